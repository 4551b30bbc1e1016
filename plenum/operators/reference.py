"""Checks of reported keys against reference tables: lookups, missing keys, existence, identity, waterfalls."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_wins(df: DataFrame, keys: list[str], order: Column | str, *columns: str) -> DataFrame:
    """One row per key, from the row that stands last."""
    row = F.max_by(F.struct(*columns), order)
    return df.groupBy(*keys).agg(row.alias("r")).select(*keys, "r.*")


def ghosts(reported: DataFrame, valid: DataFrame, key: str) -> DataFrame:
    """Reported keys that aren't valid; none at all where there are no valid keys to compare with."""
    some = valid.where(F.col(key).isNotNull()).limit(1).select(F.lit(1).alias("__some"))
    return reported.join(valid.select(key).distinct(), key, "left_anti").join(F.broadcast(some)).drop("__some")


def existence(df: DataFrame, known: DataFrame, key: str, flag: str) -> DataFrame:
    """df with ``status``: exists, missing or unknown, as known's boolean flag is true, false or absent."""
    joined = df.join(known.select(key, F.col(flag).alias("__flag")), key, "left")
    return joined.withColumn("status", F.when(F.col("__flag"), "exists").when(~F.col("__flag"), "missing").otherwise("unknown")).drop("__flag")


def waterfall(*rules: tuple[Column, str], default: str) -> Column:
    """The name of the first rule that holds; a rule that is null doesn't hold."""
    return reduce(lambda out, rule: F.when(F.coalesce(rule[0], F.lit(False)), rule[1]).otherwise(out), reversed(rules), F.lit(default))


def first_rule(df: DataFrame, group: list[str], rules: list[tuple[Column, str]], order: list[Column], columns: list[str]) -> DataFrame:
    """Per group the row chosen by the earliest rule that any row meets, and that rule's number and name.

    Of several rows the first in order counts; order has columns that sort upwards. A partial aggregate, no sort.
    """
    rank = reduce(lambda out, r: F.when(F.coalesce(r[1][0], F.lit(False)), r[0]).otherwise(out), reversed(list(enumerate(rules, 1))), F.lit(len(rules) + 1))
    names = F.array(*[F.lit(n) for _, n in rules], F.lit("none"))
    best = df.groupBy(*group).agg(F.min_by(F.struct(*columns, rank.alias("rule")), F.struct(rank, *order)).alias("r"))
    return best.select(*group, *[F.col("r")[c].alias(c) for c in columns], F.col("r.rule").cast("long").alias("rule"), F.element_at(names, F.col("r.rule")).alias("reason"))


def pending(available: DataFrame, done: DataFrame, key: str, required: int = 1) -> DataFrame:
    """Keys of available with fewer than required rows in done, and how many they have."""
    have = done.groupBy(key).agg(F.count("*").alias("have"))
    return available.select(key).distinct().join(have, key, "left").select(key, F.coalesce("have", F.lit(0).cast("long")).alias("have")).where(F.col("have") < required)


def latest(log: DataFrame, key: str, order: Column | str, *columns: str) -> DataFrame:
    """The current row per key of an append-only log."""
    return last_wins(log, [key], order, *columns)


def under(rows: DataFrame, blocks: DataFrame, path: str = "path", block: str = "block") -> DataFrame:
    """rows with the block that their path lies in: the path itself, or followed by a dot or a bracket.

    The part of a path before its first dot or bracket is what rows and blocks are joined on, so blocks are first parts.
    """
    head = F.regexp_extract(path, r"^([^.\[]*)", 1)
    return rows.withColumn(block, head).join(blocks.select(block).distinct(), block)


def closest(texts: DataFrame, candidates: DataFrame, text: str, candidate: str, name: str, width: int) -> DataFrame:
    """text, score, ties, leader: how many of ``width`` positions the best candidates share, how many do, the smallest name.

    Each text meets candidates that agree on a set of positions by an equi-join, for all 2 ** width sets. At the best
    score a candidate agrees on one set only, so counts of sets are counts of candidates, and no text is compared
    with all candidates. Texts of another length score 0. Null texts, and an empty table of candidates, give nothing.
    """

    def sets(df: DataFrame, column: str) -> DataFrame:
        def held(m):
            return F.concat(*[F.when(m.bitwiseAND(1 << i) != 0, F.substring(column, i + 1, 1)).otherwise("") for i in range(width)])

        every = F.when(F.length(column) == width, F.sequence(F.lit(0), F.lit((1 << width) - 1))).otherwise(F.array(F.lit(0)))
        return df.where(F.col(column).isNotNull()).withColumn("__mask", F.explode(every)).withColumn("__held", held(F.col("__mask")))

    per = candidates.groupBy(candidate).agg(F.count("*").alias("n"), F.min(name).alias("least"))
    per = sets(per, candidate).groupBy("__mask", "__held").agg(F.sum("n").alias("n"), F.min("least").alias("least"))
    met = sets(texts.select(text).distinct(), text).join(per, ["__mask", "__held"]).withColumn("score", F.bit_count("__mask").cast("long"))
    met = met.groupBy(text, "score").agg(F.sum("n").alias("ties"), F.min("least").alias("leader"))
    best = met.groupBy(text).agg(F.max("score").alias("score"), F.max_by(F.struct("ties", "leader"), "score").alias("b"))
    return best.select(text, "score", "b.ties", "b.leader")
