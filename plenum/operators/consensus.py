"""Votes over repeated records: winners, histograms, the best record, and where it differs.

A record's order decides ties everywhere: of equally frequent values the one seen first wins, of equally good
records the first. Null is a candidate like any other value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def votes(df: DataFrame, keys: list[str], field: str, order: str) -> DataFrame:
    """keys, value, n, first: how many records vote for each value, and the first that does."""
    return df.groupBy(*keys, F.col(field).alias("value")).agg(F.count("*").alias("n"), F.min(order).alias("first"))


def majority(df: DataFrame, keys: list[str], field: str, order: str) -> DataFrame:
    """keys, winner, votes, voters. Two partial aggregates; the second has a row per candidate only."""
    rank = F.struct(F.col("n"), -F.col("first"))
    best = F.max_by(F.struct("value"), rank)["value"]
    return votes(df, keys, field, order).groupBy(*keys).agg(best.alias("winner"), F.max("n").alias("votes"), F.sum("n").alias("voters"))


def winners(df: DataFrame, keys: list[str], fields: list[str], order: str, soft: tuple[str, ...] = ()) -> DataFrame:
    """keys, field, winner, votes, voters for all fields but soft ones, values as text; the input is read once."""
    kept = [f for f in fields if f not in soft]
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in kept]))
    long = df.select(*keys, order, pairs.alias("x")).select(*keys, order, "x.field", "x.value")
    return majority(long, [*keys, "field"], "value", order)


def best(df: DataFrame, keys: list[str], fields: list[str], order: str) -> DataFrame:
    """The record of each group that agrees with most winners, its score, and the winners beside its own values.

    Records that are alike are one row from the start, with their number and the first of them, so all that follows
    has a row per distinct record. Winners of all fields come from one aggregate over candidates.
    """
    alike = df.groupBy(*keys, *fields).agg(F.count("*").alias("__n"), F.min(order).alias(order))
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields]))
    cast = alike.select(*keys, order, "__n", pairs.alias("x")).groupBy(*keys, "x.field", "x.value").agg(F.sum("__n").alias("n"), F.min(order).alias("first"))

    def rank(f: str):
        return F.when(F.col("field") == f, F.struct("n", -F.col("first")))

    wide = cast.groupBy(*keys).agg(*[F.max_by(F.struct("value"), rank(f))["value"].alias(f"w_{f}") for f in fields], *[F.max(F.when(F.col("field") == f, F.col("n"))).alias(f"v_{f}") for f in fields])
    score = sum((F.col(f).cast("string").eqNullSafe(F.col(f"w_{f}"))).cast("long") for f in fields)
    whole = F.struct(order, *fields, *[f"{p}_{f}" for f in fields for p in "wv"])
    top = alike.join(wide, keys).withColumn("score", score).groupBy(*keys).agg(F.max("score").alias("score"), F.max_by(whole, F.struct("score", -F.col(order))).alias("r"))
    return top.select(*keys, "score", "r.*")


def differences(df: DataFrame, keys: list[str], fields: list[str], order: str) -> DataFrame:
    """keys, field, best_value, majority_value, votes where the best record and a winner that isn't null differ."""
    found = best(df, keys, fields, order)
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("best_value"), F.col(f"w_{f}").alias("majority_value"), F.col(f"v_{f}").alias("votes")) for f in fields]))
    return found.select(*keys, each.alias("x")).select(*keys, "x.*").where("majority_value IS NOT NULL AND NOT (best_value <=> majority_value)")


def first_seen(df: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """keys, seen: the distinct values of a group in the order in which they first come. One row per value meets."""
    first = df.groupBy(*keys, F.col(value).alias("value")).agg(F.min(order).alias("first"))
    return first.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("first", "value"))), lambda x: x["value"]).alias("seen"))


def merged_candidates(cast: DataFrame, anchors: DataFrame, keys: list[str]) -> DataFrame:
    """Votes (keys, value, n) and anchors (keys, value) as one ranked list: an anchor without votes has 0."""
    every = cast.select(*keys, "value", "n").unionByName(anchors.select(*keys, "value", F.lit(0).cast("long").alias("n")))
    return every.groupBy(*keys, "value").agg(F.sum("n").alias("n"))
