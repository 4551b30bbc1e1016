"""Findings as rows: building, parsing, what they mean for a block, and fan-out of records to tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plenum.functions.text import list_index, quoted_path


def findings(*kinds: tuple[DataFrame, str, Column, str]) -> DataFrame:
    """bucket, path, message over all (rows, bucket, path, template); a template has one place for the path."""
    return reduce(DataFrame.unionByName, [df.select(F.lit(bucket).alias("bucket"), path.alias("path"), F.format_string(template, path).alias("message")) for df, bucket, path, template in kinds])


def parsed(df: DataFrame, message: str = "message") -> DataFrame:
    """The path in quotes, the first index in it, and whether the message speaks of something invented."""
    m = F.col(message)
    return df.select(message, quoted_path(m).alias("path"), m.contains("HALLUCINATION").alias("invented"), list_index(m).alias("index"))


def impact(found: DataFrame, fatal: str = "critical") -> DataFrame:
    """Per first part of a path: fatal findings, list entries concerned, and whether the block or only these go."""
    block, index = F.regexp_extract("path", r"^([^.\[]*)", 1), list_index(F.col("path"))
    rows = found.select("bucket", block.alias("block"), index.alias("i"))
    bad = F.count_if(F.col("bucket") == fatal)
    return rows.groupBy("block").agg(bad.alias("fatal"), F.count_distinct("i").alias("indices"), F.when(bad > 0, "DELETE_BLOCK").otherwise("CLEAN_ENTRIES").alias("action"))


def dispatch(df: DataFrame, kind: str, targets: dict[str, str], default: str) -> DataFrame:
    """df with the table that each row goes to."""
    names = F.create_map(*[F.lit(x) for pair in targets.items() for x in pair])
    return df.withColumn("target", F.coalesce(F.try_element_at(names, F.col(kind)), F.lit(default)))


def first_items(df: DataFrame, key: str, item: str, most: int) -> DataFrame:
    """The smallest items of each key as a text, and how many more there are. Only ``most`` items of a key meet."""
    counts = df.groupBy(key).agg(F.count(item).alias("n"))
    ranked = df.where(F.col(item).isNotNull()).withColumn("__place", F.row_number().over(W.partitionBy(key).orderBy(item))).where(F.col("__place") <= most)
    first = ranked.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("__place", F.col(item).cast("string").alias("x")))).alias("some"))
    more = F.when(F.col("n") > most, F.array(F.concat(F.lit("... ("), (F.col("n") - most).cast("string"), F.lit(" more)")))).otherwise(F.array().cast("array<string>"))
    names = F.coalesce(F.transform("some", lambda x: x["x"]), F.array().cast("array<string>"))
    return counts.join(first, key, "left").select(key, F.array_join(F.concat(names, more), ", ").alias("items"))


def tallies(df: DataFrame, key: str, **conditions: Column) -> DataFrame:
    """key, n and how many rows meet each condition; null doesn't."""
    return df.groupBy(key).agg(F.count("*").alias("n"), *[F.count_if(c).alias(name) for name, c in conditions.items()])


def promoted(oligo: Column) -> Column:
    """What an oligomer analysis adds to the critical findings: a corrected chain, alerts, incomplete segments. Fixed wording."""
    over = oligo["chain_id_override"]
    shown = [F.coalesce(over[f], F.lit("None")) for f in ("original_chain_id", "corrected_chain_id", "trigger")]
    chain = F.when(over["applied"], F.concat(F.lit("CHAIN_ID CORRECTED at 'receptor_info': "), shown[0], F.lit(" -> "), shown[1], F.lit(" ("), shown[2], F.lit("). Human confirmation required.")))
    told = F.filter(oligo["alerts"], lambda a: a["type"].isin("HALLUCINATION", "MISSED_PROTOMER", "SUSPICIOUS_7TM"))
    alerts = F.transform(told, lambda a: F.concat(F.lit("OLIGOMER ALERT at 'receptor_info': ["), a["type"], F.lit("] "), F.coalesce(a["message"], F.lit(""))))
    poor = F.exists(oligo["all_gpcr_chains"], lambda c: c["7tm_status"] == "INCOMPLETE_7TM")
    quality = F.when(poor, "STRUCTURAL QUALITY at 'receptor_info': One or more GPCR chains have INCOMPLETE 7TM domains.")
    none = F.array().cast("array<string>")
    return F.concat(F.array_compact(F.array(chain)), F.coalesce(alerts, none), F.array_compact(F.array(quality)))
