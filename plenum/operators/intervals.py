"""Closed intervals of integers: merging, overlap joins with a bin as equi key, and coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def merge(df: DataFrame, keys: list[str], begin: str, end: str) -> DataFrame:
    """Intervals that touch or overlap become one; neighbours that only follow each other stay apart."""
    order = W.partitionBy(*keys).orderBy(begin, end)
    before = F.max(end).over(order.rowsBetween(W.unboundedPreceding, -1))
    marked = df.select(*keys, begin, end).withColumn("__new", F.coalesce(F.col(begin) > before, F.lit(True)).cast("long"))
    island = F.sum("__new").over(order.rowsBetween(W.unboundedPreceding, W.currentRow))
    return marked.withColumn("__island", island).groupBy(*keys, "__island").agg(F.min(begin).alias(begin), F.max(end).alias(end), F.count("*").alias("parts")).drop("__island")


def overlap(left: DataFrame, right: DataFrame, keys: list[str], width: int) -> DataFrame:
    """Pairs of left (keys, b, e) and right (keys, s, t) with a common point, and its length.

    Both sides are cut into bins of ``width``; a pair is made in the bin where its common part begins, so it's made
    once, and no bin compares what lies far apart.
    """
    a = left.withColumn("__bin", F.explode(F.sequence(F.floor(F.col("b") / width), F.floor(F.col("e") / width))))
    c = right.withColumn("__bin", F.explode(F.sequence(F.floor(F.col("s") / width), F.floor(F.col("t") / width))))
    joined = a.join(c, [*keys, "__bin"]).where("b <= t AND e >= s")
    joined = joined.where(F.floor(F.greatest("b", "s") / width) == F.col("__bin")).drop("__bin")
    return joined.withColumn("shared", F.least("e", "t") - F.greatest("b", "s") + 1)


def coverage(parts: DataFrame, wholes: DataFrame, keys: list[str], width: int, least: float) -> DataFrame:
    """wholes (keys, s, t) with how much of each the merged parts (keys, b, e) cover, and whether that is enough."""
    held = overlap(merge(parts, keys, "b", "e"), wholes, keys, width).groupBy(*keys, "s", "t").agg(F.sum("shared").alias("covered"))
    out = wholes.join(held, [*keys, "s", "t"], "left").withColumn("covered", F.coalesce("covered", F.lit(0).cast("long")))
    ratio = F.col("covered") / (F.col("t") - F.col("s") + 1)
    return out.withColumns({"ratio": F.round(ratio, 6), "enough": ratio >= least})
