"""Connected components of a distributed edge list."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def merge_labels(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Unites a[i] and b[i] for all i in a forest whose roots are the smallest members; afterwards parent is flat."""
    while True:
        x, y = parent[a], parent[b]
        if not (x != y).any():
            return
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent[:] = up


def _contract(edges: DataFrame) -> DataFrame:
    """Each batch's edges as stars around the smallest member: fewer and shallower, with the same components."""

    def run(batches):
        for batch in batches:
            u, v = (np.asarray(batch.column(i)) for i in (0, 1))
            nodes, at = np.unique(np.concatenate((u, v)), return_inverse=True)
            parent = np.arange(len(nodes))
            merge_labels(parent, at[: len(u)], at[len(u) :])
            out = np.flatnonzero(parent != np.arange(len(nodes)))
            yield pa.RecordBatch.from_arrays([pa.array(nodes[out]), pa.array(nodes[parent[out]])], names=["u", "v"])

    return edges.mapInArrow(run, "u long, v long")


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """node, root for every node that has an edge; root is the smallest node of its component.

    Alternates two steps until nothing changes: every node hands the smallest of its neighbours to the larger
    ones, then to the smaller ones. Both are a partial aggregate and a plain equi-join, which Spark splits where a
    star has many members. A round replaces its lineage by a table in the shared folder. Rounds grow with the
    logarithm of a component's length.
    """
    u, v = edges.columns[:2]
    pairs = edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).where("u <> v")
    now = scratch.write(_contract(pairs).distinct(), f"{name}0")
    seen, k = None, 0
    while True:
        mark = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if mark == seen or mark["n"] == 0:
            break
        seen = mark
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        rest = large.join(lower, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        following = rest.unionByName(lower.select("u", F.col("m").alias("v"))).distinct()
        now = scratch.write(following, f"{name}{k + 1}")
        scratch.drop(f"{name}{k}")
        k += 1
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
