"""Embedding near-duplicates by an exact metric range join.

Vectors are scaled to length 1, where a cosine of at least c is a distance of at most r = sqrt(2 - 2c). Pivots cut
the space into cells of the nearest pivot. A segment between two near vectors of different cells crosses the
plane between their pivots, so by the triangle inequality each lies within r of it: only such boundary vectors
are sent to another cell, and cells join on their own. A cell is cut into blocks of bounded size; a task holds
one block and streams the others past it, so memory doesn't grow with a cell, also where a third of all vectors
are near each other. Equal vectors are one node. Tasks return counts and stars, never all pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch
from .connected import components, merge_labels

COSINE, BLOCK, PIVOT_ROWS, PIVOTS, STRIP = 0.95, 2048, 4096, 256, 512
#: Blocks grow with the table up to WIDEST, so that there are some BLOCKS of them; a strip makes as many products as STRIP against BLOCK. Rows sent go in batches of SENT.
BLOCKS, WIDEST, SENT = 32, 32_768, 20_000
#: Pivots whose cosine is closer to 1 than PARALLEL are one; SLACK is far above the rounding errors of a border's distance.
PARALLEL, SLACK = 1e-6, 1e-7


def unit(rows: list[bytes], kind: str) -> np.ndarray:
    """Vectors scaled to length 1 in double precision."""
    x = np.frombuffer(b"".join(rows), kind).reshape(len(rows), -1).astype(np.float64)
    big = np.abs(x).max(axis=1, keepdims=True)
    x = x / big  # else squares of very large or small numbers leave the range
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def strip(n: int) -> int:
    """Vectors that are compared with n others at once."""
    return max(1, STRIP * BLOCK // max(n, BLOCK))


def nodes_of(vectors: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame, str]:
    """All rows with their content key, and a node per distinct usable vector: node, dim, v (bytes), mult, low."""
    kind = "<f4" if "float" in vectors.schema["embedding"].dataType.simpleString() else "<f8"
    e = F.col("`embedding`")
    wide = e.cast("array<double>")
    usable = F.coalesce((F.size(wide) > 0) & F.forall(wide, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))) & F.exists(wide, lambda x: x != 0), F.lit(False))
    # adding 0 makes the two zeros one
    clean = F.transform(wide, lambda x: x + F.lit(0.0))
    rows = vectors.select(F.col("`vec_id`").cast("long").alias("vec_id"), F.when(usable, clean).alias("v")).withColumns({"k1": F.when(F.col("v").isNotNull(), F.xxhash64("v")), "k2": F.when(F.col("v").isNotNull(), F.xxhash64(F.lit(7), "v"))})
    grouped = rows.where("v IS NOT NULL").groupBy("k1", "k2").agg(F.count("*").alias("mult"), F.min("vec_id").alias("low"), F.first("v").alias("v"))
    numbered = grouped.withColumn("node", F.monotonically_increasing_id()).select("node", F.size("v").alias("dim"), "v", "mult", "low", "k1", "k2")

    def pack(batches):
        for batch in batches:
            v = [np.array(x, kind).tobytes() for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(v, pa.binary()), *(batch.column(i) for i in range(3, 7))], names=batch.schema.names)

    packed = numbered.mapInArrow(pack, "node long, dim int, v binary, mult long, low long, k1 long, k2 long")
    return rows.drop("v"), scratch.write(packed, "nodes"), kind


def pivots_of(nodes: DataFrame, kind: str, pivot_rows: int, most: int) -> dict[int, np.ndarray]:
    """Per dimension one pivot for each pivot_rows nodes, up to ``most``: the nodes with the smallest hashes, one of each direction."""
    out = {}
    for dim, n in nodes.groupBy("dim").count().collect():
        count = max(1, min(most, n // pivot_rows))
        rows = nodes.where(F.col("dim") == dim).orderBy(F.xxhash64("k1"), "k1", "k2").limit(count).select("v").collect()
        p = unit([bytes(r["v"]) for r in rows], kind)
        keep = [0]
        for j in range(1, len(p)):
            if (p[keep] @ p[j]).max() <= 1 - PARALLEL:
                keep.append(j)
        out[dim] = p[keep]
    return out


def widths(n: int) -> tuple[int, int]:
    """Vectors of a block, and of a cell on average, for n of them: where pivots don't separate, each is sent to half of all blocks."""
    block = max(BLOCK, min(WIDEST, -(-n // BLOCKS)))
    return block, max(PIVOT_ROWS, 2 * block)


def near(vectors: DataFrame, cosine: float = COSINE, block: int | None = None, pivot_rows: int | None = None, pivots: int = PIVOTS) -> DataFrame:
    """vec_id, n_links, component_id and kept: one row for every row of vectors.

    Null, empty and zero vectors and those with a null or non-finite component link with nothing and are kept.
    Vectors of different lengths don't link. Repeated rows and equal vectors link with each other, each row
    counting. A null vec_id counts as a link and has its component's smallest id that isn't null. Empty table: empty
    result. Columns other than vec_id and embedding aren't read.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "near")
    rows, nodes, kind = nodes_of(vectors, scratch)
    wide = widths(nodes.count())
    block, pivot_rows = block or wide[0], pivot_rows or wide[1]
    centres = pivots_of(nodes, kind, pivot_rows, pivots)
    radius = math.sqrt(max(0.0, 2 - 2 * cosine)) + 1e-9

    def home(batches):
        for batch in batches:
            dims, v = np.asarray(batch.column(1)), batch.column(2).to_pylist()
            cell = np.zeros(len(dims), np.int32)
            for dim in np.unique(dims):
                own = np.flatnonzero(dims == dim)
                cell[own] = (unit([v[i] for i in own], kind) @ centres[dim].T).argmax(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), batch.column(3), pa.array(cell), batch.column(5)], names=["node", "dim", "v", "mult", "cell", "k1"])

    placed = scratch.write(nodes.mapInArrow(home, "node long, dim int, v binary, mult long, cell int, k1 long"), "placed")
    # blocks, numbered through within a dimension; as many as there are cells or rows / block, whichever is more
    slices: dict[int, dict[int, tuple[int, int]]] = {}
    for r in placed.groupBy("dim", "cell").count().orderBy("dim", "cell").collect():
        own = slices.setdefault(r["dim"], {})
        own[r["cell"]] = (sum(n for _, n in own.values()), -(-r["count"] // block))
    total = {dim: sum(n for _, n in own.values()) for dim, own in slices.items()}

    def send(batches):
        """Each node to its own block, and to each block that compares with it and whose cell's border is near."""
        for batch in batches:
            dims, cells, keys = (np.asarray(batch.column(i)) for i in (1, 4, 5))
            v = batch.column(2).to_pylist()
            row, to, side, held = [], [], [], 0

            def made(batch=batch):
                at = pa.array(np.concatenate(row))
                return pa.RecordBatch.from_arrays([batch.column(1).take(at), pa.array(np.concatenate(to).astype(np.int32)), pa.array(np.concatenate(side)), batch.column(0).take(at), batch.column(3).take(at), batch.column(2).take(at)], names=["dim", "block", "side", "node", "mult", "v"])

            for dim in np.unique(dims):
                own = np.flatnonzero(dims == dim)
                p, n = centres[dim], total[dim]
                cos = unit([v[i] for i in own], kind) @ p.T
                cell = cells[own]
                first = np.array([slices[dim][c][0] for c in cell])
                count = np.array([slices[dim][c][1] for c in cell])
                mine = first + (keys[own].astype(np.uint64) >> np.uint64(8)) % count.astype(np.uint64)
                mine = mine.astype(np.int64)
                row.append(own), to.append(mine), side.append(np.zeros(len(own), np.int8))
                held += len(own)
                gap = np.sqrt(np.maximum(0.0, 2 - 2 * (p @ p.T)))
                for j, (begin, many) in slices[dim].items():
                    reach = (cos[np.arange(len(own)), cell] - cos[:, j]) <= radius * gap[cell, j] + SLACK
                    for other in range(begin, begin + many):
                        ahead = (mine - other) % n  # a pair of blocks meets in the one from which the other is less far round
                        go = np.flatnonzero(reach & (ahead > 0) & ((2 * ahead < n) | ((2 * ahead == n) & (other < mine))))
                        row.append(own[go]), to.append(np.full(len(go), other)), side.append(np.ones(len(go), np.int8))
                        held += len(go)
                        if held >= SENT:  # else a batch's copies for all blocks stand in memory at once
                            yield made()
                            row, to, side, held = [], [], [], 0
            if held:
                yield made()

    def join(batches):
        """Rows come by block, the block's own ones first."""
        state: dict = {"key": None}

        def close():
            left = state.pop("left", None)
            if left is None:
                return None
            parent, links, ids = state["parent"], state["links"], state["ids"]
            step = strip(len(left))
            for s in range(0, len(left), step):
                a, b = np.nonzero(left[s : s + step] @ left[s:].T >= cosine)
                keep = a < b
                a, b = a[keep] + s, b[keep] + s
                np.add.at(links, a, state["mult"][b])
                np.add.at(links, b, state["mult"][a])
                merge_labels(parent, a, b)
            return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(links), pa.array(ids[parent])], names=["node", "links", "root"])

        def ready():
            if "left" not in state:
                state["left"] = unit(state["rows"], kind)
                state["ids"], state["mult"] = np.array(state["nodes"], np.int64), np.array(state["mults"], np.int64)
                state["parent"], state["links"] = np.arange(len(state["ids"])), np.zeros(len(state["ids"]), np.int64)

        for batch in batches:
            dim, to, side = (np.asarray(batch.column(i)) for i in range(3))
            cut = np.flatnonzero((dim[1:] != dim[:-1]) | (to[1:] != to[:-1]) | (side[1:] != side[:-1])) + 1
            for a, b in zip(np.concatenate(([0], cut)), np.concatenate((cut, [len(to)])), strict=True):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                if side[a] == 0:
                    if state["key"] != (dim[a], to[a]):
                        if state["key"] is not None:
                            ready()
                            yield close()
                        state.clear()
                        state.update(key=(dim[a], to[a]), rows=[], nodes=[], mults=[])
                    state["rows"] += part.column(5).to_pylist()
                    state["nodes"] += part.column(3).to_pylist()
                    state["mults"] += part.column(4).to_pylist()
                    continue
                ready()
                step = strip(len(state["left"]))
                for s in range(0, b - a, step):
                    piece = part.slice(s, step)
                    r, c = np.nonzero(unit(piece.column(5).to_pylist(), kind) @ state["left"].T >= cosine)
                    if not len(r):
                        continue
                    ids, mult = np.asarray(piece.column(3)), np.asarray(piece.column(4))
                    np.add.at(state["links"], c, mult[r])
                    theirs = np.zeros(len(ids), np.int64)
                    np.add.at(theirs, r, state["mult"][c])
                    first = np.flatnonzero(np.concatenate(([True], r[1:] != r[:-1])))
                    merge_labels(state["parent"], np.repeat(c[first], np.diff(np.append(first, len(r)))), c)
                    hit = r[first]
                    yield pa.RecordBatch.from_arrays([pa.array(ids[hit]), pa.array(theirs[hit]), pa.array(state["ids"][c[first]])], names=["node", "links", "root"])
        if state["key"] is not None:
            ready()
            yield close()

    sent = placed.mapInArrow(send, "dim int, block int, side byte, node long, mult long, v binary")
    blocks = max(1, sum(total.values()))
    dealt = sent.repartition(min(blocks, 100_000), "dim", "block").sortWithinPartitions("dim", "block", "side")
    found = scratch.write(dealt.mapInArrow(join, "node long, links long, root long"), "found")
    roots = components(found.where("node <> root").select("node", "root"), scratch, "roots")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    known = nodes.select("node", "mult", "low", "k1", "k2").join(links, "node", "left").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    known = scratch.write(known, "known")
    lowest = known.groupBy("root").agg(F.min("low").alias("lowest"))
    known = known.join(lowest, "root").select("k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n_links"), "lowest")
    out = rows.join(known, ["k1", "k2"], "left")
    component = F.coalesce("lowest", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


def sql(cosine: float = COSINE) -> str:
    """The same links for DuckDB, by comparing all pairs of usable vectors."""
    return f"""
WITH RECURSIVE e AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
), usable AS (
  SELECT vec_id, v FROM e WHERE len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0
), linked AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE CASE WHEN len(a.v) = len(b.v) THEN list_cosine_similarity(a.v, b.v) END >= {cosine}
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM e UNION SELECT reach.a, linked.b FROM reach JOIN linked ON reach.b = linked.a
), lowest AS (
  SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a
), links AS (
  SELECT a AS vec_id, count(*) AS n_links FROM linked GROUP BY a
)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM lowest LEFT JOIN links USING (vec_id)"""
