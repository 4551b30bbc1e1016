"""Bulk-synchronous best-fit packing of documents into sequences of a fixed capacity.

Pieces and gaps are tables. Sequences are opened in bulk, as many as the words need at least; each is a gap. Then in
supersteps:

1. Pieces and gaps are range-sorted by size over all tasks, a piece before a gap of its size.
2. A sweep upwards matches each gap to the largest piece before it that nobody took: pieces open brackets, gaps close
   them. A task matches its own range; what it can't match is some gaps smaller than some pieces, in order.
3. Between tasks only ranks matter: from each task's two counts follows which ranks of its gaps take which ranks of
   earlier tasks' pieces. Rows with the same number of a pair meet.
4. Gaps shrink by what they took, and the next superstep begins, until a sweep places hardly anything.

Few pieces are left then, mostly too large for the gaps there are; tasks open sequences for them, best fit on mixed
batches. Pieces of at most SMALL words are bundled first, so a sequence takes some 16 items at most and supersteps
are as few, however short the documents.
"""

from __future__ import annotations

import bisect
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, only
from .tokens import Vocabulary

CAPACITY, END, SMALL, LEAST, SWEEP_ROWS = 1024, 2, 64, 0.02, 4_000_000
PIECE, GAP, PLACED = 0, 1, 2

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, item long, inner long, total long"
STATE = "kind int, size long, id long, sequence long, offset long, task int, rank long"


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: whole ones, and what is left over comes first."""
    if n <= capacity:
        return [(0, n)]
    rest = n % capacity
    return ([(0, rest)] if rest else []) + [(s, capacity) for s in range(rest, n, capacity)]


def bundles(length: np.ndarray, small: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per piece the piece that stands for its bundle, its place in there, and the bundle's length (0 but for that piece).

    Small pieces of like length are bundled in order until a bundle has ``small`` ids or more; others are alone.
    """
    item, inner, total = np.arange(len(length)), np.zeros(len(length), np.int64), length.copy()
    few = np.flatnonzero(length <= small)
    few = few[np.argsort(length[few], kind="stable")]
    if len(few):
        before = np.cumsum(length[few]) - length[few]
        number = before // small
        first = np.flatnonzero(np.concatenate(([True], number[1:] != number[:-1])))
        own = np.repeat(first, np.diff(np.append(first, len(few))))
        item[few], inner[few], total[few] = few[own], before - before[own], 0
        total[few[first]] = np.add.reduceat(length[few], first)
    return item, inner, total


def pieces(docs: DataFrame, vocabulary: Vocabulary = Vocabulary(), capacity: int = CAPACITY, end: int = END, small: int = SMALL) -> DataFrame:
    """A row per piece: what it is, the item it goes with and its place there; the item's length is with one of its pieces."""

    def run(batches):
        from pyspark import TaskContext

        encoder, number = vocabulary.encoder(), TaskContext.get().partitionId() << 33
        last = np.array([end], "<u4").tobytes()
        for batch in batches:
            out = tuple([] for _ in range(5))
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encoder.ids(text.as_py() or "") + last
                for k, (start, n) in enumerate(cut(len(ids) // 4, capacity)):
                    for column, x in zip(out, (doc, k, start, n, zlib.crc32(ids[4 * start : 4 * (start + n)])), strict=True):
                        column.append(x)
            item, inner, total = bundles(np.array(out[3], np.int64), min(small, capacity // 2))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            made = [pa.array(c, k) for c, k in zip(out, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*made, pa.array(number + item), pa.array(inner), pa.array(total)], names=["doc_id", "piece", "start", "length", "ids_crc32", "item", "inner", "total"])
            number += len(item)

    return only(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(run, PIECES)


def matched(kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of pieces and of the gaps that take them, in a run sorted by size: the bracket matching.

    A piece goes one level up, a gap one down; on each level they alternate, so a piece and the next gap on its
    level are a pair.
    """
    level = np.cumsum(np.where(kind == PIECE, 1, -1)) + (kind == GAP)
    order = np.argsort(level, kind="stable")
    pair = np.flatnonzero((np.diff(level[order]) == 0) & (kind[order[:-1]] == PIECE) & (kind[order[1:]] == GAP))
    return order[pair], order[pair + 1]


def between(counts: list[tuple[int, int, int]]) -> tuple[dict[int, list], dict[int, list], int]:
    """Pairs across tasks from (task, gaps left, pieces left) in order of tasks: per task the runs (first rank, end, first pair) of its pieces and of its gaps, and how many pairs.

    Gaps have ranks upwards, pieces downwards from the largest. Two runs at most begin with each task.
    """
    stack, of_pieces, of_gaps, pairs = [], {}, {}, 0
    for task, gaps, own in counts:
        rank = 0
        while rank < gaps and stack:
            other, at, left = stack.pop()
            n = min(left, gaps - rank)
            of_pieces.setdefault(other, []).append((at, at + n, pairs))
            of_gaps.setdefault(task, []).append((rank, rank + n, pairs))
            pairs, rank = pairs + n, rank + n
            if n < left:
                stack.append((other, at + n, left - n))
        if own:
            stack.append((task, 0, own))
    return of_pieces, of_gaps, pairs


def _state(kind, size, ids, sequence=None, offset=None, task=None, rank=None) -> pa.RecordBatch:
    n = len(ids)

    def column(x, kind):
        return pa.nulls(n, kind) if x is None else pa.array(np.broadcast_to(np.asarray(x), n), kind)

    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
    return pa.RecordBatch.from_arrays([column(x, k) for x, k in zip((kind, size, ids, sequence, offset, task, rank), kinds, strict=True)], names=[c.split()[0] for c in STATE.split(", ")])


def _sweep(capacity: int):
    """A task's own matches: pieces placed and gaps updated; what is left has its rank, for other tasks."""

    def run(batches):
        from pyspark import TaskContext

        task, held = TaskContext.get().partitionId(), list(batches)
        if not held:
            return
        size, kind, ids = (np.concatenate([np.asarray(b.column(i)) for b in held]) for i in range(3))
        p, g = matched(kind)
        room = size[g]
        yield _state(PLACED, size[p], ids[p], ids[g], capacity - room)
        more = room > size[p]
        yield _state(GAP, (room - size[p])[more], ids[g][more])
        left = np.ones(len(ids), bool)
        left[p] = left[g] = False
        gaps, own = np.flatnonzero(left & (kind == GAP)), np.flatnonzero(left & (kind == PIECE))[::-1]
        for k, at in ((GAP, gaps), (PIECE, own)):
            yield _state(k, size[at], ids[at], task=task, rank=np.arange(len(at)))

    return run


def _numbered(rest: DataFrame, of_pieces: dict[int, list], of_gaps: dict[int, list]) -> DataFrame:
    """What tasks left, with the number of the pair that a row belongs to, or null."""

    def run(batches):
        for batch in batches:
            kind, task, rank = (np.asarray(batch.column(batch.schema.get_field_index(c))) for c in ("kind", "task", "rank"))
            pair = np.full(len(rank), -1, np.int64)
            for k, runs in ((PIECE, of_pieces), (GAP, of_gaps)):
                for t in np.unique(task[kind == k]):
                    own = np.flatnonzero((kind == k) & (task == t))
                    first, end, base = (np.array(x, np.int64) for x in zip(*runs.get(int(t), [(0, 0, 0)]), strict=True))
                    i = np.maximum(0, np.searchsorted(first, rank[own], side="right") - 1)
                    pair[own] = np.where(rank[own] < end[i], base[i] + rank[own] - first[i], -1)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(pair, mask=pair < 0)], names=["kind", "size", "id", "pair"])

    return rest.select("kind", "size", "id", "task", "rank").mapInArrow(run, "kind int, size long, id long, pair long")


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence (from 0) and offset of each size: best fit in decreasing order."""
    rooms, number, offset = [], np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    fresh = 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        n = int(sizes[i])
        at = bisect.bisect_left(rooms, (n, -1))
        if at < len(rooms):
            room, k = rooms.pop(at)
        else:
            room, k, fresh = capacity, fresh, fresh + 1
        number[i], offset[i] = k, capacity - room
        if room > n:
            bisect.insort(rooms, (room - n, k))
    return number, offset


def _opened(capacity: int):
    """Sequences for the pieces that no sweep places, opened batch by batch."""

    def run(batches):
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 33
        for batch in batches:
            ids, size = (np.asarray(batch.column(i)) for i in (0, 1))
            number, offset = best_fit(size, capacity)
            yield _state(PLACED, size, ids, (base + number) * 4 + 2, offset)
            base += len(ids)

    return run


def fit(items: DataFrame, scratch: Scratch, capacity: int = CAPACITY, least: float = LEAST) -> tuple[DataFrame, int]:
    """id, sequence, offset for all items (id, size; sizes below the capacity), and the number of supersteps.

    Sweeps end when one places less than ``least`` of what was there, or nothing is left. Each superstep's result is
    a table in the shared folder. The driver sees three counts a task, and a task SWEEP_ROWS rows of three numbers.
    """
    spark = scratch.spark
    sums = items.agg(F.count("*").alias("n"), F.sum("size").alias("all"), F.count_if(F.col("size") > capacity // 2).alias("half")).first()
    left, log, steps = sums["n"], [], 0
    opened = max(-(-(sums["all"] or 0) // capacity), sums["half"])
    # a task holds its range, so ranges are bounded whatever the session's number of partitions is
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(left + opened) // SWEEP_ROWS))
    now = items.select(F.lit(PIECE).alias("kind"), "size", "id")
    if left:
        gaps = spark.range(opened)
        now = now.unionByName(gaps.select(F.lit(GAP).alias("kind"), F.lit(capacity).cast("long").alias("size"), (F.col("id") * 4 + 1).alias("id")))
    while left:
        dealt = now.select("size", "kind", "id").repartitionByRange(ranges, "size", "kind", "id").sortWithinPartitions("size", "kind", "id")
        met = scratch.write(dealt.mapInArrow(_sweep(capacity), STATE), f"met{steps}")
        counts: dict[int, list[int]] = {}
        placed = 0
        for r in met.where(F.col("rank").isNotNull() | (F.col("kind") == PLACED)).groupBy("task", "kind").count().collect():  # three rows a task at most
            if r["kind"] == PLACED:
                placed += r["count"]
            else:
                counts.setdefault(r["task"], [0, 0])[r["kind"]] = r["count"]
        of_pieces, of_gaps, pairs = between([(t, c[GAP], c[PIECE]) for t, c in sorted(counts.items())])
        rest = _numbered(met.where("rank IS NOT NULL"), of_pieces, of_gaps)
        side = {f"{c}{k}": F.max(F.when(F.col("kind") == k, F.col(c))) for k in (PIECE, GAP) for c in ("size", "id")}
        across = rest.where("pair IS NOT NULL").groupBy("pair").agg(*[x.alias(n) for n, x in side.items()])
        across = scratch.write(across.select(F.col(f"id{PIECE}").alias("id"), F.col(f"id{GAP}").alias("sequence"), (capacity - F.col(f"size{GAP}")).alias("offset"), (F.col(f"size{GAP}") - F.col(f"size{PIECE}")).alias("room")), f"across{steps}")
        log += [met.where(F.col("kind") == PLACED).select("id", "sequence", "offset"), across.select("id", "sequence", "offset")]
        now = rest.where("pair IS NULL").select("kind", "size", "id").unionByName(met.where(f"kind = {GAP} AND rank IS NULL").select("kind", "size", "id"))
        now = now.unionByName(across.where("room > 0").select(F.lit(GAP).alias("kind"), F.col("room").alias("size"), F.col("sequence").alias("id")))
        steps, placed, before = steps + 1, placed + pairs, left
        left -= placed
        if placed < least * before:
            break
    if left:
        rest = now.where(F.col("kind") == PIECE).select("id", "size").repartition(F.xxhash64("id"))
        log.append(scratch.write(rest.mapInArrow(_opened(capacity), STATE), "opened").select("id", "sequence", "offset"))
    out = items.select("id", F.lit(0).cast("long").alias("sequence"), F.lit(0).cast("long").alias("offset")).limit(0)
    for part in log:
        out = out.unionByName(part)
    return out, steps


def pack(docs: DataFrame, vocabulary: Vocabulary = Vocabulary(special=True), capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset: one row per piece of every row of docs.

    Null and empty texts are the end id alone. Null doc_ids and repeated rows are packed like any other, each
    on its own. Empty table: empty result. Columns other than doc_id and text aren't read. Equal lengths tie; who
    gets which place follows tasks and their order, and any choice fills sequences alike.
    Tokens are counted once: pieces go to a table in the shared folder, so their numbers hold when a task runs again.
    A piece of the whole capacity is a sequence by itself.
    """
    scratch = Scratch(docs.sparkSession, "pack")
    rows = scratch.write(pieces(docs, vocabulary, capacity, end), "pieces")
    alone, parts = rows.where(F.col("length") == capacity), rows.where(F.col("length") < capacity)
    placed, _ = fit(parts.where("total > 0").select(F.col("item").alias("id"), F.col("total").alias("size")), scratch, capacity)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    met = parts.join(placed.select(F.col("id").alias("item"), "sequence", "offset").hint("merge"), "item")
    met = met.select(*columns, F.col("sequence").alias("sequence_id"), (F.col("offset") + F.col("inner")).alias("offset"))
    return alone.select(*columns, (F.col("item") * 4).alias("sequence_id"), F.lit(0).cast("long").alias("offset")).unionByName(met)
