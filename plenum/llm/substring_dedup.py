"""Substring dedup by prefix-partitioned suffix trees over words.

The tree's suffixes start at words, and it is cut at the depth of ``window`` words: below that, a node only splits
suffixes whose windows are equal. A node of that depth with two suffixes or more is a repeat, and the stretches that
such nodes cover are the maximal ones.

1. Which suffixes may be under such a node: a window's sample is the position of the smallest hash among its
   ``prefix``-word sequences, so equal windows have equal samples. Windows whose sample occurs once are left out.
2. Suffixes are partitioned by prefixes of variable length. A prefix has ``prefix`` words at first; one that HOT
   suffixes of a portion of texts or more begin with grows by GROW words at a time, up to the whole window. Which ones grow is
   one table for all tasks, so equal windows are in one group, and a group has HOT suffixes of a portion at most,
   unless they are equal for the whole window; of these a portion sends one.
3. A group's suffixes are sorted by the words that follow, and the common prefixes of neighbours give the subtree:
   suffixes stay together down to the depth that the least of these between them has. Where it's ``window``, all
   but the first suffix in order of documents are later ones.

Groups stream through a task in sorted order with one suffix held over, so memory doesn't follow their size. Words
stand as hashes: a window has 64 bits, a group 32, the first SHOWN words after ``prefix`` 8 bits each of a chained
hash. So nodes of the window's depth are exact as 64 bits are. Depths above are as good as 8 bits are, end with the
words shown, and are too large at the border of two groups with one hash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, Scratch, only, parts, raw, small
from .words import _P, grams, mix, word_hashes

WINDOW, PREFIX, GROW, HOT, GROWN, SHOWN, PART = 20, 8, 4, 64, 200_000, 8, 1 << 20


def samples(h: np.ndarray, window: int, prefix: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of one text the position of its sample, and the hashes of all prefixes."""
    g = grams(h, prefix)
    n, span = len(h) - window + 1, window - prefix + 1
    if n <= 0:
        return np.zeros(0, np.int64), g
    best, at = g[:n].copy(), np.arange(n)
    for j in range(1, span):
        less = g[j : n + j] < best
        best[less] = g[j : n + j][less]
        at[less] = np.flatnonzero(less) + j
    return at, g


def keyed(docs: DataFrame, scratch: Scratch, *more: str) -> tuple[DataFrame, bool]:
    """doc_id, text, more and key: a number per distinct (doc_id, text) in order of doc_id, null first; and whether keys may repeat.

    Where doc_ids are unique they are the keys. Else distinct rows are sorted over all tasks and numbered.
    """
    d = only(docs, "doc_id", "text", *more)
    odd = d.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 OR doc_id IS NULL").limit(1).count()
    if not odd:
        return d.withColumn("key", F.col("doc_id").cast("long")), False
    d = d.withColumns({"a": F.xxhash64("text"), "b": F.xxhash64(F.lit(3), "text")})
    one = d.select("doc_id", "a", "b").distinct()
    order = scratch.write(one.repartitionByRange("doc_id", "a", "b").sortWithinPartitions("doc_id", "a", "b").withColumn("key", F.monotonically_increasing_id()), "keys")
    match = d["doc_id"].eqNullSafe(order["doc_id"]) & (d["a"] == order["a"]) & (d["b"] == order["b"])
    return d.join(order, match).select(d["doc_id"], "text", *more, "key"), True


def chain(h: np.ndarray, start: np.ndarray, prefix: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """For the suffixes at start: the hashes of their first ``prefix``, ``prefix`` + GROW, .. words and of the whole
    window, a column each, and a byte for each of the next words after the first ``prefix`` (SHOWN at most)."""
    steps = [*range(prefix, window, GROW), window]
    out, hashes, shown = np.zeros(len(start), np.uint64), [], np.zeros((len(start), SHOWN), np.uint8)
    for j in range(window):
        out = out * _P + h[start + j]
        if j + 1 in steps or prefix <= j < prefix + SHOWN:
            mixed = mix(out)
            if j + 1 in steps:
                hashes.append(mixed)
            if prefix <= j < min(prefix + SHOWN, window - 1):
                shown[:, j - prefix] = (mixed >> np.uint64(56)).astype(np.uint8)
    return np.stack(hashes, 1) if hashes else np.zeros((len(start), 0), np.uint64), shown


def common(group: np.ndarray, shown: np.ndarray, whole: np.ndarray, prefix: int, window: int) -> np.ndarray:
    """How many first words each suffix but the first shares with the one before it: 0 in another group, ``window`` at most."""
    differ = shown[1:] != shown[:-1]
    same = np.where(differ.any(1), differ.argmax(1), min(SHOWN, window - 1 - prefix))
    return np.where(group[1:] != group[:-1], 0, np.where(whole[1:] == whole[:-1], window, prefix + same))


def nodes(depth: np.ndarray, least: int) -> np.ndarray:
    """The number of each suffix's topmost node of at least that depth (itself, where it's alone), by common prefixes of neighbours."""
    return np.cumsum(np.concatenate(([True], depth < least))) - 1


def _packed(shown: np.ndarray) -> np.ndarray:
    """The bytes as one column that sorts like them, but for the sign."""
    return np.ascontiguousarray(shown).view(">i8").ravel().astype(np.int64)


def _unpacked(path: np.ndarray) -> np.ndarray:
    return path.astype(">i8").view(np.uint8).reshape(-1, SHOWN)


def hot_prefixes(hs: list[np.ndarray], window: int, prefix: int, hot: int = HOT) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(length, hashes, counts) of the prefixes that ``hot`` suffixes or more of some texts begin with, longer ones under hot ones only."""
    found, at = [], [np.arange(max(0, len(h) - window + 1)) for h in hs]
    for p in range(prefix, window, GROW):
        got = [grams(h, p)[a] if len(a) else np.zeros(0, np.uint64) for h, a in zip(hs, at, strict=True)]
        every = np.sort(np.concatenate(got)) if got else np.zeros(0, np.uint64)
        first = np.flatnonzero(np.concatenate(([True], every[1:] != every[:-1]))) if len(every) else np.zeros(0, np.int64)
        many = np.diff(np.append(first, len(every)))
        keys, counts = every[first][many >= hot], many[many >= hot]
        if not len(keys):
            break
        found.append((p, keys, counts))
        at = [a[keys[np.minimum(np.searchsorted(keys, x), len(keys) - 1)] == x] for a, x in zip(at, got, strict=True)]
    return found


def _texts(batch, column: int):
    """Each row's word hashes, for pieces of the batch of bounded size."""
    data, offsets = raw(batch.column(column))
    for a, b in parts(offsets):
        h, first = word_hashes(data, offsets[a : b + 1], lower=False)
        for i in range(a, b):
            yield i, h[first[i - a] : first[i - a + 1]]


def _portions(batches, made, size):
    """What made gives for each text of the batches, in lists of some PART words or suffixes, so memory doesn't follow a batch."""
    rows, n = [], 0
    for batch in batches:
        keys = np.asarray(batch.column(0))
        lists = batch.column(2) if batch.num_columns > 2 else None
        for i, h in _texts(batch, 1):
            x = made(lists[i] if lists is not None else None, keys[i], h)
            rows.append(x)
            n += size(x)
            if n >= PART:
                yield rows
                rows, n = [], 0
    if rows:
        yield rows


def _rows(*columns, names):
    return pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns], names=list(names))


def _repeated_samples(rows: DataFrame, window: int, prefix: int) -> DataFrame:
    """key, at: sampled positions whose prefix occurs more than once. And with a count instead of a null: hot prefixes, at being their length."""

    def sample(batches):
        names = ("h", "key", "at", "kind", "count")
        for rows in _portions(batches, lambda i, key, h: (key, h, *samples(h, window, prefix)), lambda x: len(x[1])):
            hs, ks, ps, texts = [], [], [], []
            for key, h, at, g in rows:
                if len(at):
                    at = at[np.concatenate(([True], at[1:] != at[:-1]))]
                    hs.append(g[at]), ks.append(np.full(len(at), key)), ps.append(at), texts.append(h)
            if not hs:
                continue
            h, k, p = np.concatenate(hs), np.concatenate(ks), np.concatenate(ps)
            order = np.argsort(h, kind="stable")
            h, k, p = h[order], k[order], p[order]
            new = np.concatenate(([True], h[1:] != h[:-1]))
            many = np.diff(np.append(np.flatnonzero(new), len(h)))
            kind = np.where(np.repeat(many, many) > 1, 2, 0).astype(np.int8)  # known to be repeated: only passed on
            told = np.flatnonzero(new)[many > 1]  # and one row to tell others
            h_out = np.where(kind == 2, mix(k.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + p.astype(np.uint64)), h)
            n = len(h) + len(told)
            yield _rows(np.concatenate((h_out, h[told])).view(np.int64), np.concatenate((k, k[told])), np.concatenate((p, p[told])).astype(np.int32), np.concatenate((kind, np.ones(len(told), np.int8))), pa.nulls(n, pa.int64()), names=names)
            for length, grown, counts in hot_prefixes(texts, window, prefix):
                yield _rows(grown.view(np.int64), grown.view(np.int64), np.full(len(grown), length, np.int32), np.full(len(grown), 2, np.int8), counts.astype(np.int64), names=names)

    def repeated(batches):
        """Sorted by h: a row is repeated if a neighbour has its prefix."""
        before, held = None, None
        for batch in batches:
            h, k, p, kind = (np.asarray(batch.column(i)) for i in range(4))
            done = kind == 2
            keep = ~done
            hh, kk, pp, kd = h[keep], k[keep], p[keep], kind[keep]
            out_k, out_p = [], []
            if len(hh):
                same = np.concatenate(([before is not None and hh[0] == before], hh[1:] == hh[:-1]))
                if held is not None and same[0] and held[2] == 0:
                    out_k.append(np.array([held[0]])), out_p.append(np.array([held[1]], np.int32))
                found = same.copy()
                found[:-1] |= same[1:]
                yes = found & (kd == 0)
                out_k.append(kk[yes]), out_p.append(pp[yes])
                before = hh[-1]
                held = None if found[-1] else (kk[-1], pp[-1], kd[-1])
            passed = batch.filter(pa.array(done))
            more = sum(map(len, out_k))
            yield _rows(
                np.concatenate([np.asarray(passed.column(1)), *out_k]),
                np.concatenate([np.asarray(passed.column(2)), *out_p]).astype(np.int32),
                pa.concat_arrays([passed.column(4), pa.nulls(more, pa.int64())]),
                names=("key", "at", "count"),
            )

    sent = rows.mapInArrow(sample, "h long, key long, at int, kind byte, count long")
    parted = sent.repartition("h").sortWithinPartitions("h")
    return parted.mapInArrow(repeated, "key long, at int, count long")


def _growing(found: DataFrame) -> dict[int, np.ndarray]:
    """By length the sorted hashes of the prefixes that grow: the most frequent ones, GROWN at most. They only even out groups."""
    hot = found.where("count IS NOT NULL").groupBy("key", "at").agg(F.sum("count").alias("n")).orderBy(F.desc("n"), "key", "at").limit(GROWN).collect()
    lengths = {r["at"] for r in hot}
    return {p: np.sort(np.array([r["key"] for r in hot if r["at"] == p], np.int64).view(np.uint64)) for p in lengths}


def grouped(hashes: np.ndarray, growing: dict[int, np.ndarray], prefix: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each suffix's group and the length of its prefix; hashes as chain() gives them."""
    steps = [*range(prefix, window, GROW), window]
    group, length = hashes[:, 0].copy(), np.full(len(hashes), steps[0])
    going = np.arange(len(hashes))
    for i, p in enumerate(steps[:-1]):
        hot = growing.get(p)
        if hot is None or not len(going):
            break
        x = hashes[going, i]
        going = going[hot[np.minimum(np.searchsorted(hot, x), len(hot) - 1)] == x]
        group[going], length[going] = hashes[going, i + 1], steps[i + 1]
    return (mix(group ^ length.astype(np.uint64)) >> np.uint64(32)).astype(np.uint32), length


def _attach(rows: DataFrame, side: DataFrame, column: str) -> tuple[DataFrame, DataFrame | None]:
    """rows with side's column, by key, and the rows that side doesn't have. While side's keys are few, texts without a match don't move."""
    if small(side, BROADCAST_ROWS):
        keys = F.broadcast(side.select("key"))
        return rows.join(keys, "key", "left_semi").join(side.hint("merge"), "key"), rows.join(keys, "key", "left_anti")
    return rows.join(side.hint("merge"), "key", "left"), None


def _later_windows(rows: DataFrame, window: int, prefix: int, growing: dict[int, np.ndarray]) -> DataFrame:
    """key, starts (packed): windows whose words also start earlier. rows: key, text, at."""
    columns = ("group", "path", "whole", "key", "start")

    def own(sampled, key, h):
        """The key, group, path, hash and start of each suffix of a text that a sample asks for."""
        at, _ = samples(h, window, prefix)
        if not len(at) or not sampled.is_valid:
            return key, *(np.zeros(0, k) for k in (np.uint32, np.int64, np.uint64, np.int32))
        start = np.flatnonzero(np.isin(at, sampled.values.to_numpy()))
        hashes, shown = chain(h, start, prefix, window)
        return key, grouped(hashes, growing, prefix, window)[0], _packed(shown), hashes[:, -1].copy(), start.astype(np.int32)

    def suffixes(batches):
        for rows in _portions(batches, own, lambda x: len(x[4])):
            group, path, whole, s = (np.concatenate([x[i] for x in rows]) for i in range(1, 5))
            if not len(s):
                continue
            k = np.repeat(np.array([x[0] for x in rows], np.int64), [len(x[4]) for x in rows])
            rows.clear()
            order = np.lexsort((s, k, whole))
            first = np.concatenate(([True], whole[order[1:]] != whole[order[:-1]]))
            late_k, late_s = k[order][~first], s[order][~first].astype("<i4")
            sent = order[first]
            order = np.argsort(late_k, kind="stable")
            late_k, late_s = late_k[order], late_s[order]
            cut = np.flatnonzero(np.concatenate(([True], late_k[1:] != late_k[:-1]))) if len(late_k) else np.zeros(0, np.int64)
            known = [x.tobytes() for x in np.split(late_s, cut[1:])] if len(cut) else []
            owners = late_k[cut]
            n, m = len(sent), len(owners)
            group, path = group[sent], path[sent]
            nothing = np.zeros(m, np.int64)
            yield _rows(
                np.concatenate((group, (mix(owners.astype(np.uint64)) >> np.uint64(32)).astype(np.uint32))).view(np.int32),
                np.concatenate((path, nothing)),
                np.concatenate((whole[sent].view(np.int64), nothing)),
                np.concatenate((k[sent], owners)),
                np.concatenate((s[sent], np.full(m, -1))).astype(np.int32),
                pa.array([None] * n + known, pa.binary()),
                names=(*columns, "known"),
            )

    def later(batches):
        """Sorted: of the suffixes under a node of the window's depth all but the first are later."""
        before = None
        for batch in batches:
            s = np.asarray(batch.column(4))
            real, packed = np.flatnonzero(s >= 0), np.flatnonzero(s < 0)
            g, p, w, k, s = (np.asarray(batch.column(i))[real] for i in range(5))
            hit = np.zeros(len(real), bool)
            if len(real):
                row = (g[-1:], p[-1:], w[-1:])
                g, p, w = (x if before is None else np.concatenate((y, x)) for x, y in zip((g, p, w), before or row, strict=True))
                node = nodes(common(g, _unpacked(p), w, prefix, window), window)
                again = np.concatenate(([False], node[1:] == node[:-1]))
                hit, before = again[len(again) - len(real) :], row
            kk, st = k[hit], s[hit].astype("<i4")
            order = np.lexsort((st, kk))
            kk, st = kk[order], st[order]
            cut = np.flatnonzero(np.concatenate(([True], kk[1:] != kk[:-1]))) if len(kk) else np.zeros(0, np.int64)
            made = [x.tobytes() for x in np.split(st, cut[1:])] if len(cut) else []
            yield _rows(np.concatenate((np.asarray(batch.column(3))[packed], kk[cut])), pa.array(batch.column(5).take(pa.array(packed)).to_pylist() + made, pa.binary()), names=("key", "starts"))

    sent = rows.mapInArrow(suffixes, "group int, path long, whole long, key long, start int, known binary")
    return sent.repartition("group").sortWithinPartitions(*columns).mapInArrow(later, "key long, starts binary")


def covered(n: int, starts: np.ndarray, window: int) -> np.ndarray:
    """Which of n words lie in a window that begins at one of starts."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + window, n), -1)
    return np.cumsum(edge[:-1]) > 0


def spans(mask: np.ndarray) -> list[dict]:
    """Maximal runs of covered words, as first word and the word after the last."""
    edge = np.flatnonzero(np.diff(np.concatenate(([False], mask, [False])).astype(np.int8)))
    return [{"first": int(a), "end": int(b)} for a, b in edge.reshape(-1, 2)]


def later_starts(docs: DataFrame, scratch: Scratch, window: int = WINDOW, prefix: int = PREFIX) -> tuple[DataFrame, DataFrame]:
    """The keyed documents, and key, starts: per document the windows that also start earlier, packed."""
    prefix = min(prefix, window)
    rows, odd = keyed(docs, scratch)
    one = rows.select("key", "text")
    if odd:  # repeated rows are one document, so that none comes before itself
        one = scratch.write(one.groupBy("key").agg(F.first("text").alias("text")), "one")
    found = scratch.write(_repeated_samples(one, window, prefix), "samples")
    scratch.release()
    growing = _growing(found)
    lists = scratch.write(found.where("count IS NULL").groupBy("key").agg(F.array_sort(F.collect_set("at")).alias("at")), "lists")
    scratch.drop("samples")
    some, _ = _attach(one, lists, "at")
    late = _later_windows(some.select("key", "text", "at"), window, prefix, growing)
    flat = scratch.write(late, "late")
    scratch.release()
    packed = scratch.write(flat.groupBy("key").agg(F.collect_list("starts").alias("starts")), "packed")
    scratch.drop("late")
    scratch.drop("lists")
    if odd:
        scratch.drop("one")
    scratch.release()
    return rows, packed


def _final(docs: DataFrame, run, schema: str, window: int, prefix: int) -> DataFrame:
    scratch = Scratch(docs.sparkSession, "substrings")
    rows, packed = later_starts(docs, scratch, window, prefix)
    hit, miss = _attach(rows, packed, "starts")
    hit = hit.select("doc_id", "text", "starts")
    if miss is not None:
        return hit.mapInArrow(run, schema).unionByName(miss.select("doc_id", "text", F.lit(None).cast("array<binary>").alias("starts")).mapInArrow(run, schema))
    return hit.mapInArrow(run, schema)


def _each(batches, window: int):
    """Per row its words as bytes, and which of them go."""
    for batch in batches:
        data, offsets = raw(batch.column(1))
        view, lists, rows = memoryview(data) if len(data) else memoryview(b""), batch.column(2), []
        for i in range(batch.num_rows):
            words = bytes(view[offsets[i] : offsets[i + 1]]).split()
            mask = None
            if lists[i].is_valid:
                starts = np.frombuffer(b"".join(lists[i].as_py()), "<i4").astype(np.int64)
                mask = covered(len(words), starts, window)
            rows.append((words, mask))
        yield batch, rows


def dedup(docs: DataFrame, window: int = WINDOW, prefix: int = PREFIX) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for every row of docs: words in a window that also starts earlier go.

    Earlier means a smaller doc_id, or the same text and an earlier start; windows are judged on the input. Null
    and empty texts and those with fewer than ``window`` words keep all they have. A null doc_id comes before all
    others. Repeated rows (same doc_id and text) are one document, and each gets its result; rows with one doc_id
    and different texts are in order of a hash of the text. Empty table: empty result. Other columns aren't read.
    """
    import hashlib

    def run(batches):
        for batch, rows in _each(batches, window):
            kept = [w if m is None else [x for x, gone in zip(w, m.tolist(), strict=True) if not gone] for w, m in rows]
            yield _rows(
                batch.column(0),
                pa.array([len(w) for w, _ in rows], pa.int64()),
                pa.array([len(w) - len(k) for (w, _), k in zip(rows, kept, strict=True)], pa.int64()),
                pa.array([hashlib.sha256(b" ".join(k)).hexdigest() for k in kept], pa.string()),
                names=("doc_id", "n_words", "n_removed", "kept_sha256"),
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return _final(docs, run, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string", window, prefix)


def cleaned(docs: DataFrame, window: int = WINDOW, prefix: int = PREFIX) -> DataFrame:
    """doc_id, the text that is left (words joined by a blank) and the maximal repeats that went, as word spans."""

    def run(batches):
        kind = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))
        for batch, rows in _each(batches, window):
            texts = [b" ".join(w if m is None else [x for x, gone in zip(w, m.tolist(), strict=True) if not gone]).decode() for w, m in rows]
            yield _rows(batch.column(0), pa.array(texts, pa.string()), pa.array([[] if m is None else spans(m) for _, m in rows], kind), names=("doc_id", "text", "repeats"))

    kind = docs.schema["doc_id"].dataType.simpleString()
    return _final(docs, run, f"doc_id {kind}, text string, repeats array<struct<first:int,end:int>>", window, prefix)


def sql(window: int = WINDOW) -> str:
    """The same removal for DuckDB: windows as texts, numbered in order of document and start."""
    return f"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents
), p AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d
), g AS (
  SELECT doc_id, unnest(range(1, len(w) - {window} + 2)) AS i,
         unnest(list_transform(range(1, len(w) - {window} + 2), lambda i: array_to_string(w[i:i + {window - 1}], ' '))) AS gram
  FROM d WHERE len(w) >= {window}
), again AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY gram ORDER BY doc_id NULLS FIRST, i) > 1 AS again FROM g
), marked AS (
  SELECT p.doc_id, p.i, p.word,
         coalesce(bool_or(again) OVER (PARTITION BY p.doc_id ORDER BY p.i ROWS BETWEEN {window - 1} PRECEDING AND CURRENT ROW), false) AS gone
  FROM p LEFT JOIN again ON p.doc_id IS NOT DISTINCT FROM again.doc_id AND p.i = again.i
), kept AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY i) FILTER (NOT gone), '') AS kept FROM marked GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id IS NOT DISTINCT FROM kept.doc_id"""
