"""N-gram Jaccard join with adaptive multi-match prefixes.

Shingles are 64-bit hashes in ascending order, which is the same order everywhere. With threshold t, a set of n
shingles has to share at least ceil(t n) with a partner, so the first n - ceil(t n) + l shingles of either hold at
least l common ones, for any l. A longer prefix therefore allows to ask for more matches before anything is
compared:

1. Every set gives its prefix for l = 1 + SHARES[0] n. A shingle that HOT sets or more have is hot: it makes no pairs,
   as they would cost most, and is only counted for those who have it. For a pair the set with the smaller l
   decides: l less its hot shingles are the shared ones it must have; pairs below that are no candidates.
2. A set with too many hot shingles for its l is costly. The share of hot ones in its prefix estimates how many a
   longer prefix has, and with that the length at which enough cold ones are left to ask for. Costly sets meet again
   with longer prefixes and larger l, up to the whole set, until they aren't costly any more, at those lengths that
   by the estimates of all sets send the fewest shingles in total. Of two sets one at least has to be done for the pair to be found, so whoever
   isn't done takes part.
3. What even as a whole set consists of hot shingles by t or more (large groups of near copies) is grouped by its own
   shingles; each batch of sets joins those that share one first, and tells one of them per shingle.

Candidates of all three form groups, and groups are verified exactly on whole sets. With more data chance candidates
connect ever more sets, so a large group is taken apart again: its candidate pairs of steps 1 and 2, whose number is in
proportion to the shingles sent, are judged one by one, and what step 3 connects forms groups of its own. Large ones of
these are compared with one member first, which leaves few of a group of near copies; only these meet all others, in
blocks of bounded size. A task returns stars, not pairs. Sets with equal content are one set throughout.
"""

from __future__ import annotations

import itertools
import string

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, join_checked, parts, raw
from .connected import components, merge_labels
from .substring_dedup import keyed
from .words import mix, shingle_set, word_hashes

SHINGLE, HOT, SHARES, BLOCK, WIDE, HELD, HUB_BYTES = 5, 32, (0.04, 0.2, 0.5), 128, 1024, 1 << 20, 1 << 25
_KIND = 40
POSTING, TOLD, COUNTED = 0, 1, 2


def need(n):
    """ceil(0.75 n) in integers."""
    return (3 * n + 3) // 4


def slack(n, share):
    """The matches asked of a set whose prefix is lengthened by a share of it."""
    return 1 + (n * round(share * 100)) // 100


def prefix(n, share):
    """How long that prefix is; without a share it's the whole set."""
    return n if share is None else n - need(n) + min(need(n), slack(n, share))


def set_key(h: np.ndarray) -> int:
    """A 64-bit name for a set of shingles."""
    mixed = mix(h)
    return int(mix(np.array([mixed.sum() + np.uint64(len(h)), np.bitwise_xor.reduce(mixed)], np.uint64)).view(np.int64).sum()) if len(h) else 0


def _sets(batch, column: int):
    data, offsets = raw(batch.column(column))
    for a, b in parts(offsets):
        h, first = word_hashes(data, offsets[a : b + 1], lower=True)
        for i in range(a, b):
            yield i, shingle_set(h[first[i - a] : first[i - a + 1]], SHINGLE)


def _batch(*columns, names):
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=list(names))


def nodes(rows: DataFrame) -> DataFrame:
    """doc_id, key, fp, n of every row: its set's name and size."""

    def run(batches):
        for batch in batches:
            fp, n = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for i, h in _sets(batch, 2):
                fp[i], n[i] = set_key(h), len(h)
            yield _batch(batch.column(0), batch.column(1), fp, n, names=("doc_id", "key", "fp", "n"))

    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), "key", "text").mapInArrow(run, "doc_id long, key long, fp long, n long")


def _post(sets) -> pa.RecordBatch | None:
    """Postings (token, fp, meta) of (fp, n, tokens), each set once; tokens hot in this batch alone are told once."""
    fps, ns, tokens = [], [], []
    for fp, n, t in sets:
        fps.append(fp), ns.append(n), tokens.append(t)
    if not fps:
        return None
    size = np.array([len(t) for t in tokens])
    owner = np.repeat(np.arange(len(fps)), size)
    t, fps, ns = np.concatenate(tokens), np.array(fps, np.int64), np.array(ns, np.int64)
    order = np.argsort(t, kind="stable")
    t, owner = t[order], owner[order]
    first = np.flatnonzero(np.concatenate(([True], t[1:] != t[:-1])))
    many = np.diff(np.append(first, len(t)))
    hot = np.repeat(many >= HOT, many)
    told = t[first[many >= HOT]]
    count = np.bincount(owner[hot], minlength=len(fps))
    counted = np.flatnonzero(count)
    t, owner = t[~hot], owner[~hot]
    return _batch(
        np.concatenate((t, told, mix(fps[counted].view(np.uint64)))).view(np.int64),
        np.concatenate((fps[owner], np.zeros(len(told), np.int64), fps[counted])),
        np.concatenate((ns[owner] | POSTING << _KIND, np.full(len(told), TOLD << _KIND), count[counted] | COUNTED << _KIND)),
        names=("token", "fp", "meta"),
    )


def _pairs(fp: np.ndarray, n: np.ndarray, first: np.ndarray, many: np.ndarray):
    """All pairs inside runs of fewer than HOT sets whose sizes allow the threshold."""
    out = []
    for c in np.unique(many):
        if 2 <= c < HOT:
            at = first[many == c][:, None] + np.arange(c)
            i, j = np.triu_indices(c, 1)
            a, b = at[:, i].ravel(), at[:, j].ravel()
            small, large = np.minimum(n[a], n[b]), np.maximum(n[a], n[b])
            ok = 4 * small >= 3 * large
            out.append((a[ok], b[ok]))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([x for x, _ in out]), np.concatenate([x for _, x in out])


def _meet(batches):
    """Sorted by token and set: (a, b, na, nb, c) for pairs that share c cold tokens, and (a, null, .., c) for c hot ones of a."""
    names = ("a", "b", "na", "nb", "c")
    held = (np.zeros(0, np.int64),) * 3
    hot_token = None

    def pack(fp, n, a, b, hot_fp, hot_c):
        x, y = fp[a], fp[b]
        swap = x > y
        x, y, nx, ny = np.where(swap, y, x), np.where(swap, x, y), np.where(swap, n[b], n[a]), np.where(swap, n[a], n[b])
        order = np.lexsort((y, x))
        x, y, nx, ny = x[order], y[order], nx[order], ny[order]
        cut = np.flatnonzero(np.concatenate(([True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])))) if len(x) else np.zeros(0, np.int64)
        c = np.diff(np.append(cut, len(x)))
        k = len(hot_fp)
        nothing = pa.nulls(k, pa.int64())
        return _batch(
            np.concatenate((x[cut], hot_fp)),
            pa.concat_arrays([pa.array(y[cut]), nothing]),
            pa.concat_arrays([pa.array(nx[cut]), nothing]),
            pa.concat_arrays([pa.array(ny[cut]), nothing]),
            np.concatenate((c, hot_c)).astype(np.int64),
            names=names,
        )

    def work(t, fp, meta, final):
        nonlocal held, hot_token
        kind, n = meta >> _KIND, meta & ((1 << _KIND) - 1)
        own = kind == COUNTED
        hot_fp, hot_c = [fp[own]], [n[own]]
        keep = ~own
        t, fp, kind, n = t[keep], fp[keep], kind[keep], n[keep]
        if hot_token is not None and len(t):
            more = (t == hot_token) & (kind == POSTING)
            hot_fp.append(fp[more]), hot_c.append(np.ones(int(more.sum()), np.int64))
            rest = t != hot_token
            t, fp, kind, n = t[rest], fp[rest], kind[rest], n[rest]
            if len(t):
                hot_token = None
        if len(t):
            once = np.concatenate(([True], (t[1:] != t[:-1]) | (fp[1:] != fp[:-1]) | (kind[1:] != kind[:-1])))
            t, fp, kind, n = t[once], fp[once], kind[once], n[once]
            first = np.flatnonzero(np.concatenate(([True], t[1:] != t[:-1])))
            many = np.diff(np.append(first, len(t)))
            burning = (many >= HOT) | (np.maximum.reduceat(kind, first) == TOLD)
            last_held = not final and not burning[-1]
            if not final and burning[-1]:
                hot_token = t[-1]
            if last_held:
                k = first[-1]
                held = (t[k:], fp[k:], (kind[k:] << _KIND) | n[k:])
                first, many, burning = first[:-1], many[:-1], burning[:-1]
                stop = k
            else:
                held, stop = (np.zeros(0, np.int64),) * 3, len(t)
            lit = np.repeat(burning, many) & (kind[:stop] == POSTING)
            hot_fp.append(fp[:stop][lit]), hot_c.append(np.ones(int(lit.sum()), np.int64))
            a, b = _pairs(fp, n, first[~burning], many[~burning])
        else:
            held = (np.zeros(0, np.int64),) * 3
            a = b = np.zeros(0, np.int64)
        all_fp, all_c = np.concatenate(hot_fp), np.concatenate(hot_c)
        names_, at = np.unique(all_fp, return_inverse=True)
        return pack(fp, n, a, b, names_, np.bincount(at, all_c, len(names_)).astype(np.int64) if len(all_fp) else all_c)

    for batch in batches:
        t, fp, meta = (np.asarray(batch.column(i)) for i in range(3))
        yield work(np.concatenate((held[0], t)), np.concatenate((held[1], fp)), np.concatenate((held[2], meta)), False)
    yield work(*held, True)


def _meetings(posted: DataFrame, scratch: Scratch, name: str) -> tuple[DataFrame, DataFrame]:
    """Pairs with their shared cold tokens, and each set's number of hot ones (an upper bound, where its copies are in several batches)."""
    dealt = posted.repartition("token").sortWithinPartitions("token", "fp", "meta")
    met = scratch.write(dealt.mapInArrow(_meet, "a long, b long, na long, nb long, c long"), name)
    pairs = met.where("b IS NOT NULL").groupBy("a", "b", "na", "nb").agg(F.sum("c").alias("c"))
    hot = met.where("b IS NULL").groupBy(F.col("a").alias("fp")).agg(F.sum("c").alias("hot"))
    return pairs, hot


def _with_hot(pairs: DataFrame, hot: DataFrame) -> DataFrame:
    for side in ("a", "b"):
        pairs = join_checked(pairs, hot.select(F.col("fp").alias(side), F.col("hot").alias(f"h{side}")), side, "left")
    return pairs.withColumns({f"h{s}": F.coalesce(f"h{s}", F.lit(0)) for s in "ab"})


def _slack(n: Column, share: float) -> Column:
    return 1 + F.floor(n * round(share * 100) / 100)


def _length(n: Column, share: float | None) -> Column:
    least = F.ceil(n * 0.75)
    return n if share is None else n - least + F.least(least, _slack(n, share))


def _text_postings(rows: DataFrame, share: float) -> DataFrame:
    def run(batches):
        for batch in batches:
            seen: dict = {}
            for _, h in _sets(batch, 0):
                n = len(h)
                if n:
                    fp = set_key(h)
                    if fp not in seen:
                        seen[fp] = (fp, n, h[: prefix(n, share)].copy())
            made = _post(seen.values())
            if made is not None:
                yield made

    return rows.select("text").mapInArrow(run, "token long, fp long, meta long")


def _set_postings(sets: DataFrame, share: float | None) -> DataFrame:
    def run(batches):
        for batch in batches:
            fps, ns = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            made = _post((fp, n, np.frombuffer(x, np.uint64)[: prefix(n, share)]) for fp, n, x in zip(fps, ns, batch.column(2).to_pylist(), strict=True))
            if made is not None:
                yield made

    return sets.select("fp", "n", "tokens").mapInArrow(run, "token long, fp long, meta long")


def _candidates(pairs: DataFrame, hot: DataFrame, share: float | None) -> DataFrame:
    """a, b of the pairs that share enough: what l asks for, or without a share the whole overlap, less hot shingles."""
    found = _with_hot(pairs, hot)
    if share is None:
        return found.where(7 * (F.col("c") + F.least("ha", "hb")) >= 3 * (F.col("na") + F.col("nb"))).select("a", "b")
    la, lb = (_slack(F.col(n), share) for n in ("na", "nb"))
    must = F.when(la < lb, la - F.col("ha")).when(lb < la, lb - F.col("hb")).otherwise(la - F.least("ha", "hb"))
    return found.where(F.col("c") >= must).select("a", "b")


def _costly(share: float) -> Column:
    """Whether hot shingles may leave nothing to ask for, for a partner of any size that the threshold allows."""
    return F.coalesce(F.col("hot"), F.lit(0)) >= _slack(F.col("n") * 0.75, share)


def estimate(shares: tuple[float, ...], now: float) -> Column:
    """The place in shares of the least one at which a set (n, hot in the prefix of share now) should be done, or their number.

    A longer prefix is taken to have the share of hot shingles that the present one has, and a quarter more.
    """
    rate = F.col("hot") / _length(F.col("n"), now)
    out = F.lit(len(shares))
    for i, share in reversed(list(enumerate(shares))):
        out = F.when(1.25 * rate * _length(F.col("n"), share) < _slack(F.col("n") * 0.75, share), i).otherwise(out)
    return out


def cheapest(sums: dict[int, list[int]], shares: int) -> list[int]:
    """Which of some lengths costly sets should meet at, so that fewest shingles are sent; the whole set comes after all.

    sums: for the sets that should be done at a length (or at none: ``shares``), their shingles at each, and as whole sets.
    """

    def cost(chosen: tuple[int, ...]) -> int:
        total = 0
        for k, row in sums.items():
            ends = next((j for j in chosen if j >= k), shares)
            total += sum(row[j] for j in (*chosen, shares) if j <= ends)
        return total

    every = [c for n in range(shares + 1) for c in itertools.combinations(range(shares), n)]
    return list(min(every, key=lambda c: (cost(c), len(c))))


def _hub_edges(sets: DataFrame, scratch: Scratch) -> DataFrame:
    """fp, hub: edges that connect all sets which share one of their first n - ceil(t n) + 1 shingles.

    Inside a batch they are stars; a shingle leaves a batch once, with one set that stands for all who have it there.
    """

    def run(batches):
        for batch in batches:
            fps = np.asarray(batch.column(0))
            tokens = [np.frombuffer(x, np.int64)[: n - need(n) + 1] for n, x in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            if not tokens:
                continue
            t, owner = np.concatenate(tokens), np.repeat(np.arange(len(fps)), [len(x) for x in tokens])
            order = np.argsort(t, kind="stable")
            t, owner = t[order], owner[order]
            same = np.flatnonzero(t[1:] == t[:-1])
            parent = np.arange(len(fps))
            merge_labels(parent, owner[same], owner[same + 1])
            first = np.concatenate(([True], t[1:] != t[:-1]))
            out = np.flatnonzero(parent != np.arange(len(fps)))
            yield _batch(
                pa.concat_arrays([pa.nulls(len(out), pa.int64()), pa.array(t[first])]),
                np.concatenate((fps[out], fps[parent[owner[first]]])),
                pa.concat_arrays([pa.array(fps[parent[out]]), pa.nulls(int(first.sum()), pa.int64())]),
                names=("token", "fp", "hub"),
            )

    told = scratch.write(sets.select("fp", "n", "tokens").mapInArrow(run, "token long, fp long, hub long"), "told")
    posted = told.where("token IS NOT NULL").select("token", "fp")
    hub = posted.groupBy("token").agg(F.min("fp").alias("hub"), F.max("fp").alias("other")).where("hub <> other").select("token", "hub")
    across = posted.join(hub, "token").where("fp <> hub").select("fp", "hub")
    return told.where("hub IS NOT NULL").select("fp", "hub").unionByName(across).distinct()


def overlaps(tokens: list[np.ndarray]) -> np.ndarray:
    """How many elements each two of some sets share."""
    m = len(tokens)
    out = np.zeros((m, m), np.int64)
    t = np.concatenate(tokens)
    owner = np.repeat(np.arange(m), [len(x) for x in tokens])
    order = np.argsort(t, kind="stable")
    t, owner = t[order], owner[order]
    first = np.flatnonzero(np.concatenate(([True], t[1:] != t[:-1])))
    many = np.diff(np.append(first, len(t)))
    for c in range(2, 17):
        at = owner[first[many == c][:, None] + np.arange(c)]
        if len(at):
            i, j = np.triu_indices(c, 1)
            pair, count = np.unique(at[:, i].ravel() * m + at[:, j].ravel(), return_counts=True)
            out[pair // m, pair % m] += count
    frequent = np.flatnonzero(many > 16)
    for s in range(0, len(frequent), 4096):
        part = frequent[s : s + 4096]
        at = np.concatenate([np.arange(first[k], first[k] + many[k]) for k in part])
        x = np.zeros((len(part), m), np.float32)
        x[np.repeat(np.arange(len(part)), many[part]), owner[at]] = 1
        out += (x.T @ x).round().astype(np.int64)
    return np.maximum(out, out.T)


def verified(fps: np.ndarray, tokens: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Stars (set, smallest set) over the sets that links, exactly judged, connect."""
    n = np.array([len(x) for x in tokens])
    a, b = np.nonzero(np.triu(7 * overlaps(tokens) >= 3 * (n[:, None] + n[None, :]), 1))
    parent = np.arange(len(fps))
    merge_labels(parent, a, b)
    out = np.flatnonzero(parent != np.arange(len(fps)))
    return fps[out], fps[parent[out]]


def links(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets, sorted and not empty, link."""
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return 7 * int((b[at] == a).sum()) >= 3 * (len(a) + len(b))


def _to_hub(sets: DataFrame, member: DataFrame, scratch: Scratch) -> DataFrame:
    """fp, root, m, n, linked for the members of large groups: the set's size, and whether it links with the group's smallest one."""
    hubs = sets.join(member.where("fp = root").select("fp").hint("merge"), "fp").select(F.col("fp").alias("root"), F.col("tokens").alias("hub"))
    hubs = scratch.write(hubs, "hubs")
    rows = sets.join(member.hint("merge"), "fp")
    few = (hubs.agg(F.sum(F.octet_length("hub"))).first()[0] or 0) <= HUB_BYTES
    rows = rows.join(F.broadcast(hubs), "root") if few else rows.join(hubs.hint("merge"), "root")

    def run(batches):
        for batch in batches:
            linked, n = np.zeros(batch.num_rows, bool), np.zeros(batch.num_rows, np.int64)
            for i, (x, y) in enumerate(zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True)):
                a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                linked[i], n[i] = links(a, b), len(a)
            yield _batch(*batch.columns[:3], n, linked, names=("fp", "root", "m", "n", "linked"))

    return scratch.write(rows.select("fp", "root", "m", "tokens", "hub").mapInArrow(run, "fp long, root long, m long, n long, linked boolean"), "judged")


def _judged_pairs(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """fp, other: those of the pairs (a, b) that link, exactly judged."""
    one, two = (sets.select(F.col("fp").alias(c), F.col("tokens").alias(f"t{c}")).hint("merge") for c in ("a", "b"))
    rows = pairs.join(one, "a").join(two, "b")

    def run(batches):
        for batch in batches:
            found = [links(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            at = pa.array(np.flatnonzero(found))
            yield _batch(batch.column(0).take(at), batch.column(1).take(at), names=("fp", "other"))

    return rows.select("a", "b", "ta", "tb").mapInArrow(run, "fp long, other long")


def _sized(groups: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """fp, root, m of groups (node, root) that have m members."""
    size = scratch.write(groups.groupBy("root").agg(F.count("*").alias("m")), f"{name}size")
    return scratch.write(join_checked(groups.withColumnRenamed("node", "fp"), size, "root", "inner"), f"{name}members")


def _cells(judged: DataFrame) -> DataFrame:
    """fp, root, i, j: the cells in which each set that doesn't link with its group's smallest one meets the whole group."""

    def blocks(sets, shingles):
        return F.greatest(F.ceil(sets / WIDE), F.ceil(shingles / HELD))

    zero, other = F.lit(0).cast("long"), F.when(~F.col("linked"), F.col("n"))
    counts = judged.groupBy("root").agg(blocks(F.count(other), F.coalesce(F.sum(other), F.lit(0))).alias("r"), blocks(F.count("*"), F.sum("n")).alias("k"))
    rows = join_checked(judged, counts.where("r > 0"), "root", "inner").withColumn("h", F.xxhash64("fp"))
    near = rows.select("fp", "root", F.explode(F.sequence(zero, F.col("r") - 1)).alias("i"), F.pmod("h", "k").alias("j"))
    far = rows.where("NOT linked").select("fp", "root", F.pmod("h", "r").alias("i"), F.explode(F.sequence(zero, F.col("k") - 1)).alias("j"))
    return near.unionByName(far).distinct()


def _verify(sets: DataFrame, pairs: DataFrame, hubs: DataFrame, scratch: Scratch) -> DataFrame:
    """fp, other: links that connect what is connected among candidates: pairs (a, b), and groups that hubs (fp, hub) connect.

    Together they form groups. One of BLOCK sets at most is one cell. Of a larger one the pairs are judged one by one,
    and the hubs' own groups follow, the small ones again as cells. Of a large one the members that link with the
    smallest set are connected by that; the others meet the whole group, block by block. So a member has as many
    copies as there are blocks of others: none in a group around its smallest set. A block has WIDE sets at most, and
    about HELD shingles.
    """
    zero = F.lit(0).cast("long")

    def whole(member):
        return member.where(F.col("m") <= BLOCK).select("fp", "root", zero.alias("i"), zero.alias("j"))

    groups = scratch.write(components(pairs.union(hubs), scratch, "groups").distinct(), "grouped")
    member = _sized(groups, scratch, "")
    cells, stars = whole(member), None
    if member.where(F.col("m") > BLOCK).limit(1).count():
        large = scratch.write(member.where(F.col("m") > BLOCK).select("fp"), "large")
        stars = _judged_pairs(sets, join_checked(pairs.distinct(), large.withColumnRenamed("fp", "a"), "a", "left_semi"))
        own = components(join_checked(hubs, large, "fp", "left_semi"), scratch, "hubbed").distinct()
        member = _sized(own, scratch, "hub")
        cells = cells.unionByName(whole(member))
        judged = _to_hub(sets, member.where(F.col("m") > BLOCK), scratch)
        # pairs and cells each shuffle whole sets, so the ones are done before the others
        stars = scratch.write(stars, "stars").unionByName(judged.where("linked AND fp <> root").select("fp", F.col("root").alias("other")))
        cells = cells.unionByName(_cells(judged))
    rows = sets.join(cells.hint("merge"), "fp").select("root", "i", "j", "fp", "tokens")

    def run(batches):
        key, fps, tokens = None, [], []

        def close():
            x, y = verified(np.array(fps, np.int64), tokens) if len(fps) > 1 else (np.zeros(0, np.int64),) * 2
            return _batch(x, y, names=("fp", "other"))

        for batch in batches:
            for root, i, j, fp, x in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                if (root, i, j) != key:
                    if len(fps) > 1:
                        yield close()
                    key, fps, tokens = (root, i, j), [], []
                fps.append(fp), tokens.append(np.frombuffer(x, np.uint64))
        yield close()

    found = rows.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j").mapInArrow(run, "fp long, other long")
    return found if stars is None else found.unionByName(stars)


def join(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of docs.

    Words are what lies between blanks, A-Z lower-cased; a set holds the distinct runs of five, or the whole
    sequence where there are fewer. Null and empty texts and those without words have an empty set, link with
    nothing and are their own component. Repeated rows and equal texts link. component_id is the smallest doc_id
    that isn't null in the component; a null doc_id otherwise links like any other. Empty table: empty result.
    Columns other than doc_id and text aren't read.
    """
    scratch = Scratch(docs.sparkSession, "ngrams")
    rows, _ = keyed(docs, scratch)
    named = _rooted(rows, scratch)
    named = scratch.write(named, "named")
    # as a table, so that Spark can split a large component's rows in the join
    lowest = scratch.write(named.where("n > 0").groupBy("root").agg(F.min("doc_id").alias("lowest")), "lowest")
    out = named.join(lowest.hint("merge"), "root", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("lowest")).otherwise(F.col("doc_id")).alias("component_id"))


def _rooted(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """nodes() of keyed rows, and the root of each one's component; rows without words have one root, which means nothing."""
    node = scratch.write(nodes(rows), "nodes")
    # step 1
    pairs, hot = _meetings(_text_postings(rows, SHARES[0]), scratch, "met0")
    scratch.release()
    hot = scratch.write(hot, "hot0")
    edges = scratch.write(_candidates(pairs, hot, SHARES[0]), "edges0")
    scratch.drop("met0")
    # the sets that later steps need
    one = node.where("n > 0").groupBy("fp", "n").agg(F.min("key").alias("key"))
    paired = edges.select(F.col("a").alias("fp")).unionByName(edges.select(F.col("b").alias("fp"))).distinct()
    wanted = one.join(paired.unionByName(hot.select("fp")).distinct(), "fp").join(hot, "fp", "left").withColumn("costly", _costly(SHARES[0]))
    wanted = wanted.join(paired.withColumn("paired", F.lit(True)), "fp", "left").where("costly OR paired")
    wanted = scratch.write(wanted.select("key", "fp", "n", "costly", F.when(F.col("costly"), estimate(SHARES[1:], SHARES[0])).alias("step")), "wanted")
    lengths = [F.sum(_length(F.col("n"), share)).alias(str(i)) for i, share in enumerate((*SHARES[1:], None))]
    useful = cheapest({r[0]: list(r[1:]) for r in wanted.where("costly").groupBy("step").agg(*lengths).collect()}, len(SHARES) - 1)  # a row a share

    def collect(batches):
        for batch in batches:
            made = [None] * batch.num_rows
            for i, h in _sets(batch, 0):
                made[i] = h.tobytes()
            yield _batch(*(batch.column(k) for k in (1, 2, 3)), pa.array(made, pa.binary()), names=("fp", "n", "costly", "tokens"))

    texts = join_checked(rows.select("key", "text"), wanted, "key", "inner")
    sets = scratch.write(texts.select("text", "fp", "n", "costly").mapInArrow(collect, "fp long, n long, costly boolean, tokens binary"), "sets")
    # step 2
    costly = sets.where("costly").select("fp", "n", "tokens")
    for k, share in enumerate((*SHARES[1:], None)):
        if share is not None and k not in useful:
            continue
        pairs, hot = _meetings(_set_postings(costly, share), scratch, f"met{k + 1}")
        hot = scratch.write(hot, f"hot{k + 1}")
        edges = edges.unionByName(scratch.write(_candidates(pairs, hot, share), f"edges{k + 1}"))
        scratch.drop(f"met{k + 1}")
        met = join_checked(costly, hot, "fp", "inner")
        left = met.where(_costly(share)) if share is not None else met.where(F.col("hot") >= F.ceil(F.col("n") * 0.75))
        costly = scratch.write(left.select("fp", "n", "tokens"), f"costly{k + 1}")
    # step 3
    hubs = scratch.write(_hub_edges(costly, scratch), "hubs_of")
    found = scratch.write(_verify(sets.select("fp", "tokens"), edges, hubs, scratch).where("fp <> other"), "links")
    scratch.drop("sets")
    root = components(found, scratch, "components").distinct()
    return node.join(root.select(F.col("node").alias("fp"), "root"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of docs of which exactly one is left in each component. All columns stay.

    It is the row with the smallest doc_id, null last; of rows with one doc_id and different texts the first in order
    of a hash of the text, and of repeated rows the first in order of a hash of the whole row. Rows that link with
    nothing and rows without words all stay, whatever their doc_id.
    """
    scratch = Scratch(docs.sparkSession, "one_of_each")
    names = docs.columns
    own = {n: n if n in ("doc_id", "text") else f"__c{i}" for i, n in enumerate(names)}
    rows, odd = keyed(docs.select(*[F.col(f"`{n}`").alias(c) for n, c in own.items()]), scratch, *[c for c in own.values() if c.startswith("__c")])
    named = scratch.write(_rooted(rows.select("doc_id", "text", "key"), scratch).where("n > 0").select("doc_id", "key", "root"), "named")
    # keys are in order of doc_id, null first
    first = named.groupBy("root").agg(F.min(F.when(F.col("doc_id").isNotNull(), F.col("key"))).alias("some"), F.min("key").alias("any")).select("root", F.coalesce("some", "any").alias("first"))
    first = scratch.write(first, "first")
    gone = scratch.write(named.join(first.hint("merge"), "root").where("key <> first").select("key").distinct(), "gone")
    left = join_checked(rows, gone, "key", "left_anti")
    if odd:
        again = scratch.write(named.groupBy("key").count().where("count > 1").select("key"), "again")
        whole = F.struct(*[F.col(c) for c in own.values()])
        once = join_checked(left, again, "key", "left_semi").groupBy("key").agg(F.min_by(whole, F.xxhash64(F.to_json(whole))).alias("__row")).select("__row.*")
        left = join_checked(left, again, "key", "left_anti").select(*own.values()).unionByName(once)
    return left.select(*[F.col(c).alias(n) for n, c in own.items()])


def sql(n: int = SHINGLE) -> str:
    """The same join for DuckDB: sets as texts, equal ones once, and all pairs that share a shingle."""
    lower = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    return f"""
WITH RECURSIVE w AS (
  SELECT doc_id, coalesce(regexp_extract_all({lower}, '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {n} THEN [array_to_string(w, ' ')]
                      ELSE list_sort(list_distinct(list_transform(range(1, len(w) - {n} + 2), lambda i: array_to_string(w[i:i + {n - 1}], ' ')))) END AS s
  FROM w
), named AS (
  SELECT doc_id, len(s)::BIGINT AS n, dense_rank() OVER (ORDER BY s) AS node, s FROM s
), one AS (
  SELECT node, any_value(n) AS n, any_value(s) AS s FROM named WHERE n > 0 GROUP BY node
), posted AS (
  SELECT node, n, unnest(s) AS shingle FROM one
), linked AS (
  SELECT a.node AS a, b.node AS b FROM posted a JOIN posted b ON a.shingle = b.shingle AND a.node < b.node
  GROUP BY a.node, b.node, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), ways AS (
  SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked
), reach AS (
  SELECT node AS a, node AS b FROM one UNION SELECT reach.a, ways.b FROM reach JOIN ways ON reach.b = ways.a
), lowest AS (
  SELECT reach.a AS node, min(named.doc_id) AS component_id FROM reach JOIN named ON reach.b = named.node GROUP BY reach.a
)
SELECT doc_id, n AS n_shingles, coalesce(component_id, doc_id) AS component_id FROM named LEFT JOIN lowest USING (node)"""
