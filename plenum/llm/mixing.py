"""Mixing sources to target weights: water-filled targets, certain whole copies, then Pareto order sampling.

A document of a source with target t and size s is expected in t / s copies. Its whole copies are certain; what is
left is its inclusion probability p. Documents are ranked by u / (1 - u) divided by p / (1 - p), u being a hash of
the id, and each source takes documents in that order until the words it still lacks are there. The cut is found
by histograms of the rank, each one finer than the last, and becomes one row a source: where in rank it stops. The
documents themselves then meet only that table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, Scratch, join_checked

WEIGHTS, SHARE, MOST, BUCKETS, LEVELS, SEED = (5, 2, 1), 1.5, 2, 4096, 2, "mix-1"
KEYS = ["source_key", "source_null"]


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(key: Column, seed: str = SEED) -> Column:
    """A number in (0, 1) from a key's decimal text, the same in each run and engine."""
    digits = F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """source_key, source_null, source_size, target: one row a source.

    Sources in code point order, null last, weigh ``weights`` in turn. All targets together are share of all
    sizes; none is above most times its source's size: what is above goes to the others by weight. In order of
    cap / weight the capped sources come first, so running sums find the level of the others without a loop.
    """
    by = sizes.groupBy("source_key", "source_null").agg(F.sum("size").alias("source_size"))
    order = W.orderBy("source_null", "source_key")
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    by = by.withColumns({"weight": turn, "cap": F.col("source_size") * most})
    by = by.withColumn("ratio", F.col("cap") / F.col("weight"))
    everything, before = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing), W.orderBy("ratio", "source_null", "source_key").rowsBetween(W.unboundedPreceding, -1)
    by = by.withColumns(
        {
            "asked": F.lit(share) * F.sum("source_size").over(everything).cast("double"),
            "heavy": F.sum("weight").over(everything),
            "full": F.coalesce(F.sum("cap").over(before), F.lit(0)),
            "light": F.coalesce(F.sum("weight").over(before), F.lit(0)),
        }
    )
    by = by.withColumn("capped", F.col("ratio") <= F.try_divide(F.col("asked") - F.col("full"), F.col("heavy") - F.col("light")))
    by = by.withColumns({"full_all": F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0)).over(everything), "light_all": F.sum(F.when(F.col("capped"), F.col("weight")).otherwise(0)).over(everything)})
    level = F.try_divide(F.col("asked") - F.col("full_all"), F.col("heavy") - F.col("light_all"))
    return by.select("source_key", "source_null", "source_size", F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(F.col("weight") * level).alias("target"))


def _cut(fine: DataFrame, lack: DataFrame, level: int) -> DataFrame:
    """Per source the bucket in which what it lacks runs out, and what it lacks when it gets there.

    fine: a source's sizes by bucket, at most BUCKETS rows a source.
    """
    running = W.partitionBy(*KEYS).orderBy("bucket").rowsBetween(W.unboundedPreceding, W.currentRow)
    at = join_checked(fine.withColumn("upto", F.sum("held").over(running)), lack, KEYS, "inner")
    return at.where((F.col("upto") >= F.col("lack")) & (F.col("upto") - F.col("held") < F.col("lack"))).select(*KEYS, F.col("bucket").alias(f"cut{level}"), (F.col("lack") - (F.col("upto") - F.col("held"))).alias("lack"))


def _odds(seed: str) -> Column:
    """The rank of a row that has doc_id or the text's hash in ``key`` and its source's ``p``."""
    u = uniform(F.col("key"), seed)
    return (u / (1 - u)) / (F.col("p") / (1 - F.col("p")))


def _cell(buckets: int, levels: int) -> Column:
    return F.floor(F.col("odds") / (1 + F.col("odds")) * F.lit(float(buckets**levels))).cast("long")


def _key() -> Column:
    return F.coalesce(F.col("`doc_id`").cast("string"), F.md5(F.coalesce(F.col("`text`"), F.lit("")).cast("binary")))


def _tie(docs: DataFrame) -> Column:
    """A hash of the whole row."""
    odd = ("map", "variant", "struct", "array")
    return F.xxhash64(*[F.to_json(F.struct(F.col(f"`{n}`"))) if kind.startswith(odd) else F.col(f"`{n}`") for n, kind in docs.dtypes])


def cuts(d: DataFrame, scratch: Scratch, weights: tuple[int, ...], share: float, most: int, buckets: int, levels: int, seed: str) -> DataFrame:
    """One row a source: its size and target, the whole copies of each document, p, and the rank at which it stops.

    d: source_key, source_null, key, size, tie. A document in a cell before ``cut`` gets one copy more; in that cell
    one that stands before (cut_odds, cut_size, cut_tie), and ``picked`` of the ``alike`` rows that stand right there.
    Only sums and counts are shuffled: at most BUCKETS rows of a source, then the distinct rows of one cell.
    """
    goal = targets(d.select(*KEYS, "size"), weights, share, most)
    ratio = F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0))
    goal = scratch.write(goal.withColumns({"whole": F.floor(ratio).cast("long"), "p": ratio - F.floor(ratio)}), "targets")
    lack = goal.where("target > 0").withColumn("lack", F.col("target") - F.floor(F.col("target") / F.col("source_size")) * F.col("source_size")).select(*KEYS, "lack").where("lack > 0")
    ranked = join_checked(d.where("size > 0"), goal.where("p > 0").select(*KEYS, "p"), KEYS, "inner").withColumn("odds", _odds(seed)).withColumn("cell", _cell(buckets, levels))
    cut = None
    for level in range(levels):
        step = buckets ** (levels - 1 - level)
        here = ranked.withColumn("bucket", F.floor(F.col("cell") / step).cast("long"))
        if cut is not None:
            here = join_checked(here, cut, KEYS, "inner").where(F.floor(F.col("cell") / (step * buckets)) == F.col(f"cut{level - 1}"))
        fine = here.groupBy(*KEYS, "bucket").agg(F.sum("size").alias("held"))
        cut = scratch.write(_cut(fine, lack, level), f"cut{level}")
        lack = cut.select(*KEYS, "lack")
    cut = cut.withColumnRenamed(f"cut{levels - 1}", "cut")
    last = join_checked(ranked, cut, KEYS, "inner").where("cell = cut").groupBy(*KEYS, "cut", "lack", "odds", "size", "tie").agg(F.count("*").alias("alike"))
    before = W.partitionBy(*KEYS).orderBy("odds", "size", "tie").rowsBetween(W.unboundedPreceding, -1)
    last = last.withColumn("left", F.col("lack") - F.coalesce(F.sum(F.col("size") * F.col("alike")).over(before), F.lit(0)))
    # a row is taken while half of it is still lacking
    whole = F.floor(F.col("left") / F.col("size") + 0.5).cast("long")
    some = F.when(whole * F.col("size") - F.col("size") / 2 < F.col("left"), whole).otherwise(whole - 1)
    last = last.withColumn("picked", F.greatest(F.lit(0), F.least("alike", some))).where("picked < alike")
    stop = last.groupBy(*KEYS).agg(F.min(F.struct("odds", "size", "tie", "picked", "alike")).alias("s")).select(*KEYS, F.col("s.odds").alias("cut_odds"), F.col("s.size").alias("cut_size"), F.col("s.tie").alias("cut_tie"), "s.picked", "s.alike")
    out = goal.join(cut.select(*KEYS, "cut").hint("merge"), KEYS, "left").join(stop.hint("merge"), KEYS, "left")
    return scratch.write(out, "cuts")


def _copies(rows: DataFrame, made: DataFrame, size: Column, some: Column, tie: Column, columns: list[str], buckets: int, levels: int, seed: str) -> DataFrame:
    """rows (with source_key, source_null, key) and ``copies`` of each, after a join with one row a source.

    Rows that are alike in everything and stand right at the cut are counted, not numbered: their copies are
    dealt out by the count.
    """
    d = join_checked(rows, made, KEYS, "left").withColumn("odds", F.when(some & (F.col("p") > 0), _odds(seed))).withColumn("cell", _cell(buckets, levels))
    ahead, level = F.col("odds") < F.col("cut_odds"), F.col("odds") == F.col("cut_odds")
    at = F.when(F.col("cell") != F.col("cut"), False).otherwise(F.coalesce(level, F.lit(False)) & (size == F.col("cut_size")) & (tie == F.col("cut_tie")))
    more = F.when(F.col("odds").isNull() | F.col("cut").isNull(), 0).when(F.col("cell") != F.col("cut"), (F.col("cell") < F.col("cut")).cast("int")).when(F.col("cut_odds").isNull() | ahead, 1).when(~level, 0).when(size != F.col("cut_size"), (size < F.col("cut_size")).cast("int")).when(tie != F.col("cut_tie"), (tie < F.col("cut_tie")).cast("int")).otherwise(0)
    whole = F.coalesce("whole", F.lit(0))
    clear = d.withColumn("copies", (whole + more).cast("long"))
    if not made.where("picked > 0").limit(1).count():
        return clear.select(*columns, "copies")
    tied = F.coalesce(at, F.lit(False))
    alike = d.where(tied).select(*columns, "whole", "picked", "alike", *KEYS).groupBy(*KEYS, "whole", "picked", "alike").agg(F.first(F.struct(*columns)).alias("row"))
    kinds = F.array(F.struct((F.col("whole") + 1).alias("copies"), F.col("picked").alias("n")), F.struct(F.col("whole").alias("copies"), (F.col("alike") - F.col("picked")).alias("n")))
    alike = alike.select("row", F.explode(kinds).alias("kind")).where("kind.n > 0").select("row", F.col("kind.copies").alias("copies"), "kind.n")
    return clear.where(~tied).select(*columns, "copies").unionByName(_repeat(alike, "n").select("row.*", "copies"))


def _repeat(rows: DataFrame, n: str, most: int = 1000) -> DataFrame:
    """Each row n times; many repeats of one row are dealt out over all tasks."""
    lots = rows.withColumn("__lot", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(n) - 1) / most).cast("long"))))
    each = F.least(F.lit(most), F.col(n) - F.col("__lot") * most).cast("int")
    return lots.repartition("__lot").withColumn("__one", F.explode(F.sequence(F.lit(1), each))).drop("__lot", "__one")


def _narrow(docs: DataFrame) -> list[Column]:
    return [F.coalesce(F.col("`source`").cast("string"), F.lit("")).alias("source_key"), F.col("`source`").isNull().alias("source_null"), _key().alias("key")]


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST, buckets: int = BUCKETS, levels: int = LEVELS, seed: str = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken and copies for every row of docs.

    size is the number of words. Null text: size 0, nothing to take. Null source: a source of its own, last in
    order. Null doc_id: ranked by a hash of the text. Repeated rows count each; they tie in rank, and which of equal
    rows is taken makes no difference. A source without words has target 0. Empty table: empty result. Columns other
    than doc_id, source and text only break ties between rows with one doc_id.
    Each source's taken words miss its target by half of one document at most.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    d = scratch.write(docs.select(F.col("`doc_id`").alias("doc_id"), *_narrow(docs), words(F.col("`text`")).alias("size"), _tie(docs).alias("tie")), "sizes")
    made = cuts(d, scratch, weights, share, most, buckets, levels, seed)
    columns = ["doc_id", "size", "source_size", "target"]
    out = _copies(d, made, F.col("size"), F.col("size") > 0, F.col("tie"), columns, buckets, levels, seed)
    return out.select(*columns, (F.col("copies") * F.col("size")).alias("taken"), "copies")


def resampled(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST, buckets: int = BUCKETS, levels: int = LEVELS, seed: str = SEED) -> DataFrame:
    """The rows of docs as often as the mix takes them, with docs' own columns; one without words has its whole copies only.

    Everything is decided on ids and sizes; the texts themselves pass once, beside a table of one row a source.
    Nulls, ties and repeated rows as in mix(); an empty table gives an empty one. Columns of any name stay.
    """
    scratch = Scratch(docs.sparkSession, "resampled")
    names = docs.columns
    d = scratch.write(docs.select(*_narrow(docs), words(F.col("`text`")).alias("size"), _tie(docs).alias("tie")), "sizes")
    made = cuts(d, scratch, weights, share, most, buckets, levels, seed)
    columns = [f"__c{i}" for i in range(len(names))]
    held = docs.select(*[F.col(f"`{n}`").alias(c) for n, c in zip(names, columns, strict=True)], *_narrow(docs), _tie(docs).alias("tie"))
    text = F.col(columns[names.index("text")])
    out = _copies(held, made, words(text), F.coalesce(text.rlike(WORD), F.lit(False)), F.col("tie"), columns, buckets, levels, seed)
    again = out.where("copies > 0").withColumn("copies", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return again.select(*[F.col(c).alias(n) for n, c in zip(names, columns, strict=True)])


def sql(weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST, seed: str = SEED) -> str:
    """The same mix for DuckDB, with plain windows."""
    return f"""
WITH d AS (
  SELECT doc_id, source, coalesce(doc_id::VARCHAR, md5(coalesce(text, ''))) AS key, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, (sum(size) * {most})::BIGINT AS cap,
         [{", ".join(map(str, weights))}][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(weights)} + 1)::INT] AS weight
  FROM d GROUP BY source
), r AS (
  SELECT *, cap / weight AS ratio, {share} * (sum(source_size) OVER ())::DOUBLE AS asked, (sum(weight) OVER ())::BIGINT AS heavy,
         coalesce(sum(cap) OVER w, 0)::BIGINT AS cap_before, coalesce(sum(weight) OVER w, 0)::BIGINT AS weight_before
  FROM s WINDOW w AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), c AS (
  SELECT *, ratio <= (asked - cap_before) / nullif(heavy - weight_before, 0) AS capped FROM r
), l AS (
  SELECT *, (asked - (sum(CASE WHEN capped THEN cap ELSE 0 END) OVER ())::BIGINT)
            / nullif(heavy - (sum(CASE WHEN capped THEN weight ELSE 0 END) OVER ())::BIGINT, 0) AS level FROM c
), g AS (
  SELECT source, source_size, CASE WHEN capped THEN cap::DOUBLE ELSE weight * level END AS target FROM l
), e AS (
  SELECT d.doc_id, d.key, d.size, g.*, coalesce(g.target / nullif(g.source_size, 0), 0.0) AS expected,
         (('0x' || substr(md5('{seed}:' || key), 1, 13))::BIGINT + 0.5::DOUBLE) / {1 << 52}::DOUBLE AS u
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source
), p AS (
  SELECT *, floor(expected)::BIGINT AS whole, expected - floor(expected) AS p FROM e
), o AS (
  SELECT *, CASE WHEN p > 0 AND size > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS odds FROM p
), k AS (
  SELECT *, sum(size) OVER (PARTITION BY source, odds IS NULL ORDER BY odds, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM o
)
SELECT doc_id, size, source_size, target,
       (whole + CASE WHEN odds IS NOT NULL AND upto - size / 2 < target - floor(target / source_size) * source_size THEN 1 ELSE 0 END)::BIGINT * size AS taken,
       (whole + CASE WHEN odds IS NOT NULL AND upto - size / 2 < target - floor(target / source_size) * source_size THEN 1 ELSE 0 END)::BIGINT AS copies
FROM k"""
