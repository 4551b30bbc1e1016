"""Secret scans over an incremental ledger of blobs, in DataFrame functions only.

Each version of a text is addressed by the SHA-256 of its content. A blob is scanned once for each version of the
rules, however many paths hold it; the ledger remembers which pairs are done, and findings are joined back to
every path. Patterns give the matches; the pieces between matches give their places.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, join_checked, numbered


@dataclass(frozen=True)
class Rule:
    """kind, its pattern, and the least length of what a group of it must hold."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


#: The base rules come first and in this order. Where a longer run can't hide a shorter one, the length is in the pattern.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
)
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"),
)
RULES = BASE + MORE
SPAN = "array<struct<start:int,rule:int,end:int>>"


def version(rules: tuple[Rule, ...] = RULES) -> str:
    """A name for a set of rules that changes whenever one of them does."""
    return hashlib.sha256(repr(rules).encode()).hexdigest()[:16]


def _spans(text: Column, rule: Rule, number: int) -> Column:
    """Leftmost non-overlapping matches of a rule as (start, rule, end) in code points, without those that are too short."""
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    pieces = F.split(text, rule.pattern, -1)
    held = F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)), F.length) if rule.least else F.transform(found, F.length)
    parts = F.arrays_zip(F.transform(pieces, F.length).alias("gap"), F.transform(found, F.length).alias("len"), held.alias("held"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["gap"]
        end = begin + F.coalesce(x["len"], F.lit(0))
        span = F.array(F.struct(begin.alias("start"), F.lit(number).alias("rule"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(F.coalesce(x["held"] >= max(1, rule.least), F.lit(False)), F.concat(acc["out"], span)).otherwise(acc["out"]).alias("out"))

    return F.when(text.rlike(rule.pattern), F.aggregate(parts, start, step, lambda acc: acc["out"])).otherwise(F.array().cast(SPAN))


def scan(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """blob, spans for each blob and its text, sorted by start, rule and end."""
    every = F.concat(*[_spans(F.col("text"), r, i) for i, r in enumerate(rules)])
    return blobs.select("blob", F.array_sort(every).alias("spans"))


def address(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def unseen(docs: DataFrame, ledger: DataFrame | None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """blob, text of what the ledger hasn't under these rules, one row a blob. Copies meet before the shuffle."""
    rows = docs.select(address(F.col("`text`")).alias("blob"), F.coalesce(F.col("`text`"), F.lit("")).alias("text"))
    if ledger is not None:
        rows = join_checked(rows, ledger.where(F.col("rules") == version(rules)).select("blob").distinct(), "blob", "left_anti")
    return rows.groupBy("blob").agg(F.first("text").alias("text"))


def update(docs: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The ledger's new rows: blob, rules, spans. Append them to the stored ledger; a lost run only repeats its scans."""
    return scan(unseen(docs, ledger, rules), rules).select("blob", F.lit(version(rules)).alias("rules"), "spans")


def _names(spans: Column, rules: tuple[Rule, ...]) -> Column:
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["rule"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def findings(docs: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans for every row of docs.

    Null text is empty, and empty texts have no findings. Null doc_ids and repeated rows keep their own rows. Empty
    table: empty result. Columns other than doc_id and text aren't read. Findings come from the ledger where it
    has the blob under these rules, else from a scan.
    """
    new = Scratch(docs.sparkSession, "ledger").write(update(docs, ledger, rules), "new")
    if ledger is not None:
        known = ledger.where(F.col("rules") == version(rules)).select("blob", "rules", "spans")
        new = new.unionByName(known.groupBy("blob", "rules").agg(F.first("spans").alias("spans")))
    some = new.where(F.size("spans") > 0).select("blob", "spans")
    paths = docs.select(F.col("`doc_id`").alias("doc_id"), address(F.col("`text`")).alias("blob"))
    got = F.coalesce(F.col("spans"), F.array().cast(SPAN))
    rows = paths.join(some, "blob", "left").select("doc_id", got.alias("spans"))
    base = F.filter("spans", lambda s: s["rule"] < len(BASE))

    def count(i: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["rule"] == i)).cast("long")

    return rows.select("doc_id", *[count(i).alias(f"n_{r.kind}") for i, r in enumerate(BASE)], F.sha2(_names(base, rules).cast("binary"), 256).alias("base_sha256"), _names(F.col("spans"), rules).alias("spans"))


def redacted(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mark: str = "[secret]") -> DataFrame:
    """docs with each finding replaced by a mark, and n_chars counted again where docs has it. All other columns stay.

    Overlapping findings become one mark. The scan sees each distinct text once; only texts with findings are
    joined back, by their content address. Null texts stay null, repeated rows stay repeated, whatever the doc_id;
    an empty table gives an empty one. Columns may have any names.
    """
    rows, own = numbered(docs)
    text = F.col(own[docs.columns.index("text")])
    some = update(rows.select(text.alias("text")), None, rules).where(F.size("spans") > 0).select("blob", "spans")
    rows = rows.withColumn("blob", address(text)).join(some, "blob", "left")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        grown = F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(s["start"] >= acc["at"], grown).otherwise(acc["out"]).alias("out"))

    clean = F.aggregate(F.col("spans"), start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    rows = rows.withColumn("clean", F.when(F.col("spans").isNull(), text).otherwise(clean))
    made = {"text": F.col("clean")} | ({"n_chars": F.length("clean").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {})
    return rows.select(*[made.get(n, F.col(c)).alias(n) for n, c in zip(docs.columns, own, strict=True)])


def sql(rules: tuple[Rule, ...] = RULES) -> str:
    """The same findings for DuckDB: matches and the pieces between them, numbered and summed by window."""

    def kind(i: int, r: Rule) -> str:
        pattern = r.pattern.replace("'", "''")
        return f"""
  SELECT k, {i} AS rule, unnest(range(1, len(m) + 1)) AS i, unnest(m) AS x, unnest(g) AS y, unnest(s[:len(m)]) AS gap, {max(1, r.least)} AS least
  FROM (SELECT k, regexp_extract_all(text, '{pattern}') AS m, regexp_extract_all(text, '{pattern}', {r.group}) AS g, regexp_split_to_array(text, '{pattern}') AS s
        FROM d WHERE regexp_matches(text, '{pattern}'))"""

    kinds = ", ".join(f"'{r.kind}'" for r in rules)
    return f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text FROM documents),
m AS ({" UNION ALL ".join(kind(i, r) for i, r in enumerate(rules))}),
p AS (SELECT k, rule, y, least, length(x) AS n, sum(length(gap) + length(x)) OVER (PARTITION BY k, rule ORDER BY i) AS stop FROM m),
f AS (SELECT k, rule, stop - n AS start, [{kinds}][rule + 1] || ':' || (stop - n)::BIGINT || ':' || stop::BIGINT AS name FROM p WHERE length(y) >= least),
a AS (SELECT k, count(*) FILTER (rule = 0) AS n_assign, count(*) FILTER (rule = 1) AS n_access, count(*) FILTER (rule = 2) AS n_hex,
             string_agg(name, ',' ORDER BY start, rule) FILTER (rule < {len(BASE)}) AS base, string_agg(name, ',' ORDER BY start, rule) AS spans FROM f GROUP BY k)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a USING (k)"""
