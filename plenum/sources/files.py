"""Scans and sinks of the record files: JSON documents, JSON lines, line lists, tab-separated tables, status logs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plenum.functions.text import sanitized, stripped


def header_difference(expected: list[str], actual: list[str]) -> tuple[list[str], list[str]]:
    """Columns that are missing, and those too many, each in order."""
    return [c for c in expected if c not in actual], [c for c in actual if c not in expected]


class HeaderMismatch(ValueError):
    """A table that exists has other columns than the rows to append."""

    def __init__(self, path: str, expected: list[str], actual: list[str]):
        missing, extra = header_difference(expected, actual)
        what = f"missing {missing}, extra {extra}" if missing or extra else "in another order"
        super().__init__(f"{path}: expected {len(expected)} columns, found {len(actual)}: {what}")


def line_list(lines: DataFrame) -> DataFrame:
    """id, pos from (line, pos): trimmed and upper-cased, without blanks and comments, each id where it stands first."""
    kept = lines.select(stripped(F.col("line")).alias("line"), "pos").where("line <> '' AND NOT startswith(line, '#')")
    return kept.groupBy(F.upper("line").alias("id")).agg(F.min("pos").alias("pos"))


def json_documents(spark: SparkSession, path: str) -> DataFrame:
    """file, v for each JSON object under path, one per file; corrupt files and other kinds of values are left out."""
    text = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    return text.select("file", F.try_parse_json("value").alias("v")).where(F.schema_of_variant("v").startswith("OBJECT"))


def runs(spark: SparkSession, path: str) -> DataFrame:
    """entity, run, v: run files of all entities, path/<entity>/run_*.json. Runs sort by file name, as text."""
    found = json_documents(spark, f"{path}/*/run_*.json")
    return found.select(F.regexp_extract("file", r"([^/]+)/[^/]+$", 1).alias("entity"), F.regexp_extract("file", r"([^/]+)\.json$", 1).alias("run"), "v")


def json_lines(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Parsed objects (line, v) and the lines that are none, for quarantine."""
    lines = spark.read.text(path).select(F.col("value").alias("line")).where("trim(line) <> ''").withColumn("v", F.try_parse_json("line"))
    good = F.coalesce(F.schema_of_variant("v").startswith("OBJECT"), F.lit(False))
    return lines.where(good), lines.where(~good).select("line")


def cached(spark: SparkSession, path: str, version: int, schema: str | None = None) -> DataFrame:
    """The rows of a versioned cache; those of other versions don't count. With a schema, a cache that isn't there is empty."""
    where, store = _at(spark, path)
    if schema is not None and not store.exists(where):
        return spark.createDataFrame([], schema)
    return spark.read.parquet(path).where(F.col("version") == version).drop("version")


def read_log(spark: SparkSession, path: str, schema: str = "id string, status string, timestamp string") -> DataFrame:
    """The rows of a log of JSON lines; lines that are corrupt, or have no id, and a log that isn't there give none."""
    where, store = _at(spark, path)
    if not store.exists(where):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path).where("id IS NOT NULL")


def is_pdf(content):
    """Whether binary content begins as a PDF does."""
    return F.substring(content, 1, 4) == F.lit(b"%PDF")


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def commit(writes: list[tuple[str, DataFrame, str, dict]]) -> None:
    """Writes (path, rows, format, options) all or none: everything goes to a folder beside its path first, and the files
    move once all of it is written. Where a move fails, those that moved are taken back. Existing files stay.
    """
    staged, moved = [], []
    try:
        for path, df, kind, options in writes:
            aside = f"{path.rstrip('/')}.{uuid.uuid4().hex}.staged"
            staged.append((df.sparkSession, aside, path))
            df.write.format(kind).options(**options).save(aside)
        for spark, aside, path in staged:
            source, store = _at(spark, aside)
            target, _ = _at(spark, path)
            store.mkdirs(target)
            for f in store.listStatus(source):
                name = f.getPath().getName()
                if not name.startswith(("_", ".")):
                    end = spark._jvm.org.apache.hadoop.fs.Path(target, name)
                    if not store.rename(f.getPath(), end):
                        raise OSError(f"{f.getPath()} can't be moved to {end}")
                    moved.append((store, end))
    except BaseException:
        for store, end in moved:
            store.delete(end, False)
        raise
    finally:
        for spark, aside, _ in staged:
            source, store = _at(spark, aside)
            store.delete(source, True)


def append_tables(tables: dict[str, tuple[str, DataFrame]]) -> None:
    """Appends rows to tab-separated tables with a header, to all or to none. All headers are checked before anything is
    written; a table without rows isn't touched."""
    some = {k: (p, df) for k, (p, df) in tables.items() if df.limit(1).count()}
    for path, df in some.values():
        where, store = _at(df.sparkSession, path)
        if store.exists(where):
            there = df.sparkSession.read.option("sep", "\t").option("header", True).csv(path).columns
            if there != df.columns:
                raise HeaderMismatch(path, df.columns, there)
    flat = {"sep": "\t", "header": "true", "escape": '"'}
    commit([(path, df.select(*[sanitized(F.col(f"`{c}`"), kind).alias(c) for c, kind in df.dtypes]), "csv", flat) for path, df in some.values()])


def write_aggregated(records: DataFrame, reports: DataFrame, differences: DataFrame, folder: str) -> None:
    """Commits what aggregate() made as JSON lines: records, reports, and differences if there are any."""
    rows = records.select("entity", F.to_json("v").alias("record"))
    some = [(f"{folder}/records", rows, "json", {}), (f"{folder}/reports", reports, "json", {})]
    commit(some + ([(f"{folder}/differences", differences, "json", {})] if differences.limit(1).count() else []))


def write_cache(df: DataFrame, path: str, version: int) -> None:
    """Replaces a versioned cache in one move; readers see the old rows or the new ones."""
    where, store = _at(df.sparkSession, path)
    new, old = (_at(df.sparkSession, f"{path.rstrip('/')}.{uuid.uuid4().hex}")[0] for _ in range(2))
    df.withColumn("version", F.lit(version)).write.parquet(str(new.toString()))
    had = store.exists(where) and store.rename(where, old)
    if not store.rename(new, where):
        if had:
            store.rename(old, where)
        raise OSError(f"{path} can't be replaced")
    if had:
        store.delete(old, True)


def write_requests(requests: DataFrame, path: str) -> None:
    """Appends batch requests (entity, run, prompt) as JSON lines, keyed so that answers find their run."""
    key = F.concat_ws("_run_", "entity", F.col("run").cast("string"))
    part = F.array(F.struct(F.array(F.struct(F.col("prompt").alias("text"))).alias("parts")))
    requests.select(key.alias("key"), F.struct(part.alias("contents")).alias("request")).write.mode("append").json(path)


def answers(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(entity, run, v) of batch answers (v VARIANT), v being the first function call's arguments; and the others with the reason.

    An answer without a key, with an error, or without a call's object goes to the others.
    """
    key = F.try_variant_get("v", "$.key", "string")
    args = F.try_variant_get("v", "$.response.candidates[0].content.parts", "array<variant>")
    call = F.get(F.filter(F.transform(args, lambda p: F.try_variant_get(p, "$.functionCall.args", "variant")), lambda a: F.schema_of_variant(a).startswith("OBJECT")), F.lit(0))
    run = F.regexp_extract(key, r"^(.+)_run_(\d+)$", 2)
    error = F.to_json(F.try_variant_get("v", "$.error", "variant"))
    reason = F.when(F.coalesce(run, F.lit("")) == "", "no key").when(error.isNotNull() & (error != "null"), "error").when(call.isNull(), "no function call")
    rows = lines.select("v", reason.alias("reason"), F.regexp_extract(key, r"^(.+)_run_(\d+)$", 1).alias("entity"), run.alias("run"), call.alias("call"))
    return rows.where("reason IS NULL").select("entity", F.col("run").cast("long").alias("run"), F.col("call").alias("v")), rows.where("reason IS NOT NULL").select("v", "reason")


def append_log(df: DataFrame, path: str) -> None:
    """Appends status or audit rows as JSON lines; nothing is ever rewritten."""
    df.write.mode("append").json(path)


def current_status(log: DataFrame, key: str = "id", order: str = "timestamp") -> DataFrame:
    """The last row of each key."""
    rest = [c for c in log.columns if c != key]
    return log.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("r")).select(key, "r.*")
