"""Shared folder handling, text buffers and batch plumbing of the operators."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of a join is broadcast up to this many rows of two longs; beyond it the join shuffles.
BROADCAST_ROWS = 500_000

#: With it, Spark deletes a query's shuffle files when the query ends, not when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: The words of the contracts, as bytes of UTF-8: runs of what is neither a blank nor 0x09 to 0x0D.
WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only a local master may leave it unset: it gets a folder of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="plenum-")
        atexit.register(shutil.rmtree, folder[7:], ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


class Scratch:
    """Tables of one call in the shared folder. They replace lineage, so a lost executor costs one stage at most.

    A call's result reads from them, so they stay until clean() is called after its rows are written.
    """

    made: set[str] = set()

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, f"{shared_folder(spark)}/plenum/{name}-{uuid.uuid4().hex}"
        Scratch.made.add(self.root)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Writes df and reads it again with the same column types. Its shuffle files go at once, as nothing reads them again."""
        schema, before = df.schema, self.spark.conf.get(CLEANUP, None)
        self.spark.conf.set(CLEANUP, "true")
        try:
            df.write.mode("overwrite").option("compression", "zstd").parquet(self.path(name))
        finally:
            if before is None:
                self.spark.conf.unset(CLEANUP)
            else:
                self.spark.conf.set(CLEANUP, before)
        return self.spark.read.schema(schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        delete(self.spark, self.path(name))

    def release(self) -> None:
        """Lets Spark delete the shuffle files of plans that nothing refers to any more."""
        import gc

        gc.collect()
        self.spark._jvm.System.gc()


def delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def clean(spark: SparkSession, *keep: str) -> None:
    """Deletes the scratch tables of all calls but those whose folders are to be kept."""
    for root in Scratch.made - set(keep):
        delete(spark, root)
        Scratch.made.discard(root)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def numbered(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """df with columns c0, c1, .. instead of its own names, so that names of an operator's own never clash, and these."""
    names = [f"c{i}" for i in range(len(df.columns))]
    return df.toDF(*names), names


def only(df: DataFrame, *names: str) -> DataFrame:
    """The named columns; all others, whatever they are called, stay out of the operator's way."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def crc_fold(key: Column) -> Column:
    """crc32 of an id's decimal text, mod 4: rows at 2 are held out."""
    return F.crc32(key.cast("string").cast("binary")) % 4


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether df has at most so many rows, found without reading more than it must."""
    return len(df.select(F.lit(1)).limit(rows + 1).groupBy().count().where(F.col("count") <= rows).take(1)) == 1


def join_checked(left: DataFrame, right: DataFrame, on: str, how: str, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Equi-join that broadcasts right only where it is small; beyond that it's a sort-merge join."""
    if small(right, rows):
        return left.join(F.broadcast(right), on, how)
    return left.join(right.hint("merge"), on, how)


def raw(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than rows) of a string or binary column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), at


def parts(offsets: np.ndarray, most: int = 1 << 20):
    """Cuts rows into ranges [a, b) of at most so many bytes; a longer row is alone."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, side="right")) - 1)
        yield a, b
        a = b
