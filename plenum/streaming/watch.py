"""Streams over arriving files and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def arrivals(spark: SparkSession, folder: str, pending: DataFrame, suffix: str = "pdf") -> DataFrame:
    """A stream of files whose name, without its ending, is a pending id; the checkpoint knows which were seen.

    Spark decides by its size whether the pending ids are broadcast.
    """
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("pathGlobFilter", f"*.{suffix}").load(folder)
    named = files.select(F.upper(F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1)).alias("id"), "path", "length", (F.substring("content", 1, 4) == F.lit(b"%PDF")).alias("valid"))
    return named.join(pending.select("id").distinct(), "id")


def rates(spark: SparkSession, folder: str, schema: StructType, time: str, late: str = "10 minutes", width: str = "1 minute", step: str = "10 seconds") -> DataFrame:
    """A stream of how many rows each sliding window has; rows later than the watermark are left out."""
    rows = spark.readStream.schema(schema).parquet(folder)
    return rows.withWatermark(time, late).groupBy(F.window(time, width, step)).agg(F.count("*").alias("n"))


def run_available(stream: DataFrame, out: str, checkpoint: str) -> DataFrame:
    """Appends what is there now to a Parquet table and returns the table; another call goes on from the checkpoint."""
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(out)


def snapshot(stream: DataFrame, name: str) -> DataFrame:
    """A small aggregate over all that is there now, as a table in the driver's memory; for large ones use run_available()."""
    stream.writeStream.format("memory").queryName(name).outputMode("complete").trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.table(name)
