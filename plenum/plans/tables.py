"""Scans of the shared test tables and the session that tests and benchmarks use."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def session(name: str = "plenum", cores: int | None = None, partitions: int | None = None) -> SparkSession:
    """A local session with the settings that results depend on, and adaptive execution."""
    cores = cores or os.cpu_count() or 8
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.shuffle.partitions": str(partitions or cores),
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    return SparkSession.builder.master(f"local[{cores}]").appName(name).config(map=conf).getOrCreate()


def shared(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir; a local one where that is unset)."""
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        import tempfile

        context.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or "file://" + tempfile.mkdtemp(prefix="plenum-"))
    return context._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """df without its lineage, from the shared folder."""
    shared(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """df without its lineage, like cut(), as a compressed table in the shared folder; it stays until that folder goes."""
    schema, path = df.schema, f"{shared(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)
