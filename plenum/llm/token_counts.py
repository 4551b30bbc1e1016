"""Token counts of documents in flat token files that have no index, by a scan for separators.

A file is ids of a fixed width, one after another, with an end-of-document id after each document. It is cut into
blocks at any id. A block's scan finds all separators at once and keeps per block how many there are, and how many
ids stand before the first and after the last; a prefix scan over the blocks of a file stitches documents that
cross block boundaries and numbers them. Blocks are read by range, so a file may be far larger than a task.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch, join_checked, only
from .tokens import Vocabulary

END, BLOCK, WIDTH = 50256, 1 << 22, 2


def separators(block: np.ndarray, end: int = END) -> np.ndarray:
    """Positions of the end id in a block of ids."""
    return np.flatnonzero(block == end)


def _files(uri: str):
    """The file system of a folder and the folder's path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri)


@dataclass(frozen=True)
class Files:
    """Flat token files of one folder, each with a block table."""

    folder: str
    width: int = WIDTH
    end: int = END


def write_files(docs: DataFrame, folder: str, vocabulary: Vocabulary = Vocabulary(), end: int = END, width: int = WIDTH) -> DataFrame:
    """Writes one flat file per task of docs and returns file, n_tokens (separators included), and what its documents are in order.

    A vocabulary with ids that ``width`` bytes can't hold is an error.

    A task writes under a name of its own attempt, so a run that is repeated or races another never leaves a
    mixed file; only names in the returned table count.
    """

    def run(batches):
        import uuid

        from pyspark import TaskContext

        store, root = _files(folder)
        store.create_dir(root, recursive=True)
        name = f"tokens-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.bin"
        encoder, nth, total = vocabulary.encoder(), 0, 0
        if max(encoder.top, end) >= 1 << 8 * width:
            raise ValueError(f"ids up to {max(encoder.top, end)} don't fit into {width} bytes")
        last = np.array([end], f"<u{width}").tobytes()
        with store.open_output_stream(f"{root}/{name}") as out:
            for batch in batches:
                for text in batch.column(1):
                    ids = np.frombuffer(encoder.ids(text.as_py() or ""), "<u4").astype(f"<u{width}")
                    out.write(ids.tobytes())
                    out.write(last)
                    total += len(ids) + 1
                rows = batch.num_rows
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([name] * rows, pa.string()), pa.array(np.arange(nth, nth + rows)), pa.array([None] * rows, pa.int64())], names=["doc_id", "file", "nth", "n_tokens"])
                nth += rows
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([name], pa.string()), pa.array([-1], pa.int64()), pa.array([total], pa.int64())], names=["doc_id", "file", "nth", "n_tokens"])

    return only(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(run, "doc_id long, file string, nth long, n_tokens long")


def blocks(files: DataFrame, block: int = BLOCK) -> DataFrame:
    """file, block, first, last: id ranges of at most ``block`` ids for each file, n_tokens being its length."""
    cut = files.where("n_tokens > 0").select("file", "n_tokens", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_tokens") - 1) / block).cast("long"))).alias("block"))
    return cut.select("file", "block", (F.col("block") * block).alias("first"), F.least((F.col("block") + 1) * block, F.col("n_tokens")).alias("last"))


def scan(ranges: DataFrame, files: Files) -> DataFrame:
    """file, block, nth, tokens: per separator its number in the block and the ids since the one before it in the
    block (or the block's start); nth -1 has the block's number of separators, tail the ids after its last one."""

    def run(batches):
        store, root = _files(files.folder)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_file(f"{root}/{row['file']}") as f:
                    data = f.read_at((row["last"] - row["first"]) * files.width, row["first"] * files.width)
                ids = np.frombuffer(data, f"<u{files.width}")
                at = separators(ids, files.end)
                tokens = np.diff(at, prepend=-1) - 1
                tail = len(ids) - (int(at[-1]) + 1 if len(at) else 0)
                n = len(at) + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["file"]] * n, pa.string()), pa.array(np.full(n, row["block"])), pa.array(np.arange(-1, n - 1)), pa.array(np.concatenate(([len(at)], tokens))), pa.array(np.full(n, tail, np.int64))],
                    names=["file", "block", "nth", "tokens", "tail"],
                )

    return ranges.mapInArrow(run, "file string, block long, nth long, tokens long, tail long")


def stitch(found: DataFrame, scratch: Scratch) -> DataFrame:
    """file, nth, n_tokens: each document's number in its file and its ids, those in earlier blocks included.

    The prefix scan runs over one row a block, and only that side of the last join may be broadcast. A block's carry is what follows the last separator before it: the
    tails of all blocks since the last one that has a separator. Ids after a file's last separator are no document.
    """
    heads = found.where("nth = -1").select("file", "block", F.col("tokens").alias("seps"), "tail")
    past = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    heads = heads.withColumns({"base": F.coalesce(F.sum("seps").over(past), F.lit(0)), "group": F.coalesce(F.count(F.when(F.col("seps") > 0, 1)).over(past), F.lit(0))})
    # blocks of one group stand between two blocks with separators; the first of them carries what the block before it left
    tails = W.partitionBy("file").orderBy("block")
    heads = heads.withColumn("left", F.lag("tail").over(tails)).withColumn("carry", F.coalesce(F.sum("left").over(W.partitionBy("file", "group").orderBy("block").rowsBetween(W.unboundedPreceding, W.currentRow)), F.lit(0)))
    carry = scratch.write(heads.select("file", "block", "base", "carry"), "carry")
    rows = join_checked(found.where("nth >= 0"), carry, ["file", "block"], "inner")
    return rows.select("file", (F.col("base") + F.col("nth")).alias("nth"), (F.col("tokens") + F.when(F.col("nth") == 0, F.col("carry")).otherwise(0)).alias("n_tokens"))


def count_files(spark: SparkSession, folder: str, files: DataFrame, width: int = WIDTH, end: int = END, block: int = BLOCK) -> DataFrame:
    """file, nth, n_tokens of every document in the flat files of a folder; files: file, n_tokens (its length in ids).

    An empty file has no documents; two separators in a row enclose a document of 0 tokens.
    """
    ranges = blocks(files, block)
    scratch = Scratch(spark, "scan")
    return stitch(scratch.write(scan(ranges.repartition("file", "block"), Files(folder, width, end)), "found"), scratch)


def token_counts(docs: DataFrame, vocabulary: Vocabulary = Vocabulary(), block: int = BLOCK) -> DataFrame:
    """doc_id, n_tokens of every row of docs: texts go to flat files in the shared folder, counts come from a scan of these.

    Null and empty texts: 0 tokens. Null doc_ids and repeated rows: one result each. Empty table: empty result.
    Columns other than doc_id and text aren't read.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "tokens")
    folder = scratch.path("flat")
    written = scratch.write(write_files(docs, folder, vocabulary), "written")
    counted = count_files(spark, folder, written.where("nth = -1").select("file", "n_tokens"), block=block)
    return written.where("nth >= 0").select("doc_id", "file", "nth").join(counted.hint("merge"), ["file", "nth"]).select("doc_id", "n_tokens")
