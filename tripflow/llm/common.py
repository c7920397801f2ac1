"""Tables, shared-folder writes and small hashes used by several operators."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Labelled documents that a classifier learns from: the bound of the sample.
MAX_LABELS = 40_000
HASHES = 1 << 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """Folder of ``spark.checkpoint.dir``: all executors reach it. Its absence is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, deleted by Hadoop's file system when the driver ends."""
    path = f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def drop_path(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back.

    The lineage is cut in a way that survives lost executors, and the planner knows the true
    size of what it reads: a join broadcasts it only below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fold(doc_id: str = "doc_id") -> Column:
    """Remainder by 3 of the CRC-32 of the id as text; a null id is in fold 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3, F.lit(0))


def known_labels(labels: DataFrame, label: str, max_labels: int = MAX_LABELS) -> DataFrame:
    """``doc_id`` and ``label`` (0 or 1) one may learn from: not held out, ``max_labels`` rows or so.

    Of more labels, a sample by a hash of the id is kept: the same ids in every run, about ``max_labels``
    of them (the square root of that is one standard deviation), 12 bytes each. So the result can always be
    broadcast, and the texts it selects need no shuffle of all texts. Ids labelled twice count once,
    with the larger label; null ids and labels are left out.
    """
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & (fold() != 1))
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("label"))
    )
    known = stored(known, "labels")
    found = known.count()
    if found <= max_labels:
        return known
    return known.where(F.pmod(F.xxhash64("doc_id"), F.lit(HASHES)) < HASHES * max_labels // found)


def labelled(documents: DataFrame, labels: DataFrame, label: str, max_labels: int = MAX_LABELS) -> DataFrame:
    """Text and label of the documents in ``known_labels``; null texts are left out."""
    known = F.broadcast(known_labels(labels, label, max_labels))
    return documents.select("doc_id", "text").where("text IS NOT NULL").join(known, "doc_id")


def as_text(column: str | Column, name: str | None = None) -> Column:
    """A long as text, for the way through pandas: there a column of longs with nulls turns into doubles."""
    column = F.col(column) if isinstance(column, str) else column
    text = column.cast("long").cast("string")
    return text.alias(name) if name else text


def mixed(hashes: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers (multiply, shift, twice), so that every bit depends on all."""
    h = hashes.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))
