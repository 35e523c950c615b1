"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
#: bytes.translate table that lower-cases A-Z and nothing else.
ASCII_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a new temporary one where it is unset and all run on one machine (tests)."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """df as a Parquet table in the shared folder, read again: lineage ends there and lost executors cost nothing above it."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """Take away a table in the shared folder that nothing reads any more."""
    gone = spark._jvm.org.apache.hadoop.fs.Path(path)
    gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)


def words(text: Column) -> Column:
    """Array of the words of text; null and blank texts give an empty array."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def without(df: DataFrame, names: list[str]) -> list[Column]:
    """Columns of df, less those whose names the caller is about to add (compared without case, as Spark does)."""
    taken = {n.lower() for n in names}
    return [df[f"`{c}`"] for c in df.columns if c.lower() not in taken]


def by_size(batch: pa.RecordBatch, place: int, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about `most` bytes of text, so that memory doesn't follow the batch."""
    size = np.array([len(t.as_buffer()) if t.is_valid else 0 for t in batch.column(place)])
    cut = (np.cumsum(size) // most).tolist()
    start = 0
    for i in range(1, len(cut) + 1):
        if i == len(cut) or cut[i] != cut[start]:
            yield batch.slice(start, i - start)
            start = i
