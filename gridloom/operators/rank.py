"""Top rows, samples, versions and batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_cells(counts: DataFrame, n: int = 6, col: str = "n_days") -> DataFrame:
    """The n cells with the most days; none unless n cells have any."""
    top = counts.where(F.col(col) > 0).orderBy(F.desc(col), "cell_id").limit(n)
    return top.withColumn("__m", F.count("*").over(Window.partitionBy())).where(F.col("__m") >= n).drop("__m")


def latest_version(files: DataFrame, keys: list[str], version: str = "version") -> DataFrame:
    """files with superseded: whether a later version of the same file exists."""
    last = files.groupBy(*keys).agg(F.max(version).alias("__last"))
    return files.join(last, keys).withColumn("superseded", F.col(version) < F.col("__last")).drop("__last")


def subsample_size(n: int, pct: float = 10, least: int = 20, most: int = 75) -> int:
    """All of up to `least`, else pct per cent, but no more than `most`."""
    return n if n <= least else min(most, max(1, int(n * pct / 100)))


def subsample(df: DataFrame, key: str, pct: float = 10, least: int = 20, most: int = 75, seed: int = 0) -> DataFrame:
    return df.orderBy(F.md5(F.concat_ws(":", F.col(key), F.lit(seed)).cast("binary")), key).limit(subsample_size(df.count(), pct, least, most))


def n_per_batch(df: DataFrame, by: list[str], order: list[str], n: int) -> DataFrame:
    """Adds batch: consecutive chunks of n within each group."""
    return df.withColumn("batch", F.floor((F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1) / n))


def pack_batches(files: DataFrame, by: list[str], name: str = "path", size: str = "bytes", max_bytes: int = 50_000_000_000, max_n: int = 200) -> DataFrame:
    """by, name and batch: files in order of name (then size) fill a batch until either limit would be passed. A file over the limit is a batch of its own.

    Each file's batch depends on the ones before it, so a group is passed through in order by one task, which keeps only the open batch.
    """
    rows = files.select(*by, name, F.coalesce(F.col(size).cast("long"), F.lit(0)).alias("__size")).repartition(*by).sortWithinPartitions(*by, name, "__size")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, batch, total, held = None, 0, 0, 0
        for b in batches:
            out = []
            for *now, bytes_ in zip(*(b.column(c).to_pylist() for c in [*by, "__size"])):
                if now != group:
                    group, batch, total, held = now, 0, 0, 0
                elif total + bytes_ > max_bytes or held >= max_n:
                    batch, total, held = batch + 1, 0, 0
                total, held = total + bytes_, held + 1
                out.append(batch)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in [*by, name]), pa.array(out, pa.int64())], names=[*by, name, "batch"])

    return rows.mapInArrow(run, rows.select(*by, name).schema.add("batch", "long"))


def sort_variants(files: DataFrame, scenarios: list[str]) -> DataFrame:
    """Distinct (table, variable) pairs of each model and variant by scenario, most historical ones first."""
    pairs = files.groupBy("model", "variant").pivot("scenario", scenarios).agg(F.countDistinct("table_id", "variable"))
    filled = pairs.na.fill(0)
    return filled.orderBy(F.desc("historical"), "model", "variant")
