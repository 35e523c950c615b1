"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared_dir


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("u"), F.col("v")).union(edges.select(F.col("v"), F.col("u")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame) -> DataFrame:
    """edges(u, v), one row per link, self links ignored: returns (u, root) for every linked node but the roots themselves.

    root is the smallest node of the component. A step moves every edge towards the smallest node it can see, so the number of
    rounds grows with the logarithm of the longest path. Each round is checkpointed in the shared folder. No links: no rows.
    """
    shared_dir(edges.sparkSession)
    now = edges.where("u <> v").select("u", "v").distinct().checkpoint()
    before = _signature(now)
    while before[0]:
        now = _small_star(_large_star(now)).checkpoint()
        after = _signature(now)
        if after == before:
            break
        before = after
    return now.select("u", F.col("v").alias("root"))
