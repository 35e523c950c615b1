"""Summaries of fields. Reductions skip null unless they say otherwise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .select import COMPARE
from .selection import percentiles
from .windows import common_keys, member_keys, series_keys


def doy_stats(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    return df.where("doy is not null").groupBy(*(keys or series_keys(df)), "doy").agg(F.min("value").alias("min"), F.avg("value").alias("mean"), F.max("value").alias("max"))


def monthly_climatology(df: DataFrame) -> DataFrame:
    return df.groupBy(*series_keys(df), "month").agg(F.avg("value").alias("mean"))


def period_mean(df: DataFrame, first: int, last: int, keys: list[str] | None = None) -> DataFrame:
    return df.where(F.col("year").between(first, last)).groupBy(*(keys or series_keys(df))).agg(F.avg("value").alias("mean"))


def doy_deltas(adjusted: DataFrame, simulated: DataFrame) -> DataFrame:
    """Series keys of both, doy, delta and proportion of two DOY means. A table without models serves all models of the other."""
    a, s = (doy_stats(d).withColumnRenamed("mean", n) for d, n in ((adjusted, "a"), (simulated, "s")))
    both = a.join(s, [*common_keys(adjusted, simulated), "doy"])
    keys = series_keys(both)
    return both.select(*keys, "doy", (F.col("a") - F.col("s")).alias("delta"), F.try_divide(F.col("a") - F.col("s"), F.col("s")).alias("proportion"))


def domain_summary(deltas: DataFrame) -> DataFrame:
    """A row for each member, over all its cells and days."""
    d, p = F.col("delta"), F.abs(F.col("proportion"))
    return deltas.groupBy(*member_keys(deltas)).agg(F.min(d).alias("min"), F.max(d).alias("max"), F.avg(d).alias("mean"), F.stddev_pop(d).alias("std"), F.avg(p).alias("mean_proportion"), F.max(p).alias("max_proportion"))


def delta_maps(deltas: DataFrame) -> DataFrame:
    return deltas.groupBy(*series_keys(deltas)).agg(F.min("delta").alias("min"), F.max("delta").alias("max"), F.avg("delta").alias("mean"))


def count_exceed(df: DataFrame, threshold: float) -> DataFrame:
    """Days over the threshold by series, and over each member's domain in its row without a cell."""
    own = [F.col(k) for k in member_keys(df)]
    return df.groupingSets([[*own, F.col("cell_id")], own], *own, "cell_id").agg(F.count_if(F.col("value") > threshold).alias("n_days"))


def count_out_of_range(df: DataFrame, low: float, high: float, keys: list[str]) -> DataFrame:
    v = F.col("value")
    return df.groupBy(*keys).agg(F.count_if((v < low) | (v > high)).alias("n_out"))


def pct_condition(df: DataFrame, op: str, value: float, keys: list[str]) -> DataFrame:
    """Per cent of all rows that meet the condition, nulls in the denominator; null for a series without data."""
    hit = F.count_if(COMPARE[op](F.col("value"), value))
    return df.groupBy(*keys).agg(F.when(F.count("value") > 0, 100.0 * hit / F.count("*")).alias("pct"))


def min_max(df: DataFrame, inside: Column, keys: list[str]) -> DataFrame:
    """Extremes inside a box, or over the whole extent for a series of which nothing lies in it."""
    v, i = F.col("value"), F.when(inside, F.col("value"))
    return df.groupBy(*keys).agg(F.coalesce(F.min(i), F.min(v)).alias("min"), F.coalesce(F.max(i), F.max(v)).alias("max"))


def rmse(a: DataFrame, b: DataFrame, keys: list[str], by: list[str] = ()) -> DataFrame:
    both = a.select(*keys, F.col("value").alias("__a")).join(b.select(*keys, F.col("value").alias("__b")), keys)
    d = F.col("__a") - F.col("__b")
    return both.groupBy(*by).agg(F.sqrt(F.avg(d * d)).alias("rmse"), F.count("*").alias("n"))


def nunique_by(df: DataFrame, of: list[str], by: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.countDistinct(F.struct(*of)).alias("n"))


def extent_summary(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*(f(c).alias(f"{c}_{n}") for c in ("year", "lat", "lon") for f, n in ((F.min, "min"), (F.max, "max"))))


def grid_signature(grid: DataFrame, keys: list[str]) -> DataFrame:
    """Least, greatest, size and first step of each axis, their text and a rank gr0, gr1... of distinct texts."""
    parts = []
    for axis in ("lat", "lon"):
        own = grid.select(*keys, axis).distinct().groupBy(*keys).agg(F.min(axis).alias("a"), F.max(axis).alias("b"), F.count(axis).alias("n"), F.slice(F.array_sort(F.collect_set(axis)), 1, 2).alias("two"))
        step = F.get("two", 1) - F.get("two", 0)
        parts.append(own.select(*keys, F.concat_ws("_", *(F.format_number(c, 2) for c in ("a", "b")), "n", F.format_number(step, 2)).alias(axis)))
    signed = parts[0].join(parts[1], keys).select(*keys, F.concat_ws("|", "lat", "lon").alias("signature"))
    # Distinct grids are few (one or two a model), so that their order is a small matter.
    ranks = signed.select("signature").distinct().withColumn("grid", F.concat(F.lit("gr"), F.row_number().over(Window.orderBy("signature")) - 1))
    return signed.join(ranks, "signature").select(*keys, "signature", "grid")


def value_counts(df: DataFrame, by: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("n"))


def distribution_summary(df: DataFrame, keys: list[str]) -> DataFrame:
    """Exact quartiles of groups of any size, and the whiskers of the values within 1.5 quartile ranges of them."""
    q = percentiles(df, keys, [0.25, 0.5, 0.75]).select(*keys, *(F.col("q")[i].alias(n) for i, n in enumerate(("q1", "q2", "q3"))))
    spread = 1.5 * (F.col("q3") - F.col("q1"))
    inside = df.join(q, keys).where(F.col("value").between(F.col("q1") - spread, F.col("q3") + spread))
    return inside.groupBy(*keys, "q1", "q2", "q3").agg(F.min("value").alias("low"), F.max("value").alias("high"))


def total_size(df: DataFrame, by: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("n_files"), (F.sum("bytes") / 1e12).alias("terabytes"))


def max_by_group(df: DataFrame, by: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.max("value").alias("max"))


def strict_total(df: DataFrame, keys: list[str]) -> DataFrame:
    """Sum and mean that are null if any value is; a total of 0 is null too."""
    whole = F.count("value") == F.count("*")
    return df.groupBy(*keys).agg(F.nullif(F.when(whole, F.sum("value")), F.lit(0.0)).alias("total"), F.when(whole, F.avg("value")).alias("mean"))


def mask_fraction(df: DataFrame, land: DataFrame, tolerance: float = 0.2) -> DataFrame:
    """For each member the share of cells without data at their first time against the share that isn't land: land(cell_id, is_land)."""
    first = df.groupBy(*series_keys(df)).agg(F.min_by(F.struct("value"), "date")["value"].isNull().cast("double").alias("empty"))
    both = first.join(land, "cell_id").groupBy(*member_keys(df)).agg(F.avg("empty").alias("masked"), F.avg((~F.col("is_land")).cast("double")).alias("expected"))
    return both.withColumn("good", F.abs(F.col("masked") - F.col("expected")) < tolerance)
