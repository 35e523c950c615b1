"""Joins of fields, thresholds, files and lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .windows import common_keys


def align_inner(a: DataFrame, b: DataFrame, keys: list[str], names: tuple[str, str]) -> DataFrame:
    """keys and both values, on common keys."""
    x, y = a.select(*keys, F.col("value").alias(names[0])), b.select(*keys, F.col("value").alias(names[1]))
    return x.join(y, keys)


def align_pairs(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """keys and matched: whether both sides have the key."""
    x, y = a.select(*keys).distinct().withColumn("a", F.lit(True)), b.select(*keys).distinct().withColumn("b", F.lit(True))
    return x.join(y, keys, "full").select(*keys, (F.col("a").isNotNull() & F.col("b").isNotNull()).alias("matched"))


def merge_variables(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    return a.join(b, keys, "full")


def doy_threshold_join(df: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Each day with its series' threshold for the day of the year: thresholds(series keys, doy, threshold), joined on the keys of both."""
    return df.join(thresholds, [*common_keys(df, thresholds), "doy"])


def temporal_containment(dates: DataFrame, files: DataFrame, keys: list[str]) -> DataFrame:
    """dates(keys, date) with the file whose [start, stop] holds the date: files(keys, filename, start, stop); n_matches must be 1.

    File spans are cut at year ends into an equi key, so the range is compared within a key's year only.
    """
    years = F.explode(F.sequence(F.year("start"), F.year("stop")))
    f = files.select(*keys, "filename", "start", "stop", years.alias("__year"))
    both = dates.withColumn("__year", F.year("date")).join(f, [*keys, "__year"], "left")
    inside = F.col("date").between(F.col("start"), F.col("stop"))
    return both.groupBy(*keys, "date").agg(F.count_if(inside).alias("n_matches"), F.min(F.when(inside, F.col("filename"))).alias("filename"))


def file_span(name: Column) -> tuple[Column, Column]:
    """First and last day that a file name's YYYYMM-YYYYMM says."""
    part = lambda i: F.regexp_extract(name, r"(\d{6})-(\d{6})\.nc$", i)
    day = lambda p: F.to_date(F.when(p != "", p), "yyyyMM")
    return day(part(1)), F.last_day(day(part(2)))


def time_nearest(df: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """wanted(keys, at): the value at that date, or else at the nearest one (the earlier of two as near).

    Neighbours on both sides come from running windows over the union, so no date is paired with all others.
    """
    known = df.where("value is not null").select(*keys, F.col("date").alias("t"), F.struct(F.col("date"), F.col("value")).alias("point"), F.lit(False).alias("asked"))
    both = known.unionByName(wanted.select(*keys, F.col("at").alias("t"), F.lit(None).alias("point"), F.lit(True).alias("asked")))
    by = Window.partitionBy(*keys).orderBy("t")
    both = both.withColumn("b", F.last("point", True).over(by.rangeBetween(Window.unboundedPreceding, 0))).withColumn("a", F.last("point", True).over(Window.partitionBy(*keys).orderBy(F.desc("t")).rangeBetween(Window.unboundedPreceding, 0)))
    near = F.when(F.col("a").isNull() | (F.datediff("t", "b.date") <= F.datediff("a.date", "t")), F.col("b")).otherwise(F.col("a"))
    return both.where("asked").select(*keys, F.col("t").alias("at"), near.alias("p")).select(*keys, "at", F.col("p.date").alias("date"), F.col("p.value").alias("value"))


def lookup(df: DataFrame, dim: DataFrame, on: list[str]) -> DataFrame:
    """Left join with a dimension table. Spark broadcasts it if its measured bytes are under its own threshold, and shuffles otherwise."""
    return df.join(dim, on, "left")


def institution(model: Column, activity: Column, names: Column) -> Column:
    """Of a model's institutions the first for historical runs, the second (if any) for others."""
    return F.when((activity == "CMIP") | (F.size(names) < 2), F.get(names, 0)).otherwise(F.get(names, 1))


def expected_vs_existing(dims: list[DataFrame], existing: DataFrame) -> DataFrame:
    """Combinations of the dimensions that aren't in existing. The combinations are what is asked for, so the dimensions are crossed."""
    wanted = dims[0]
    for d in dims[1:]:
        wanted = wanted.crossJoin(d)
    return wanted.join(existing.select(*wanted.columns).distinct(), wanted.columns, "left_anti")


def validate_source(trained: DataFrame, simulated: DataFrame, key: str = "model") -> DataFrame:
    """Simulated sources that no trained map has."""
    return simulated.select(key).distinct().join(trained.select(key).distinct(), key, "left_anti")


def triplets(a: DataFrame, b: DataFrame, c: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """keys and a presence flag for each of three file sets."""
    out = None
    for df, n in zip((a, b, c), names):
        one = df.select(*keys).distinct().withColumn(n, F.lit(True))
        out = one if out is None else out.join(one, keys, "full")
    return out.select(*keys, *(F.coalesce(n, F.lit(False)).alias(n) for n in names))
