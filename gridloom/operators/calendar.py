"""Calendars and time resampling."""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import noleap_doy


def resample_daily(hourly: DataFrame, rules: dict[str, str], key: str = "cell_id", ts: str = "ts", value: str = "value") -> DataFrame:
    """One row per key and day; rules name the output columns: min, mean, max or sum. The sum of a day without data is 0."""
    how = {"min": F.min, "mean": F.avg, "max": F.max, "sum": lambda c: F.coalesce(F.sum(c), F.lit(0.0))}
    return hourly.groupBy(key, F.to_date(ts).alias("date")).agg(*(how[r](value).alias(name) for name, r in rules.items()))


def gregorian_to_noleap(df: DataFrame) -> DataFrame:
    """Without 29 February, and with doy in 1..365."""
    return df.withColumn("doy", noleap_doy(F.col("date"))).where("doy is not null")


def inserted_days(years: list[int]) -> list[tuple[int, int, int]]:
    """(year, i, r): in a 360-day year, day i of five is put before 0-based day r, drawn from each 72 days with the year as seed."""
    out = []
    for year in years:
        rng = random.Random(year)
        for i in range(5):
            r = rng.randrange(72 * i, 72 * (i + 1))
            out.append((year, i, min(r, 358)))
    return out


def cal360_to_noleap(df: DataFrame, first_year: int, last_year: int, keys: list[str] = ("cell_id",)) -> DataFrame:
    """keys, year, doy360 (1..360), value to 365 days: five days a year are inserted with the mean of their neighbours, or the one of the two that
    has data; null if neither has."""
    spark = df.sparkSession
    days = F.broadcast(spark.createDataFrame(inserted_days(list(range(first_year, last_year + 1))), "year int, i int, r int"))
    # Each day is a neighbour of the days inserted after it (r = its 0-based place) and before it (r = the place before).
    beside = df.select(*keys, "year", "value", F.explode(F.array(F.col("doy360") - 1, F.col("doy360") - 2)).alias("r"))
    added = beside.join(days, ["year", "r"]).groupBy(*keys, "year", "r", "i").agg(F.avg("value").alias("value")).select(*keys, "year", (F.col("r") + F.col("i") + 1).alias("doy"), "value")
    rs = days.groupBy("year").agg(F.array_sort(F.collect_list("r")).alias("rs"))
    moved = df.join(F.broadcast(rs), "year").withColumn("doy", (F.col("doy360") + F.size(F.filter("rs", lambda r: r <= F.col("doy360") - 1))).cast("int"))
    return moved.select(*keys, "year", "doy", "value").unionByName(added.withColumn("doy", F.col("doy").cast("int")))


def fix_hour_12(date: Column) -> Column:
    return F.make_timestamp_ntz(F.year(date), F.month(date), F.dayofmonth(date), F.lit(12), F.lit(0), F.lit(0))


def month_to_15th(date: Column) -> Column:
    return F.make_date(F.year(date), F.month(date), F.lit(15))


def infer_frequency(df: DataFrame, source: str = "source") -> DataFrame:
    """source, gap_days and frequency, from the second and third time of each source."""
    order = Window.partitionBy(source).orderBy("date")
    ranked = df.select(source, "date").distinct().withColumn("n", F.row_number().over(order)).where("n in (2, 3)")
    gap = F.datediff(F.max("date"), F.min("date"))
    out = ranked.groupBy(source).agg(gap.alias("gap_days"))
    return out.withColumn("frequency", F.when(F.col("gap_days") == 1, "day").when(F.col("gap_days").between(28, 31), "mon"))


def align_time(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """keys and dates that only one of two series has: empty if they are aligned to the day."""
    x, y = (d.select(*keys, F.to_date("date").alias("date")).distinct() for d in (a, b))
    return x.exceptAll(y).withColumn("only_in", F.lit("a")).unionByName(y.exceptAll(x).withColumn("only_in", F.lit("b")))


def expected_outputs(df: DataFrame, monthly: bool = False, source: str = "source") -> DataFrame:
    """source, year and the time part of the file name that each year of a source gives."""
    out = df.groupBy(source, F.year("date").alias("year")).agg(F.min(F.month("date")).alias("m1"), F.max(F.month("date")).alias("m2"))
    form = "%d%02d-%d%02d" if monthly else "%d%02d01-%d%02d31"
    return out.select(source, "year", F.format_string(form, "year", "m1", "year", "m2").alias("timeframe"))


def year_month(date: Column) -> Column:
    return F.trunc(date, "month")


def year_start_end(df: DataFrame, key: str = "cell_id") -> DataFrame:
    out = df.groupBy(key, F.year("date").alias("year")).agg(F.min("date").alias("first"), F.max("date").alias("last"))
    return out.withColumn("timeframe", F.concat_ws("-", F.date_format("first", "yyyyMMdd"), F.date_format("last", "yyyyMMdd")))
