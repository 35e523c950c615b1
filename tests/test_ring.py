"""Day-of-year percentiles from a ring of days against pools of repeated rows."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.functions.scalar import noleap_doy, quantile_type8
from gridloom.operators import indicators, windows


@pytest.fixture(scope="module")
def series(spark):
    """Series that begin and end anywhere, with leap days at their ends, gaps, nulls, a single day, and one without data."""
    rng, rows = np.random.default_rng(4), []
    spans = [(1, dt.date(1999, 12, 30), 800), (2, dt.date(2000, 2, 28), 3), (3, dt.date(2000, 2, 29), 1), (4, dt.date(2003, 3, 1), 366), (5, dt.date(1996, 2, 29), 1462), (6, dt.date(2001, 7, 7), 40)]
    for cell, first, n in spans:
        for i in range(n):
            if i in (0, n - 1) or rng.random() > 0.05:
                v = None if cell == 6 or rng.random() < 0.1 else round(float(rng.gamma(2, 3)), 1)
                rows.append(("a" if i % 9 else "b", cell, first + dt.timedelta(days=i), v, None if v is None else -v))
    df = spark.createDataFrame(rows, "model string, cell_id long, date date, value double, low double")
    return df.withColumn("doy", noleap_doy(F.col("date"))).cache()


@pytest.mark.parametrize("window", [1, 3, 5, 7])
def test_ring_and_pools_agree(series, window):
    pools = windows.pooled(series, window // 2).groupBy("model", "cell_id", "doy").agg(F.array_sort(F.collect_list("value")).alias("v"))
    want = {tuple(r)[:3]: r[3] for r in pools.select("model", "cell_id", "doy", quantile_type8(F.col("v"), 0.9)).collect()}
    got = {tuple(r)[:3]: r[3] for r in windows.percentile_doy(series, 0.9, window).collect()}
    assert got == want and len(got) > 500


def test_several_percentiles_at_once(series):
    both = windows.doy_percentiles(series, {"hot": ("value", 0.9), "cold": ("low", 0.1)}).select("model", "cell_id", F.posexplode("limits").alias("at", "x")).select("model", "cell_id", (F.col("at") + 1).alias("doy"), "x.hot", "x.cold")
    one = {n: {tuple(r)[:3]: r[3] for r in windows.percentile_doy(series.withColumn("value", F.col(c)), p).collect()} for n, c, p in (("hot", "value", 0.9), ("cold", "low", 0.1))}
    for r in both.collect():
        key = tuple(r)[:3]
        assert r["hot"] == one["hot"].get(key) and r["cold"] == one["cold"].get(key)


def test_each_value_is_shuffled_once(series):
    plan = windows.percentile_doy(series.select("model", "cell_id", "date", "value"), 0.9)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_indicators_share_shuffles(series):
    """One shuffle of the data and one of its history, for aggregates, runs and percentiles."""
    df = series.select("model", "cell_id", "date", "doy", F.year("date").alias("year"), F.col("value").alias("pr"), F.col("value").alias("tasmax"), F.col("low").alias("tasmin"))
    spark = df.sparkSession
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for k, v in zip(before, ("false", "-1")):
            spark.conf.set(k, v)
        out = indicators.run_indicators(df, ["wsdi", "csdi", "cwd", "rx5day", "su"])
        assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert out.count() > 0


def test_base_period(series):
    """Normals come from the base period's years alone."""
    df = series.select("model", "cell_id", "date", "doy", F.year("date").alias("year"), F.col("value").alias("tasmax"), F.col("low").alias("tasmin"))
    some = indicators.day_limits(df, "tasmax", 0.9, base=(1996, 1997))
    assert {tuple(r) for r in some.collect()} == {tuple(r) for r in indicators.day_limits(df.where("year(date) between 1996 and 1997"), "tasmax", 0.9).collect()}
    a = indicators.run_indicators(df, ["wsdi"], base=(1996, 1997)).collect()
    b = indicators.run_indicators(df, ["wsdi"], hist=df.where("year between 1996 and 1997")).collect()
    assert sorted(map(str, a)) == sorted(map(str, b))
