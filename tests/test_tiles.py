"""Tables of tiles in buckets of cells: what works on series runs without a shuffle."""

import uuid

import pytest
from pyspark.sql import functions as F

from gridloom.operators import bias, indicators, windows
from gridloom.plans.inputs import member, members
from gridloom.plans.q_select import shared_path
from gridloom.sources import fields


@pytest.fixture(scope="module")
def stored(spark, sf):
    """One table of tiles for each variable."""
    out = {}
    for v in ("pr", "tasmax", "tasmin"):
        name = f"tiles_{uuid.uuid4().hex}"
        fields.write_tiles(member(spark, sf, v), name, shared_path(spark, "tiles"), 4)
        out[v] = fields.read_tiles(spark, name)
    return out


def plan(df):
    spark = df.sparkSession
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.requireAllClusterKeysForCoPartition")}
    try:
        for k, v in zip(before, ("false", "-1", "false")):
            spark.conf.set(k, v)
        return df.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_there_and_back(spark, sf, stored):
    want = {(r["model"], r["scenario"], r["cell_id"], r["date"]): r["value"] for r in member(spark, sf, "pr").where("doy is not null and value is not null").collect()}
    got = {(r["model"], r["scenario"], r["cell_id"], r["date"]): (r["value"], r["doy"], r["month"]) for r in stored["pr"].collect()}
    assert {k: v for k, (v, _, _) in got.items()} == want and all(m == k[3].month for k, (_, _, m) in got.items())


def test_no_shuffle_on_series(stored):
    """Window quantiles, ranks, means, percentiles, runs and yearly aggregates."""
    pr, tasmax = stored["pr"], stored["tasmax"]
    for df in (
        windows.doy_window_quantiles_per_cell(pr, 5, 15),
        windows.rank_in_doy_window(pr, 15),
        windows.doy_window_means(pr, 15),
        windows.percentile_doy(pr, 0.9),
        windows.rolling_sum(pr, 5),
        indicators.run_indicators(pr.withColumnRenamed("value", "pr"), ["rx1day", "rx5day", "cwd", "cdd", "r10mm"]),
        indicators.run_indicators(tasmax.withColumnRenamed("value", "tasmax"), ["wsdi", "su"]),
    ):
        assert "Exchange" not in plan(df)
    assert "Exchange" in plan(windows.percentile_doy(pr.drop("cell_id").withColumn("cell_id", F.col("year").cast("long")), 0.9))


def test_indicators_equal(spark, sf, stored):
    """Indicators of two tables of tiles side by side are those of the long table without its leap days."""
    on = ["model", "scenario", "cell_id", "year", "doy", "date", "month"]
    both = stored["pr"].withColumnRenamed("value", "pr").join(stored["tasmax"].withColumnRenamed("value", "tasmax"), on)
    whole = members(spark, sf).where("doy is not null and pr is not null").select(*on, "pr", "tasmax")
    names = ["rx1day", "rx5day", "cwd", "wsdi", "su"]
    assert sorted(map(str, indicators.run_indicators(both.select(*on, "pr", "tasmax"), names).collect())) == sorted(map(str, indicators.run_indicators(whole, names).collect()))


def test_bias_training(stored):
    """The long form of tiles trains and adjusts as any other."""
    hist, later = (stored["pr"].where(f"scenario = '{s}'") for s in ("historical", "ssp585"))
    ref = hist.where("model = 'm0'").drop("model", "scenario")
    qmap = bias.qdm_train(ref, hist, "+", 5, 15)
    assert bias.qdm_adjust(qmap, later, "+", 5, 15).count() == later.count()
