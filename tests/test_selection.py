"""Order statistics of large groups against sorted arrays, with bounds so small that groups are taken apart for several rounds."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.operators import aggregate, selection, windows

P = [0.0, 0.25, 0.5, 0.9, 1.0]


@pytest.fixture(scope="module")
def groups(spark):
    """g, value: one group with a third of ties, one of two values only, one wide, one small, one without data, one of a null key."""
    r = np.random.default_rng(7)
    parts = {
        "ties": np.where(r.random(9000) < 0.34, 0.0, np.round(r.normal(size=9000), 2)),
        "two": np.repeat([1.0, 2.0], [5001, 4999]),
        "wide": np.concatenate([r.normal(size=9000) * 1e-6, [1e12, -1e12, 1e9]]),
        "same": np.full(4000, -3.5),
        "small": r.random(40),
        None: r.random(5000),
    }
    rows = [(g, float(v)) for g, values in parts.items() for v in values]
    rows += [("none", None), ("none", float("nan")), ("small", None), ("ties", None), ("wide", float("nan"))]
    return parts, spark.createDataFrame(rows, "g string, value double").repartition(5).cache()


@pytest.mark.parametrize("bound", [30, 500, 1 << 18])
def test_percentiles(groups, bound):
    parts, df = groups
    got = {r["g"]: r["q"] for r in selection.percentiles(df, ["g"], P, bound=bound).collect()}
    assert got.keys() == parts.keys()
    for g, values in parts.items():
        assert got[g] == pytest.approx(np.quantile(values, P).tolist(), rel=1e-12, abs=1e-15), g


def test_whole_table_integers_and_empty(spark, groups):
    ints = spark.range(20_000).select((F.col("id") * 7919 % 20_011).alias("n"))
    want = np.quantile(np.arange(20_000) * 7919 % 20_011, P)
    assert selection.percentiles(ints, [], P, "n", 100).first()["q"] == pytest.approx(want.tolist())
    none = groups[1].where("false")
    assert selection.percentiles(none, ["g"], P, bound=10).collect() == []
    assert selection.percentiles(none, [], P, bound=10).collect() == []
    assert selection.cumulative(none, ["g"], bound=10).collect() == []


@pytest.mark.parametrize("bound", [30, 1 << 18])
def test_cumulative(groups, bound):
    parts, df = groups
    df = df.where("not isnan(value)")
    out = selection.cumulative(df.withColumn("row", F.monotonically_increasing_id()), ["g"], bound=bound)
    assert out.columns == ["g", "value", "row", "cdf"]
    got = out.collect()
    for g, values in parts.items():
        own = sorted((r["value"], r["cdf"]) for r in got if r["g"] == g)
        ordered = np.sort(values)
        assert [v for v, _ in own] == ordered.tolist()
        assert [c for _, c in own] == pytest.approx((np.searchsorted(ordered, ordered, side="right") / len(ordered)).tolist())
    assert len(got) == sum(map(len, parts.values()))


def test_users(spark, groups):
    df = groups[1].where("g is not null and not isnan(value)")
    a = {r["g"]: r for r in aggregate.distribution_summary(df, ["g"]).collect()}
    for g, values in groups[0].items():
        if g:
            q1, q2, q3 = np.quantile(values, [0.25, 0.5, 0.75])
            inside = values[(values >= q1 - 1.5 * (q3 - q1)) & (values <= q3 + 1.5 * (q3 - q1))]
            assert [a[g][n] for n in ("q1", "q2", "q3", "low", "high")] == pytest.approx([q1, q2, q3, inside.min(), inside.max()])
    assert windows.ecdf(df, ["g"]).where("cdf = 1").select("g").distinct().count() == 5
