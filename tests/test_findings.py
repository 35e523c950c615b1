"""Cases in which queries of larger tables went wrong."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.operators import bias, curvilinear, kernel, nearest, qc, regrid, windows
from gridloom.plans import catalogue
from gridloom.plans.inputs import member


def test_tiles_query_has_tables_of_its_own(spark, sf):
    run = catalogue.queries()["s6_bucketed_tiles"]
    a, b = run(spark, sf), run(spark, sf)
    days = member(spark, sf, "pr").where("doy is not null and value is not null").select("model", "scenario", "cell_id").distinct().count()
    assert a.select("model", "scenario", "cell_id").distinct().count() == days
    assert a.exceptAll(b).count() == 0


def test_attributes_of_a_path_that_is_listed_twice(spark):
    files = spark.createDataFrame([("a/x.nc", "x"), ("a/x.nc", "x"), ("b/y.nc", "y")], "path string, variable string")
    claimed = spark.createDataFrame([("a/x.nc", "z"), ("a/x.nc", "x"), ("b/y.nc", None)], "path string, variable string")
    got = qc.validate_attrs(files, claimed, "path", ["variable"]).collect()
    assert sorted(map(tuple, got)) == [("a/x.nc", "variable"), ("b/y.nc", "variable")]


def test_tail_of_the_cvm_law_far_out():
    n = np.full(4, 2500.0)
    t = np.array([0.17, 5.0, 12.0, 600.0])
    tail = windows._cvm_tail(t, n, n)
    assert 0.3 < tail[0] < 0.4 and tail[1:].max() < 1e-9
    # The SQL's sum of twelve terms gave 0.036 where the statistic is 241.
    body = catalogue.oracle_sql()["w9_cvm_statistic"].split(", u AS (")[0].rsplit("x AS (", 1)[0]
    ends = catalogue.oracle_sql()["w9_cvm_statistic"][len(body):]
    sql = f"WITH t AS (SELECT 'm' AS model, 's' AS scenario, 0 AS cell_id, 2499e0 AS n, 1021e0 AS m, unnest([0.17e0, 5e0, 241.6e0]) AS statistic), {ends}"
    p = [r[-1] for r in duckdb.sql(sql).fetchall()]
    assert p[0] == pytest.approx(windows._cvm_tail(np.array([0.17]), np.array([2499.0]), np.array([1021.0]))[0], abs=2e-5) and p[1:] == [0, 0]


def test_conservative_weights_at_and_over_a_pole(spark):
    axis = "cell_id long, iy int, ix int, lat double, lon double"
    grid = lambda lats: spark.createDataFrame([(2 * j + i, j, i, float(v), 10.0 * i) for j, v in enumerate(lats) for i in range(2)], axis)
    total = lambda w: [r["t"] for r in w.groupBy("dst_cell").agg(F.sum("w").alias("t")).collect()]
    # Ends of an axis stop at the pole; an interval that lies evenly about a pole has no measure and gives no weights instead of an error.
    assert total(regrid.weights_conservative(grid([86, 87, 88, 89, 90]), grid([87.5, 88.5, 89.5]))) == pytest.approx([1.0] * 6)
    assert sorted({r["dst_cell"] for r in regrid.weights_conservative(grid([80, 85, 90, 95, 100]), grid([85, 90, 95])).collect()}) == [0, 1, 4, 5]


def test_cells_of_no_extent_meet_nothing(spark):
    ring = "cell_id long, ring array<struct<lat:double,lon:double>>"
    box = lambda n, lat, lon, a: (n, [{"lat": lat, "lon": lon}, {"lat": lat, "lon": lon + a}, {"lat": lat + a, "lon": lon + a}, {"lat": lat + a, "lon": lon}])
    points = [(n, [{"lat": -90.0, "lon": float(n)}] * 4) for n in range(100, 140)]
    fine = [box(10 * j + i, 10.0 + j, 20.0 + i, 1.0) for j in range(10) for i in range(10)]
    w = curvilinear.weights_conservative_cells(spark.createDataFrame(fine + points, ring), spark.createDataFrame([box(1, 10.0, 20.0, 8.0), box(2, 12.2, 22.2, 0.5), box(3, -10.0, 20.0, 5.0), *points], ring)).collect()
    assert {r["dst_cell"] for r in w} == {1, 2} and {r["src_cell"] for r in w if r["dst_cell"] == 2} == {22}
    assert sum(r["w"] for r in w if r["dst_cell"] == 1) == pytest.approx(1, abs=2e-3) and len(w) == len({(r["src_cell"], r["dst_cell"]) for r in w})


def test_nearest_far_and_near(spark):
    """Points beside many cells settle in the cubes around them; points on the other side of the sphere, and ties, come from the tree. Against all pairs."""
    rng = np.random.default_rng(4)
    place = [(n, float(rng.uniform(40, 60)), float(rng.uniform(0, 40))) for n in range(400)] + [(400, *(50.0, 20.0)), (401, *(50.0, 20.0)), (402, None, 1.0)]
    points = [(n, float(rng.uniform(40, 60)), float(rng.uniform(0, 40))) for n in range(200)] + [(200, -50.0, -160.0), (201, 50.0, 20.0), (202, -90.0, 0.0), (203, 90.0, 5.0), (204, None, 2.0)]
    frame = lambda rows: spark.createDataFrame(rows, "cell_id long, lat double, lon double")
    got = {r["k"]: (r["cell_id"], r["km"]) for r in nearest.nearest_cells(frame(place), frame(points).withColumnRenamed("cell_id", "k"), "k").collect()}
    assert got.keys() == set(range(204))
    lat, lon = np.radians([p[1:] for p in place[:402]]).T
    for n, a, b in points[:204]:
        x, y = np.radians([a, b])
        km = 2 * 6371 * np.arcsin(np.sqrt(np.minimum(1, np.sin((lat - x) / 2) ** 2 + np.cos(lat) * np.cos(x) * np.sin((lon - y) / 2) ** 2)))
        assert got[n] == (min(range(402), key=lambda k: (round(km[k], 6), k)), pytest.approx(km.min(), abs=1e-5))
    assert nearest.nearest_cells(frame(place).where("false"), frame(points).withColumnRenamed("cell_id", "k"), "k").count() == 0


def test_nearest_pairs_follow_the_points(spark, monkeypatch):
    """No point of an even grid needs the tree."""
    monkeypatch.setattr(nearest, "_down_the_tree", None)
    grid = spark.range(20000).select(F.col("id").alias("cell_id"), (F.floor(F.col("id") / 200) * 1.8 - 89).alias("lat"), ((F.col("id") % 200) * 1.8 - 180).alias("lon"))
    assert nearest.nearest_cells(grid, grid.withColumnRenamed("cell_id", "k"), "k").where("k <> cell_id").count() == 0


def test_nearest_quantile_of_two_as_near_but_for_rounding(spark):
    """0.3 is as far from 0.1 + 0.2 - 0.25 as from 0.55, but not in binary."""
    value, low, high = 0.3, 0.05 - 4e-16, 0.55 - 1e-15
    assert abs(low - value) != abs(high - value)
    qmap = spark.createDataFrame([(1, 5, 0, low, 10.0), (1, 5, 1, high, 20.0)], "cell_id long, doy int, q_idx int, hist_q double, af double")
    sim = spark.createDataFrame([(1, 5, value)], "cell_id long, doy int, value double")
    assert bias.eqm_adjust(qmap, sim).first()["value"] == value + 10.0
    k = object.__new__(kernel.Kernel)
    k.kind = "+"
    found = (np.array([[low, high]]), np.array([[10.0, 20.0]]))
    assert k._nearest(found, np.array([0]), np.array([value])).tolist() == [value + 10.0]
    found = (np.array([[high, low]]), np.array([[10.0, 20.0]]))
    assert k._nearest(found, np.array([0]), np.array([value])).tolist() == [value + 10.0]


def test_bilinear_of_twisted_squares(spark):
    """Every weighted place is where the point is, though squares may be twisted: roots that aren't real don't count."""
    rng = np.random.default_rng(5)
    src = [(6 * j + i, j, i, float(j + rng.normal()), float(i + rng.normal())) for j in range(6) for i in range(6)]
    points = [(n, float(rng.uniform(0, 5)), float(rng.uniform(0, 5))) for n in range(60)]
    unit = lambda a, b: np.array([np.cos(np.radians(a)) * np.cos(np.radians(b)), np.cos(np.radians(a)) * np.sin(np.radians(b)), np.sin(np.radians(a))])
    grid = spark.createDataFrame(src, "cell_id long, iy int, ix int, lat double, lon double")
    there = {}
    for r in curvilinear.weights_bilinear_curved(grid, spark.createDataFrame(points, "cell_id long, lat double, lon double")).collect():
        there[r["dst_cell"]] = there.get(r["dst_cell"], 0) + r["w"] * unit(*src[r["src_cell"]][3:])
    assert len(there) > 30 and all(np.linalg.norm(v / np.linalg.norm(v) - unit(*points[n][1:])) < 1e-7 for n, v in there.items())
