"""Hand-checked cases and properties of the climate operators."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.functions.scalar import Albers, clean, noleap_doy, quantile_type8
from gridloom.operators import aggregate, bias, calendar, catalog, indicators, joins, qc, rank, regrid, select, units, windows
from gridloom.sources import fields

DAY = dt.date(1999, 12, 28)


def daily(spark, values, start=DAY, cell=1, name="value"):
    rows = [(cell, start + dt.timedelta(days=i), None if v is None else float(v)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"cell_id long, date date, {name} double")
    return df.withColumns({"year": F.year("date"), "month": F.month("date"), "doy": noleap_doy(F.col("date"))})


def one(df):
    return [tuple(r) for r in df.collect()]


def scalar(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_runs_are_cut_at_year_ends(spark):
    d = daily(spark, [0, 2, 2, 0, 2, 2, 2, 0], dt.date(2001, 3, 1), name="pr")
    assert one(windows.longest_run(d, F.col("pr") > 1, ["cell_id", "year"]).select("longest")) == [(3,)]
    assert one(windows.longest_run(d, F.col("pr") < 1, ["cell_id", "year"]).select("longest")) == [(1,)]
    over = daily(spark, [0, 0, 2, 2, 2, 2, 0], dt.date(1999, 12, 28), name="pr")
    assert sorted(one(windows.longest_run(over, F.col("pr") > 1, ["cell_id", "year"]))) == [(1, 1999, 2), (1, 2000, 2)]


def test_spells_and_sums(spark):
    d = daily(spark, [1] * 7 + [0] + [1] * 5, dt.date(2001, 5, 1))
    assert one(windows.days_in_runs(d, F.col("value") == 1, ["cell_id", "year"], 6, "n")) == [(1, 2001, 7)]
    assert one(indicators.rx5day(daily(spark, range(1, 11), dt.date(2001, 5, 1), name="pr")).select("rx5day")) == [(40.0,)]
    ten = daily(spark, range(1, 11), dt.date(2001, 5, 1), name="tasmax").withColumn("tasmin", F.col("tasmax"))
    assert one(indicators.run_indicators(ten, ["hd", "cd"]).select("hd", "cd")) == [(5.0, 6.0)]
    pairs = spark.createDataFrame([(1, 2001, 1.0, 0.0), (1, 2001, 1.0, 1.0), (1, 2001, 0.0, -1.0), (1, 2001, 2.0, -3.0)], "cell_id long, year int, tasmax double, tasmin double")
    assert one(pairs.agg(indicators._freeze_thaw(False), indicators.SIMPLE["ftc"]())) == [(2, None)]
    wet = daily(spark, [10, 10.1], dt.date(2001, 5, 1), name="pr").withColumns({"tasmax": F.lit(0.0), "tasmin": F.lit(0.0)})
    assert one(indicators.run_indicators(wet, ["r10mm"]).select("r10mm")) == [(1,)]
    with pytest.raises(ValueError):
        indicators.run_indicators(wet, ["nothing"])


def test_type8_quantiles(spark):
    five = F.array(*map(F.lit, [1.0, 2.0, 3.0, 4.0, 5.0]))
    got = scalar(spark, *(quantile_type8(five, p) for p in (0.9, 0.5, 0.3, 0.0)), quantile_type8(F.array().cast("array<double>"), 0.5))
    assert got[:2] == (5.0, 3.0) and math.isclose(got[2], 1.9333333333) and got[3:] == (1.0, None)


def test_nodes_and_ranks(spark):
    assert scalar(spark, *(bias.nearest_node(F.lit(q), 4) for q in (0.0, 0.3, 1.0))) == (0, 1, 3)
    d = daily(spark, [10, 20, 20, 40], dt.date(2001, 5, 1))
    ranks = windows.rank_in_doy_window(d, 31).orderBy("date")
    assert [r["q"] for r in ranks.collect()] == [0.0, 0.5, 0.5, 1.0]


def series(spark, years=3, cells=2, seed=0):
    rng = np.random.default_rng(seed)
    start = np.datetime64("1999-01-01")
    days = np.arange(start, start + 365 * years + 1)
    rows = [(c, d.item(), float(v)) for c in range(cells) for d, v in zip(days, rng.gamma(2, 3, len(days)))]
    df = spark.createDataFrame(rows, "cell_id long, date date, value double")
    return df.withColumns({"year": F.year("date"), "month": F.month("date"), "doy": noleap_doy(F.col("date"))})


def test_quantile_paths_agree_and_identity(spark):
    s = series(spark, 2, 1).cache()
    a = {(r["doy"], r["q_idx"]): r["value"] for r in windows.doy_window_quantiles(s, 7, 31).collect()}
    b = {(r["doy"], r["q_idx"]): r["value"] for r in windows.doy_window_quantiles_per_cell(s, 7, 31).collect()}
    assert a.keys() == b.keys() and max(abs(a[k] - b[k]) for k in a) < 1e-9
    for kind, neutral in (("+", 0.0), ("*", 1.0)):
        qmap = bias.qdm_train(s, s, kind, 10, 31)
        assert {r["af"] for r in qmap.collect()} == {neutral}
        same = bias.qdm_adjust(qmap, s.where("doy is not null"), kind, 10, 31).join(s.select("cell_id", "date", F.col("value").alias("v")), ["cell_id", "date"])
        assert same.where("abs(value - v) > 1e-9 or value is null").count() == 0
    assert {r["ok"] for r in bias.validate_qmap(qmap).collect()} == {True}


def test_adapt_frequency_lowers_dry_share(spark):
    ref = series(spark, 2, 1, 1)
    hist = ref.withColumn("value", F.when(F.dayofmonth("date") % 2 == 0, 0.0).otherwise(F.col("value")))
    out = bias.adapt_freq(ref, hist, 1.0, 31)
    dry = lambda d: d.where("value < 1").count()
    assert out.count() == hist.count() and dry(ref) <= dry(out) < 0.7 * dry(hist)
    assert sorted(one(out)) == sorted(one(bias.adapt_freq(ref, hist, 1.0, 31)))


def test_detrend(spark):
    s = series(spark, 3, 1).withColumn("value", F.col("year") * 2.0)
    for kind, worst in (("poly1", 1e-6), ("poly3", 1e-6), ("mean", 3.0), ("loess", 3.0)):
        d = bias.detrend(s.where("doy = 100"), kind)
        assert d.agg(F.max(F.abs(F.col("value") - F.col("trend")))).first()[0] <= worst, kind


def test_scalars(spark):
    assert scalar(spark, *(units.dtr(F.lit(a), F.lit(b)) for a, b in ((5.0, 3.0), (3.0, 5.0))), units.dtr(F.lit(None).cast("double"), F.lit(1.0))) == (2.0, 0.0000999, None)
    assert scalar(spark, units.clamp(F.lit(None).cast("double"), None, 333.15), units.clamp(F.lit(400.0), None, 333.15)) == (None, 333.15)
    rounded = scalar(spark, *(units.round_negative(F.lit(v)) for v in (-0.4, -0.5, -1.5, 2.7)))
    assert rounded == (0.0, 0.0, -2.0, 2.7) and math.copysign(1, rounded[0]) == 1
    assert scalar(spark, *(units.shift_longitude(F.lit(v)) for v in (183.0, 180.0, -170.0))) == (-177.0, -180.0, -170.0)
    assert scalar(spark, clean(F.lit(float("nan"))), clean(F.lit(1.0))) == (None, 1.0)
    days = [noleap_doy(F.lit(d).cast("date")) for d in ("2000-02-29", "2000-03-01", "2000-12-31", "2001-12-31")]
    assert scalar(spark, *days) == (None, 60, 365, 365)


def test_clamp_and_jitter_properties(spark):
    s = series(spark, 1, 1)
    once = units.clamp_quantile_hist(s, 0.05, 0.95, 100)
    assert once.agg(F.min("value")).first()[0] > s.agg(F.min("value")).first()[0]
    j = units.jitter_under(s, 2.0, ["cell_id", "date"])
    assert j.where("value <= 0 or value is null").count() == 0 and j.where("value < 2").count() == s.where("value < 2").count()
    assert sorted(one(j)) == sorted(one(units.jitter_under(s.repartition(5), 2.0, ["cell_id", "date"])))


def test_calendar_of_360_days(spark):
    drawn = [r for _, _, r in calendar.inserted_days([1990])]
    assert drawn == [1, 115, 154, 232, 293]
    rows = [(1, 1990, d, float(d)) for d in range(1, 361)]
    out = {r["doy"]: r["value"] for r in calendar.cal360_to_noleap(spark.createDataFrame(rows, "cell_id long, year int, doy360 int, value double"), 1990, 1990).collect()}
    assert sorted(out) == list(range(1, 366))
    for at, r in zip((1, 116, 156, 235, 297), drawn):
        assert out[at + 1] == ((r + 1) + (r + 2)) / 2
    assert out[1] == 1.0 and out[365] == 360.0


def test_inserted_day_with_one_neighbour(spark):
    rows = [(1, 1990, d, None if d == 2 else float(d)) for d in range(1, 361) if d not in (117, 155, 156)]
    out = {r["doy"]: r["value"] for r in calendar.cal360_to_noleap(spark.createDataFrame(rows, "cell_id long, year int, doy360 int, value double"), 1990, 1990).collect()}
    # r = 1 lies between days 2 and 3, r = 115 between 116 and 117, r = 154 between 155 and 156.
    assert out[2] is None or out[2] == 3.0
    assert [v for v in (out.get(2), out.get(3)) if v is not None] == [3.0] and out[117] == 116.0 and 157 not in out


def test_boxes():
    assert select.orient_bbox(-170, 50, 20, 70) == [(0, 50, 20, 70), (190, 50, 359.9, 70)]
    assert select.orient_bbox(-170, 50, -100, 70) == [(190, 50, 260, 70)]
    for bad in ((-190, 0, 0, 10), (0, -95, 10, 0)):
        with pytest.raises(ValueError):
            select.check_bbox(*bad)


def grid(spark, nx, ny, x0, y0, dx, dy):
    rows = [(j * nx + i, j, i, y0 + j * dy, x0 + i * dx) for j in range(ny) for i in range(nx)]
    return spark.createDataFrame(rows, "cell_id long, iy int, ix int, lat double, lon double")


def test_regridding(spark):
    src, mid = grid(spark, 2, 2, 0.0, 0.0, 1.0, 1.0), spark.createDataFrame([(9, 0, 0, 0.5, 0.5)], "cell_id long, iy int, ix int, lat double, lon double")
    w = regrid.weights_bilinear(src, mid)
    f = spark.createDataFrame([(c, DAY, float(c)) for c in range(4)], "cell_id long, date date, value double")
    assert one(regrid.apply_weights(f, w).select("value")) == [(1.5,)]
    assert one(regrid.apply_weights(f.withColumn("value", F.when(F.col("cell_id") > 0, F.col("value"))), w).select("value")) == [(None,)]
    wide = regrid.apply_regrid(f, w, grid(spark, 2, 1, 0.5, 0.5, 50.0, 1.0).withColumn("cell_id", F.col("cell_id") + 9))
    assert sorted(one(wide.select("cell_id", "value"))) == [(9, 1.5), (10, None)]
    fine, coarse = grid(spark, 12, 9, -10.0, 40.0, 1.0, 1.0), grid(spark, 4, 3, -9.0, 41.0, 3.0, 3.0)
    for make in (regrid.weights_conservative, regrid.weights_nearest):
        assert all(abs(r["s"] - 1) < 1e-9 for r in make(fine, coarse).groupBy("dst_cell").agg(F.sum("w").alias("s")).collect())
    world = grid(spark, 36, 3, 0.0, 0.0, 10.0, 10.0)
    seam = spark.createDataFrame([(0, 0, 0, 5.0, 355.0)], "cell_id long, iy int, ix int, lat double, lon double")
    assert regrid.weights_bilinear(world, seam).count() == 0
    assert sorted(one(regrid.weights_bilinear(world, seam, periodic=True).select("src_cell"))) == [(0,), (35,), (36,), (71,)]
    assert one(regrid.is_periodic(world).select("periodic")) == [(True,)] and one(regrid.is_periodic(fine).select("periodic")) == [(False,)]
    assert regrid.make_latlon_grid(spark, 183.0, 50.0, 232.0, 50.0, 0.5).count() == 99
    two = regrid.cascade(regrid.weights_bilinear(fine, coarse), regrid.weights_bilinear(coarse, grid(spark, 1, 1, -6.0, 43.0, 1.0, 1.0)))
    assert abs(two.agg(F.sum("w")).first()[0] - 1) < 1e-9


def test_albers_round_trip_and_origin(spark):
    x, y = scalar(spark, *Albers().forward(F.lit(50.0), F.lit(-154.0)))
    assert abs(x) < 1e-6 and abs(y) < 1e-6
    lat, lon = Albers().inverse(*Albers().forward(F.lit(64.8), F.lit(-147.7)))
    back = scalar(spark, lat, lon)
    assert abs(back[0] - 64.8) < 1e-8 and abs(back[1] + 147.7) < 1e-8


def test_percentages_and_ranges(spark):
    d = spark.createDataFrame([("a", -1.0), ("a", 1.0), ("a", None), ("a", None), ("b", None)], "k string, value double")
    assert dict(one(aggregate.pct_condition(d, "<", 0, ["k"]))) == {"a": 25.0, "b": None}
    src = spark.createDataFrame([("p", 0.0), ("p", 100.0), ("q", 0.0), ("q", 100.0)], "k string, value double")
    out = spark.createDataFrame([("p", -4.0), ("p", 50.0), ("q", 0.0), ("q", 106.0)], "k string, value double")
    assert dict(one(qc.qc_regrid_range(src, out, ["k"]).select("k", "ok"))) == {"p": True, "q": False}


def test_samples_batches_versions(spark):
    assert [rank.subsample_size(n) for n in (15, 300, 1000)] == [15, 30, 75]
    gb = 10**9
    files = spark.createDataFrame([("s", n, b * gb) for n, b in (("a", 30), ("b", 30), ("c", 10), ("d", 60))], "series string, path string, bytes long")
    assert sorted(one(rank.pack_batches(files, ["series"]).select("path", "batch"))) == [("a", 0), ("b", 1), ("c", 1), ("d", 2)]
    versions = spark.createDataFrame([("f", "v20190101"), ("f", "v20200101")], "filename string, version string")
    assert one(rank.latest_version(versions, ["filename"]).where("not superseded").select("version")) == [("v20200101",)]
    few = spark.createDataFrame([(c, 1) for c in range(5)], "cell_id long, n_days int")
    assert rank.top_cells(few).count() == 0


def test_frequency(spark):
    rows = [("d", DAY + dt.timedelta(days=i)) for i in range(4)] + [("m", dt.date(2000, m, 1)) for m in (1, 3, 4)]
    assert dict((r["source"], r["frequency"]) for r in calendar.infer_frequency(spark.createDataFrame(rows, "source string, date date")).collect()) == {"d": "day", "m": "mon"}


def test_holdings_report_what_is_missing(spark):
    requests = spark.createDataFrame([("m", "historical", "r1", "day", "pr"), ("m", "historical", "r1", "day", "tas")], "model string, scenario string, variant string, table_id string, variable string")
    files = spark.createDataFrame([("m", "historical", "r1", "day", "pr", "gn", v, f) for v, f in (("v1", "a.nc"), ("v2", "b.nc"), ("v2", "c.nc"))], "model string, scenario string, variant string, table_id string, variable string, grid_type string, version string, filename string")
    got = {r["variable"]: (r["version"], r["filenames"]) for r in catalog.holdings_table(requests, files).collect()}
    assert got == {"pr": ("v2", ["b.nc", "c.nc"]), "tas": (None, None)}


def test_mask_and_years(spark):
    d = daily(spark, [None, 1, 2], dt.date(2001, 1, 1)).unionByName(daily(spark, [3, None, 4], dt.date(2001, 1, 1), cell=2))
    assert sorted(one(select.mask_first_slice(d).groupBy("cell_id").agg(F.count("value")))) == [(1, 0), (2, 2)]
    with pytest.raises(ValueError, match="2002"):
        fields.require_years(d, 2001, 2003)
    with pytest.raises(ValueError):
        fields.missing_years(d, 1940, 2000)
    assert one(joins.time_nearest(d.where("cell_id = 2"), spark.createDataFrame([(2, dt.date(2001, 1, 2))], "cell_id long, at date"), ["cell_id"]).select("value")) == [(3.0,)]


def test_cramer_von_mises(spark):
    a, b = daily(spark, range(20)), daily(spark, [x + 100 for x in range(20)])
    far = windows.cvm_2samp(a, b).first()
    same = windows.cvm_2samp(a, daily(spark, [x + 0.5 for x in range(20)])).first()
    assert far["pvalue"] < 1e-4 and same["pvalue"] > 0.9


def test_models_are_not_pooled(spark):
    a, b = (daily(spark, [v] * 10, dt.date(2001, 5, 1), name="pr").withColumn("model", F.lit(m)) for m, v in (("a", 2), ("b", 0)))
    d = a.unionByName(b).withColumns({"tasmax": F.lit(1.0), "tasmin": F.lit(0.0)})
    got = {r["model"]: (r["cwd"], r["rx5day"], r["cdd"]) for r in indicators.run_indicators(d, ["cwd", "rx5day", "cdd"]).collect()}
    assert got == {"a": (10, 10.0, 0), "b": (0, 0.0, 10)}


def test_cells_without_data_have_no_counts(spark):
    d = daily(spark, [None, 30, 30], dt.date(2001, 1, 1), name="tasmax").unionByName(daily(spark, [30, None, 30], dt.date(2001, 1, 1), cell=2, name="tasmax"))
    later = daily(spark, [30, 30], dt.date(2002, 1, 1), name="tasmax")
    out = indicators.run_indicators(d.unionByName(later), ["su", "max_consecutive_warm_days"])
    assert sorted(one(out)) == [(1, 2001, None, None), (1, 2002, None, None), (2, 2001, 2, 1)]
    assert sorted(one(indicators.run_indicators(d, ["su"], mask=False))) == [(1, 2001, 2), (2, 2001, 2)]


def test_maps_serve_all_scenarios_of_a_model(spark):
    s = series(spark, 2, 1).where("doy is not null")
    sim = s.withColumn("model", F.lit("a")).unionByName(s.withColumns({"model": F.lit("b"), "value": F.col("value") + 5}))
    hist, later = sim.withColumn("scenario", F.lit("historical")), sim.withColumn("scenario", F.lit("ssp585"))
    qmap = bias.qdm_train(s, hist, "+", 10, 31)
    assert qmap.select("model").distinct().count() == 2 and "scenario" not in qmap.columns
    for adjust in (bias.qdm_adjust(qmap, later, "+", 10, 31), bias.eqm_adjust(qmap, later), bias.dqm_adjust(s, hist, later, "+", 10, 31)):
        assert adjust.count() == later.count()
        both = adjust.join(s.select("cell_id", "date", F.col("value").alias("v")), ["cell_id", "date"])
        assert both.where("value is null or (model = 'b' and abs(value - v) > 3.5)").count() == 0
    assert bias.sliding_year_adjust(qmap, later, "+", 10, 31, 1).count() == later.count()


def test_analogs_on_one_pool(spark):
    """Five days of one year, window 1: each day is a pool of its own, so the analog is the day itself."""
    coarse, fine = daily(spark, [1, 2, 3, 4, 5], dt.date(2001, 5, 1)), daily(spark, [2, 4, 6, 8, 10], dt.date(2001, 5, 1))
    out = bias.qplad_adjust(bias.qplad_train(fine, coarse, 1), coarse, 1)
    assert [r["value"] for r in out.orderBy("date").collect()] == [2, 4, 6, 8, 10]
    wide = bias.qplad_train(fine, coarse.withColumn("value", -F.col("value")), 31).where("doy = 123").orderBy("rank").collect()
    assert [(r["n"], r["af"]) for r in wide] == [(5, 15.0), (5, 12.0), (5, 9.0), (5, 6.0), (5, 3.0)]


def test_nearest_anywhere(spark):
    cells = "cell_id long, lat double, lon double"
    far = spark.createDataFrame([(1, 29.9, 44.9), (2, 0.1, -31.0)], cells)
    dst = spark.createDataFrame([(7, 0.1, 0.5), (8, -80.0, 10.0), (9, None, 1.0)], cells)
    assert sorted(one(regrid.weights_nearest(far, dst))) == [(2, 7, 1.0), (2, 8, 1.0)]
    point = spark.createDataFrame([("p", 0.1, 0.0)], "name string, plat double, plon double")
    assert one(select.sel_nearest(spark.createDataFrame([(1, 4.0, 170.0), (2, 11.0, 0.0)], cells), point).select("cell_id")) == [(2,)]
    rng = np.random.default_rng(3)
    place = lambda n, south, north: list(zip(np.degrees(np.arcsin(rng.uniform(np.sin(np.radians(south)), np.sin(np.radians(north)), n))).tolist(), rng.uniform(-180, 180, n).tolist()))
    for src, own in ((place(800, -90, 90), place(60, -90, 90)), ([(60 + i / 50, -150 + j / 50) for i in range(30) for j in range(30)], place(60, -90, 90)), ([(5.0, 5.0)] * 3, place(5, -90, 90))):
        got = dict(one(regrid.weights_nearest(spark.createDataFrame([(i, *p) for i, p in enumerate(src)], cells), spark.createDataFrame([(i, *p) for i, p in enumerate(own)], cells)).select("dst_cell", "src_cell")))
        s, d = np.radians(np.array(src)), np.radians(np.array(own))
        a = np.sin((s[None, :, 0] - d[:, None, 0]) / 2) ** 2 + np.cos(s[None, :, 0]) * np.cos(d[:, None, 0]) * np.sin((s[None, :, 1] - d[:, None, 1]) / 2) ** 2
        assert [got[i] for i in range(len(own))] == a.argmin(axis=1).tolist()
    assert regrid.weights_nearest(far.where("false"), dst).count() == 0


def test_long_dimension_tables(spark):
    """More than ten thousand rows on the small side of a join."""
    n = 10_001
    ids = spark.range(n).select(F.concat(F.lit("v"), F.col("id")).alias("variable"), F.lit("day").alias("table_id"))
    models = spark.createDataFrame([("m", ["r1"])], "model string, variants array<string>")
    assert catalog.expand_requests(models, ids, ["historical"]).count() == n
    assert joins.expected_vs_existing([ids.select("variable"), ids.select("table_id").distinct()], ids.limit(1)).count() == n - 1
    named = ids.select(F.col("variable").alias("indicator"))
    assert qc.qc_ranges(named.withColumn("value", F.lit(2.0)), named.withColumns({"min": F.lit(0.0), "max": F.lit(1.0)})).agg(F.sum("n_outside")).first()[0] == n
    own = named.withColumn("units", F.lit("K"))
    assert qc.qc_units(own, own).where("ok").count() == n
    boxes = spark.range(n).select(F.col("id").alias("region"), F.col("id").cast("double").alias("x1"), (F.col("id") + 0.5).alias("x2"), F.lit(0.0).alias("y1"), F.lit(1.0).alias("y2"))
    assert select.sel_regions(spark.range(n).select((F.col("id") + 0.25).alias("x"), F.lit(0.5).alias("y")), boxes).select("region").distinct().count() == n


def test_difference_needs_equal_units(spark):
    a = spark.createDataFrame([(1, 3.0, "K")], "cell_id long, value double, unit string")
    assert one(units.difference(a, a, ["cell_id"], "d")) == [(1, "d", 0.0, "K")]
    with pytest.raises(Exception, match="units differ"):
        units.difference(a, a.withColumn("unit", F.lit("degC")), ["cell_id"], "d").collect()


def test_a_callers_series_code(spark):
    """A median as a Column and as a caller's code are equal; the caller's sees dates in order and no nulls."""
    d = series(spark, 2, 2, 5).withColumn("value", F.when(F.dayofmonth("date") % 7 != 3, F.col("value")))
    a = indicators.resample_with(d, ["cell_id"], "month", F.median)
    b = indicators.resample_series(d, ["cell_id"], "month", lambda dates, values: np.median(values))
    assert a.columns == b.columns
    left, right = ({tuple(r)[:2]: r["value"] for r in df.collect()} for df in (a, b))
    assert left.keys() == right.keys() and all(abs(v - right[k]) < 1e-12 for k, v in left.items())
    span = indicators.resample_series(d, ["cell_id"], "month", lambda dates, values: float((dates[-1] - dates[0]).astype(int)) + (np.diff(dates).min() <= np.timedelta64(0, "D")))
    assert all(20 <= r["value"] <= 31 for r in span.where("month(period) <> 1 or year(period) < 2001").collect())
    assert one(indicators.resample_series(daily(spark, [None, None]), ["cell_id"], "year", lambda dates, values: 1.0).select("value")) == [(None,), (None,)][:1]


def test_members_keep_to_themselves(spark):
    """Two models side by side in masks, histograms, tiles, yearly partitions and day-of-year selections."""
    a = daily(spark, [None, 5, 6], dt.date(2001, 1, 1)).withColumn("model", F.lit("a"))
    b = daily(spark, [1, 2, 900], dt.date(2000, 12, 31)).withColumn("model", F.lit("b"))
    both = a.unionByName(b)
    assert sorted(one(select.mask_first_slice(both).groupBy("model").agg(F.count("value")))) == [("a", 0), ("b", 3)]
    assert {r["model"]: r["upper"] for r in units.quantile_bounds(both, 0.0, 1.0, 10).collect()} == {"a": 6.0, "b": 900.0}
    assert sorted(one(fields.from_tiles(fields.to_tiles(both)).groupBy("model").agg(F.sum("value")))) == [("a", 11.0), ("b", 903.0)]
    centres = both.groupBy("model", "cell_id").agg(F.lit(2).alias("centre"))
    assert select.sel_doys_around(both, centres, 5).count() == 5
    assert sorted(one(fields.year_status(both).select("model", "year", "n_dates", "written"))) == [("a", 2001, 3, True), ("b", 2000, 1, False), ("b", 2001, 2, True)]
