"""Queries of sources, selections and units."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.shared import shared_path
from ..operators import select, units, windows
from ..sources import fields
from .catalogue import query
from .inputs import catalog, daily, dated, field, grid, member, members, pool_sql, series, sql, table

KEYS = "model, scenario, variable, cell_id, date"
S = "model, scenario, cell_id"
MEMBER = ["model", "scenario", "cell_id"]


def six(df, *names):
    return df.withColumns({n: F.round(n, 6) for n in names})


@query("s1_read_field", sql(f"SELECT {KEYS}, year, month, doy, value FROM field WHERE variable = 'pr' AND model IN ('m0', 'm1') AND scenario = 'historical' AND year BETWEEN 1996 AND 1997", "field"))
def _(spark, sf):
    path = shared_path(spark, "field")
    fields.write_by_year(field(spark, sf), path)
    return fields.read_field(spark, path, "pr", ["m0", "m1"], ["historical"], (1996, 1997))


@query("s2_missing_years", sql("SELECT y::INT AS year FROM range(1993, 2011) t(y) WHERE y NOT IN (SELECT year FROM dated)", "dated"))
def _(spark, sf):
    return fields.missing_years(dated(daily(spark, sf)), 1993, 2010)


@query("s3_concat_members", sql(f"SELECT {KEYS}, count(*) AS n FROM (SELECT * FROM field WHERE variable = 'pr' UNION ALL SELECT * FROM field WHERE variable = 'pr' AND year = 1996 UNION ALL SELECT * FROM field WHERE variable = 'tasmax') GROUP BY ALL HAVING count(*) > 1", "field"))
def _(spark, sf):
    f = field(spark, sf)
    pr = f.where("variable = 'pr'")
    return fields.conflicts(fields.concat_members([pr, pr.where("year = 1996"), f.where("variable = 'tasmax'")]))


@query("s4_write_by_year", sql("WITH v AS (SELECT model, scenario, cell_id, date, year FROM members WHERE model = 'm0' OR year < 1999 OR (year = 1999 AND date = (SELECT min(date) FROM members WHERE year = 1999 AND model = 'm1'))) SELECT model, scenario, year, count(DISTINCT date) AS n_dates, year >= 1997 AND count(DISTINCT date) <> 1 AS written, CASE WHEN year >= 1997 AND count(DISTINCT date) <> 1 THEN count(*) END AS n_rows FROM v GROUP BY model, scenario, year", "members"))
def _(spark, sf):
    """Model m1 has a single day in 1999, which is not written, while m0's 1999 is."""
    path, of = shared_path(spark, "years"), member(spark, sf, "pr")
    first = of.where("model = 'm1' and year = 1999").agg(F.min("date").alias("first"))
    df = of.join(first, how="cross").where("model = 'm0' or year < 1999 or (year = 1999 and date = first)").drop("first")
    status = fields.write_by_year(df, path, 1997, rows_a_file=2000)
    fields.write_by_year(df, path, 1997, rows_a_file=2000)
    there = spark.read.parquet(path).groupBy("model", "scenario", "year").agg(F.count("*").alias("n_rows"))
    return status.join(there, ["model", "scenario", "year"], "left")


@query("s5_no_clobber", sql("SELECT variable, model, year, count(*) AS n, round(sum(CASE WHEN variable = 'pr' AND year < 1999 THEN -1 ELSE value END), 4) AS total FROM field GROUP BY ALL", "field"))
def _(spark, sf):
    path, keys, f = shared_path(spark, "outputs"), ["variable", "model", "year"], field(spark, sf)
    f.where("variable = 'pr' and year < 1999").withColumn("value", F.lit(-1.0)).write.partitionBy(*keys).parquet(path)
    fields.write_missing(f, path, keys, spark.read.parquet(path))
    return spark.read.parquet(path).groupBy(*keys).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("s6_tiles", sql(f"SELECT {S}, year, count(*) AS n, sum(value) AS total, min(doy) AS first_doy, max(doy) AS last_doy FROM (SELECT {S}, year, doy, pr AS value FROM members WHERE doy IS NOT NULL AND pr IS NOT NULL) GROUP BY ALL", "members"))
def _(spark, sf):
    back = fields.from_tiles(fields.to_tiles(member(spark, sf, "pr")))
    return fields.to_series_layout(back.withColumn("date", F.col("doy"))).groupBy(*MEMBER, "year").agg(F.count("*").alias("n"), F.sum("value").alias("total"), F.min("doy").alias("first_doy"), F.max("doy").alias("last_doy"))


@query("s6_bucketed_tiles", sql(f"WITH long AS (SELECT {S}, date, doy, pr FROM members WHERE doy IS NOT NULL AND pr IS NOT NULL), {pool_sql('long', 'pr', 7, S)} SELECT {S}, doy, unnest(range(5))::INT AS q_idx, round(unnest(quantile_cont(value, [0.1, 0.3, 0.5, 0.7, 0.9])), 6) AS value FROM pool GROUP BY {S}, doy", "members"))
def _(spark, sf):
    """Quantiles of windows from a table of tiles in buckets of cells, without a shuffle after it is written."""
    name = f"tiles_{uuid.uuid4().hex}"
    fields.write_tiles(member(spark, sf, "pr"), name, shared_path(spark, "tiles"), 8)
    long = fields.read_tiles(spark, name)
    return six(windows.doy_window_quantiles_per_cell(long, 5, 15), "value").select(*MEMBER, "doy", "q_idx", "value")


@query("s7_holdings_names", sql("SELECT model, variable, count(*) AS n, min(filename) AS first FROM catalog GROUP BY ALL", "catalog"))
def _(spark, sf):
    path = shared_path(spark, "holdings")
    text = F.concat(F.lit("['"), F.concat_ws("', '", F.collect_list("filename")), F.lit("', 'x.nc4', 'y.txt']"))
    catalog(spark, sf).groupBy("model", "variable").agg(text.alias("filenames")).write.option("header", True).option("escape", '"').csv(path)
    return fields.read_holdings_csv(spark, path).select("model", "variable", F.size("filenames").cast("long").alias("n"), F.array_min("filenames").alias("first"))


@query("s8_path_list", sql("SELECT 'src/' || path AS src, CASE WHEN file_no % 2 = 0 THEN 'dst/' || path END AS dst FROM catalog WHERE path LIKE '%/ssp585/%'", "catalog"))
def _(spark, sf):
    path = shared_path(spark, "paths")
    both = F.when(F.col("file_no") % 2 == 0, F.concat(F.lit("dst/"), F.col("path")))
    catalog(spark, sf).select(F.concat_ws(" ", F.concat(F.lit("  src/"), F.col("path")), both).alias("value")).write.text(path)
    return fields.read_path_list(spark, path, "/ssp585/")


@query("s9_batches", sql("SELECT variable, table_id, count(*) AS n, min('src/' || path || ' dst/' || path) AS first FROM catalog GROUP BY 1, 2", "catalog"))
def _(spark, sf):
    path = shared_path(spark, "batches")
    fields.write_batches(catalog(spark, sf).select("variable", "table_id", F.concat(F.lit("src/"), F.col("path")).alias("src"), F.concat(F.lit("dst/"), F.col("path")).alias("dst")), path)
    return spark.read.schema("value string, variable string, table_id string").text(path).groupBy("variable", "table_id").agg(F.count("*").alias("n"), F.min("value").alias("first"))


@query("s10_validate_readback", sql("SELECT model, variable, count(*) AS n, count(value) AS n_valid, min(value) AS min, max(value) AS max, round(avg(value), 6) AS mean, count(value) > 0 AS ok FROM field GROUP BY 1, 2", "field"))
def _(spark, sf):
    return six(fields.validate_readback(field(spark, sf), ["model", "variable"]), "mean")


@query("p1_rename_variable", sql("SELECT CASE variable WHEN 'pr' THEN 'precipitation' WHEN 'tasmax' THEN 't2max' ELSE variable END AS variable, count(*) AS n FROM field GROUP BY 1", "field"))
def _(spark, sf):
    return select.rename_variable(field(spark, sf), {"pr": "precipitation", "tasmax": "t2max"}).groupBy("variable").agg(F.count("*").alias("n"))


@query("p2_select_variables", sql("SELECT variable, count(*) AS n, sum(value) AS total FROM field WHERE variable IN ('pr') GROUP BY 1", "field"))
def _(spark, sf):
    return select.select_variables(field(spark, sf), ["pr"]).groupBy("variable").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


@query("p3_drop_aux_columns", sql("SELECT cell_id, date, value FROM field WHERE variable = 'tasmin'", "field"))
def _(spark, sf):
    return select.drop_aux_columns(field(spark, sf).where("variable = 'tasmin'"), ["cell_id", "date"])


@query("p4_sel_time", sql("SELECT cell_id, date, pr AS value FROM daily WHERE date BETWEEN DATE '1996-02-01' AND DATE '1997-03-31'", "daily"))
def _(spark, sf):
    return select.sel_time(series(spark, sf, "pr"), "1996-02-01", "1997-03-31").select("cell_id", "date", "value")


@query("p5_sel_bbox_latlon", sql("SELECT cell_id, lat, lon FROM grid WHERE lat BETWEEN 55 AND 66 AND lon BETWEEN -165 AND -140", "grid"))
def _(spark, sf):
    return select.sel_bbox_latlon(grid(spark, sf), -165, 55, -140, 66).select("cell_id", "lat", "lon")


@query("p6_sel_bbox_xy", sql("SELECT cell_id, iy, ix FROM grid WHERE iy BETWEEN 1 AND 3 AND ix BETWEEN 0 AND 2", "grid"))
def _(spark, sf):
    return select.sel_bbox_xy(grid(spark, sf), 0, 1, 2, 3).select("cell_id", "iy", "ix")


@query("p7_orient_bbox", sql("SELECT cell_id, lat, lon FROM grid WHERE lat BETWEEN 50 AND 65 AND ((lon + 360) % 360 BETWEEN 0 AND 20 OR (lon + 360) % 360 BETWEEN 200 AND 359.9)", "grid"))
def _(spark, sf):
    return select.in_boxes(grid(spark, sf), select.orient_bbox(-160, 65, 20, 50), F.pmod(F.col("lon"), F.lit(360.0))).select("cell_id", "lat", "lon")


POINTS = [("fairbanks", 64.8, -147.7), ("juneau", 58.3, -134.4), ("kotzebue", 66.9, -162.6), ("null island", 0.0, 0.0)]


@query("p8_sel_nearest", sql("SELECT name, arg_min(cell_id, (round(km, 9), cell_id)) AS cell_id, round(min(km), 6) AS km FROM (SELECT name, cell_id, 2 * 6371e0 * asin(sqrt(pow(sin(radians(lat - plat) / 2), 2) + cos(radians(plat)) * cos(radians(lat)) * pow(sin(radians(lon - plon) / 2), 2))) AS km FROM grid, (VALUES ('fairbanks', 64.8e0, -147.7e0), ('juneau', 58.3e0, -134.4e0), ('kotzebue', 66.9e0, -162.6e0), ('null island', 0e0, 0e0)) p(name, plat, plon)) GROUP BY name", "grid"))
def _(spark, sf):
    return six(select.sel_nearest(grid(spark, sf), spark.createDataFrame(POINTS, "name string, plat double, plon double")), "km")


@query("p9_sel_months", sql("SELECT cell_id, month, count(*) AS n FROM dated WHERE month IN (4, 5, 9) GROUP BY ALL", "dated"))
def _(spark, sf):
    return select.sel_months(series(spark, sf, "pr"), [4, 5, 9]).groupBy("cell_id", "month").agg(F.count("*").alias("n"))


@query("p10_sel_doys_around", sql(f"SELECT {S}, count(*) AS n, min(doy) AS first, max(doy) AS last FROM members d JOIN (SELECT {S}, arg_max(doy, (pr, -(date - DATE '1970-01-01'))) AS centre FROM members WHERE doy IS NOT NULL AND pr IS NOT NULL GROUP BY ALL) c USING ({S}) WHERE doy >= centre - 15 AND doy < centre + 15 GROUP BY ALL", "members"))
def _(spark, sf):
    from ..operators.windows import argmax_doy

    pr = member(spark, sf, "pr")
    return select.sel_doys_around(pr, argmax_doy(pr)).groupBy(*MEMBER).agg(F.count("*").alias("n"), F.min("doy").alias("first"), F.max("doy").alias("last"))


@query("p11_where_condition", sql("SELECT cell_id, date, tasmax AS value FROM daily WHERE tasmax > 32", "daily"))
def _(spark, sf):
    return select.where_condition(series(spark, sf, "tasmax"), ">", 32).select("cell_id", "date", "value")


@query("p12_mask_first_slice", sql(f"WITH m AS (SELECT {S}, arg_min_null(value, date) IS NULL AS masked FROM (SELECT {S}, date, CASE WHEN pr < 40 THEN pr END AS value FROM members) GROUP BY ALL) SELECT {S}, count(*) AS n, count(CASE WHEN NOT masked AND pr < 40 THEN 1 END) AS n_valid FROM members JOIN m USING ({S}) GROUP BY ALL", "members"))
def _(spark, sf):
    pr = member(spark, sf, "pr").withColumn("value", F.when(F.col("value") < 40, F.col("value")))
    return select.mask_first_slice(pr).groupBy(*MEMBER).agg(F.count("*").alias("n"), F.count("value").alias("n_valid"))


@query("p13_regions", sql("SELECT region_name, count(*) AS n, sum(pr) AS total FROM daily JOIN grid USING (cell_id) JOIN (VALUES ('southcentral', -170, -150, 50, 60), ('interior', -160, -130, 60, 70)) b(region_name, x1, x2, y1, y2) ON x BETWEEN x1 AND x2 AND y BETWEEN y1 AND y2 GROUP BY 1", "daily", "grid"))
def _(spark, sf):
    boxes = spark.createDataFrame([("southcentral", -170, -150, 50, 60), ("interior", -160, -130, 60, 70)], "region_name string, x1 int, x2 int, y1 int, y2 int")
    return select.sel_regions(daily(spark, sf).join(grid(spark, sf), "cell_id"), boxes).groupBy("region_name").agg(F.count("*").alias("n"), F.sum("pr").alias("total"))


@query("p14_crop_domain", sql("SELECT cell_id, count(*) AS n FROM daily JOIN grid USING (cell_id) WHERE lat >= 60 GROUP BY 1", "daily", "grid"))
def _(spark, sf):
    return select.crop_domain(daily(spark, sf).join(grid(spark, sf), "cell_id"), 60).groupBy("cell_id").agg(F.count("*").alias("n"))


@query("p15_sel_valid_points", sql("SELECT cell_id, count(pr) AS n_values FROM daily GROUP BY 1 HAVING count(pr) > 0 ORDER BY md5(cell_id || ':0'), cell_id LIMIT 5", "daily"))
def _(spark, sf):
    return select.sel_valid_points(series(spark, sf, "pr"))


@query("p16_sel_version", "SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events WHERE event_id % 2 = 1 GROUP BY 1")
def _(spark, sf):
    e = table(spark, sf, "events").withColumn("expver", F.col("event_id") % 2)
    return select.sel_version(e).groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("e1_convert_units", sql("SELECT variable, count(*) AS n, round(min(v), 6) AS min, round(max(v), 6) AS max FROM (SELECT variable, CASE WHEN variable = 'pr' THEN value * (86400e0 * day(last_day(date))) ELSE value - 273.15e0 END AS v FROM field) GROUP BY 1", "field"))
def _(spark, sf):
    return six(units.convert_units(field(spark, sf), monthly=True).groupBy("variable").agg(F.count("*").alias("n"), F.min("value").alias("min"), F.max("value").alias("max")), "min", "max")


@query("e2_celsius_to_kelvin", sql("SELECT cell_id, date, round(tasmax + 273.15e0, 6) AS kelvin FROM daily", "daily"))
def _(spark, sf):
    return daily(spark, sf).select("cell_id", "date", F.round(units.celsius_to_kelvin(F.col("tasmax")), 6).alias("kelvin"))


@query("e3_relabel_units", sql("WITH g AS (SELECT cell_id, date - lag(date) OVER (PARTITION BY cell_id ORDER BY date) AS gap FROM daily), s AS (SELECT cell_id, avg((gap = 1)::INT::DOUBLE) AS share FROM g WHERE gap IS NOT NULL GROUP BY 1) SELECT cell_id, CASE WHEN share > 0.5 THEN 'mm/day' END AS unit, count(*) AS n FROM daily LEFT JOIN s USING (cell_id) GROUP BY ALL", "daily"))
def _(spark, sf):
    pr = series(spark, sf, "pr").withColumn("unit", F.lit("mm"))
    return units.relabel_units(pr, least=0.5).groupBy("cell_id", "unit").agg(F.count("*").alias("n"))


@query("e4_flux_units", sql("SELECT cell_id, date, round(pr / 86400e0, 9) AS flux FROM daily", "daily"))
def _(spark, sf):
    return daily(spark, sf).select("cell_id", "date", F.round(units.flux_units(F.col("pr")), 9).alias("flux"))


def _var(spark, sf, v):
    return daily(spark, sf).select("cell_id", "date", F.col(v).alias("value"))


@query("e5_difference", sql("SELECT cell_id, date, 'dtr' AS variable, round(tasmax - tasmin, 6) AS value, 'degC' AS unit FROM daily", "daily"))
def _(spark, sf):
    a, b = (_var(spark, sf, v).withColumn("unit", F.lit("degC")) for v in ("tasmax", "tasmin"))
    return six(units.difference(a, b, ["cell_id", "date"], "dtr"), "value")


@query("e6_dtr", sql("SELECT cell_id, date, round(CASE WHEN tasmax - (tasmin + 25) < 0 THEN 0.0000999e0 ELSE tasmax - (tasmin + 25) END, 7) AS dtr FROM daily", "daily"))
def _(spark, sf):
    return daily(spark, sf).select("cell_id", "date", F.round(units.dtr(F.col("tasmax"), F.col("tasmin") + 25), 7).alias("dtr"))


@query("e7_clamp", sql("SELECT cell_id, date, CASE WHEN pr < 5 THEN 5 WHEN pr > 100 THEN 100 ELSE pr END AS value FROM daily", "daily"))
def _(spark, sf):
    return daily(spark, sf).select("cell_id", "date", units.clamp(F.col("pr"), 5.0, 100.0).alias("value"))


@query("e7_clamp_report", sql("SELECT variable, count(CASE WHEN value < -10 THEN 1 END) AS n_below, count(CASE WHEN value > 30 THEN 1 END) AS n_above, count(value) AS n FROM field GROUP BY 1", "field"))
def _(spark, sf):
    return units.clamp_report(field(spark, sf), -10, 30, ["variable"])


@query("e8_clamp_quantile_hist", sql("WITH v AS (SELECT model, scenario, cell_id, date, tasmax - tasmin AS value FROM members), e AS (SELECT model, scenario, min(value) AS low, (max(value) - min(value)) / 100 AS width FROM v GROUP BY ALL), h AS (SELECT model, scenario, least(99, floor((value - low) / width))::INT AS bin, count(*) AS n FROM v JOIN e USING (model, scenario) GROUP BY ALL), c AS (SELECT model, scenario, bin, sum(n) OVER (PARTITION BY model, scenario ORDER BY bin) / sum(n) OVER (PARTITION BY model, scenario) AS cdf FROM h), q AS (SELECT model, scenario, any_value(low) + any_value(width) * min(CASE WHEN cdf >= 0.02 THEN bin END) AS lower, any_value(low) + any_value(width) * (min(CASE WHEN cdf >= 0.98 THEN bin END) + 1) AS upper FROM c JOIN e USING (model, scenario) GROUP BY ALL) SELECT model, scenario, cell_id, date, round(CASE WHEN value < lower THEN lower WHEN value > upper THEN upper ELSE value END, 6) AS value FROM v JOIN q USING (model, scenario)", "members"))
def _(spark, sf):
    dtr = members(spark, sf).select(*MEMBER, "date", (F.col("tasmax") - F.col("tasmin")).alias("value"))
    return six(units.clamp_quantile_hist(dtr, 0.02, 0.98, 100), "value")


@query("e9_round_negative", sql("SELECT cell_id, date, CASE WHEN tasmin / 10 < 0 THEN round_even(tasmin / 10, 0) + 0e0 ELSE tasmin / 10 END AS value FROM daily", "daily"))
def _(spark, sf):
    v = F.col("tasmin") / 10
    return daily(spark, sf).select("cell_id", "date", units.round_negative(v).alias("value"))


@query("e9_round_negative_report", sql("SELECT variable, count(*) AS total, count(CASE WHEN value < 0 THEN 1 END) AS negative, count(CASE WHEN value < 0 AND round_even(value, 0) <> value THEN 1 END) AS changed, round(100e0 * count(CASE WHEN value < 0 AND round_even(value, 0) <> value THEN 1 END) / count(*), 6) AS pct_changed, count(CASE WHEN value < 0 AND round_even(value, 0) < 0 THEN 1 END) AS remaining FROM field GROUP BY 1", "field"))
def _(spark, sf):
    return six(units.round_negative_report(field(spark, sf), ["variable"]), "pct_changed")


@query("e10_jitter_under")
def _(spark, sf):
    return units.jitter_under(_var(spark, sf, "pr"), 10.0, ["cell_id", "date"])


@query("e11_shift_longitude", sql("SELECT cell_id, ((lon + 360 + 180) % 360) - 180 AS lon FROM grid", "grid"))
def _(spark, sf):
    return grid(spark, sf).select("cell_id", units.shift_longitude(F.col("lon") + 360).alias("lon"))


@query("e14_abs_delta", sql("SELECT cell_id, date, round(abs(tasmax - tasmin), 6) AS d, round(CASE WHEN tasmin <> 0 THEN tasmax / tasmin END, 6) AS r FROM daily WHERE abs(tasmax - tasmin) > 30", "daily"))
def _(spark, sf):
    d = units.abs_delta(F.col("tasmax"), F.col("tasmin"))
    return daily(spark, sf).where(d > 30).select("cell_id", "date", F.round(d, 6).alias("d"), F.round(units.ratio(F.col("tasmax"), F.col("tasmin")), 6).alias("r"))


@query("e15_resolution_km", sql("SELECT cell_id, round(abs(lat) / 40 * 110) AS lat_km, round(abs(lon) / 100 * 111.32e0 * cos(radians(65e0))) AS lon_km, round(2 * 6371e0 * asin(abs(cos(radians(lat)) * sin(radians(0.25e0)))), 6) AS width_km FROM grid", "grid"))
def _(spark, sf):
    y, x = units.resolution_km(F.abs("lat") / 40, F.abs("lon") / 100)
    return grid(spark, sf).select("cell_id", y.alias("lat_km"), x.alias("lon_km"), F.round(units.step_width_km(F.lit(0.5), F.col("lat")), 6).alias("width_km"))


_ENTRIES = ["model", "scenario", "variable", "table_id"]


@query("e5_common_attrs", sql(f"WITH a AS (SELECT variant, arg_min(({', '.join(_ENTRIES)}), file_no) AS a FROM catalog GROUP BY 1) SELECT file_no, array_to_string([x for x in [{', '.join(f"CASE WHEN {e} = a[{i + 1}] THEN '{e}=' || {e} END" for i, e in enumerate(_ENTRIES))}] if x IS NOT NULL], ';') AS attrs FROM catalog JOIN a USING (variant)", "catalog"))
def _(spark, sf):
    c = catalog(spark, sf)
    attrs = F.create_map(*(x for e in _ENTRIES for x in (F.lit(e), F.col(e))))
    first = c.groupBy("variant").agg(F.min_by(F.struct(*_ENTRIES), "file_no").alias("f")).select("variant", F.create_map(*(x for e in _ENTRIES for x in (F.lit(e), F.col("f")[e]))).alias("a"))
    shared = units.common_attrs(attrs, F.col("a"))
    return c.join(first, "variant").select("file_no", F.array_join(F.transform(F.map_entries(shared), lambda e: F.concat_ws("=", e["key"], e["value"])), ";").alias("attrs"))
