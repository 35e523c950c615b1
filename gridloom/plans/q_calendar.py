"""Queries of calendars and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import calendar, joins
from .catalogue import query
from .inputs import catalog, daily, field, grid, hourly, series, simulated, sql
from .q_select import six


@query("c1_resample_daily", sql("SELECT cell_id, ts::DATE AS date, min(value) AS t2min, round(avg(value), 6) AS t2, max(value) AS t2max, round(sum(value), 6) AS pr FROM hourly GROUP BY 1, 2", "hourly"))
def _(spark, sf):
    return six(calendar.resample_daily(hourly(spark, sf), {"t2min": "min", "t2": "mean", "t2max": "max", "pr": "sum"}), "t2", "pr")


@query("c2_gregorian_to_noleap", sql("SELECT cell_id, date, doy FROM dated WHERE doy IS NOT NULL", "dated"))
def _(spark, sf):
    return calendar.gregorian_to_noleap(daily(spark, sf)).select("cell_id", "date", "doy")


@query("c3_cal360_to_noleap")
def _(spark, sf):
    own = series(spark, sf, "pr").where("doy <= 360").groupBy("cell_id", "year", F.col("doy").alias("doy360")).agg(F.avg("value").alias("value"))
    return calendar.cal360_to_noleap(own, 1994, 2004)


@query("c4_fix_hour_12", sql("SELECT cell_id, make_timestamp(year(date), month(date), day(date), 12, 0, 0) AS ts FROM daily", "daily"))
def _(spark, sf):
    return daily(spark, sf).select("cell_id", calendar.fix_hour_12(F.col("date")).alias("ts"))


@query("c5_month_to_15th", sql("SELECT cell_id, make_date(year(date), month(date), 15) AS date, count(*) AS n FROM daily GROUP BY 1, 2", "daily"))
def _(spark, sf):
    return daily(spark, sf).groupBy("cell_id", calendar.month_to_15th(F.col("date")).alias("date")).agg(F.count("*").alias("n"))


@query("c6_infer_frequency", sql("WITH s AS (SELECT DISTINCT 'd' || cell_id AS source, date FROM daily UNION SELECT DISTINCT 'm' || cell_id, make_date(year(date), month(date), 1) FROM daily), r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY date) AS n FROM s) SELECT source, (max(date) - min(date))::INT AS gap_days, CASE WHEN max(date) - min(date) = 1 THEN 'day' WHEN max(date) - min(date) BETWEEN 28 AND 31 THEN 'mon' END AS frequency FROM r WHERE n IN (2, 3) GROUP BY 1", "daily"))
def _(spark, sf):
    d = daily(spark, sf)
    s = d.select(F.concat(F.lit("d"), "cell_id").alias("source"), "date").union(d.select(F.concat(F.lit("m"), "cell_id"), F.trunc("date", "month")))
    return calendar.infer_frequency(s)


@query("c7_align_time", sql("SELECT cell_id, date, 'a' AS only_in FROM (SELECT cell_id, date FROM daily EXCEPT SELECT cell_id, date FROM simulated) UNION ALL SELECT cell_id, date, 'b' FROM (SELECT cell_id, date FROM simulated EXCEPT SELECT cell_id, date FROM daily)", "daily", "simulated"))
def _(spark, sf):
    return calendar.align_time(daily(spark, sf), simulated(spark, sf), ["cell_id"])


@query("c8_expected_outputs", sql("SELECT 's' || cell_id AS source, year, year || lpad(min(month)::VARCHAR, 2, '0') || '01-' || year || lpad(max(month)::VARCHAR, 2, '0') || '31' AS timeframe FROM dated GROUP BY cell_id, year", "dated"))
def _(spark, sf):
    return calendar.expected_outputs(daily(spark, sf).withColumn("source", F.concat(F.lit("s"), "cell_id")))


@query("c9_year_month", sql("SELECT cell_id, date_trunc('month', date)::DATE AS ym, sum(pr) AS total FROM daily GROUP BY 1, 2", "daily"))
def _(spark, sf):
    return daily(spark, sf).groupBy("cell_id", calendar.year_month(F.col("date")).alias("ym")).agg(F.sum("pr").alias("total"))


@query("c10_year_start_end", sql("SELECT cell_id, year, min(date) AS first, max(date) AS last, strftime(min(date), '%Y%m%d') || '-' || strftime(max(date), '%Y%m%d') AS timeframe FROM dated GROUP BY 1, 2", "dated"))
def _(spark, sf):
    return calendar.year_start_end(daily(spark, sf))


@query("j1_align_inner", sql("SELECT cell_id, date, d.pr AS ref, s.value AS sim FROM daily d JOIN simulated s USING (cell_id, date)", "daily", "simulated"))
def _(spark, sf):
    return joins.align_inner(series(spark, sf, "pr"), simulated(spark, sf), ["cell_id", "date"], ("ref", "sim"))


@query("j2_align_pairs", sql("SELECT cell_id, date, x IS NOT NULL AND y IS NOT NULL AS matched FROM (SELECT DISTINCT cell_id, date, 1 AS x FROM daily) FULL JOIN (SELECT DISTINCT cell_id, date, 1 AS y FROM simulated) USING (cell_id, date)", "daily", "simulated"))
def _(spark, sf):
    return joins.align_pairs(daily(spark, sf), simulated(spark, sf), ["cell_id", "date"])


@query("j3_merge_variables", sql("SELECT cell_id, date, pr, value AS sim FROM daily FULL JOIN simulated USING (cell_id, date)", "daily", "simulated"))
def _(spark, sf):
    return joins.merge_variables(daily(spark, sf).select("cell_id", "date", "pr"), simulated(spark, sf).select("cell_id", "date", F.col("value").alias("sim")), ["cell_id", "date"])


@query("j4_doy_threshold_join", sql("SELECT d.cell_id, d.date, d.pr > t.threshold AS over FROM dated d JOIN (SELECT cell_id, doy, avg(pr) AS threshold FROM dated WHERE doy IS NOT NULL GROUP BY 1, 2) t USING (cell_id, doy)", "dated"))
def _(spark, sf):
    pr = series(spark, sf, "pr")
    limits = pr.where("doy is not null").groupBy("cell_id", "doy").agg(F.avg("value").alias("threshold"))
    return joins.doy_threshold_join(pr, limits).select("cell_id", "date", (F.col("value") > F.col("threshold")).alias("over"))


_FILES = "f AS (SELECT model, variable, filename, min(strptime(regexp_extract(filename, '(\\d{6})-(\\d{6})\\.nc$', 1), '%Y%m'))::DATE AS start, last_day(min(strptime(regexp_extract(filename, '(\\d{6})-(\\d{6})\\.nc$', 2), '%Y%m'))::DATE) AS stop FROM catalog WHERE variable <> 'sftlf' GROUP BY 1, 2, 3)"


@query("j6_temporal_containment", sql(f"WITH {_FILES}, d AS (SELECT DISTINCT model, variable, day AS date FROM catalog WHERE variable <> 'sftlf') SELECT d.model, d.variable, d.date, count(f.filename) AS n_matches, min(f.filename) AS filename FROM d LEFT JOIN f ON d.model = f.model AND d.variable = f.variable AND d.date BETWEEN f.start AND f.stop GROUP BY 1, 2, 3", "catalog"))
def _(spark, sf):
    c = catalog(spark, sf).where("variable <> 'sftlf'")
    a, b = joins.file_span(F.col("filename"))
    files = c.select("model", "variable", "filename", a.alias("start"), b.alias("stop")).distinct()
    dates = c.select("model", "variable", F.col("day").alias("date")).distinct()
    return joins.temporal_containment(dates, files, ["model", "variable"])


@query("j7_time_nearest", sql('WITH w AS (SELECT DISTINCT cell_id, date AS "at" FROM simulated) SELECT cell_id, "at", arg_min(date, (abs(date - "at"), date)) AS date, arg_min(pr, (abs(date - "at"), date)) AS value FROM w LEFT JOIN daily USING (cell_id) GROUP BY 1, 2', "daily", "simulated"))
def _(spark, sf):
    wanted = simulated(spark, sf).select("cell_id", F.col("date").alias("at")).distinct()
    return joins.time_nearest(series(spark, sf, "pr"), wanted, ["cell_id"])


@query("j9_lookup", sql("SELECT model, scenario, variable, unit, CASE WHEN scenario = 'historical' THEN model || '-a' ELSE model || '-b' END AS institution, count(*) AS n FROM field LEFT JOIN (VALUES ('pr', 'mm/day'), ('tasmax', 'degC')) u(variable, unit) USING (variable) GROUP BY ALL", "field"))
def _(spark, sf):
    names = spark.createDataFrame([("pr", "mm/day"), ("tasmax", "degC")], "variable string, unit string")
    activity = F.when(F.col("scenario") == "historical", "CMIP").otherwise("ScenarioMIP")
    own = F.array(F.concat("model", F.lit("-a")), F.concat("model", F.lit("-b")))
    out = joins.lookup(field(spark, sf), names, ["variable"]).withColumn("institution", joins.institution(F.col("model"), activity, own))
    return out.groupBy("model", "scenario", "variable", "unit", "institution").agg(F.count("*").alias("n"))


@query("j10_expected_vs_existing", sql("SELECT m.model, s.scenario, v.variable FROM (SELECT DISTINCT model FROM field) m, (VALUES ('historical'), ('ssp585'), ('ssp126')) s(scenario), (VALUES ('pr'), ('snw')) v(variable) WHERE NOT EXISTS (SELECT 1 FROM field f WHERE f.model = m.model AND f.scenario = s.scenario AND f.variable = v.variable)", "field"))
def _(spark, sf):
    f = field(spark, sf)
    return joins.expected_vs_existing([f.select("model").distinct(), spark.createDataFrame([("historical",), ("ssp585",), ("ssp126",)], "scenario string"), spark.createDataFrame([("pr",), ("snw",)], "variable string")], f)


@query("j11_validate_source", sql("SELECT DISTINCT 'c' || cell_id AS model FROM simulated WHERE 'c' || cell_id NOT IN (SELECT 'c' || cell_id FROM daily WHERE cell_id % 4 <> 1)", "daily", "simulated"))
def _(spark, sf):
    key = lambda d: d.withColumn("model", F.concat(F.lit("c"), "cell_id"))
    return joins.validate_source(key(daily(spark, sf).where("cell_id % 4 <> 1")), key(simulated(spark, sf)))


@query("j12_triplets", sql("SELECT model, scenario, bool_or(variable = 'tasmax') AS tasmax, bool_or(variable = 'tasmin' AND grid_type = 'gn') AS tasmin, bool_or(variable = 'pr' AND table_id = 'Amon') AS pr FROM catalog WHERE variable = 'tasmax' OR (variable = 'tasmin' AND grid_type = 'gn') OR (variable = 'pr' AND table_id = 'Amon') GROUP BY 1, 2", "catalog"))
def _(spark, sf):
    c = catalog(spark, sf)
    return joins.triplets(c.where("variable = 'tasmax'"), c.where("variable = 'tasmin' and grid_type = 'gn'"), c.where("variable = 'pr' and table_id = 'Amon'"), ["model", "scenario"], ["tasmax", "tasmin", "pr"])


_KM = "2 * 6371e0 * asin(sqrt(pow(sin(radians(lat - plat) / 2), 2) + cos(radians(plat)) * cos(radians(lat)) * pow(sin(radians(lon - plon) / 2), 2)))"


@query("j5_nearest_point_join", sql(f"WITH c AS (SELECT name, arg_min(cell_id, (round({_KM}, 9), cell_id)) AS cell_id FROM grid, (VALUES ('fairbanks', 64.8e0, -147.7e0), ('juneau', 58.3e0, -134.4e0)) p(name, plat, plon) GROUP BY name) SELECT name, date, pr FROM c JOIN daily USING (cell_id)", "daily", "grid"))
def _(spark, sf):
    from ..operators.select import sel_nearest

    points = spark.createDataFrame([("fairbanks", 64.8, -147.7), ("juneau", 58.3, -134.4)], "name string, plat double, plon double")
    return daily(spark, sf).join(sel_nearest(grid(spark, sf), points).select("name", "cell_id"), "cell_id").select("name", "date", "pr")
