"""Queries of quality-control reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import catalog as paths
from ..operators import indicators, qc, units
from .catalogue import query
from .inputs import catalog, daily, dated, field, member, series, simulated, sql, table
from .q_select import six


def yearly(spark, sf):
    wide = indicators.run_indicators(dated(daily(spark, sf)), ["rx1day", "su", "r10mm"])
    cast = wide.select("cell_id", "year", "rx1day", F.col("su").cast("double").alias("su"), F.col("r10mm").cast("double").alias("r10mm"))
    return cast.unpivot(["cell_id", "year"], ["rx1day", "su", "r10mm"], "indicator", "value")


YEARLY = "yw AS (SELECT cell_id, year, max(pr) AS rx1day, count(CASE WHEN tasmax > 25 THEN 1 END)::DOUBLE AS su, count(CASE WHEN pr > 10 THEN 1 END)::DOUBLE AS r10mm FROM dated GROUP BY 1, 2), yearly AS (SELECT * FROM (UNPIVOT yw ON rx1day, su, r10mm INTO NAME indicator VALUE value))"


@query("q1_ranges", sql(f"WITH {YEARLY} SELECT indicator, min(value) AS least, max(value) AS most, count(CASE WHEN value < lo OR value > hi THEN 1 END) AS n_outside FROM yearly JOIN (VALUES ('rx1day', 0, 200), ('su', 0, 100)) r(indicator, lo, hi) USING (indicator) WHERE value <> -9999 GROUP BY 1", "dated"))
def _(spark, sf):
    return qc.qc_ranges(yearly(spark, sf), spark.createDataFrame([("rx1day", 0.0, 200.0), ("su", 0.0, 100.0)], "indicator string, min double, max double"))


@query("q2_units", sql(f"WITH {YEARLY} SELECT DISTINCT indicator, CASE indicator WHEN 'rx1day' THEN 'mm' END AS units, CASE indicator WHEN 'rx1day' THEN 'mm' WHEN 'su' THEN 'd' END AS expected, indicator <> 'su' AS ok FROM yearly", "dated"))
def _(spark, sf):
    named = yearly(spark, sf).withColumn("units", F.when(F.col("indicator") == "rx1day", "mm"))
    return qc.qc_units(named, spark.createDataFrame([("rx1day", "mm"), ("su", "d")], "indicator string, units string"))


@query("q3_nodata_match", sql("WITH f AS (SELECT model, scenario, cell_id, arg_min_null(v, date) IS NULL AS a FROM (SELECT model, scenario, cell_id, date, CASE WHEN pr < 20 THEN pr END AS v FROM members) GROUP BY ALL) SELECT model, scenario, cell_id, d.year FROM (SELECT DISTINCT model, scenario, cell_id, year FROM members) d JOIN f USING (model, scenario, cell_id) WHERE a <> (cell_id % 3 = 0)", "members"))
def _(spark, sf):
    src = member(spark, sf, "pr").withColumn("value", F.when(F.col("value") < 20, F.col("value")))
    out = src.select("model", "scenario", "cell_id", "year", F.when(F.col("cell_id") % 3 != 0, F.lit(1.0)).alias("value")).distinct()
    return qc.qc_nodata_match(out, src)


@query("q4_names", sql("SELECT path, split_part(filename, '_', 1) AS named, CASE WHEN file_no % 100 = 0 THEN 'orog' ELSE variable END AS variable FROM catalog WHERE file_no % 100 = 0", "catalog"))
def _(spark, sf):
    c = catalog(spark, sf).withColumn("variable", F.when(F.col("file_no") % 100 == 0, "orog").otherwise(F.col("variable")))
    return qc.qc_names(c).select("path", "named", "variable")


@query("q5_regrid_range", sql("WITH s AS (SELECT cell_id, min(pr) AS source_min, max(pr) AS source_max FROM daily GROUP BY 1), o AS (SELECT cell_id, min(value) AS out_min, max(value) AS out_max FROM simulated GROUP BY 1) SELECT cell_id, source_min, source_max, round(out_min, 6) AS out_min, round(out_max, 6) AS out_max, out_min >= source_min - 0.05e0 * (source_max - source_min) AND out_max <= source_max + 0.05e0 * (source_max - source_min) AS ok FROM s JOIN o USING (cell_id)", "daily", "simulated"))
def _(spark, sf):
    return six(qc.qc_regrid_range(series(spark, sf, "pr"), simulated(spark, sf), ["cell_id"]), "out_min", "out_max")


@query("q6_log_scan", "SELECT CASE WHEN page_id % 5 = 0 THEN 'overwrite' ELSE 'error' END AS kind, regexp_extract(line, '(\\S+/\\S+)', 1) AS path FROM (SELECT page_id, CASE WHEN page_id % 5 = 0 THEN 'OVERWRITE: ' || url WHEN page_id % 5 = 1 THEN 'PROCESSING ERROR in ' || url ELSE 'done ' || url END AS line FROM pages) WHERE page_id % 5 IN (0, 1)")
def _(spark, sf):
    line = F.concat(F.when(F.col("page_id") % 5 == 0, "OVERWRITE: ").when(F.col("page_id") % 5 == 1, "PROCESSING ERROR in ").otherwise("done "), F.col("url"))
    return qc.qc_log_scan(table(spark, sf, "pages").select(line.alias("value")))


def _pct(cond: str) -> str:
    return f"round(100e0 * count(CASE WHEN {cond} THEN 1 END) / count(*), 6)"


@query("q7_check_bounds", sql(f"SELECT model, scenario, 'pr' AS variable, '> 150' AS condition, {_pct('value > 150')} AS pct, count(CASE WHEN value > 150 THEN 1 END) = 0 AS ok FROM field WHERE variable = 'pr' GROUP BY 1, 2 UNION ALL SELECT model, scenario, 'tasmin', '< -70', {_pct('value < -70')}, count(CASE WHEN value < -70 THEN 1 END) = 0 FROM field WHERE variable = 'tasmin' GROUP BY 1, 2", "field"))
def _(spark, sf):
    return six(qc.check_bounds(field(spark, sf), [("pr", ">", 150), ("tasmin", "<", -70)], ["model", "scenario"]), "pct")


@query("q8_check_order", sql(f"SELECT cell_id, {_pct('tasmin + 30 > tasmax')} AS pct FROM daily GROUP BY 1", "daily"))
def _(spark, sf):
    d = daily(spark, sf)
    low, high = d.select("cell_id", "date", (F.col("tasmin") + 30).alias("value")), d.select("cell_id", "date", F.col("tasmax").alias("value"))
    return six(qc.check_order(low, high, ["cell_id", "date"], ["cell_id"]), "pct")


@query("q9_presence_matrix", sql("SELECT model, bool_or(scenario = 'historical') AS historical, bool_or(scenario = 'ssp585') AS ssp585, false AS ssp126 FROM field GROUP BY 1", "field"))
def _(spark, sf):
    return qc.presence_matrix(field(spark, sf), ["historical", "ssp585", "ssp126"])


@query("q10_validate_attrs", sql("SELECT path, 'variable' AS \"column\" FROM catalog WHERE file_no % 40 = 0 UNION ALL SELECT path, 'model' FROM catalog WHERE file_no % 60 = 0", "catalog"))
def _(spark, sf):
    c = catalog(spark, sf)
    claimed = c.withColumns({"variable": F.when(F.col("file_no") % 40 == 0, "x").otherwise(F.col("variable")), "model": F.when(F.col("file_no") % 60 == 0, "y").otherwise(F.col("model"))})
    return qc.validate_attrs(paths.parse_path(c), claimed, "path", ["model", "scenario", "variable"])


@query("q11_recompute_compare", sql("SELECT cell_id, date, dtr, only_in FROM (SELECT cell_id, date, 0e0 AS dtr, 'stored' AS only_in FROM daily WHERE day(date) = 3 AND round(tasmax - tasmin, 6) <> 0 UNION ALL SELECT cell_id, date, round(tasmax - tasmin, 6), 'again' FROM daily WHERE day(date) = 3 AND round(tasmax - tasmin, 6) <> 0)", "daily"))
def _(spark, sf):
    d = daily(spark, sf)
    again = d.select("cell_id", "date", F.round(units.dtr(F.col("tasmax"), F.col("tasmin")), 6).alias("dtr"))
    stored = again.withColumn("dtr", F.when(F.dayofmonth("date") == 3, 0.0).otherwise(F.col("dtr")))
    return qc.recompute_compare(stored, again)


@query("q12_check_value_range", sql("SELECT cell_id, round(min(tasmax - tasmin), 6) AS min, round(max(tasmax - tasmin), 6) AS max, min(tasmax - tasmin) >= 0 AND max(tasmax - tasmin) < 66 AND min(tasmax - tasmin) < max(tasmax - tasmin) AS ok FROM daily GROUP BY 1", "daily"))
def _(spark, sf):
    d = daily(spark, sf).select("cell_id", (F.col("tasmax") - F.col("tasmin")).alias("value"))
    return six(qc.check_value_range(d, 0, 66, ["cell_id"]), "min", "max")


@query("q13_mirror_check", sql("SELECT path FROM catalog WHERE file_no % 7 = 3 EXCEPT SELECT path FROM catalog WHERE file_no % 7 <> 3", "catalog"))
def _(spark, sf):
    c = catalog(spark, sf)
    return qc.mirror_check(c, c.where("file_no % 7 <> 3"))


@query("q14_check_single_params", sql("SELECT DISTINCT model, scenario, variable FROM catalog WHERE variable NOT IN ('pr', 'tas', 'tasmax') OR scenario NOT IN ('historical', 'ssp585')", "catalog"))
def _(spark, sf):
    models = [f"NATION_{i}" for i in range(25)]
    return qc.check_single_params(paths.parse_path(catalog(spark, sf)), {"model": models, "scenario": ["historical", "ssp585"], "variable": ["pr", "tas", "tasmax"]})
