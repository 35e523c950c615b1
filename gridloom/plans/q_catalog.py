"""Queries of catalogue tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import catalog as ops
from .catalogue import query
from .inputs import catalog, sql, table
from .q_select import six

SCENARIOS = ["historical", "ssp126", "ssp245", "ssp370", "ssp585"]
TICKS = ", ".join(f"bool_or(variable = '{v}') AS {v}" for v in ("pr", "tasmax", "tasmin"))


def requests(spark, sf):
    models = catalog(spark, sf).groupBy("model").agg(F.array_sort(F.collect_set("variant")).alias("variants"))
    variables = spark.createDataFrame([("day", "pr"), ("Amon", "tas"), ("fx", "orog")], "table_id string, variable string")
    return ops.expand_requests(models, variables, ["historical", "ssp585"])


REQUESTS = "req AS (SELECT model, variant, scenario, CASE WHEN scenario = 'historical' THEN 'CMIP' ELSE 'ScenarioMIP' END AS activity, table_id, variable FROM (SELECT DISTINCT model, variant FROM catalog), (VALUES ('historical'), ('ssp585')) s(scenario), (VALUES ('day', 'pr'), ('Amon', 'tas'), ('fx', 'orog')) v(table_id, variable))"
HELD = "last AS (SELECT model, scenario, variant, table_id, variable, grid_type, max(version) AS version FROM catalog GROUP BY ALL), held AS (SELECT model, scenario, variant, table_id, variable, grid_type, version, count(*) AS n_files, list_sort(list(filename)) AS filenames FROM catalog JOIN last USING (model, scenario, variant, table_id, variable, grid_type, version) GROUP BY ALL)"


@query("t1_expand_requests", sql(f"WITH {REQUESTS} SELECT * FROM req", "catalog"))
def _(spark, sf):
    return requests(spark, sf)


@query("t2_holdings_table", sql(f"WITH {REQUESTS}, {HELD} SELECT model, scenario, variant, table_id, variable, grid_type, version, n_files, filenames[1] AS first_file FROM req LEFT JOIN held USING (model, scenario, variant, table_id, variable)", "catalog"))
def _(spark, sf):
    out = ops.holdings_table(requests(spark, sf), catalog(spark, sf))
    return out.select("model", "scenario", "variant", "table_id", "variable", "grid_type", "version", "n_files", F.get("filenames", 0).alias("first_file"))


@query("t3_manifest", sql(f"WITH {HELD}, u AS (SELECT * EXCLUDE (filenames), unnest(filenames) AS filename FROM held WHERE variant = 'r2i1p1f1' AND grid_type = 'gn'), d AS (SELECT *, regexp_extract(filename, '(\\d{{6,12}})-(\\d{{6,12}})\\.nc$', 1) AS a, regexp_extract(filename, '(\\d{{6,12}})-(\\d{{6,12}})\\.nc$', 2) AS b FROM u) SELECT model, scenario, variant, table_id, variable, grid_type, version, CASE WHEN a <> '' THEN a[1:4]::INT END AS start_year, CASE WHEN a <> '' THEN a[5:6]::INT END AS start_month, CASE WHEN len(a) >= 8 THEN a[7:8]::INT END AS start_day, CASE WHEN b <> '' THEN b[1:4]::INT END AS end_year, CASE WHEN b <> '' THEN b[5:6]::INT END AS end_month, CASE WHEN len(b) >= 8 THEN b[7:8]::INT END AS end_day, filename FROM d", "catalog"))
def _(spark, sf):
    c = catalog(spark, sf)
    keys = c.select("model", "scenario", "variant", "table_id", "variable").distinct()
    production = c.select("model").distinct().select("model", F.lit("r2i1p1f1").alias("variant"), F.array(F.lit("gn")).alias("grids"))
    return ops.manifest(ops.holdings_table(keys, c), production)


@query("t4_fallback_rows", sql("SELECT model, variable, min(path) AS path FROM catalog c WHERE variable IN ('sftlf') AND NOT EXISTS (SELECT 1 FROM catalog d WHERE d.model = c.model AND d.variable = c.variable AND d.variant = 'r1i1p1f1' AND d.bytes > 490000) GROUP BY 1, 2", "catalog"))
def _(spark, sf):
    c = catalog(spark, sf)
    return ops.fallback_rows(c.where("variant = 'r1i1p1f1' and bytes > 490000"), c, ["sftlf"])


@query("t5_append_extra", sql("SELECT variable, grid_type, count(*) AS n FROM (SELECT variable, grid_type FROM catalog WHERE variable = 'pr' UNION ALL SELECT variable, grid_type FROM catalog WHERE variable = 'sftlf' AND file_no % 10 = 0) GROUP BY 1, 2", "catalog"))
def _(spark, sf):
    c = catalog(spark, sf)
    return ops.append_extra(c.where("variable = 'pr'"), c.where("variable = 'sftlf' and file_no % 10 = 0").select("path")).groupBy("variable", "grid_type").agg(F.count("*").alias("n"))


@query("t6_transfer_pairs", sql("SELECT CASE WHEN model LIKE 'NATION_1%' THEN 'one' WHEN model LIKE 'NATION_2%' THEN 'two' ELSE 'main' END || '/' || path AS src, 'mirror/' || path AS dst FROM catalog", "catalog"))
def _(spark, sf):
    return ops.transfer_pairs(catalog(spark, sf), {"NATION_1": "one", "NATION_2": "two"}, "main", "mirror")


@query("t7_parse_archive_path", sql("SELECT path, split_part(path, '/', -8) AS model, split_part(path, '/', -7) AS scenario, split_part(path, '/', -6) AS variant, split_part(path, '/', -5) AS table_id, split_part(path, '/', -4) AS variable, split_part(path, '/', -3) AS grid_type, split_part(path, '/', -2) AS version, split_part(path, '/', -1) AS filename FROM catalog", "catalog"))
def _(spark, sf):
    return ops.parse_path(catalog(spark, sf))


_LAYOUTS = "CASE file_no % 3 WHEN 0 THEN path WHEN 1 THEN 'out/' || model || '/' || scenario || '/' || table_id || '/' || variable || '/' || variable || '_' || model || '_regrid_' || strftime(day, '%Y%m%d') || '.nc' ELSE 'cmip6_dtr/' || model || '/' || scenario || '/day/dtr/dtr_' || model || '_' || strftime(day, '%Y%m') || '.nc' END"


@query("t7_layouts", sql(f"WITH p AS (SELECT *, {_LAYOUTS} AS p, file_no % 3 AS k FROM catalog) SELECT p AS path, CASE k WHEN 0 THEN 'mirror' WHEN 1 THEN 'regrid' ELSE 'dtr' END AS layout, model, scenario, CASE WHEN k = 0 THEN variant END AS variant, CASE WHEN k = 2 THEN 'day' ELSE table_id END AS table_id, CASE WHEN k = 2 THEN 'dtr' ELSE variable END AS variable, CASE WHEN k = 0 THEN grid_type END AS grid_type, CASE k WHEN 0 THEN replace(split_part(filename, '_', -1), '.nc', '') WHEN 1 THEN strftime(day, '%Y%m%d') ELSE strftime(day, '%Y%m') END AS timeframe FROM p", "catalog"))
def _(spark, sf):
    c = catalog(spark, sf)
    dated = lambda form: F.date_format("day", form)
    regrid = F.concat(F.concat_ws("/", F.lit("out"), "model", "scenario", "table_id", "variable", F.concat_ws("_", "variable", "model", F.lit("regrid"), dated("yyyyMMdd"))), F.lit(".nc"))
    dtr = F.concat(F.concat_ws("/", F.lit("cmip6_dtr"), "model", "scenario", F.lit("day/dtr"), F.concat_ws("_", F.lit("dtr"), "model", dated("yyyyMM"))), F.lit(".nc"))
    paths = c.select(F.when(F.col("file_no") % 3 == 0, F.col("path")).when(F.col("file_no") % 3 == 1, regrid).otherwise(dtr).alias("path"))
    return ops.parse_layouts(paths)


@query("t8_regrid_name", sql("SELECT filename, regexp_replace(filename, '_g[a-z0-9]+(_[0-9]+-[0-9]+)?\\.nc$', '_regrid\\1.nc') AS name FROM catalog", "catalog"))
def _(spark, sf):
    return catalog(spark, sf).select("filename", ops.regrid_name(F.col("filename")).alias("name"))


@query("t8_source_of_regrid", sql("WITH f AS (SELECT model, variable, filename, strptime(regexp_extract(filename, '(\\d{6})-(\\d{6})\\.nc$', 1), '%Y%m')::DATE AS start, last_day(strptime(regexp_extract(filename, '(\\d{6})-(\\d{6})\\.nc$', 2), '%Y%m')::DATE) AS stop FROM (SELECT DISTINCT model, variable, filename FROM catalog WHERE variable = 'tas')), d AS (SELECT DISTINCT model, variable, make_date(year(day), 7, 15) AS date FROM catalog WHERE variable = 'tas') SELECT d.model, d.variable, d.date, count(f.filename) AS n_matches, min(f.filename) AS filename FROM d LEFT JOIN f ON d.model = f.model AND d.variable = f.variable AND d.date BETWEEN f.start AND f.stop GROUP BY 1, 2, 3", "catalog"))
def _(spark, sf):
    from ..operators.joins import file_span

    c = catalog(spark, sf).where("variable = 'tas'")
    a, b = file_span(F.col("filename"))
    files = c.select("model", "variable", "filename", a.alias("start"), b.alias("stop")).distinct()
    made = c.select("model", "variable", F.make_date(F.year("day"), F.lit(7), F.lit(15)).alias("date")).distinct()
    return ops.source_of_regrid(made, files, ["model", "variable"])


@query("t9_availability_matrix", sql(f"SELECT model, scenario, {TICKS} FROM catalog WHERE table_id = 'day' GROUP BY 1, 2", "catalog"))
def _(spark, sf):
    return ops.availability_matrix(catalog(spark, sf), ["pr", "tasmax", "tasmin"], ["day"])


@query("t10_normalise_frequency", sql("SELECT CASE table_id WHEN 'Amon' THEN 'mon' ELSE table_id END AS frequency, count(*) AS n FROM catalog GROUP BY 1", "catalog"))
def _(spark, sf):
    return catalog(spark, sf).groupBy(ops.normalise_frequency(F.col("table_id")).alias("frequency")).agg(F.count("*").alias("n"))


@query("t11_set_difference", sql("SELECT model, table_id, variable FROM catalog WHERE bytes > 480000 AND variant = 'r1i1p1f1' EXCEPT SELECT model, table_id, variable FROM catalog WHERE bytes > 480000 AND variant = 'r2i1p1f1'", "catalog"))
def _(spark, sf):
    return ops.set_difference(catalog(spark, sf).where("bytes > 480000"), "r1i1p1f1", "r2i1p1f1")


@query("t12_by_grid", sql("SELECT DISTINCT model, table_id, variable, grid_type, n > 1 AS shared FROM catalog JOIN (SELECT model, table_id, variable, count(DISTINCT grid_type) AS n FROM catalog GROUP BY 1, 2, 3) USING (model, table_id, variable)", "catalog"))
def _(spark, sf):
    return ops.by_grid(catalog(spark, sf))


@query("t13_best_variants", sql("WITH n AS (SELECT model, scenario, variant, count(DISTINCT (table_id, variable)) AS n FROM catalog GROUP BY 1, 2, 3), t AS (SELECT model, scenario, max(n) AS n FROM n GROUP BY 1, 2) SELECT model, variant FROM n JOIN t USING (model, scenario, n) GROUP BY 1, 2 HAVING count(DISTINCT scenario) = 5", "catalog"))
def _(spark, sf):
    return ops.best_variants(catalog(spark, sf), SCENARIOS)


@query("t14_dedupe_paths", "SELECT regexp_extract(url, '^[^?#]*') AS path, count(*) AS n FROM pages GROUP BY 1")
def _(spark, sf):
    return ops.dedupe_paths(table(spark, sf, "pages").select(F.regexp_extract("url", r"^[^?#]*", 0).alias("path")))


@query("t15_union_holdings", sql(f"WITH {REQUESTS}, {HELD}, h AS (SELECT model, variable, n_files FROM req LEFT JOIN held USING (model, scenario, variant, table_id, variable)) SELECT model, variable, n_files FROM (SELECT * FROM h UNION ALL SELECT 'E3SM', variable, n_files FROM h) WHERE n_files IS NOT NULL", "catalog"))
def _(spark, sf):
    h = ops.holdings_table(requests(spark, sf), catalog(spark, sf)).select("model", "variable", "n_files")
    return ops.union_holdings(h, h.withColumn("model", F.lit("E3SM")))


@query("t16_melt", sql("WITH s AS (SELECT model, avg(bytes) AS mean_bytes, max(bytes)::DOUBLE AS max_bytes FROM catalog GROUP BY 1) SELECT model, indicator, round(pval, 6) AS pval FROM (UNPIVOT s ON mean_bytes, max_bytes INTO NAME indicator VALUE pval)", "catalog"))
def _(spark, sf):
    s = catalog(spark, sf).groupBy("model").agg(F.avg("bytes").alias("mean_bytes"), F.max("bytes").cast("double").alias("max_bytes"))
    return six(ops.melt(s, ["model"], ["mean_bytes", "max_bytes"], "indicator", "pval"), "pval")


@query("t17_ensemble_key", sql("WITH v AS (SELECT model, min(variant) AS variant FROM catalog WHERE model NOT LIKE '%7' GROUP BY 1) SELECT c.model, c.scenario, coalesce(v.variant, 'unknown') AS variant, c.model || '_' || coalesce(v.variant, 'unknown') || '_' || c.scenario AS ensemble, count(*) AS n FROM catalog c LEFT JOIN v USING (model) GROUP BY 1, 2, 3, 4", "catalog"))
def _(spark, sf):
    c = catalog(spark, sf)
    v = c.where("model not like '%7'").groupBy("model").agg(F.min("variant").alias("variant"))
    return ops.ensemble_key(c.drop("variant"), v).groupBy("model", "scenario", "variant", "ensemble").agg(F.count("*").alias("n"))
