"""Climate-shaped inputs made from the given star-schema tables, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import noleap_doy


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def daily(spark: SparkSession, sf: str) -> DataFrame:
    """cell_id, date, pr, tasmax, tasmin: a cell per nation, line items by shipping day."""
    items, suppliers = table(spark, sf, "lineitem"), table(spark, sf, "supplier")
    rows = items.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    return rows.groupBy(F.col("s_nationkey").cast("long").alias("cell_id"), F.to_date("l_shipdate").alias("date")).agg(
        F.sum("l_quantity").alias("pr"), (F.max("l_extendedprice") / 2000 - 20).alias("tasmax"), (F.min("l_extendedprice") / 2000 - 35).alias("tasmin")
    )


def dated(df: DataFrame) -> DataFrame:
    d = F.col("date")
    return df.withColumns({"year": F.year(d), "month": F.month(d), "doy": noleap_doy(d)})


def series(spark: SparkSession, sf: str, variable: str) -> DataFrame:
    """cell_id, date, year, month, doy, value of one daily variable."""
    return dated(daily(spark, sf).select("cell_id", "date", F.col(variable).alias("value")))


def field(spark: SparkSession, sf: str) -> DataFrame:
    """Long table: model, scenario, variable, cell_id, date, year, month, doy, value."""
    wide = dated(daily(spark, sf))
    tall = wide.unpivot(["cell_id", "date", "year", "month", "doy"], ["pr", "tasmax", "tasmin"], "variable", "value")
    return tall.withColumns({"model": F.concat(F.lit("m"), F.col("cell_id") % 3), "scenario": F.when(F.col("year") <= 1998, "historical").otherwise("ssp585")})


def members(spark: SparkSession, sf: str) -> DataFrame:
    """Wide daily table of two models and two scenarios: model, scenario, cell_id, date, year, month, doy, pr, tasmax, tasmin. Every seventh cell
    lacks precipitation in the first half of a month."""
    items, suppliers = table(spark, sf, "lineitem"), table(spark, sf, "supplier")
    rows = items.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    days = rows.groupBy(F.concat(F.lit("m"), F.col("l_linenumber") % 2).alias("model"), F.col("s_nationkey").cast("long").alias("cell_id"), F.to_date("l_shipdate").alias("date")).agg(
        (F.greatest(F.lit(0.0), F.sum("l_quantity") - 25) / 4).alias("pr"), (F.max("l_extendedprice") / 2000 - 20).alias("tasmax"), (F.min("l_extendedprice") / 2000 - 35).alias("tasmin")
    )
    later, gone = F.col("year") > 1998, (F.col("cell_id") % 7 == 0) & (F.dayofmonth("date") <= 15)
    warmer = F.when(later, 12.0).otherwise(0.0)
    return dated(days).withColumns({"scenario": F.when(later, "ssp585").otherwise("historical"), "pr": F.when(~gone, F.col("pr")), "tasmax": F.col("tasmax") + warmer, "tasmin": F.col("tasmin") - warmer})


def member(spark: SparkSession, sf: str, variable: str) -> DataFrame:
    """model, scenario, cell_id, date, year, month, doy, value of one variable of members."""
    return members(spark, sf).select("model", "scenario", "cell_id", "date", "year", "month", "doy", F.col(variable).alias("value"))


def simulated(spark: SparkSession, sf: str) -> DataFrame:
    """cell_id, date, ..., value: order totals by customer nation and day, as a model's precipitation."""
    rows = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return dated(rows.groupBy(F.col("c_nationkey").cast("long").alias("cell_id"), F.to_date("o_orderdate").alias("date")).agg((F.floor(F.max("o_totalprice") / 10) / 1000.0).alias("value")))


def simulations(spark: SparkSession, sf: str) -> DataFrame:
    """model, scenario, cell_id, date, year, month, doy, value: simulated of two models and two scenarios."""
    rows = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    days = rows.groupBy(F.concat(F.lit("m"), F.col("o_orderkey") % 2).alias("model"), F.col("c_nationkey").cast("long").alias("cell_id"), F.to_date("o_orderdate").alias("date"))
    out = dated(days.agg((F.floor(F.max("o_totalprice") / 10) / 1000.0).alias("value")))
    return out.withColumn("scenario", F.when(F.col("year") > 1998, "ssp585").otherwise("historical"))


def grid(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("n_nationkey").cast("int")
    iy, ix = F.floor(n / 5).cast("int"), n % 5
    return table(spark, sf, "nation").select(n.cast("long").alias("cell_id"), iy.alias("iy"), ix.alias("ix"), (50.0 + 5 * iy).alias("lat"), (10.0 * ix - 170).alias("lon"), (50.0 + 5 * iy).alias("y"), (10.0 * ix - 170).alias("x"), F.col("n_regionkey").alias("region"))


def sites(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Two irregular grids (cell_id, lat, lon): a cell per customer north of 35 degrees, and one per supplier anywhere."""
    k, j = F.col("c_custkey"), F.col("s_suppkey")
    src = table(spark, sf, "customer").select(k.cast("long").alias("cell_id"), (35 + (k * 7919) % 5499 / 100).alias("lat"), ((k * 104729) % 35999 / 100 - 180).alias("lon"))
    dst = table(spark, sf, "supplier").select(j.cast("long").alias("cell_id"), ((j * 6151) % 17999 / 100 - 90).alias("lat"), ((j * 98317) % 35999 / 100 - 180).alias("lon"))
    return src, dst


def grids(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Two rectilinear grids: fifty columns of a cell per customer, and five columns of one per supplier inside it."""
    k, j = F.col("c_custkey"), F.col("s_suppkey")
    src = table(spark, sf, "customer").select(k.cast("long").alias("cell_id"), F.floor(k / 50).cast("int").alias("iy"), (k % 50).cast("int").alias("ix"))
    dst = table(spark, sf, "supplier").select(j.cast("long").alias("cell_id"), F.floor(j / 5).cast("int").alias("iy"), (j % 5).cast("int").alias("ix"))
    return src.withColumns({"lat": -70 + F.col("iy") * 0.25, "lon": -170 + F.col("ix") * 2.5}), dst.withColumns({"lat": -69.9375 + F.col("iy") * 0.6875, "lon": -168.75 + F.col("ix") * 21.25})


def hourly(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(F.col("user_id").alias("cell_id"), "ts", "value")


def catalog(spark: SparkSession, sf: str) -> DataFrame:
    """An archive's files, one per order: path parts, version from the order day, bytes from its total."""
    rows = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    one = F.substring("o_orderpriority", 1, 1).cast("int")
    names = F.array(*(F.lit(v) for v in ("tas", "pr", "tasmax", "tasmin", "sftlf")))
    variable = F.element_at(names, one)
    out = rows.select(
        F.col("n_name").alias("model"),
        F.element_at(F.array(*(F.lit(s) for s in ("historical", "ssp126", "ssp245", "ssp370", "ssp585"))), F.floor(F.col("o_custkey") % 5).cast("int") + 1).alias("scenario"),
        F.concat(F.lit("r"), F.col("o_custkey") % 3 + 1, F.lit("i1p1f1")).alias("variant"),
        F.when(variable == "sftlf", "fx").when(F.col("o_orderstatus") == "F", "Amon").otherwise("day").alias("table_id"),
        variable.alias("variable"),
        F.when(F.col("o_custkey") % 2 == 0, "gn").otherwise("gr").alias("grid_type"),
        F.concat(F.lit("v"), F.date_format("o_orderdate", "yyyyMMdd")).alias("version"),
        F.to_date("o_orderdate").alias("day"),
        F.col("o_totalprice").cast("long").alias("bytes"),
        F.col("o_orderkey").alias("file_no"),
    )
    years = F.concat(F.date_format("day", "yyyyMM"), F.lit("-"), F.date_format(F.add_months("day", 11), "yyyyMM"))
    name = F.when(F.col("variable") == "sftlf", F.concat_ws("_", "variable", "table_id", "model", "scenario", "variant", "grid_type")).otherwise(F.concat_ws("_", "variable", "table_id", "model", "scenario", "variant", "grid_type", years))
    return out.withColumn("filename", F.concat(name, F.lit(".nc"))).withColumn("path", F.concat_ws("/", F.lit("archive"), "model", "scenario", "variant", "table_id", "variable", "grid_type", "version", "filename"))


NOLEAP = "(CASE WHEN dayofyear(make_date(year({0})::INT, 12, 31)) = 366 AND dayofyear({0}) = 60 THEN NULL WHEN dayofyear(make_date(year({0})::INT, 12, 31)) = 366 AND dayofyear({0}) > 60 THEN dayofyear({0}) - 1 ELSE dayofyear({0}) END)::INT"
_DATED = f"year(date)::INT AS year, month(date)::INT AS month, {NOLEAP.format('date')} AS doy"
CTES = {
    "daily": "daily AS (SELECT s_nationkey::BIGINT AS cell_id, l_shipdate::DATE AS date, sum(l_quantity) AS pr, max(l_extendedprice) / 2000e0 - 20e0 AS tasmax, min(l_extendedprice) / 2000e0 - 35e0 AS tasmin FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2)",
    "dated": f"dated AS (SELECT *, {_DATED} FROM daily)",
    "field": "field AS (SELECT 'm' || (cell_id % 3) AS model, CASE WHEN year <= 1998 THEN 'historical' ELSE 'ssp585' END AS scenario, variable, cell_id, date, year, month, doy, value FROM (UNPIVOT dated ON pr, tasmax, tasmin INTO NAME variable VALUE value))",
    "member_days": "member_days AS (SELECT 'm' || (l_linenumber % 2) AS model, s_nationkey::BIGINT AS cell_id, l_shipdate::DATE AS date, greatest(0e0, sum(l_quantity) - 25) / 4 AS pr, max(l_extendedprice) / 2000e0 - 20e0 AS tasmax, min(l_extendedprice) / 2000e0 - 35e0 AS tasmin FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2, 3)",
    "members": f"members AS (SELECT model, CASE WHEN year(date) > 1998 THEN 'ssp585' ELSE 'historical' END AS scenario, cell_id, date, {_DATED}, CASE WHEN cell_id % 7 <> 0 OR day(date) > 15 THEN pr END AS pr, tasmax + CASE WHEN year(date) > 1998 THEN 12e0 ELSE 0e0 END AS tasmax, tasmin - CASE WHEN year(date) > 1998 THEN 12e0 ELSE 0e0 END AS tasmin FROM member_days)",
    "simulated": f"simulated AS (SELECT *, {_DATED} FROM (SELECT c_nationkey::BIGINT AS cell_id, o_orderdate::DATE AS date, floor(max(o_totalprice) / 10) / 1000e0 AS value FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2))",
    "simulations": f"simulations AS (SELECT *, CASE WHEN year > 1998 THEN 'ssp585' ELSE 'historical' END AS scenario FROM (SELECT *, {_DATED} FROM (SELECT 'm' || (o_orderkey % 2) AS model, c_nationkey::BIGINT AS cell_id, o_orderdate::DATE AS date, floor(max(o_totalprice) / 10) / 1000e0 AS value FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3)))",
    "grid": "grid AS (SELECT n_nationkey::BIGINT AS cell_id, (n_nationkey // 5)::INT AS iy, (n_nationkey % 5)::INT AS ix, 50e0 + 5 * (n_nationkey // 5) AS lat, 10e0 * (n_nationkey % 5) - 170 AS lon, 50e0 + 5 * (n_nationkey // 5) AS y, 10e0 * (n_nationkey % 5) - 170 AS x, n_regionkey AS region FROM nation)",
    "sites": "sites AS (SELECT c_custkey::BIGINT AS cell_id, 35 + (c_custkey * 7919) % 5499 / 100e0 AS lat, (c_custkey * 104729) % 35999 / 100e0 - 180 AS lon FROM customer)",
    "site_targets": "site_targets AS (SELECT s_suppkey::BIGINT AS cell_id, (s_suppkey * 6151) % 17999 / 100e0 - 90 AS lat, (s_suppkey * 98317) % 35999 / 100e0 - 180 AS lon FROM supplier)",
    "big_grid": "grid AS (SELECT *, -70e0 + iy * 0.25e0 AS lat, -170e0 + ix * 2.5e0 AS lon FROM (SELECT c_custkey::BIGINT AS cell_id, (c_custkey // 50)::INT AS iy, (c_custkey % 50)::INT AS ix FROM customer))",
    "hourly": "hourly AS (SELECT user_id AS cell_id, ts, value FROM events)",
    "catalog0": "catalog0 AS (SELECT n_name AS model, (['historical', 'ssp126', 'ssp245', 'ssp370', 'ssp585'])[(o_custkey % 5) + 1] AS scenario, 'r' || (o_custkey % 3 + 1) || 'i1p1f1' AS variant, (['tas', 'pr', 'tasmax', 'tasmin', 'sftlf'])[o_orderpriority[1:1]::INT] AS variable, o_orderstatus, CASE WHEN o_custkey % 2 = 0 THEN 'gn' ELSE 'gr' END AS grid_type, 'v' || strftime(o_orderdate, '%Y%m%d') AS version, o_orderdate::DATE AS day, trunc(o_totalprice)::BIGINT AS bytes, o_orderkey AS file_no FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)",
    "catalog1": "catalog1 AS (SELECT * EXCLUDE (o_orderstatus), CASE WHEN variable = 'sftlf' THEN 'fx' WHEN o_orderstatus = 'F' THEN 'Amon' ELSE 'day' END AS table_id FROM catalog0)",
    "catalog": "catalog AS (SELECT *, concat_ws('/', 'archive', model, scenario, variant, table_id, variable, grid_type, version, filename) AS path FROM (SELECT *, concat_ws('_', variable, table_id, model, scenario, variant, grid_type, CASE WHEN variable <> 'sftlf' THEN strftime(day, '%Y%m') || '-' || strftime(day + INTERVAL 11 MONTH, '%Y%m') END) || '.nc' AS filename FROM catalog1))",
}
_NEEDS = {"members": ["member_days"], "dated": ["daily"], "field": ["daily", "dated"], "catalog": ["catalog0", "catalog1"]}


#: The destination of big_grid.
BIG_DST = "dst AS (SELECT *, -69.9375e0 + iy * 0.6875e0 AS lat, -168.75e0 + ix * 21.25e0 AS lon FROM (SELECT s_suppkey::BIGINT AS cell_id, (s_suppkey // 5)::INT AS iy, (s_suppkey % 5)::INT AS ix FROM supplier))"


def pool_sql(source: str, column: str, half: int, keys: str = "cell_id") -> str:
    """A CTE `pool` of keys, doy, value: values in the pools of the days around them, within the series."""
    doy = NOLEAP.format("moved")
    own = ", ".join(f"s.{k}" for k in keys.split(", "))
    return f"e AS (SELECT {keys}, min(date) AS a, max(date) AS b FROM {source} GROUP BY ALL), o AS (SELECT {own}, (s.date + k.k)::DATE AS moved, {column} AS value, a, b FROM {source} s JOIN e USING ({keys}), (SELECT unnest(range({-half}, {half + 1}))::INT AS k) k), pool AS (SELECT {keys}, {doy} AS doy, value FROM o WHERE moved BETWEEN a AND b AND {doy} IS NOT NULL AND value IS NOT NULL)"


def sql(body: str, *ctes: str) -> str:
    """body with the named inputs, and those that they need, in front; `body` may begin with CTEs of its own and a comma-free SELECT."""
    names = list(dict.fromkeys(n for c in ctes for n in [*_NEEDS.get(c, []), c]))
    body = body.strip()
    more = ""
    if body[:5].upper() == "WITH ":
        more, body = ", " + body[5:], ""
    return "WITH " + ", ".join(CTES[n] for n in names) + more + " " + body
