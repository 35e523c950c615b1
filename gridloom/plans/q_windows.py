"""Queries of windows, ranks, batches and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import rank, selection, windows
from .catalogue import query
from .inputs import catalog, member, members, series, simulations, sql
from .q_indicators import S, limits_sql, pool_sql
from .q_select import six

SERIES = ["model", "scenario", "cell_id"]


@query("w1_rolling_sum", sql(f"SELECT {S}, date, CASE WHEN count(pr) OVER w = 3 THEN sum(pr) OVER w END AS rolled FROM members WINDOW w AS (PARTITION BY {S} ORDER BY date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)", "members"))
def _(spark, sf):
    return windows.rolling_sum(member(spark, sf, "pr"), 3).select(*SERIES, "date", "rolled")


@query("w2_runs", sql(f"WITH r AS (SELECT {S}, date, coalesce(pr > 5, false) AS flag, row_number() OVER (PARTITION BY {S} ORDER BY date) - row_number() OVER (PARTITION BY {S}, coalesce(pr > 5, false) ORDER BY date) AS island FROM members) SELECT {S}, n AS length, count(*) AS n_runs FROM (SELECT {S}, island, count(*) AS n FROM r WHERE flag GROUP BY ALL) GROUP BY ALL", "members"))
def _(spark, sf):
    return windows.runs(members(spark, sf), F.col("pr") > 5, SERIES).groupBy(*SERIES, "length").agg(F.count("*").alias("n_runs"))


@query("w3_percentile_doy", sql(f"WITH {limits_sql('tasmax', 0.9, 'members', S)} SELECT {S}, doy, round(threshold + 1e-9, 6) AS threshold FROM lim", "members"))
def _(spark, sf):
    return six(windows.percentile_doy(member(spark, sf, "tasmax"), 0.9).withColumn("threshold", F.col("threshold") + 1e-9), "threshold")


_Q = f"SELECT {S}, doy, unnest(range(5))::INT AS q_idx, unnest(quantile_cont(value, [0.1, 0.3, 0.5, 0.7, 0.9])) AS value FROM pool GROUP BY {S}, doy"


@query("w4_doy_window_quantiles", sql(f"WITH {pool_sql('members', 'pr', 7, S)} SELECT {S}, doy, q_idx, round(value, 6) AS value FROM ({_Q})", "members"))
def _(spark, sf):
    return six(windows.doy_window_quantiles(member(spark, sf, "pr"), 5, 15), "value").select(*SERIES, "doy", "q_idx", "value")


@query("w4_doy_window_quantiles_per_cell", sql(f"WITH {pool_sql('members', 'pr', 7, S)} SELECT {S}, doy, q_idx, round(value, 6) AS value FROM ({_Q})", "members"))
def _(spark, sf):
    return six(windows.doy_window_quantiles_per_cell(member(spark, sf, "pr"), 5, 15), "value").select(*SERIES, "doy", "q_idx", "value")


def rank_sql(pool: str = "pool", keys: str = S, out: str = "ranked") -> str:
    """A CTE of keys, doy, value and its scaled rank in the pool."""
    whole = f"PARTITION BY {keys}, doy"
    return f"{out} AS (SELECT {keys}, doy, value, CASE WHEN sum(k) OVER ({whole}) > 1 THEN (coalesce(sum(k) OVER ({whole} ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + (k + 1) / 2e0 - 1) / (sum(k) OVER ({whole}) - 1) ELSE 0e0 END AS q FROM (SELECT {keys}, doy, value, count(*) AS k FROM {pool} GROUP BY ALL))"


@query("w5_rank_in_doy_window", sql(f"WITH {pool_sql('members', 'pr', 7, S)}, {rank_sql()} SELECT {S}, d.date, round(q, 6) AS q FROM members d LEFT JOIN (SELECT * RENAME (value AS pr) FROM ranked) r USING ({S}, doy, pr)", "members"))
def _(spark, sf):
    return six(windows.rank_in_doy_window(member(spark, sf, "pr"), 15), "q").select(*SERIES, "date", "q")


@query("w6_ecdf", sql(f"SELECT {S}, date, round(cume_dist() OVER (PARTITION BY {S} ORDER BY pr), 9) AS cdf FROM members WHERE pr IS NOT NULL", "members"))
def _(spark, sf):
    return windows.ecdf(member(spark, sf, "pr"), SERIES).select(*SERIES, "date", F.round("cdf", 9).alias("cdf"))


@query("w6_domain_ecdf", sql("SELECT model, scenario, cell_id, date, round(cume_dist() OVER (PARTITION BY model, scenario ORDER BY pr), 9) AS cdf FROM members WHERE pr IS NOT NULL", "members"))
def _(spark, sf):
    """All cells of a member are one group, dealt into intervals of its values."""
    out = selection.cumulative(member(spark, sf, "pr"), ["model", "scenario"], bound=1000)
    return out.select(*SERIES, "date", F.round("cdf", 9).alias("cdf"))


@query("w7_argmax_doy", sql(f"SELECT {S}, arg_max(doy, (pr, -(date - DATE '1970-01-01'))) AS centre FROM members WHERE doy IS NOT NULL AND pr IS NOT NULL GROUP BY ALL", "members"))
def _(spark, sf):
    return windows.argmax_doy(member(spark, sf, "pr"))


@query("w8_extreme_cells", sql("WITH s AS (SELECT model, scenario, cell_id, max(pr) AS max, min(pr) AS min, avg(pr) AS mean, sum(pr) AS total FROM members GROUP BY ALL), t AS (UNPIVOT s ON max, min, mean, total INTO NAME statistic VALUE v) SELECT model, scenario, statistic, arg_max(cell_id, (v, -cell_id)) AS most_cell, round(max(v), 6) AS most, arg_min(cell_id, (v, cell_id)) AS least_cell, round(min(v), 6) AS least FROM t GROUP BY ALL", "members"))
def _(spark, sf):
    return six(windows.extreme_cells(member(spark, sf, "pr")), "most", "least")


_CVM = f"k AS (SELECT DISTINCT {S} FROM simulations), b AS (SELECT {S}, pr AS value, 1 AS s FROM daily JOIN k USING (cell_id) UNION ALL SELECT {S}, value, 2 FROM simulations), m AS (SELECT {S}, s, rank() OVER (PARTITION BY {S} ORDER BY value) + (count(*) OVER (PARTITION BY {S}, value) - 1) / 2e0 - rank() OVER (PARTITION BY {S}, s ORDER BY value) - (count(*) OVER (PARTITION BY {S}, s, value) - 1) / 2e0 AS d FROM b), g AS (SELECT {S}, count(CASE WHEN s = 1 THEN 1 END)::DOUBLE AS n, count(CASE WHEN s = 2 THEN 1 END)::DOUBLE AS m, sum(CASE WHEN s = 1 THEN d * d END) AS d1, sum(CASE WHEN s = 2 THEN d * d END) AS d2 FROM m GROUP BY ALL), t AS (SELECT {S}, n, m, (n * d1 + m * d2) / (n * m * (n + m)) - (4 * n * m - 1) / (6 * (n + m)) AS statistic FROM g WHERE n > 0 AND m > 0)"
#: The p-value in SQL: the series of the limit law, the Bessel function of order 1/4 by its cosh integral.
_PVALUE = """x AS (SELECT *, greatest(1e-6, 1 / 6e0 + (statistic - (1 + 1 / (n + m)) / 6) / sqrt(45 * ((n + m + 1) * (4 * m * n * (n + m) - 3 * (m * m + n * n) - 2 * m * n) / (45 * (n + m) ** 2 * 4 * m * n)))) AS x FROM t),
u AS (SELECT list(i * 0.01e0) AS us FROM range(1, 1200) r(i)),
p AS (SELECT *, 1 - list_sum([exp(lgamma(k + 0.5e0) - lgamma(k + 1e0)) / pi() ** 1.5 / sqrt(x) * sqrt(4 * k + 1e0) * exp(-1 * pow(4 * k + 1e0, 2) / (16 * x)) * 0.01e0 * (0.5e0 * exp(-1 * pow(4 * k + 1e0, 2) / (16 * x)) + list_sum([exp(-1 * pow(4 * k + 1e0, 2) / (16 * x) * (exp(a) + exp(-a)) / 2) * (exp(a / 4) + exp(-a / 4)) / 2 for a in us])) for k in range(0, 12)]) AS tail FROM x, u)"""


@query("w9_cvm_statistic", sql(f"WITH {_CVM}, {_PVALUE} SELECT {S}, n, m, round(statistic, 6) AS statistic, round(CASE WHEN statistic < 0.003 THEN 1 WHEN x > 10 THEN 0 ELSE greatest(0, least(1, tail)) END, 5) + 0e0 AS pvalue FROM p", "daily", "simulations"))
def _(spark, sf):
    out = six(windows.cvm_2samp(series(spark, sf, "pr"), simulations(spark, sf)), "statistic")
    return out.withColumn("pvalue", F.round("pvalue", 5) + 0.0)


@query("w10_q_ratio", sql(f"SELECT {S}, round(r / h, 6) AS ratio FROM (SELECT cell_id, quantile_cont(pr, 0.9) AS r FROM dated WHERE doy BETWEEN 105 AND 135 GROUP BY 1) JOIN (SELECT {S}, quantile_cont(value, 0.9) AS h FROM simulations WHERE doy BETWEEN 105 AND 135 GROUP BY ALL) USING (cell_id)", "dated", "simulations"))
def _(spark, sf):
    return six(windows.q_ratio(series(spark, sf, "pr"), simulations(spark, sf), 120, 0.9), "ratio")


@query("k1_top_cells", sql("SELECT cell_id, count(CASE WHEN pr > 60 THEN 1 END) AS n_days FROM daily GROUP BY 1 ORDER BY n_days DESC, cell_id LIMIT 6", "daily"))
def _(spark, sf):
    return rank.top_cells(series(spark, sf, "pr").groupBy("cell_id").agg(F.count_if(F.col("value") > 60).alias("n_days")))


@query("k2_latest_version", sql("SELECT model, scenario, variant, variable, file_no, version, version < max(version) OVER (PARTITION BY model, scenario, variant, variable) AS superseded FROM catalog", "catalog"))
def _(spark, sf):
    return rank.latest_version(catalog(spark, sf), ["model", "scenario", "variant", "variable"]).select("model", "scenario", "variant", "variable", "file_no", "version", "superseded")


@query("k3_subsample", sql("SELECT path FROM catalog ORDER BY md5(path || ':0'), path LIMIT 75", "catalog"))
def _(spark, sf):
    return rank.subsample(catalog(spark, sf).select("path"), "path")


@query("k4_n_per_batch", sql("SELECT model, file_no, ((row_number() OVER (PARTITION BY model ORDER BY file_no) - 1) // 200)::BIGINT AS batch FROM catalog", "catalog"))
def _(spark, sf):
    return rank.n_per_batch(catalog(spark, sf), ["model"], ["file_no"], 200).select("model", "file_no", "batch")


@query("k5_pack_batches", sql("WITH RECURSIVE n AS (SELECT model, scenario, variable, path, bytes, row_number() OVER (PARTITION BY model, scenario, variable ORDER BY path, bytes) AS k FROM catalog), r AS (SELECT *, 0 AS batch, bytes AS total, 1 AS held FROM n WHERE k = 1 UNION ALL SELECT n.model, n.scenario, n.variable, n.path, n.bytes, n.k, r.batch + CASE WHEN r.total + n.bytes > 500000 OR r.held >= 4 THEN 1 ELSE 0 END, CASE WHEN r.total + n.bytes > 500000 OR r.held >= 4 THEN n.bytes ELSE r.total + n.bytes END, CASE WHEN r.total + n.bytes > 500000 OR r.held >= 4 THEN 1 ELSE r.held + 1 END FROM r JOIN n ON n.model = r.model AND n.scenario = r.scenario AND n.variable = r.variable AND n.k = r.k + 1) SELECT model, scenario, variable, path, batch::BIGINT AS batch FROM r", "catalog").replace("WITH catalog0", "WITH RECURSIVE catalog0", 1).replace(", RECURSIVE n AS", ", n AS", 1))
def _(spark, sf):
    return rank.pack_batches(catalog(spark, sf), ["model", "scenario", "variable"], max_bytes=500_000, max_n=4)


@query("k6_sort_variants", sql("SELECT model, variant, " + ", ".join(f"count(DISTINCT CASE WHEN scenario = '{s}' THEN (table_id, variable) END) AS {s}" for s in ("historical", "ssp126", "ssp585")) + " FROM catalog GROUP BY 1, 2", "catalog"))
def _(spark, sf):
    return rank.sort_variants(catalog(spark, sf), ["historical", "ssp126", "ssp585"])
