"""Queries of aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregate, selection
from .catalogue import query
from .inputs import catalog, field, grid, member, series, simulated, simulations, sql
from .q_select import six

SIM = "SELECT cell_id, doy, min(value) AS mn, avg(value) AS mean, max(value) AS mx FROM simulated WHERE doy IS NOT NULL GROUP BY 1, 2"
REF = "SELECT cell_id, doy, min(pr) AS mn, avg(pr) AS mean, max(pr) AS mx FROM dated WHERE doy IS NOT NULL GROUP BY 1, 2"
MS = "model, scenario"
SIMS = "SELECT model, scenario, cell_id, doy, avg(value) AS mean FROM simulations WHERE doy IS NOT NULL GROUP BY ALL"
DELTA_MAPS = f"d AS (SELECT {MS}, cell_id, doy, r.mean - s.mean AS delta FROM ({REF}) r JOIN ({SIMS}) s USING (cell_id, doy))"
DELTAS = f"d AS (SELECT cell_id, doy, r.mean - s.mean AS delta, CASE WHEN s.mean <> 0 THEN (r.mean - s.mean) / s.mean END AS proportion FROM ({REF}) r JOIN ({SIM}) s USING (cell_id, doy))"


@query("a1_doy_stats", sql("SELECT model, variable, doy, min(value) AS min, round(avg(value) + 1e-9, 6) AS mean, max(value) AS max FROM field WHERE doy IS NOT NULL GROUP BY 1, 2, 3", "field"))
def _(spark, sf):
    return six(aggregate.doy_stats(field(spark, sf), ["model", "variable"]).withColumn("mean", F.col("mean") + 1e-9), "mean")


@query("a2_monthly_climatology", sql("SELECT cell_id, month, round(avg(pr), 6) AS mean FROM dated GROUP BY 1, 2", "dated"))
def _(spark, sf):
    return six(aggregate.monthly_climatology(series(spark, sf, "pr")), "mean")


@query("a3_period_mean", sql("SELECT cell_id, round(avg(pr), 6) AS mean FROM dated WHERE year BETWEEN 1996 AND 1998 GROUP BY 1", "dated"))
def _(spark, sf):
    return six(aggregate.period_mean(series(spark, sf, "pr"), 1996, 1998), "mean")


def deltas(spark, sf):
    return aggregate.doy_deltas(series(spark, sf, "pr"), simulated(spark, sf))


def member_deltas(spark, sf):
    return aggregate.doy_deltas(series(spark, sf, "pr"), simulations(spark, sf))


@query("a4_domain_summary", sql(f"WITH {DELTAS} SELECT round(min(delta), 6) AS min, round(max(delta), 6) AS max, round(avg(delta), 6) AS mean, round(stddev_pop(delta), 6) AS std, round(avg(abs(proportion)), 6) AS mean_proportion, round(max(abs(proportion)), 6) AS max_proportion FROM d", "dated", "simulated"))
def _(spark, sf):
    return six(aggregate.domain_summary(deltas(spark, sf)), "min", "max", "mean", "std", "mean_proportion", "max_proportion")


@query("a5_delta_maps", sql(f"WITH {DELTA_MAPS} SELECT {MS}, cell_id, round(min(delta), 6) AS min, round(max(delta), 6) AS max, round(avg(delta), 6) AS mean FROM d GROUP BY ALL", "dated", "simulations"))
def _(spark, sf):
    return six(aggregate.delta_maps(member_deltas(spark, sf)), "min", "max", "mean")


@query("a6_count_exceed", sql(f"SELECT {MS}, cell_id, count(CASE WHEN pr > 20 THEN 1 END) AS n_days FROM members GROUP BY GROUPING SETS (({MS}, cell_id), ({MS}))", "members"))
def _(spark, sf):
    return aggregate.count_exceed(member(spark, sf, "pr"), 20)


@query("a7_count_out_of_range", sql("SELECT variable, count(CASE WHEN value < 0 OR value > 100 THEN 1 END) AS n_out FROM field GROUP BY 1", "field"))
def _(spark, sf):
    return aggregate.count_out_of_range(field(spark, sf), 0, 100, ["variable"])


@query("a8_pct_condition", sql("SELECT model, scenario, variable, round(CASE WHEN count(value) > 0 THEN 100e0 * count(CASE WHEN value < 0 THEN 1 END) / count(*) END, 6) AS pct FROM field GROUP BY 1, 2, 3", "field"))
def _(spark, sf):
    return six(aggregate.pct_condition(field(spark, sf), "<", 0, ["model", "scenario", "variable"]), "pct")


@query("a9_min_max", sql("SELECT model, variable, coalesce(min(CASE WHEN lat < 55 AND ix <> 1 THEN value END), min(value)) AS min, coalesce(max(CASE WHEN lat < 55 AND ix <> 1 THEN value END), max(value)) AS max FROM field JOIN grid USING (cell_id) GROUP BY 1, 2", "field", "grid"))
def _(spark, sf):
    return aggregate.min_max(field(spark, sf).join(grid(spark, sf), "cell_id"), (F.col("lat") < 55) & (F.col("ix") != 1), ["model", "variable"])


@query("a10_rmse", sql("SELECT round(sqrt(avg((d.pr - s.value) * (d.pr - s.value))), 6) AS rmse, count(*) AS n FROM daily d JOIN simulated s USING (cell_id, date)", "daily", "simulated"))
def _(spark, sf):
    return six(aggregate.rmse(series(spark, sf, "pr"), simulated(spark, sf), ["cell_id", "date"]), "rmse")


@query("a11_nunique_by", sql("SELECT model, scenario, variant, count(DISTINCT (table_id, variable)) AS n FROM catalog GROUP BY 1, 2, 3", "catalog"))
def _(spark, sf):
    return aggregate.nunique_by(catalog(spark, sf), ["table_id", "variable"], ["model", "scenario", "variant"])


@query("a12_extent_summary", sql("SELECT model, variable, min(year) AS year_min, max(year) AS year_max, min(lat) AS lat_min, max(lat) AS lat_max, min(lon) AS lon_min, max(lon) AS lon_max FROM field JOIN grid USING (cell_id) GROUP BY 1, 2", "field", "grid"))
def _(spark, sf):
    return aggregate.extent_summary(field(spark, sf).join(grid(spark, sf), "cell_id"), ["model", "variable"])


@query("a13_value_counts", sql("SELECT model, grid_type, count(*) AS n FROM catalog GROUP BY 1, 2", "catalog"))
def _(spark, sf):
    return aggregate.value_counts(catalog(spark, sf), ["model", "grid_type"])


@query("a14_grid_signature", sql("WITH y AS (SELECT region, list_sort(list(DISTINCT lat)) AS v FROM grid GROUP BY 1), x AS (SELECT region, list_sort(list(DISTINCT lon)) AS v FROM grid GROUP BY 1), t AS (SELECT y.region, format('{:.2f}_{:.2f}_{}', y.v[1], y.v[-1], len(y.v)) || CASE WHEN len(y.v) > 1 THEN format('_{:.2f}', y.v[2] - y.v[1]) ELSE '' END || '|' || format('{:.2f}_{:.2f}_{}', x.v[1], x.v[-1], len(x.v)) || CASE WHEN len(x.v) > 1 THEN format('_{:.2f}', x.v[2] - x.v[1]) ELSE '' END AS signature FROM y JOIN x USING (region)) SELECT region, signature, 'gr' || (dense_rank() OVER (ORDER BY signature) - 1) AS grid FROM t", "grid"))
def _(spark, sf):
    return aggregate.grid_signature(grid(spark, sf), ["region"])


@query("a15_histogram", sql("WITH e AS (SELECT min(pr) AS low, (max(pr) - min(pr)) / 25 AS width FROM daily) SELECT least(24, floor((pr - low) / width))::INT AS bin, count(*) AS n FROM daily, e GROUP BY 1", "daily"))
def _(spark, sf):
    from ..operators.units import histogram

    return histogram(series(spark, sf, "pr"), 25).select("bin", "n")


@query("a16_distribution_summary", sql("WITH q AS (SELECT cell_id, quantile_cont(pr, 0.25) AS q1, quantile_cont(pr, 0.5) AS q2, quantile_cont(pr, 0.75) AS q3 FROM daily GROUP BY 1) SELECT cell_id, round(q1, 6) AS q1, round(q2, 6) AS q2, round(q3, 6) AS q3, min(pr) AS low, max(pr) AS high FROM daily JOIN q USING (cell_id) WHERE pr BETWEEN q1 - 1.5e0 * (q3 - q1) AND q3 + 1.5e0 * (q3 - q1) GROUP BY ALL", "daily"))
def _(spark, sf):
    return six(aggregate.distribution_summary(series(spark, sf, "pr"), ["cell_id"]), "q1", "q2", "q3")


@query("a16_domain_quartiles", sql("SELECT model, scenario, round(quantile_cont(pr, 0.25), 6) AS q1, round(quantile_cont(pr, 0.5), 6) AS q2, round(quantile_cont(pr, 0.75), 6) AS q3 FROM members WHERE pr IS NOT NULL GROUP BY ALL", "members"))
def _(spark, sf):
    """All cells of a member are one group: taken apart, as the bound of a thousand values asks."""
    q = selection.percentiles(member(spark, sf, "pr"), ["model", "scenario"], [0.25, 0.5, 0.75], bound=1000)
    return q.select("model", "scenario", *(F.round(F.col("q")[i], 6).alias(n) for i, n in enumerate(("q1", "q2", "q3"))))


@query("a17_total_size", sql("SELECT scenario, count(*) AS n_files, round(sum(bytes) / 1e12, 9) AS terabytes FROM catalog GROUP BY 1", "catalog"))
def _(spark, sf):
    return aggregate.total_size(catalog(spark, sf), ["scenario"]).withColumn("terabytes", F.round("terabytes", 9))


@query("a18_max_by_group", sql("SELECT model, scenario, max(value) AS max FROM field GROUP BY 1, 2", "field"))
def _(spark, sf):
    return aggregate.max_by_group(field(spark, sf), ["model", "scenario"])


@query("a19_strict_total", sql("SELECT cell_id, year, CASE WHEN count(v) = count(*) THEN nullif(sum(v), 0) END AS total, round(CASE WHEN count(v) = count(*) THEN avg(v) END, 6) AS mean FROM (SELECT cell_id, year, CASE WHEN pr <= 250 THEN pr END AS v FROM dated) GROUP BY 1, 2", "dated"))
def _(spark, sf):
    pr = series(spark, sf, "pr").withColumn("value", F.when(F.col("value") <= 250, F.col("value")))
    return six(aggregate.strict_total(pr, ["cell_id", "year"]), "mean")


@query("a20_mask_fraction", sql(f"WITH f AS (SELECT {MS}, cell_id, (arg_min_null(v, date) IS NULL)::INT::DOUBLE AS empty FROM (SELECT {MS}, cell_id, date, CASE WHEN pr <= 10 THEN pr END AS v FROM members) GROUP BY ALL), m AS (SELECT {MS}, avg(empty) AS masked, avg((NOT region > 1)::INT::DOUBLE) AS expected FROM f JOIN grid USING (cell_id) GROUP BY ALL) SELECT {MS}, round(masked, 6) AS masked, round(expected, 6) AS expected, abs(masked - expected) < 0.2e0 AS good FROM m", "members", "grid"))
def _(spark, sf):
    pr = member(spark, sf, "pr").withColumn("value", F.when(F.col("value") <= 10, F.col("value")))
    land = grid(spark, sf).select("cell_id", (F.col("region") > 1).alias("is_land"))
    return six(aggregate.mask_fraction(pr, land), "masked", "expected")


@query("u2_resample_with", sql("SELECT cell_id, date_trunc('quarter', date)::DATE AS period, round(stddev_pop(pr), 6) AS value FROM daily GROUP BY 1, 2", "daily"))
def _(spark, sf):
    from ..operators.indicators import resample_with

    return six(resample_with(series(spark, sf, "pr"), ["cell_id"], "quarter", F.stddev_pop), "value")


@query("u2_resample_series", sql("SELECT model, scenario, cell_id, date_trunc('month', date)::DATE AS period, round(median(pr), 6) AS value FROM members GROUP BY ALL", "members"))
def _(spark, sf):
    """A caller's own code: the median of a month's values."""
    import numpy as np

    from ..operators.indicators import resample_series

    return six(resample_series(member(spark, sf, "pr"), ["model", "scenario", "cell_id"], "month", lambda dates, values: np.median(values)), "value")


@query("a9_file_extremes", sql("SELECT variable, model, scenario, year, min(value) AS min, max(value) AS max, count(*) AS n, min(date) AS first, max(date) AS last FROM field GROUP BY ALL", "field"))
def _(spark, sf):
    """Extremes and times of each stored file, whose name tells its partition."""
    from ..sources import fields
    from .q_select import shared_path

    path = shared_path(spark, "files")
    fields.write_by_year(field(spark, sf), path)
    files = fields.read_sources(spark, path).groupBy("source").agg(F.min("value").alias("min"), F.max("value").alias("max"), F.count("*").alias("n"), F.min("date").alias("first"), F.max("date").alias("last"))
    part = lambda name: F.regexp_extract("source", f"/{name}=([^/]+)/", 1)
    return files.select(part("variable").alias("variable"), part("model").alias("model"), part("scenario").alias("scenario"), part("year").cast("int").alias("year"), "min", "max", "n", "first", "last")
