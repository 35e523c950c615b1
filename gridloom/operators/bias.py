"""Bias adjustment by quantile mapping in day-of-year windows.

Training makes a quantile table (series keys, doy, q_idx, q, ref_q, hist_q, af); adjusting joins a simulation to it by rank. kind "+" maps
by differences, "*" by ratios. Missing quantiles stay null and adjust to null.

A map belongs to a model (and variable) and cell, if the simulation has models: its scenario column is left out of training, as maps of the historical
scenario adjust all others, and simulations are ranked series by series. A reference without models serves them all. Windows of days are taken from a series
in one Arrow group, so the shuffle moves each value once.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import windows
from .aggregate import doy_stats
from .kernel import Setting, adjust_grid, by_doy, smooth, uniform
from .units import clamp
from .windows import common_keys, day_numbers, series_keys

#: Mapping kind, jitter threshold and dry-day threshold by variable.
KIND = {"tasmax": "+", "tasmin": "+", "pr": "*", "dtr": "*", "snw": "*"}
JITTER = {"pr": 0.01, "dtr": 1e-4, "snw": 0.01}
ADAPT = {"pr": 0.254, "snw": 0.254}


def factor(ref: Column, hist: Column, kind: str) -> Column:
    return ref - hist if kind == "+" else F.try_divide(ref, hist)


def adjusted(value: Column, af: Column, kind: str) -> Column:
    return value + af if kind == "+" else value * af


def _of_model(df: DataFrame) -> DataFrame:
    return df.drop("scenario")


def _joined(df: DataFrame, table: DataFrame, *on: str, how: str = "left") -> DataFrame:
    """df with a table of maps, on the series keys of both and more."""
    return df.join(table, [*common_keys(df, table), *on], how)


def qdm_train(ref: DataFrame, hist: DataFrame, kind: str = "+", nq: int = 100, window: int = 31, per_cell: bool = True) -> DataFrame:
    """The quantile table. per_cell: one Arrow group a series, which moves each value once; else pooled rows and built-in percentiles."""
    quantiles: Callable = windows.doy_window_quantiles_per_cell if per_cell else windows.doy_window_quantiles
    r, h = (quantiles(_of_model(d), nq, window).withColumnRenamed("value", n) for d, n in ((ref, "ref_q"), (hist, "hist_q")))
    both = _joined(h, r.drop("q"), "doy", "q_idx", how="inner")
    return both.select(*series_keys(h), "doy", "q_idx", "q", "ref_q", "hist_q", factor(F.col("ref_q"), F.col("hist_q"), kind).alias("af"))


def nearest_node(q: Column, nq: int) -> Column:
    """The trained quantile nearest to q, constant beyond the ends; of two as near the lower."""
    return F.greatest(F.lit(0), F.least(F.lit(nq - 1), F.ceil(q * nq - 1))).cast("int")


def _by_rank(ranked: DataFrame, qmap: DataFrame, kind: str, nq: int) -> DataFrame:
    """Rows with a rank q, adjusted by the factor of the nearest trained quantile."""
    factors = qmap.select(*series_keys(qmap), "doy", "q_idx", "af")
    out = _joined(ranked.withColumn("q_idx", nearest_node(F.col("q"), nq)), factors, "doy", "q_idx")
    return out.withColumn("value", adjusted(F.col("value"), F.col("af"), kind))


def qdm_adjust(qmap: DataFrame, sim: DataFrame, kind: str = "+", nq: int = 100, window: int = 31) -> DataFrame:
    """sim with value adjusted by the factor of its rank in its own day-of-year pool."""
    return _by_rank(windows.rank_in_doy_window(sim, window), qmap, kind, nq).select(*sim.columns)


def eqm_adjust(qmap: DataFrame, sim: DataFrame, kind: str = "+") -> DataFrame:
    """sim adjusted by the factor of the trained quantile whose value is nearest, to nine decimals (the lower of two)."""
    arrays = qmap.groupBy(*series_keys(qmap), "doy").agg(F.array_sort(F.collect_list(F.struct("q_idx", "hist_q", "af"))).alias("map"))
    near = F.array_min(F.transform("map", lambda m: F.struct(F.round(F.abs(m["hist_q"] - F.col("value")), 9).alias("d"), m["q_idx"].alias("i"), m["af"].alias("af"))))["af"]
    return _joined(sim, arrays, "doy").withColumn("value", adjusted(F.col("value"), near, kind)).select(*sim.columns)


def detrend_linear(df: DataFrame, degree: int = 1) -> DataFrame:
    """Adds trend: the mean (degree 0) or the least-squares line over years of each series and day of the year."""
    keys, y, v = series_keys(df), F.col("year").cast("double"), F.col("value")
    fit = df.groupBy(*keys, "doy").agg(F.avg(v).alias("__m"), F.regr_slope(v, y).alias("__b"), F.regr_intercept(v, y).alias("__a"))
    line = F.coalesce(F.col("__a") + F.col("__b") * y, F.col("__m")) if degree else F.col("__m")
    return df.join(fit, [*keys, "doy"]).withColumn("trend", line).drop("__m", "__a", "__b")


def detrend_series(df: DataFrame, how: str = "poly3", share: float = 0.2) -> DataFrame:
    """Adds trend per series and day of the year by a cubic ("poly3") or by LOESS of degree 0 with tricube weights ("loess")."""

    def make(table: pa.Table) -> np.ndarray:
        doy, year, value = (table[c].to_numpy() for c in ("doy", "year", "value"))
        trend = np.full(len(value), np.nan)
        for at in by_doy(doy):
            trend[at] = smooth(year[at].astype(float), value[at], how, share)
        return trend

    return windows.with_series_column(df.where("doy is not null"), make, "trend")


def detrend(df: DataFrame, kind: str) -> DataFrame:
    """kind: mean, poly1, poly3 or loess."""
    return detrend_linear(df, 0 if kind == "mean" else 1) if kind in ("mean", "poly1") else detrend_series(df, kind)


def dqm_adjust(ref: DataFrame, hist: DataFrame, sim: DataFrame, kind: str = "+", nq: int = 20, window: int = 31, trend: str = "mean") -> DataFrame:
    """Detrended quantile mapping: quantiles of values normalised by their group mean, means scaled apart, the trend put back."""
    off = lambda v, m: v - m if kind == "+" else F.try_divide(v, m)
    ref, hist = _of_model(ref), _of_model(hist)
    rm, hm = (windows.doy_window_means(d, window) for d in (ref, hist))
    norm = lambda d, m: _joined(d, m, "doy", how="inner").withColumn("value", off(F.col("value"), F.col("mean"))).drop("mean")
    qmap = qdm_train(norm(ref, rm), norm(hist, hm), kind, nq, window)
    both = _joined(hm.withColumnRenamed("mean", "hm"), rm.withColumnRenamed("mean", "rm"), "doy", how="inner")
    scaling = both.select(*series_keys(hm), "doy", factor(F.col("rm"), F.col("hm"), kind).alias("scale"))
    scaled = _joined(sim, scaling, "doy", how="inner").withColumn("value", adjusted(F.col("value"), F.col("scale"), kind)).drop("scale")
    trended = detrend(scaled, trend)
    out = eqm_adjust(qmap, trended.withColumn("value", off(F.col("value"), F.col("trend"))), kind)
    return out.withColumn("value", adjusted(F.col("value"), F.col("trend"), kind)).select(*sim.columns)


def dry_excess(ref: DataFrame, hist: DataFrame, threshold: float, window: int = 31) -> DataFrame:
    """Series keys of hist, doy, rd, hd and top where more of hist's pool (hd) than of ref's (rd) is under the threshold; top: ref's value at
    hist's dry share, the threshold at least. Both series of a cell are one pair of Arrow groups."""
    hist = _of_model(hist)
    keys, common = series_keys(hist), common_keys(hist, ref)
    # Aliased, so that the two sides have no column in common.
    ref = ref.join(hist.select(*(F.col(k).alias(k) for k in keys)).distinct(), common)
    schema = hist.select(*keys).schema.add("doy", "integer").add("rd", "double").add("hd", "double").add("top", "double")

    def run(of_ref: pa.Table, of_hist: pa.Table) -> pa.Table:
        pools = []
        for t in (of_ref, of_hist):
            t = t.sort_by("date")
            pools.append(dict(windows.doy_pools(day_numbers(t), t["value"].to_numpy(), window // 2)) if len(t) else {})
        rows = []
        for d in sorted(pools[0].keys() & pools[1].keys()):
            r, h = pools[0][d], pools[1][d]
            rd, hd = (r < threshold).mean(), (h < threshold).mean()
            if hd > rd:
                rows.append((d, rd, hd, max(threshold, r[min(len(r) - 1, int(hd * len(r)))])))
        own = of_hist.select(keys).take(pa.array(np.zeros(len(rows), np.int64)))
        columns = [pa.array([x[i] for x in rows], t) for i, t in enumerate((pa.int32(), pa.float64(), pa.float64(), pa.float64()))]
        return pa.table([*own.columns, *columns], names=schema.names)

    sides = [d.select(*(F.col(k).alias(k) for k in [*keys, "date", "value"])).groupBy(*keys) for d in (ref, hist)]
    return sides[0].cogroup(sides[1]).applyInArrow(run, schema)


def adapt_freq(ref: DataFrame, hist: DataFrame, threshold: float, window: int = 31, seed: int = 0) -> DataFrame:
    """hist with its excess of dry days made wet: where more of its pool than of ref's is under the threshold, as large a share of its dry days
    gets values drawn between the threshold and ref's quantile at hist's dry share. Ties share a rank, so a draw says which of the dry days."""
    keys = series_keys(hist)
    out = _joined(hist, dry_excess(ref, hist, threshold, window), "doy")
    excess = (F.col("value") < threshold) & (uniform(seed, keys) < (F.col("hd") - F.col("rd")) / F.col("hd"))
    wet = threshold + uniform(seed + 1, keys) * (F.col("top") - threshold)
    return out.withColumn("value", F.when(excess, wet).otherwise(F.col("value"))).select(*hist.columns)


def qplad_train(fine: DataFrame, coarse: DataFrame, window: int = 31) -> DataFrame:
    """Series keys, doy, rank, n, af: for each rank of the coarse pool of a day of the year, fine - coarse on the day that holds it (the
    earlier of equals). Every day of a pool is a quantile of its own, as the method asks."""
    fine, coarse = _of_model(fine), _of_model(coarse)
    both = coarse.select(*series_keys(coarse), "date", F.col("value").alias("c")).join(fine.select(*common_keys(fine, coarse), "date", F.col("value").alias("f")), [*common_keys(fine, coarse), "date"])

    def make(table: pa.Table) -> dict[str, np.ndarray]:
        days = day_numbers(table)
        c, f = windows.on_every_day(days, table["c"].to_numpy(), table["f"].to_numpy())
        out: dict[str, list] = {"doy": [], "rank": [], "n": [], "af": []}
        for d, span in windows.doy_spans(int(days[0]), int(days[-1]), window // 2):
            span = np.sort(span[~np.isnan(c[span]) & ~np.isnan(f[span])])
            order = span[np.argsort(c[span], kind="stable")]
            for name, column in (("doy", np.full(len(span), d, np.int32)), ("rank", np.arange(len(span), dtype=np.int32)), ("n", np.full(len(span), len(span), np.int32)), ("af", f[order] - c[order])):
                out[name].append(column)
        return {k: np.concatenate(v) for k, v in out.items()}

    return windows.per_series(both, make, "doy int, rank int, n int, af double", series_keys(coarse))


def qplad_adjust(analogs: DataFrame, sim: DataFrame, window: int = 31) -> DataFrame:
    """sim plus the analog difference at its rank in its day-of-year pool."""
    n = analogs.groupBy(*series_keys(analogs), "doy").agg(F.max("n").alias("n"))
    ranked = _joined(windows.rank_in_doy_window(sim, window), n, "doy")
    ranked = ranked.withColumn("rank", F.least(F.col("n") - 1, F.greatest(F.lit(0), F.round(F.col("q") * (F.col("n") - 1)))).cast("int"))
    out = _joined(ranked, analogs.drop("n"), "doy", "rank")
    return out.withColumn("value", F.col("value") + F.col("af")).select(*sim.columns)


def adjust_methods(ref: DataFrame, hist: DataFrame, sim: DataFrame, kind: str = "+", nq: int = 20, window: int = 31, trends: tuple[str, ...] = ("mean", "poly1", "poly3", "loess")) -> DataFrame:
    """Detrended mapping with each trend, delta mapping and plain mapping of one simulation, stacked under method, from one pass over the series."""
    settings = [*(Setting("dqm", t, window, nq) for t in trends), Setting("qdm", None, window, nq), Setting("qm", None, window, nq)]
    made = adjust_grid(ref, hist, sim, settings, kind)
    return made.select(F.concat_ws("_", "method", "trend").alias("method"), *sim.columns)


def param_sweep(ref: DataFrame, hist: DataFrame, sim: DataFrame, kind: str, windows_: list[int], nqs: list[int], adapts: tuple[float | None, ...] = (None,), jitters: tuple[float | None, ...] = (None,), seed: int = 0) -> DataFrame:
    """qdm of each window, number of quantiles, adapt_freq threshold and jitter threshold, stacked under the parameters, from one pass over the series."""
    settings = [Setting("qdm", None, w, nq, a, j) for w in windows_ for nq in nqs for a in adapts for j in jitters]
    return adjust_grid(ref, hist, sim, settings, kind, seed).drop("method", "trend")


def sweep_matrix(ref: DataFrame, runs: DataFrame, row: str, column: str, values: list) -> DataFrame:
    """Greatest absolute difference of DOY means from the reference, row parameter by column parameter."""
    keys = common_keys(runs, ref)
    means = doy_stats(runs, [*keys, row, column]).select(*keys, "doy", row, column, F.col("mean").alias("m"))
    both = means.join(doy_stats(ref, keys).select(*keys, "doy", F.col("mean").alias("r")), [*keys, "doy"])
    return both.withColumn("d", F.abs(F.col("m") - F.col("r"))).groupBy(row).pivot(column, values).agg(F.max("d"))


def sliding_year_adjust(qmap: DataFrame, sim: DataFrame, kind: str = "+", nq: int = 100, window: int = 31, years: int = 10) -> DataFrame:
    """Each year ranked among the years - years .. + years around it."""
    ranked = windows.with_series_column(sim, lambda t: windows.sliding_ranks(day_numbers(t), t["value"].to_numpy(), window // 2, years), "q")
    return _by_rank(ranked, qmap, kind, nq).select(*sim.columns)


def adjust_pipeline(qmap: DataFrame, sim: DataFrame, kind: str, low: float | None, high: float | None, nq: int = 100, window: int = 31) -> DataFrame:
    """qdm_adjust, then bounds."""
    return qdm_adjust(qmap, sim, kind, nq, window).withColumn("value", clamp(F.col("value"), low, high))


def validate_qmap(qmap: DataFrame) -> DataFrame:
    """Series keys, n_quantiles, ok: it has quantiles and they aren't all null."""
    return qmap.groupBy(*series_keys(qmap)).agg(F.count("*").alias("n_quantiles"), (F.count("af") > 0).alias("ok"))
