"""Yearly indicators of each series, and the registry that runs several of them in one pass.

An indicator is an aggregate Column over a series' year, so any number of them share one scan and one shuffle. Those of runs aggregate
lengths that one sorted window finds for all of them; those beyond a day-of-year percentile join its table first. A caller's
indicator that needs more builds its own DataFrame and is joined on the keys.

Keys are the series columns that the table has (model, scenario, cell_id) and the year. A percentile comes from the historical scenario,
if the table has scenarios, and applies to all of a model's.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import windows
from .joins import doy_threshold_join
from .windows import series_keys


def by_year(df: DataFrame) -> list[str]:
    return [*series_keys(df), "year"]


def _exceed(variable: str, op: str, threshold: float) -> Callable[[], Column]:
    from .select import COMPARE

    return lambda: F.count_if(COMPARE[op](F.col(variable), threshold))


def _nth(variable: str, n: int, largest: bool) -> Callable[[], Column]:
    """The n-th greatest or least value of a year, which holds 366 values at most; null with fewer than n."""
    return lambda: F.get(F.sort_array(F.collect_list(variable), not largest), n - 1)


def _freeze_thaw(whole_years: bool = True) -> Column:
    """Days with tasmax > 0 and tasmin <= 0; null for a year with missing days (unless whole_years is off)."""
    n = F.count_if((F.col("tasmax") > 0) & (F.col("tasmin") <= 0))
    have = F.count_if(F.col("tasmax").isNotNull() & F.col("tasmin").isNotNull())
    whole = F.dayofyear(F.make_date(F.max("year"), F.lit(12), F.lit(31)))
    return F.when((have >= whole) | F.lit(not whole_years), n)


#: Aggregates over a year of the wide daily table (series keys, date, year, pr, tasmax, tasmin): name -> Column.
SIMPLE: dict[str, Callable[[], Column]] = {
    "rx1day": lambda: F.max("pr"),
    "su": _exceed("tasmax", ">", 25),
    "dw": _exceed("tasmin", "<", -30),
    "r10mm": _exceed("pr", ">", 10),
    "ice_days": _exceed("tasmax", "<", 0),
    "summer_days_20": _exceed("tasmax", ">", 20),
    "dpi": lambda: F.avg(F.when(F.col("pr") >= 1, F.col("pr"))),
    "dw_30": _exceed("tasmax", "<", -30),
    "dry_days": _exceed("pr", "<", 0.2),
    "ftc": _freeze_thaw,
    "hd": _nth("tasmax", 6, True),
    "cd": _nth("tasmin", 6, False),
}
#: The longest run of days: name -> flag.
RUNS: dict[str, Callable[[], Column]] = {
    "cwd": lambda: F.col("pr") > 1,
    "cdd": lambda: F.col("pr") < 1,
    "max_consecutive_warm_days": lambda: F.col("tasmax") > 25,
}
#: Days in runs of six or more beyond a five-day percentile: name -> variable, probability, above.
SPELLS: dict[str, tuple[str, float, bool]] = {"wsdi": ("tasmax", 0.9, True), "csdi": ("tasmin", 0.1, False)}
#: The variables whose cells have no data if their first day has none; of other indicators all that the table has.
VARIABLES: dict[str, list[str]] = {
    **dict.fromkeys(["rx1day", "rx5day", "r10mm", "dpi", "dry_days", "cwd", "cdd"], ["pr"]),
    **dict.fromkeys(["su", "ice_days", "summer_days_20", "dw_30", "hd", "max_consecutive_warm_days", "wsdi"], ["tasmax"]),
    **dict.fromkeys(["dw", "cd", "csdi"], ["tasmin"]),
    "ftc": ["tasmax", "tasmin"],
}
#: A caller's indicators that build a DataFrame: name -> function of (daily, hist).
BUILT: dict[str, Callable[[DataFrame, DataFrame], DataFrame]] = {}


def rx5day(df: DataFrame, days: int = 5) -> DataFrame:
    """Greatest sum of `days` consecutive rows, over year ends too, in the year of the last."""
    by = by_year(df)
    return windows.rolling_sum(df.select(*by, "date", F.col("pr").alias("value")), days).groupBy(*by).agg(F.max("rolled").alias("rx5day"))


def historical(df: DataFrame, base: tuple[int, int] | None = None) -> DataFrame:
    """The historical scenario of a table with scenarios, without that column, and the base period's years of it; other tables as they are."""
    own = df.where(F.col("scenario") == "historical").drop("scenario") if "scenario" in df.columns else df
    return own.where(F.year("date").between(*base)) if base else own


def day_limits(hist: DataFrame, variable: str, p: float, window: int = 5, base: tuple[int, int] | None = None) -> DataFrame:
    """Day-of-year percentiles of hist (of its base period): series keys without the scenario, doy, threshold."""
    own = historical(hist, base)
    return windows.percentile_doy(own.select(*series_keys(own), "date", F.col(variable).alias("value")), p, window)


def spell_index(df: DataFrame, hist: DataFrame, variable: str, p: float, above: bool, name: str, least: int = 6, window: int = 5, base: tuple[int, int] | None = None) -> DataFrame:
    """Days in runs of at least `least` days beyond the day-of-year percentile of hist (over its base period: 1985 to 2014 for climate normals); 29 February is passed over."""
    by = by_year(df)
    both = doy_threshold_join(df.select(*by, "date", "doy", F.col(variable).alias("value")), day_limits(hist, variable, p, window, base))
    hit = F.col("value") > F.col("threshold") if above else F.col("value") < F.col("threshold")
    return windows.days_in_runs(both, hit, by, least, name)


def tx90p(df: DataFrame, hist: DataFrame, p: float = 0.9, window: int = 5) -> DataFrame:
    """Days above the day-of-year percentile, by month."""
    by = [*by_year(df), "month"]
    both = doy_threshold_join(df.select(*by, "doy", F.col("tasmax").alias("value")), day_limits(hist, "tasmax", p, window))
    return both.groupBy(*by).agg(F.count_if(F.col("value") > F.col("threshold")).alias("tx90p"))


def register_indicator(name: str, builder: Callable, variables: list[str] | None = None) -> None:
    """Add an indicator: a function without parameters that gives an aggregate Column, or one of (daily, hist) that gives a DataFrame.
    variables: those whose first day tells whether a cell has data."""
    import inspect

    (BUILT if inspect.signature(builder).parameters else SIMPLE)[name] = builder
    if variables:
        VARIABLES[name] = variables


def _prepared(df: DataFrame, names: list[str], hist: DataFrame, base: tuple[int, int] | None) -> tuple[DataFrame, dict[str, Column]]:
    """df with the columns that the named indicators aggregate, and their aggregates. Percentiles come first, as an array a series, so that rows are dealt by series once
    for them and for all that follows."""
    keys, by = series_keys(df), by_year(df)
    aggregates = {n: SIMPLE[n]() for n in names if n in SIMPLE}
    spells = {n: SPELLS[n] for n in names if n in SPELLS}
    if spells:
        limits = windows.doy_percentiles(historical(hist, base), {n: (v, p) for n, (v, p, _) in spells.items()})
        own = F.get("limits", F.col("doy") - 1)
        columns = df.columns
        df = df.join(limits, windows.common_keys(df, limits), "left").select(*columns, *(own[n].alias(f"__limit_{n}") for n in spells))
    if "rx5day" in names:
        along = Window.partitionBy(*keys).orderBy("date").rowsBetween(-4, 0)
        df = df.withColumn("__sum5", F.when(F.count("pr").over(along) == 5, F.sum("pr").over(along)))
        aggregates["rx5day"] = F.max("__sum5")
    runs = {f"__{n}": RUNS[n]() for n in names if n in RUNS}
    if runs:
        df = windows.with_run_lengths(df, runs, by)
        aggregates |= {n[2:]: F.max(n).cast("long") for n in runs}
    if spells:
        flags = {f"__{n}": F.col(v) > F.col(f"__limit_{n}") if above else F.col(v) < F.col(f"__limit_{n}") for n, (v, _, above) in spells.items()}
        df = windows.with_run_lengths(df, flags, by, counts=F.col("doy").isNotNull())
        aggregates |= {n[2:]: windows.days_of_runs(F.col(n), 6) for n in flags}
    return df, aggregates


def run_indicators(df: DataFrame, names: list[str], hist: DataFrame | None = None, mask: bool = True, base: tuple[int, int] | None = None) -> DataFrame:
    """Series keys, year and a column for each indicator; hist, of whose base period's years percentiles are taken (all, if there is none), defaults to the table itself.

    With mask, a series without data on its first day has none for the indicators of that variable (counts would say 0 there).
    """
    unknown = [n for n in names if n not in {*SIMPLE, *RUNS, *SPELLS, *BUILT, "rx5day"}]
    if unknown:
        raise ValueError(f"no such indicators: {unknown}")
    hist = df if hist is None else hist
    keys, by = series_keys(df), by_year(df)
    ready, aggregates = _prepared(df, names, hist, base)
    held = {n: VARIABLES.get(n, [v for v in ("pr", "tasmax", "tasmin") if v in df.columns]) for n in names} if mask else {}
    used = sorted({v for own in held.values() for v in own})
    first = [F.min_by(F.struct(*used), "date").alias("__first")] if used else []
    out = ready.groupBy(*by).agg(*(a.alias(n) for n, a in aggregates.items()), *first, F.min("date").alias("__from"))
    for n in names:
        if n in BUILT:
            out = out.join(BUILT[n](df, hist), by, "left")
    if used:
        out = out.withColumn("__first", F.first("__first").over(Window.partitionBy(*keys).orderBy("year")))
    gone = {n: F.lit(False) if not own else F.greatest(*(F.col(f"__first.{v}").isNull() for v in own), F.lit(False)) for n, own in held.items()}
    return out.select(*by, *(F.when(~gone[n], F.col(n)).alias(n) if n in gone else F.col(n) for n in names))


def indicator_delta(indicator: DataFrame, name: str, hist: tuple[int, int], proj: tuple[int, int], keys: list[str] | None = None) -> DataFrame:
    """Mean over the projected years less that over the historical ones; keys default to the series' without the scenario, since the
    two periods are mostly of different ones (a table with several projected scenarios needs keys or a filter)."""
    mean = lambda p: F.avg(F.when(F.col("year").between(*p), F.col(name)))
    keys = keys or [k for k in series_keys(indicator) if k != "scenario"]
    return indicator.groupBy(*keys).agg((mean(proj) - mean(hist)).alias("delta"))


def resample_with(df: DataFrame, keys: list[str], period: str, reducer: Callable[[str], Column], name: str = "value") -> DataFrame:
    """A caller's reducer over the days of each period (year, month, quarter, week)."""
    return df.groupBy(*keys, F.trunc("date", period).alias("period")).agg(reducer("value").alias(name))


def resample_series(df: DataFrame, keys: list[str], period: str, make: Callable[[np.ndarray, np.ndarray], float | None], name: str = "value") -> DataFrame:
    """resample_with for code that no Column says: make(dates, values) gives a number for the days of a period, in order, without those that have no value. Periods without
    a value are null. A period of a series is one Arrow group, which the calendar bounds."""
    own = df.select(*keys, F.trunc("date", period).alias("period"), "date", F.col("value").cast("double").alias("value"))
    schema = own.select(*keys, "period").schema.add(name, "double")

    def run(table: pa.Table) -> pa.Table:
        first = table.select([*keys, "period"]).slice(0, 1)
        table = table.filter(pc.is_valid(table["value"])).sort_by("date")
        found = make(table["date"].to_numpy(), table["value"].to_numpy()) if table.num_rows else None
        return first.append_column(name, pa.array([None if found is None else float(found)], pa.float64()))

    return own.groupBy(*keys, "period").applyInArrow(run, schema)
