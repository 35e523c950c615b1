"""Windows over days, runs, ranks and day-of-year quantiles."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import quantile_type8
from .selection import cumulative


#: What tells one daily series of a field table from another, as far as the table has it.
SERIES = ["model", "scenario", "variable", "cell_id"]


def series_keys(df: DataFrame) -> list[str]:
    """The series columns that the table has: no operator pools two models, scenarios or variables."""
    return [k for k in SERIES if k in df.columns]


def common_keys(a: DataFrame, b: DataFrame) -> list[str]:
    return [k for k in series_keys(a) if k in b.columns]


def member_keys(df: DataFrame) -> list[str]:
    """The series columns without the cell: what tells whole fields apart."""
    return [k for k in series_keys(df) if k != "cell_id"]


def on_members(a: DataFrame, b: DataFrame, *on: str, how: str = "inner") -> DataFrame:
    """a and a table with a row for each of its members (or one for all of them), joined on what member columns both have."""
    keys = [*(k for k in member_keys(a) if k in b.columns), *on]
    return a.join(b, keys, how) if keys else a.join(b, how="cross")


def rolling_sum(df: DataFrame, days: int, keys: list[str] | None = None) -> DataFrame:
    """Adds rolled: the sum of a row and the days - 1 before it, null unless all have data."""
    w = Window.partitionBy(*(keys or series_keys(df))).orderBy("date").rowsBetween(-(days - 1), 0)
    return df.withColumn("rolled", F.when(F.count("value").over(w) == days, F.sum("value").over(w)))


def runs(df: DataFrame, flag: Column, by: list[str]) -> DataFrame:
    """by and length: each run of consecutive rows (by date) with the flag."""
    along = Window.partitionBy(*by).orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    marked = df.select(*by, "date", F.coalesce(flag, F.lit(False)).alias("__on"))
    return marked.withColumn("__breaks", F.count_if(~F.col("__on")).over(along)).where("__on").groupBy(*by, "__breaks").agg(F.count("*").alias("length")).drop("__breaks")


def with_run_lengths(df: DataFrame, flags: dict[str, Column], by: list[str], counts: Column | None = None) -> DataFrame:
    """Adds a column for each flag: how many rows in a row have it by then, 0 without it. All flags share one sorted window. Rows that
    don't count (`counts`) are passed over: they neither break a run nor lengthen it."""
    counts = F.lit(True) if counts is None else F.coalesce(counts, F.lit(False))
    along = Window.partitionBy(*by).orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    on = {n: F.coalesce(f, F.lit(False)) for n, f in flags.items()}
    out = df.withColumn("__at", F.count_if(counts).over(along))
    out = out.withColumns({f"__last_{n}": F.max(F.when(counts & ~f, F.col("__at"))).over(along) for n, f in on.items()})
    lengths = {n: F.when(counts & f, F.col("__at") - F.coalesce(f"__last_{n}", F.lit(0))).otherwise(0) for n, f in on.items()}
    return out.withColumns(lengths).drop("__at", *(f"__last_{n}" for n in on))


def days_of_runs(length: Column, least: int) -> Column:
    """Aggregate of with_run_lengths: the days in runs of at least `least` days."""
    return F.coalesce(F.sum(F.when(length == least, least).when(length > least, 1)), F.lit(0)).cast("long")


def longest_run(df: DataFrame, flag: Column, by: list[str], name: str = "longest") -> DataFrame:
    """by and the longest run of the flag; groups without one have 0."""
    return with_run_lengths(df, {"__run": flag}, by).groupBy(*by).agg(F.max("__run").cast("long").alias(name))


def days_in_runs(df: DataFrame, flag: Column, by: list[str], least: int, name: str) -> DataFrame:
    """by and the number of days in runs of at least `least` days."""
    return with_run_lengths(df, {"__run": flag}, by).groupBy(*by).agg(days_of_runs(F.col("__run"), least).alias(name))


def pooled(df: DataFrame, half: int) -> DataFrame:
    """Series keys, doy, value: each value in the pools of the days within `half` days of its own, across year ends but not past the
    ends of the series. Every row is repeated 2 * half + 1 times, which suits windows of few days; `per_series` is the form for long ones."""
    from ..functions.scalar import noleap_doy

    keys = series_keys(df)
    ends = df.groupBy(*keys).agg(F.min("date").alias("__a"), F.max("date").alias("__b"))
    offsets = df.where("value is not null").join(ends, keys).withColumn("__at", F.explode(F.sequence(F.date_add("date", -half), F.date_add("date", half))))
    inside = offsets.where(F.col("__at").between(F.col("__a"), F.col("__b")))
    return inside.select(*keys, noleap_doy(F.col("__at")).alias("doy"), "value").where("doy is not null")


def doy_percentiles(df: DataFrame, wanted: dict[str, tuple[str, float]], window: int = 5) -> DataFrame:
    """Series keys and limits: an array of 365 structs with a field for each wanted percentile, name -> (column, probability), of type 8 over the pool of the days around each
    day of the year (those that `pooled` makes); null where a pool is empty.

    Each row is shuffled once, to its series, whatever the window and the number of percentiles. A day's values are gathered once and pools are made of a ring of 365 days by
    its neighbours. Values whose window has a 29 February or an end of the series in it don't fit the ring: they are put to each of their days by themselves.
    """
    from ..functions.scalar import noleap_doy

    keys, half, columns = series_keys(df), window // 2, sorted({c for c, _ in wanted.values()})
    whole = Window.partitionBy(*keys)  # which deals rows by series, unless a bucketed table has them so
    rows = df.select(*keys, "date", *columns).withColumns({"__a": F.min("date").over(whole), "__b": F.max("date").over(whole)}).where(F.coalesce(*columns).isNotNull())
    around = F.filter(F.sequence(F.date_add("date", -half), F.date_add("date", half)), lambda d: d.between(F.col("__a"), F.col("__b")))
    centres = F.filter(F.transform(around, noleap_doy), lambda d: d.isNotNull())
    to = lambda d, ring: F.struct(d.alias("doy"), F.lit(ring).alias("ring"))
    places = F.when(F.size("__centres") == 2 * half + 1, F.array(to(noleap_doy(F.col("date")), True))).otherwise(F.transform("__centres", lambda d: to(d, False)))
    placed = rows.withColumn("__centres", centres).select(*keys, F.explode(places).alias("p"), F.struct(*columns).alias("v"))
    days = placed.groupBy(*keys, F.col("p.doy").alias("doy")).agg(F.collect_list(F.when(F.col("p.ring"), F.col("v"))).alias("ring"), F.collect_list(F.when(~F.col("p.ring"), F.col("v"))).alias("own"))
    series = days.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("doy", F.struct("ring", "own")))).alias("m"))
    year = F.transform(F.sequence(F.lit(1), F.lit(365)), lambda d: F.try_element_at("m", d))
    none = F.array().cast(placed.select(F.array("v")).schema[0].dataType)

    def limits(i: Column) -> Column:
        pool = F.flatten(F.array(*(F.coalesce(F.get("year", F.pmod(i + o, F.lit(365)))["ring"], none) for o in range(-half, half + 1)), F.coalesce(F.get("year", i)["own"], none)))
        one = lambda c, p: F.get(F.transform(F.array(F.sort_array(F.filter(F.transform(pool, lambda v: v[c]), lambda x: x.isNotNull()))), lambda v: quantile_type8(v, p)), 0)
        return F.struct(*(one(c, p).alias(n) for n, (c, p) in wanted.items()))

    return series.select(*keys, year.alias("year")).select(*keys, F.transform(F.sequence(F.lit(0), F.lit(364)), limits).alias("limits"))


def percentile_doy(df: DataFrame, p: float, window: int = 5) -> DataFrame:
    """Series keys, doy, threshold: type 8 percentile of the pooled window."""
    keys = series_keys(df)
    out = doy_percentiles(df, {"threshold": ("value", p)}, window).select(*keys, F.posexplode("limits").alias("at", "limit"))
    return out.select(*keys, (F.col("at") + 1).alias("doy"), F.col("limit.threshold").alias("threshold")).where("threshold is not null")


def nodes(n: int) -> list[float]:
    return [(k + 0.5) / n for k in range(n)]


def doy_window_quantiles(df: DataFrame, n: int, window: int = 31) -> DataFrame:
    """Series keys, doy, q_idx, q, value: linear (type 7) quantiles of the pooled window at (k + 0.5) / n."""
    q, keys = nodes(n), series_keys(df)
    out = pooled(df, window // 2).groupBy(*keys, "doy").agg(F.percentile("value", F.array(*map(F.lit, q))).alias("v"))
    return out.select(*keys, "doy", F.posexplode("v").alias("q_idx", "value")).withColumn("q", (F.col("q_idx") + 0.5) / n)


def noleap_days(days: np.ndarray) -> np.ndarray:
    """Day of the year, 1 to 365, of day numbers since 1970; 0 on 29 February."""
    days = np.datetime64("1970-01-01") + days.astype(int)
    years = days.astype("datetime64[Y]")
    doy = (days - years.astype("datetime64[D]")).astype(int) + 1
    y = years.astype(int) + 1970
    leap = (y % 4 == 0) & ((y % 100 != 0) | (y % 400 == 0))
    return np.where(leap & (doy == 60), 0, np.where(leap & (doy > 60), doy - 1, doy))


def doy_spans(first: int, last: int, half: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each day of the year in first..last (day numbers), the places, counted from first, of the days within `half` days of its dates."""
    doy = noleap_days(np.arange(first, last + 1))
    order = np.argsort(doy, kind="stable")
    at = np.searchsorted(doy[order], np.arange(1, 367))
    for d in range(1, 366):
        centres = order[at[d - 1] : at[d]]
        if len(centres):
            span = (centres[:, None] + np.arange(-half, half + 1)).ravel()
            yield d, span[(span >= 0) & (span < len(doy))]


def on_every_day(days: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    """The values on all days from the first to the last, NaN where there are none."""
    out = []
    for v in values:
        dense = np.full(int(days[-1] - days[0]) + 1, np.nan)
        dense[days - days[0]] = v
        out.append(dense)
    return out


def doy_pools(days: np.ndarray, values: np.ndarray, half: int) -> Iterator[tuple[int, np.ndarray]]:
    """(doy, sorted pool) of a series. days: day numbers in order. A day's pool is made of the values around each of its dates."""
    (dense,) = on_every_day(days, values)
    for d, span in doy_spans(int(days[0]), int(days[-1]), half):
        pool = dense[span]
        pool = np.sort(pool[~np.isnan(pool)])
        if len(pool):
            yield d, pool


def rank_in(pool: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Ranks of values in a sorted pool that holds them, average ties, scaled to 0..1."""
    rank = (np.searchsorted(pool, values, "left") + np.searchsorted(pool, values, "right") + 1) / 2
    return (rank - 1) / (len(pool) - 1) if len(pool) > 1 else np.zeros(len(values))


def doy_ranks(days: np.ndarray, values: np.ndarray, half: int) -> np.ndarray:
    """The rank of each day in the pool of its own day of the year, NaN without data."""
    q = np.full(len(values), np.nan)
    doy = np.where(np.isnan(values), 0, noleap_days(days))
    order = np.argsort(doy, kind="stable")
    at = np.searchsorted(doy[order], np.arange(1, 367))
    for d, pool in doy_pools(days, values, half):
        own = order[at[d - 1] : at[d]]
        q[own] = rank_in(pool, values[own])
    return q


class RankCounts:
    """Multisets of ranks that values enter and leave one by one, one a lane, with counts by rank and by block of about sqrt(n) ranks. An entry touches two counts, and a question
    about what lies below a rank adds up the blocks before its own and the ranks before it in its block."""

    def __init__(self, lanes: int, ranks: int):
        self.width = max(1, int(np.ceil(np.sqrt(ranks))))
        self.blocks = -(-ranks // self.width) + 1
        self.count, self.block = np.zeros(lanes * self.blocks * self.width, np.int32), np.zeros(lanes * self.blocks, np.int32)

    def put(self, lane: np.ndarray, rank: np.ndarray, times: int = 1) -> None:
        np.add.at(self.count, lane * (self.blocks * self.width) + rank, times)
        np.add.at(self.block, lane * self.blocks + rank // self.width, times)

    def ask(self, lane: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """How many of a lane are below the rank, of it, and in all."""
        block, at = np.divmod(rank, self.width)
        blocks = self.block.reshape(-1, self.blocks)[lane]
        own = self.count.reshape(-1, self.blocks, self.width)[lane, block]
        before = np.where(np.arange(self.blocks) < block[:, None], blocks, 0).sum(axis=1)
        inside = np.where(np.arange(self.width) < at[:, None], own, 0).sum(axis=1)
        return before + inside, own[np.arange(len(lane)), at], blocks.sum(axis=1)


def sliding_ranks(days: np.ndarray, values: np.ndarray, half: int, years: int) -> np.ndarray:
    """The rank of each day among the days around its day of the year in the years - years .. + years around its own, scaled to 0..1; NaN without data.

    Pools are those of doy_pools over that frame of years, widened by half a window at both ends. Each day of the year has a lane of RankCounts: from one year to the next the windows of one year
    enter it and those of another leave, so the work follows the years of the series and not the length of the frame. What the frame's two ends add or lack
    is put in for the year's question and taken out again.
    """
    q = np.full(len(values), np.nan)
    known = ~np.isnan(values)
    if not known.any():
        return q
    distinct, ranks = np.unique(values[known], return_inverse=True)
    first, last = int(days[0]), int(days[-1])
    dense = np.full(last - first + 1, -1, np.int64)
    dense[days[known] - first] = ranks
    every = np.arange(first, last + 1)
    doy, year = noleap_days(every), _years(every)
    jan1 = {y: int(np.searchsorted(year, y)) for y in range(int(year[0]) - 1, int(year[-1]) + 3)}
    counts, spread = RankCounts(366, len(distinct)), np.arange(-half, half + 1)

    def windows_of(centres: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """Lanes and ranks of the days around centres (places from first) that lie in low..high."""
        centres = centres[doy[centres] > 0]
        at = (centres[:, None] + spread).ravel()
        lane = np.repeat(doy[centres], len(spread))
        ok = (at >= low) & (at <= high)
        at, lane = at[ok], lane[ok]
        ok = dense[at] >= 0
        return lane[ok], dense[at[ok]]

    def of_year(y: int) -> tuple[np.ndarray, np.ndarray]:
        return windows_of(np.arange(jan1.get(y, 0), jan1.get(y + 1, 0)), 0, len(dense) - 1)

    row_place = days - first
    row_year = year[row_place]
    entered = range(0)
    for y in np.unique(row_year).tolist():
        frame = range(max(y - years, int(year[0])), min(y + years, int(year[-1])) + 1)
        for k in entered:
            if k not in frame:
                counts.put(*of_year(k), -1)
        for k in frame:
            if k not in entered:
                counts.put(*of_year(k))
        entered = frame
        # The frame's days with rows, in whole days from first; and its years' days.
        low, high = max(0, _new_year(y - years) - half - first), min(len(dense), _new_year(y + years + 1) + half - first)
        rows = row_place[np.searchsorted(row_place, low) : np.searchsorted(row_place, high)]
        f0, f1 = int(rows[0]), int(rows[-1])
        a, b = jan1[frame[0]], jan1[frame[-1] + 1]
        beyond = [np.arange(a, min(f0, b)), np.arange(max(f1 + 1, a), b)]
        ends = [np.arange(f0, min(a, f1 + 1)), np.arange(max(b, f0), f1 + 1)]
        extra = [(w, -1) for c in beyond for w in [windows_of(c, 0, len(dense) - 1)]] + [(w, 1) for c in ends for w in [windows_of(c, f0, f1)]]
        for w, times in extra:
            counts.put(*w, times)
        own = np.flatnonzero((row_year == y) & known & (doy[row_place] > 0))
        if len(own):
            at = row_place[own]
            below, equal, total = counts.ask(doy[at], dense[at])
            q[own] = np.where(total > 1, (below + (equal - 1) / 2) / np.maximum(total - 1, 1), 0.0)
        for w, times in extra:
            counts.put(*w, -times)
    return q


def _years(days: np.ndarray) -> np.ndarray:
    return (np.datetime64("1970-01-01") + days.astype(int)).astype("datetime64[Y]").astype(int) + 1970


def _new_year(year: int) -> int:
    return int((np.datetime64(f"{year:04d}-01-01") - np.datetime64("1970-01-01")).astype(int))


def day_numbers(table: pa.Table) -> np.ndarray:
    return table["date"].cast(pa.int32()).to_numpy()


def per_series(df: DataFrame, make: Callable[[pa.Table], dict[str, np.ndarray]], columns: str, keys: list[str] | None = None) -> DataFrame:
    """Series keys and what `make` gives for each series, its rows in order of date, as an Arrow table; columns: the schema of that.

    The shuffle moves each value once. A series is bounded by the calendar; it has one row a day and every row has a date.
    """
    keys = keys or series_keys(df)
    schema = df.select(*keys).schema
    for f in T.StructType.fromDDL(columns):
        schema = schema.add(f)

    def run(table: pa.Table) -> pa.Table:
        made = make(table.sort_by("date"))
        n = len(next(iter(made.values())))
        own = table.select(keys).take(pa.array(np.zeros(n, np.int64)))
        return pa.table([*own.columns, *(pa.array(v, from_pandas=True) for v in made.values())], names=[*keys, *made])

    return df.groupBy(*keys).applyInArrow(run, schema)


def with_series_column(df: DataFrame, make: Callable[[pa.Table], np.ndarray], name: str) -> DataFrame:
    """df with a column of doubles that `make` finds for each series, its rows in order of date."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("date")
        return table.append_column(name, pa.array(make(table), pa.float64(), from_pandas=True))

    return df.groupBy(*series_keys(df)).applyInArrow(run, df.select("*").schema.add(name, "double"))


def doy_window_quantiles_per_cell(df: DataFrame, n: int, window: int = 31) -> DataFrame:
    """doy_window_quantiles for long windows: one Arrow group a series."""
    q = np.array(nodes(n))

    def make(table: pa.Table) -> dict[str, np.ndarray]:
        doys, out = [], []
        for d, pool in doy_pools(day_numbers(table), table["value"].to_numpy(), window // 2):
            doys.append(d)
            out.append(np.quantile(pool, q))
        k = np.tile(np.arange(n, dtype=np.int32), len(doys))
        return {"doy": np.repeat(np.array(doys, np.int32), n), "q_idx": k, "value": np.concatenate([np.zeros(0), *out]), "q": q[k]}

    return per_series(df.select(*series_keys(df), "date", "value"), make, "doy int, q_idx int, value double, q double")


def doy_window_means(df: DataFrame, window: int = 31) -> DataFrame:
    """Series keys, doy and mean of the pooled window."""

    def make(table: pa.Table) -> dict[str, np.ndarray]:
        found = [(d, pool.mean()) for d, pool in doy_pools(day_numbers(table), table["value"].to_numpy(), window // 2)]
        return {"doy": np.array([d for d, _ in found], np.int32), "mean": np.array([m for _, m in found], np.float64)}

    return per_series(df.select(*series_keys(df), "date", "value"), make, "doy int, mean double")


def rank_in_doy_window(df: DataFrame, window: int = 31) -> DataFrame:
    """Adds q: the rank of a day in the pool of its own day of the year, average ties, scaled to 0..1; null without data and on 29 February."""
    return with_series_column(df, lambda t: doy_ranks(day_numbers(t), t["value"].to_numpy(), window // 2), "q")


def ecdf(df: DataFrame, by: list[str]) -> DataFrame:
    """Rows with data and cdf: the share of their group's values that are no greater, for groups of any size."""
    return cumulative(df, by)


def argmax_doy(df: DataFrame) -> DataFrame:
    """Series keys and centre: the day of the year of the maximum, the earliest date of equals."""
    return df.where("value is not null and doy is not null").groupBy(*series_keys(df)).agg(F.max_by("doy", F.struct("value", (-F.unix_date("date")).alias("d"))).alias("centre"))


def extreme_cells(df: DataFrame) -> DataFrame:
    """By model, scenario and variable as far as the table has them: statistic, cell with the greatest and the least of the time max, min,
    mean and total of the cells; ties to the smaller cell."""
    keys = series_keys(df)
    s = df.groupBy(*keys).agg(F.max("value").alias("max"), F.min("value").alias("min"), F.avg("value").alias("mean"), F.sum("value").alias("total"))
    tall = s.unpivot(keys, ["max", "min", "mean", "total"], "statistic", "v")
    top = F.max_by("cell_id", F.struct("v", (-F.col("cell_id")).alias("c")))
    return tall.groupBy(*(k for k in keys if k != "cell_id"), "statistic").agg(top.alias("most_cell"), F.max("v").alias("most"), F.min_by("cell_id", F.struct("v", "cell_id")).alias("least_cell"), F.min("v").alias("least"))


def cvm_statistic(a: DataFrame, b: DataFrame) -> DataFrame:
    """Series keys, n, m, statistic: two-sample Cramer-von Mises T from mid ranks. Keys that only b has (a model's, where a is observed) give a comparison each."""
    keys, common = series_keys(b), common_keys(a, b)
    a = a.join(b.select(*keys).distinct(), common) if len(common) < len(keys) else a
    both = a.select(*keys, "value", F.lit(1).alias("s")).unionByName(b.select(*keys, "value", F.lit(2).alias("s"))).where("value is not null")
    series = Window.partitionBy(*keys)
    mid = F.rank().over(series.orderBy("value")) + (F.count("*").over(Window.partitionBy(*keys, "value")) - 1) / 2
    own = Window.partitionBy(*keys, "s").orderBy("value")
    i = F.rank().over(own) + (F.count("*").over(Window.partitionBy(*keys, "s", "value")) - 1) / 2
    d = both.select(*keys, "s", F.pow(mid - i, F.lit(2)).alias("d"))
    g = d.groupBy(*keys).agg(F.count_if(F.col("s") == 1).cast("double").alias("n"), F.count_if(F.col("s") == 2).cast("double").alias("m"), F.sum(F.when(F.col("s") == 1, F.col("d"))).alias("d1"), F.sum(F.when(F.col("s") == 2, F.col("d"))).alias("d2"))
    u = F.col("n") * F.col("d1") + F.col("m") * F.col("d2")
    n, m = F.col("n"), F.col("m")
    return g.where("n > 0 and m > 0").select(*keys, "n", "m", (u / (n * m * (n + m)) - (4 * n * m - 1) / (6 * (n + m))).alias("statistic"))


def _cvm_tail(t: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Asymptotic p-values: T is standardised to the limit law's mean 1/6 and variance 1/45, whose distribution has a Bessel series."""
    total = n + m
    mean = (1 + 1 / total) / 6
    spread = (total + 1) * (4 * m * n * total - 3 * (m * m + n * n) - 2 * m * n) / (45 * total**2 * 4 * m * n)
    x = np.maximum(1 / 6 + (t - mean) / np.sqrt(45 * spread), 1e-6)
    cdf = np.zeros_like(x)
    for k in range(40):
        y = (4 * k + 1) ** 2 / (16 * x)
        cdf += math.exp(math.lgamma(k + 0.5) - math.lgamma(k + 1)) / math.pi**1.5 / np.sqrt(x) * math.sqrt(4 * k + 1) * np.exp(-y) * _k14(y)
    # The sum needs some 3 * sqrt(x) terms; beyond 10 the tail is under exp(-49).
    return np.where(t < 0.003, 1.0, np.where(x > 10, 0.0, np.clip(1 - cdf, 0, 1)))


def _k14(y: np.ndarray) -> np.ndarray:
    """The modified Bessel function of the second kind of order 1/4, by the trapezoid rule over its cosh integral."""
    u = np.linspace(0, 12, 2401)
    with np.errstate(over="ignore", under="ignore"):
        inner = np.exp(-np.multiply.outer(y, np.cosh(u))) * np.cosh(u / 4)
    return (inner.sum(axis=-1) - 0.5 * inner[..., 0]) * (u[1] - u[0])


def cvm_2samp(a: DataFrame, b: DataFrame) -> DataFrame:
    """cvm_statistic with its asymptotic pvalue."""
    found = cvm_statistic(a, b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m, t = (batch.column(c).to_numpy() for c in ("n", "m", "statistic"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(_cvm_tail(t, n, m))], names=[*batch.schema.names, "pvalue"])

    return found.mapInArrow(run, found.select("*").schema.add("pvalue", "double"))


def q_ratio(ref: DataFrame, hist: DataFrame, doy: int, q: float, half: int = 15) -> DataFrame:
    """Series keys of hist and ratio of the two series' quantiles over the days around one day of the year, without wrapping. A series has as
    many of these days as the calendar, so its quantile is a plain aggregate."""
    near = F.col("doy").between(doy - half, doy + half)
    r, h = (d.where(near).groupBy(*series_keys(d)).agg(F.percentile("value", F.lit(q)).alias(n)) for d, n in ((ref, "r"), (hist, "h")))
    return r.join(h, common_keys(ref, hist)).select(*series_keys(hist), F.try_divide("r", "h").alias("ratio"))
