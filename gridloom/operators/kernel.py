"""Many settings of bias adjustment in one pass over the series.

The reference, the historical simulation and the simulation to adjust are dealt once, by the keys that all three share (a cell), as one table of rows with a role. A group
holds a cell's series of all models, which the calendar and the catalogue bound. In it every setting is worked out from arrays that settings have in common: sorted pools are made once a
window, quantiles once a window and number, ranks once a window, adapted values once a threshold. So shuffles don't depend on the number of settings.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import astuple, dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import windows
from .windows import common_keys, series_keys

_SETTING = "method string, trend string, window int, nq int, adapt double, jitter double"


@dataclass(frozen=True)
class Setting:
    """method: qdm (by rank), qm (by value) or dqm (by value, detrended by trend: mean, poly1, poly3 or loess). adapt: the dry-day threshold of frequency
    adaptation, jitter: the value under which reference and historical values become noise; None: neither."""

    method: str = "qdm"
    trend: str | None = None
    window: int = 31
    nq: int = 100
    adapt: float | None = None
    jitter: float | None = None

    def __post_init__(self):
        if self.method not in ("qdm", "qm", "dqm") or (self.method == "dqm") != (self.trend in ("mean", "poly1", "poly3", "loess")):
            raise ValueError(f"no such setting: {self}")


def uniform(seed: int, keys: list[str]) -> Column:
    """A number in 0..1 drawn from a hash of the keys and the date, so that a task that runs again draws the same."""
    return (F.pmod(F.xxhash64(F.lit(seed), *keys, "date"), F.lit(1 << 40)).cast("double") + 0.5) / float(1 << 40)


def smooth(x: np.ndarray, v: np.ndarray, how: str, share: float = 0.2) -> np.ndarray:
    """The mean, the line, the cubic or the LOESS curve of v over x at each x; values that are missing don't count."""
    ok = ~np.isnan(v)
    if not ok.any():
        return np.full(len(v), np.nan)
    if how != "loess":
        degree = min({"mean": 0, "poly1": 1, "poly3": 3}[how], len(np.unique(x[ok])) - 1)
        centre = x[ok].mean()
        return np.polyval(np.polyfit(x[ok] - centre, v[ok], degree), x - centre)
    k = max(2, int(np.ceil(share * ok.sum())))
    d = np.abs(x[:, None] - x[ok][None, :])
    reach = np.sort(d, axis=1)[:, min(k, d.shape[1]) - 1 : min(k, d.shape[1])]
    w = np.clip(1 - (d / np.maximum(reach * (1 + 1e-9), 1e-9)) ** 3, 0, None) ** 3
    return (w * v[ok]).sum(axis=1) / w.sum(axis=1)


def by_doy(doy: np.ndarray) -> Iterator[np.ndarray]:
    """The places of each day of the year."""
    order = np.argsort(doy, kind="stable")
    yield from np.split(order, np.flatnonzero(np.diff(doy[order])) + 1)


class _Daily:
    """A daily series in order, with the draws of its rows; pools of each day of the year are made once a window."""

    def __init__(self, table: pa.Table):
        self.days, self.values = windows.day_numbers(table), table["value"].to_numpy(zero_copy_only=False).astype(float)
        self.doy = windows.noleap_days(self.days)
        self.draws = {c: table[c].to_numpy(zero_copy_only=False) for c in ("u0", "u1", "uj") if c in table.column_names}
        self._pools: dict = {}

    def with_values(self, values: np.ndarray) -> _Daily:
        other = object.__new__(_Daily)
        other.__dict__ = self.__dict__ | {"values": values, "_pools": {}}
        return other

    def pools(self, window: int) -> dict[int, np.ndarray]:
        if window not in self._pools:
            self._pools[window] = dict(windows.doy_pools(self.days, self.values, window // 2)) if len(self.days) else {}
        return self._pools[window]

    def on_doys(self, found: dict[int, float]) -> np.ndarray:
        """The value of each row's day of the year, NaN without one."""
        table = np.full(367, np.nan)
        for d, v in found.items():
            table[d] = v
        table[0] = np.nan
        return table[self.doy]


def _divided(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.divide(a, b, out=np.full(np.broadcast(a, b).shape, np.nan), where=b != 0)


class Kernel:
    """All settings of one historical series, its reference and the series to adjust."""

    def __init__(self, ref: _Daily, hist: _Daily, kind: str):
        self.ref, self.hist, self.kind = ref, hist, kind
        self.trained, self.map, self.normal = cache(self._trained), cache(self._map), cache(self._normal)

    def factor(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return a - b if self.kind == "+" else _divided(a, b)

    def adjusted(self, value: np.ndarray, af: np.ndarray) -> np.ndarray:
        return value + af if self.kind == "+" else value * af

    def _trained(self, window: int, adapt: float | None, jitter: float | None) -> tuple[_Daily, _Daily]:
        """Reference and historical series as a setting trains on them: jitter first, then dry days made wet where the historical ones are too many."""
        if jitter is None and adapt is None:
            return self.ref, self.hist
        if adapt is None:
            return tuple(d.with_values(np.where(d.values < jitter, np.maximum(1e-12, d.draws["uj"] * jitter), d.values)) for d in (self.ref, self.hist))
        ref, hist = self.trained(0, None, jitter)
        share, top = {}, {}
        r_pools, h_pools = ref.pools(window), hist.pools(window)
        for d in r_pools.keys() & h_pools.keys():
            r, h = r_pools[d], h_pools[d]
            rd, hd = (r < adapt).mean(), (h < adapt).mean()
            if hd > rd:
                share[d], top[d] = (hd - rd) / hd, max(adapt, r[min(len(r) - 1, int(hd * len(r)))])
        wet = adapt + hist.draws["u1"] * (hist.on_doys(top) - adapt)
        return ref, hist.with_values(np.where((hist.values < adapt) & (hist.draws["u0"] < hist.on_doys(share)), wet, hist.values))

    def _quantiles(self, ref: _Daily, hist: _Daily, window: int, nq: int) -> tuple[np.ndarray, np.ndarray]:
        """hist_q and af by day of the year and node, NaN where a side has no pool."""
        nodes, tables = np.array(windows.nodes(nq)), []
        for d in (ref, hist):
            table = np.full((367, nq), np.nan)
            for doy, pool in d.pools(window).items():
                table[doy] = np.quantile(pool, nodes)
            tables.append(table)
        r, h = tables
        return np.where(np.isnan(r), np.nan, h), self.factor(r, h)

    def _map(self, window: int, nq: int, adapt: float | None, jitter: float | None) -> tuple[np.ndarray, np.ndarray]:
        return self._quantiles(*self.trained(window, adapt, jitter), window, nq)

    def _normal(self, window: int, nq: int, adapt: float | None, jitter: float | None) -> tuple[tuple[np.ndarray, np.ndarray], dict[int, float]]:
        """The map of values without the means of their pools, and what scales one mean to the other."""
        ref, hist = self.trained(window, adapt, jitter)
        means = [{d: float(p.mean()) for d, p in s.pools(window).items()} for s in (ref, hist)]
        flat = [s.with_values(self.without(s.values, s.on_doys(m))) for s, m in zip((ref, hist), means)]
        both = sorted(means[0].keys() & means[1].keys())
        scale = self.factor(np.array([means[0][d] for d in both]), np.array([means[1][d] for d in both]))
        return self._quantiles(*flat, window, nq), dict(zip(both, scale.tolist()))

    def without(self, value: np.ndarray, of: np.ndarray) -> np.ndarray:
        return value - of if self.kind == "+" else _divided(value, of)

    def _nearest(self, found: tuple[np.ndarray, np.ndarray], doy: np.ndarray, value: np.ndarray) -> np.ndarray:
        """value adjusted by the factor of the quantile whose value is nearest, to nine decimals, the lower of two."""
        hist_q, af = found
        out = np.full(len(value), np.nan)
        for at in np.array_split(np.arange(len(value)), max(1, len(value) // 20_000)):
            away = np.round(np.abs(hist_q[doy[at]] - value[at, None]), 9)
            k = np.where(np.isnan(away), np.inf, away).argmin(axis=1)
            out[at] = self.adjusted(value[at], np.where(np.isnan(away[np.arange(len(at)), k]), np.nan, af[doy[at], k]))
        return out

    def apply(self, sim: _Daily, rank, s: Setting) -> tuple[np.ndarray, np.ndarray]:
        """Adjusted values, and which rows the method gives at all. rank: the series' ranks for a window."""
        how = (s.window, s.nq, s.adapt, s.jitter)
        every = np.ones(len(sim.values), bool)
        if s.method == "qm":
            return self._nearest(self.map(*how), sim.doy, sim.values), every
        if s.method == "qdm":
            q, af = rank(s.window), self.map(*how)[1]
            k = np.clip(np.ceil(np.nan_to_num(q) * s.nq - 1), 0, s.nq - 1).astype(int)
            return np.where(np.isnan(q), np.nan, self.adjusted(sim.values, af[sim.doy, k])), every
        found, scale = self.normal(*how)
        given = np.isin(sim.doy, np.fromiter(scale, np.int64, len(scale)))
        value, trend = self.adjusted(sim.values, sim.on_doys(scale)), np.full(len(sim.values), np.nan)
        year = (np.datetime64("1970-01-01") + sim.days.astype(int)).astype("datetime64[Y]").astype(int) + 1970.0
        own = np.flatnonzero(given)
        for at in by_doy(sim.doy[own]) if len(own) else ():
            trend[own[at]] = smooth(year[own[at]], value[own[at]], s.trend)
        return self.adjusted(self._nearest(found, sim.doy, self.without(value, trend)), trend), given


def adjust_grid(ref: DataFrame, hist: DataFrame, sim: DataFrame, settings: list[Setting], kind: str = "+", seed: int = 0) -> DataFrame:
    """method, trend, window, nq, adapt, jitter and sim's columns, value adjusted: sim's rows for each setting (dqm leaves out days that have no scale).

    Maps are trained as qdm_train does, on hist without its scenario, and serve all scenarios of the model; a ref without models serves them all. Null values and
    days without a map are null. Equal settings are made once. Tables without rows give none.
    """
    settings = list(dict.fromkeys(settings))
    common = [k for k in common_keys(sim, ref) if k in hist.columns and k != "scenario"]
    own = [k for k in common_keys(sim, hist) if k not in (*common, "scenario")]
    named = lambda keys: F.to_json(F.struct(*keys)) if keys else F.lit("")
    draws, random = F.lit(None).cast("double"), any(s.adapt is not None or s.jitter is not None for s in settings)
    kept = T.StructType(sim.schema.fields)

    def side(df: DataFrame, role: int, who: Column, series: Column, row: Column, u: list[Column]) -> DataFrame:
        return df.select(*common, F.lit(role).alias("role"), who.alias("who"), series.alias("series"), "date", F.col("value").cast("double").alias("value"), *(c.alias(n) for c, n in zip(u, ("u0", "u1", "uj"))), row.alias("row"))

    draw = lambda df, k: uniform(seed + k, series_keys(df)) if random else draws
    none = F.lit(None).cast(kept)
    rows = side(ref, 0, F.lit(""), F.lit(""), none, [draws, draws, draw(ref, 2)])
    rows = rows.unionByName(side(hist, 1, named(own), F.lit(""), none, [draw(hist, 0), draw(hist, 1), draw(hist, 2)]))
    rows = rows.unionByName(side(sim, 2, named(own), named(series_keys(sim)), F.struct(*sim.columns), [draws, draws, draws]))
    names, place = kept.names, kept.names.index("value")
    schema = T.StructType([*T.StructType.fromDDL(_SETTING).fields, *(f if f.name != "value" else T.StructField("value", T.DoubleType()) for f in kept.fields)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)).sort_by([("role", "ascending"), ("who", "ascending"), ("series", "ascending"), ("date", "ascending")])
        key = [table[c].to_numpy(zero_copy_only=False) for c in ("role", "who", "series")]
        edges = np.flatnonzero(np.concatenate([[True], np.any([k[1:] != k[:-1] for k in key], axis=0)])).tolist() + [table.num_rows]
        parts = [table.slice(a, b - a).combine_chunks() for a, b in zip(edges, edges[1:])]
        empty = table.slice(0, 0)
        of = lambda role: [p for p in parts if p["role"][0].as_py() == role]
        reference = _Daily((of(0) or [empty])[0])
        trained = {p["who"][0].as_py(): Kernel(reference, _Daily(p), kind) for p in of(1)}
        for p in of(2):
            daily = _Daily(p)
            kernel = trained.get(p["who"][0].as_py()) or Kernel(reference, _Daily(empty), kind)
            rank = cache(lambda window, d=daily: windows.doy_ranks(d.days, d.values, window // 2))
            columns = pa.concat_arrays(p["row"].chunks).flatten() if p["row"].num_chunks != 1 else p["row"].chunk(0).flatten()
            for s in settings:
                value, given = kernel.apply(daily, rank, s)
                own_rows = [*columns[:place], pa.array(value, pa.float64(), from_pandas=True), *columns[place + 1 :]]
                head = [pa.array([x] * len(value), t) for x, t in zip(astuple(s), (pa.string(), pa.string(), pa.int32(), pa.int32(), pa.float64(), pa.float64()))]
                yield pa.RecordBatch.from_arrays([*head, *own_rows], names=[*schema_names, *names]).filter(pa.array(given))

    schema_names = schema.names[:6]
    return rows.groupBy(*common).applyInArrow(run, schema)
