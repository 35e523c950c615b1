"""Queries of indicators, over two models and two scenarios of each cell; some cells have no precipitation on their first day."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import indicators
from .catalogue import query
from .inputs import members, pool_sql, sql
from .q_select import six

S = "model, scenario, cell_id"
KEYS = f"{S}, year"


def limits_sql(column: str, p: float, source: str = "dated", keys: str = "cell_id") -> str:
    """CTEs that end in `lim`: the type 8 percentile of a five-day pool."""
    return pool_sql(source, column, 2, keys) + f", s8 AS (SELECT {keys}, doy, list_sort(list(value)) AS v, (len(list(value)) + 1e0 / 3) * {p}e0 + 1e0 / 3 AS h FROM pool GROUP BY ALL), i8 AS (SELECT *, greatest(1, least(len(v), floor(h)))::INT AS lo FROM s8), lim AS (SELECT {keys}, doy, v[lo] + greatest(0e0, least(1e0, h - lo)) * (v[least(len(v), lo + 1)] - v[lo]) AS threshold FROM i8)"


def _named(ctes: str, suffix: str) -> str:
    """CTEs under names of their own."""
    import re

    for name in ("e", "o", "pool", "s8", "i8", "lim"):
        ctes = re.sub(rf"(?<![\w.']){name}(?=( AS \(| USING|\)| WHERE| GROUP|$| JOIN))", f"{name}_{suffix}", ctes)
    return ctes


FIRST = f"first_day AS (SELECT {S}, arg_min((pr IS NULL)::INT, date) = 1 AS no_pr, arg_min((tasmax IS NULL)::INT, date) = 1 AS no_tasmax, arg_min((tasmin IS NULL)::INT, date) = 1 AS no_tasmin FROM members GROUP BY ALL)"
HISTORY = "history AS (SELECT model, cell_id, date, doy, tasmax, tasmin FROM members WHERE scenario = 'historical')"
_SIMPLE = {
    "rx1day": "max(pr)", "su": "count(CASE WHEN tasmax > 25 THEN 1 END)", "dw": "count(CASE WHEN tasmin < -30 THEN 1 END)", "r10mm": "count(CASE WHEN pr > 10 THEN 1 END)",
    "ice_days": "count(CASE WHEN tasmax < 0 THEN 1 END)", "summer_days_20": "count(CASE WHEN tasmax > 20 THEN 1 END)", "dpi": "round(avg(CASE WHEN pr >= 1 THEN pr END), 6)",
    "dw_30": "count(CASE WHEN tasmax < -30 THEN 1 END)", "dry_days": "count(CASE WHEN pr < 0.2 THEN 1 END)", "hd": "list_sort(list(tasmax) FILTER (tasmax IS NOT NULL), 'DESC')[6]", "cd": "list_sort(list(tasmin) FILTER (tasmin IS NOT NULL))[6]",
    "ftc": "CASE WHEN count(CASE WHEN tasmax IS NOT NULL AND tasmin IS NOT NULL THEN 1 END) >= dayofyear(make_date(year, 12, 31)) THEN count(CASE WHEN tasmax > 0 AND tasmin <= 0 THEN 1 END) END",
}
_RUNS = {"cwd": "pr > 1", "cdd": "pr < 1", "max_consecutive_warm_days": "tasmax > 25"}
_SPELLS = {"wsdi": ("tasmax", 0.9, ">"), "csdi": ("tasmin", 0.1, "<")}
_NUMBERS = {"rx1day": "i1", "rx5day": "i2", "su": "i3", "dw": "i4", "ftc": "i5", "hd": "i6", "cd": "i7", "r10mm": "i8", "cwd": "i9", "cdd": "i10", "wsdi": "i11", "csdi": "i12", "ice_days": "i13", "summer_days_20": "i14", "dpi": "i16", "dw_30": "i17", "dry_days": "i18", "max_consecutive_warm_days": "i19"}


def _islands(source: str, n: str) -> str:
    """CTEs that end in `l_<n>`: the lengths of the runs of a flag."""
    return f"r_{n} AS (SELECT {KEYS}, date, flag, row_number() OVER (PARTITION BY {KEYS} ORDER BY date) - row_number() OVER (PARTITION BY {KEYS}, flag ORDER BY date) AS island FROM ({source})), l_{n} AS (SELECT {KEYS}, island, count(*) AS n FROM r_{n} WHERE flag GROUP BY ALL)"


def table_sql(name: str) -> str:
    """CTEs that end in `t_<name>`: the indicator by series and year, without the mask."""
    if name in _SIMPLE:
        return f"t_{name} AS (SELECT {KEYS}, {_SIMPLE[name]} AS {name} FROM members GROUP BY {KEYS})"
    if name == "rx5day":
        return f"t_rx5day AS (SELECT {KEYS}, max(s) AS rx5day FROM (SELECT {KEYS}, CASE WHEN count(pr) OVER w = 5 THEN sum(pr) OVER w END AS s FROM members WINDOW w AS (PARTITION BY {S} ORDER BY date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)) GROUP BY {KEYS})"
    every = f"(SELECT DISTINCT {KEYS} FROM members)"
    if name in _RUNS:
        return _islands(f"SELECT {KEYS}, date, coalesce({_RUNS[name]}, false) AS flag FROM members", name) + f", t_{name} AS (SELECT {KEYS}, coalesce(max(n), 0) AS {name} FROM {every} LEFT JOIN l_{name} USING ({KEYS}) GROUP BY {KEYS})"
    column, p, op = _SPELLS[name]
    source = f"SELECT d.{KEYS.replace(', ', ', d.')}, d.date, coalesce(d.{column} {op} q.threshold, false) AS flag FROM members d LEFT JOIN lim_{name} q USING (model, cell_id, doy) WHERE doy IS NOT NULL"
    return _named(limits_sql(column, p, "history", "model, cell_id"), name) + ", " + _islands(source, name) + f", t_{name} AS (SELECT {KEYS}, coalesce(sum(n), 0)::BIGINT AS {name} FROM {every} LEFT JOIN (SELECT * FROM l_{name} WHERE n >= 6) USING ({KEYS}) GROUP BY {KEYS})"


def indicators_sql(names: list[str]) -> str:
    masked = ", ".join(f"CASE WHEN NOT ({' OR '.join(f'no_{v}' for v in indicators.VARIABLES[n])}) THEN {n} END AS {n}" for n in names)
    joined = " ".join(f"JOIN t_{n} USING ({KEYS})" for n in names[1:])
    return sql(f"WITH {HISTORY}, {FIRST}, {', '.join(map(table_sql, names))} SELECT {KEYS}, {masked} FROM t_{names[0]} {joined} JOIN first_day USING ({S})", "members")


for _name, _number in _NUMBERS.items():

    @query(f"{_number}_{_name}", indicators_sql([_name]))
    def _(spark, sf, name=_name):
        out = indicators.run_indicators(members(spark, sf), [name])
        return six(out, name) if name == "dpi" else out


@query("i15_tx90p", sql(f"WITH {HISTORY}, {limits_sql('tasmax', 0.9, 'history', 'model, cell_id')} SELECT d.model, d.scenario, d.cell_id, d.year, d.month, count(CASE WHEN d.tasmax > lim.threshold THEN 1 END) AS tx90p FROM members d JOIN lim USING (model, cell_id, doy) GROUP BY ALL", "members"))
def _(spark, sf):
    d = members(spark, sf)
    return indicators.tx90p(d, d)


@query("i20_run_indicators", indicators_sql(list(_NUMBERS)))
def _(spark, sf):
    return six(indicators.run_indicators(members(spark, sf), list(_NUMBERS)), "dpi")


@query("i21_indicator_delta", sql("WITH a AS (SELECT model, cell_id, year, max(pr) AS rx1day FROM members GROUP BY ALL) SELECT model, cell_id, round(avg(CASE WHEN year BETWEEN 1999 AND 2001 THEN rx1day END) - avg(CASE WHEN year BETWEEN 1995 AND 1998 THEN rx1day END), 6) AS delta FROM a GROUP BY ALL", "members"))
def _(spark, sf):
    yearly = indicators.run_indicators(members(spark, sf), ["rx1day"], mask=False)
    return six(indicators.indicator_delta(yearly, "rx1day", (1995, 1998), (1999, 2001)), "delta")


@query("u1_register_indicator", sql(f"SELECT {KEYS}, count(CASE WHEN tasmax - tasmin > 30 THEN 1 END) AS wide_days FROM members GROUP BY {KEYS}", "members"))
def _(spark, sf):
    indicators.register_indicator("wide_days", lambda: F.count_if(F.col("tasmax") - F.col("tasmin") > 30), ["tasmax", "tasmin"])
    return indicators.run_indicators(members(spark, sf), ["wide_days"])
