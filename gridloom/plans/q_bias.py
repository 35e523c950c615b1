"""Queries of bias adjustment."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import bias
from .catalogue import query
from .inputs import member, series, simulations, sql
from .q_indicators import S, pool_sql
from .q_select import six
from .q_windows import rank_sql

W, NQ = 15, 5
NODES = "[0.1, 0.3, 0.5, 0.7, 0.9]"
M = "model, cell_id"
#: The reference has no models; hist is the simulations' historical scenario, later the other one.
HIST = "hist AS (SELECT * EXCLUDE (scenario) FROM simulations WHERE scenario = 'historical'), later AS (SELECT * FROM simulations WHERE scenario = 'ssp585'), obs AS (SELECT cell_id, date, year, month, doy, pr AS value FROM dated)"


def pools(source: str, name: str, keys: str, window: int = W) -> str:
    out = pool_sql(source, "value", window // 2, keys)
    for part in ("e", "o", "pool"):
        out = out.replace(f"{part} AS (", f"{name}_{part} AS (", 1)
    return out.replace("JOIN e USING", f"JOIN {name}_e USING").replace("FROM o WHERE", f"FROM {name}_o WHERE")


def quantiles(name: str, column: str, keys: str, nq: int = NQ) -> str:
    nodes = [(k + 0.5) / nq for k in range(nq)]
    return f"SELECT {keys}, doy, unnest(range({nq}))::INT AS q_idx, unnest(quantile_cont(value, {nodes})) AS {column} FROM {name}_pool GROUP BY {keys}, doy"


def qmap_sql(op: str = "-", out: str = "qmap", ref: str = "obs", hist: str = "hist", tag: str = "", window: int = W, nq: int = NQ) -> str:
    """CTEs that end in the quantile table of two sources."""
    af = "ref_q - hist_q" if op == "-" else "CASE WHEN hist_q <> 0 THEN ref_q / hist_q END"
    r, h = f"r{tag}", f"h{tag}"
    return f"{pools(ref, r, 'cell_id', window)}, {pools(hist, h, M, window)}, {out} AS (SELECT {M}, doy, q_idx, ref_q, hist_q, {af} AS af FROM ({quantiles(h, 'hist_q', M, nq)}) JOIN ({quantiles(r, 'ref_q', 'cell_id', nq)}) USING (cell_id, doy, q_idx))"


def ranked(source: str, name: str, keys: str = S, window: int = W) -> str:
    return f"{pools(source, name, keys, window)}, {rank_sql(f'{name}_pool', keys, f'{name}_ranked')}"


def node(q: str, nq: int = NQ) -> str:
    return f"greatest(0, least({nq - 1}, ceil({q} * {nq} - 1)))::INT"


def adjusted(source: str, name: str, op: str, ranks: str = "l_ranked", qmap: str = "qmap", nq: int = NQ) -> str:
    return f"{name} AS (SELECT {S}, date, year, doy, value {op} af AS value FROM {source} s LEFT JOIN {ranks} r USING ({S}, doy, value) LEFT JOIN (SELECT {M}, doy, q_idx, af FROM {qmap}) m ON m.model = s.model AND m.cell_id = s.cell_id AND m.doy = s.doy AND m.q_idx = {node('r.q', nq)})"


def eqm(source: str, name: str, qmap: str = "qmap", keep: str = "") -> str:
    """A CTE of source's rows adjusted by the factor of the nearest quantile."""
    more = f", any_value({keep}) AS {keep}" if keep else ""
    return f"{name} AS (SELECT s.model, s.scenario, s.cell_id, s.date, any_value(s.value) + arg_min(m.af, (round(abs(m.hist_q - s.value), 9), m.q_idx)) AS value{more} FROM {source} s LEFT JOIN {qmap} m ON m.model = s.model AND m.cell_id = s.cell_id AND m.doy = s.doy GROUP BY ALL)"


#: Trends of `scaled` by series and day of the year: the mean; the line and the cubic by polynomials orthogonal over a group's years; LOESS of
#: degree 0 with tricube weights.
TRENDS = {
    "mean": f"SELECT {S}, doy, date, avg(value) OVER (PARTITION BY {S}, doy) AS trend FROM scaled",
    "poly1": "SELECT {S}, doy, date, v0 + coalesce(v1 / nullif(s1, 0), 0) * p1 AS trend FROM poly",
    "poly3": "SELECT {S}, doy, date, v0 + coalesce(v1 / nullif(s1, 0), 0) * p1 + coalesce(v2 / nullif(s2, 0), 0) * p2 + coalesce(v3 / nullif(s3, 0), 0) * p3 AS trend FROM poly",
    "loess": f"SELECT {S}, doy, date, sum(w * v) / sum(w) AS trend FROM (SELECT *, greatest(0, 1 - (d / greatest(1e-9, reach * (1 + 1e-9))) ** 3) ** 3 AS w FROM (SELECT *, max(CASE WHEN k <= greatest(2, ceil(0.2e0 * n)) THEN d END) OVER (PARTITION BY {S}, doy, date) AS reach FROM (SELECT {S}, doy, a.date, b.value AS v, abs(a.year - b.year)::DOUBLE AS d, row_number() OVER (PARTITION BY {S}, doy, a.date ORDER BY abs(a.year - b.year)) AS k, count(*) OVER (PARTITION BY {S}, doy, a.date) AS n FROM scaled a JOIN scaled b USING ({S}, doy)))) GROUP BY ALL",
}


def _poly() -> str:
    """CTE poly: rows of scaled with orthogonal polynomials p1, p2, p3 of the year, their squares' sums and the sums of value times each.
    Squares that come from rounding alone, where a group has too few years, are 0."""
    over = f"OVER (PARTITION BY {S}, doy)"
    zero = lambda x, p: f"CASE WHEN sum({p} * {p}) {over} > 1e-6 THEN {x} ELSE 0 END"
    return (
        f"poly1_ AS (SELECT *, year - avg(year) {over} AS p1, avg(value) {over} AS v0, count(*) {over} AS n0 FROM scaled), "
        f"poly2_ AS (SELECT *, sum(p1 * p1) {over} AS s1, sum(value * p1) {over} AS v1, p1 * p1 - sum(p1 * p1) {over} / n0 - coalesce(sum(p1 * p1 * p1) {over} / nullif(sum(p1 * p1) {over}, 0), 0) * p1 AS p2 FROM poly1_), "
        f"poly3_ AS (SELECT *, {zero(f'sum(p2 * p2) {over}', 'p2')} AS s2, {zero(f'sum(value * p2) {over}', 'p2')} AS v2, p1 * p2 - {zero(f'sum(p1 * p2 * p2) {over} / nullif(sum(p2 * p2) {over}, 0)', 'p2')} * p2 - coalesce(sum(p1 * p1 * p2) {over} / nullif(s1, 0), 0) * p1 AS p3 FROM poly2_), "
        f"poly AS (SELECT *, {zero(f'sum(p3 * p3) {over}', 'p3')} AS s3, {zero(f'sum(value * p3) {over}', 'p3')} AS v3 FROM poly3_)"
    )


def dqm_sql() -> str:
    """CTEs as far as the quantile table of values without their means (nmap) and the scaled simulation (scaled)."""
    means = lambda n, k: f"{n}_mean AS (SELECT {k}, doy, avg(value) AS mean FROM {n}_pool GROUP BY {k}, doy)"
    return (
        f"{means('r', 'cell_id')}, {means('h', M)}, nobs AS (SELECT cell_id, date, doy, value - mean AS value FROM obs JOIN r_mean USING (cell_id, doy)), nhist AS (SELECT {M}, date, doy, value - mean AS value FROM hist JOIN h_mean USING ({M}, doy)), "
        f"{qmap_sql('-', 'nmap', 'nobs', 'nhist', 'n')}, scaled AS (SELECT {S}, date, year, doy, value + r.mean - h.mean AS value FROM later JOIN h_mean h USING ({M}, doy) JOIN r_mean r USING (cell_id, doy))"
    )


def trend_sql(kind: str) -> str:
    return TRENDS[kind].replace("{S}", S)


def dqm_out(kind: str) -> str:
    return f"t_{kind} AS ({trend_sql(kind)}), flat_{kind} AS (SELECT {S}, doy, date, value - trend AS value, trend FROM scaled JOIN t_{kind} USING ({S}, doy, date)), {eqm(f'flat_{kind}', f'm_{kind}', 'nmap', 'trend')}"


def obs(spark, sf):
    return series(spark, sf, "pr")


def hist(spark, sf):
    return simulations(spark, sf).where("scenario = 'historical'")


def later(spark, sf):
    return simulations(spark, sf).where("scenario = 'ssp585'")


def qmap(spark, sf, kind="+", per_cell=True):
    return bias.qdm_train(obs(spark, sf), hist(spark, sf), kind, NQ, W, per_cell)


OUT = ["model", "scenario", "cell_id", "date", "value"]


for _kind, _op, _cell in (("+", "-", True), ("*", "/", True), ("+", "-", False)):

    @query("b1_qdm_train" + {"+-True": "", "*/True": "_ratio", "+-False": "_pooled"}[f"{_kind}{_op}{_cell}"], sql(f"WITH {HIST}, {qmap_sql(_op)} SELECT {M}, doy, q_idx, round(ref_q, 6) AS ref_q, round(hist_q, 6) AS hist_q, round(af, 6) AS af FROM qmap", "dated", "simulations"))
    def _(spark, sf, kind=_kind, cell=_cell):
        return six(qmap(spark, sf, kind, cell).drop("q"), "ref_q", "hist_q", "af")


@query("b2_adapt_freq")
def _(spark, sf):
    return bias.adapt_freq(obs(spark, sf), hist(spark, sf), 20.0, W)


@query("b2_dry_excess", sql(f"WITH {HIST}, {pools('obs', 'r', 'cell_id')}, {pools('hist', 'h', M)}, x AS (SELECT cell_id, doy, count(CASE WHEN value < 30 THEN 1 END) / count(*)::DOUBLE AS rd, list_sort(list(value)) AS v FROM r_pool GROUP BY ALL), y AS (SELECT {M}, doy, count(CASE WHEN value < 30 THEN 1 END) / count(*)::DOUBLE AS hd FROM h_pool GROUP BY ALL) SELECT {M}, doy, round(rd, 6) AS rd, round(hd, 6) AS hd, greatest(30e0, v[least(len(v), floor(hd * len(v))::INT + 1)]) AS top FROM y JOIN x USING (cell_id, doy) WHERE hd > rd", "dated", "simulations"))
def _(spark, sf):
    return six(bias.dry_excess(obs(spark, sf), hist(spark, sf), 30.0, W), "rd", "hd")


@query("b3_qdm_adjust", sql(f"WITH {HIST}, {qmap_sql()}, {ranked('later', 'l')}, {adjusted('later', 'a', '+')} SELECT {S}, date, round(value, 6) AS value FROM a", "dated", "simulations"))
def _(spark, sf):
    return six(bias.qdm_adjust(qmap(spark, sf), later(spark, sf), "+", NQ, W), "value").select(*OUT)


@query("b4_eqm_adjust", sql(f"WITH {HIST}, {qmap_sql()}, {eqm('later', 'a')} SELECT {S}, date, round(value, 6) AS value FROM a", "dated", "simulations"))
def _(spark, sf):
    return six(bias.eqm_adjust(qmap(spark, sf), later(spark, sf)), "value").select(*OUT)


@query("b5_dqm_adjust", sql(f"WITH {HIST}, {qmap_sql()}, {dqm_sql()}, {dqm_out('mean')} SELECT {S}, date, value + trend AS value FROM m_mean", "dated", "simulations"))
def _(spark, sf):
    return bias.dqm_adjust(obs(spark, sf), hist(spark, sf), later(spark, sf), "+", NQ, W, "mean").select(*OUT)


for _trend in TRENDS:

    @query(f"b6_detrend_{_trend}", sql(f"WITH scaled AS (SELECT * FROM simulations WHERE doy IS NOT NULL), {_poly()}, t AS ({trend_sql(_trend)}) SELECT {S}, date, trend FROM t", "simulations"))
    def _(spark, sf, trend=_trend):
        return bias.detrend(simulations(spark, sf).where("doy is not null"), trend).select(*OUT[:-1], "trend")


@query("b7_qplad", sql(f"WITH later AS (SELECT * FROM members WHERE scenario = 'ssp585'), both_ AS (SELECT h.model, cell_id, date, h.doy, d.pr AS f, h.pr AS c FROM members h JOIN daily d USING (cell_id, date) WHERE h.scenario = 'historical'), ok AS (SELECT * FROM both_ WHERE f IS NOT NULL AND c IS NOT NULL), {pool_sql('both_', '(date, f, c)', W // 2, M)}, a AS (SELECT {M}, doy, row_number() OVER (PARTITION BY {M}, doy ORDER BY value[3], value[1]) - 1 AS rank, count(*) OVER (PARTITION BY {M}, doy) AS n, value[2] - value[3] AS af FROM pool WHERE value[2] IS NOT NULL AND value[3] IS NOT NULL), l_src AS (SELECT {S}, date, doy, pr AS value FROM later), {ranked('l_src', 'l')}, n AS (SELECT {M}, doy, max(n) AS n FROM a GROUP BY ALL), p AS (SELECT {S}, date, doy, value, least(n - 1, greatest(0, round(q * (n - 1)))) AS rank FROM l_src LEFT JOIN l_ranked USING ({S}, doy, value) LEFT JOIN n USING ({M}, doy)) SELECT {S}, date, value + af AS value FROM p LEFT JOIN a USING ({M}, doy, rank)", "members", "daily"))
def _(spark, sf):
    fine, coarse = series(spark, sf, "pr"), member(spark, sf, "pr").where("scenario = 'historical'")
    return bias.qplad_adjust(bias.qplad_train(fine, coarse, W), member(spark, sf, "pr").where("scenario = 'ssp585'"), W).select(*OUT)


_METHODS = " UNION ALL ".join([*(f"SELECT 'dqm_{t}' AS method, {S}, date, value + trend AS value FROM m_{t}" for t in TRENDS), f"SELECT 'qdm', {S}, date, value FROM a", f"SELECT 'qm', {S}, date, value FROM q"])


@query("b8_adjust_methods", sql(f"WITH {HIST}, {qmap_sql()}, {ranked('later', 'l')}, {adjusted('later', 'a', '+')}, {eqm('later', 'q')}, {dqm_sql()}, {_poly()}, {', '.join(map(dqm_out, TRENDS))} SELECT method, {S}, date, value FROM ({_METHODS})", "dated", "simulations"))
def _(spark, sf):
    return bias.adjust_methods(obs(spark, sf), hist(spark, sf), later(spark, sf), "+", NQ, W).select("method", *OUT)


_SWEEP = [(w, nq) for w in (W, 31) for nq in (NQ, 10)]


def _sweep() -> str:
    ctes = [f"{qmap_sql('-', f'qmap_{w}_{n}', tag=f'_{w}_{n}', window=w, nq=n)}, {ranked('later', f'l_{w}_{n}', window=w)}, {adjusted('later', f'a_{w}_{n}', '+', f'l_{w}_{n}_ranked', f'qmap_{w}_{n}', n)}" for w, n in _SWEEP]
    parts = " UNION ALL ".join(f'SELECT {w}::INT AS "window", {n}::INT AS nq, {S}, date, round(value, 6) AS value FROM a_{w}_{n}' for w, n in _SWEEP)
    return f"WITH {HIST}, {', '.join(ctes)} SELECT * FROM ({parts})"


@query("b9_param_sweep", sql(_sweep(), "dated", "simulations"))
def _(spark, sf):
    out = bias.param_sweep(obs(spark, sf), hist(spark, sf), later(spark, sf), "+", [W, 31], [NQ, 10])
    return six(out, "value").select("window", "nq", *OUT)


@query("b9_adapt_jitter_sweep")
def _(spark, sf):
    """Every adapt_freq threshold with every jitter threshold: random, so tests hold it against the operators one by one."""
    return bias.param_sweep(obs(spark, sf), hist(spark, sf), later(spark, sf), "+", [W], [NQ], (None, 20.0, 40.0), (None, 0.5)).select("adapt", "jitter", *OUT)


@query("b10_sweep_matrix", sql(f"{_sweep().split(' SELECT * FROM (')[0]}, d AS ({' UNION ALL '.join(f'SELECT {w} AS win, {n} AS nq, cell_id, doy, avg(value) AS m FROM a_{w}_{n} WHERE doy IS NOT NULL GROUP BY ALL' for w, n in _SWEEP)}), r AS (SELECT cell_id, doy, avg(pr) AS r FROM dated WHERE doy IS NOT NULL GROUP BY 1, 2) SELECT win::INT AS \"window\", round(max(CASE WHEN nq = {NQ} THEN abs(m - r) END), 5) AS \"{NQ}\", round(max(CASE WHEN nq = 10 THEN abs(m - r) END), 5) AS \"10\" FROM d JOIN r USING (cell_id, doy) GROUP BY 1", "dated", "simulations"))
def _(spark, sf):
    runs = bias.param_sweep(obs(spark, sf), hist(spark, sf), later(spark, sf), "+", [W, 31], [NQ, 10])
    out = bias.sweep_matrix(obs(spark, sf), runs, "window", "nq", [NQ, 10])
    return out.select("window", *(F.round(str(n), 5).alias(str(n)) for n in (NQ, 10)))


_FRAMES = f"y AS (SELECT DISTINCT year AS target FROM later), fr AS (SELECT model, scenario, cell_id * 10000 + target AS cell_id, date, year, doy, value, target FROM later, y WHERE date BETWEEN make_date(target - 1, 1, 1) - {W // 2} AND make_date(target + 1, 12, 31) + {W // 2})"


@query("b11_sliding_year_adjust", sql(f"WITH {HIST}, {qmap_sql()}, {_FRAMES}, {ranked('fr', 'l')} SELECT f.model, f.scenario, f.cell_id // 10000 AS cell_id, f.date, round(f.value + m.af, 6) AS value FROM fr f LEFT JOIN l_ranked r USING ({S}, doy, value) LEFT JOIN qmap m ON m.model = f.model AND m.cell_id = f.cell_id // 10000 AND m.doy = f.doy AND m.q_idx = {node('r.q')} WHERE f.year = f.target", "dated", "simulations"))
def _(spark, sf):
    return six(bias.sliding_year_adjust(qmap(spark, sf), later(spark, sf), "+", NQ, W, 1), "value").select(*OUT)


@query("b12_adjust_pipeline", sql(f"WITH {HIST}, {qmap_sql('/')}, {ranked('later', 'l')}, {adjusted('later', 'a', '*')} SELECT {S}, date, round(CASE WHEN value < 0 THEN 0 WHEN value > 80 THEN 80 ELSE value END, 6) AS value FROM a", "dated", "simulations"))
def _(spark, sf):
    return six(bias.adjust_pipeline(qmap(spark, sf, "*"), later(spark, sf), "*", 0.0, 80.0, NQ, W), "value").select(*OUT)


@query("b13_validate_qmap", sql(f"WITH {HIST}, {qmap_sql()} SELECT {M}, count(*) AS n_quantiles, count(af) > 0 AS ok FROM qmap GROUP BY ALL", "dated", "simulations"))
def _(spark, sf):
    return bias.validate_qmap(qmap(spark, sf))
