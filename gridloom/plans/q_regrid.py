"""Queries of regridding."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalar import Albers
from ..operators import curvilinear, regrid
from .catalogue import query
from .inputs import BIG_DST, daily, grid, grids, member, series, sites, sql, table
from .q_select import six

KM = "2 * 6371e0 * asin(sqrt(least(1e0, pow(sin(radians(s.lat - d.lat) / 2), 2) + cos(radians(d.lat)) * cos(radians(s.lat)) * pow(sin(radians(s.lon - d.lon) / 2), 2))))"
#: A destination of 4 x 4 cells inside the source, as a CTE and as a table.
DST = "dst AS (SELECT (4 * i + j)::BIGINT AS cell_id, i::INT AS iy, j::INT AS ix, 52e0 + i * 5.5e0 AS lat, -168e0 + j * 11.25e0 AS lon FROM range(4) a(i), range(4) b(j))"
AXIS_Y = "ay AS (SELECT lat AS v, iy AS i, lead(lat) OVER (ORDER BY lat) AS v2, lead(iy) OVER (ORDER BY lat) AS i2 FROM (SELECT DISTINCT lat, iy FROM grid))"
AXIS_X = AXIS_Y.replace("ay AS", "ax AS").replace("lat", "lon").replace("iy", "ix")
BILINEAR = (
    f"{DST}, {AXIS_Y}, {AXIS_X}, "
    "ly AS (SELECT t, unnest([i, i2]) AS iy, unnest([1 - f, f]) AS wy FROM (SELECT t, i, i2, (t - v) / (v2 - v) AS f FROM (SELECT DISTINCT lat AS t FROM dst), ay WHERE t BETWEEN v AND v2)), "
    "lx AS (SELECT t, unnest([i, i2]) AS ix, unnest([1 - f, f]) AS wx FROM (SELECT t, i, i2, (t - v) / (v2 - v) AS f FROM (SELECT DISTINCT lon AS t FROM dst), ax WHERE t BETWEEN v AND v2)), "
    "w AS (SELECT DISTINCT g.cell_id AS src_cell, dst.cell_id AS dst_cell, wy * wx AS w FROM dst JOIN ly ON ly.t = dst.lat JOIN lx ON lx.t = dst.lon JOIN grid g ON g.iy = ly.iy AND g.ix = lx.ix WHERE wy > 0 AND wx > 0)"
)
BOUNDS = "{0} AS (SELECT v, i, coalesce((lag(v) OVER o + v) / 2, v - (lead(v) OVER o - v) / 2) AS lo, coalesce((v + lead(v) OVER o) / 2, v + (v - lag(v) OVER o) / 2) AS hi FROM (SELECT DISTINCT {1} AS v, {2} AS i FROM {3}) WINDOW o AS (ORDER BY v))"
CONSERVATIVE = (
    f"{DST}, " + ", ".join(BOUNDS.format(*b) for b in (("sy", "lat", "iy", "grid"), ("sx", "lon", "ix", "grid"), ("dy", "lat", "iy", "dst"), ("dx", "lon", "ix", "dst")))
    + ", py AS (SELECT dy.v AS t, sy.i AS iy, (sin(radians(least(sy.hi, dy.hi))) - sin(radians(greatest(sy.lo, dy.lo)))) / (sin(radians(dy.hi)) - sin(radians(dy.lo))) AS wy FROM dy JOIN sy ON least(sy.hi, dy.hi) > greatest(sy.lo, dy.lo))"
    + ", px AS (SELECT dx.v AS t, sx.i AS ix, (least(sx.hi, dx.hi) - greatest(sx.lo, dx.lo)) / (dx.hi - dx.lo) AS wx FROM dx JOIN sx ON least(sx.hi, dx.hi) > greatest(sx.lo, dx.lo))"
    + ", w AS (SELECT g.cell_id AS src_cell, dst.cell_id AS dst_cell, wy * wx AS w FROM dst JOIN py ON py.t = dst.lat JOIN px ON px.t = dst.lon JOIN grid g ON g.iy = py.iy AND g.ix = px.ix)"
)
NEAREST = f"w AS (SELECT arg_min(s.cell_id, (round({KM}, 6), s.cell_id)) AS src_cell, d.cell_id AS dst_cell, 1e0 AS w FROM site_targets d, grid s GROUP BY d.cell_id)"


def dst(spark):
    at = F.col("id")
    iy, ix = F.floor(at / 4).cast("int"), (at % 4).cast("int")
    return spark.range(16).select(F.col("id").alias("cell_id"), iy.alias("iy"), ix.alias("ix"), (52.0 + iy * 5.5).alias("lat"), (-168.0 + ix * 11.25).alias("lon"))


@query("r1_weights_nearest", sql(f"SELECT arg_min(s.cell_id, (round({KM}, 6), s.cell_id)) AS src_cell, d.cell_id AS dst_cell, 1e0 AS w FROM site_targets d, sites s GROUP BY d.cell_id", "sites", "site_targets"))
def _(spark, sf):
    return regrid.weights_nearest(*sites(spark, sf))


@query("r2_weights_nearest_d2s", sql(f"WITH b AS (SELECT s.cell_id AS src_cell, arg_min(d.cell_id, (round({KM}, 6), d.cell_id)) AS dst_cell FROM site_targets d, sites s GROUP BY 1) SELECT src_cell, dst_cell, round(1e0 / count(*) OVER (PARTITION BY dst_cell), 9) AS w FROM b", "sites", "site_targets"))
def _(spark, sf):
    return regrid.weights_nearest_d2s(*sites(spark, sf)).withColumn("w", F.round("w", 9))


@query("r3_weights_bilinear", sql(f"WITH {BILINEAR.replace(DST, BIG_DST)} SELECT src_cell, dst_cell, round(w, 9) AS w FROM w", "big_grid"))
def _(spark, sf):
    return regrid.weights_bilinear(*grids(spark, sf)).withColumn("w", F.round("w", 9))


@query("r4_weights_conservative", sql(f"WITH {CONSERVATIVE.replace(DST, BIG_DST)} SELECT src_cell, dst_cell, round(w, 9) AS w FROM w", "big_grid"))
def _(spark, sf):
    return regrid.weights_conservative(*grids(spark, sf)).withColumn("w", F.round("w", 9))


MS = "model, scenario"
def _curved_sql() -> str:
    """Inverse bilinear weights of every destination in every square, by the same equations; the first square that holds it counts."""
    place = lambda lat, lon: (f"cos(radians({lat})) * cos(radians({lon}))", f"cos(radians({lat})) * sin(radians({lon}))", f"sin(radians({lat}))")
    xyz = ", ".join(f"{e} AS {a}" for e, a in zip(place("lat2", "lon2"), "xyz"))
    sides = (("x", "-sin(b)", "cos(b)", "0"), ("y", "-sin(a) * cos(b)", "-sin(a) * sin(b)", "cos(a)"), ("d", "cos(a) * cos(b)", "cos(a) * sin(b)", "sin(a)"))
    seen = ", ".join(f"c{k}.x * ({e}) + c{k}.y * ({n}) + c{k}.z * ({u}) AS {name}{k}" for k in range(4) for name, e, n, u in sides)
    lines = ", ".join(f"-{c}0 AS h{c}, {c}1 - {c}0 AS e{c}, {c}3 - {c}0 AS f{c}, {c}0 - {c}1 + {c}2 - {c}3 AS g{c}" for c in "xy")
    unit = lambda v: f"least(1e0, greatest(0e0, {v}))"
    w = [f"(1 - {unit('s')}) * (1 - {unit('r')})", f"{unit('s')} * (1 - {unit('r')})", f"{unit('s')} * {unit('r')}", f"(1 - {unit('s')}) * {unit('r')}"]
    return (
        f"v AS (SELECT cell_id, iy, ix, {xyz} FROM (SELECT cell_id, iy, ix, lat + 2 * sin(radians(lon * 3)) AS lat2, lon + lat / 10 AS lon2 FROM grid)), "
        "sq AS (SELECT c0.iy, c0.ix, c0, c1, c2, c3 FROM v c0 JOIN v c1 ON c1.iy = c0.iy AND c1.ix = c0.ix + 1 JOIN v c2 ON c2.iy = c0.iy + 1 AND c2.ix = c0.ix + 1 JOIN v c3 ON c3.iy = c0.iy + 1 AND c3.ix = c0.ix), "
        f"q AS (SELECT p.cell_id AS dst_cell, iy, ix, c0.cell_id AS i0, c1.cell_id AS i1, c2.cell_id AS i2, c3.cell_id AS i3, {seen} FROM sq, (SELECT cell_id, radians(lat) AS a, radians(lon) AS b FROM dst) p), "
        f"l AS (SELECT *, {lines} FROM q WHERE greatest(d0, d1, d2, d3) > 0), k AS (SELECT *, gx * fy - gy * fx AS k2, ex * fy - ey * fx + hx * gy - hy * gx AS k1, hx * ey - hy * ex AS k0 FROM l), "
        "b AS (SELECT *, -(k1 + CASE WHEN k1 < 0 THEN -1 ELSE 1 END * sqrt(greatest(0e0, k1 * k1 - 4 * k0 * k2))) / 2 AS big FROM k WHERE k1 * k1 - 4 * k0 * k2 >= -1e-12 * (k1 * k1 + abs(4 * k0 * k2))), r AS (SELECT *, unnest([CASE WHEN big <> 0 THEN k0 / big END, CASE WHEN k2 <> 0 THEN big / k2 END]) AS r, unnest([1, 2]) AS n FROM b), "
        "s AS (SELECT *, CASE WHEN abs(ex + gx * r) > abs(ey + gy * r) THEN (hx - fx * r) / nullif(ex + gx * r, 0) ELSE (hy - fy * r) / nullif(ey + gy * r, 0) END AS s FROM r), "
        f"o AS (SELECT *, [{', '.join(w)}] AS w FROM s WHERE r BETWEEN -1e-9 AND 1 + 1e-9 AND s BETWEEN -1e-9 AND 1 + 1e-9), "
        "first AS (SELECT *, row_number() OVER (PARTITION BY dst_cell ORDER BY iy, ix, n) AS nth FROM o WHERE w[1] * d0 + w[2] * d1 + w[3] * d2 + w[4] * d3 > 0), u AS (SELECT dst_cell, unnest([i0, i1, i2, i3]) AS src_cell, unnest(w) AS w FROM first WHERE nth = 1)"
    )


@query("r3_curvilinear", sql(f"WITH {BIG_DST}, {_curved_sql()} SELECT src_cell, dst_cell, round(w, 7) AS w FROM u WHERE w > 1e-12", "big_grid"))
def _(spark, sf):
    src, dst_ = grids(spark, sf)
    bent = src.withColumns({"lat": F.col("lat") + 2 * F.sin(F.radians(F.col("lon") * 3)), "lon": F.col("lon") + F.col("lat") / 10})
    return curvilinear.weights_bilinear_curved(bent, dst_).withColumn("w", F.round("w", 7))


@query("r4_projected_cells")
def _(spark, sf):
    """Areas on planes that touch each destination have no SQL; tests hold them against arithmetic and conserved totals."""
    src, dst_ = grids(spark, sf)
    flat = lambda df, step: df.select("cell_id", "iy", "ix", (F.col("ix") * step - 1.2e6).alias("px"), (F.col("iy") * step + 4e5).alias("py"))
    return curvilinear.weights_conservative_cells(curvilinear.projected_cells(flat(src, 5e4)), curvilinear.projected_cells(flat(dst_, 1.1e5)))


APPLY = f"s AS (SELECT {MS}, dst_cell, date, count(pr) AS have, sum(w * pr) AS value FROM members JOIN w ON members.cell_id = w.src_cell GROUP BY ALL), need AS (SELECT dst_cell, count(*) AS need FROM w GROUP BY 1)"


@query("r5_apply_regrid", sql(f"WITH {BILINEAR}, {APPLY} SELECT {MS}, d.cell_id, t.date, round(CASE WHEN have = need THEN value END, 6) AS value FROM dst d CROSS JOIN (SELECT DISTINCT {MS}, date FROM members) t LEFT JOIN s ON s.dst_cell = d.cell_id AND s.date = t.date AND s.model = t.model AND s.scenario = t.scenario LEFT JOIN need ON need.dst_cell = d.cell_id", "members", "grid").replace("SELECT model, scenario, d.cell_id", "SELECT t.model, t.scenario, d.cell_id"))
def _(spark, sf):
    pr = member(spark, sf, "pr").select("model", "scenario", "cell_id", "date", "value")
    return six(regrid.apply_regrid(pr, regrid.weights_bilinear(grid(spark, sf), dst(spark)), dst(spark)), "value")


@query("j8_apply_weights", sql(f"WITH {CONSERVATIVE}, {APPLY} SELECT {MS}, s.dst_cell AS cell_id, s.date, round(CASE WHEN have = need THEN value END, 6) AS value FROM s JOIN need USING (dst_cell)", "members", "grid"))
def _(spark, sf):
    pr = member(spark, sf, "pr").select("model", "scenario", "cell_id", "date", "value")
    return six(regrid.apply_weights(pr, regrid.weights_conservative(grid(spark, sf), dst(spark))), "value")


@query("r6_cascade", sql(f"WITH {BILINEAR.replace(DST, BIG_DST)}, n AS (SELECT arg_min(s.cell_id, (round({KM}, 6), s.cell_id)) AS mid, d.cell_id AS dst_cell FROM site_targets d, dst s GROUP BY d.cell_id) SELECT src_cell, n.dst_cell, round(sum(w), 9) AS w FROM w JOIN n ON n.mid = w.dst_cell GROUP BY 1, 2", "big_grid", "site_targets"))
def _(spark, sf):
    src, mid = grids(spark, sf)
    return regrid.cascade(regrid.weights_bilinear(src, mid), regrid.weights_nearest(mid, sites(spark, sf)[1])).withColumn("w", F.round("w", 9))


@query("r7_make_latlon_grid", sql("SELECT m.lat AS lat, m.lon AS lon, d.cell_id AS nearest_row, d.lat = m.lat AS same_lat FROM (SELECT 50e0 + i * (25e0 / 10) AS lat, -170e0 + j * (40e0 / 16) AS lon FROM range(11) a(i), range(17) b(j)) m JOIN grid d ON d.lat = m.lat AND d.lon = m.lon", "grid"))
def _(spark, sf):
    m = regrid.make_latlon_grid(spark, -170.0, 50.0, -130.0, 75.0, 2.5).select("lat", "lon")
    return m.join(grid(spark, sf).select(F.col("cell_id").alias("nearest_row"), "lat", "lon"), ["lat", "lon"]).withColumn("same_lat", F.lit(True))


@query("r8_refine_grid", sql("WITH y AS (SELECT lat, row_number() OVER (ORDER BY lat) - 1 AS k, lead(lat) OVER (ORDER BY lat) AS b FROM (SELECT DISTINCT lat FROM grid)), x AS (SELECT lon, row_number() OVER (ORDER BY lon) - 1 AS k, lead(lon) OVER (ORDER BY lon) AS b FROM (SELECT DISTINCT lon FROM grid)), fy AS (SELECT 2 * k AS iy, lat FROM y UNION ALL SELECT 2 * k + 1, (lat + b) / 2 FROM y WHERE b IS NOT NULL), fx AS (SELECT 2 * k AS ix, lon FROM x UNION ALL SELECT 2 * k + 1, (lon + b) / 2 FROM x WHERE b IS NOT NULL) SELECT (iy * (SELECT count(*) FROM fx) + ix)::BIGINT AS cell_id, lat, lon FROM fy, fx", "big_grid"))
def _(spark, sf):
    return regrid.refine_grid(grids(spark, sf)[0]).select(F.col("cell_id").cast("long").alias("cell_id"), "lat", "lon")


def _albers_sql() -> str:
    p = Albers()
    e2 = 0.0066943800229
    e = e2**0.5
    q = f"((1 - {e2}) * (sin(radians(lat)) / (1 - {e2}e0 * sin(radians(lat)) * sin(radians(lat))) - ln((1 - {e!r}e0 * sin(radians(lat))) / (1 + {e!r}e0 * sin(radians(lat)))) / {2 * e!r}e0))".replace("e0e0", "e0")
    return f"pq AS (SELECT cell_id, lat, lon, 6378137e0 * sqrt({p.c!r}e0 - {p.n!r}e0 * {q}) / {p.n!r}e0 AS rho, {p.n!r}e0 * radians(lon + 154e0) AS theta FROM grid), p AS (SELECT cell_id, lat, lon, rho * sin(theta) AS px, {p.rho0!r}e0 - rho * cos(theta) AS py FROM pq)"


@query("e12_project", sql(f"WITH {_albers_sql()} SELECT cell_id, round(px, 3) AS px, round(py, 3) AS py FROM p", "grid"))
def _(spark, sf):
    return regrid.project(grid(spark, sf)).select("cell_id", F.round("px", 3).alias("px"), F.round("py", 3).alias("py"))


@query("e12_unproject", sql("SELECT cell_id, round(lat, 6) AS lat, round(lon, 6) AS lon FROM grid", "grid"))
def _(spark, sf):
    return six(regrid.unproject(regrid.project(grid(spark, sf)).drop("lat", "lon")).select("cell_id", "lat", "lon"), "lat", "lon")


@query("e13_wrf_xy", sql("WITH c AS (SELECT max(ix) AS mx, max(iy) AS my, avg(lat) AS clat, avg(lon) AS clon FROM grid), k AS (SELECT *, 6370000e0 * (1 + sin(radians(64e0))) * tan(pi() / 4 - radians(clat) / 2) AS rho FROM c) SELECT cell_id, round(rho * sin(radians(clon + 152)) + (ix - mx / 2e0) * 4000, 3) AS wx, round(-rho * cos(radians(clon + 152)) + (iy - my / 2e0) * 4000, 3) AS wy FROM grid, k", "grid"))
def _(spark, sf):
    return regrid.wrf_xy(grid(spark, sf)).select("cell_id", F.round("wx", 3).alias("wx"), F.round("wy", 3).alias("wy"))


@query("r9_target_grid_from_slice", sql(f"WITH {_albers_sql()} SELECT p.cell_id, lat, lon, round(px, 3) AS px, round(py, 3) AS py FROM p JOIN (SELECT DISTINCT cell_id FROM daily WHERE date = (SELECT min(date) FROM daily)) f USING (cell_id)", "daily", "grid"))
def _(spark, sf):
    out = regrid.target_grid_from_slice(daily(spark, sf), grid(spark, sf))
    return out.withColumn("px", F.round("px", 3)).withColumn("py", F.round("py", 3))


@query("r10_reproject", sql("SELECT (cell_id + 100)::BIGINT AS cell_id, date, pr AS value FROM daily", "daily"))
def _(spark, sf):
    moved = regrid.project(grid(spark, sf)).select((F.col("cell_id") + 100).alias("cell_id"), (F.col("px") + 900.0).alias("px"), (F.col("py") - 700.0).alias("py"))
    return regrid.reproject(series(spark, sf, "pr").select("cell_id", "date", "value"), grid(spark, sf), moved)


#: Supplier places on a fifty-column polar plane that has a cell per customer: 80 km wide, as high as 2800 km allow.
_WARP = (
    "p AS (SELECT s_suppkey::BIGINT AS dst_cell, 50 + (s_suppkey * 6151) % 2500 / 100e0 AS lat, (s_suppkey * 98317) % 6000 / 100e0 - 180 AS lon FROM supplier), "
    "n AS (SELECT max(c_custkey) // 50 + 1 AS ny FROM customer), "
    "q AS (SELECT dst_cell, 6370000e0 * (1 + sin(radians(64e0))) * tan(pi() / 4 - radians(lat) / 2) AS rho, radians(lon + 152) AS theta FROM p), "
    "i AS (SELECT dst_cell, ny, floor((rho * sin(theta) + 2e6) / 8e4 + 0.5)::BIGINT AS ix, floor((4.4e6 - rho * cos(theta)) / (2.8e6 / ny) + 0.5)::BIGINT AS iy FROM q, n)"
)


@query("r10_warp", sql(f"WITH {_WARP} SELECT iy * 50 + ix AS src_cell, dst_cell, 1e0 AS w FROM i WHERE ix BETWEEN 0 AND 49 AND iy BETWEEN 0 AND ny - 1", "grid"))
def _(spark, sf):
    rows = grids(spark, sf)[0].agg(F.max("iy") + 1).first()[0]
    j = F.col("s_suppkey")
    places = table(spark, sf, "supplier").select(j.cast("long").alias("cell_id"), (50 + (j * 6151) % 2500 / 100).alias("lat"), ((j * 98317) % 6000 / 100 - 180).alias("lon"))
    return regrid.weights_warp(regrid.Axes(-2e6, -4.4e6, 8e4, 2.8e6 / rows, 50, rows), regrid.project(places).select("cell_id", "px", "py"))


@query("r11_mosaic", sql("SELECT cell_id, lat, lon FROM grid", "grid"))
def _(spark, sf):
    g = grid(spark, sf).select("cell_id", "lat", "lon")
    return regrid.mosaic(g.where("lon < -150"), g.where("lon >= -150").withColumn("lon", F.col("lon") + 360))


@query("r12_is_periodic", sql("SELECT true AS ascending, max(lon) - min(lon) AS span, 10e0 AS step, abs(max(lon) - min(lon) + 10 - 360) < 1e-6 AS periodic FROM grid", "grid"))
def _(spark, sf):
    return regrid.is_periodic(grid(spark, sf))


def _land(spark, sf):
    return grid(spark, sf).select("cell_id", (25.0 * F.col("region") - 25).alias("sftlf"))


@query("r13_landmask", sql(f"WITH {NEAREST} SELECT w.dst_cell AS cell_id, 25e0 * region - 25 > 0 AS is_land FROM w JOIN grid g ON g.cell_id = w.src_cell", "grid", "site_targets"))
def _(spark, sf):
    return regrid.landmask(_land(spark, sf), regrid.weights_nearest(grid(spark, sf), sites(spark, sf)[1]))


@query("r14_prep_landsea", sql(f"WITH {BILINEAR}, sl AS (SELECT cell_id FROM grid WHERE region > 1), dl AS (SELECT cell_id FROM dst WHERE cell_id % 3 <> 0), l AS (SELECT * FROM w WHERE src_cell IN (FROM sl) AND dst_cell IN (FROM dl)), a AS (SELECT dst_cell, sum(w) AS whole FROM w GROUP BY 1), p AS (SELECT dst_cell, sum(w) AS part FROM l GROUP BY 1) SELECT src_cell, dst_cell, round(w * whole / part, 9) AS w FROM l JOIN a USING (dst_cell) JOIN p USING (dst_cell)", "grid"))
def _(spark, sf):
    w = regrid.weights_bilinear(grid(spark, sf), dst(spark))
    dl = dst(spark).select("cell_id", (F.col("cell_id") % 3 != 0).alias("is_land"))
    return regrid.prep_landsea(w, regrid.landmask(_land(spark, sf)), dl).withColumn("w", F.round("w", 9))


@query("r14_source_mask", sql(f"WITH f AS (SELECT {MS}, cell_id, arg_min_null(v, date) IS NOT NULL AS own FROM (SELECT {MS}, cell_id, date, CASE WHEN pr <= 10 THEN pr END AS v FROM members) GROUP BY ALL), g AS (SELECT {MS}, abs(avg((NOT own)::INT::DOUBLE) - avg((region <= 1)::INT::DOUBLE)) < 0.2e0 AS good FROM f JOIN grid USING (cell_id) GROUP BY ALL) SELECT {MS}, cell_id, CASE WHEN good THEN own ELSE region > 1 END AS is_land FROM f JOIN grid USING (cell_id) JOIN g USING ({MS})", "members", "grid"))
def _(spark, sf):
    pr = member(spark, sf, "pr").withColumn("value", F.when(F.col("value") <= 10, F.col("value")))
    return regrid.source_mask(pr, regrid.landmask(_land(spark, sf)))


@query("r15_order_axes", sql("SELECT date, cell_id, row_number() OVER (PARTITION BY date ORDER BY lon, lat DESC) - 1 AS place FROM daily JOIN grid USING (cell_id)", "daily", "grid"))
def _(spark, sf):
    return regrid.order_axes(daily(spark, sf), grid(spark, sf)).select("date", "cell_id", F.col("place").cast("long").alias("place"))


def _measures(source: str, name: str) -> str:
    return " UNION ALL ".join(f"SELECT '{a}' AS axis, unnest(['size', 'min', 'max', 'step']) AS measure, unnest([count(DISTINCT {a})::DOUBLE, min({a}), max({a}), (max({a}) - min({a})) / (count(DISTINCT {a}) - 1)]) AS {name} FROM {source}" for a in ("lat", "lon"))


@query("r16_grid_compare", sql(f"WITH {BIG_DST}, a AS ({_measures('grid', 'a')}), b AS ({_measures('dst', 'b')}) SELECT axis, measure, round(a, 6) AS a, round(b, 6) AS b, abs(a - b) < 0.01e0 AS same FROM a JOIN b USING (axis, measure)", "big_grid"))
def _(spark, sf):
    return six(regrid.grid_compare(*grids(spark, sf)), "a", "b")


@query("r17_bbox_of", sql("SELECT region, min(lon) AS west, min(lat) AS south, max(lon) AS east, max(lat) AS north FROM grid GROUP BY 1", "grid"))
def _(spark, sf):
    return regrid.bbox_of(grid(spark, sf), ["region"])


@query("r17_index_bbox", sql("SELECT min(ix) AS ix_min, max(ix) AS ix_max, min(iy) AS iy_min, max(iy) AS iy_max FROM grid WHERE lat BETWEEN 54 AND 66 AND lon BETWEEN -165 AND -141", "grid"))
def _(spark, sf):
    g = grid(spark, sf).withColumn("lon", F.col("lon") + 360)
    return regrid.index_bbox(g, -165, 54, -141, 66, 360)
