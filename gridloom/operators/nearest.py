"""The nearest cell by great circle, for any grids and any distances.

Cells are points of the unit sphere in cubes of halving sides. A point first meets the cells of its own cube, of a level at which cubes hold a few, and of those around
it: a cell found within a cube's side is the nearest, as all cells so near lie in these cubes. Points with none so near, far from all cells, search on in a tree that begins with
the cube of the whole sphere and goes down two levels a round: of a point's cubes those stay whose least distance is within the greatest distance to the farthest corner of
some other one, so the cube of the nearest cell is never left out, wherever it lies. They meet the cells of their last cubes alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import haversine_km
from ..functions.shared import written

_DEEPEST = 18
#: Kilometres of a radian, and what is left to rounding (some 6 mm), as ties are to a millimetre.
_RADIUS, _ROOM = 6371.0, 1e-9


def _place(lat: Column, lon: Column) -> list[Column]:
    return [F.cos(F.radians(lat)) * F.cos(F.radians(lon)), F.cos(F.radians(lat)) * F.sin(F.radians(lon)), F.sin(F.radians(lat))]


def _cube(place: list[Column], level: int) -> list[Column]:
    """The cube's number along each axis: 2 ** level cubes from -1 to 1."""
    return [F.least(F.lit(2**level - 1), F.floor((v + 1) * 2.0 ** (level - 1)).cast("int")) for v in place]


def _code(cube: list[Column]) -> Column:
    x, y, z = (c.cast("long") for c in cube)
    return F.shiftleft(x, 40).bitwiseOR(F.shiftleft(y, 20)).bitwiseOR(z)


def _depth(cells: DataFrame) -> int:
    """The level at which cubes hold eight cells or fewer on average."""
    levels = range(2, _DEEPEST + 1, 2)
    found = cells.agg(F.count("*"), *(F.approx_count_distinct(_code(_cube(_place(F.col("lat"), F.col("lon")), k))) for k in levels)).first()
    return next((k for k, n in zip(levels, found[1:]) if 8 * n >= found[0]), _DEEPEST)


def _around(cells: DataFrame, points: DataFrame, key: str, level: int) -> DataFrame:
    """key, lat, lon, cell_id, km of points: the nearest cell in a point's cube and the 26 around it, null where these are empty. A row a point and place."""
    place = _place(F.col("lat"), F.col("lon"))
    # Cubes are counted from 1 here, so that those beyond the sphere's box have codes of their own.
    own = cells.select("cell_id", F.col("lat").alias("clat"), F.col("lon").alias("clon"), *(c.alias(n) for c, n in zip(_cube(place, level), "xyz")))
    for n in "xyz":
        own = own.withColumn(n, F.explode(F.sequence(F.col(n), F.col(n) + 2)))
    own = own.select("cell_id", "clat", "clon", _code([F.col(n) for n in "xyz"]).alias("cube"))
    both = points.select(key, "lat", "lon", _code([c + 1 for c in _cube(place, level)]).alias("cube")).join(own.hint("merge"), "cube", "left")
    return _nearest(both, key, "lat", "lon")


def _nearest(both: DataFrame, *keys: str) -> DataFrame:
    """The nearest cell of pairs (keys, lat, lon, cell_id, clat, clon), ties to the smaller one."""
    km = F.when(F.col("cell_id").isNotNull(), haversine_km(F.col("lat"), F.col("lon"), F.col("clat"), F.col("clon")))
    found = both.withColumn("km", km).groupBy(*keys).agg(F.min_by("cell_id", F.when(F.col("km").isNotNull(), F.struct(F.round("km", 6), "cell_id"))).alias("cell_id"), F.min("km").alias("km"))
    return found


def nearest_cells(cells: DataFrame, points: DataFrame, key: str) -> DataFrame:
    """key, cell_id, km: the nearest of cells(cell_id, lat, lon) to each of points(key, lat, lon); ties (to a millimetre) go to the smaller cell.

    Points and cells without coordinates have and are no neighbour; a key that comes twice has the nearer cell of both. No cells: no rows.
    """
    there = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    cells, points = cells.select("cell_id", "lat", "lon").where(there), points.select(key, "lat", "lon").where(there)
    depth = _depth(cells)
    first = written(_around(cells, points, key, depth), "near")
    side = 2.0 ** (1 - depth)
    # The straight way to a cell, in radii, is no longer than a cube's side: nothing outside the 27 cubes is nearer.
    settled = F.coalesce(2 * F.sin(F.col("km") / (2 * _RADIUS)) + _ROOM < side, F.lit(False))
    far = first.where(~settled).select(key, "lat", "lon")
    out = first.where(settled).select(key, "cell_id", "km")
    if not far.isEmpty():
        out = out.unionByName(_down_the_tree(cells, far, key, depth))
    return out.groupBy(key).agg(F.min_by("cell_id", F.struct(F.round("km", 6), "cell_id")).alias("cell_id"), F.min("km").alias("km"))


def _down_the_tree(cells: DataFrame, points: DataFrame, key: str, depth: int) -> DataFrame:
    """key, cell_id, km of points wherever they lie."""
    now = points.select(key, "lat", "lon", F.lit(0).cast("long").alias("cube"))
    place = _place(F.col("lat"), F.col("lon"))
    for level in range(2, depth + 1, 2):
        inside = _cube(place, level)
        held = cells.select(_code(_cube(place, level - 2)).alias("cube"), _code(inside).alias("child"), *(c.alias(n) for c, n in zip(inside, "xyz"))).distinct()
        side = 2.0 ** (1 - level)
        # 4096 cubes at most as far as level 4.
        both = now.join(F.broadcast(held) if level <= 4 else held, "cube")
        away = [F.abs(v - ((F.col(n) + 0.5) * side - 1)) for v, n in zip(place, "xyz")]
        least = sum((F.greatest(F.lit(0.0), a - side / 2) * F.greatest(F.lit(0.0), a - side / 2) for a in away), F.lit(0.0))
        most = sum(((a + side / 2) * (a + side / 2) for a in away), F.lit(0.0))
        reached = both.groupBy(key, "lat", "lon").agg(F.min(most).alias("most"), F.collect_list(F.struct(least.alias("least"), "child")).alias("near"))
        now = reached.select(key, "lat", "lon", F.explode(F.filter("near", lambda c: c["least"] <= F.col("most") + 1e-9)["child"]).alias("cube"))
    own = cells.select("cell_id", F.col("lat").alias("clat"), F.col("lon").alias("clon"), _code(_cube(place, depth)).alias("cube"))
    return _nearest(now.join(own, "cube"), key)
