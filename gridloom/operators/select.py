"""Projections, filters and predicates over fields and grids."""

from __future__ import annotations

import operator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .nearest import nearest_cells
from .windows import common_keys, series_keys

COMPARE = {">": operator.gt, "<": operator.lt, ">=": operator.ge, "<=": operator.le, "==": operator.eq, "!=": operator.ne}


def rename_variable(df: DataFrame, names: dict[str, str], col: str = "variable") -> DataFrame:
    """Variable names by a mapping; names outside it stay."""
    pairs = F.create_map(*(F.lit(x) for kv in names.items() for x in kv))
    return df.withColumn(col, F.coalesce(pairs[F.col(col)], F.col(col)))


def select_variables(df: DataFrame, keep: list[str], col: str = "variable") -> DataFrame:
    return df.where(F.col(col).isin(keep))


def drop_aux_columns(df: DataFrame, dims: list[str], keep: list[str] = ()) -> DataFrame:
    """Only the dimension columns, value, and what is asked for."""
    return df.select(*[c for c in df.columns if c in {*dims, *keep, "value"}])


def sel_time(df: DataFrame, start: str, end: str, col: str = "date") -> DataFrame:
    """Closed date range."""
    return df.where(F.col(col).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def check_bbox(west: float, south: float, east: float, north: float) -> None:
    if not (-180 <= west <= 180 and -180 <= east <= 180):
        raise ValueError("longitudes must lie in -180..180")
    if not (-90 <= south <= 90 and -90 <= north <= 90):
        raise ValueError("latitudes must lie in -90..90")


def sel_bbox_latlon(grid: DataFrame, west: float, south: float, east: float, north: float) -> DataFrame:
    check_bbox(west, south, east, north)
    return grid.where(F.col("lat").between(south, north) & F.col("lon").between(west, east))


def sel_bbox_xy(grid: DataFrame, x1: int, y1: int, x2: int, y2: int) -> DataFrame:
    if x1 > x2 or y1 > y2:
        raise ValueError("an index box runs from its least corner to its greatest")
    return grid.where(F.col("iy").between(y1, y2) & F.col("ix").between(x1, x2))


def orient_bbox(west: float, south: float, east: float, north: float) -> list[tuple[float, float, float, float]]:
    """The box on a 0..360 axis: one box, or two where it crosses the prime meridian."""
    south, north = min(south, north), max(south, north)
    if west < 0 <= east:
        return [(0, south, east, north), (west % 360, south, 359.9, north)]
    return [(west % 360 if west < 0 else west, south, east % 360 if east < 0 else east, north)]


def in_boxes(grid: DataFrame, boxes: list[tuple[float, float, float, float]], lon: Column) -> DataFrame:
    hit = F.lit(False)
    for w, s, e, n in boxes:
        hit = hit | (lon.between(w, e) & F.col("lat").between(s, n))
    return grid.where(hit)


def sel_months(df: DataFrame, months: list[int]) -> DataFrame:
    return df.where(F.col("month").isin(months))


def sel_doys_around(df: DataFrame, centres: DataFrame, half: int = 15) -> DataFrame:
    """Days [d - half, d + half) around the centre day d of each series, without wrapping; centres without models serve them all."""
    return df.join(centres, common_keys(df, centres)).where((F.col("doy") >= F.col("centre") - half) & (F.col("doy") < F.col("centre") + half))


def where_condition(df: DataFrame, op: str, value: float, col: str = "value") -> DataFrame:
    return df.where(COMPARE[op](F.col(col), value))


def no_data_cells(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """keys (the series, unless others are given) and masked: the value at their first time is null."""
    return df.groupBy(*(keys or series_keys(df))).agg(F.min_by(F.struct("value"), "date")["value"].isNull().alias("masked"))


def mask_first_slice(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Null out every value of a series that has none at its first time."""
    return df.join(no_data_cells(df, keys), keys or series_keys(df)).withColumn("value", F.when(~F.col("masked"), F.col("value"))).drop("masked")


def sel_regions(df: DataFrame, boxes: DataFrame) -> DataFrame:
    """Rows of grid cells in named x/y boxes: boxes(region, x1, x2, y1, y2).

    A box's class is the power of two next above its longer side, so it lies in four squares of that side at most, however different the boxes are. Cells go
    into a square of each class that a box has: sixty classes or so at most, and one collected row.
    """
    boxes = boxes.where("x1 <= x2 and y1 <= y2")
    side = F.greatest(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"), F.lit(1e-9)).cast("double")
    sized = boxes.withColumn("__class", F.ceil(F.log2(side)).cast("int"))
    at = lambda c: F.floor(F.col(c) / F.pow(F.lit(2.0), F.col("__class")))
    across = lambda a, b: F.explode(F.sequence(at(a), at(b)))
    b = sized.withColumn("__bx", across("x1", "x2")).withColumn("__by", across("y1", "y2"))
    classes = sized.agg(F.array_sort(F.collect_set("__class"))).first()[0]
    d = df.withColumn("__class", F.explode(F.array(*map(F.lit, classes)).cast("array<int>"))).withColumns({"__bx": at("x"), "__by": at("y")})
    inside = F.col("x").between(F.col("x1"), F.col("x2")) & F.col("y").between(F.col("y1"), F.col("y2"))
    return d.join(b, ["__class", "__bx", "__by"]).where(inside).drop("x1", "x2", "y1", "y2", "__class", "__bx", "__by")


def crop_domain(df: DataFrame, south: float = 50.0) -> DataFrame:
    return df.where(F.col("lat") >= south)


def sel_valid_points(df: DataFrame, n: int = 5, seed: int = 0) -> DataFrame:
    """n cells with data, chosen by hash."""
    cells = df.groupBy("cell_id").agg(F.count("value").alias("n_values")).where("n_values > 0")
    return cells.orderBy(F.md5(F.concat_ws(":", F.col("cell_id"), F.lit(seed)).cast("binary")), "cell_id").limit(n)


def sel_version(df: DataFrame, version: int = 1, col: str = "expver") -> DataFrame:
    return df.where(F.col(col) == version).drop(col)


def sel_nearest(grid: DataFrame, points: DataFrame) -> DataFrame:
    """The nearest cell to each named point, and how far it is: points(name, plat, plon)."""
    return nearest_cells(grid, points.select("name", F.col("plat").alias("lat"), F.col("plon").alias("lon")), "name")
