"""Readers, writers and checks of field tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import noleap_date

FIELD = "model string, scenario string, variable string, cell_id long, date date, year int, month int, doy int, value double"
SERIES = ["model", "scenario", "variable", "cell_id", "date"]


def read_field(spark: SparkSession, path: str, variable: str, models: list[str], scenarios: list[str], years: tuple[int, int]) -> DataFrame:
    """All files of a variable as one series per model and scenario; the filters prune partitions of a table written by write_by_year."""
    df = spark.read.schema(FIELD).parquet(path)
    return df.where((F.col("variable") == variable) & F.col("model").isin(models) & F.col("scenario").isin(scenarios) & F.col("year").between(*years))


def read_sources(spark: SparkSession, path: str) -> DataFrame:
    """A stored field table with source, the file that each row comes from, so that per-file checks (calendar, extremes, expected outputs) run on what is stored."""
    return spark.read.schema(FIELD).parquet(path).withColumn("source", F.col("_metadata.file_path"))


def missing_years(df: DataFrame, first: int, last: int) -> DataFrame:
    """Years of the closed range that the table lacks."""
    if not 1950 <= first < last <= 2100:
        raise ValueError("years must run forward within 1950..2100")
    spark = df.sparkSession
    return spark.range(first, last + 1).select(F.col("id").cast("int").alias("year")).join(df.select("year").distinct(), "year", "left_anti")


def require_years(df: DataFrame, first: int, last: int) -> DataFrame:
    gone = sorted(r["year"] for r in missing_years(df, first, last).collect())  # at most 151 rows
    if gone:
        raise ValueError(f"missing years: {gone}")
    return df


def concat_members(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def conflicts(df: DataFrame, keys: list[str] = SERIES) -> DataFrame:
    """Keys that come more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def year_status(df: DataFrame, min_year: int = 1950, by: tuple[str, ...] | None = None) -> DataFrame:
    """by (what of model, scenario and variable the table has, and the year), n_dates, written: whether write_by_year writes that year of that member."""
    n = df.groupBy(*(by or _member_years(df))).agg(F.countDistinct("date").alias("n_dates"))
    return n.withColumn("written", (F.col("year") >= min_year) & (F.col("n_dates") != 1))


def _member_years(df: DataFrame) -> tuple[str, ...]:
    return (*(k for k in ("variable", "model", "scenario") if k in df.columns), "year")


def write_by_year(df: DataFrame, path: str, min_year: int = 1950, by: tuple[str, ...] | None = None, rows_a_file: int = 4_000_000, existing: DataFrame | None = None) -> DataFrame:
    """Write a partition per member and year, and return year_status; years before min_year, and years of a single time of that member, are left out.

    Only partitions that the rows belong to are replaced, and each as a whole when all tasks have ended: a run that is repeated, or was lost half way, leaves the
    same files as one that wasn't. A large year is written by several tasks (its rows are dealt by a hash of the cell into so many parts that
    each has about rows_a_file of them), so neither a task nor a file grows with the grid. Members' years that `existing` has already are left alone.
    """
    by = by or _member_years(df)
    status = year_status(df, min_year, by)
    sizes = df.groupBy(*by).agg(F.count("*").alias("__n"), F.countDistinct("date").alias("__d")).where((F.col("year") >= min_year) & (F.col("__d") != 1))
    if existing is not None:
        sizes = sizes.join(existing.select(*by).distinct(), list(by), "left_anti")
    parts = sizes.select(*by, F.ceil(F.col("__n") / rows_a_file).cast("int").alias("__parts"))
    spread = F.xxhash64(*(c for c in ("cell_id",) if c in df.columns), "date")
    rows = df.join(parts, list(by)).withColumn("__part", F.pmod(spread, F.col("__parts"))).repartition(*by, "__part").drop("__part", "__parts")
    rows.write.partitionBy(*by).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    return status


def write_missing(df: DataFrame, path: str, keys: list[str], existing: DataFrame) -> None:
    """Append only the rows whose output keys aren't there yet."""
    todo = df.select(*keys).distinct().join(existing.select(*keys).distinct(), keys, "left_anti")
    df.join(todo, keys, "left_semi").write.partitionBy(*keys).mode("append").parquet(path)


def new_keys(df: DataFrame, keys: list[str], existing: DataFrame) -> DataFrame:
    return df.select(*keys).distinct().join(existing.select(*keys).distinct(), keys, "left_anti")


def _tile_keys(df: DataFrame) -> list[str]:
    return [k for k in ("model", "scenario", "variable", "cell_id", "year") if k in df.columns]


def to_tiles(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """A row per series and year with its values by day of the year, 365 of them; days without data are null."""
    keys = keys or _tile_keys(df)
    by_day = F.map_from_entries(F.collect_list(F.struct("doy", "value")))
    rows = df.where("doy is not null").groupBy(*keys).agg(by_day.alias("m"))
    return rows.select(*keys, F.transform(F.sequence(F.lit(1), F.lit(365)), lambda d: F.try_element_at("m", d)).alias("values"))


def from_tiles(tiles: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The long form again, without days that hold nothing."""
    keys = keys or _tile_keys(tiles)
    return tiles.select(*keys, F.posexplode("values").alias("p", "value")).where("value is not null").select(*keys, (F.col("p") + 1).alias("doy"), "value")


def write_tiles(df: DataFrame, name: str, path: str, buckets: int) -> None:
    """Save to_tiles(df) as a table of that name, its files in the shared folder `path`, in buckets of whole cells.

    What works on series (windows, ranks, percentiles, indicators, bias training) then needs no shuffle: a bucket holds all of a cell, whatever model, scenario and variable it is keyed
    by besides. A bucket should be some hundred megabytes; tables that are used together need the same number of them. Joins on more than the cell (indicators with the limits of their
    model) find the buckets enough with spark.sql.requireAllClusterKeysForCoPartition set to false.
    """
    to_tiles(df).write.format("parquet").option("path", path).bucketBy(buckets, "cell_id").sortBy("cell_id", "year").mode("overwrite").saveAsTable(name)


def read_tiles(spark: SparkSession, name: str) -> DataFrame:
    """The long form of a table of write_tiles: series keys, year, doy, date, month and value, still in its buckets. 29 February and days without data aren't in tiles."""
    long = from_tiles(spark.table(name))
    date = noleap_date(F.col("year"), F.col("doy"))
    return long.withColumn("date", date).withColumn("month", F.month("date"))


def to_series_layout(df: DataFrame, key: str = "cell_id") -> DataFrame:
    """Each cell's days together and in order within a partition."""
    return df.repartition(key).sortWithinPartitions(key, "date")


def read_holdings_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV whose filenames column is a list in text; only names that end in .nc stay."""
    return parse_filenames(spark.read.option("header", True).option("quote", '"').option("escape", '"').csv(path))


def parse_filenames(df: DataFrame, col: str = "filenames") -> DataFrame:
    names = F.transform(F.split(F.regexp_replace(col, r"[\[\]'\"]", ""), ","), lambda x: F.trim(x))
    return df.withColumn(col, F.filter(names, lambda x: x.rlike(r"^.*[^/]\.nc$")))


def read_path_list(spark: SparkSession, path: str, contains: str = "") -> DataFrame:
    """src and dst of text files with a path, or a pair of them, on each line."""
    return parse_paths(spark.read.text(path), contains)


def parse_paths(lines: DataFrame, contains: str = "") -> DataFrame:
    parts = F.split(F.trim("value"), r"\s+")
    return lines.where(F.trim("value") != "").select(F.get(parts, 0).alias("src"), F.get(parts, 1).alias("dst")).where(F.col("src").contains(contains))


def write_batches(pairs: DataFrame, path: str) -> None:
    """A text file of source and destination per variable and table: pairs(variable, table_id, src, dst)."""
    lines = pairs.select("variable", "table_id", F.concat_ws(" ", "src", "dst").alias("value"))
    lines.repartition("variable", "table_id").sortWithinPartitions("variable", "table_id", "value").write.partitionBy("variable", "table_id").text(path)


def validate_readback(df: DataFrame, keys: list[str]) -> DataFrame:
    """keys, n, n_valid, min, max, mean and ok: rows are there and not all null."""
    out = df.groupBy(*keys).agg(F.count("*").alias("n"), F.count("value").alias("n_valid"), F.min("value").alias("min"), F.max("value").alias("max"), F.avg("value").alias("mean"))
    return out.withColumn("ok", F.col("n_valid") > 0)
