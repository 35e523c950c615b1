"""Catalogue tables of an archive: requests, holdings, manifests and their summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PARTS = ["model", "scenario", "variant", "table_id", "variable", "grid_type", "version", "filename"]
FREQUENCIES = {"6hrLev": "6hr", "6hrPlev": "6hr", "6hrPlevPt": "6hr", "3hr": "3hr", "E3hr": "3hr", "E3hrPt": "3hr", "CF3hr": "3hr", "Amon": "mon", "Omon": "mon", "SImon": "mon", "day": "day", "Eday": "day", "Oday": "day"}


def expand_requests(models: DataFrame, variables: DataFrame, scenarios: list[str]) -> DataFrame:
    """Every model with its variants, each scenario and each (table, variable): models(model, variants), variables(table_id, variable).
    The product is what is asked for, so the tables are crossed."""
    runs = models.select("model", F.explode("variants").alias("variant")).withColumn("scenario", F.explode(F.array(*map(F.lit, scenarios))))
    activity = F.when(F.col("scenario") == "historical", "CMIP").otherwise("ScenarioMIP")
    return runs.withColumn("activity", activity).crossJoin(variables)


def parse_path(paths: DataFrame, col: str = "path") -> DataFrame:
    """The parts of archive paths by their place from the end."""
    p = F.split(col, "/")
    return paths.select(col, *(F.try_element_at(p, F.lit(i - len(PARTS))).alias(n) for i, n in enumerate(PARTS)))


def parse_layouts(paths: DataFrame, col: str = "path") -> DataFrame:
    """path, layout and what the path says, in any of the archive's three layouts, by place from the end.

    mirror: model/scenario/variant/table_id/variable/grid_type/version/file; dtr (its folder is called so) and regrid (its name has `_regrid`):
    model/scenario/table_id/variable/file, without variant and grid. timeframe: the name's last part.
    """
    p = F.split(col, "/")
    at = lambda i: F.try_element_at(p, F.lit(i))
    layout = F.when(at(-2) == "dtr", "dtr").when(at(-1).contains("_regrid"), "regrid").otherwise("mirror")
    short = layout != "mirror"
    long_at, short_at = {n: i - len(PARTS) for i, n in enumerate(PARTS)}, {"model": -5, "scenario": -4, "table_id": -3, "variable": -2}
    named = (F.when(short, at(short_at[n]) if n in short_at else F.lit(None)).otherwise(at(long_at[n])).alias(n) for n in PARTS[:6])
    timeframe = F.regexp_replace(F.element_at(F.split(at(-1), "_"), -1), r"\.nc.*$", "")
    return paths.select(col, layout.alias("layout"), *named, timeframe.alias("timeframe"))


def holdings_table(requests: DataFrame, files: DataFrame) -> DataFrame:
    """For each request the latest version's files by grid: version, n_files, filenames; a null row where there is nothing."""
    keys = ["model", "scenario", "variant", "table_id", "variable"]
    last = files.groupBy(*keys, "grid_type").agg(F.max("version").alias("version"))
    held = files.join(last, [*keys, "grid_type", "version"]).groupBy(*keys, "grid_type", "version").agg(F.count("*").alias("n_files"), F.array_sort(F.collect_list("filename")).alias("filenames"))
    return requests.join(held, keys, "left")


def name_dates(name: Column) -> list[Column]:
    """start and end year, month and day that a file name says, from parts of 6, 8 or 12 digits; nulls for names without."""
    out = []
    for i, which in ((1, "start"), (2, "end")):
        digits = F.regexp_extract(name, r"(\d{6,12})-(\d{6,12})\.nc$", i)
        for at, length, unit in ((1, 4, "year"), (5, 2, "month"), (7, 2, "day")):
            part = F.substring(digits, at, length)
            out.append(F.when(F.length(part) == length, part.cast("int")).alias(f"{which}_{unit}"))
    return out


def manifest(holdings: DataFrame, production: DataFrame) -> DataFrame:
    """A row per file of each model's production variant and grids: production(model, variant, grids)."""
    rows = holdings.join(production, ["model", "variant"]).where(F.array_contains("grids", F.col("grid_type"))).where("n_files is not null")
    rows = rows.withColumn("filename", F.explode("filenames"))
    return rows.select("model", "scenario", "variant", "table_id", "variable", "grid_type", "version", *name_dates(F.col("filename")), "filename")


def fallback_rows(chosen: DataFrame, files: DataFrame, variables: list[str]) -> DataFrame:
    """For models that lack one of the variables, its first file of any variant."""
    fixed = files.where(F.col("variable").isin(variables))
    missing = fixed.join(chosen.select("model", "variable").distinct(), ["model", "variable"], "left_anti")
    first = missing.groupBy("model", "variable").agg(F.min(F.struct("path")).alias("f"))
    return first.select("model", "variable", F.col("f.path").alias("path"))


def append_extra(rows: DataFrame, paths: DataFrame) -> DataFrame:
    """rows(path and its parts) with explicit paths added."""
    return rows.select("path", *PARTS).unionByName(parse_path(paths))


def transfer_pairs(files: DataFrame, prefixes: dict[str, str], default: str, to: str) -> DataFrame:
    """src by the model's family (the longest matching start of its name) and dst."""
    src = F.lit(default)
    for start, prefix in sorted(prefixes.items(), key=lambda kv: len(kv[0])):
        src = F.when(F.col("model").startswith(start), F.lit(prefix)).otherwise(src)
    return files.select(F.concat_ws("/", src, "path").alias("src"), F.concat_ws("/", F.lit(to), "path").alias("dst"))


def regrid_name(name: Column) -> Column:
    """The name of the regridded file: the grid part becomes regrid."""
    return F.regexp_replace(name, r"_g[a-z0-9]+(_[0-9]+-[0-9]+)?\.nc$", "_regrid$1.nc")


def source_of_regrid(regridded: DataFrame, files: DataFrame, keys: list[str]) -> DataFrame:
    """The source file of each regridded one, by keys and the dates it holds: regridded(keys, day)."""
    from .joins import temporal_containment

    return temporal_containment(regridded, files, keys)


def availability_matrix(files: DataFrame, variables: list[str], tables: list[str]) -> DataFrame:
    """A tick per model and scenario for each variable."""
    ticks = files.where(F.col("table_id").isin(tables)).groupBy("model", "scenario").pivot("variable", variables).agg(F.max(F.lit(True)))
    return ticks.select("model", "scenario", *(F.coalesce(v, F.lit(False)).alias(v) for v in variables))


def normalise_frequency(table_id: Column) -> Column:
    pairs = F.create_map(*(F.lit(x) for kv in FREQUENCIES.items() for x in kv))
    return F.coalesce(pairs[table_id], table_id)


def set_difference(files: DataFrame, a: str, b: str) -> DataFrame:
    """(model, table_id, variable) held by variant a but not by b."""
    own = lambda v: files.where(F.col("variant") == v).select("model", "table_id", "variable").distinct()
    return own(a).exceptAll(own(b))


def by_grid(files: DataFrame) -> DataFrame:
    """model, table_id, variable, grid_type, shared: whether another grid of the model has the pair too."""
    keys = ["model", "table_id", "variable"]
    n = files.groupBy(*keys).agg(F.countDistinct("grid_type").alias("__n"))
    return files.select(*keys, "grid_type").distinct().join(n, keys).select(*keys, "grid_type", (F.col("__n") > 1).alias("shared"))


def best_variants(files: DataFrame, scenarios: list[str]) -> DataFrame:
    """Variants with the model's greatest number of pairs in every scenario."""
    n = files.where(F.col("scenario").isin(scenarios)).groupBy("model", "scenario", "variant").agg(F.countDistinct("table_id", "variable").alias("n"))
    top = n.groupBy("model", "scenario").agg(F.max("n").alias("n"))
    return n.join(top, ["model", "scenario", "n"]).groupBy("model", "variant").agg(F.countDistinct("scenario").alias("__k")).where(F.col("__k") == len(scenarios)).drop("__k")


def dedupe_paths(paths: DataFrame, col: str = "path") -> DataFrame:
    """Each path once, with how often it came."""
    return paths.groupBy(col).agg(F.count("*").alias("n"))


def union_holdings(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).where("n_files is not null")


def melt(df: DataFrame, ids: list[str], values: list[str], name: str, value: str) -> DataFrame:
    return df.unpivot(ids, values, name, value)


def ensemble_key(df: DataFrame, variants: DataFrame) -> DataFrame:
    """Adds ensemble, <model>_<variant>_<scenario>; a model without a variant has 'unknown'."""
    named = df.join(variants.select("model", "variant"), "model", "left")
    return named.withColumn("variant", F.coalesce("variant", F.lit("unknown"))).withColumn("ensemble", F.concat_ws("_", "model", "variant", "scenario"))
