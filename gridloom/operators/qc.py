"""Quality-control reports: each returns a table of findings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .aggregate import pct_condition
from .joins import align_inner
from .windows import common_keys, series_keys


def qc_ranges(df: DataFrame, ranges: DataFrame, nodata: float = -9999) -> DataFrame:
    """indicator, least, most, n_outside against ranges(indicator, min, max)."""
    own = df.where(F.col("value") != nodata).join(ranges.select("indicator", "min", "max"), "indicator")
    v = F.col("value")
    return own.groupBy("indicator").agg(F.min(v).alias("least"), F.max(v).alias("most"), F.count_if((v < F.col("min")) | (v > F.col("max"))).alias("n_outside"))


def qc_units(df: DataFrame, expected: DataFrame) -> DataFrame:
    """indicator, units and whether they are the expected ones: nulls never are, unless nothing is expected."""
    e = expected.select("indicator", F.col("units").alias("expected"))
    return df.select("indicator", "units").distinct().join(e, "indicator", "left").withColumn("ok", F.col("units").eqNullSafe(F.col("expected")))


def qc_nodata_match(out: DataFrame, source: DataFrame) -> DataFrame:
    """Series keys and year of output rows whose nulls differ from those of the source series at its first time; series of one side only, too, and every source
    variable or member where the output doesn't tell them apart."""
    on = common_keys(source, out)
    first = source.groupBy(*series_keys(source)).agg(F.min_by(F.struct("value"), "date")["value"].isNull().alias("a"))
    own = [k for k in series_keys(out) if k not in on]
    both = out.select(*on, *own, "year", F.col("value").isNull().alias("b")).join(first, on, "full")
    return both.where(~F.col("a").eqNullSafe(F.col("b"))).select(*series_keys(both), "year")


def qc_names(files: DataFrame, path: str = "path") -> DataFrame:
    """Files whose name's variable isn't the column's."""
    named = F.regexp_extract(F.element_at(F.split(path, "/"), -1), r"^([^_]+)_", 1)
    return files.withColumn("named", named).where(~F.col("named").eqNullSafe(F.col("variable")))


def qc_regrid_range(source: DataFrame, out: DataFrame, keys: list[str], buffer: float = 0.05) -> DataFrame:
    """keys, extremes of both and ok: the output's lie within the source's, widened by a share of their range."""
    s = source.groupBy(*keys).agg(F.min("value").alias("source_min"), F.max("value").alias("source_max"))
    o = out.groupBy(*keys).agg(F.min("value").alias("out_min"), F.max("value").alias("out_max"))
    room = buffer * (F.col("source_max") - F.col("source_min"))
    return s.join(o, keys).withColumn("ok", (F.col("out_min") >= F.col("source_min") - room) & (F.col("out_max") <= F.col("source_max") + room))


def qc_log_scan(lines: DataFrame, col: str = "value") -> DataFrame:
    """kind and path of log lines that report an overwrite or a processing error."""
    line = F.col(col)
    kind = F.when(line.startswith("OVERWRITE"), "overwrite").when(line.startswith("PROCESSING ERROR"), "error")
    return lines.select(kind.alias("kind"), F.regexp_extract(line, r"(\S+/\S+)", 1).alias("path")).where("kind is not null")


def check_bounds(df: DataFrame, bounds: list[tuple[str, str, float]], keys: list[str]) -> DataFrame:
    """For each (variable, operator, value) that must hold nowhere: keys, the per cent where it does, and ok."""
    out = None
    for variable, op, value in bounds:
        one = pct_condition(df.where(F.col("variable") == variable), op, value, keys).select(*keys, F.lit(variable).alias("variable"), F.lit(f"{op} {value:g}").alias("condition"), "pct", (F.coalesce("pct", F.lit(0.0)) == 0).alias("ok"))
        out = one if out is None else out.unionByName(one)
    return out


def check_order(low: DataFrame, high: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """by, per cent of common rows with low > high."""
    both = align_inner(low, high, keys, ("low", "high")).withColumn("value", F.col("low") - F.col("high"))
    return pct_condition(both, ">", 0, by)


def presence_matrix(df: DataFrame, scenarios: list[str]) -> DataFrame:
    wide = df.groupBy("model").pivot("scenario", scenarios).agg(F.max(F.lit(True)))
    return wide.select("model", *(F.coalesce(s, F.lit(False)).alias(s) for s in scenarios))


def validate_attrs(parsed: DataFrame, claimed: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """key and column of each claim that differs from what the path says. A path that is listed or claimed several times is read once, so each claim counts for itself."""
    p = parsed.select(key, *(F.col(c).cast("string").alias(f"__{c}") for c in columns)).distinct()
    both = claimed.select(key, *columns).join(p, key)
    wrong = F.array_compact(F.array(*(F.when(~F.col(c).cast("string").eqNullSafe(F.col(f"__{c}")), F.lit(c)) for c in columns)))
    return both.select(key, F.explode(wrong).alias("column"))


def recompute_compare(stored: DataFrame, again: DataFrame) -> DataFrame:
    """Rows that only one of two tables has."""
    again = again.select(*stored.columns)
    return stored.exceptAll(again).withColumn("only_in", F.lit("stored")).unionByName(again.exceptAll(stored).withColumn("only_in", F.lit("again")))


def check_value_range(df: DataFrame, low: float, high: float, keys: list[str]) -> DataFrame:
    """keys, extremes and ok: low <= min, max < high, not constant."""
    out = df.groupBy(*keys).agg(F.min("value").alias("min"), F.max("value").alias("max"))
    return out.withColumn("ok", (F.col("min") >= low) & (F.col("max") < high) & (F.col("min") < F.col("max")))


def mirror_check(manifest: DataFrame, mirror: DataFrame, col: str = "path") -> DataFrame:
    """Manifest paths that the mirror lacks."""
    return manifest.select(col).distinct().join(mirror.select(col), col, "left_anti")


def check_single_params(parsed: DataFrame, allowed: dict[str, list[str]]) -> DataFrame:
    """Distinct parameters outside the requested lists."""
    bad: Column = F.lit(False)
    for c, values in allowed.items():
        bad = bad | ~F.coalesce(F.col(c).isin(values), F.lit(False))
    return parsed.select(*allowed).distinct().where(bad)
