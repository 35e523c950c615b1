"""Units, clamps and elementwise arithmetic. No data stays null throughout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import days_in_month, haversine_km
from .windows import member_keys, on_members, series_keys

#: What a negative temperature range becomes: just above no range at all.
LEAST_DTR = 0.0000999


def convert_units(df: DataFrame, monthly: bool = False) -> DataFrame:
    """Kelvin to Celsius for temperatures, flux to millimetres per step for precipitation and snowfall, by variable."""
    seconds = 86400.0 * (days_in_month(F.col("date")) if monthly else F.lit(1))
    v, k = F.col("value"), F.col("variable")
    return df.withColumn("value", F.when(k.isin("tas", "tasmax", "tasmin"), v - 273.15).when(k.isin("pr", "prsn"), v * seconds).otherwise(v))


def celsius_to_kelvin(v: Column) -> Column:
    return v + 273.15


def flux_units(v: Column) -> Column:
    """Millimetres a day to kg m-2 s-1."""
    return v / 86400.0


def daily_share(df: DataFrame) -> DataFrame:
    """Series keys, share: how many of the steps between consecutive dates are one day."""
    keys = series_keys(df)
    gap = F.datediff("date", F.lag("date").over(Window.partitionBy(*keys).orderBy("date")))
    return df.select(*keys, gap.alias("gap")).where("gap is not null").groupBy(*keys).agg(F.avg((F.col("gap") == 1).cast("double")).alias("share"))


def relabel_units(df: DataFrame, names: dict[str, str] = {"mm": "mm/day", "m": "m/day"}, least: float = 0.9) -> DataFrame:
    """Per-day unit labels without touching values, for series that are daily (over `least` of their steps); others keep null."""
    keys = series_keys(df)
    daily = daily_share(df).where(F.col("share") > least).select(*keys, F.lit(True).alias("daily"))
    pairs = F.create_map(*(F.lit(x) for kv in names.items() for x in kv))
    return df.join(daily, keys, "left").withColumn("unit", F.when(F.col("daily"), pairs[F.col("unit")])).drop("daily")


def difference(a: DataFrame, b: DataFrame, keys: list[str], name: str) -> DataFrame:
    """a - b on common keys, named. Where both tables have a unit column the units must be the same: a row whose units differ stops the job;
    the result keeps the unit."""
    with_unit = ["unit"] if "unit" in a.columns and "unit" in b.columns else []
    own = lambda d, x: d.select(*keys, *(F.col(c).alias(f"__{x}_{c}") for c in ["value", *with_unit]))
    both = own(a, "a").join(own(b, "b"), keys)
    value = F.col("__a_value") - F.col("__b_value")
    if not with_unit:
        return both.select(*keys, F.lit(name).alias("variable"), value.alias("value"))
    wrong = F.raise_error(F.concat(F.lit("units differ: "), F.coalesce("__a_unit", F.lit("none")), F.lit(" and "), F.coalesce("__b_unit", F.lit("none")))).cast("double")
    return both.select(*keys, F.lit(name).alias("variable"), F.when(F.col("__a_unit").eqNullSafe(F.col("__b_unit")), value).otherwise(wrong).alias("value"), F.col("__a_unit").alias("unit"))


def common_attrs(a: Column, b: Column) -> Column:
    """The entries that two attribute maps share."""
    return F.map_filter(a, lambda k, v: b[k].eqNullSafe(v))


def dtr(tasmax: Column, tasmin: Column) -> Column:
    d = tasmax - tasmin
    return F.when(d < 0, LEAST_DTR).otherwise(d)


def clamp(v: Column, low: float | None = None, high: float | None = None) -> Column:
    """v within bounds; null stays null."""
    out = v
    if low is not None:
        out = F.when(v < low, F.lit(low)).otherwise(out)
    if high is not None:
        out = F.when(v > high, F.lit(high)).otherwise(out)
    return out


def clamp_report(df: DataFrame, low: float, high: float, keys: list[str]) -> DataFrame:
    v = F.col("value")
    return df.groupBy(*keys).agg(F.count_if(v < low).alias("n_below"), F.count_if(v > high).alias("n_above"), F.count("value").alias("n"))


def histogram(df: DataFrame, bins: int, keys: list[str] | None = None) -> DataFrame:
    """keys (those of a member, unless others are given), bin, n, low and width of equal-width bins between each member's extremes; a constant one is one bin of width 0."""
    keys = member_keys(df) if keys is None else keys
    v = df.where("value is not null").select(*keys, "value")
    ends = v.groupBy(*keys).agg(F.min("value").alias("low"), F.max("value").alias("high")).withColumn("width", (F.col("high") - F.col("low")) / bins)
    at = F.least(F.lit(bins - 1), F.coalesce(F.floor(F.try_divide(F.col("value") - F.col("low"), F.col("width"))), F.lit(0)).cast("int"))
    return on_members(v, ends).groupBy(*keys, at.alias("bin")).agg(F.count("*").alias("n"), F.first("low").alias("low"), F.first("width").alias("width"))


def quantile_bounds(df: DataFrame, low_q: float, high_q: float, bins: int = 10_000) -> DataFrame:
    """Member keys, lower and upper: the edges of the first bins whose cumulative share reaches the two quantiles. At most `bins` rows a member are ordered."""
    keys, h = member_keys(df), histogram(df, bins)
    whole = Window.partitionBy(*keys)
    h = h.withColumn("cdf", F.sum("n").over(whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)) / F.sum("n").over(whole))
    low, high = F.min(F.when(F.col("cdf") >= low_q, F.col("bin"))), F.min(F.when(F.col("cdf") >= high_q, F.col("bin")))
    return h.groupBy(*keys).agg((F.first("low") + low * F.first("width")).alias("lower"), (F.first("low") + (high + 1) * F.first("width")).alias("upper"))


def clamp_quantile_hist(df: DataFrame, low_q: float = 2e-7, high_q: float = 1 - 2e-7, bins: int = 10_000) -> DataFrame:
    """Values outside the bounds of their member's own distribution become the bound."""
    v = F.col("value")
    return on_members(df, quantile_bounds(df, low_q, high_q, bins), how="left").withColumn("value", F.when(v < F.col("lower"), F.col("lower")).when(v > F.col("upper"), F.col("upper")).otherwise(v)).drop("lower", "upper")


def round_negative(v: Column) -> Column:
    """Negative values to the nearest integer, half to even; -0.0 is 0."""
    return F.when(v < 0, F.rint(v) + 0.0).otherwise(v)


def round_negative_report(df: DataFrame, keys: list[str]) -> DataFrame:
    v, new = F.col("value"), round_negative(F.col("value"))
    changed = F.count_if(new != v)
    return df.groupBy(*keys).agg(F.count("*").alias("total"), F.count_if(v < 0).alias("negative"), changed.alias("changed"), (100.0 * changed / F.count("*")).alias("pct_changed"), F.count_if(new < 0).alias("remaining"))


def jitter_under(df: DataFrame, threshold: float, keys: list[str], seed: int = 0, least: float = 1e-12) -> DataFrame:
    """Values under the threshold become noise in (0, threshold) drawn from a hash of the keys, so a retry draws the same."""
    u = (F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(1 << 40)).cast("double") + 0.5) / float(1 << 40)
    return df.withColumn("value", F.when(F.col("value") < threshold, F.greatest(F.lit(least), u * threshold)).otherwise(F.col("value")))


def shift_longitude(lon: Column) -> Column:
    return F.pmod(lon + 180.0, F.lit(360.0)) - 180.0


def abs_delta(a: Column, b: Column) -> Column:
    return F.abs(a - b)


def ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a, b)


def resolution_km(lat_step: Column, lon_step: Column) -> tuple[Column, Column]:
    """Rounded kilometres of a grid step, longitude at 65 degrees."""
    return F.round(lat_step * 110), F.round(lon_step * 111.32 * F.cos(F.radians(F.lit(65.0))))


def step_width_km(lon_step: Column, lat: Column) -> Column:
    """Great-circle kilometres of a longitude step at a latitude."""
    return haversine_km(lat, F.lit(0.0), lat, lon_step)
