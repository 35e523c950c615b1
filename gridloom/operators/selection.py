"""Exact order statistics of groups of any size.

No group is held whole: a mergeable sketch names values near the wanted ranks, one pass counts exactly what lies at and between those values, and the
interval that holds a rank is taken apart again until it has few enough values to be sorted. Sketches only choose where to cut, so results are exact whatever
they say. Each round narrows an interval to about a sixtieth, and leaves out the values cut at in any case.

Groups of up to `bound` values go the plain way, and only they do where no group is larger. A round reads the input twice; an input that is dear to make is
best written or cached before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.shared import written

#: Marks that a sketch is asked for, its size, and how many marks either side of a rank its cuts lie: about four times the sketch's error.
_MARKS, _SIZE, _SIDE = 256, 2000, 2
#: Values that one group, or interval of a group, may hold in a task.
BOUND = 1 << 18


def _meet(a: DataFrame, b: DataFrame, on: list[str], how: str = "inner", also: Column | None = None) -> DataFrame:
    """a joined to b on columns that both have, nulls equal; b's other columns are named in `also` by their names."""
    b = b.select(*(F.col(c).alias(f"__{c}") if c in on else F.col(c) for c in b.columns))
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in on]
    for c in same[1:] + ([also] if also is not None else []):
        same[0] = same[0] & c
    return a.join(b, same[0], how).drop(*(f"__{c}" for c in on))


def _marks(value: str) -> Column:
    return F.kll_sketch_get_quantile_double(F.kll_sketch_agg_double(value, F.lit(_SIZE)), F.array(*(F.lit(i / _MARKS) for i in range(_MARKS + 1))))


def _inside(value: str) -> Column:
    """value lies between low and high, both left out; null is no limit."""
    v = F.col(value)
    return F.coalesce(v > F.col("low"), F.lit(True)) & F.coalesce(v < F.col("high"), F.lit(True))


def _narrowed(values: DataFrame, targets: DataFrame, keys: list[str]) -> DataFrame:
    """Targets (keys, total, rank, part, low, high, before, n, value) in the parts of their parts; those whose part is a single value get it."""
    parts = targets.select(*keys, "part", "low", "high").distinct()
    sketched = _meet(values, parts, keys, also=_inside("__v")).groupBy(*keys, "part").agg(_marks("__v").alias("marks"))
    at = F.round((F.col("rank") - F.col("before") + 0.5) / F.col("n") * _MARKS).cast("int")
    near = F.array(*(F.get("marks", F.greatest(F.lit(0), F.least(F.lit(_MARKS), at + d))) for d in (-_SIDE, _SIDE)))
    near = _meet(targets, sketched, [*keys, "part"]).groupBy(*keys, "part", "low", "high", "before").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(near)))).alias("cuts"))
    cuts = written(near, "cuts")
    # Places 0, 2, 4... lie between cuts, 1, 3, 5... are the cuts themselves.
    place = 2 * F.size(F.filter("cuts", lambda c: c < F.col("__v"))) + F.array_contains("cuts", F.col("__v")).cast("int")
    counts = _meet(values, cuts, keys, also=_inside("__v")).groupBy(*keys, "part", place.alias("place")).agg(F.count("*").alias("held"))
    placed = _meet(counts, cuts, [*keys, "part"])
    upto = F.sum("held").over(Window.partitionBy(*keys, "part").orderBy("place"))
    j = F.floor(F.col("place") / 2).cast("int")
    cut, single = F.get("cuts", j), F.col("place") % 2 == 1
    ends = placed.select(
        *keys, "part", "held", (F.col("before") + upto - F.col("held")).alias("start"), F.when(single, cut).alias("only"),
        F.when(j > 0, F.get("cuts", j - 1)).otherwise(F.col("low")).alias("low2"), F.when(j < F.size("cuts"), cut).otherwise(F.col("high")).alias("high2"), F.concat_ws("/", "part", "place").alias("part2"),
    )
    found = _meet(targets, ends, [*keys, "part"], also=(F.col("rank") >= F.col("start")) & (F.col("rank") < F.col("start") + F.col("held")))
    return found.select(*keys, "total", "rank", F.col("part2").alias("part"), F.col("low2").alias("low"), F.col("high2").alias("high"), F.col("start").alias("before"), F.col("held").alias("n"), F.col("only").alias("value"))


def _ranked(values: DataFrame, sizes: DataFrame, keys: list[str], ranks: Column, bound: int) -> DataFrame:
    """keys, total, rank, value of the wanted ranks (from 0) of each group of sizes(keys, total)."""
    none = F.lit(None).cast("double")
    targets = sizes.select(*keys, "total", F.explode(F.array_distinct(ranks)).alias("rank"), F.lit("").alias("part"), none.alias("low"), none.alias("high"), F.lit(0).cast("long").alias("before"), F.col("total").alias("n"), none.alias("value"))
    large = (F.col("n") > bound) & F.col("value").isNull()
    while not targets.where(large).isEmpty():
        targets = written(_narrowed(values, targets.where(large), keys).unionByName(targets.where(~large)), "ranks")
    rest = targets.where("value is null")
    lists = _meet(values, rest.select(*keys, "part", "low", "high").distinct(), keys, also=_inside("__v")).groupBy(*keys, "part").agg(F.array_sort(F.collect_list("__v")).alias("list"))
    sought = _meet(rest, lists, [*keys, "part"]).withColumn("value", F.get("list", (F.col("rank") - F.col("before")).cast("int")))
    return sought.select(*keys, "total", "rank", "value").unionByName(targets.where("value is not null").select(*keys, "total", "rank", "value"))


def percentiles(df: DataFrame, keys: list[str], probabilities: list[float], value: str = "value", bound: int = BOUND) -> DataFrame:
    """keys and q: for each group the array of its exact type 7 quantiles, by linear interpolation between the two nearest ranks, as doubles.

    Null and NaN are no data; a group without data has no row, nor has an empty table. Null keys are a group of their own; without keys the table is one group.
    """
    own = keys or ["__all"]
    values = (df if keys else df.withColumn("__all", F.lit(1))).select(*own, F.col(value).cast("double").alias("__v")).where("__v is not null and not isnan(__v)")
    sizes = written(values.groupBy(*own).agg(F.count("*").alias("total")).where(F.col("total") > bound), "sizes")
    plain = F.percentile("__v", F.array(*map(F.lit, probabilities)))
    if sizes.isEmpty():
        return values.groupBy(*own).agg(plain.alias("q")).select(*keys, "q")
    small = _meet(values, sizes, own, "left_anti").groupBy(*own).agg(plain.alias("q"))
    at = [(F.col("total") - 1) * F.lit(p) for p in probabilities]
    ranks = F.array(*(f(a).cast("long") for a in at for f in (F.floor, F.ceil)))
    found = _ranked(values, sizes, own, ranks, bound).groupBy(*own, "total").agg(F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("by_rank"))
    by = lambda r: F.element_at("by_rank", r.cast("long"))
    # Written as the built-in percentile does, so that both ways round alike.
    between = lambda a: (F.ceil(a) - a) * by(F.floor(a)) + (a - F.floor(a)) * by(F.ceil(a))
    q = F.array(*(F.when(F.floor(a) == F.ceil(a), by(F.floor(a))).otherwise(between(a)) for a in at))
    return found.select(*own, q.alias("q")).unionByName(small).select(*keys, "q")


def cumulative(df: DataFrame, keys: list[str], value: str = "value", name: str = "cdf", bound: int = BOUND) -> DataFrame:
    """Rows with data and the share of their group's values that are no greater than theirs.

    A large group is counted by value, so that repeated values are one row; its distinct values are dealt into 256 intervals at a sketch's marks, and running sums
    inside an interval start from the sums of those before it. A task sorts one interval of a group.
    """
    own = keys or ["__all"]
    rows = (df if keys else df.withColumn("__all", F.lit(1))).where(F.col(value).isNotNull())
    sizes = written(rows.groupBy(*own).agg(F.count("*").alias("total")).where(F.col("total") > bound), "sizes")
    plain = F.cume_dist().over(Window.partitionBy(*own).orderBy(value))
    if sizes.isEmpty():
        return rows.withColumn(name, plain).drop("__all")
    small = _meet(rows, sizes, own, "left_anti").withColumn(name, plain)
    big = _meet(rows, sizes, own, "left_semi")
    counts = big.groupBy(*own, value).agg(F.count("*").alias("held")).withColumn("__v", F.col(value).cast("double"))
    splits = written(counts.groupBy(*own).agg(_marks("__v").alias("marks")).select(*own, F.array_distinct("marks").alias("cuts")), "splits")
    interval = F.size(F.filter("cuts", lambda c: c < F.col("__v")))
    dealt = _meet(counts, splits, own).withColumn("interval", interval)
    inside = F.sum("held").over(Window.partitionBy(*own, "interval").orderBy(value))
    totals = dealt.groupBy(*own, "interval").agg(F.sum("held").alias("all_held"))
    base = F.sum("all_held").over(Window.partitionBy(*own).orderBy("interval")) - F.col("all_held")
    starts = totals.select(*own, "interval", base.alias("base"))
    upto = _meet(_meet(dealt.withColumn("inside", inside), starts, [*own, "interval"]), sizes, own).select(*own, value, ((F.col("base") + F.col("inside")) / F.col("total")).alias(name))
    return _meet(big, upto, [*own, value]).unionByName(small).drop("__all")
