"""Mixing sources to target weights by Sainte-Lague apportionment of equal-word blocks.

Targets. Sources in code-point order, null last, weigh 5, 2, 1 and again; together they share `share` of all words. A target stops
at `most` times its source's size and the excess is reshared by weight. Sorted by (cap / weight), the sources that reach their cap
are a prefix, so running sums over one row a source find all targets without iteration.

Quotas. The corpus has as many seats as blocks of `block_words` words fit its targets. Seats go to the highest quotients target / (2k - 1). All but a few
seats of a source are certain beforehand (a divisor method differs from the exact share by a bounded amount), so only the doubtful
ones are ranked, a few a source. Documents are dealt by hash into shards of about `shard_words` words, and a source's seats are divided among them by its
running word sums, rounded, so that the shards' quotas add up to the source's at any number of shards.

Selection. The words of a source's documents in a shard, in seeded order, are cut into blocks. A quota takes every block as many whole
times as it can, and for the rest a run of blocks from a seeded start, round the end. Runs keep documents whole but for two
cuts at most, and since the order is itself seeded any run is a random choice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import words, written

WEIGHTS = (5, 2, 1)


def _draw(*parts: Column) -> Column:
    return F.conv(F.substring(F.md5(F.concat_ws(":", *(F.coalesce(p.cast("string"), F.lit("null")) for p in parts)).cast("binary")), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """sizes(source, source_size): adds weight and target. One row a source, so the windows hold no more rows than there are sources. A null source is
    one of its own, last; a source without words has the target 0, and an empty table none."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    rank = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    out = sizes.withColumn("weight", F.element_at(F.array(*(F.lit(w) for w in weights)), rank.cast("int") + 1).cast("long"))
    out = out.withColumn("cap", F.lit(most) * F.col("source_size")).withColumn("ratio", F.col("cap") / F.col("weight"))
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before, after = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(0, Window.unboundedFollowing)
    total = F.lit(share) * F.sum("source_size").over(by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    out = out.withColumn("level", (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after))
    open_ = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = F.min(F.when(F.col("level") < F.col("ratio"), F.struct("ratio", "level"))).over(open_)["level"]
    target = F.when(level.isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), level * F.col("weight")))
    return out.select("source", "source_size", "weight", target.alias("target"))


def quotas(sources: DataFrame, block_words: int, most: float = 2.0) -> DataFrame:
    """sources(source, source_size, target), a row each: adds quota, whole blocks by highest quotients; no more than `most` times the source's blocks.

    Ties go to the earlier source, null last. Seats that a source at its cap can't take go to the next quotients of others.
    """
    every = Window.partitionBy()
    seats = F.floor(F.sum("target").over(every) / block_words + 0.5)
    cap = (F.ceil(F.col("source_size") / block_words) * most).cast("long")
    out = sources.withColumn("total", F.sum("target").over(every)).withColumn("n", F.count("*").over(every)).withColumn("seats", seats).withColumn("cap", cap)
    near = lambda shift: F.coalesce(F.floor(F.try_divide(F.col("target") * (F.col("seats") + shift * F.col("n")), F.col("total")) + 0.5), F.lit(0))
    out = out.withColumn("low", F.greatest(F.lit(0), F.least(near(-0.5) - 1, F.col("cap"))).cast("long")).withColumn("high", F.least(near(1.5) + 1, F.col("cap")).cast("long"))
    out = out.withColumn("left", F.col("seats") - F.sum("low").over(every))
    doubtful = out.where("high > low").select("source", "target", "left", F.explode(F.sequence(F.col("low") + 1, F.col("high"))).alias("k"))
    ranked = doubtful.withColumn("place", F.row_number().over(Window.orderBy(F.desc(F.col("target") / (2 * F.col("k") - 1)), F.col("source").asc_nulls_last(), "k")))
    more = ranked.where("place <= left").groupBy("source").agg(F.count("*").alias("more")).withColumnRenamed("source", "source_")
    joined = out.join(more, out["source"].eqNullSafe(more["source_"]), "left")
    return joined.select("source", "source_size", "target", (F.col("low") + F.coalesce("more", F.lit(0))).alias("quota"))


def shard_quotas(parts: DataFrame, whole: DataFrame, block_words: int, most: float = 2.0) -> DataFrame:
    """parts(shard, source, words) with the share of the source's quota that falls to its words: whole(source, source_size, target, quota).

    No more than `most` times the shard's blocks; a source at its cap can lose a block or two of the corpus by that, as its last block is short.
    """
    w = whole.withColumnRenamed("source", "source_").withColumnRenamed("quota", "all")
    named = parts.join(w, F.col("source").eqNullSafe(F.col("source_"))).drop("source_")
    along = Window.partitionBy("source").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    upto = lambda words: F.floor(F.col("all") * F.coalesce(F.try_divide(words.cast("double"), F.col("source_size")), F.lit(0.0)) + 0.5)
    named = named.withColumn("upto", F.sum("words").over(along))
    quota = F.least(upto(F.col("upto")) - upto(F.col("upto") - F.col("words")), F.ceil(F.col("words") / block_words) * most).cast("long")
    return named.select("shard", "source", "words", "source_size", "target", quota.alias("quota"))


def _overlap(low: Column, high: Column) -> Column:
    return F.struct(F.greatest("start", low).alias("from"), F.least("stop", high).alias("to"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0, block_words: int = 16, shard_words: int = 1 << 20, seed: int = 11, keep_row: bool = False) -> DataFrame:
    """doc_id, size, source_size, target, taken, shard, passes and spans for every row of docs (and `row`, a struct of it, if asked).

    size: words of the text, null none. passes: whole times the document is taken; spans: word ranges taken once more. taken is
    their sum of words and at most `most` times size. Null sources are one source, last. Repeated rows are rows of their own;
    rows without words take nothing. An empty table gives an empty result.
    """
    row = [F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row")] if keep_row else []
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.size(words(F.col(text_col))).cast("long").alias("size"), F.xxhash64(text_col).alias("tie"), *row)
    rows = rows.withColumn("order", _draw(F.lit(seed), F.col("doc_id"), F.col("size")))
    sizes = written(rows.drop("row"), "sizes")
    total = sizes.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    shards = max(1, -(-total // shard_words))
    shard = F.pmod("order", F.lit(shards)).cast("int")
    rows = (rows if keep_row else sizes).withColumn("shard", shard)
    parts = written(sizes.groupBy(shard.alias("shard"), "source").agg(F.sum("size").alias("words")), "parts")
    whole = targets(parts.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, most)
    plan = shard_quotas(parts, quotas(whole, block_words, most), block_words, most)
    blocks = F.ceil(F.col("words") / block_words).cast("long")
    plan = plan.withColumn("blocks", blocks).withColumn("passes", F.coalesce(F.expr("quota div nullif(blocks, 0)"), F.lit(0).cast("long"))).withColumn("run", F.col("quota") - F.col("passes") * F.col("blocks"))
    plan = plan.withColumn("begin", F.pmod(_draw(F.lit(seed), F.lit("begin"), F.col("shard"), F.col("source")), F.greatest("blocks", F.lit(1).cast("long"))))
    facts = written(plan.select(F.col("shard").alias("shard_"), F.col("source").alias("source_"), "source_size", "target", "blocks", "passes", "run", "begin"), "quotas")

    along = Window.partitionBy("shard", "source").orderBy("order", "doc_id", "size", "tie").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("stop", F.sum("size").over(along)).withColumn("start", F.col("stop") - F.col("size"))
    rows = rows.join(facts, (F.col("shard") == F.col("shard_")) & F.col("source").eqNullSafe(F.col("source_")))
    begin, end = F.col("begin"), F.col("begin") + F.col("run")
    ranges = F.array(_overlap(F.lit(0).cast("long"), (end - F.col("blocks")) * block_words), _overlap(begin * block_words, end * block_words))
    spans = F.transform(F.filter(ranges, lambda s: s["to"] > s["from"]), lambda s: F.struct((s["from"] - F.col("start")).alias("from"), (s["to"] - F.col("start")).alias("to")))
    taken = F.col("passes") * F.col("size") + F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["to"] - s["from"])
    rows = rows.withColumn("spans", spans)
    return rows.select("doc_id", "size", "source_size", "target", taken.alias("taken"), "shard", F.col("passes").cast("int").alias("passes"), "spans", *(["row"] if keep_row else []))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The mix as documents: a row for each whole pass, and one for the words taken once more (text cut at words, n_chars anew)."""
    taken = mix(docs, id_col, text_col, source_col, keep_row=True, **how)
    piece = F.split(F.col("row")[text_col], r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    part = F.array_join(F.transform("spans", lambda s: F.array_join(F.slice(piece, (s["from"] + 1).cast("int"), (s["to"] - s["from"]).cast("int")), "")), "\n")
    once = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["to"] - s["from"])
    copies = taken.withColumn("once", once).withColumn("copy", F.explode(F.filter(F.sequence(F.lit(0), F.col("passes")), lambda k: (k < F.col("passes")) | (F.col("once") > 0))))
    cut = (F.col("copy") == F.col("passes")) & (F.col("once") < F.col("size"))
    text = F.when(cut, part).otherwise(F.col("row")[text_col])
    out = [text.alias(c) if c == text_col else F.when(cut, F.length(part).cast("long")).otherwise(F.col("row")[c]).alias(c) if c == "n_chars" else F.col("row")[c].alias(c) for c in docs.columns]
    return copies.select(*out)
