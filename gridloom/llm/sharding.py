"""Two-pass external shuffle into shards that keep to a consistent key law.

Pass one scatters whole rows by seeded hashes: the shard is the one whose hash with the id is greatest (so one more shard takes rows only
into itself), and within it the bucket is another hash modulo a bucket count that follows the bytes and rows of the table, so that a bucket
fits in a task's memory. Pass two shuffles each bucket by Fisher-Yates, its draws being hashes of (seed, shard, bucket, chunk, step), and writes
it; running sums over the buckets' counts give gapless slots. The rows move once, to their bucket. All draws are hashes: a retried task
repeats them. A bucket that repeated rows make larger than planned is shuffled in chunks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import without, written

OUT = ["size", "text_crc32", "law", "shard", "slot", "grown_shard"]


def _draw(*parts: Column) -> Column:
    """60 bits of an MD5 over the parts, as a number."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *(F.coalesce(p.cast("string"), F.lit("null")) for p in parts)).cast("binary")), 1, 15), 16, 10).cast("long")


def key_shard(key: Column, shards: int, seed: int = 7) -> Column:
    """Rendezvous hashing: the shard of 0..shards-1 with the greatest draw for the key."""
    drawn = [F.struct(_draw(F.lit(seed), key, F.lit(s)).alias("d"), F.lit(s).alias("s")) for s in range(shards)]
    return (F.greatest(*drawn) if shards > 1 else drawn[0])["s"]


def _permutation(n: Column, *of: Column) -> Column:
    """Fisher-Yates over 0..n-1: for i = n-1 .. 1, swap place i with place draw(i) mod (i+1).

    Arrays are immutable, so the places are kept in about sqrt(n) pieces of which a swap makes at most two anew.
    """
    down = F.when(n > 1, F.sequence(n - 1, F.lit(1), F.lit(-1))).otherwise(F.array().cast("array<int>"))
    swaps = F.transform(down, lambda i: F.struct(i.alias("i"), F.pmod(_draw(*of, i), i + 1).cast("int").alias("j")))
    width = F.ceil(F.sqrt(n)).cast("int")
    piece = lambda x: F.floor(x / width).cast("int")
    whole = F.transform(F.sequence(F.lit(0), piece(n - 1)), lambda k: F.sequence(k * width, F.least(n, (k + 1) * width) - 1))

    def swap(perm: Column, s: Column) -> Column:
        at = lambda x: F.get(F.get(perm, piece(x)), x % width)
        a, b = at(s["i"]), at(s["j"])
        anew = lambda p, k: F.transform(p, lambda x: F.when(x == a, b).when(x == b, a).otherwise(x))
        return F.transform(perm, lambda p, k: F.when((k == piece(s["i"])) | (k == piece(s["j"])), anew(p, k)).otherwise(p))

    return F.flatten(F.aggregate(swaps, whole, swap))


def shard_documents(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text", seed: int = 7, bucket_bytes: int = 32 << 20, bucket_rows: int = 1 << 14) -> DataFrame:
    """docs with size, text_crc32, law ('key'), shard, slot and grown_shard; input columns of those names are replaced.

    size: UTF-8 bytes of the text and 1; null counts as empty. slot: gapless from 0 in each shard. A bucket holds about bucket_bytes of
    text and bucket_rows rows at most; texts longer than that are a row like any other. Null ids are one key, which makes their shard large but nothing
    else. Repeated rows keep as many slots as they are. An empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = without(docs, OUT)
    kept = [c for c in docs.columns if c.lower() not in OUT]
    key = F.col("row")[id_col] if id_col in kept else F.lit(None)
    n, size = docs.agg(F.count("*"), F.coalesce(F.sum(F.octet_length(text) + 1), F.lit(0))).first()
    buckets = max(1, -(-size // (shards * bucket_bytes)), -(-n // (shards * bucket_rows)))
    rows = docs.select(F.struct(*own).alias("row"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    rows = rows.withColumn("shard", key_shard(key, shards, seed)).withColumn("grown_shard", key_shard(key, shards + 1, seed))
    rows = rows.withColumn("bucket", F.pmod(_draw(F.lit(seed), F.lit("bucket"), key, F.col("size"), F.col("text_crc32")), F.lit(buckets)).cast("int"))

    held = written(rows.groupBy("shard", "bucket").agg(F.count("*").alias("n")), "buckets")
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = held.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0).cast("long")).alias("base"))
    chunk = 2 * bucket_rows
    length = lambda c: F.least(F.lit(chunk).cast("long"), F.col("n") - c * chunk).cast("int")
    chunks = F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / chunk).cast("long"))
    perms = held.repartition("shard", "bucket").select("shard", "bucket", F.transform(chunks, lambda c: _permutation(length(c), F.lit(seed), F.col("shard"), F.col("bucket"), c)).alias("perms"))
    in_bucket = Window.partitionBy("shard", "bucket").orderBy(key, "size", "text_crc32", F.xxhash64("row"))
    placed = rows.withColumn("rank", F.row_number().over(in_bucket) - 1).join(perms.hint("merge"), ["shard", "bucket"]).join(base.hint("merge"), ["shard", "bucket"])
    at = F.floor(F.col("rank") / chunk).cast("long")
    slot = F.col("base") + at * chunk + F.get(F.get("perms", at.cast("int")), (F.col("rank") % chunk).cast("int"))
    return placed.select(*(F.col("row")[c].alias(c) for c in kept), "size", "text_crc32", F.lit("key").alias("law"), "shard", slot.alias("slot"), "grown_shard")


def write_shards(docs: DataFrame, path: str, **how) -> None:
    """Whole rows of shard_documents as files: a folder a shard, rows of a file in slot order. size and text_crc32 are left to the reader."""
    shard_documents(docs, **how).drop("size", "text_crc32").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def read_shards(spark: SparkSession, path: str, schema, text_col: str = "text") -> DataFrame:
    """Rows of written shards, with size and text_crc32 of the text as stored; schema: that of the documents."""
    placed = T.StructType([f for f in schema.fields if f.name.lower() not in OUT]).add("law", "string").add("slot", "long").add("grown_shard", "integer").add("shard", "integer")
    text = F.coalesce(F.col(text_col), F.lit(""))
    return spark.read.schema(placed).parquet(path).withColumns({"size": (F.octet_length(text) + 1).cast("long"), "text_crc32": F.crc32(text.cast("binary"))})
