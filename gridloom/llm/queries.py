"""Queries of the training-data operators over the given tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import centroids, chat, decontaminate, fim, langid, line_dedup, mixing, quality, repeats, sharding, simhash, token_store, warc
from .common import new_path
from .sql import SQL  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "warc")
    warc.write_archive(table(spark, sf_dir, "pages"), path, least_bytes=0)
    return warc.read_archive(spark, path).drop("target_uri")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_equal", "n_near", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("kept_md5"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.drop("text")


def op6_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = new_path(spark, "tokens")
    token_store.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return token_store.read_tokens(spark, path)


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    turns = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    path = new_path(spark, "chat")
    chat.format_conversations(turns.unionByName(extra)).write.parquet(path)
    return chat.digests(spark.read.schema(chat.FORMATTED).parquet(path))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_leaks(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.item_id", "leak.similarity", "leak.start", "leak.words")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = table(spark, sf_dir, "documents"), new_path(spark, "shards")
    sharding.write_shards(docs, path)
    out = sharding.read_shards(spark, path, docs.schema)
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.where(~langid.held_out(F.col("doc_id"))))
    return langid.identify(docs.select("doc_id", "text"), model).select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op11_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repeats.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["size"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    state, final = centroids.cluster_vectors(table(spark, sf_dir, "embeddings"))
    facts = centroids.cluster_facts(state, final).withColumn("centroid_sha256", F.sha2(centroids.spelled(F.col("centroid")).cast("binary"), 256)).drop("centroid")
    return state.select("vec_id", "cluster", "distance").join(facts, "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op13_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fim.fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text", "pieces")
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", F.sha2(fim.restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"))


QUERIES = {f.__name__: f for f in (op1_warc, op2_mixing, op3_simhash, op4_line_dedup, op5_quality, op6_tokens, op7_chat, op8_decontaminate, op9_sharding, op10_langid, op11_repeats, op12_centroids, op13_fim)}

