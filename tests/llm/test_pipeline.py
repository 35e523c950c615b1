"""The pipeline's stages: what they keep, and that each works on what the last one left."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import __spark_entry__
from gridloom.llm import decontaminate, queries, sharding

from .test_operators import DOCS, HARD, leaks_expected, rows, target_expected, words, words_of_letters
from .test_similar import groups_expected


@pytest.fixture(scope="module")
def hard(spark):
    return spark.createDataFrame([(*r, "x", "y", "z", "w", "v") for r in HARD], DOCS)


def test_registered():
    names = set(__spark_entry__.queries())
    assert {f"op{n}" for n in range(1, 11)} <= {n.split("_")[0] for n in names} and "pipeline" in names
    assert set(__spark_entry__.oracle_sql()) <= names
    assert all("documents" in sql or "pages" in sql or "embeddings" in sql for sql in queries.SQL.values())


def keys(df):
    return Counter((r["doc_id"], r["text"]) for r in rows(df))


def test_language_id(spark, sf, hard):
    docs = queries.table(spark, sf, "documents")
    kept = corpus_pipeline.language_id(spark, docs, sf)
    assert kept.columns == docs.columns and kept.count() >= 0.95 * docs.count()
    odd = corpus_pipeline.language_id(spark, hard, sf)
    assert odd.columns == hard.columns and not keys(odd) - keys(hard)
    assert all(words_of_letters(t) for _, t in keys(odd)) and keys(odd)[6, HARD[5][1]] == 2
    assert corpus_pipeline.language_id(spark, hard.where("false"), sf).count() == 0


def test_near_duplicates(spark, sf, hard):
    kept = corpus_pipeline.near_duplicates(spark, hard, sf)
    given = [(r[0], r[1]) for r in HARD if r[0] is not None]
    assert kept.columns == hard.columns
    assert keys(kept) == Counter({(i, t): 1 for i, t in given if groups_expected(given)[i] == i} | {(None, HARD[8][1]): 1})
    assert corpus_pipeline.near_duplicates(spark, hard.where("false"), sf).count() == 0


def test_benchmark_leaks(spark, sf, hard):
    items = rows(queries.table(spark, sf, "benchmark"))
    docs = queries.table(spark, sf, "documents").where("length(text) < 4000").limit(120)
    for table in (docs, hard, hard.where("false")):
        leaks = {i for i, _ in leaks_expected(rows(table), items)}
        clean = corpus_pipeline.benchmark_leaks(spark, table, sf)
        assert clean.columns == table.columns
        assert Counter(r["doc_id"] for r in rows(clean)) == Counter(r["doc_id"] for r in rows(table) if r["doc_id"] not in leaks)
    all_docs = queries.table(spark, sf, "documents")
    leaks = {r["doc_id"] for r in decontaminate.find_leaks(all_docs, queries.table(spark, sf, "benchmark")).where("size(leaks) > 0").collect()}
    assert leaks and Counter(r["doc_id"] for r in rows(corpus_pipeline.benchmark_leaks(spark, all_docs, sf))) == Counter(r["doc_id"] for r in rows(all_docs) if r["doc_id"] not in leaks)


def test_mix(spark, sf, hard):
    for table in (queries.table(spark, sf, "documents"), hard, hard.where("false")):
        made = corpus_pipeline.mix_sources(spark, table, sf)
        sizes, taken, longest = Counter(), Counter(), Counter()
        for r in rows(table):
            sizes[r["source"]] += len(words(r["text"]))
            longest[r["doc_id"]] += 2 * len(words(r["text"]))
        for r in rows(made):
            taken[r["source"]] += len(words(r["text"]))
            longest[r["doc_id"]] -= len(words(r["text"]))
        assert made.columns == table.columns and min(longest.values(), default=0) >= 0
        assert all(abs(taken[s] - t) <= 32 for s, t in target_expected(sizes).items()) if sizes else not taken


def test_shard(spark, sf, hard):
    for table in (queries.table(spark, sf, "documents"), hard, hard.where("false")):
        out = rows(corpus_pipeline.shards(spark, table, sf))
        kept = [c for c in table.columns if c not in sharding.OUT]
        assert Counter(tuple(r[c] for c in kept) for r in out) == Counter(tuple(r[c] for c in kept) for r in rows(table))
        for s in {r["shard"] for r in out}:
            own = sorted(r["slot"] for r in out if r["shard"] == s)
            assert own == list(range(len(own)))


#: Names that stages use themselves.
CLASHING = ["score", "level", "foreign", "lang_pred", "leaks", "__id", "__mark", "__h1", "__h2", "__leaks", "c0", "row", "spans", "id", "node", "passes", "copy", "once"]


def test_clashing_names(spark, sf):
    """Whole rows come out as they went in, whatever their columns are called."""
    few = queries.table(spark, sf, "documents").where("length(text) < 3000")
    docs = few.withColumns({c: F.concat(F.lit(f"{c} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))) for c in CLASHING})
    given = {tuple(r) for r in docs.collect()}
    for stage in (corpus_pipeline.language_id, corpus_pipeline.near_duplicates, corpus_pipeline.benchmark_leaks):
        kept = stage(spark, docs, sf)
        assert kept.columns == docs.columns
        found = [tuple(r) for r in kept.collect()]
        assert len(found) > 100 and set(found) <= given and len(set(found)) == len(found)
    mixed = corpus_pipeline.mix_sources(spark, docs, sf)
    own = [c for c in docs.columns if c not in ("text", "n_chars")]
    assert mixed.columns == docs.columns and {tuple(r[c] for c in own) for r in mixed.collect()} <= {tuple(r[docs.columns.index(c)] for c in own) for r in given}
    sharded = corpus_pipeline.shards(spark, docs.withColumns({"slot": F.lit("mine"), "size": F.lit("mine")}), sf)
    assert len(sharded.columns) == len(docs.columns) + len(sharding.OUT)
    assert {tuple(r[c] for c in docs.columns) for r in sharded.collect()} == given and dict(sharded.dtypes)["slot"] == "bigint" and "size" in sharded.columns


def test_run(spark, sf):
    out = corpus_pipeline.run(spark, sf).collect()
    slots = Counter((r["shard"], r["slot"]) for r in out)
    assert out and max(slots.values()) == 1
