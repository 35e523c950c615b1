"""The pipeline's near duplicates against all pairs of shingle sets."""

import glob
import itertools
import random
import time

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gridloom.llm import similar, simhash


def groups_expected(given, size=5):
    sets, root = {}, {}
    for i, text in given:
        w = (text or "").lower().split()
        sets[i] = {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()
        root[i] = i

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        if sets[a] == sets[b] or 9 * len(sets[a] & sets[b]) >= 4 * (len(sets[a]) + len(sets[b])):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return {i: find(i) for i in root}


def family(rng, n, words, edits):
    base = [f"w{rng.randrange(900)}" for _ in range(words)]
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randrange(edits + 1)):
            own[rng.randrange(words)] = f"x{rng.randrange(900)}"
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("dense", [32, 8, 2])
def test_groups(spark, dense):
    rng = random.Random(5)
    texts = [None, "", " \t", "a", "A", "a b c", *family(rng, 25, 60, 3), *family(rng, 25, 120, 9), *family(rng, 8, 9, 1), *family(rng, 90, 200, 12)]
    given = list(enumerate(texts))
    found = similar.similar_groups(spark.createDataFrame(given, "doc_id long, text string").repartition(3), dense=dense).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == groups_expected(given)


def test_many_keys(spark):
    """Long texts alike, of which each has far more keys than rows carry."""
    rng = random.Random(9)
    texts = family(rng, 40, 1500, 260)
    given = list(enumerate(texts))
    found = similar.similar_groups(spark.createDataFrame(given, "doc_id long, text string").repartition(3), dense=2).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == groups_expected(given)


def test_stage_on_tables(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    expected = groups_expected([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    kept = corpus_pipeline.near_duplicates(spark, docs, sf)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(expected.values()))
    assert similar.keep_first(docs.where("false")).count() == 0


def test_repeated_ids(spark):
    given = [(1, "alpha beta gamma delta"), (1, "wholly other words stand here now"), (1, "wholly other words stand here now"), (None, "no id"), (None, "no id"), (2, "alpha beta gamma delta")]
    kept = similar.keep_first(spark.createDataFrame(given, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept) == [(0, "no id"), (0, "no id"), (1, "alpha beta gamma delta"), (1, "wholly other words stand here now")]


def test_ring(spark):
    """The ring and Hamming check against the plain distance: chains lose no pair."""
    rng = random.Random(7)
    pairs = []
    for _ in range(3000):
        a = rng.getrandbits(64)
        b = a
        for i in rng.sample(range(64), rng.randrange(40)):
            b ^= 1 << i
        pairs.append((a - (1 << 63), b - (1 << 63)))
    got = spark.createDataFrame(pairs, "a long, b long").select("a", "b", simhash.within_ring(F.col("a"), F.col("b"), similar.RADIUS).alias("near")).collect()
    assert [r["near"] for r in got] == [((r["a"] ^ r["b"]) & (2**64 - 1)).bit_count() <= similar.RADIUS for r in got]


def test_pairs_of_a_family(spark, monkeypatch):
    """A family of which many members are pairwise under 0.8: pairs are listed for hubs alone, so they follow its size and not its square."""
    rng, listed, compared = random.Random(11), [], similar._compared
    texts = family(rng, 150, 200, 24)
    given = list(enumerate(texts))

    def counted(pairs, nodes, sets):
        listed.append(pairs.distinct().count())
        return compared(pairs, nodes, sets)

    monkeypatch.setattr(similar, "_compared", counted)
    found = similar.similar_groups(spark.createDataFrame(given, "doc_id long, text string").repartition(3), dense=8).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == groups_expected(given)
    # Those of keys with few members and of three hubs; what the hubs leave over is compared without a list.
    assert len(listed) <= 4 and sum(listed) < 20 * len(texts), listed


def test_pairs_by_chance(spark, monkeypatch):
    """Texts that share a run of words and no more: a pair is compared only if the keys that it shares may be enough."""
    rng, listed, compared = random.Random(3), [], similar._compared
    line = lambda i: " ".join(f"l{i}x{k}" for k in range(12))
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(40)) + f" {line(i // 2)}" for i in range(200)] + family(rng, 6, 60, 2)
    given = list(enumerate(texts))

    def counted(pairs, nodes, sets):
        listed.append((pairs.distinct().count(), sets.count()))
        return compared(pairs, nodes, sets)

    monkeypatch.setattr(similar, "_compared", counted)
    found = similar.similar_groups(spark.createDataFrame(given, "doc_id long, text string").repartition(3)).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == groups_expected(given)
    assert len(listed) == 1 and listed[0][0] <= 15 and listed[0][1] <= 6, listed


def test_far_fingerprints(spark):
    """Similar texts whose fingerprints are outside the radius are linked as well."""
    lines = [
        "w778150 w472420 w173432 w622206 w617256 w391258 w54088 w881562 w761160",
        "w129273 w962266 w167661 w10347 w914682 w824488 w807165 w537155 w918136",
    ]
    given = list(enumerate(t for line in lines for t in (line, line.rpartition(" ")[0])))
    prints = [simhash.majority(similar.shingles(t)) for _, t in given]
    assert [(prints[i] ^ prints[i + 1]).bit_count() for i in (0, 2)] == [26, 27] and similar.RADIUS < 26
    found = similar.similar_groups(spark.createDataFrame(given, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == groups_expected(given) == {0: 0, 1: 0, 2: 2, 3: 2}


def test_shuffle_files_go(spark, sf):
    """What a query shuffled is gone when the next begins, so the disk doesn't hold all of them."""
    folders = [f.getPath() for f in spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirs()]
    there = lambda: {p for d in folders for p in glob.glob(f"{d}/*/shuffle_*.data")}
    before = there()
    similar.keep_first(spark.read.parquet(f"{sf}/documents.parquet"))
    ends = time.time() + 10
    while there() - before and time.time() < ends:
        time.sleep(0.2)
    assert not there() - before
