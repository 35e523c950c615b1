"""Centroid clustering against brute force, and its bounds against full drift."""

import hashlib
import math

import numpy as np
import pytest

from gridloom.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, cluster string, distance string, vec string"


def expected(vectors, k, rounds, seed):
    """vectors: (id, whole numbers). Plain k-means in whole numbers of any size."""
    order = sorted(vectors, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    c = [list(v) for _, v in order[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, x)), j) for j, x in enumerate(c))
    for _ in range(rounds):
        own = [near(v)[1] for _, v in vectors]
        for j in range(len(c)):
            held = [v for (_, v), o in zip(vectors, own) if o == j]
            if held:
                c[j] = [math.floor(sum(x) / len(held)) if abs(sum(x)) < 1 << 50 else sum(x) // len(held) for x in zip(*held)]
    return sorted((-1 if i is None else i, near(v)[1], near(v)[0]) for i, v in vectors), c


def check(spark, given, k, rounds, dim, seed=3):
    kept = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in given if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    df = spark.createDataFrame([(i, v, "x", "y", "z") for i, v in given], SCHEMA).repartition(3)
    state, final = centroids.cluster_vectors(df, k, rounds, seed, dim=dim)
    got = state.collect()
    want, c = expected(kept, k, rounds, seed)
    assert sorted((-1 if r["vec_id"] is None else r["vec_id"], r["cluster"], r["distance"]) for r in got) == want
    assert final.tolist() == c
    facts = centroids.cluster_facts(state, final).collect()
    assert sum(r["cluster_inertia"] for r in facts) == sum(d for *_, d in want) and {r["inertia"] for r in facts} <= {sum(d for *_, d in want)}
    return got


@pytest.mark.parametrize("k, rounds", [(1, 2), (4, 6), (7, 10)])
def test_against_brute_force(spark, k, rounds):
    rng = np.random.default_rng(k)
    middles = rng.normal(size=(5, 6))
    given = [(i, (middles[i % 5] + 0.2 * rng.normal(size=6)).tolist()) for i in range(400)]
    got = check(spark, given, k, rounds, 6)
    assert k < 4 or sum(r["scanned"] for r in got) < len(got)


def test_hard_cases(spark):
    """Nulls, wrong lengths, infinities, ties, repeated rows and ids, fewer vectors than clusters, large components, columns of the added names."""
    odd = [(1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 0.0]), (5, [1.0]), (6, [1.0, 2.0, 3.0]), (None, [0.5, 0.5]), (7, [0.5, 0.5]), (7, [0.5, 0.5]), (8, [-0.5, -0.5]), (9, [0.0, 0.0]), (10, [-1e-9, 130000.0])]
    for k in (2, 3, 8):
        check(spark, odd, k, 4, 2)
    check(spark, [(i, [1.0, -1.0]) for i in range(50)] + [(99, [1.5, -1.0])], 3, 3, 2)
    state, final = centroids.cluster_vectors(spark.createDataFrame([], SCHEMA))
    assert state.collect() == [] and len(final) == 0 and centroids.cluster_facts(state, final).collect() == []
    far = spark.createDataFrame([(1, [1e6, 0.0], "", "", "")], SCHEMA)
    with pytest.raises(Exception, match="squared distances would not fit"):
        centroids.cluster_vectors(far, dim=2)


def test_query(spark, sf):
    """The registered query against whole-number brute force over the whole table."""
    from gridloom.llm import queries

    table = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    want, c = expected([(r["vec_id"], [math.floor(1024 * x) for x in r["embedding"]]) for r in table], 8, 10, 3)
    got = queries.op12_centroids(spark, sf).collect()
    assert sorted((r["vec_id"], r["cluster"], r["distance"]) for r in got) == want
    for r in got:
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, c[r["cluster"]])).encode()).hexdigest()
        assert r["cluster_inertia"] == sum(d for _, j, d in want if j == r["cluster"]) and r["inertia"] == sum(d for *_, d in want)


def test_loosening_holds_and_is_less_than_full_drift():
    """No vector of a sphere comes nearer to a moved centroid than its bound says, and the bound is mostly below the longest move."""
    rng, less = np.random.default_rng(0), 0
    for _ in range(300):
        k, dim = int(rng.integers(2, 6)), int(rng.integers(1, 5))
        old = rng.integers(-50, 50, size=(k, dim))
        new = old + rng.integers(-9, 9, size=(k, dim)) * (rng.random((k, 1)) < 0.8)
        radius = np.where(rng.random(k) < 0.2, -1.0, rng.random(k) * 30)
        bound = centroids.loosening(old, new, radius)
        for i in np.flatnonzero(radius >= 0):
            way = rng.normal(size=(200, dim))
            x = old[i] + way / np.linalg.norm(way, axis=1)[:, None] * radius[i] * rng.random((200, 1)) ** (1 / 4)
            others = [j for j in range(k) if j != i]
            nearer = max((np.linalg.norm(x - old[j], axis=1) - np.linalg.norm(x - new[j], axis=1)).max() for j in others)
            full = max(np.linalg.norm(new[j] - old[j]) for j in others)
            assert nearer <= bound[i] + 1e-9
            assert bound[i] <= full * (1 + 1e-6) + 1e-6
            less += bound[i] < 0.9 * full
    assert less > 200
