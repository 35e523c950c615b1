"""Centroid clustering of integer vectors, with bounds loosened by geometric drift.

Every vector keeps its cluster, the exact squared distance to its centroid and a lower bound on the distance to any other. When centroids move, the bound
of the vectors of cluster i has to be loosened. Full drift would take off the longest move of another centroid. But all vectors of i lie in a sphere around its
old centroid, and seen from there a move c -> c' brings c' nearer by less. In the plane through the sphere's middle and the line of the move, with the origin
halfway of it, |x-c| - |x-c'| = 4hs / (|x-c| + |x-c'|) for half the move h and a place x at s along the line; the sum below is at least 2 max(h, |x|), so
the move brings c' nearer by 2h cos(angle of x) at most, by 2s at most, and by 2h at most. Over the sphere the least angle is that of its middle less
the angle under which the origin sees its radius, and the greatest s is that of its middle and its radius.

Vectors whose distance to their own centroid, computed anew and exactly, stays under the loosened bound keep their cluster; the others are ambiguous and are compared
with all centroids, in whole numbers. A round is one pass over the vectors without a shuffle; what is gathered is a sum a cluster.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import new_path, removed

#: Components of this size and more could give squared distances beyond 64 bits.
MOST = 1 << 27
#: What a comparison of rounded lengths leaves room for, relative to them.
_SLACK = 1e-9
_STATE = "vec_id long, vec array<int>, cluster int, was int, distance long, other double, scanned boolean"


def whole_vectors(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", dim: int = 64, scale: int = 1024) -> DataFrame:
    """(vec_id, vec array<int>): floor(scale * x) of the vectors with exactly dim components, none null, NaN or infinite; the rest are left out.

    Components beyond 2^27 after scaling stop the job, as their distances don't fit in 64 bits. Null ids and repeated rows stay. Other columns are ignored.
    """
    vec = F.col(vec_col).cast("array<double>")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    kept = table.where((F.size(vec) == dim) & ~F.exists(vec, bad))
    far = F.raise_error(F.lit(f"a component of {MOST} or more after scaling: squared distances would not fit in 64 bits")).cast("int")
    whole = lambda x: F.when(F.abs(x * scale) < MOST, F.floor(x * scale).cast("int")).otherwise(far)
    return kept.select(F.col(id_col).cast("long").alias("vec_id"), F.transform(vec, whole).alias("vec"))


def first_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors whose ids' sha256("seed:id") are smallest, in that order; repeated ids by their components. Fewer vectors: all of them."""
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    return np.array([r["vec"] for r in vectors.orderBy(draw, "vec").limit(k).collect()], np.int64)


def loosening(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """For each cluster the most by which the distance from one of its vectors to any other centroid has shrunk. radius: of its sphere around old, or negative without vectors."""
    out = np.zeros(len(old))
    moves, middles = (new - old).astype(float), (new + old) / 2.0
    full = np.sqrt((moves**2).sum(1))
    moved = np.flatnonzero(full > 0)
    for i in np.flatnonzero(radius >= 0):
        j = moved[moved != i]
        if not len(j):
            continue
        h, p = full[j] / 2, old[i] - middles[j]
        along, away = (p * moves[j]).sum(1) / full[j], np.sqrt((p**2).sum(1))
        angle = np.arccos(np.clip(np.divide(along, away, out=np.ones_like(away), where=away > 0), -1, 1))
        seen = np.where(radius[i] < away, np.arcsin(np.clip(np.divide(radius[i], away, out=np.ones_like(away), where=away > 0), 0, 1)), np.pi)
        nearer = np.minimum(2 * h * np.cos(np.clip(angle - seen, 0, np.pi / 2)), np.maximum(0, 2 * (along + radius[i])))
        out[i] = max(0.0, np.minimum(nearer, 2 * h).max()) * (1 + _SLACK) + _SLACK * (1 + away.max())
    return out


def squared(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances, vectors by centroids. Floats hold them exactly where components are small, and 64-bit whole numbers elsewhere."""
    if max(np.abs(vectors).max(initial=0), np.abs(centroids).max(initial=0)) ** 2 * vectors.shape[1] < 1 << 50:
        v, c = vectors.astype(float), centroids.astype(float)
        return np.rint((v**2).sum(1)[:, None] - 2 * (v @ c.T) + (c**2).sum(1)).astype(np.int64)
    return np.stack([((vectors - c) ** 2).sum(1) for c in centroids], axis=1)


def scan(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest centroid (ties: the smaller number), its squared distance, and the distance to the nearest other one."""
    d = squared(vectors, centroids)
    own, at = d.argmin(1), np.arange(len(d))
    least = d[at, own]
    d[at, own] = np.iinfo(np.int64).max
    return own.astype(np.int32), least, np.sqrt(d.min(1).astype(float))


def _matrix(column: pa.ListArray, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)


def _assigned(rows: DataFrame, centroids: np.ndarray, slack: np.ndarray | None) -> DataFrame:
    """The state of each vector under new centroids. slack: what its cluster's bound loses; None in the first round, where all are scanned."""
    dim, names = centroids.shape[1], [c.split()[0] for c in _STATE.replace("array<int>", "list").split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                b = whole.slice(at, 4096)
                v = _matrix(b.column(1), dim)
                if slack is None:
                    was = np.full(len(v), -1, np.int32)
                    cluster, distance, other, open_ = was.copy(), np.zeros(len(v), np.int64), np.zeros(len(v)), np.ones(len(v), bool)
                else:
                    was = b.column(2).to_numpy()
                    cluster = was.copy()
                    gone = v - centroids[was]
                    distance, other = (gone * gone).sum(1), b.column(3).to_numpy() - slack[was]
                    open_ = np.sqrt(distance.astype(float)) * (1 + _SLACK) >= other * (1 - _SLACK)
                if open_.any():
                    cluster[open_], distance[open_], found = scan(v[open_], centroids)
                    other = other.copy()
                    other[open_] = found
                arrays = [b.column(0), b.column(1), pa.array(cluster), pa.array(was), pa.array(distance), pa.array(other), pa.array(open_)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return rows.mapInArrow(run, _STATE)


def _gathered(state: DataFrame, centroids: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Adds to sums and counts, a cluster each, what moved vectors bring and takes off what they leave; returns the clusters' squared radii, -1 without vectors.

    Vectors that keep their cluster are only looked at for its radius. Tasks send one row a cluster at most.
    """
    k, dim = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        change, n = np.zeros((k, dim), np.int64), np.zeros(k, np.int64)
        for b in batches:
            v, now, was = _matrix(b.column(0), dim), b.column(1).to_numpy(), b.column(2).to_numpy()
            left = was >= 0
            np.add.at(change, now, v)
            np.subtract.at(change, was[left], v[left])
            n += np.bincount(now, minlength=k) - np.bincount(was[left], minlength=k)
        held = np.flatnonzero(change.any(1) | (n != 0)).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(n[held]), pa.array(list(change[held]), pa.list_(pa.int64()))], names=["cluster", "n", "change"])

    moved = state.where("cluster <> was").select("vec", "cluster", "was").mapInArrow(run, "cluster int, n long, change array<long>")
    parts = moved.select("cluster", "n", F.posexplode("change").alias("at", "x")).groupBy("cluster", "at").agg(F.sum("x").alias("x"), F.sum("n").alias("n"))
    for r in parts.collect():  # clusters times components
        sums[r["cluster"], r["at"]] += r["x"]
        if r["at"] == 0:
            counts[r["cluster"]] += r["n"]
    radius = np.full(k, -1, np.int64)
    for r in state.groupBy("cluster").agg(F.max("distance").alias("far")).collect():
        radius[r["cluster"]] = r["far"]
    return radius


def cluster_vectors(table: DataFrame, k: int = 8, rounds: int = 10, seed: int = 3, id_col: str = "vec_id", vec_col: str = "embedding", dim: int = 64, scale: int = 1024) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, vec, cluster, was, distance, other, scanned) of every kept vector, and the final centroids (k x dim whole numbers).

    Centroids start as first_centroids. Each round assigns every vector to its nearest centroid (squared distance; ties: the smaller number) and replaces each centroid that has
    vectors by the componentwise floor of their mean; at the end vectors are assigned once more. scanned tells which were ambiguous in that last pass. Fewer
    vectors than k: as many clusters. Repeated rows are vectors of their own, and so weigh more; of equal centroids the first gets the vectors and the others stay.
    Vectors that whole_vectors leaves out have no row; an empty table gives none. Each pass writes its state to the shared folder, reads only the one
    before it and takes that away when its own is whole: two are held at most.
    """
    spark = table.sparkSession
    vectors = whole_vectors(table, id_col, vec_col, dim, scale)
    centroids = first_centroids(vectors, k, seed).reshape(-1, dim)
    if not len(centroids):
        return spark.createDataFrame([], _STATE), centroids
    sums, counts = np.zeros_like(centroids), np.zeros(len(centroids), np.int64)
    rows, slack, before = vectors, None, None
    for step in range(rounds + 1):
        path = new_path(spark, "clusters")
        _assigned(rows, centroids, slack).write.parquet(path)
        if before:
            removed(spark, before)
        state, before = spark.read.schema(_STATE).parquet(path), path
        if step == rounds:
            break
        radius = _gathered(state, centroids, sums, counts)
        moved = np.where(counts[:, None] > 0, sums // np.maximum(counts, 1)[:, None], centroids)
        slack = loosening(centroids, moved, np.where(radius < 0, -1.0, np.sqrt(np.maximum(radius, 0).astype(float)) * (1 + _SLACK)))
        centroids, rows = moved, state.select("vec_id", "vec", "cluster", "other")
    return state, centroids


def cluster_facts(state: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(cluster, cluster_inertia, inertia, centroid): a row a cluster with vectors."""
    schema = "cluster int, cluster_inertia long, inertia long, centroid array<long>"
    held = [(r["cluster"], r["s"]) for r in state.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()]
    return state.sparkSession.createDataFrame([(c, s, sum(x for _, x in held), centroids[c].tolist()) for c, s in held], schema)


def spelled(centroid: Column) -> Column:
    """Components as decimal whole numbers with commas between."""
    return F.array_join(centroid.cast("array<string>"), ",")
