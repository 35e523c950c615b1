"""Near-duplicate documents by SimHash, linked with a pigeonring filter.

Method. A 64-bit fingerprint is cut into four 16-bit segments on a ring. Two fingerprints at most three bits apart have a segment
from which a walk round the ring keeps, after l segments, at most l*3/4 differing bits: 0, 1, 2 and 3. The first three budgets
become join keys: the first segment is equal, and of the four half segments that follow, two known ones are equal (one of the
second segment's, since it may hold a single difference). That makes 4 starts x 5 choices = 20 keys of 32 bits for a fingerprint,
and pairs that share a key pass the chain budgets before the full Hamming distance is taken.

Groups of copies. Copies share a fingerprint and are one node. A key held by more than `dense` fingerprints (a family of near
copies) is not expanded into pairs. Its fingerprints emit all variants at one and two bits instead: those within one bit of a
variant are within two of each other, those at two bits are within three of any of the former, so linking each to the smallest
of the former loses no connection and makes no pair lists.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ASCII_LOWER, written
from .graph import components

_ONE = 0xFFFF


def fingerprint(text: str | None, size: int = 3) -> int:
    """SimHash of the word shingles of text, unsigned. No words: 0. Fewer words than size: one shingle of them all."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").translate(ASCII_LOWER).split() if text else []
    if not words:
        return 0
    shingles = map(b" ".join, zip(*(words[i:] for i in range(size)))) if len(words) >= size else [b" ".join(words)]
    return majority(np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(42)), np.uint64))


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half the hashes."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 8192):
        bits = np.unpackbits(hashes[at : at + 8192].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """(id, fp BIGINT) for each row of docs; fp holds the 64 bits as a signed number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = np.fromiter((fingerprint(t.as_py(), size) for t in b.column(1)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found.view(np.int64))], names=["id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "id long, fp long")


def _segment(fp: Column, at: int) -> Column:
    return F.shiftrightunsigned(fp, 16 * (at % 4)).bitwiseAND(F.lit(_ONE).cast("long"))


def _keys(fp: Column) -> Column:
    """The 20 ring keys: start and choice above, 16 bits of the first segment and twice 8 of later halves below."""
    out = []
    for start in range(4):
        first = _segment(fp, start)
        halves = [p for at in (start + 1, start + 2) for p in (F.shiftright(_segment(fp, at), 8), _segment(fp, at).bitwiseAND(F.lit(255).cast("long")))]
        for choice, (i, j) in enumerate(((0, 1), (0, 2), (0, 3), (1, 2), (1, 3))):
            tag = (start * 5 + choice) << 32
            out.append(F.lit(tag).cast("long") + F.shiftleft(first, 16) + F.shiftleft(halves[i], 8) + halves[j])
    return F.array(*out)


def _differing(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def within_ring(a: Column, b: Column, radius: int, segments: int = 8) -> Column:
    """Whether two fingerprints differ in at most `radius` bits, by pigeonring: round the ring of equal segments there must be a start from
    which l consecutive ones differ in at most l * radius / segments bits, for every l. That is tested first, then the whole distance."""
    width = 64 // segments
    part = F.lit((1 << width) - 1).cast("long")
    away = [_differing(F.shiftrightunsigned(a, width * s).bitwiseAND(part), F.shiftrightunsigned(b, width * s).bitwiseAND(part)) for s in range(segments)]
    chains = F.lit(False)
    for s in range(segments):
        total, chain = F.lit(0), F.lit(True)
        for k in range(segments - 1):
            total = total + away[(s + k) % segments]
            chain = chain & (total <= (k + 1) * radius // segments)
        chains = chains | chain
    return chains & (_differing(a, b) <= radius)


def _chain(a: Column, b: Column, key: Column) -> Column:
    """The cumulative budgets of the chain at the key's start."""
    start = F.floor(F.shiftright(key, 32) / 5)
    passes = F.lit(False)
    for s in range(4):
        d = [_differing(_segment(a, s + k), _segment(b, s + k)) for k in range(3)]
        passes = passes | ((start == s) & (d[0] == 0) & (d[0] + d[1] <= 1) & (d[0] + d[1] + d[2] <= 2))
    return passes


def hamming_links(fps: DataFrame, radius: int = 3, dense: int = 64) -> DataFrame:
    """fps(fp), distinct: links (u, v), u > v, that connect fingerprints whose chains of links hold at most 3 differing bits.

    Every linked pair is returned, but within families denser than `dense` members a key, where enough links to keep everything
    connected are. radius is 3, for which the ring above is cut.
    """
    if radius != 3:
        raise ValueError("the ring is cut for a radius of 3")
    keyed = fps.select("fp", F.explode(_keys(F.col("fp"))).alias("key"))
    held = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    near = keyed.join(held, "key")
    few = near.where(F.col("n") <= dense)
    a, b = few.select("key", F.col("fp").alias("u")), few.select("key", F.col("fp").alias("v"))
    u, v = F.col("u"), F.col("v")
    pairs = a.join(b, "key").where((u > v) & _chain(u, v, F.col("key")) & (_differing(u, v) <= radius)).select("u", "v")

    many = near.where(F.col("n") > dense).select("fp").distinct()
    bits = [F.lit(1 << i if i < 63 else -(1 << 63)).cast("long") for i in range(64)]
    one = F.array(F.lit(0).cast("long"), *bits)
    near1 = many.select("fp", F.explode(one).alias("mask")).select("fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("variant"))
    centre = near1.groupBy("variant").agg(F.min("fp").alias("v"))
    two = many.select("fp", F.explode(F.array(*bits)).alias("x")).select("fp", "x", F.explode(F.array(*bits)).alias("y")).where("x > y")
    near2 = two.select("fp", F.col("fp").bitwiseXOR(F.col("x")).bitwiseXOR(F.col("y")).alias("variant"))
    spokes = near1.union(near2).join(centre, "variant").where("fp <> v").select(F.col("fp").alias("u"), "v")
    return pairs.union(spokes).distinct()


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, dense: int = 64) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of docs.

    fingerprint: 16 hexadecimal digits. component_id: the smallest id reachable over links of at most three differing bits,
    the row's own included; null ids don't count, and a component without any other id has null. Null, empty and blank texts
    have fingerprint zero and are linked like any other. Repeated rows are returned as often as they come. An empty table gives
    an empty result. Other columns of docs are ignored.
    """
    fps = written(fingerprints(docs, id_col, text_col, size), "fingerprints")
    nodes = fps.groupBy("fp").agg(F.min("id").alias("least"))
    roots = components(hamming_links(nodes.select("fp"), dense=dense))
    placed = nodes.join(roots, nodes.fp == roots.u, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = placed.join(least, "root").select("fp", "component_id")
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return fps.join(named, "fp").select(F.col("id").alias("doc_id"), digits.alias("fingerprint"), "component_id")
