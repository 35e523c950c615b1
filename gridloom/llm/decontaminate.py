"""Benchmark decontamination.

A document is contaminated by an item if a window of as many words as the item has holds the item's word shingles (five words, the
whole item if it is shorter) with a weighted Jaccard similarity of at least `similarity`, weights being multiplicities. A document
shorter than the item is one window.

Item-sized windows and items are fingerprinted by SimHash of 128 bits. A multi-index of the items' fingerprints in eight blocks of 16
bits gives all of them within `radius`: two fingerprints that differ in at most 31 bits have a block in which they differ in at most three, so
a lookup probes the 697 values of each block within three bits. A random fingerprint meets 8.5 % of the items that way. The exact similarity
decides. At a similarity of 0.8 fingerprints differ in 19.4 bits on average with a deviation of 4, so about one such pair in 800 lies outside the radius.

Only windows that hold enough shingles of the items of their length to reach the bound with any of them are fingerprinted; this
says nothing about which item, and loses none.

The benchmark is taken in blocks of bounded size. Where there is more than one, the corpus is still read once: a bit table of all items' shingles, which tells a few others for
them and misses none, picks the texts that hold enough of them in a window of some item's length. These alone, written once, are looked up block after
block. So neither memory nor what is broadcast follows the benchmark's size (the table has at most `TABLE_BITS` bits; beyond some 30 million shingles it lets more texts through).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import by_size, written

#: bytes.translate table: A-Z to lower case, ASCII punctuation and controls to blanks.
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
HITS = T.ArrayType(T.StructType().add("item_id", "long").add("similarity", "double").add("start", "integer").add("words", "integer"))
_HIT = pa.list_(pa.struct([("item_id", pa.int64()), ("similarity", pa.float64()), ("start", pa.int32()), ("words", pa.int32())]))
_BLOCKS = 8
#: Bits of the table of all items' shingles: 16 a shingle, and no more than this.
TABLE_BITS = 1 << 29


def plain_words(text: str | None) -> list[bytes]:
    """Lower-case words of letters and digits; other ASCII characters part them."""
    return text.lower().encode("utf-8", "surrogatepass").translate(_PLAIN).split() if text else []


def shingles(words: list[bytes], size: int) -> list[bytes]:
    if len(words) <= size:
        return [b" ".join(words)]
    return list(map(b" ".join, zip(*(words[i:] for i in range(size)))))


def fingerprints(words: list[bytes], size: int, starts: np.ndarray, windows: int) -> np.ndarray:
    """SimHash fingerprints, rows of eight 16-bit blocks, of the `windows` shingles from each of the starts (in order)."""
    import xxhash

    out, cuts = np.zeros((len(starts), _BLOCKS), np.uint16), np.flatnonzero(np.diff(starts, prepend=starts[:1] - windows - 1) > windows).tolist()
    for a, b in zip(cuts, [*cuts[1:], len(starts)]):
        # Starts in reach of each other: every shingle is hashed once, and sums of bits along them give all windows.
        for c in range(a, b, 4096):
            own = starts[c : min(b, c + 4096)]
            span = words[int(own[0]) : int(own[-1]) + windows + size - 1]
            hashed = np.frombuffer(b"".join(map(xxhash.xxh128_digest, shingles(span, size))), np.uint8).reshape(-1, 16)
            sums = np.cumsum(np.unpackbits(hashed, axis=1), axis=0, dtype=np.int32)
            last = own - own[0] + windows - 1
            ones = sums[last] - np.where((own == own[0])[:, None], 0, sums[last - windows])
            out[c : c + len(own)] = np.packbits(2 * ones > windows, axis=1).view(np.uint16)
    return out


class BlockIndex:
    """Fingerprints by the value of each 16-bit block: within() misses none in the radius."""

    def __init__(self, prints: np.ndarray, radius: int):
        self.prints, self.radius = prints, radius
        self.order = np.argsort(prints, axis=0, kind="stable")
        held = np.take_along_axis(prints, self.order, axis=0)
        self.first = np.stack([np.searchsorted(held[:, b], np.arange((1 << 16) + 1)) for b in range(_BLOCKS)])
        self.masks = np.array([sum(1 << i for i in c) for k in range(radius // _BLOCKS + 1) for c in combinations(range(16), k)], np.uint16)

    def candidates(self, fp: np.ndarray) -> np.ndarray:
        probes = (fp[:, None] ^ self.masks).astype(np.int64)
        block, at = np.nonzero(self.first[np.arange(_BLOCKS)[:, None], probes + 1] > self.first[np.arange(_BLOCKS)[:, None], probes])
        value = probes[block, at]
        found = [self.order[self.first[b, v] : self.first[b, v + 1], b] for b, v in zip(block.tolist(), value.tolist())]
        return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)

    def within(self, fp: np.ndarray) -> np.ndarray:
        near = self.candidates(fp)
        return near[np.bitwise_count(self.prints[near] ^ fp).sum(axis=1) <= self.radius]


def _rows_by_key(keys: np.ndarray, n: int) -> np.ndarray:
    return np.searchsorted(keys, np.arange(n + 1))


class Index:
    """A block of benchmark items, ready to be looked up. All is kept in arrays but the numbers of the words."""

    def __init__(self, items: list[tuple[int | None, str]], size: int, similarity: float, radius: int):
        self.similarity, self.size = similarity, size
        texts = [(k, w) for k, w in ((k, plain_words(t)) for k, t in items) if w]
        self.ids, self.lengths = [k for k, _ in texts], np.array([len(w) for _, w in texts], np.int64)
        self.vocabulary: dict[bytes, int] = {}
        self.factors = np.random.default_rng(1).integers(1, 1 << 63, size, dtype=np.uint64) | np.uint64(1)
        by_size: dict[int, tuple[list[np.ndarray], list[np.ndarray]]] = {}
        prints = np.zeros((len(texts), _BLOCKS), np.uint16)
        for i, (_, w) in enumerate(texts):
            numbers = np.array([self.vocabulary.setdefault(x, len(self.vocabulary) + 1) for x in w], np.uint64)
            g = min(size, len(w))
            rows, owners = by_size.setdefault(g, ([], []))
            rows.append(np.lib.stride_tricks.sliding_window_view(numbers, g))
            owners.append(np.full(len(w) - g + 1, i))
            prints[i] = fingerprints(w, g, np.zeros(1, np.int64), len(w) - g + 1)[0]
        self.index = BlockIndex(prints, radius) if texts else None
        # By shingle length: codes in order, the word numbers that tell equal codes apart, and where the shingles' numbers begin.
        self.lookups, owner, shingle, total = {}, [], [], 0
        for g, (rows, owners) in sorted(by_size.items()):
            distinct, which = np.unique(np.concatenate(rows), axis=0, return_inverse=True)
            codes = self._codes(distinct)
            order = np.argsort(codes, kind="stable")
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            self.lookups[g] = (codes[order], distinct[order], total)
            owner.append(np.concatenate(owners))
            shingle.append(total + place[which.ravel()])
            total += len(order)
        owner, shingle = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (owner, shingle))
        # Shingles of each item with their multiplicities, and lengths of the items that hold each shingle.
        pairs, self.counts = np.unique(np.stack([owner, shingle]), axis=1, return_counts=True)
        self.item_first, self.item_shingles = _rows_by_key(pairs[0], len(texts)), pairs[1]
        lengths = np.unique(np.stack([shingle, self.lengths[owner]]), axis=1) if len(owner) else np.zeros((2, 0), np.int64)
        self.length_first, self.shingle_lengths = _rows_by_key(lengths[0], total), lengths[1]

    def _codes(self, numbers: np.ndarray) -> np.ndarray:
        return (numbers * self.factors[: numbers.shape[1]]).sum(axis=1, dtype=np.uint64)

    def _shingles(self, numbers: np.ndarray, g: int) -> np.ndarray:
        """The shingle at each place of a text, -1 for those of no item."""
        codes, own, first = self.lookups[g]
        sliding = np.lib.stride_tricks.sliding_window_view(numbers, g)
        out = np.full(len(sliding), -1, np.int64)
        at = np.flatnonzero(sliding.all(axis=1))
        if len(at):
            code = self._codes(sliding[at])
            place = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
            ok = (codes[place] == code) & (own[place] == sliding[at]).all(axis=1)
            out[at[ok]] = first + place[ok]
        return out

    def _similarity(self, window: np.ndarray, item: int) -> float:
        own = slice(self.item_first[item], self.item_first[item + 1])
        held, counts = self.item_shingles[own], self.counts[own]
        here, times = np.unique(window[window >= 0], return_counts=True)
        at = np.minimum(np.searchsorted(held, here), len(held) - 1)
        both = int(np.where(held[at] == here, np.minimum(counts[at], times), 0).sum())
        return both / (len(window) + int(counts.sum()) - both)

    def hits(self, text: str | None) -> list[dict]:
        """For each item the best window of the text at or over the similarity, the first of equals."""
        found = plain_words(text)
        if not found or not self.ids:
            return []
        numbers = np.fromiter(map(self.vocabulary.get, found, [0] * len(found)), np.uint64, len(found))
        best: dict[int, tuple[float, int, int]] = {}
        for g in self.lookups:
            if len(found) < g:
                continue
            at_place = self._shingles(numbers, g)
            places = np.flatnonzero(at_place >= 0)
            if not len(places):
                continue
            first, last = self.length_first[at_place[places]], self.length_first[at_place[places] + 1]
            n = last - first
            lengths = self.shingle_lengths[np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
            places = np.repeat(places, n)
            for m in np.unique(lengths).tolist():
                self._windows(found, at_place, places[lengths == m], m, g, best)
        return [{"item_id": self.ids[i], "similarity": v, "start": s, "words": n} for i, (v, s, n) in sorted(best.items())]

    def _windows(self, found: list[bytes], at_place: np.ndarray, marked: np.ndarray, m: int, g: int, best: dict[int, tuple[float, int, int]]) -> None:
        """Looks the windows for items of m words up that hold enough of the marked places."""
        length = min(m, len(found))
        windows, k = length - g + 1, m - g + 1
        need = math.ceil(self.similarity * (k + windows) / (1 + self.similarity) - 1e-9)
        if windows < 1 or len(marked) < need:
            return
        marks = np.zeros(len(at_place) + 1, np.int32)
        marks[marked + 1] = 1
        total = np.cumsum(marks)
        starts = np.flatnonzero(total[windows:] - total[: len(total) - windows] >= need)
        if not len(starts):
            return
        for s, fp in zip(starts.tolist(), fingerprints(found, g, starts, windows)):
            near = self.index.within(fp)
            for i in near[self.lengths[near] == m].tolist():
                value = self._similarity(at_place[s : s + windows], i)
                if value >= self.similarity - 1e-12 and value > best.get(i, (0.0, 0, 0))[0]:
                    best[i] = (value, s, length)


def find_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", size: int = 5, similarity: float = 0.8, radius: int = 31, block_bytes: int = 4 << 20, out: str = "leaks") -> DataFrame:
    """docs with a column of leaks: item_id, similarity, first word and number of words of the best window, for each item found.

    An input column named like the new one is replaced. Null, empty and blank texts leak nothing, items without a word are never
    found; equal items are found alike, and so are repeated rows. Texts are taken whole, however long. Empty tables give no leaks.
    """
    sc = docs.sparkSession.sparkContext
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.coalesce(F.col(item_text_col), F.lit("")).alias("text"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_bytes))
    kept = [c for c in docs.columns if c.lower() != out.lower()]
    now = docs.select(*(docs[f"`{c}`"] for c in kept))

    def shared(b: int):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        return sc.broadcast(sorted(((r["item_id"], r["text"]) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1])))

    if blocks == 1:
        return _look_up(now, shared(0), text_col, size, similarity, radius, out)
    # A text is known by two hashes, and what each block finds in it is written. Rows are carried whole, under a name of their own.
    keys = [F.xxhash64(text_col).alias("h1"), F.xxhash64(F.lit("second"), F.col(text_col)).alias("h2")]
    rows = now.select(F.struct(*(F.col(f"`{c}`") for c in kept)).alias("row"), *keys)
    texts, found = _held(now.select(*keys, F.col(text_col).alias("text")), items, size, similarity), None
    texts = written(texts.groupBy("h1", "h2").agg(F.first("text").alias("text")), "suspects")
    for b in range(blocks):
        block = shared(b)
        hits = _look_up(texts, block, "text", size, similarity, radius, "leaks").where(F.size("leaks") > 0)
        one = written(hits.select("h1", "h2", "leaks"), "leaks")
        block.destroy()
        found = one if found is None else found.unionByName(one)
    found = written(found.groupBy("h1", "h2").agg(F.array_sort(F.flatten(F.collect_list("leaks"))).alias("leaks")), "leaks")
    named = rows.join(found.hint("merge"), ["h1", "h2"], "left")
    return named.select(*(F.col("row")[c].alias(c) for c in kept), F.coalesce("leaks", F.array().cast(HITS)).alias(out))


def _hashed(words: list[bytes], g: int) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh64_intdigest, shingles(words, g)), np.uint64)


def _held(texts: DataFrame, items: DataFrame, size: int, similarity: float) -> DataFrame:
    """The rows of texts(h1, h2, text) that may leak: some window of an item's length has as many of all items' shingles as the similarity needs.

    Shingles that only look like an item's let a few texts more through, and none that leaks is left out. Items' lengths are few, and with the table all that tasks get.
    """

    def item_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in batch.column(0):
                w = plain_words(t.as_py())
                if w:
                    g = min(size, len(w))
                    own = _hashed(w, g)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), len(w), np.int32)), pa.array(own.view(np.int64))], names=["length", "x"])

    every = written(items.select("text").mapInArrow(item_shingles, "length int, x long"), "shingles")
    lengths = np.array(sorted(r[0] for r in every.select("length").distinct().collect()), np.int64)
    n = every.agg(F.approx_count_distinct("x")).first()[0]
    bits = min(TABLE_BITS, 1 << max(6, int(16 * n).bit_length()))
    at = F.pmod("x", F.lit(bits))
    words = every.groupBy(F.shiftright(at, 6).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(x, {bits}) & 63 as int))")).alias("bits")).toPandas()  # a word of the table at most each
    table = np.zeros(bits >> 6, np.uint64)
    table[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).view(np.uint64)
    shared = texts.sparkSession.sparkContext.broadcast((table, lengths))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, lengths = shared.value
        for batch in batches:
            for b in by_size(batch, 2):
                yield b.filter(pa.array([may_leak(plain_words(t.as_py()), table, bits, lengths, size, similarity) for t in b.column(2)], pa.bool_()))

    return texts.mapInArrow(run, "h1 long, h2 long, text string")


def may_leak(words: list[bytes], table: np.ndarray, bits: int, lengths: np.ndarray, size: int, similarity: float) -> bool:
    """Whether a window of one of the lengths holds as many shingles of the table as an item of that length needs."""
    for g in np.unique(np.minimum(lengths, size)).tolist():
        if len(words) < g:
            continue
        x = _hashed(words, g)
        place = (x.view(np.int64) % bits).astype(np.uint64)
        held = (table[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1)
        total = np.concatenate([np.zeros(1, np.int64), np.cumsum(held.astype(np.int64))])
        if not total[-1]:
            continue
        for m in lengths[np.minimum(lengths, size) == g].tolist():
            windows, k = min(m, len(words)) - g + 1, m - g + 1
            need = math.ceil(similarity * (k + windows) / (1 + similarity) - 1e-9)
            if total[-1] >= need and (total[windows:] - total[: len(total) - windows]).max() >= need:
                return True
    return False


def _look_up(docs: DataFrame, shared, text_col: str, size: int, similarity: float, radius: int, name: str) -> DataFrame:
    place = docs.columns.index(text_col)
    schema = docs.select("*").schema.add(name, HITS)
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = None
        for b in batches:
            index = index or Index(shared.value, size, similarity, radius)
            found = pa.array([index.hits(t.as_py()) for t in b.column(place)], _HIT)
            yield pa.RecordBatch.from_arrays([*b.columns, found], names=names)

    return docs.mapInArrow(run, schema)
