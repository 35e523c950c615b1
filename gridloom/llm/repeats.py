"""Removal of long repeated strings by a run-length index (r-index) over repetitive parts of a corpus.

What has to go is every byte that a string of `length` bytes covers which also starts anywhere else. No task can sort the suffixes of a corpus, so strings that can be
equal are brought together first. Each string of `length` bytes (a window) is given the least hash of the grams inside it: equal windows have equal
keys, and neighbouring windows mostly share one, so a text falls into pieces of some hundred windows with one key. A key met once repeats nothing. A
key whose pieces are all equal repeats wholly: its windows are settled by their count. The other keys, whose pieces differ, are dealt to buckets of bounded size.

In a bucket the distinct pieces form one text, and its run-length index is built: the Burrows-Wheeler transform as runs, with the text positions of each run's first
and last suffix and the length that the suffixes on either side of a run's edge have in common. That is enough for the matching statistics of the text
against its other places: if two neighbouring suffixes are preceded by the same byte, so are their extensions by that byte, which are neighbours too and have
one byte more in common; so every match is seen, at its left end, at an edge of a run, and from there its length falls by one from place to place. One sweep over the run
ends gives the statistic at each place; where it reaches `length`, the window is repeated.

Hot keys. A key whose different pieces have more than `most` bytes (a common line in many contexts) is taken apart by longer grams, which tell contexts apart that the
first did not. Where that leaves as much, its windows are counted: a piece sends the hashes of its different windows, packed in a row for each of some buckets of bounded
size, so that rows follow the pieces and not their windows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import by_size, without, written

OUT = ["n_bytes", "spans", "kept"]
#: Windows that are cut at once, and the most windows of a piece.
_CHUNK, _PIECE = 1 << 20, 4096
#: An odd factor for the hash of grams.
_BASE = 0x9E3779B97F4A7C15
_CODES = "start long, size int, key long, h long, again boolean"
_SPANS = "array<struct<start:int,size:int>>"
_SPAN_LIST = pa.list_(pa.struct([("start", pa.int32()), ("size", pa.int32())]))


class Grams:
    """Hashes of all grams of a text by prefix sums of a polynomial modulo 2^64; equal grams have equal hashes wherever they stand."""

    def __init__(self, gram: int, most: int):
        self.gram = gram
        step, back = np.full(most, _BASE, np.uint64), np.full(most + 1, pow(_BASE, -1, 1 << 64), np.uint64)
        step[0] = back[0] = 1
        self.power, self.inverse = np.multiply.accumulate(step), np.multiply.accumulate(back)

    def __call__(self, text: np.ndarray) -> np.ndarray:
        n, m = len(text), len(text) + 1 - self.gram
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((text.astype(np.uint64) + np.uint64(1)) * self.power[:n], out=sums[1:])
        h = (sums[self.gram :] - sums[:m]) * self.inverse[:m]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
        return h


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least of each `width` neighbours: running minima from both ends of blocks of that width."""
    if width == 1:
        return x
    n, rows = len(x), -(-len(x) // width)
    padded = np.full(rows * width, np.iinfo(x.dtype).max, x.dtype)
    padded[:n] = x
    blocks = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def pieces_of(text: np.ndarray, length: int, grams: Grams) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(start, size, key, again) of the pieces of a text, part by part. A piece is a run of neighbouring windows of one key, and size its bytes.

    again: the key's gram may be at several places of the piece, without which no window comes twice in it.
    """
    width = length - grams.gram + 1
    for at in range(0, len(text) - length + 1, _CHUNK):
        h = grams(text[at : at + _CHUNK + length - 1])
        keys = sliding_min(h, width)
        new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        ends = np.append(new[1:], len(keys))
        long = ends - new > _PIECE
        if long.any():  # texts with a period
            new = np.sort(np.concatenate([new, *(np.arange(a + _PIECE, b, _PIECE) for a, b in zip(new[long], ends[long]))]))
            ends = np.append(new[1:], len(keys))
        key, again = keys[new], np.zeros(len(new), bool)
        # A gram is the least of some window around it if it is no more than the greatest of these windows' keys.
        around = ~sliding_min(~np.pad(keys, width - 1), width)
        least = np.flatnonzero(h == around)
        twice = np.flatnonzero((h[least[1:]] == h[least[:-1]]) & (np.diff(least) <= width))
        low = np.maximum(np.searchsorted(new, least[twice] - width + 1, "right") - 1, 0)
        n = np.searchsorted(new, least[twice + 1], "right") - low
        pair = np.repeat(np.arange(len(twice)), n)
        near = low[pair] + np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n)
        again[near[key[near] == h[least[twice[pair]]]]] = True
        yield at + new, ends - new + length - 1, key, again


@dataclass
class RunLengthIndex:
    """The runs of a Burrows-Wheeler transform: the symbol before the run's suffixes, their number, the places of the first and last of them, and
    the symbols that the first has in common with the suffix before it. Ends of pieces are all different, so each is a run of its own."""

    symbol: np.ndarray
    count: np.ndarray
    first: np.ndarray
    last: np.ndarray
    common: np.ndarray
    size: int


def _packed(symbols: np.ndarray) -> np.ndarray:
    """Seven symbols of nine bits from each place on; zeros past the end."""
    padded = np.concatenate([symbols.astype(np.int64), np.zeros(7, np.int64)])
    out = np.zeros(len(symbols), np.int64)
    for k in range(7):
        out = (out << 9) | padded[k : k + len(symbols)]
    return out


def suffix_order(symbols: np.ndarray, packed: np.ndarray) -> np.ndarray:
    """Suffixes in order, by prefix doubling of those that aren't told apart yet. Symbol 0 ends a piece; the end of an earlier piece is the smaller."""
    n = len(symbols)
    after_end = np.zeros(n, np.int64)  # what of the seven symbols lies behind an end
    left = np.flatnonzero(symbols == 0)
    left = left[np.searchsorted(left, np.arange(n))] - np.arange(n)
    near = left < 6
    after_end[near] = 9 * (6 - left[near])
    key = (packed >> after_end) << after_end
    order = np.argsort(key, kind="stable")
    sorted_key, ended = key[order], left[order] < 7
    head = np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]]) | ended
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    open_ = np.flatnonzero(~(head & np.append(head[1:], True)))
    depth = 7
    while len(open_):
        suffixes = order[open_]
        key = rank[suffixes] * n + rank[suffixes + depth]
        by = np.argsort(key)
        suffixes, key = suffixes[by], key[by]
        order[open_] = suffixes
        head = np.concatenate([[True], key[1:] != key[:-1]])
        rank[suffixes] = open_[np.maximum.accumulate(np.where(head, np.arange(len(key)), 0))]
        open_ = open_[~(head & np.append(head[1:], True))]
        depth *= 2
    return order


def _in_common(symbols: np.ndarray, packed: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Symbols that the suffixes at a and b begin with alike, up to the end of a piece."""
    end = np.flatnonzero(symbols == 0)
    most = np.minimum(end[np.searchsorted(end, a)] - a, end[np.searchsorted(end, b)] - b)
    out, highest = np.zeros(len(a), np.int64), 1 << np.arange(0, 63, 9)  # two packed places first differ in the symbol of their highest different bit
    open_ = np.flatnonzero(most > 0)
    while len(open_):
        x, y = packed[a[open_] + out[open_]], packed[b[open_] + out[open_]]
        alike = 7 - np.searchsorted(highest, x ^ y, "right")
        out[open_] += alike
        open_ = open_[(alike == 7) & (out[open_] < most[open_])]
    return np.minimum(out, most)


def run_length_index(symbols: np.ndarray) -> RunLengthIndex:
    """symbols: pieces with bytes as 1 to 256, each with a 0 behind it."""
    packed = _packed(symbols)
    order = suffix_order(symbols, packed)
    before = symbols[order - 1]  # the place before the first is the end of the last piece
    edge = np.flatnonzero(np.concatenate([[True], (before[1:] != before[:-1]) | (before[1:] == 0)]))
    last = np.append(edge[1:], len(order)) - 1
    common = np.zeros(len(edge), np.int64)
    common[1:] = _in_common(symbols, packed, order[edge[1:] - 1], order[edge[1:]])
    return RunLengthIndex(before[edge], last - edge + 1, order[edge], order[last], common, len(order))


def matching_statistics(index: RunLengthIndex) -> np.ndarray:
    """For each place of the indexed text the length of the longest string from there that also starts at another place."""
    far = np.zeros(index.size, np.int64)
    np.maximum.at(far, index.first[1:], index.first[1:] + index.common[1:])
    np.maximum.at(far, index.last[:-1], index.last[:-1] + index.common[1:])
    return np.maximum(np.maximum.accumulate(far) - np.arange(index.size), 0)


def repeated_spans(pieces: list[bytes], length: int) -> list[list[tuple[int, int]]]:
    """For each piece the (start, size) of what is covered by strings of `length` bytes that start at another place of any piece too."""
    sizes = np.array([len(p) for p in pieces])
    begins = np.cumsum(sizes + 1) - sizes - 1
    symbols = np.zeros(int((sizes + 1).sum()), np.int16)
    for at, p in zip(begins, pieces):
        symbols[at : at + len(p)] = np.frombuffer(p, np.uint8).astype(np.int16) + 1
    hits = np.flatnonzero(matching_statistics(run_length_index(symbols)) >= length)
    out: list[list[tuple[int, int]]] = [[] for _ in pieces]
    if len(hits):
        new = np.flatnonzero(np.concatenate([[True], np.diff(hits) > length]))
        for a, b in zip(hits[new], hits[np.append(new[1:], len(hits)) - 1]):
            k = int(np.searchsorted(begins, a, "right")) - 1
            out[k].append((int(a - begins[k]), int(b - a + length)))
    return out


def _pieces(texts: DataFrame, item: list[str], length: int, gram: int) -> DataFrame:
    """texts(*item, doc, th, base, text as binary): a row a piece, with its start in the document."""
    carried = len(texts.columns) - 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        grams = Grams(gram, _CHUNK + length)
        for batch in batches:
            for b in by_size(batch, carried + 1):
                row, cols = [], [[] for _ in added]
                for i in range(b.num_rows):
                    text, base = memoryview(b.column(carried + 1)[i].as_buffer()), b.column(carried)[i].as_py()
                    for start, size, key, again in pieces_of(np.frombuffer(text, np.uint8), length, grams):
                        h = np.fromiter((xxhash.xxh3_64_intdigest(text[a : a + n]) for a, n in zip(start.tolist(), size.tolist())), np.uint64, len(start))
                        row.append(np.full(len(start), i))
                        for c, x in zip(cols, (start + base, size.astype(np.int32), key.view(np.int64), h.view(np.int64), again)):
                            c.append(x)
                if row:
                    at = pa.array(np.concatenate(row))
                    yield pa.RecordBatch.from_arrays([*(b.column(k).take(at) for k in range(carried)), *(pa.array(np.concatenate(c)) for c in cols)], names=[*names, *added])

    codes = T.StructType.fromDDL(_CODES)
    names, added = texts.columns[:carried], codes.names
    return texts.mapInArrow(run, T.StructType([*texts.schema.fields[:carried], *codes.fields]))


def _fetched(variants: DataFrame, docs: DataFrame) -> DataFrame:
    """variants(key, h, n, at) with the bytes of their places: (key, h, n, doc, th, base, text)."""
    wanted = variants.groupBy(F.col("at.doc").alias("doc"), F.col("at.th").alias("th")).agg(F.collect_list(F.struct("key", "h", "n", F.col("at.start").alias("start"), F.col("at.size").alias("size"))).alias("wanted"))
    joined = docs.join(wanted.hint("merge"), ["doc", "th"]).select("doc", "th", "wanted", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in by_size(batch, 3):
                row, cut, parts = [], [], b.column(2).flatten()
                for i, n in enumerate(b.column(2).value_lengths().to_pylist()):
                    row += [i] * n
                starts, sizes = parts.field("start").to_pylist(), parts.field("size").to_pylist()
                for i, a, n in zip(row, starts, sizes):
                    cut.append(b.column(3)[i].as_buffer().slice(a, n).to_pybytes())
                at = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays([parts.field("key"), parts.field("h"), parts.field("n"), b.column(0).take(at), b.column(1).take(at), parts.field("start"), pa.array(cut, pa.binary())], names=["key", "h", "n", "doc", "th", "base", "text"])

    return joined.mapInArrow(run, "key long, h long, n long, doc long, th binary, base long, text binary")


def _as_spans(runs: list[tuple[int, int]]) -> list[dict[str, int]]:
    return [{"start": a, "size": e - a} for a, e in runs]


def _span_table(held: list[tuple]) -> pa.Table:
    kinds = [pa.int64(), pa.int64(), _SPAN_LIST]
    return pa.Table.from_arrays([pa.array([r[i] for r in held], k) for i, k in enumerate(kinds)], names=["key0", "h0", "spans"])


def _indexed(found: DataFrame, buckets: int, length: int, most: int) -> DataFrame:
    """(key, h, spans): what repeats of each variant. A bucket's keys are indexed together as far as they have no more than `most` bytes. Variants that came
    several times repeat wholly."""

    def run(table: pa.Table) -> pa.Table:
        seen = {}
        for key, h, n, text in sorted(zip(*(table.column(c).to_pylist() for c in ("key", "h", "n", "text")))):
            seen[key, h] = (n, text)
        sizes = np.array([len(t) for _, t in seen.values()])
        keys = np.array([k for k, _ in seen])
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        part = np.cumsum(np.add.reduceat(sizes, first)) // most
        cuts = [*first[np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))].tolist(), len(keys)]
        held, every = [], list(seen.items())
        for a, b in zip(cuts, cuts[1:]):
            own = every[a:b]
            for (k, (n, t)), s in zip(own, repeated_spans([t for _, (_, t) in own], length)):
                if n > 1 or s:
                    held.append((*k, _as_spans([(0, len(t))] if n > 1 else [(x, x + y) for x, y in s])))
        return _span_table(held).rename_columns(["key", "h", "spans"])

    dealt = found.select(F.pmod(F.xxhash64("key"), F.lit(buckets)).alias("bucket"), "key", "h", "n", "text")
    return dealt.groupBy("bucket").applyInArrow(run, f"key long, h long, spans {_SPANS}")


def _counted(texts: DataFrame, buckets: int, length: int) -> DataFrame:
    """(key0, h0, spans) of texts(key0, h0, text): what windows that come several times cover, by counting all of them. The same key0 and h0 are the same text, and count once."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            for b in by_size(batch, 2, 1 << 20):
                row, bucket, codes, starts, own = [], [], [], [], []
                for i in range(b.num_rows):
                    text, places = memoryview(b.column(2)[i].as_buffer()), {}
                    for at in range(len(text) - length + 1):
                        places.setdefault(xxhash.xxh3_128_digest(text[at : at + length]), []).append(at)
                    dealt: dict[int, list[bytes]] = {}
                    for code in places:
                        dealt.setdefault(int.from_bytes(code[:8], "little") % buckets, []).append(code)
                    inside = _as_spans(merged([(at, at + length) for several in places.values() if len(several) > 1 for at in several]))
                    for k, held in dealt.items():
                        row.append(i)
                        bucket.append(k)
                        codes.append(b"".join(held))
                        starts.append([places[code][0] for code in held])
                        own.append(inside)
                        inside = []  # once is enough
                at = pa.array(row, pa.int64())
                kinds = [pa.int32(), pa.binary(), pa.list_(pa.int32()), _SPAN_LIST]
                packed = [pa.array(c, kind) for c, kind in zip((bucket, codes, starts, own), kinds)]
                yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), *packed], names=["key0", "h0", "bucket", "codes", "starts", "own"])

    def count(table: pa.Table) -> pa.Table:
        first: dict[tuple[int, int], int] = {}
        for i, k in enumerate(zip(table.column("key0").to_pylist(), table.column("h0").to_pylist())):
            first.setdefault(k, i)
        table = table.take(pa.array(first.values(), pa.int64()))
        code = np.frombuffer(b"".join(table.column("codes").to_pylist()), np.uint64).reshape(-1, 2)
        order = np.lexsort((code[:, 1], code[:, 0]))
        equal = (code[order[1:]] == code[order[:-1]]).all(axis=1)
        several = np.zeros(len(code), bool)
        several[order[1:][equal]] = several[order[:-1][equal]] = True
        held, at = [], 0
        for k, starts, own in zip(first, table.column("starts").to_pylist(), table.column("own").to_pylist()):
            hit = [starts[i] for i in np.flatnonzero(several[at : at + len(starts)])]
            at += len(starts)
            if hit or own:
                held.append((*k, _as_spans(merged([(a, a + length) for a in hit] + [(x["start"], x["start"] + x["size"]) for x in own]))))
        return _span_table(held)

    packed = texts.mapInArrow(windows, f"key0 long, h0 long, bucket int, codes binary, starts array<int>, own {_SPANS}")
    parts = packed.groupBy("bucket").applyInArrow(count, f"key0 long, h0 long, spans {_SPANS}")
    return _runs(parts.groupBy("key0", "h0").agg(F.flatten(F.collect_list("spans")).alias("spans")))


def _runs(spans: DataFrame) -> DataFrame:
    """spans(key0, h0, spans) with those as one that touch or overlap, so that a variant has no more of them than it has runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [_as_spans(merged([(x["start"], x["start"] + x["size"]) for x in own])) for own in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, _SPAN_LIST)], names=["key0", "h0", "spans"])

    return spans.mapInArrow(run, f"key0 long, h0 long, spans {_SPANS}")


def _repeats(texts: DataFrame, item: list[str], docs: DataFrame, length: int, grams: list[int], most: int, first: bool = True) -> DataFrame:
    """(*item, start, size) of repeated parts of texts; start counts in the document."""
    pieces = _pieces(texts, item, length, grams[0])
    pieces = written(pieces if first else pieces.dropDuplicates([*item, "start"]), "pieces")
    keys = pieces.groupBy("key").agg(F.count("*").alias("n"), F.min("h").alias("low"), F.max("h").alias("high"), F.max("again").alias("again")).where("n > 1 or again")
    keys = written(keys.select("key", F.expr("low = high and n > 1").alias("whole")), "keys")
    met = written(pieces.join(keys.hint("merge"), "key"), "met")
    whole, parts = met.where("whole").select(*item, "start", "size"), met.where("not whole")
    place = F.struct("doc", "th", "start", "size")
    variants = written(parts.groupBy("key", "h").agg(F.count("*").alias("n"), F.min(place).alias("at")), "variants")
    n, size = variants.agg(F.count("*"), F.sum("at.size")).first()
    if not n:
        return whole
    hot = variants.groupBy("key").agg(F.sum("at.size").alias("held"), F.sum(F.col("at.size") - (length - 1)).alias("windows")).where(F.col("held") > most)
    many = written(hot.select("key", "windows"), "hot-keys")
    windows = many.agg(F.sum("windows")).first()[0]
    few = variants.join(many, "key", "left_anti") if windows else variants
    spans = _indexed(_fetched(few, docs), -(-size // most), length, most)
    if windows:
        inner = _fetched(variants.join(many, "key", "left_semi"), docs).withColumnsRenamed({"key": "key0", "h": "h0"})
        if len(grams) > 1:
            found = _repeats(inner.select("key0", "h0", F.col("base").alias("begin"), "doc", "th", "base", "text"), ["key0", "h0", "begin"], docs, length, grams[1:], most, first=False)
            inside = _runs(found.groupBy("key0", "h0").agg(F.collect_list(F.struct((F.col("start") - F.col("begin")).cast("int").alias("start"), F.col("size").cast("int").alias("size"))).alias("spans")))
        else:
            inside = _counted(inner.select("key0", "h0", "text"), -(-windows // most), length)
        again = variants.where("n > 1").join(many, "key", "left_semi").select("key", "h", F.array(F.struct(F.lit(0).alias("start"), F.col("at.size").alias("size"))).alias("spans"))
        spans = spans.union(inside).union(again)
    spans = written(spans, "spans")
    inside = parts.join(spans.hint("merge"), ["key", "h"]).select(*item, "start", F.explode("spans").alias("s"))
    return whole.union(inside.select(*item, (F.col("start") + F.col("s.start")).alias("start"), F.col("s.size").alias("size")))


def remove_repeats(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text", most: int = 1 << 20) -> DataFrame:
    """docs with n_bytes, spans (start and size of the removed runs of bytes, in order, none touching) and kept (the other bytes).

    Texts are UTF-8 bytes; a null text is empty. A byte goes if a string of `length` bytes over it also starts anywhere else in the table, in the same document too, overlapping or not. Strings
    never go on into another document, and are judged on the table as given, so of equal texts of `length` bytes or more nothing stays. Shorter texts
    stay whole. most: the bytes of an index, and the windows counted at once. Texts are taken whole, however long: a part of a million places at a time. Ids only help to find texts again and may be null or repeated. Repeated rows are
    documents of their own, so each other's repeats. kept is binary, as a cut may go through a character. Input columns of the added names are replaced; others pass
    through. An empty table gives an empty result. Keys and pieces are told apart by 64-bit hashes each (128 together), texts by MD5.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    th = F.unhex(F.md5(text.cast("binary")))
    found = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-1)).alias("doc"), th.alias("th"), text.cast("binary").alias("text")).where(F.octet_length("text") >= length)
    grams = sorted({max(1, length // 4), max(1, length // 2)})
    marks = _repeats(found.select("doc", "th", F.lit(0).cast("long").alias("base"), "text"), ["th"], found, length, grams, most)
    marks = written(marks.groupBy("th").agg(F.collect_set(F.struct("start", "size")).alias("marks")), "marks")
    kept = docs.select(*without(docs, OUT))
    rows = docs.select(F.struct(*without(docs, OUT)).alias("row"), th.alias("th")).join(marks.hint("merge"), "th", "left").select("row", "marks")
    names, place = kept.columns, kept.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = pa.RecordBatch.from_arrays([*batch.column(0).flatten(), batch.column(1)], names=[*names, "marks"])
            for b in by_size(flat, place):
                sizes, spans, left = [], [], []
                for t, m in zip(b.column(place), b.column(len(names))):
                    body = t.as_buffer() if t.is_valid else pa.py_buffer(b"")
                    own = merged([(x["start"], x["start"] + x["size"]) for x in m.as_py() or ()])
                    edges = [0, *(e for s in own for e in s), len(body)]
                    sizes.append(len(body))
                    spans.append([{"start": a, "size": e - a} for a, e in own])
                    left.append(b"".join(body.slice(a, e - a).to_pybytes() for a, e in zip(edges[::2], edges[1::2])))
                kind = pa.list_(pa.struct([("start", pa.int64()), ("size", pa.int64())]))
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(sizes, pa.int64()), pa.array(spans, kind), pa.array(left, pa.binary())], names=[*names, *OUT])

    return rows.mapInArrow(run, T.StructType([*kept.schema.fields, *T.StructType.fromDDL("n_bytes long, spans array<struct<start:long,size:long>>, kept binary").fields]))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """(start, end) spans in order, those that touch or overlap as one."""
    out: list[tuple[int, int]] = []
    for a, e in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((a, e))
    return out
