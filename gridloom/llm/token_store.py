"""Token files as wavelet matrices.

Documents are range-partitioned and sorted by id, encoded, and cut into shards of at most `shard_tokens` ids at document ends. A shard
is one compressed file image with a magic number, the shard's alphabet, document offsets and ids, and for each bit of the symbols' ranks
a bit plane, permuted so that zeros come before ones, with the ones counted at every 512 bits. Ranks at any place come from those
counts and one popcount, so access, count and locate touch one plane a bit and never decode the rest.

Layout after decompression (little endian): magic 4 bytes, then n tokens, alphabet size, planes, documents (u32 each), alphabet u32,
document ends u32, document ids i64, document nulls u8, then per plane zeros u32, rank samples u32, bits.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import by_size

MAGIC = b"WMX1"
_BLOCK = 512


class WaveletMatrix:
    """A sequence of symbols with rank and select over its bit planes."""

    def __init__(self, n: int, alphabet: np.ndarray, planes: list[tuple[int, np.ndarray, np.ndarray]]):
        self.n, self.alphabet, self.planes = n, alphabet, planes

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        n = len(ids)
        held = np.bincount(ids) if n else np.zeros(0, np.int64)
        alphabet = np.flatnonzero(held).astype(np.uint32)
        place = np.zeros(len(held), np.uint16 if len(alphabet) < 1 << 16 else np.uint32)
        place[alphabet] = np.arange(len(alphabet))
        now, planes = place[ids], []
        for level in reversed(range(max(1, (len(alphabet) - 1).bit_length()) if n else 0)):
            bit = (now >> level) & 1 != 0
            bits = np.packbits(bit, bitorder="little")
            bits = np.concatenate([bits, np.zeros(-len(bits) % (_BLOCK // 8), np.uint8)])
            planes.append((int(n - np.count_nonzero(bit)), _samples(bits), bits))
            now = np.concatenate([now[~bit], now[bit]])
        return cls(n, alphabet, planes)

    def _rank1(self, plane: int, at: int) -> int:
        _, samples, bits = self.planes[plane]
        first = at // _BLOCK
        whole = int.from_bytes(bits[first * (_BLOCK // 8) : (first + 1) * (_BLOCK // 8)].tobytes(), "little") & ((1 << at % _BLOCK) - 1)
        return int(samples[first]) + whole.bit_count()

    def access(self, at: int) -> int:
        """The symbol at a place."""
        symbol = 0
        for p, (zeros, _, bits) in enumerate(self.planes):
            bit = int(bits[at >> 3]) >> (at & 7) & 1
            ones = self._rank1(p, at)
            symbol, at = symbol << 1 | bit, zeros + ones if bit else at - ones
        return int(self.alphabet[symbol])

    def _range(self, symbol: int, start: int, stop: int) -> tuple[int, int]:
        code = int(np.searchsorted(self.alphabet, symbol))
        if code == len(self.alphabet) or self.alphabet[code] != symbol:
            return 0, 0
        for p, (zeros, _, _) in enumerate(self.planes):
            a, b = self._rank1(p, start), self._rank1(p, stop)
            start, stop = (zeros + a, zeros + b) if code >> (len(self.planes) - 1 - p) & 1 else (start - a, stop - b)
        return start, stop

    def count(self, symbol: int, start: int = 0, stop: int | None = None) -> int:
        """How often the symbol comes in places start..stop-1."""
        a, b = self._range(symbol, start, self.n if stop is None else stop)
        return b - a

    def select(self, symbol: int, k: int) -> int:
        """The place of the symbol's occurrence k, from 0."""
        a, b = self._range(symbol, 0, self.n)
        if not 0 <= k < b - a:
            raise IndexError("no such occurrence")
        at, code = a + k, int(np.searchsorted(self.alphabet, symbol))
        for p in reversed(range(len(self.planes))):
            bit = code >> (len(self.planes) - 1 - p) & 1
            at = self._select_bit(p, bit, at - self.planes[p][0] if bit else at)
        return at

    def _select_bit(self, plane: int, bit: int, k: int) -> int:
        _, samples, bits = self.planes[plane]
        before = samples if bit else np.arange(len(samples), dtype=np.int64) * _BLOCK - samples
        block = int(np.searchsorted(before, k, side="right")) - 1
        inside = np.unpackbits(bits[block * (_BLOCK // 8) : (block + 1) * (_BLOCK // 8)], bitorder="little")
        return block * _BLOCK + int(np.flatnonzero(inside == bit)[k - int(before[block])])

    def locate(self, symbol: int) -> list[int]:
        """All places of the symbol."""
        return [self.select(symbol, k) for k in range(self.count(symbol))]

    def decode(self) -> np.ndarray:
        """All symbols in order. Planes are undone from the last: each says which of its sorted places were zeros and ones."""
        if not self.n:
            return np.zeros(0, np.uint32)
        now = np.zeros(self.n, np.uint16 if len(self.planes) <= 16 else np.uint32)
        for level, (zeros, _, bits) in enumerate(reversed(self.planes)):
            bit = np.unpackbits(bits, count=self.n, bitorder="little").view(bool)
            up = np.empty_like(now)
            up[~bit] = now[:zeros]
            up[bit] = now[zeros:] | now.dtype.type(1 << level)
            now = up
        return self.alphabet[now]


def _samples(bits: np.ndarray) -> np.ndarray:
    ones = np.bitwise_count(bits.view(np.uint64)).reshape(-1, _BLOCK // 64).sum(axis=1, dtype=np.uint32)
    return np.concatenate([np.zeros(1, np.uint32), np.cumsum(ones, dtype=np.uint32)])


def to_bytes(ids: np.ndarray, ends: list[int], docs: list[int | None]) -> bytes:
    """The shard file of ids, with each document's end and id."""
    import zstandard

    m = WaveletMatrix.build(ids)
    parts = [MAGIC, struct.pack("<4I", m.n, len(m.alphabet), len(m.planes), len(docs)), m.alphabet.astype("<u4").tobytes(), np.array(ends, "<u4").tobytes(), np.array([d or 0 for d in docs], "<i8").tobytes(), bytes(d is None for d in docs)]
    for zeros, samples, bits in m.planes:
        parts += [struct.pack("<I", zeros), samples.astype("<u4").tobytes(), bits.tobytes()]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def from_bytes(data: bytes) -> tuple[WaveletMatrix, np.ndarray, list[int | None]]:
    """The matrix, document ends and document ids of a shard file."""
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(data)
    if raw[:4] != MAGIC:
        raise ValueError("not a token shard")
    n, size, levels, docs = struct.unpack_from("<4I", raw, 4)
    at = 20

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(raw, kind, count, at)
        at += out.nbytes
        return out

    alphabet, ends, ids, nulls = take("<u4", size), take("<u4", docs), take("<i8", docs), take("u1", docs)
    width, planes = -(-n // _BLOCK) * (_BLOCK // 8), []
    for _ in range(levels):
        zeros = int(take("<u4", 1)[0])
        planes.append((zeros, take("<u4", width // (_BLOCK // 8) + 1), take("u1", width)))
    return WaveletMatrix(n, alphabet, planes), ends, [None if x else int(d) for d, x in zip(ids, nulls)]


#: The steps of the vocabularies whose texts can be encoded piece by piece: words are runs of letters, single digits or runs of other signs.
_BY_PIECE = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ]},
}


def _by_piece(spec: dict) -> bool:
    """Whether a vocabulary is of this kind: its special tokens hold "<|" and no upper case, and its model takes words by themselves."""
    model, special = spec["model"], [t["content"] for t in spec["added_tokens"]]
    steps = all(spec[k] == v for k, v in _BY_PIECE.items()) and spec["post_processor"] is None
    return steps and model["type"] == "BPE" and not model["dropout"] and all("<|" in t and t == t.lower() and not t.split()[1:] for t in special)


def _gather(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches of flat from each start, one after the other."""
    ends = np.cumsum(size)
    return flat[np.repeat(start - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)]


class Encoder:
    """Ids of whole texts.

    A vocabulary of the kind above never joins across white space, so the ids of a text are those of its pieces between ASCII
    white space, one after the other; each new piece goes through the tokenizers library once while it is kept. A piece of letters up
    to U+00FF alone is one word in normal form, which the library's model takes directly; others take the whole way. Texts are encoded
    whole with any other vocabulary.
    """

    _made: dict[str, Encoder] = {}

    @classmethod
    def of(cls, path: str) -> Encoder:
        """The process's encoder for a vocabulary: what it knows serves all tasks that the worker runs."""
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def __init__(self, path: str, keep: int = 1_500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for each core already
        from tokenizers import Tokenizer

        self.tokenizer, self.keep, self.known = Tokenizer.from_file(path), keep, {}
        self.model, self.by_piece = self.tokenizer.model, _by_piece(json.loads(self.tokenizer.to_str()))
        self.code = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.dtype = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and how many each has. Each distinct piece is looked up once."""
        if not self.by_piece:
            found = [np.array(e.ids, self.dtype) for e in self.tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
            return np.concatenate([np.zeros(0, self.dtype), *found]), np.fromiter(map(len, found), np.int64, len(found))
        lists = pc.ascii_split_whitespace(texts)
        pieces = lists.flatten().dictionary_encode()
        place = pieces.indices.to_numpy()
        cores, tails, ends = _cut(pieces.dictionary)
        parts = pa.concat_arrays([cores, tails]).dictionary_encode()
        every, at = parts.dictionary, parts.indices.to_numpy()
        held = self._held(every)
        flat = np.frombuffer(b"".join(held), self.dtype)
        sizes = np.fromiter(map(len, held), np.int64, len(held)) // self.dtype.itemsize
        starts = np.cumsum(sizes) - sizes
        # A piece is its core, and its tail if it has one.
        start, size = np.zeros((len(cores), 2), np.int64), np.zeros((len(cores), 2), np.int64)
        start[:, 0], size[:, 0] = starts[at[: len(cores)]], sizes[at[: len(cores)]]
        start[ends, 1], size[ends, 1] = starts[at[len(cores) :]], sizes[at[len(cores) :]]
        flat = _gather(flat, start.ravel(), size.ravel())
        sizes = size.sum(axis=1)
        own = sizes[place]
        ids = _gather(flat, (np.cumsum(sizes) - sizes)[place], own)
        bounds = np.concatenate([np.zeros(1, np.int64), np.cumsum(own)])[np.concatenate([np.zeros(1, np.int64), np.cumsum(lists.value_lengths().to_numpy())])]
        return ids, np.diff(bounds)

    def _held(self, every: pa.Array) -> list[bytes]:
        """The ids of each of the distinct parts, as bytes; new ones are encoded first."""
        known, names = self.known, every.to_numpy(zero_copy_only=False).tolist()
        new = [p for p in names if p not in known]
        if len(known) + len(new) > self.keep:
            known.clear()
            new = names
        plain, model, code = [], self.model.tokenize, self.code
        for p in new:
            if p.isalpha() and (p.isascii() or max(p) <= "\u00ff"):
                known[p] = array(code, [t.id for t in model(p if p.isascii() else p.encode("utf-8").decode("latin-1").translate(_BYTE_LEVEL))]).tobytes()
            else:
                plain.append(p)
        for at in range(0, len(plain), 4096):
            some = plain[at : at + 4096]
            for p, e in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False)):
                known[p] = array(code, e.ids).tobytes()
        return list(map(known.__getitem__, names))


def _cut(pieces: pa.Array) -> tuple[pa.Array, pa.Array, np.ndarray]:
    """Cores of all pieces, tails of some, and which have one: with the same ids, characters up to U+00FF are in lower case (as the vocabulary
    has it), and full stops and commas after a last letter apart, since the pre-tokenizer ends a word where its letters end. Pieces that may
    hold a special token, and those with other characters, stay as they are."""
    simple = pc.and_not(pc.match_substring_regex(pieces, "^[\\x00-\\x{FF}]*$"), pc.match_substring(pieces, "<|"))
    low = pc.if_else(simple, pc.utf8_lower(pieces), pieces)
    short = pc.ascii_rtrim(low, ".,")
    has = pc.and_(pc.and_(simple, pc.not_equal(short, low)), pc.match_substring_regex(short, "[a-z\\x{AA}\\x{B5}\\x{BA}\\x{DF}-\\x{F6}\\x{F8}-\\x{FF}]$"))
    return pc.if_else(has, short, low), pc.replace_substring_regex(low.filter(has), "^.*[^.,]", ""), has.to_numpy(zero_copy_only=False)


def _byte_level() -> dict[int, int]:
    """The byte-level alphabet: bytes that print stand for themselves, the others for 256, 257 and so on in order."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    return {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in prints)}


_BYTE_LEVEL = _byte_level()


STORE = "part int, seq int, first_doc long, n_docs long, n_tokens long, data binary"


def write_tokens(docs: DataFrame, path: str, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2, shard_tokens: int = 1 << 19, partition_bytes: int = 32 << 20) -> None:
    """Write token shards of all docs in ascending id order (null ids first, ties by text) under path.

    The end id follows each document; null and empty texts are the end id alone. A shard holds whole documents, so one longer than
    shard_tokens is a shard of its own. Other columns are ignored; an empty table writes no shards.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(1, -(-size // partition_bytes))
    rows = rows.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text").withColumn("part", F.spark_partition_id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = None, None
        ids, ends, names, total, seq, part_id = [], [], [], 0, 0, 0

        def shard() -> pa.RecordBatch:
            data = to_bytes(np.concatenate(ids), ends, names)
            return pa.RecordBatch.from_arrays([pa.array([part_id], pa.int32()), pa.array([seq], pa.int32()), pa.array([names[0]], pa.int64()), pa.array([len(names)], pa.int64()), pa.array([total], pa.int64()), pa.array([data], pa.binary())], names=["part", "seq", "first_doc", "n_docs", "n_tokens", "data"])

        for batch in batches:
            if encoder is None:
                encoder = Encoder.of(vocabulary)
                end = np.array([end_id], encoder.dtype)
            if batch.num_rows:
                part_id = batch.column(2)[0].as_py()
            for part in by_size(batch, 1):
                found, counts = encoder.encode(part.column(1))
                at = 0
                for doc, n in zip(part.column(0).to_pylist(), counts.tolist()):
                    if ids and total + n + 1 > shard_tokens:
                        yield shard()
                        ids, ends, names, total, seq = [], [], [], 0, seq + 1
                    ids += [found[at : at + n], end]
                    at += n
                    total += n + 1
                    ends.append(total)
                    names.append(doc)
        if ids:
            yield shard()

    rows.mapInArrow(run, STORE).write.option("parquet.block.size", 8 << 20).option("compression", "uncompressed").parquet(path)


def _bases(shards: DataFrame, group: int = 1024) -> DataFrame:
    """part, seq and base: the ids in all shards before. Sums go up from shards to parts (a range of documents each) and groups of parts, of which there is one for some
    32 GB of text, so few enough for the driver; running sums come down again within a group and within a part."""
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("n")).withColumn("of", F.floor(F.col("part") / group).cast("int"))
    sums, so_far, bases = sorted((r["of"], r["n"]) for r in parts.groupBy("of").agg(F.sum("n").alias("n")).collect()), 0, []
    for k, n in sums:
        bases.append((k, so_far))
        so_far += n
    groups = shards.sparkSession.createDataFrame(bases, "of int, begin long")
    before = lambda by, order: F.coalesce(F.sum("n").over(Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    begins = parts.withColumn("begin_part", before("of", "part")).join(groups, "of").select("part", (F.col("begin") + F.col("begin_part")).alias("begin"))
    own = shards.select("part", "seq", F.col("n_tokens").alias("n")).withColumn("inside", before("part", "seq"))
    return own.join(begins, "part").select("part", "seq", (F.col("begin") + F.col("inside")).alias("base"))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """A row per document from the shards: doc_id, start, n_tokens, ids_crc32. start counts the ids of all documents before it."""
    shards = spark.read.schema(STORE).parquet(path)
    base = _bases(shards)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                matrix, ends, docs = from_bytes(data.as_py())
                ids = matrix.decode().astype("<u4", copy=False)
                starts = np.concatenate([np.zeros(1, np.int64), ends[:-1]]).astype(np.int64)
                view = memoryview(ids).cast("B")
                sums = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays([pa.array([part] * len(docs), pa.int32()), pa.array([seq] * len(docs), pa.int32()), pa.array(docs, pa.int64()), pa.array(starts), pa.array(ends.astype(np.int64) - starts), pa.array(sums, pa.int64())], names=["part", "seq", "doc_id", "at", "n_tokens", "ids_crc32"])

    read = shards.select("part", "seq", "data").mapInArrow(run, "part int, seq int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return read.join(base, ["part", "seq"]).select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
