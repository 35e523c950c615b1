"""Fill-in-the-middle by a piece table.

A document is a list of pieces, each (buffer, start, bytes): buffer 0 is the document's own UTF-8 text, buffers 1, 2 and 3 are the sentinels. Neither
is ever changed or copied to cut and arrange a document: cutting splits the one piece of the whole text in three, and a form is a permutation of these
with sentinels between. Hashes run over the pieces in turn. The way back reads the output as a new buffer, splits it at the sentinels into pieces and
puts them in the order of the inverse permutation.

Cuts and forms are drawn from hashes of (seed, id), so that a task that runs again repeats them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import by_size, without

#: Prefix, suffix and middle sentinels.
SENTINELS = ("<P>", "<S>", "<M>")
#: The order in which a form puts prefix (0), middle (1) and suffix (2); each is led by its sentinel.
FORMS = {"psm": (0, 2, 1), "spm": (2, 0, 1)}
OUT = ["n", "form", "prefix_chars", "middle_chars", "pieces", "output", "output_sha256"]
_PIECE = pa.list_(pa.struct([("buffer", pa.int32()), ("start", pa.int64()), ("length", pa.int64())]))
_ADDED = "n long, form string, prefix_chars long, middle_chars long, pieces array<struct<buffer:int,start:long,length:long>>, output string, output_sha256 string"
_TEXT, _LEADS = 0, (1, 3, 2)  # buffers: the text; the sentinels that lead prefix, middle and suffix

Piece = tuple[int, int, int]


def unit_starts(text: bytes) -> np.ndarray:
    """Byte offsets at which the units [A-Za-z]+|[^A-Za-z] of a UTF-8 text begin."""
    b = np.frombuffer(text, np.uint8)
    letter = ((b | 32) >= 97) & ((b | 32) <= 122)
    after = np.concatenate([[False], letter[:-1]]) if len(b) else letter
    return np.flatnonzero((letter & ~after) | (~letter & ((b & 0xC0) != 0x80)))


def _chars(text: bytes, start: int, end: int) -> int:
    return int(np.count_nonzero((np.frombuffer(text, np.uint8)[start:end] & 0xC0) != 0x80))


def split(piece: Piece, cuts: Sequence[int]) -> list[Piece]:
    """A piece cut at offsets of its buffer, in ascending order."""
    buffer, start, length = piece
    edges = [start, *cuts, start + length]
    return [(buffer, a, b - a) for a, b in zip(edges, edges[1:])]


def arrange(parts: list[Piece], form: str, sentinels: Sequence[bytes]) -> list[Piece]:
    """Prefix, middle and suffix in the order of the form, each after its sentinel."""
    return [p for k in FORMS[form] for p in ((_LEADS[k], 0, len(sentinels[_LEADS[k] - 1])), parts[k])]


def stream(pieces: list[Piece], buffers: Sequence[bytes]) -> Iterator[memoryview]:
    """The bytes that pieces stand for, without copies."""
    for buffer, start, length in pieces:
        yield memoryview(buffers[buffer])[start : start + length]


def found_pieces(output: bytes, form: str, sentinels: Sequence[bytes]) -> list[Piece]:
    """Prefix, middle and suffix as pieces of an output, by its sentinels and the inverse of its form's permutation."""
    order, at, parts = FORMS[form], 0, {}
    for i, k in enumerate(order):
        at += len(sentinels[_LEADS[k] - 1])
        end = output.index(sentinels[_LEADS[order[i + 1]] - 1], at) if i + 1 < len(order) else len(output)
        parts[k] = (_TEXT, at, end - at)
        at = end
    return [parts[k] for k in sorted(parts)]


def _checked(sentinels: Sequence[str]) -> list[bytes]:
    """Sentinels as bytes; no end of one may begin another, or outputs could be read in two ways."""
    if len(sentinels) != 3 or len(set(sentinels)) != 3 or not all(sentinels):
        raise ValueError("three different sentinels are needed")
    for a in sentinels:
        for b in sentinels:
            if any(a[-k:] == b[:k] for k in range(1, min(len(a), len(b)) + (a != b))) or (a != b and a in b):
                raise ValueError(f"sentinels {a} and {b} can overlap")
    return [s.encode() for s in sentinels]


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1, plain_from: int = 90, spm_below: int = 20, sentinels: Sequence[str] = SENTINELS) -> DataFrame:
    """docs with n (units), form (plain, psm or spm), prefix_chars, middle_chars, pieces (the descriptors), output and output_sha256.

    h1 to h4 are the first four groups of 8 hexadecimal digits of sha256("seed:id"): cuts at h1 and h2 modulo n + 1 units; plain where h3 % 100 >= plain_from,
    spm where h4 % 100 < spm_below. Empty and null texts, and those that hold a sentinel, are plain; a null text counts as empty, a null id as an empty one. Repeated
    rows are rows of their own, with equal results. A very long text is a row like any other: it is held once, beside its output. Input columns of the added
    names are replaced; others pass through. An empty table gives an empty result.
    """
    buffers = _checked(sentinels)
    kept = docs.select(*without(docs, OUT))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"), 256)
    names = kept.columns
    width, place = len(names), names.index(text_col)
    rows = docs.select(*without(docs, OUT), digest.alias("__draw"))

    def one(text: bytes, draw: str):
        h = [int(draw[8 * k : 8 * k + 8], 16) for k in range(4)]
        starts = unit_starts(text)
        n, whole = len(starts), (_TEXT, 0, len(text))
        if not text or any(s in text for s in buffers) or h[2] % 100 >= plain_from:
            return n, "plain", None, None, [whole]
        cuts = [int(starts[k]) if k < n else len(text) for k in sorted((h[0] % (n + 1), h[1] % (n + 1)))]
        form = "spm" if h[3] % 100 < spm_below else "psm"
        return n, form, _chars(text, 0, cuts[0]), _chars(text, *cuts), arrange(split(whole, cuts), form, buffers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in by_size(batch, place):
                made = []
                for t, d in zip(b.column(place), b.column(width)):
                    text = t.as_buffer().to_pybytes() if t.is_valid else b""
                    *facts, pieces = one(text, d.as_py())
                    digest, out = hashlib.sha256(), bytearray()
                    for part in stream(pieces, (text, *buffers)):
                        digest.update(part)
                        out += part
                    made.append((*facts, [dict(zip(("buffer", "start", "length"), p)) for p in pieces], bytes(out), digest.hexdigest()))
                cols = list(zip(*made)) if made else [()] * 7
                types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), _PIECE, pa.binary(), pa.string()]
                arrays = [pa.array(c, t) for c, t in zip(cols, types)]
                arrays[5] = arrays[5].view(pa.string())
                yield pa.RecordBatch.from_arrays([*b.columns[:width], *arrays], names=[*names, *OUT])

    added = T.StructType.fromDDL(_ADDED)
    return rows.mapInArrow(run, T.StructType([*kept.schema.fields, *added.fields]))


def restored(output: Column, form: Column, sentinels: Sequence[str] = SENTINELS) -> Column:
    """The text that an output of a form was made of."""
    buffers = _checked(sentinels)

    @F.arrow_udf("string")
    def run(outputs: pa.Array, forms: pa.Array) -> pa.Array:
        texts = []
        for o, f in zip(outputs, forms):
            whole = o.as_buffer().to_pybytes() if o.is_valid else b""
            pieces = [(_TEXT, 0, len(whole))] if f.as_py() == "plain" else found_pieces(whole, f.as_py(), buffers)
            texts.append(b"".join(stream(pieces, (whole,))))
        return pa.array(texts, pa.binary()).view(pa.string())

    return run(output, form)
