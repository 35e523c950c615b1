"""Removal of repeated strings against brute force; the index's parts against plain definitions."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from gridloom.llm import queries, repeats

SCHEMA = "doc_id long, text string, kept string, n_bytes string, spans string, row string, th string, marks string, key string, start string"


def expected(texts, length):
    """(n_removed, n_spans, kept) of each text, by counting all windows."""
    bodies = [(t or "").encode() for t in texts]
    held = Counter(b[i : i + length] for b in bodies for i in range(len(b) - length + 1))
    out = []
    for b in bodies:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if held[b[i : i + length]] > 1:
                gone[i : i + length] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[False], gone])))
        out.append((int(gone.sum()), len(edges) // 2, bytes(x for x, g in zip(b, gone) if not g)))
    return out


def check(spark, texts, length, most=1 << 20):
    given = [(None if i % 7 == 3 else i // 2, t, *"abcdefgh") for i, t in enumerate(texts)]
    df = spark.createDataFrame(given, SCHEMA).repartition(3)
    got = repeats.remove_repeats(df, length, most=most)
    assert got.columns == [c for c in df.columns if c not in repeats.OUT] + repeats.OUT
    rows = got.collect()
    want = Counter((None if i % 7 == 3 else i // 2, t, *w) for i, (t, w) in enumerate(zip(texts, expected(texts, length))))
    assert Counter((r["doc_id"], r["text"], sum(s["size"] for s in r["spans"]), len(r["spans"]), bytes(r["kept"])) for r in rows) == want
    assert all(r["n_bytes"] == len((r["text"] or "").encode()) and (r["row"], r["th"], r["marks"]) == ("d", "e", "f") for r in rows)
    return rows


def varied(seed, n, length):
    """Texts that share passages, are near copies of each other, or repeat themselves."""
    rng = random.Random(seed)
    word = lambda k: "".join(rng.choice("abé ") for _ in range(k))
    shared = [word(length * 2) for _ in range(4)]
    out = []
    for _ in range(n):
        t = "".join(rng.choice([word(rng.randint(0, 2 * length)), rng.choice(shared), rng.choice(shared)[: rng.randint(0, 2 * length)]]) for _ in range(rng.randint(0, 6)))
        if rng.random() < 0.3 and t:
            at = rng.randrange(len(t))
            out.append(t[:at] + "#" + t[at + 1 :])
        out.append(t)
    return out


@pytest.mark.parametrize("seed, length, most", [(1, 40, 1 << 20), (2, 12, 60), (3, 25, 100), (4, 5, 20), (5, 1, 3), (6, 40, 700)])
def test_against_brute_force(spark, seed, length, most):
    check(spark, varied(seed, 30, length), length, most)


def test_hard_cases(spark):
    """Nulls, blanks, periods, short texts, repeated rows, characters that are cut, very long texts."""
    long = "".join(random.Random(0).choices("abcdefghij", k=30_000))
    texts = [None, "", " ", "a" * 9000, "a" * 39, "ab" * 300, "xyz" * 20 + "!" + "xyz" * 20, long, long[10_000:10_100], long[:5000] + "?" + long[5000:9000], "é" * 30, "é" * 30, "漢字" * 8, "漢字" * 8 + "x"]
    for most in (1 << 20, 300):
        check(spark, texts, 40, most)
    empty = spark.createDataFrame([], SCHEMA)
    assert repeats.remove_repeats(empty).collect() == []
    alone = repeats.remove_repeats(spark.createDataFrame([(1, "b" * 1000, *"abcdefgh")], SCHEMA)).collect()
    assert [(r["spans"][0]["size"], bytes(r["kept"])) for r in alone] == [(1000, b"")]


def test_very_long_text(spark, monkeypatch):
    """Texts over a part's size are cut at its edges only for the work, and long periods into pieces."""
    monkeypatch.setattr(repeats, "_CHUNK", 100)
    monkeypatch.setattr(repeats, "_PIECE", 16)
    grams = repeats.Grams(5, 200)
    text = np.frombuffer(("abcdefghijklmnop" * 40 + "".join(random.Random(1).choices("abc", k=900))).encode(), np.uint8)
    parts = list(repeats.pieces_of(text, 20, grams))
    start, size = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    assert start[0] == 0 and (start[1:] == start[:-1] + size[:-1] - 19).all() and start[-1] + size[-1] == len(text)
    keys = {}
    for s, n, k in zip(start, size, np.concatenate([p[2] for p in parts])):
        for i in range(s, s + n - 19):
            assert keys.setdefault(bytes(text[i : i + 20]), k) == k


def test_index_against_definitions():
    rng = random.Random(5)
    for _ in range(60):
        pieces = [bytes(rng.choices(b"ab\x00\xff", k=rng.randint(1, 60))) * rng.randint(1, 3) for _ in range(rng.randint(1, 5))]
        symbols = np.concatenate([np.append(np.frombuffer(p, np.uint8).astype(np.int16) + 1, 0) for p in pieces]).astype(np.int16)
        ends = np.flatnonzero(symbols == 0)
        unlike = symbols.astype(int).tolist()
        for k, e in enumerate(ends):
            unlike[e] = k - len(ends)
        order = sorted(range(len(unlike)), key=lambda i: unlike[i:])
        assert repeats.suffix_order(symbols, repeats._packed(symbols)).tolist() == order
        index = repeats.run_length_index(symbols)
        assert index.count.sum() == len(symbols) and np.repeat(index.symbol, index.count).tolist() == symbols[np.array(order) - 1].tolist()
        alike = lambda i, j: next((k for k in range(len(unlike)) if i + k >= len(unlike) or j + k >= len(unlike) or unlike[i + k] != unlike[j + k]), 0)
        want = [max((alike(i, j) for j in range(len(unlike)) if j != i), default=0) for i in range(len(unlike))]
        assert repeats.matching_statistics(index).tolist() == want


def test_repetitive_text_has_few_runs():
    unit = bytes(random.Random(2).choices(range(97, 123), k=500))
    symbols = np.tile(np.append(np.frombuffer(unit, np.uint8).astype(np.int16) + 1, 0), 40).astype(np.int16)
    assert len(repeats.run_length_index(symbols).symbol) < 700


def test_query(spark, sf):
    table = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = {r["doc_id"]: (n, k, hashlib.sha256(kept).hexdigest()) for r, (n, k, kept) in zip(table, expected([r["text"] for r in table], 400))}
    got = queries.op11_repeats(spark, sf).collect()
    assert {r["doc_id"]: (r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got} == want
    assert sum(n > 0 for n, *_ in want.values()) > 3


def test_spans_of_hot_keys_are_runs(spark, monkeypatch):
    """Parts of a key that is taken apart repeat window by window: what is joined to its places has them as runs."""
    rng, kept, written = random.Random(3), [], repeats.written

    def seen(df, label):
        out = written(df, label)
        if label == "spans":
            kept.extend([(s["start"], s["start"] + s["size"]) for s in r["spans"]] for r in out.collect())
        return out

    monkeypatch.setattr(repeats, "written", seen)
    line = "".join(rng.choice("abcdefgh") for _ in range(60))
    texts = ["".join(rng.choice("abcdefgh") for _ in range(9)) + line[rng.randrange(8) :] + "".join(rng.choice("abcdefgh") for _ in range(9)) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    repeats.remove_repeats(docs, length=24, most=400).collect()
    assert kept and all(repeats.merged(x) == sorted(x) for x in kept)


def test_windows_of_hot_keys_are_packed(spark, monkeypatch):
    """A key that stays hot is settled without a row for each of its windows: lines repeated over and over, a passage in many contexts, near copies."""
    rng, rows, written = random.Random(4), [], repeats.written
    word = lambda k: "".join(rng.choice("abcdefgh") for _ in range(k))

    def seen(df, label):
        out = written(df, label)
        rows.append((label, out.count()))
        return out

    monkeypatch.setattr(repeats, "written", seen)
    line, passage, near = word(7), word(60), word(80)
    texts = [word(3) + line * rng.randint(20, 60) + word(3) for _ in range(40)]
    texts += [word(20) + passage + word(20) for _ in range(40)]
    texts += [near[:at] + word(1) + near[at + 1 :] for at in (rng.randrange(80) for _ in range(40))]
    docs = spark.createDataFrame([(None if i % 7 == 3 else i, t) for i, t in enumerate(texts + texts[:9])], "doc_id long, text string")
    got = repeats.remove_repeats(docs, length=24, most=600).collect()
    want = Counter((t, *w) for t, w in zip(texts + texts[:9], expected(texts + texts[:9], 24)))
    assert Counter((r["text"], sum(s["size"] for s in r["spans"]), len(r["spans"]), bytes(r["kept"])) for r in got) == want
    windows = sum(len(t) - 23 for t in texts)
    assert windows > 15_000 and max(n for _, n in rows) < windows / 8
