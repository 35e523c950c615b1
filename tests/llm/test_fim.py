"""Fill-in-the-middle against brute force, and its way back."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from gridloom.llm import fim

SCHEMA = "doc_id long, text string, form string, n long, output string, pieces string"
TEXTS = ["", None, "a", " ", "abc def", "é漢字 x\n\ty", "with <S> inside", "<P", "tail <", "<M", "-" * 50, "word " * 30_000, "x" * 100_000]


def expected(doc, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n, d = len(units), hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(d[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def check(df):
    got = df.withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    for r in got:
        want = expected(r["doc_id"], r["text"])
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == want
        assert r["output_sha256"] == hashlib.sha256(want[-1].encode()).hexdigest() and r["back"] == (r["text"] or "")
        buffers = [(r["text"] or "").encode(), *(x.encode() for x in fim.SENTINELS)]
        assert b"".join(fim.stream([tuple(p) for p in r["pieces"]], buffers)).decode() == r["output"]
    return got


def test_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = check(fim.fill_in_middle(docs))
    assert len(got) == docs.count() and {r["form"] for r in got} == {"plain", "psm", "spm"}
    assert {r["source"] for r in got} == {r["source"] for r in docs.collect()}


def test_hard_cases(spark):
    """Nulls, blanks, very long texts, repeated rows, sentinels in texts and halves of them at cuts, columns of the added names."""
    given = [(i, t, "x", 7, "y", "z") for i, t in enumerate(TEXTS * 9)] + [(None, "no id", "x", 7, "y", "z"), (5, "twice", "x", 7, "y", "z"), (5, "twice", "x", 7, "y", "z")]
    out = fim.fill_in_middle(spark.createDataFrame(given, SCHEMA))
    assert sorted(out.columns) == sorted(["doc_id", "text", *fim.OUT])
    assert len(check(out)) == len(given)
    assert check(fim.fill_in_middle(spark.createDataFrame([], SCHEMA))) == []


@pytest.mark.parametrize("bad", [("<P>", "<P>", "<M>"), ("aba", "<S>", "<M>"), ("<P", "P>", "x"), ("<<P>>", "<P>", "x")])
def test_sentinels_that_overlap(bad):
    with pytest.raises(ValueError):
        fim._checked(bad)
