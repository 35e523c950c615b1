"""The dealt operators against brute force on small tables, and on hard cases: nulls, blanks, long texts, ties, repeats, clashing names."""

import base64
import hashlib
import itertools
import math
import re
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from gridloom.llm import chat, decontaminate, graph, langid, line_dedup, mixing, quality, queries, sharding, similar, simhash, token_store, warc
from gridloom.llm.common import new_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, shard string, row string, size string, score string, id string"
LONG = " ".join(f"word{i % 977}" for i in range(30_000))
HARD = [
    (1, "one two three four five six seven eight nine ten\none two three four five six seven eight nine ten", "en", "a", 0),
    (2, "one two three four five six seven eight nine ten\none two three four five SIX seven eight nine zehn", "en", "a", 0),
    (3, "", "en", "b", 0),
    (4, None, None, None, None),
    (5, " \t\n ", "de", "b", 0),
    (6, LONG, "de", None, 0),
    (6, LONG, "de", None, 0),
    (7, "ab  \x1fcd\u00a0ef\r\ngh 漢字 ελληνικά кириллица <s> </s>", "xx", "", 0),
    (None, "no id here at all but some words to be found in it", "en", "a", 0),
    (9, "#### $$$ %%% &&&", "en", "c", 0),
    (10, "a", "en", "c", 0),
]


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="module")
def hard(spark):
    return spark.createDataFrame([(*r, "x", "y", "z", "w", "v") for r in HARD], DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def words(text):
    return WORD.findall(text or "")


# 1: archive


def warc_expected(pages, least):
    groups = defaultdict(list)
    for p in pages:
        body = (p["html"] or "").encode()
        groups[body].append(p["page_id"])
    out = Counter()
    for body, ids in groups.items():
        first = max((i for i in ids if i is not None), default=None)
        for i in ids:
            response = i == first or len(body) < least
            out[i, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "response" if response else "revisit", None if response else first] += 1
    return out


@pytest.mark.parametrize("least", [0, 5])
def test_warc(spark, sf, least):
    extra = [(9001, "http://a/\r\nX: y", "same"), (9002, None, "same"), (9003, "http://c", None), (9004, "http://d", ""), (None, "http://e", "same"), (9005, "http://f", "x\r\n\r\nWARC/1.1\r\n"), (9002, None, "same")]
    pages = queries.table(spark, sf, "pages").unionByName(spark.createDataFrame(extra, "page_id long, url string, html string"))
    path = new_path(spark, "warc")
    warc.write_archive(pages, path, least_bytes=least)
    got = Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows(warc.read_archive(spark, path)))
    assert got == warc_expected(rows(pages), least)
    whole = rows(warc.reconstruct(spark, path))
    assert Counter((r["page_id"], bytes(r["payload"])) for r in whole) == Counter((p["page_id"], (p["html"] or "").encode()) for p in rows(pages))
    files = new_path(spark, "files")
    warc.export_warc(spark, path, files, rows_per_file=50)
    read = rows(warc.read_warc(spark, files))
    assert Counter(r["header"].encode() + b"" + bytes(r["block"]) + b"\r\n\r\n" for r in read) == Counter(bytes(r["record"]) for r in whole)
    assert spark.read.parquet(f"{path}/payloads").count() == len({(p["html"] or "") for p in rows(pages)})


def test_warc_empty(spark):
    path = new_path(spark, "warc")
    warc.write_archive(spark.createDataFrame([], "page_id long, url string, html string, strong int"), path)
    assert rows(warc.read_archive(spark, path)) == [] and rows(warc.reconstruct(spark, path)) == []
    files = new_path(spark, "files")
    warc.export_warc(spark, path, files)
    assert rows(warc.read_warc(spark, files)) == []


def test_warc_large_payloads_and_empty_urls(spark):
    """Payloads over a slice's size come back whole, one after the other; an empty url isn't a missing one."""
    path, big = new_path(spark, "warc"), "0123456789abcdef" * 600_000
    given = [(1, "", big), (2, None, big + "x"), (3, "http://a", big), (4, "http://b", "small")]
    warc.write_archive(spark.createDataFrame(given, "page_id long, url string, html string").coalesce(1), path)
    assert {r["page_id"]: (r["target_uri"], r["payload_bytes"], r["record_type"]) for r in rows(warc.read_archive(spark, path))} == {1: ("", len(big), "revisit"), 2: (None, len(big) + 1, "response"), 3: ("http://a", len(big), "response"), 4: ("http://b", 5, "response")}
    assert {r["page_id"]: bytes(r["payload"]).decode() for r in rows(warc.reconstruct(spark, path))} == {i: t for i, _, t in given}


# 2: mixing


def target_expected(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, fixed = 1.5 * sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in fixed]
        level = (total - sum(2 * sizes[s] for s in fixed)) / max(1, sum(weight[s] for s in free))
        over = {s for s in free if level * weight[s] > 2 * sizes[s]}
        if not over:
            return {s: 2.0 * sizes[s] if s in fixed else level * weight[s] for s in order}
        fixed |= over


@pytest.mark.parametrize("how", [{}, {"shard_words": 5000}, {"shard_words": 2000, "block_words": 3}])
def test_mixing(docs, hard, how):
    for table in (docs, hard):
        given = rows(table)
        sizes = defaultdict(int)
        for r in given:
            sizes[r["source"]] += len(words(r["text"]))
        expected = target_expected(dict(sizes))
        got = rows(mixing.mix(table, keep_row=True, **how))
        assert len(got) == len(given)
        taken = defaultdict(int)
        shards = len({r["shard"] for r in got})
        for r in got:
            source = r["row"]["source"]
            assert r["size"] == len(words(r["row"]["text"])) and r["source_size"] == sizes[source]
            assert math.isclose(r["target"], expected[source], rel_tol=1e-9, abs_tol=1e-6)
            assert 0 <= r["taken"] <= 2 * r["size"]
            assert r["taken"] == r["passes"] * r["size"] + sum(s["to"] - s["from"] for s in r["spans"])
            taken[source] += r["taken"]
        for s, t in expected.items():
            assert abs(taken[s] - t) <= 2 * how.get("block_words", 16) * shards, (s, taken[s], t)
        again = mixing.mix(table.repartition(3), **how).select("doc_id", "size", "taken")
        assert Counter(map(tuple, again.collect())) == Counter((r["doc_id"], r["size"], r["taken"]) for r in got)
        made = rows(mixing.mixed_documents(table, **how))
        assert sum(len(words(r["text"])) for r in made) == sum(taken.values())


@pytest.mark.parametrize("capped", [False, True])
def test_quotas_are_highest_quotients(spark, capped):
    rng = np.random.default_rng(0)
    sources = [(f"s{i}", int(t) // 2 if capped and i % 3 == 0 else 10_000, float(int(t) // 2 * 2)) for i, t in enumerate(rng.integers(1, 3000, 30))]
    got = {r["source"]: r["quota"] for r in rows(mixing.quotas(spark.createDataFrame(sources, "source string, source_size long, target double"), 16))}
    left, expected = int(sum(t for *_, t in sources) / 16 + 0.5), {s: 0 for s, *_ in sources}
    for _, s, k in sorted((-t / (2 * k - 1), s, k) for s, n, t in sources for k in range(1, -(-n // 16) * 2 + 1)):
        if left and expected[s] == k - 1:
            expected[s], left = k, left - 1
    assert got == expected and (not capped or any(got[s] == -(-n // 16) * 2 for s, n, _ in sources))


def test_shard_quotas_add_up(spark):
    """A source of a few words in each of many shards still gets its share."""
    parts = [(shard, s, n) for shard in range(200) for s, n in (("big", 9000), ("small", 5), ("tiny", 1 if shard % 50 == 0 else 0))]
    sizes = {"big": 9000 * 200, "small": 1000, "tiny": 4}
    whole = spark.createDataFrame([(s, n, 1.5 * n) for s, n in sizes.items()], "source string, source_size long, target double")
    plan = rows(mixing.shard_quotas(spark.createDataFrame(parts, "shard int, source string, words long"), mixing.quotas(whole, 16), 16))
    quota = Counter()
    for r in plan:
        quota[r["source"]] += r["quota"]
        assert 0 <= r["quota"] <= 2 * -(-r["words"] // 16)
    assert all(abs(16 * quota[s] - 1.5 * n) <= 16 for s, n in sizes.items())


def test_mixing_empty(none):
    assert rows(mixing.mix(none)) == [] and rows(mixing.mixed_documents(none)) == []


# 3: SimHash


def fingerprint_expected(text, size=3):
    found = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in words(text)]
    if not found:
        return 0
    own = [" ".join(found[i : i + size]) for i in range(len(found) - size + 1)] or [" ".join(found)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in own]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_expected(prints):
    root = {i: i for i in range(len(prints))}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(range(len(prints)), 2):
        if (prints[a] ^ prints[b]).bit_count() <= 3:
            root[find(a)] = find(b)
    return [find(i) for i in range(len(prints))]


@pytest.mark.parametrize("dense", [64, 2])
def test_simhash(docs, hard, dense):
    for table in (docs, hard):
        given = rows(table)
        prints = [fingerprint_expected(r["text"]) for r in given]
        group = groups_expected(prints)
        least = defaultdict(lambda: None)
        for r, g in zip(given, group):
            if r["doc_id"] is not None and (least[g] is None or r["doc_id"] < least[g]):
                least[g] = r["doc_id"]
        expected = Counter((r["doc_id"], f"{p:016x}", least[g]) for r, p, g in zip(given, prints, group))
        assert Counter(map(tuple, simhash.simhash_groups(table, dense=dense).collect())) == expected


@pytest.mark.parametrize("dense", [64, 3])
def test_hamming_families(spark, dense):
    rng = np.random.default_rng(3)
    prints = set()
    for _ in range(12):
        base = int(rng.integers(0, 1 << 63))
        for _ in range(25):
            prints.add(base ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 7), replace=False)))
    prints = sorted(prints)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    links = simhash.hamming_links(spark.createDataFrame(signed, "fp long"), dense=dense)
    if dense == 64:
        expected = {frozenset((a, b)) for a, b in itertools.combinations(prints, 2) if (a ^ b).bit_count() <= 3}
        assert {frozenset((r["u"] % (1 << 64), r["v"] % (1 << 64))) for r in rows(links)} == expected
    root = {r["u"] % (1 << 64): r["root"] % (1 << 64) for r in rows(graph.components(links))}
    mine, true = defaultdict(set), defaultdict(set)
    for p, g in zip(prints, groups_expected(prints)):
        true[g].add(p)
        mine[root.get(p, p)].add(p)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, true.values()))


def test_components_of_a_long_path(spark):
    path = spark.range(300).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    assert {r["root"] for r in rows(graph.components(path))} == {0}
    assert rows(graph.components(path.where("u < 0"))) == []


def test_keep_first(hard, none):
    kept = rows(similar.keep_first(hard))
    assert sorted(r["doc_id"] for r in kept if r["doc_id"] is not None) == [1, 3, 6, 7, 9, 10]
    assert sum(r["doc_id"] is None for r in kept) == 1
    assert rows(similar.keep_first(none)) == []


# 4: lines


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    a, b = (a, b) if len(a) > len(b) else (b, a)
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def lines_expected(given, least=8):
    first = {}
    places = sorted(((r["doc_id"] if r["doc_id"] is not None else -(1 << 63), i, line) for r in given if r["text"] is not None for i, line in enumerate(r["text"].split("\n"))), key=lambda p: p[:2])
    for d, i, line in places:
        key = tuple(words(line.lower()))
        if key:
            first.setdefault(key, (d, i))
    near_to = set()
    ends = defaultdict(list)
    for key in first:
        if len(key) >= least:
            for n in range(2):
                ends["f", key[: len(key) // 2 - n]].append(key)
                ends["r", key[len(key) - len(key) // 2 + n :]].append(key)
    for group in ends.values():
        for a, b in itertools.combinations(group, 2):
            if near(a, b):
                near_to.add(max(first[a], first[b]))
    out = Counter()
    for r in given:
        lines = r["text"].split("\n") if r["text"] is not None else []
        d = r["doc_id"] if r["doc_id"] is not None else -(1 << 63)
        stay = [x for i, x in enumerate(lines) if not words(x) or (first[tuple(words(x.lower()))] == (d, i) and (d, i) not in near_to)]
        n_near = sum(bool(words(x)) and first[tuple(words(x.lower()))] == (d, i) and (d, i) in near_to for i, x in enumerate(lines))
        out[r["doc_id"], len(lines), len(lines) - len(stay) - n_near, n_near, "\n".join(stay) if r["text"] is not None else None] += 1
    return out


def test_lines(spark, docs, hard, none):
    extra = [(100, "p q r s t u v w x\n\np q r s t u v w y"), (101, "p q r s t u v w\nz p q r s t u v w x"), (102, "p q r s t u v w x\r\n P  q r s t u v w x "), (103, "b b b c d e f g h\nb b c d e f g h\nb c b b d e f g h\nb b b b c d e f g h")]
    for table in (spark.createDataFrame(extra, "doc_id long, text string"), docs, hard, none):
        assert Counter(map(tuple, line_dedup.dedup_lines(table).collect())) == lines_expected(rows(table))


def test_lines_with_many_shared_ends(spark, docs, monkeypatch):
    """Keys beyond the bit table are joined, with the same result."""
    marked = Counter(map(tuple, line_dedup.dedup_lines(docs).collect()))
    monkeypatch.setattr(line_dedup._among, "__defaults__", (0,))
    assert Counter(map(tuple, line_dedup.dedup_lines(docs).collect())) == marked


def test_long_line_of_one_word(spark):
    n = 20_000
    got = line_dedup.dedup_lines(spark.createDataFrame([(1, " ".join(["ha"] * n)), (2, " ".join(["ha"] * (n - 1))), (3, " ".join(["ha"] * (n - 3)))], "doc_id long, text string"))
    assert sorted((r["doc_id"], r["n_near"]) for r in got.collect()) == [(1, 0), (2, 1), (3, 0)]


# 5: quality


def quality_expected(text):
    found = words(text)
    seen = Counter(tuple(found[i : i + 5]) for i in range(len(found) - 4))
    covered = {j for i in range(len(found) - 4) if seen[tuple(found[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    n = len(found)
    return n, sum(map(len, found)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered), n < 10 or 100 * len(covered) > 20 * n


def test_quality(spark, docs, hard, none, sf):
    twice = spark.createDataFrame([(1, "a b c d e a b c d e x"), (2, "a a a a a a a a a a a a"), (3, "q a b c d e f a b c d e f g h i j k l m n o p q r s t u v w x y z 1 2 3 4 5 6 7 8 9")], "doc_id long, text string")
    for table in (docs, hard, none, twice):
        out = rows(quality.quality_rules(table))
        assert Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in out) == Counter((r["doc_id"], *quality_expected(r["text"])) for r in rows(table))
        assert not any(r["kept"] and r["base_failed"] for r in out)
    labels = {r["doc_id"]: r["quality"] for r in rows(spark.read.parquet(f"{sf}/labels.parquet"))}
    judged = [(r["kept"], labels[r["doc_id"]]) for r in rows(quality.quality_rules(docs)) if r["doc_id"] in labels and r["n_words"] >= 10]
    assert sum(k == bool(q) for k, q in judged) >= 0.97 * len(judged)


# 6: tokens


def test_tokens(spark, docs, hard, none):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    odd = spark.createDataFrame([(-3, "it's I'LL <|endoftext|>a b<|startoftext|> e\u0301 \u0301x ΣΑΣ Σ 1234 a\u2003b \x1c x"), (-2, "<|endoftext|>"), (-1, "The. the, THE., é.. É., e\u0301. İ. a.b. 1. '. it's. IT'S., <|ENDOFTEXT|>. <|endoftext|>. ... , ß. x.")], "doc_id long, text string")
    for table, most in ((docs, 1 << 21), (docs, 3000), (hard, 100), (none, 100), (odd, 5)):
        to = new_path(spark, "tokens")
        token_store.write_tokens(table, to, path, shard_tokens=most, partition_bytes=100_000)
        given = sorted(((r["doc_id"], r["text"] or "") for r in rows(table)), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        start, expected = 0, Counter()
        for doc, text in given:
            ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
            expected[doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
            start += len(ids)
        assert Counter(map(tuple, token_store.read_tokens(spark, to).collect())) == expected


@pytest.mark.parametrize("n,symbols", [(0, 5), (1, 1), (511, 7), (512, 300), (5000, 40_000), (3000, 1)])
def test_wavelet(n, symbols):
    ids = np.random.default_rng(n).integers(0, symbols, n).astype(np.uint16)
    m, ends, docs = token_store.from_bytes(token_store.to_bytes(ids, [n], [None]))
    assert docs == [None] and list(ends) == [n] and np.array_equal(m.decode(), ids)
    for at in range(0, n, max(1, n // 50)):
        assert m.access(at) == ids[at]
        s = int(ids[at])
        assert m.count(s) == int((ids == s).sum()) and m.count(s, at // 2, at) == int((ids[at // 2 : at] == s).sum())
        assert m.locate(s)[:20] == np.flatnonzero(ids == s)[:20].tolist()
    assert m.count(symbols + 1) == 0


# 7: chat

TURNS = [
    (1, 0, "user", "hi <s> \\ [INST"), (1, 1, "assistant", "\\</s>[INST] ok [/INST]\\\\n"), (2, 0, "assistant", " starts "), (2, 0, "assistant", " starts "),
    (3, 1, "tool", "a\n[/ROLE]"), (3, 0, "user]\n x", None), (3, 2, None, ""), (3, None, "system", "<<SYS>>\n\n<</SYS>>\n"), (None, 5, "user", "漢字"), (4, 0, "system", "s"), (4, 1, "user", "u"), (4, 2, "assistant", LONG),
]


def chat_expected(turns):
    by = defaultdict(list)
    for t in turns:
        by[t["conv_id"]].append((t["turn"] is not None, t["turn"] or 0, t["role"] or "", t["text"] or ""))
    out = {}
    for conv, own in by.items():
        own.sort()
        said = "".join(t for _, _, r, t in own if r == "assistant")
        out[conv] = (len(own), hashlib.sha256("".join(f"{r}\n{t}\n" for _, _, r, t in own).encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest())
    return out


@pytest.mark.parametrize("most", [1 << 20, 10])
def test_chat(spark, sf, most):
    odd = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string").withColumn("chunk", F.lit("x"))
    for table in (odd, queries.table(spark, sf, "conversations"), odd.where("false")):
        made = chat.format_conversations(table, chunk_chars=most)
        got = {r["conv_id"]: r for r in rows(chat.digests(made))}
        assert {c: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for c, r in got.items()} == chat_expected(rows(table))
        chars = defaultdict(int)
        for r in rows(made):
            chars[r["conv_id"]] += len(r["text"])
            assert "".join(r["text"][s["start"] : s["stop"]] for s in r["segments"]) == r["text"]
        assert {c: r["formatted_chars"] for c, r in got.items()} == chars
    got = {r["conv_id"]: (r["valid"], r["broken_at"]) for r in rows(chat.digests(chat.format_conversations(odd, chunk_chars=most)))}
    assert got == {1: (True, -1), 2: (False, 0), 3: (False, 1), None: (False, -1), 4: (True, -1)}


# 8: benchmark


def leaks_expected(docs, items, bound=0.8):
    out = {}
    for d in docs:
        found = decontaminate.plain_words(d["text"])
        for item in items:
            w = decontaminate.plain_words(item["text"])
            if not w or not found:
                continue
            g, length = min(5, len(w)), min(len(w), len(found))
            if length < g:
                continue
            mine = Counter(tuple(w[i : i + g]) for i in range(len(w) - g + 1))
            best = 0.0
            for s in range(len(found) - length + 1):
                own = found[s : s + length]
                here = Counter(tuple(own[i : i + g]) for i in range(length - g + 1))
                both = sum((here & mine).values())
                best = max(best, both / (here.total() + mine.total() - both))
            if best >= bound - 1e-12:
                out[d["doc_id"], item["item_id"]] = round(best, 9)
    return out


def test_leaks(spark, docs, hard, none, sf):
    benchmark = queries.table(spark, sf, "benchmark")
    items = rows(benchmark)
    long_item = max(items, key=lambda r: len(r["text"]))["text"].split()
    changed = [*long_item[:10], "changed", *long_item[11:]]
    planted = [(500, "Before. " + " ".join(long_item).upper() + "! after"), (501, " ".join(["x"] * 30 + changed + ["y"] * 9)), (502, " ".join(long_item[:-3])), (503, " ".join(long_item[: len(long_item) // 2])), (504, " ".join(["k", *long_item[:20], "inserted", *long_item[20:]]))]
    small = docs.select("doc_id", "text").where(F.length("text") < 6000).limit(80).unionByName(spark.createDataFrame(planted, "doc_id long, text string"))
    more = benchmark.unionByName(spark.createDataFrame([(900, "one two three"), (901, ""), (902, None), (903, "four five SIX, seven eight")], "item_id long, text string"))
    for table, size in ((small, 8 << 20), (small, 3000), (hard, 8 << 20), (none, 8 << 20)):
        got = rows(decontaminate.find_leaks(table, more, block_bytes=size))
        assert Counter(r["doc_id"] for r in got) == Counter(r["doc_id"] for r in rows(table))
        assert {(r["doc_id"], x["item_id"]): round(x["similarity"], 9) for r in got for x in r["leaks"]} == leaks_expected(rows(table), rows(more))
    assert all(not r["leaks"] for r in rows(decontaminate.find_leaks(small, benchmark.where("false"))))


def test_block_index():
    """within() against all fingerprints, at and about the radius; a random fingerprint meets less than a tenth of them."""
    rng = np.random.default_rng(5)
    prints = rng.integers(0, 1 << 16, (3000, 8), dtype=np.uint16)
    asked = [*prints[:5], *rng.integers(0, 1 << 16, (20, 8), dtype=np.uint16)]
    for n in (1, 20, 31, 32, 40):
        for base in prints[:10]:
            bits = np.zeros(128, np.uint8)
            bits[rng.choice(128, n, replace=False)] = 1
            asked.append(base ^ np.packbits(bits).view(np.uint16))
    for radius in (3, 31):
        index = decontaminate.BlockIndex(prints, radius)
        for fp in asked:
            assert index.within(fp).tolist() == np.flatnonzero(np.bitwise_count(prints ^ fp).sum(axis=1) <= radius).tolist()
    share = np.mean([len(index.candidates(fp)) / len(prints) for fp in rng.integers(0, 1 << 16, (50, 8), dtype=np.uint16)])
    assert 0.07 < share < 0.1


def test_window_fingerprints():
    """Sums along the text against each window by itself."""
    found = [f"w{i * i % 37}".encode() for i in range(400)]
    starts = np.array([0, 1, 2, 30, 31, 200, 260, 330])
    for size, windows in ((5, 20), (1, 3), (5, 66)):
        whole = decontaminate.fingerprints(found, size, starts, windows)
        for s, fp in zip(starts.tolist(), whole):
            own = [xxhash.xxh128_intdigest(b" ".join(found[i : i + size])) for i in range(s, s + windows)]
            expected = [2 * sum(h >> (127 - k) & 1 for h in own) > windows for k in range(128)]
            assert np.packbits(expected).view(np.uint16).tolist() == fp.tolist()


def test_items_that_share_a_shingle(spark):
    """A shingle of every item, and a document of it alone: work follows the items' lengths, not the items."""
    shared = "terms of use apply here"
    items = spark.range(3000).select(F.col("id").alias("item_id"), F.concat_ws(" ", F.lit(shared), *(F.concat(F.lit(c), F.col("id")) for c in "abcdefghij")).alias("text"))
    index = decontaminate.Index([(r["item_id"], r["text"]) for r in items.collect()], 5, 0.8, 31)
    assert len(index.shingle_lengths) == len(index.length_first) - 1
    docs = spark.createDataFrame([(1, " ".join([shared] * 2000)), (2, shared + " a7 b7 c7 d7 e7 f7 g7 h7 i7 j7 " + shared)], "doc_id long, text string")
    assert {r["doc_id"]: [x["item_id"] for x in r["leaks"]] for r in rows(decontaminate.find_leaks(docs, items))} == {1: [], 2: [7]}


def test_suspects_hold_all_leaks(spark, docs, sf):
    """The bit table of the items' shingles loses no text that leaks, however full it is, and the corpus is read once for it."""
    items = queries.table(spark, sf, "benchmark")
    named = items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    texts = docs.select(F.xxhash64("text").alias("h1"), F.col("doc_id").alias("h2"), "text")
    leaks = {r["doc_id"] for r in rows(decontaminate.find_leaks(docs, items)) if r["leaks"]}
    kept = {r["h2"] for r in rows(decontaminate._held(texts, named, 5, 0.8))}
    assert leaks <= kept and len(kept) < 3 * len(leaks) + 10
    full = decontaminate.TABLE_BITS
    try:
        decontaminate.TABLE_BITS = 1 << 10
        assert leaks <= {r["h2"] for r in rows(decontaminate._held(texts, named, 5, 0.8))}
    finally:
        decontaminate.TABLE_BITS = full


# 9: shards


@pytest.mark.parametrize("chunk", [1 << 14, 4])
def test_shards(spark, docs, hard, none, chunk):
    for table in (docs, hard, none):
        got = rows(sharding.shard_documents(table, bucket_rows=chunk))
        given = rows(table)
        assert Counter((r["doc_id"], r["text"], r["size"], r["text_crc32"]) for r in got) == Counter((r["doc_id"], r["text"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())) for r in given)
        by, where = defaultdict(list), {}
        for r in got:
            by[r["shard"]].append(r["slot"])
            assert r["grown_shard"] in (r["shard"], 8) and r["law"] == "key" and 0 <= r["shard"] < 8
            assert where.setdefault(r["doc_id"], r["shard"]) == r["shard"]
        assert all(sorted(s) == list(range(len(s))) for s in by.values())
        again = sharding.shard_documents(table.repartition(3), bucket_rows=chunk)
        assert Counter((r["doc_id"], r["shard"], r["slot"]) for r in rows(again)) == Counter((r["doc_id"], r["shard"], r["slot"]) for r in got)
        assert "BroadcastExchange" not in again._jdf.queryExecution().toString()


def test_permutation_is_fisher_yates(spark):
    perm = rows(spark.range(40).select(F.col("id"), sharding._permutation((F.col("id") + 1).cast("int"), F.lit(3)).alias("p")))
    assert all(sorted(r["p"]) == list(range(r["id"] + 1)) for r in perm)
    assert sum(r["p"] == list(range(r["id"] + 1)) for r in perm) < 5
    for r in perm:
        n = r["id"] + 1
        want = list(range(n))
        for i in range(n - 1, 0, -1):
            j = int(hashlib.md5(f"3:{i}".encode()).hexdigest()[:15], 16) % (i + 1)
            want[i], want[j] = want[j], want[i]
        assert r["p"] == want


# 10: languages


def viterbi_expected(scores, penalty):
    best, back = list(scores[0]), []
    for s in scores[1:]:
        top = int(np.argmax(best))
        back.append([k if best[k] >= best[top] - penalty else top for k in range(len(s))])
        best = [max(best[k], best[top] - penalty) + s[k] for k in range(len(s))]
    path = [int(np.argmax(best))]
    for b in reversed(back):
        path.append(b[path[-1]])
    return path[::-1]


def test_viterbi():
    rng = np.random.default_rng(0)
    lengths = np.array([1, 7, 1, 30, 7, 2, 100])
    scores = rng.normal(size=(lengths.sum(), 4)).astype(np.float32)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    got = langid.viterbi(scores, starts, lengths, 1.5)
    for s, n in zip(starts, lengths):
        assert got[s : s + n].tolist() == viterbi_expected(scores[s : s + n].astype(float), 1.5)


def test_steady_sequences_are_what_viterbi_gives():
    rng = np.random.default_rng(1)
    settled = 0
    for _ in range(400):
        n = int(rng.integers(1, 40))
        scores = (rng.normal(size=(n, 3)) * 0.7 + [0.9, 0, 0]).astype(np.float32)
        k = langid.steady(scores, 1.5)
        full = langid.viterbi(scores, np.array([0]), np.array([n]), 1.5)
        settled += k >= 0
        assert k < 0 or set(full.tolist()) == {k}
        assert langid.label(scores, np.array([0]), np.array([n]), 1.5).tolist() == full.tolist()
    assert 50 < settled < 400


def words_of_letters(text):
    out = [""]
    for c in text or "":
        out = [*out[:-1], out[-1] + c] if unicodedata.category(c)[0] == "L" else [*out, ""]
    return [w for w in out if w]


def prediction_expected(text, model, penalty=4.0):
    """One word and one n-gram at a time."""
    found, scores = words_of_letters(text), []
    for w in found:
        codes, held = [ord(c) for c in f"^{w.lower()}$"], []
        for n in (1, 2, 3):
            for i in range(len(codes) - n + 1):
                if n > 1 or 0 < i < len(codes) - 1:
                    h = codes[i]
                    for c in codes[i + 1 : i + n]:
                        h = (h * 1_000_003 + c) % (1 << 64)
                    held.append(model.odds[((h * 0x9E3779B97F4A7C15) % (1 << 64) >> 32) % len(model.odds)].astype(float))
        script = next((langid._NAMES.index(name) for name, low, high in langid.SCRIPTS if low <= ord(w.lower()[0]) <= high), 0)
        can = model.allowed[script] if model.allowed[script].any() else np.ones(len(model.languages), bool)
        scores.append(np.where(can, 3 * np.mean(held, axis=0), -50.0))
    if not found:
        return "und", 0.0
    path = viterbi_expected(np.array(scores), penalty)
    mass, trust = Counter(), Counter()
    for w, s, k in zip(found, scores, path):
        mass[k] += len(w)
        trust[k] += len(w) * np.exp(s[k] - max(s)) / np.exp(s - max(s)).sum()
    best = max(mass, key=lambda k: (mass[k], -k))
    return model.languages[best], trust[best] / sum(mass.values())


def test_predictions_against_brute_force(docs, hard):
    model = langid.train(docs)
    texts = [r["text"] for r in rows(docs.where(F.length("text") < 1500).limit(60))] + [t for _, t, *_ in HARD if t is None or len(t) < 2000]
    texts += ["\u00b2 \u00bd \u2460 \u2167 123 _", "x\u00b2y", "\u4e00\u4e8c word", "\u0440\u0443\u0441\u0441\u043a\u0438\u0439 and english", "na\u00efve caf\u00e9 \u00df"]
    for (lang, score), text in zip(zip(*langid.predict(texts, model)), texts):
        want, value = prediction_expected(text, model)
        assert lang == want and abs(score - value) < 1e-3, (text, lang, want, score, value)
    assert langid.predict(["\u00b2 \u00bd \u2460 \u2167"], model) == (["und"], [0.0])


def test_many_languages(spark):
    """Every labelled language is learned, however many."""
    given = [(i, " ".join(f"{chr(97 + i // 26)}{chr(97 + i % 26)}{c}" for c in "abcdefgh"), f"l{i:03d}") for i in range(300)]
    model = langid.train(spark.createDataFrame(given, "doc_id long, text string, lang string"))
    assert len(model.languages) == 300
    found, _ = langid.predict([t for _, t, _ in given], model)
    assert sum(a == b for a, (_, _, b) in zip(found, given)) >= 290


def test_languages(spark, docs, hard, none):
    model = langid.train(docs.where(~langid.held_out(F.col("doc_id"))))
    got = rows(langid.identify(docs, model).withColumn("held_out", langid.held_out(F.col("doc_id"))))
    test = [r for r in got if r["lang"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    assert all(r["held_out"] for r in test) and len(test) > 20
    assert sum(r["lang"] == r["lang_pred"] for r in test) >= 0.95 * len(test)
    odd = rows(langid.identify(hard, model, with_spans=True))
    assert [(r["doc_id"], r["shard"]) for r in odd] == [(r[0], "x") for r in HARD]
    assert [r["lang_pred"] == "und" for r in odd] == [not words_of_letters(r[1]) for r in HARD]
    assert all(0 <= r["score"] <= 1 for r in got + odd)
    assert rows(langid.identify(none, model)) == []
    blind = langid.train(none)
    assert {r["lang_pred"] for r in rows(langid.identify(hard, blind))} == {"und"}


def test_language_spans(spark, docs):
    model = langid.train(docs)
    own = {k: next(r["text"] for r in rows(docs) if r["lang"] == k and r["n_chars"] > 800)[:400] for k in ("en", "de")}
    mixed = own["en"] + "\n" + own["de"]
    spans = langid.spans_of(mixed, model)
    share = defaultdict(int)
    for start, stop, k in spans:
        share[k, start >= len(own["en"])] += stop - start
    assert share["en", False] > 300 and share["de", True] > 300
    letters = np.zeros((len(langid._NAMES), 2))
    letters[langid._NAMES.index("latin"), 0] = letters[langid._NAMES.index("greek"), 1] = 9
    scripts = langid.Model.fit(["a", "b"], np.ones((64, 2)), letters)
    assert langid.predict(["abc", "αβγ", "кир"], scripts)[0] == ["a", "b", "a"]
    assert langid.spans_of("abc αβγ", scripts) == [(0, 3, "a"), (4, 7, "b")]
