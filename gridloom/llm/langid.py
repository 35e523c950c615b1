"""Language identification of mixed texts.

Model. Character n-grams (1 to 3, of words with their edges marked) are hashed into `buckets` counters per language, so the model
has a fixed size whatever the corpus. Counting runs on Spark over a seeded sample of at most about `train_rows` labelled rows;
the driver receives only the counters. A language's scripts are those that hold a twentieth of its letters.

Prediction. A word's script narrows the languages (none with that script: all stay), its score is the mean log-odds of its n-grams,
and Viterbi with a penalty for each switch labels the words, which gives spans of one language. The document's language has
the most letters in its spans; the score is its share of letters times the mean posterior of those words.

Evidence. The score only compares languages. What can tell a text of none of them is absolute: the share of letters in words whose
script no language uses, and how far the log likelihood of the n-grams lies under that of the languages' own training texts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import by_size

#: Runs of word characters but digits and underscores: letters, and a few that are numeric only (superscripts, fractions, circled or Roman numbers).
_WORDS = re.compile(r"[^\W\d_]+")
_NO_WORD = re.compile(r"[\W\d_]+")
#: First and last code point of script ranges, by name; letters outside them are script "other".
SCRIPTS = [
    ("latin", 0x41, 0x24F), ("latin", 0x1E00, 0x1EFF), ("greek", 0x370, 0x3FF), ("greek", 0x1F00, 0x1FFF), ("cyrillic", 0x400, 0x52F),
    ("armenian", 0x530, 0x58F), ("hebrew", 0x590, 0x5FF), ("arabic", 0x600, 0x77F), ("devanagari", 0x900, 0x97F), ("bengali", 0x980, 0x9FF),
    ("tamil", 0xB80, 0xBFF), ("thai", 0xE00, 0xE7F), ("georgian", 0x10A0, 0x10FF), ("ethiopic", 0x1200, 0x137F), ("kana", 0x3040, 0x30FF),
    ("hangul", 0x1100, 0x11FF), ("hangul", 0xAC00, 0xD7AF), ("han", 0x3400, 0x4DBF), ("han", 0x4E00, 0x9FFF),
]


_NAMES = ["other", *dict.fromkeys(name for name, _, _ in SCRIPTS)]
_FIRST = np.array([low for _, low, _ in sorted(SCRIPTS, key=lambda s: s[1])])
_LAST = np.array([high for _, _, high in sorted(SCRIPTS, key=lambda s: s[1])])
_WHICH = np.array([_NAMES.index(name) for name, _, _ in sorted(SCRIPTS, key=lambda s: s[1])])


def scripts_of(codes: np.ndarray) -> np.ndarray:
    """Script numbers (places in _NAMES) of code points."""
    at = np.maximum(np.searchsorted(_FIRST, codes, side="right") - 1, 0)
    return np.where((codes >= _FIRST[at]) & (codes <= _LAST[at]), _WHICH[at], 0)


def grams(words: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed 1- to 3-grams of lower-case words with marked edges: word numbers in order, buckets, and the words' script numbers."""
    codes = np.frombuffer(("^" + "$^".join(words) + "$").encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    first = codes == ord("^")
    word = np.cumsum(first) - 1
    owners, found, hashed = [], [], codes
    for n in (1, 2, 3):
        if n > 1:
            hashed = hashed[:-1] * np.uint64(1_000_003) + codes[n - 1 :]
        whole = word[: len(hashed)] == word[n - 1 :] if n > 1 else ~first & (codes != ord("$"))
        owners.append(word[: len(hashed)][whole])
        found.append(((hashed[whole] * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64))
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return owner[order], np.concatenate(found)[order], scripts_of(codes[np.flatnonzero(first) + 1])


def letter_runs(text: str) -> list[str]:
    """The runs of letters (Unicode category L) of a text."""
    found = _WORDS.findall(text)
    return found if all(map(str.isalpha, found)) else [w for f in found for w in ([f] if f.isalpha() else _only_letters(f).split())]


def _only_letters(run: str) -> str:
    return "".join(c if c.isalpha() else " " for c in run)


class Model:
    """Languages, log-odds of the hashed n-grams (buckets x languages) and which scripts each language uses."""

    def __init__(self, languages: list[str], odds: np.ndarray, allowed: np.ndarray, keep: int = 400_000, level: np.ndarray | None = None, spread: np.ndarray | None = None):
        self.level, self.spread = level, spread  # log likelihoods less each language's mean (buckets x languages), and their deviations
        self.languages, self.odds, self.allowed, self.keep = languages, odds, allowed, keep
        self.known: dict[str, int] = {}
        self.depth, self.native = np.zeros((1024, max(1, len(languages))), np.float32), np.zeros(1024, bool)
        self.table, self.sizes, self.used = np.zeros((1024, max(1, len(languages))), np.float32), np.zeros(1024, np.int32), 0

    @classmethod
    def fit(cls, languages: list[str], counts: np.ndarray, letters: np.ndarray) -> Model:
        """counts: buckets x languages; letters: scripts x languages."""
        share = (counts + 0.5) / (counts.sum(axis=0) + 0.5 * len(counts))
        odds = np.log(share) - np.log(share.mean(axis=1, keepdims=True))
        level, own = np.log(share), counts / np.maximum(1, counts.sum(axis=0))
        level -= (own * level).sum(axis=0)
        spread = np.sqrt((own * level**2).sum(axis=0))
        return cls(languages, odds.astype(np.float32), letters >= 0.05 * np.maximum(1, letters.sum(axis=0)), level=level.astype(np.float32), spread=spread)

    def scores(self, words: list[str]) -> np.ndarray:
        """Score rows of words, not kept."""
        owner, bucket, script = grams([w.lower() for w in words], len(self.odds))
        start = np.searchsorted(owner, np.arange(len(words)))
        mean = np.add.reduceat(self.odds[bucket], start, axis=0) / np.diff(start, append=len(owner))[:, None]
        can = self.allowed[script]
        can |= ~can.any(axis=1, keepdims=True)
        return np.where(can, 3 * mean, np.float32(-50))

    def depths(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Sums of the n-grams' log likelihoods, and whether a language uses the word's script."""
        owner, bucket, script = grams([w.lower() for w in words], len(self.odds))
        return np.add.reduceat(self.level[bucket], np.searchsorted(owner, np.arange(len(words))), axis=0), self.allowed[script].any(axis=1)

    def rows(self, found: list[str]) -> np.ndarray:
        """Places of the words in the table of scores, which are made once while they are kept."""
        known = self.known
        new = list(set(found).difference(known))
        if new and len(known) + len(new) > self.keep:
            known.clear()
            new, self.used = list(set(found)), 0
        for at in range(0, len(new), 1 << 15):
            part = new[at : at + (1 << 15)]
            while self.used + len(part) > len(self.table):
                self.table, self.sizes = np.concatenate([self.table, np.zeros_like(self.table)]), np.concatenate([self.sizes, np.zeros_like(self.sizes)])
            self.table[self.used : self.used + len(part)] = self.scores(part)
            if self.level is not None:
                while self.used + len(part) > len(self.native):
                    self.depth, self.native = np.concatenate([self.depth, np.zeros_like(self.depth)]), np.concatenate([self.native, np.zeros_like(self.native)])
                self.depth[self.used : self.used + len(part)], self.native[self.used : self.used + len(part)] = self.depths(part)
            self.sizes[self.used : self.used + len(part)] = np.fromiter(map(len, part), np.int32, len(part))
            known.update(zip(part, range(self.used, self.used + len(part))))
            self.used += len(part)
        return np.fromiter(map(known.__getitem__, found), np.int32, len(found))


def viterbi(scores: np.ndarray, starts: np.ndarray, lengths: np.ndarray, penalty: float) -> np.ndarray:
    """Best labels of many word sequences at once. scores: words x languages; sequences lie one after the other."""
    kind = np.uint8 if scores.shape[1] <= 256 else np.uint16
    labels = np.zeros(len(scores), kind)
    if not len(scores):
        return labels
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    steps = int(lengths[0])
    active = np.searchsorted(-lengths, -np.arange(steps + 1), side="left").tolist()  # sequences longer than each step, first in order
    back, every = np.zeros(scores.shape, kind), np.arange(scores.shape[1], dtype=kind)
    now = scores[starts].astype(np.float64)
    for t in range(steps):
        n, at = active[t], starts[: active[t]] + t
        if t:
            now = now[:n]
            best = now.argmax(axis=1)
            jump = now[np.arange(n), best] - penalty
            stay = now >= jump[:, None]
            back[at] = np.where(stay, every, best[:, None])
            now = np.where(stay, now, jump[:, None]) + scores[at]
        if active[t + 1] < n:
            labels[at[active[t + 1] :]] = now[active[t + 1] :].argmax(axis=1)
    for t in range(steps - 1, 0, -1):
        at = starts[: active[t]] + t
        labels[at - 1] = back[at, labels[at]]
    return labels


def steady(scores: np.ndarray, penalty: float) -> int:
    """The language that Viterbi gives every word of a sequence, or -1 if that isn't plain from sums.

    A stay elsewhere costs two switches inside the sequence and one at its ends. If no stretch of words gains that much by leaving
    the language with the greatest sum, even with free choice of languages for each word, nothing leaves it.
    """
    k = int(scores.sum(axis=0, dtype=np.float64).argmax())
    if scores.shape[1] == 1:
        return k
    gain = np.cumsum(np.delete(scores, k, axis=1).max(axis=1) - scores[:, k], dtype=np.float64)
    before = np.concatenate([np.zeros(1), gain[:-1]])
    inside = (gain - np.minimum.accumulate(before)).max() < 2 * penalty
    return k if inside and gain.max() < penalty and (gain[-1] - before).max() < penalty else -1


def label(scores: np.ndarray, starts: np.ndarray, lengths: np.ndarray, penalty: float) -> np.ndarray:
    """viterbi(), with steady sequences settled beforehand."""
    labels, moving = np.zeros(len(scores), np.uint8 if scores.shape[1] <= 256 else np.uint16), []
    for i, (s, n) in enumerate(zip(starts.tolist(), lengths.tolist())):
        k = steady(scores[s : s + n], penalty)
        if k < 0:
            moving.append(i)
        else:
            labels[s : s + n] = k
    if moving:
        own = np.array(moving)
        at = np.concatenate([np.arange(s, s + n) for s, n in zip(starts[own].tolist(), lengths[own].tolist())])
        labels[at] = viterbi(scores[at], np.cumsum(lengths[own]) - lengths[own], lengths[own], penalty)
    return labels


def spans_of(text: str, model: Model, penalty: float = 4.0) -> list[tuple[int, int, str]]:
    """(start, stop, language) of the single-language spans of a text, in code points; none where there is no letter."""
    found = list(re.finditer(r"\S+", _WORDS.sub(lambda m: m[0] if m[0].isalpha() else _only_letters(m[0]), _NO_WORD.sub(lambda m: " " * len(m[0]), text))))
    if not found or not model.languages:
        return []
    rows = model.rows([m[0] for m in found])
    labels = label(model.table[rows], np.array([0]), np.array([len(rows)]), penalty)
    out: list[tuple[int, int, str]] = []
    for m, k in zip(found, labels.tolist()):
        name = model.languages[k]
        if out and out[-1][2] == name:
            out[-1] = (out[-1][0], m.end(), name)
        else:
            out.append((m.start(), m.end(), name))
    return out


def predict(texts: list[str | None], model: Model, penalty: float = 4.0) -> tuple[list[str], list[float]]:
    """Language and score of each text; 'und' and 0 for null and for texts without a letter, and throughout if the model knows no language."""
    found = [letter_runs(t) if t else [] for t in texts]
    lengths = np.array([len(f) for f in found], np.int64)
    if not model.languages or not lengths.sum():
        return ["und"] * len(texts), [0.0] * len(texts)
    rows = model.rows(list(chain.from_iterable(found)))
    scores, size = model.table[rows], model.sizes[rows].astype(np.float64)
    full = np.flatnonzero(lengths)
    starts = (np.cumsum(lengths) - lengths)[full]
    labels = label(scores, starts, lengths[full], penalty)
    odds = np.exp(scores - scores.max(axis=1, keepdims=True))
    sure = odds[np.arange(len(rows)), labels] / odds.sum(axis=1)
    mass = np.stack([np.add.reduceat(np.where(labels == k, size, 0.0), starts) for k in range(len(model.languages))], axis=1)
    trust = np.stack([np.add.reduceat(np.where(labels == k, size * sure, 0.0), starts) for k in range(len(model.languages))], axis=1)
    best = mass.argmax(axis=1)
    score = trust[np.arange(len(full)), best] / mass.sum(axis=1)
    names, values = ["und"] * len(texts), [0.0] * len(texts)
    for i, k, s in zip(full.tolist(), best.tolist(), score.tolist()):
        names[i], values[i] = model.languages[k], min(1.0, max(0.0, s))
    return names, values


def evidence(texts: list[str | None], model: Model, penalty: float = 4.0) -> tuple[list[float], list[float]]:
    """foreign and level of each text. foreign: the share of its letters in words of a script that no language of the model uses.
    level: the mean log likelihood of the n-grams of its other words, in the languages that they are labelled with, less that of those
    languages' training texts, and three standard errors more, as short texts vary. Without such words 0."""
    foreign, level = np.zeros(len(texts)), np.zeros(len(texts))
    found = [letter_runs(t) if t else [] for t in texts]
    lengths = np.array([len(f) for f in found], np.int64)
    if not model.languages or not lengths.sum():
        return foreign.tolist(), level.tolist()
    rows = model.rows(list(chain.from_iterable(found)))
    full = np.flatnonzero(lengths)
    starts = (np.cumsum(lengths) - lengths)[full]
    labels = label(model.table[rows], starts, lengths[full], penalty)
    size, native = model.sizes[rows].astype(np.float64), model.native[rows]
    n = np.where(native, 3 * size + 1, 0.0)  # n-grams of a word with its edges
    total = lambda x: np.add.reduceat(x, starts)
    foreign[full] = total(np.where(native, 0.0, size)) / total(size)
    depth = np.where(native, model.depth[rows, labels], 0.0)
    level[full] = (total(depth) + 3 * np.sqrt(total(n * model.spread[labels] ** 2))) / np.maximum(1.0, total(n))
    return foreign.tolist(), level.tolist()


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", train_rows: int = 20_000, least_rows: int = 200, buckets: int = 1 << 15, seed: int = 5) -> Model:
    """Fit on a seeded sample of about train_rows rows with text and language, and of about least_rows at least (or all) of each language.

    The sample keeps rows whose hashed id falls under their language's share. Every labelled language is learned; counters are summed by
    (language, bucket), so the driver gets buckets of them a language at most (half a megabyte in memory). No labelled rows: a model without languages.
    """
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    held = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages, total = sorted(held), sum(held.values())
    if not total:
        return Model([], np.zeros((1, 1), np.float32), np.ones((len(_NAMES), 1), bool))
    share = {x: min(1.0, max(train_rows / total, least_rows / n)) for x, n in held.items()}
    bounds = F.create_map(*(F.lit(v) for x, p in share.items() for v in (x, int(p * (1 << 30)))))
    sample = rows.where(F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(1 << 30)) < bounds[F.col("lang")])
    place = {x: i for i, x in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, letters = np.zeros((buckets, len(languages)), np.int64), np.zeros((len(_NAMES), len(languages)), np.int64)
        for b in batches:
            words: dict[int, Counter] = {}
            for text, lang in zip(b.column(0), b.column(1).to_pylist()):
                if (k := place.get(lang)) is not None:
                    words.setdefault(k, Counter()).update(letter_runs(text.as_py().lower()))
            for k, own in words.items():
                every, n = list(own), np.fromiter(own.values(), np.int64, len(own))
                for at in range(0, len(every), 100_000):
                    part = slice(at, at + 100_000)
                    owner, bucket, script = grams(every[part], buckets)
                    held[:, k] += np.bincount(bucket, n[part][owner], buckets).astype(np.int64)
                    letters[:, k] += np.bincount(script, n[part] * np.fromiter(map(len, every[part]), np.int64), len(_NAMES)).astype(np.int64)
        for table, which in ((held, 0), (letters, 1)):
            at, k = np.nonzero(table)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), which, np.int32)), pa.array(k.astype(np.int32)), pa.array(at.astype(np.int32)), pa.array(table[at, k])], names=["which", "k", "at", "n"])

    sums = sample.select("text", "lang").mapInArrow(count, "which int, k int, at int, n long").groupBy("which", "k", "at").agg(F.sum("n").alias("n")).toPandas()
    counts, letters = np.zeros((buckets, len(languages))), np.zeros((len(_NAMES), len(languages)))
    for table, which in ((counts, 0), (letters, 1)):
        own = sums[sums["which"] == which]
        table[own["at"], own["k"]] = own["n"]
    return Model.fit(languages, counts, letters)


def identify(docs: DataFrame, model: Model, text_col: str = "text", penalty: float = 4.0, with_spans: bool = False, with_evidence: bool = False) -> DataFrame:
    """docs with lang_pred and score (and spans, or foreign and level, if asked); input columns of those names are replaced.

    lang_pred is 'und', score 0, where the text is null or has no letter, or the model knows no language. All other texts, however short or long, get a
    language of the model. Only the text is looked at.
    """
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast((model.languages, model.odds, model.allowed, model.keep, *((model.level, model.spread) if with_evidence else ())))
    names = ["lang_pred", "score"] + ["spans"] * with_spans + ["foreign", "level"] * with_evidence
    kept = [c for c in docs.columns if c.lower() not in names]
    out_schema = docs.select(*(docs[f"`{c}`"] for c in kept)).schema.add("lang_pred", "string").add("score", "double")
    if with_spans:
        out_schema = out_schema.add("spans", T.ArrayType(T.StructType().add("start", "integer").add("stop", "integer").add("lang", "string")))
    if with_evidence:
        out_schema = out_schema.add("foreign", "double").add("level", "double")
    place = docs.columns.index(text_col)
    at = [docs.columns.index(c) for c in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for whole in batches:
            for b in by_size(whole, place, 2 << 20):
                texts = b.column(place).to_pylist()
                lang, score = predict(texts, own, penalty)
                columns = [b.column(i) for i in at] + [pa.array(lang, pa.string()), pa.array(score, pa.float64())]
                if with_spans:
                    found = [[{"start": s, "stop": e, "lang": x} for s, e, x in spans_of(t, own, penalty)] if t else [] for t in texts]
                    columns.append(pa.array(found, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("lang", pa.string())]))))
                if with_evidence:
                    columns += [pa.array(x, pa.float64()) for x in evidence(texts, own, penalty)]
                yield pa.RecordBatch.from_arrays(columns, names=out_names)

    out_names = out_schema.names
    return docs.mapInArrow(run, out_schema)


def held_out(key: Column) -> Column:
    return F.crc32(key.cast("string").cast("binary")) % 3 == 1
