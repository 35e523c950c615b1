"""Quality rules: a threshold table compiled into one projection of built-in functions.

Each rule is (name, measure, least, most): the row is kept if every measure lies within its closed bounds. The measures are ratios
of the counts in `counts`, so a rule is data; `verdict` turns the table into one boolean column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import words

#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in a is that for it as was with be by on not he are this at from or an have has "
    "der die das und zu den von mit sich des auf für ist im dem nicht ein eine als auch es er sie wie bei oder nach "
    "le la les de et en un une du que qui pour dans par sur est au pas plus ne se ce il elle avec "
    "el los las y del por con no su para al lo como más pero sus o este si"
).split()
SYMBOLS = "#*$%&|<>"
#: (name, measure, least, most); None leaves a side open.
RULES = [
    ("length", "n_words", 10, None),
    ("word length", "chars_per_word", 2.0, 12.0),
    ("symbols", "symbols_per_word", None, 0.1),
    ("stop words", "stop_ratio", 0.06, None),
    ("repeated lines", "dup_line_ratio", None, 0.6),
]
OUT = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_stop_words", "n_lines", "base_failed", "kept"]


def counts(docs: DataFrame, text_col: str = "text", window: int = 5) -> DataFrame:
    """docs with its columns in a struct `row` and the counts of its texts beside it."""
    text = F.coalesce(F.col("row")[text_col], F.lit(""))
    spans = F.sequence(F.lit(1), F.size("w") - (window - 1))
    hashed = F.when(F.size("w") >= window, F.transform(spans, lambda i: F.xxhash64(*(F.element_at("w", i + k) for k in range(window))))).otherwise(F.array().cast("array<bigint>"))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = docs.select(F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row")).withColumn("w", words(text)).withColumn("lines", lines).withColumn("h", hashed)
    # Windows found twice, as sorted (hash, place) pairs whose neighbour has the same hash; a window starts a run of `window` words, cut short by the next.
    pairs = F.array_sort(F.transform("h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    out = out.withColumn("p", F.when(F.size(F.array_distinct("h")) < F.size("h"), pairs).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")))
    same = lambda a, b: F.coalesce(F.get("p", a)["h"] == F.get("p", b)["h"], F.lit(False))
    out = out.withColumn("at", F.array_sort(F.transform(F.filter(F.transform("p", lambda p, j: F.struct(p["i"].alias("i"), (same(j, j - 1) | same(j, j + 1)).alias("twice"))), lambda p: p["twice"]), lambda p: p["i"])))
    covered = F.aggregate(F.transform("at", lambda a, j: F.least(F.lit(window), F.coalesce(F.get("at", j + 1) - a, F.lit(window)))), F.lit(0).cast("long"), lambda s, x: s + x)
    return out.select(
        "row",
        F.size("w").cast("long").alias("n_words"),
        F.aggregate("w", F.lit(0).cast("long"), lambda s, x: s + F.length(x)).alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
        F.size(F.filter("w", lambda x: F.lower(x).isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
        F.size("lines").cast("long").alias("n_lines"),
    )


#: Ratios by name: the count above, what is added to it, and the count below (None: 1). The one more stop word keeps very short texts
#: from failing for want of a single word.
MEASURES = {
    "n_words": ("n_words", 0, None),
    "chars_per_word": ("word_chars", 0, "n_words"),
    "symbols_per_word": ("n_symbols", 0, "n_words"),
    "stop_ratio": ("n_stop_words", 1, "n_words"),
    "dup_line_ratio": ("n_dup_lines", 0, "n_lines"),
}


def verdict(rules: list[tuple]) -> Column:
    """The threshold table as one boolean column; a ratio of nothing is 0."""
    passes = F.lit(True)
    for _, measure, least, most in rules:
        above, more, below = MEASURES[measure]
        count = (F.col(above) + more).cast("double")
        value = count if below is None else F.coalesce(F.try_divide(count, F.col(below)), F.lit(0.0))
        passes = passes & (value >= least if least is not None else F.lit(True)) & (value <= most if most is not None else F.lit(True))
    return passes


def quality_rules(docs: DataFrame, text_col: str = "text", rules: list[tuple] | None = None) -> DataFrame:
    """docs with the counts, base_failed and kept; an input column named like one of them is replaced.

    Words are runs of characters other than ASCII white space. n_repeat_words counts the words in five-word windows that the text
    holds twice or more, the first included. base_failed: under ten words, or more than a fifth of them repeated. kept: not
    base_failed, and within every threshold. Null, empty and blank texts have no words and fail. Rows stay as many as they are.
    """
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    out = counts(docs, text_col).withColumn("base_failed", failed).withColumn("kept", ~failed & verdict(RULES if rules is None else rules))
    return out.select(*(F.col("row")[c].alias(c) for c in docs.columns if c.lower() not in OUT), *OUT)
