"""Line deduplication by a deletion-neighbourhood join, in DataFrame functions only.

A line is its words in lower case. Lines are equal, or near if one word is replaced, inserted or deleted (the edit bound); only lines of
at least `least_words` words are compared for nearness, since shorter ones have little but the changed word in common. A line is
dropped if an equal or near line comes earlier, by (id, line number), anywhere in the corpus; blank lines stay.

Variants. A line emits a key for each word left out, hashed with the number of words and the place left out: lines with a common
key of this kind differ in that word alone. It also emits the keys without the place, and one for itself whole: a
line whose variant equals another whole line has one word more. The hash of a variant is the XOR of 64-bit hashes of (word, place), so running
XORs make all variants of a line in time linear in its length. Groups link to their earliest member or to the whole line, never
all to all, by one place for a pair, and each link's edit distance is verified on the words.

Most lines have no near line. Two near lines share their first or last p words, where p is the largest power of two up to half
their length, so only lines that share such an end with another distinct line emit variants, and only for the words outside a
shared end; this leaves no pair out. Up to four million shared ends are marked in a bit table that is broadcast, its size following their number: it may
let lines through that share nothing, but none that do are lost. More of them are joined instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, written


#: As many keys are marked in a bit table, of 63 bits a row and a row for every four keys; more are joined.
_MOST_MARKED = 1 << 22
_BLANKS = " \t\r\x0b\x0c"


def normal(line: Column) -> Column:
    """The words of a line in lower case, one blank between them."""
    odd = line.contains("  ") | line.startswith(" ") | line.endswith(" ")
    for c in "\t\r\x0b\x0c":
        odd = odd | line.contains(c)
    return F.lower(F.when(odd, F.regexp_replace(F.regexp_replace(line, SPACE, " "), "^ | $", "")).otherwise(line))


def _lines(docs: DataFrame, least_words: int) -> DataFrame:
    """A row per non-blank line: id, no, line, two hashes of it, its number of words n, p, and ends: keys of its first and last p
    words, and of twice as many if a line with a word more would take those."""
    # The outer form of explode: the plain one makes Spark test the array beforehand, which computes it twice.
    lines = docs.select("id", F.posexplode_outer(F.split("text", "\n")).alias("no", "raw")).where(F.btrim("raw", F.lit(_BLANKS)) != "").select("id", "no", normal(F.col("raw")).alias("line"))
    count = F.octet_length("line") - F.octet_length(F.replace(F.col("line"), F.lit(" "), F.lit(""))) + 1
    lines = lines.select("id", "no", "line", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("second"), "line").alias("h2"), count.cast("int").alias("n"))
    lines = lines.withColumn("p", F.expr("cast(shiftleft(1, cast(floor(log2(greatest(n, 2) / 2)) as int)) as int)"))

    def keys(p: Column) -> list[Column]:
        front = F.call_function("substring_index", F.col("line"), F.lit(" "), p)
        rear = F.call_function("substring_index", F.col("line"), F.lit(" "), -p)
        return [F.xxhash64(F.lit("front"), p, front), F.xxhash64(F.lit("rear"), p, rear)]

    p = F.col("p")
    crossing = F.col("n").bitwiseAND(F.col("n") + 1) == 0
    ends = F.when(F.col("n") < least_words, F.array().cast("array<bigint>")).when(crossing, F.array(*keys(p), *keys(p * 2))).otherwise(F.array(*keys(p)))
    return lines.withColumn("ends", ends)


def _among(rows: DataFrame, keys: DataFrame, most: int = _MOST_MARKED) -> DataFrame:
    """The rows whose key is in keys(key), and maybe some others."""
    keys = written(keys.select("key"), "keys")
    n = keys.count()
    if n > most:
        return rows.join(keys.distinct(), "key", "left_semi")
    size = F.lit(1 << max(4, (n // 4).bit_length()))
    bit = F.pmod(F.shiftright("key", 32), F.lit(63)).cast("int")
    marks = keys.groupBy(F.pmod("key", size).alias("mark")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("bits"))
    hit = F.call_function("shiftright", F.col("bits"), bit).bitwiseAND(F.lit(1).cast("long")) == 1
    return rows.withColumn("mark", F.pmod("key", size)).join(F.broadcast(marks), "mark").where(hit).drop("mark", "bits")


def near_places(docs: DataFrame, first: DataFrame, least_words: int) -> DataFrame:
    """first(id, no, ends), distinct lines: places (id, no) of those that have an earlier near line."""
    shared = first.select(F.explode("ends").alias("key")).groupBy("key").agg(F.count("*").alias("held")).where("held > 1")
    ends = _lines(docs, least_words).select("id", "no", "line", "h1", "h2", "n", "p", F.posexplode_outer("ends").alias("end", "key"))
    own = _among(ends, shared).groupBy("h1", "h2").agg(
        F.min(F.struct("id", "no")).alias("place"), F.first("line").alias("line"), F.first("n").alias("n"), F.first("p").alias("p"), F.max(F.col("end") == 0).alias("front"), F.max(F.col("end") == 1).alias("rear")
    )
    own = written(own.select("place.id", "place.no", "n", "p", "front", "rear", F.split("line", " ").alias("words")), "candidates")

    placed = own.repartition("id", "no").select("id", "no", "n", "p", "front", "rear", F.posexplode("words").alias("at", "word"))
    placed = placed.select("id", "no", "n", "at", ((F.col("front") & (F.col("at") >= F.col("p"))) | (F.col("rear") & (F.col("at") < F.col("n") - F.col("p")))).alias("open"), F.xxhash64("word", "at").alias("here"), F.xxhash64(F.col("word"), F.col("at") - 1).alias("left"))
    # What lies behind a place is all of the line less what lies up to it, so no frame shrinks.
    line = Window.partitionBy("id", "no")
    along = line.orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    upto = lambda c: F.bit_xor(c).over(along)
    rest = upto("here").bitwiseXOR(F.col("here")).bitwiseXOR(F.bit_xor("left").over(line)).bitwiseXOR(upto("left"))
    zero = F.lit(0).cast("long")
    sums = placed.select("id", "no", "n", "at", "open", rest.alias("rest")).where("open")
    sums = written(sums.select("id", "no", "at", F.xxhash64(F.lit("swap"), "n", "at", "rest").alias("swap"), F.xxhash64(F.lit("in"), F.col("n") - 1, F.col("rest")).alias("in")), "variants")
    whole_rest = F.aggregate(F.transform("words", lambda w, i: F.xxhash64(w, i)), zero, lambda s, x: s.bitwiseXOR(x))
    whole = own.select(F.col("id").alias("wid"), F.col("no").alias("wno"), F.xxhash64(F.lit("in"), "n", whole_rest).alias("key"))

    swapped = sums.select("id", "no", "at", F.col("swap").alias("key"))
    # Most keys come once. Which do not is counted on bare keys; places are shuffled for those alone.
    again = _among(swapped, swapped.groupBy("key").agg(F.count("*").alias("m")).where("m > 1"))
    centre = again.groupBy("key").agg(F.min(F.struct("id", "no")).alias("with"), F.count("*").alias("m")).where("m > 1").select("key", F.col("with.id").alias("wid"), F.col("with.no").alias("wno"))
    swaps = again.join(centre, "key").where("id <> wid or no <> wno").withColumn("swap", F.lit(True))
    inserted = _among(sums.select("id", "no", "at", F.col("in").alias("key")), whole).join(whole, "key").withColumn("swap", F.lit(False))
    # A pair may meet at many places, as in a line of one word repeated; any of them tells.
    links = swaps.unionByName(inserted).groupBy("id", "no", "wid", "wno", "swap").agg(F.min("at").alias("at"))
    a, b = own.select("id", "no", F.col("words").alias("a")), own.select(F.col("id").alias("wid"), F.col("no").alias("wno"), F.col("words").alias("b"))
    both = links.join(a, ["id", "no"]).join(b, ["wid", "wno"])
    cut = lambda w: F.concat(F.slice(w, F.lit(1), F.col("at")), F.slice(w, F.col("at") + 2, F.size(w)))
    within = F.when(F.col("swap"), cut("a") == cut("b")).otherwise(cut("a") == F.col("b"))
    later = F.greatest(F.struct("id", "no"), F.struct(F.col("wid").alias("id"), F.col("wno").alias("no")))
    return both.where(within).select(later.alias("place")).distinct().select("place.id", "place.no")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = 8) -> DataFrame:
    """A row per row of docs: id, n_lines, n_equal and n_near (lines dropped as either), and the text of the lines that stay.

    Null texts stay null and have no lines. Null ids count as the smallest id. Rows that repeat an id are one place each line: if
    their texts are equal so are their results, and lines at which they differ are compared as if each were there; give
    rows ids of their own. An empty table gives an empty result; other columns are ignored.
    """
    least = F.lit(-(1 << 63)).cast("long")
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), least).alias("id"), F.col(text_col).alias("text"))
    texts = rows.where(F.col("text").isNotNull())
    first = _lines(texts, least_words).groupBy("h1", "h2").agg(F.min(F.struct("id", "no")).alias("place"), F.first("ends").alias("ends"))
    first = written(first.select("place.id", "place.no", "ends"), "lines")
    near = near_places(texts, first, least_words).withColumn("near", F.lit(True))
    stay = first.select("id", "no").join(near, ["id", "no"], "left")
    by_doc = stay.groupBy("id").agg(F.collect_list(F.when(F.col("near").isNull(), F.col("no"))).alias("stay"), F.count("near").alias("n_near"))
    whole = rows.join(by_doc, "id", "left").withColumn("lines", F.split("text", "\n"))
    none = F.array().cast("array<int>")
    blank = F.filter(F.transform("lines", lambda x, i: F.when(F.btrim(x, F.lit(_BLANKS)) != "", -1).otherwise(i)), lambda i: i >= 0)
    places = F.array_intersect(F.sequence(F.lit(0), F.size("lines") - 1), F.concat(F.coalesce("stay", none), blank))
    whole = whole.withColumn("kept", F.transform(places, lambda i: F.get("lines", i)))
    dropped = F.size("lines") - F.size("kept")
    near_n = F.coalesce("n_near", F.lit(0))
    return whole.select(
        F.when(F.col("id") != least, F.col("id")).alias(id_col),
        F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.when(F.col("text").isNull(), F.lit(0)).otherwise(dropped - near_n).cast("long").alias("n_equal"),
        F.when(F.col("text").isNull(), F.lit(0)).otherwise(near_n).cast("long").alias("n_near"),
        F.array_join("kept", "\n").alias(text_col),
    )
