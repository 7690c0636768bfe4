"""Quality rules by distribution divergence, with DataFrame functions only.

For every document two histograms are compared with a reference of its language by the Jensen-Shannon distance (base 2, so
between 0 and 1): characters by class, and words that are common in the language. The references are the same histograms
over all documents of the language (null is a language of its own). Common are words, of any length,
that make up ``COMMON`` or more of a language's words, so there are at most 1 / ``COMMON`` of them.

A document fails if a distance exceeds its limit, which allows for chance in short texts by a term that falls with the root
of the length. Below the guards (``LEAST_BYTES``, ``LEAST_WORDS``) a histogram says too little and is not used. The plain
rules (under ten words, a fifth of the words repeated) come first.

Edge cases: null and empty texts have no words and fail the plain rules. A language with nothing counted has no reference
and no distance. Texts are read whole. Repeated rows are answered row by row. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescast.session import materialize

SPACE = r"\x20\x09-\x0D"
SPACES = " \t\n\x0b\f\r"
#: Characters that are left of a text when all others are deleted. Further classes are spaces, the bytes that wide characters
#: take beyond one, and the rest: letters a-z and all others.
CLASSES = {"upper": "A-Z", "digit": "0-9", "stop": ".,;:?!'\"()-", "symbol": "#*$%&|<>"}

COMMON = 0.005
LEAST_BYTES, LEAST_WORDS = 200, 50
#: Limits of the two distances, and what is added over the root of the number of characters or words.
CHAR_LIMIT, CHAR_NOISE = 0.22, 1.5
WORD_LIMIT, WORD_NOISE = 0.35, 1.2


def _windows(hashes: Column, size: int = 5) -> Column:
    """A hash of every ``size`` consecutive words."""
    starts = F.when(F.size(hashes) >= size, F.sequence(F.lit(0), F.size(hashes) - size)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(*(F.get(hashes, i + k) for k in range(size))))


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id"), F.col("lang").cast("string").alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def _words(text: Column) -> Column:
    for space in SPACES[1:]:
        text = F.replace(text, F.lit(space), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def common_words(documents: DataFrame) -> DataFrame:
    """(lang, common, word_shares) of languages with words: the common ones in order, and their shares."""
    words = _texts(documents).select("lang", F.explode(_words(F.lower("text"))).alias("word"))
    counts = materialize(words.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")), "quality-counts")
    totals = materialize(counts.groupBy(F.col("lang").alias("of")).agg(F.sum("n").alias("all_words")), "quality-totals")
    common = counts.join(totals, F.col("lang").eqNullSafe(F.col("of"))).where(F.col("n") >= COMMON * F.col("all_words"))
    common = common.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("word", (F.col("n") / F.col("all_words")).alias("share")))).alias("c"))
    return common.select("lang", F.col("c.word").alias("common"), F.col("c.share").alias("word_shares"))


def features(documents: DataFrame, common: DataFrame) -> DataFrame:
    """Counts of each document (doc_id, text, lang): the plain ones, characters by class, and how often it has each common word."""
    none = F.col("text")
    for space in SPACES:
        none = F.replace(none, F.lit(space), F.lit(""))
    rows = _texts(documents).select(
        "doc_id", "lang", "text", _words(F.col("text")).alias("words"), F.length(none).cast("long").alias("word_chars"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike(f"[^{SPACE}]")).alias("lines"),
        F.length("text").cast("long").alias("n_chars"), F.octet_length("text").cast("long").alias("n_bytes"),
        *(F.length(F.regexp_replace("text", f"[^{kept}]+", "")).cast("long").alias(f"c_{name}") for name, kept in CLASSES.items()))
    rows = rows.join(common.withColumnRenamed("lang", "of"), F.col("lang").eqNullSafe(F.col("of")), "left")
    rows = rows.select(
        "doc_id", "lang", "n_chars", "n_bytes", "word_chars", *(f"c_{name}" for name in CLASSES), F.size("words").cast("long").alias("n_words"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), "common", "word_shares",
        F.filter(F.transform("words", lambda w: F.array_position("common", F.lower(w))), lambda k: k > 0).alias("hits"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    rows = rows.withColumn("windows", _windows(F.col("hashes"))).drop("hashes")
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    pairs = F.sort_array(F.transform("windows", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    rows = rows.withColumn("pairs", F.when(repeats, pairs)).drop("windows")
    # Windows found twice or more, as places in order; each covers its words as far as the next one.
    again = F.filter("pairs", lambda p, k: F.coalesce(p["x"] == F.get("pairs", k - 1)["x"], F.lit(False))
                     | F.coalesce(p["x"] == F.get("pairs", k + 1)["x"], F.lit(False)))
    rows = rows.withColumn("places", F.sort_array(F.transform(again, lambda p: p["i"]))).drop("pairs")
    covered = F.aggregate(
        F.transform("places", lambda p, k: F.least(F.lit(5), F.coalesce(F.get("places", k + 1) - p, F.lit(5))).cast("long")),
        F.lit(0).cast("long"), lambda a, n: a + n)
    classes = [*(F.col(f"c_{name}") for name in CLASSES), F.col("n_chars") - F.col("word_chars"), F.col("n_bytes") - F.col("n_chars")]
    counts = F.transform(F.sequence(F.lit(1), F.size("common")), lambda k: F.size(F.filter("hits", lambda h: h == k)))
    return rows.select(
        "doc_id", "lang", "n_words", "word_chars", F.col("c_symbol").alias("n_symbols"),
        "n_dup_lines", F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"), "n_bytes",
        F.array(*classes, F.col("n_bytes") - sum(classes, F.lit(0))).alias("chars"), "word_shares",
        # The second use of hits keeps the optimizer from moving their making into the lambda of counts.
        F.when((F.size("common") > 0) & (F.size("hits") >= 0), counts).alias("common_counts"))


def character_shares(found: DataFrame) -> DataFrame:
    """(lang, char_shares): the shares of the character classes in a language's texts."""
    n = len(CLASSES) + 3
    chars = found.groupBy("lang").agg(F.sum("n_bytes").alias("all_bytes"), F.array(*(F.sum(F.get("chars", F.lit(k))) for k in range(n))).alias("sums"))
    return chars.select("lang", F.transform("sums", lambda s: s / F.greatest("all_bytes", F.lit(1))).alias("char_shares"))


def jensen_shannon(left: Column, right: Column) -> Column:
    """The distance of two arrays of shares, base 2."""
    def half(p: Column, q: Column) -> Column:
        return F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(F.lit(0.0))

    parts = F.zip_with(left, right, lambda p, q: half(p, q) + half(q, p))
    distance = F.sqrt(F.greatest(F.lit(0.0), F.aggregate(parts, F.lit(0.0), lambda a, x: a + x) / 2))
    return F.when(left.isNotNull() & right.isNotNull(), distance)


def quality(documents: DataFrame) -> DataFrame:
    """Plain counts, both distances, and the verdict ``kept`` for each row of ``documents`` (doc_id, text, lang).

    One scan counts the words of each language, another makes all counts of a document, of which only numbers are written.
    """
    # Written, so that Spark knows how small references are and does not shuffle the documents by language.
    found = materialize(features(documents, materialize(common_words(documents), "quality-words")), "quality-features")
    known = materialize(character_shares(found), "quality-characters").withColumnRenamed("lang", "of")
    rows = found.join(known, F.col("lang").eqNullSafe(F.col("of")), "left")
    shares = F.transform("common_counts", lambda c: c / F.col("n_words"))
    rest = lambda s: F.array_append(s, 1 - F.aggregate(s, F.lit(0.0), lambda a, x: a + x))
    rows = rows.select(
        "*", F.when(F.col("n_bytes") >= LEAST_BYTES, jensen_shannon(
            F.transform("chars", lambda c: c / F.col("n_bytes")), F.col("char_shares"))).alias("char_distance"),
        F.when(F.col("n_words") >= LEAST_WORDS, shares).alias("shares"))
    rows = rows.withColumn("word_distance", jensen_shannon(rest(F.col("shares")), rest(F.col("word_shares"))))
    base_failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    far = (F.coalesce(F.col("char_distance") > CHAR_LIMIT + CHAR_NOISE / F.sqrt("n_bytes"), F.lit(False))
           | F.coalesce(F.col("word_distance") > WORD_LIMIT + WORD_NOISE / F.sqrt("n_words"), F.lit(False)))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       base_failed.alias("base_failed"), (~base_failed & ~far).alias("kept"), "char_distance", "word_distance")
