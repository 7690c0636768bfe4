"""Plain versions of the word patterns, and small tables with awkward rows."""

import re

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
LETTERS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def spaced(text):
    return SPACED.findall((text or "").translate(UPPER))


def letters(text):
    return LETTERS.findall((text or "").translate(UPPER))


DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint, spans string, toxicity string"


def documents(spark, rows):
    """A documents table of (doc_id, text) pairs, with columns whose names operators use themselves."""
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), "x", "y") for i, t in rows], DOCUMENTS)


def rows(df):
    return [r.asDict() for r in df.collect()]
