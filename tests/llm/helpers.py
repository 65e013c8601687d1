"""Brute-force versions and small tables for the tests of this folder."""

import random
import re
from collections import Counter

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def shingles(text, width=5):
    w = WORD.findall((text or "").encode().lower())
    if not w:
        return Counter()
    return Counter(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1)))


def jaccard(a, b):
    shared = sum((a & b).values())
    return shared / max(1, sum(a.values()) + sum(b.values()) - shared)


def words(seed, n, vocabulary=400):
    draw = random.Random(seed)
    return [f"w{draw.randrange(vocabulary)}x" for _ in range(n)]


def changed(tokens, seed, n):
    draw = random.Random(seed)
    out = list(tokens)
    for i in draw.sample(range(len(out)), n):
        out[i] = f"q{draw.randrange(10**6)}"
    return out


def awkward(spark):
    """Nulls in every column, empty and very long texts, repeated rows, a clashing extra column."""
    long = " ".join(words(1, 60_000))
    rows = [(1, "", "en", "a", 0, "x"), (2, None, None, None, None, None), (None, "some words here and there again", "en", "a", 5, None), (None, None, None, None, None, None), (3, long, "en", "b", len(long), "y"), (4, "one two three", "de", "b", 13, "z"), (4, "one two three", "de", "b", 13, "z"), (5, "\u0000\n\t  ", "fr", None, 5, "w"), (6, "Ünïcode ß 漢字 text with several words in it", "fr", "c", 40, "v")]
    return spark.createDataFrame(rows, DOCS + ", `__key` string").withColumnRenamed("__key", "shard")


def empty(spark):
    return spark.createDataFrame([], DOCS)
