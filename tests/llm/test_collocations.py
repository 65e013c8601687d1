import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from larkspur.llm import collocations, words

from .helpers import DOCS, awkward, empty

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, top):
    counts = {}
    for text, lang in rows:
        f = counts.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall("[^\x20\x09]+", piece)
            f.update(tuple(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in cand.items():
            if any(len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))) and 100 * b >= 50 * a for q, b in cand.items()):
                continue
            score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, n, -s) for i, (s, a, p, left, right) in enumerate(sorted(kept)[:top])]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize(("split", "buckets"), [(collocations.SPLIT, 3), (4, 5)])
def test_equals_brute_force(spark, split, buckets):
    """Repeated words, pivots twice in a phrase, hot words dealt over buckets, ties, pieces and spaces of all kinds."""
    draw = random.Random(7)
    vocabulary = ["the", "The", "of", "x", "é", "ß漢", "a\x00b", "q" * 40, "u", "v"]
    rows = []
    for i in range(120):
        parts = [draw.choice(vocabulary[: 3 + i % 8]) + draw.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "!"]) for _ in range(draw.randrange(60))]
        rows.append((i % 50, "".join(parts), draw.choice(["en", "fr", None, "und", ""]), "s", 0))
    rows += [(1, None, "en", None, None), (None, "", "de", None, None)] * 2
    out = collocations.collocations(spark.createDataFrame(rows, DOCS), least=4, top=60, buckets=buckets, split=split)
    assert got(out) == brute([(r[1], r[2]) for r in rows], 4, 60)


def test_scores_beyond_64_bits(spark):
    """The expression of the score with counts whose products need more than 64 bits."""
    a, left, right = 9 * 10**13, 10**14 - 1, 95 * 10**12
    row = spark.createDataFrame([(a, left, right)], "a long, l long, r long")
    got_ = row.select(F.expr("cast(1000000 as decimal(7,0)) * cast(a as decimal(15,0)) * cast(a as decimal(15,0)) div (cast(l as decimal(15,0)) * cast(r as decimal(15,0)))").alias("s")).first()["s"]
    assert got_ == 10**6 * a * a // (left * right)


def test_hashes_are_sparks(spark):
    langs, some = ["en", "é", ""], ["a", "", "ßx" * 30, "w" * 33]
    pairs = [(i, w) for i in range(3) for w in some]
    ours = words.seeded_hashes(langs, [w for _, w in pairs], np.array([i for i, _ in pairs]))
    theirs = spark.createDataFrame([(i, langs[i], w) for i, w in pairs], "i int, l string, w string").select("l", "w", F.xxhash64("l", "w").alias("h")).collect()
    assert {(r["l"], r["w"]): r["h"] for r in theirs} == {(langs[i], w): int(h) for (i, w), h in zip(pairs, ours.view(np.int64), strict=True)}


@pytest.mark.parametrize("span", [3, 7, 1 << 20])
def test_words_of_long_texts(span):
    """Cuts of a long text fall between words only, however short the span."""
    texts = ["Ab  cd.e", "", "xyzxyzxyzxyz", "f", ".", " g.h "]
    data, offsets = np.frombuffer("".join(texts).encode(), np.uint8), np.cumsum([0, *map(len, texts)])
    found, rows, broken = words.split(data, offsets, collocations.WORD, collocations.BREAK, span)
    assert found.to_pylist() == ["ab", "cd", "e", "xyzxyzxyzxyz", "f", "g", "h"] and found.type == pa.string()
    assert rows.tolist() == [0, 0, 0, 2, 3, 5, 5] and broken.tolist() == [0, 0, 1, 1, 1, 2, 3]


@pytest.mark.parametrize("make", [awkward, empty])
def test_awkward_tables(spark, make):
    docs = make(spark)
    rows = [(r["text"], r["lang"]) for r in docs.collect()]
    assert got(collocations.collocations(docs, least=2, top=30)) == brute(rows, 2, 30)
