import math
import tracemalloc
from collections import Counter
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from larkspur.llm import language_model as L

from .helpers import awkward, empty, words


def naive_ctw(texts, depth):
    """The same mixture by recursion over dictionaries."""
    counts = Counter()
    for t in texts:
        b = [65] * depth + [x + 32 if 65 <= x <= 90 else x for x in t.encode()] + [65]
        for i in range(depth, len(b)):
            context = tuple(b[i - d] for d in range(1, depth + 1))
            for k in range(8):
                for d in range(depth + 1):
                    counts[context[:d], (1 << k) | (b[i] >> (8 - k)), (b[i] >> (7 - k)) & 1] += 1
    nodes = {}
    for c, j, _ in counts:
        nodes.setdefault((len(c), j), set()).add(c)

    def n(c, j):
        return counts[c, j, 0], counts[c, j, 1]

    @cache
    def weigh(c, j):
        a, b = n(c, j)
        own = math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)
        kids = [x for x in nodes.get((len(c) + 1, j), ()) if x[: len(c)] == c]
        if not kids:
            return own, 1.0
        below = sum(weigh(x, j)[0] for x in kids)
        total = np.logaddexp(own, below) - math.log(2)
        return total, math.exp(own - math.log(2) - total)

    def predict(c, j):
        said, share, best = 0.0, 1.0, 0.5
        for d in range(depth + 1):
            a, b = n(c[:d], j)
            if a + b == 0:
                break
            p, w = (b + 0.5) / (a + b + 1), weigh(c[:d], j)[1]
            best = said + share * p
            said, share = said + share * w * p, share * (1 - w)
        return best

    def log10(t):
        b, out = [65] * depth + [x + 32 if 65 <= x <= 90 else x for x in t.encode()] + [65], 0.0
        for i in range(depth, len(b)):
            c = tuple(b[i - d] for d in range(1, depth + 1))
            for k in range(8):
                p = predict(c, (1 << k) | (b[i] >> (8 - k)))
                out += math.log10(p if (b[i] >> (7 - k)) & 1 else 1 - p)
        return out

    return log10


def test_scores_equal_the_recursion(spark):
    train = ["abracadabra abra", "Abba barb", "cab"]
    asked = [*train, "abracadazzz", "", "BARBARA"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(asked)], "doc_id long, text string")
    model = L.train(df.where("doc_id < 3"), depth=3)
    naive = naive_ctw(train, 3)
    for r in L.score(df, model, ["doc_id"]).collect():
        assert abs(r["score"] - naive(asked[r["doc_id"]])) < 1e-4 * max(1, abs(r["score"]))


def test_bytes_of_a_context_sum_to_one():
    data = np.frombuffer(b"hello world hello there", np.uint8)
    keys, counts = np.unique(L.grams(data, np.array([0, len(data)]), 3)[0], return_counts=True)
    tree = L.ContextTree(keys, counts, 3)
    for context in (0x6C6C65, 0x010203, 0x6F6C7A):
        total = (10 ** tree.log10((np.uint64(context) << np.uint64(8)) + np.arange(256, dtype=np.uint64))).sum()
        assert abs(total - 1) < 1e-4


def test_base_scores_and_counts(spark):
    texts = [" ".join(words(i, 30, 50)).upper() + " rare%d" % i for i in range(60)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    counts, n = Counter(), 0
    for t in texts[:40]:
        w = t.lower().split()
        counts.update([*w, None])
        n += len(w) + 1
    for head in (1 << 20, 8):  # all tokens broadcast, or nearly all joined
        model = L.train(df.where("doc_id < 40"), head=head)
        for r in L.score(df, model, ["doc_id"]).collect():
            tokens = [*texts[r["doc_id"]].lower().split(), None]
            want = sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (len(counts) + 1))) for t in tokens)
            assert abs(r["base_score"] - want) < 1e-9 * abs(want)
            assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(tokens), sum(counts[t] > 0 for t in tokens), n)


def test_the_end_is_no_byte_of_a_text(spark):
    texts = ["abab", "abab\0", "abab\1", "abab\0\0", "ABAB"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").withColumns({"__row": F.lit(1), "__text": F.lit("x"), "key": F.lit(2)})
    model = L.train(df.where("doc_id = 0"), depth=3, head_grams=0)
    got = {r["doc_id"]: r["score"] for r in L.score(df, model, ["doc_id"]).collect()}
    assert len({round(got[i], 6) for i in (0, 1, 3)}) == 3 and abs(got[4] - got[0]) < 1e-6
    told = {r["doc_id"]: r["score"] for r in L.score(df, model, ["doc_id"], trained=F.col("doc_id") == 0).collect()}
    assert all(abs(told[i] - v) < 1e-6 for i, v in got.items())


def test_awkward_rows(spark):
    docs = awkward(spark)
    rows = L.score(docs, L.train(docs), ["doc_id"]).collect()
    assert len(rows) == docs.count() and all(r["score"] < 0 for r in rows)
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (1, 2)} == {1}
    nothing = L.train(empty(spark))
    assert {(r["n_known"], r["train_tokens"]) for r in L.score(docs, nothing, ["doc_id"]).collect()} == {(0, 0)}
    assert L.score(empty(spark), nothing, ["doc_id"]).count() == 0


def test_the_tree_keeps_every_context(spark, monkeypatch):
    """More contexts than the 250,000 that the tree once had, in many slices, with few of them in the broadcast head."""
    monkeypatch.setattr(L, "SLICE_ENTRIES", 20_000)
    draw = np.random.default_rng(7)
    texts = ["".join(map(chr, draw.integers(97, 123, 3_000))) for _ in range(120)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    model = L.train(df.where("doc_id < 110"), head_grams=500)
    data = np.frombuffer("".join(texts[:110]).encode(), np.uint8)
    keys, counts = np.unique(L.grams(data, np.arange(111) * 3_000, L.DEPTH)[0], return_counts=True)
    assert len(keys) > 250_000 and model.tree.entries.count() == len(keys)
    tree = L.ContextTree(keys, counts, L.DEPTH)
    for r in L.score(df, model, ["doc_id"]).collect():
        want = tree.log10(L.grams(np.frombuffer(texts[r["doc_id"]].encode(), np.uint8), np.array([0, 3_000]), L.DEPTH)[0]).sum()
        assert abs(r["score"] - want) < 1e-4 * abs(want)


def test_a_task_hands_over_each_key_once_in_small_batches():
    draw = np.random.default_rng(3)
    texts = ["".join(map(chr, draw.integers(97, 123, 40_000))) for _ in range(20)]
    told = list(L._count(L.DEPTH)(pa.RecordBatch.from_arrays([pa.array(texts[i : i + 5])], names=["t"]) for i in range(0, 20, 5)))
    assert max(b.num_rows for b in told) <= 1 << 17
    kinds, keys, n = (np.concatenate([b.column(i).to_numpy() for b in told]) for i in range(3))
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    want, counts = np.unique(L.grams(data, np.arange(21) * 40_000, L.DEPTH)[0], return_counts=True)
    order = np.argsort(keys[kinds == 0].view(np.uint64))
    assert np.array_equal(keys[kinds == 0].view(np.uint64)[order], want) and np.array_equal(n[kinds == 0][order], counts)
    assert n[kinds == 1].sum() == 20 and n[kinds == 2].sum() == 20
    # the same where runs are handed over before the end
    parts = list(L._count(L.DEPTH, spill=50_000)(iter([pa.RecordBatch.from_arrays([pa.array(texts)], names=["t"])])))
    summed = Counter()
    for b in parts:
        for kind, key, c in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
            summed[kind, key] += c
    assert summed == Counter({(int(k), int(key)): int(c) for k, key, c in zip(kinds, keys, n, strict=True)})


def test_a_slice_of_the_tree_takes_little_memory():
    draw = np.random.default_rng(5)
    data = draw.integers(97, 123, 200_000).astype(np.uint8)
    keys, counts = np.unique(L.grams(data, np.array([0, len(data)]), L.DEPTH)[0], return_counts=True)
    top = L.Top(*(np.zeros(0, t) for t in (np.uint64, np.int64)), -1, (np.zeros(0, np.uint64), np.zeros(0)))
    tracemalloc.start()
    told = L.ContextTree.answers(keys, counts, L.DEPTH, top, keys)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 400 * len(keys)  # all eight decisions in hash tables took over 900 bytes an entry
    assert np.array_equal(told, L.ContextTree(keys, counts, L.DEPTH).log10(keys))
