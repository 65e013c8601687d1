import os
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspur.llm import nearest as N
from larkspur.llm import token_counts as T

from .helpers import awkward, empty

MODEL = os.environ.get("LARKSPUR_UNIGRAM_VOCABULARY", "/opt/tokenizers/piece_bpe_32k.model")


def library(vocabulary):
    tokenizers = pytest.importorskip("tokenizers")
    low = min(s for _, s in vocabulary.pieces)
    own = [("<unk>", low), *((f"<0x{b:02X}>", low) for b in range(256 if vocabulary.byte_fallback else 0)), *vocabulary.pieces]
    t = tokenizers.Tokenizer(tokenizers.models.Unigram(own, 0, vocabulary.byte_fallback))
    t.pre_tokenizer = tokenizers.pre_tokenizers.Metaspace(replacement=T.MARK, prepend_scheme="never", split=False)
    return lambda x: len(t.encode(" " + x, add_special_tokens=False).ids)


@pytest.mark.parametrize("seed", range(6))
def test_ties_and_unknowns_equal_the_library(seed):
    draw = random.Random(seed)
    pieces = {T.MARK: -2.0, "a": -1.0, "b": -1.0}
    for _ in range(25):
        pieces[draw.choice(["", T.MARK]) + "".join(draw.choice("abc") for _ in range(draw.randint(1, 4)))] = -float(draw.randint(1, 3))
    if seed % 2:
        pieces[T.MARK * 2] = -2.0
    v = T.Vocabulary(tuple(pieces.items()), seed % 3 > 0)
    count, counter = library(v), T.Counter(v)
    for _ in range(150):
        text = "".join(draw.choice("aabbc  é\n漢") for _ in range(draw.randint(1, 14)))
        assert counter.text(text)[0] == count(text), (text, v)


@pytest.mark.skipif(not os.path.exists(MODEL), reason="no vocabulary file")
def test_a_public_vocabulary(spark):
    v = T.Vocabulary.from_sentencepiece(MODEL)
    count = library(v)
    docs = awkward(spark).where("doc_id is null or doc_id <> 3")
    for r in T.count_tokens(docs, v, ["text"]).collect():
        assert r["n_tokens"] == (count(r["text"]) if r["text"] else 0)
    assert T.count_tokens(empty(spark), v, ["doc_id"]).count() == 0


def as_unigram(path, out, spaces):
    """The same pieces and scores (but for the lowest) as a unigram model; `spaces`: repeated spaces go."""
    with open(path, "rb") as f:
        fields = list(T.message_fields(f.read()))

    def packed(items):
        b = b""
        for k, v in items:
            kind = 0 if isinstance(v, int) else 5 if (len(v) == 4 and k in FLOATS) else 2
            b += varint(k << 3 | kind) + (varint(v) if kind == 0 else v if kind == 5 else varint(len(v)) + v)
        return b

    def varint(n):
        b = b""
        while n > 127:
            b, n = b + bytes([n & 127 | 128]), n >> 7
        return b + bytes([n])

    FLOATS = set()
    body = b""
    for k, v in fields:
        if k == 1:
            FLOATS = {2}
            v = packed([(a, struct.pack("<f", max(-40_000.0, struct.unpack("<f", b)[0])) if a == 2 else b) for a, b in T.message_fields(v)])
        if k == 2:
            FLOATS = {10, 15}  # floats of the trainer's part
            v = packed([(a, 1 if a == 3 else b) for a, b in T.message_fields(v)])
        if k == 3:
            FLOATS = set()
            v = packed([(a, int(spaces) if a == 4 else b) for a, b in T.message_fields(v)])
        body += varint(k << 3 | 2) + varint(len(v)) + v
    out.write_bytes(body)
    return str(out)


@pytest.mark.skipif(not os.path.exists(MODEL), reason="no vocabulary file")
@pytest.mark.parametrize("spaces", [False, True])
def test_a_unigram_file_counts_as_its_own_encoder(spark, tmp_path, spaces):
    """Its scores are whole numbers, so sums are exact in the library's single precision too."""
    sentencepiece = pytest.importorskip("sentencepiece")
    path = as_unigram(MODEL, tmp_path / "unigram.model", spaces)
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("length(text) < 1200").select("text")
    more = spark.createDataFrame([("  two  spaces ",), (" lead",), ("trail ",), (" ",), ("a▁b",), ("tab\tand\nline",), ("漢字 ß",), ("",), (None,)], "text string")
    v = T.Vocabulary.from_sentencepiece(path)
    assert (v.normaliser is not None) == spaces
    got = T.count_tokens(docs.union(more), v, ["text"]).collect()
    assert len(got) > 60 and all(r["n_tokens"] == len(model.encode(r["text"] or "")) for r in got)


@pytest.mark.skipif(not os.path.exists(MODEL), reason="no vocabulary file")
def test_merge_ranks_are_read_as_probabilities(spark):
    v = T.Vocabulary.from_sentencepiece(MODEL)
    assert abs(sum(np.exp(s) for _, s in v.pieces) - 1) < 1e-9 and v.pieces[0][1] == max(s for _, s in v.pieces)
    c, long = T.Counter(v), "abc" * 50_000
    assert c.text(long)[0] == T.Counter(v).viterbi(T.MARK + long)[0] >= 50_000


def brute(ids, x, queries, k):
    out = {}
    for i in queries:
        s = (x * x[ids.index(i)]).sum(axis=1)
        out[i] = sorted((j for j in range(len(ids)) if ids[j] != i), key=lambda j: (-s[j], ids[j]))[:k]
    return {i: [ids[j] for j in v] for i, v in out.items()}


def frame(spark, ids, x):
    return spark.createDataFrame([(i, [float(c) for c in v]) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<double>")


def test_recall_and_scores(spark):
    x = np.random.default_rng(0).normal(size=(1500, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ids = list(range(1500))
    got = N.search(frame(spark, ids, x), F.col("vec_id") % 20 == 0, block=400, chunk=30).collect()
    want = brute(ids, x, ids[::20], 20)
    found = {}
    for r in got:
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
        assert abs(r["score"] - x[r["query_id"]] @ x[r["vec_id"]]) < 1e-12
    assert np.mean([len(found[q] & set(w)) / 20 for q, w in want.items()]) >= 0.9
    assert sorted(r["rank"] for r in got if r["query_id"] == 0) == list(range(1, 21))


def test_all_cells_are_exact_with_ties(spark):
    draw = np.random.default_rng(1)
    x = draw.integers(-2, 3, size=(200, 6)).astype(float)
    x[:, 0] += 0.5
    x[50:130] = x[50]
    ids = [3 * i for i in range(200)]
    got = N.search(frame(spark, ids, x).repartition(6), F.col("vec_id") % 20 == 0, k=7, recall=1.0, block=64, chunk=4).orderBy("query_id", "rank").collect()
    found = {}
    for r in got:
        found.setdefault(r["query_id"], []).append(r["vec_id"])
    assert found == brute(ids, x, [i for i in ids if i % 20 == 0], 7)


def test_visits_go_by_rising_distance():
    x = np.random.default_rng(2).normal(size=(300, 8))
    index = N.MultiIndex(x, 6)
    index.counts = np.bincount(index.cells(x), minlength=36)
    q = x[0]
    far = (-(index.first @ q[:4]))[:, None] - (index.second @ q[4:])[None, :]
    for due in (1, 40, 200, 1000):
        flags = index.visit(q, due).reshape(6, 6)
        seen, rest = far[flags], far[~flags]
        assert index.counts[flags.reshape(-1)].sum() >= min(due, 300) and (not rest.size or seen.max() <= rest.min() + 1e-12)


def test_vectors_that_take_no_part(spark):
    rows = [(0, [1.0, 2.0]), (20, None), (40, [0.0, 0.0]), (60, [float("nan"), 1.0]), (80, [1.0, None]), (100, [float("inf"), 1.0]), (None, [1.0, 1.0]), (120, [1.0, 1.0, 1.0]), (1, [3.0, 1.0]), (1, [3.0, 1.0]), (140, [1.0, 0.0]), (160, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in N.search(df, F.col("vec_id") % 20 == 0).collect()}
    assert got == {(0, 1, 1, 5.0), (0, 2, 140, 1.0), (140, 1, 1, 3.0), (140, 2, 0, 1.0)}
    assert N.search(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_a_vec_id_of_two_vectors_and_a_second_length(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 2.0]), (7, [1.0, 1.0]), (20, [1.0, 1.0, 0.0]), (9, [0.0, 0.0, 4.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"row": F.lit(1), "cell": F.lit(2), "v": F.lit("x")})
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in N.search(df, F.col("vec_id") % 20 == 0).collect())
    assert got == [(0, 1, 7, 1.0), (0, 1, 7, 2.0), (0, 2, 0, 0.0), (0, 2, 0, 0.0), (20, 1, 9, 0.0)]
