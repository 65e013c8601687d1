import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from larkspur.llm import packing

from .helpers import DOCS, awkward, empty, words

PATH = public_tokenizers.path("word_bpe_49k.json")


def padding(sequences, length=packing.LENGTH):
    """Share of padding; asserts that each sequence is gapless and not too long."""
    held = paid = 0
    for pieces in sequences.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at and n > 0
            at += n
        assert at <= length
        held, paid = held + at, paid + (at if at & (at - 1) == 0 else length)
    return 1 - held / paid if paid else 0.0


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 63), st.integers(1, 40), max_size=30), st.integers(1, 8))
def test_plan_places_every_token_once(histogram, least):
    p, sequences = packing.plan(histogram, 64, least), defaultdict(list)
    for size, n in histogram.items():
        for rank in range(n):
            at = 0
            for start, m, sequence, offset in p.pieces(size, rank):
                assert start == at
                at += m
                sequences[sequence].append((offset, m))
            assert at == size
    assert sorted(sequences) == list(range(p.sequences))
    assert padding(sequences, 64) <= least / 64


def test_shortest_pack_first():
    # 60 and 50 open packs; 13 goes to the one with more room, 4 then to the other; 64 // 20 pieces of 20 share a new pack
    assert packing.patterns({60: 1, 50: 1, 13: 1, 4: 1}, 64) == [(1, 0, [(60, 1), (4, 1)]), (1, 1, [(50, 1), (13, 1)])]
    assert packing.patterns({20: 7}, 64) == [(2, 4, [(20, 3)]), (1, 44, [(20, 1)])]


def test_patterns_grow_with_the_length_not_with_the_documents():
    draw = random.Random(1)
    few = {s: draw.randrange(1, 50) for s in range(1, 2048)}
    assert len(packing.patterns({s: n * 10**9 for s, n in few.items()})) <= 2 * len(packing.patterns(few)) + 4096


def check(df, rows):
    """Each id of each row once, as the tokenizer gives them for the whole text."""
    tokenizer, sequences, held = Tokenizer.from_file(PATH), defaultdict(list), defaultdict(list)
    for r in df.collect():
        held[r["doc_id"], r["doc_tokens"]].append((r["start"], tuple(np.frombuffer(r["ids"], "<u4").tolist())))
        assert r["length"] * 4 == len(r["ids"])
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    want = defaultdict(list)
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        want[doc_id, len(ids)].append(ids)
    assert held.keys() == want.keys()
    for key, texts in want.items():
        if len(texts) == 1:
            assert [i for _, x in sorted(held[key]) for i in x] == texts[0]
        else:  # rows of one id and length: their pieces together
            assert sorted(i for _, x in held[key] for i in x) == sorted(i for t in texts for i in t)
    assert sorted(sequences) == list(range(len(sequences)))
    return padding(sequences)


def test_ids_are_the_tokenizers(spark):
    odd = ["a<|endoftext|>b <|startoftext|>", "é ́x  tab\there\n\nnew", "It's we'll 12345 ＡＢΣ ΣΑΣ", "　  x", "漢字かな" * 800, "İstanbul'S", " ", "x" * 9000, " ".join(words(3, 5000))]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(odd + odd[:2])]
    assert check(packing.pack(spark.createDataFrame(rows, DOCS), PATH, ["doc_id"]), [(r[0], r[1]) for r in rows]) < 0.01


@pytest.mark.parametrize("make", [awkward, empty])
def test_awkward_tables(spark, make):
    docs = make(spark).withColumnRenamed("shard", "offset")
    out = packing.pack(docs, PATH, ["doc_id", *[c for c in ("offset",) if c in docs.columns]])
    assert check(out, [(r["doc_id"], r["text"]) for r in docs.collect()]) < 0.01
    assert "offset" not in docs.columns or "kept_offset" in out.columns


def test_hot_length_and_many_parts(spark, monkeypatch):
    monkeypatch.setattr(packing, "NUMBERED", 7)
    rows = [(i, "one two three four" if i % 3 else " ".join(words(i, 20 + 9 * i)), "en", "s", 0) for i in range(300)]
    assert check(packing.pack(spark.createDataFrame(rows, DOCS).repartition(6), PATH, ["doc_id"]), [(r[0], r[1]) for r in rows]) < 0.005


def test_query_has_the_crc_of_the_ids(spark):
    import zlib

    from larkspur.llm import queries

    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    tokenizer = Tokenizer.from_file(PATH)
    for r in queries.op13_packing(spark, sf).limit(50).collect():
        ids = np.array(tokenizer.encode(texts[r["doc_id"]], add_special_tokens=False).ids + [1], "<u4")
        assert r["doc_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes())
