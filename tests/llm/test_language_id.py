import random

from pyspark.sql import functions as F

from larkspur.llm import language_id as L

from .helpers import awkward, empty

LANGS = {"aa": ["the", "and", "water", "house", "with"], "bb": ["der", "und", "wasser", "haus", "mit"], "cc": ["le", "et", "eau", "maison", "avec"]}


def sentence(lang, seed, n=12):
    draw = random.Random(f"{lang}{seed}")
    return " ".join(draw.choice(LANGS[lang]) for _ in range(n))


def naive_phrases(reference, text):
    """Greedy longest phrases, by search in the reference."""
    classes = lambda b: bytes(L._CLASS[list(b)]) if b else b""
    ref, out = classes(reference), 0
    for at in range(0, len(text), L.SEGMENT):
        part = classes(text[at : at + L.SEGMENT])
        i = 0
        while i < len(part):
            n = 1
            while i + n < len(part) and part[i : i + n + 1] in ref:
                n += 1
            i, out = i + n, out + 1
    return out


def test_parser_counts_longest_phrases():
    import numpy as np

    ref = " ".join(sentence("aa", s) for s in range(8)).encode()
    parser = L.Parser(ref)
    for seed in range(12):
        text = (sentence("aa" if seed % 2 else "bb", 100 + seed, 5) + " ?é9").encode()
        lanes = np.zeros((L.SEGMENT, 1), np.uint8)
        lanes[: len(text), 0] = L._CLASS[list(text)]
        assert parser.phrases(lanes)[0] == naive_phrases(ref, text)


def test_held_out_accuracy(spark):
    rows = [(i, sentence(lang, i), lang) for i, lang in enumerate(list(LANGS) * 60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    refs = L.references(df.where("doc_id % 5 <> 1"))
    got = L.identify(df, refs, ["doc_id", "lang"]).collect()
    assert all(r["lang"] == r["lang_pred"] and 0.3 < r["score"] <= 1 for r in got)


def test_awkward_rows(spark):
    docs = awkward(spark)
    refs = L.references(docs)
    got = {(r["doc_id"], r["lang_pred"] == "und") for r in L.identify(docs, refs, ["doc_id"]).collect()}
    assert got == {(1, True), (2, True), (None, False), (None, True), (3, False), (4, False), (5, True), (6, False)}
    kept = L.keep_identified(docs, refs)
    assert kept.columns == docs.columns and kept.count() == 5
    assert L.identify(empty(spark), refs, ["doc_id"]).count() == 0
    nothing = L.references(empty(spark))
    assert nothing == () and {r["lang_pred"] for r in L.identify(docs, nothing, ["doc_id"]).collect()} == {"und"}


def test_only_labels_and_text_matter(spark):
    rows = [(i, sentence(lang, i), lang) for i, lang in enumerate(list(LANGS) * 20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert L.references(df) == L.references(df.withColumn("doc_id", F.col("doc_id") * 7).repartition(3))


def test_languages_with_long_texts_alone_have_references(spark):
    rows = [(i, "1 " * 9_000 + " ".join(sentence(lang, f"{i}-{k}") for k in range(300)), lang) for i, lang in enumerate(list(LANGS) * 12)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    refs = L.references(df.where("doc_id % 4 <> 1"))
    assert [k for k, _ in refs] == list(LANGS) and all(not v.startswith(b"1") for _, v in refs)
    assert all(r["lang"] == r["lang_pred"] for r in L.identify(df, refs, ["lang"]).collect())


def test_references_do_not_shrink_with_the_number_of_languages(spark):
    rows = [(i, f"l{i % 20}x t{i}x " + sentence("aa", i, 600), f"l{i % 20}") for i in range(240)]
    refs = L.references(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert len(refs) == 20 and all(23_900 < len(v) <= 24_000 for _, v in refs)
    # each of the up to 12 sampled texts has its part (12 less those of equal remainder)
    assert all(v.count(k.encode() + b"x") >= 6 for k, v in refs)


def test_references_come_from_all_over_a_text(spark):
    """Long numbers after one letter leave the words that follow them to the reference."""
    numbers = lambda i: " ".join(str(10**7 + 9_973 * i + 17 * k) for k in range(2_000))
    rows = [(i, f"a {numbers(i)} " + " ".join(sentence("aa", f"{i}-{k}") for k in range(20)), "aa") for i in range(40)]
    rows += [(100 + i, sentence("bb", i, 200), "bb") for i in range(40)]
    refs = L.references(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert all(w.encode() in dict(refs)["aa"] for w in LANGS["aa"])
    asked = spark.createDataFrame([(i, sentence("aa", f"new{i}", 30)) for i in range(20)], "doc_id long, text string")
    assert {r["lang_pred"] for r in L.identify(asked, refs, ["doc_id"]).collect()} == {"aa"}


def test_slices_without_spaces_and_ties(spark):
    """A text of one endless word is cut by length; equal references tie, and the first language by code point wins."""
    rows = [(1, "ab" * 9_000, "xx"), (2, "ab" * 9_000, "yy"), (3, "漢字" * 5_000, "zz")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    refs = L.references(docs)
    assert [k for k, _ in refs] == ["xx", "yy", "zz"] and refs[0][1] == refs[1][1] and all(0 < len(v) <= 24_000 for _, v in refs)
    assert {r["doc_id"]: r["lang_pred"] for r in L.identify(docs, refs, ["doc_id"]).collect()} == {1: "xx", 2: "xx", 3: "zz"}
