import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspur.llm import common
from larkspur.llm import near_dedup as N
from larkspur.llm.components import connected_components

from .helpers import awkward, changed, empty, jaccard, shingles, words


def groups(rows, threshold=0.8):
    sets = [shingles(x) for _, x in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and jaccard(sets[i], sets[j]) >= threshold:
                root[find(i)] = find(j)
    members = {}
    for i, (d, _) in enumerate(rows):
        members.setdefault(find(i), []).append(d)
    return {d: min(m) for m in members.values() for d in m}


def test_classes_equal_brute_force(spark):
    rows = []
    for g in range(12):
        base = words(g, 40 + 60 * (g % 4))
        rows += [(100 * g, " ".join(base)), (100 * g + 1, " ".join(base))]
        rows += [(100 * g + 2 + k, " ".join(changed(base, k, 1 + k % 3))) for k in range(6)]
    rows += [(5000, "the the the the the the the"), (5001, "the the the the the the"), (5002, "alone")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = N.near_duplicate_classes(df).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == groups(rows)
    assert sorted(r["doc_id"] for r in got if r["keep"]) == sorted(set(groups(rows).values()))
    assert {r["doc_id"] for r in N.deduplicate(df).collect()} == set(groups(rows).values())


def test_links_that_leaders_and_neighbours_leave_open(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 7)
    monkeypatch.setattr(N, "NEIGHBOURS", 0)
    base = words(1, 300)
    rows = [(k, " ".join(changed(base, k, 3 + k % 4))) for k in range(60)]
    expected = groups(rows)
    assert 1 < len(set(expected.values())) < 60
    got = N.near_duplicate_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == expected


@pytest.mark.parametrize("repeats", [0, 30, 700])
def test_a_coordinate_agrees_as_often_as_the_multisets(repeats):
    base = words(3, 200) + ["the"] * repeats
    other = changed(base[:200], 1, 8) + ["the"] * (repeats * 3 // 4)
    size = 4096
    sigs = []
    for t in (base, other):
        data = np.frombuffer(" ".join(t).encode(), np.uint8)
        sigs.append(N.dart_signatures(*N.weighted_elements(data, np.array([0, len(data)]), 5), 1, size)[0])
    true = jaccard(shingles(" ".join(base)), shingles(" ".join(other)))
    assert 0.4 < true < 0.95 and abs((sigs[0] == sigs[1]).mean() - true) < 0.04


def test_awkward_rows(spark):
    docs = awkward(spark)
    got = N.near_duplicate_classes(docs).collect()
    assert len(got) == docs.count()
    assert {r["doc_id"]: (r["class_id"], r["keep"]) for r in got if r["doc_id"] in (1, 2, 5)} == {1: (1, True), 2: (1, False), 5: (5, True)}
    assert len({r["class_key"] for r in got if r["doc_id"] is None}) == 2
    assert [r["class_id"] for r in got if r["doc_id"] == 4] == [4, 4]
    kept = N.deduplicate(docs)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 3 and kept.where("doc_id = 4").count() == 1
    assert N.near_duplicate_classes(empty(spark)).count() == 0 and N.deduplicate(empty(spark)).count() == 0


def test_wordless_copies_are_one_class_and_clashing_columns_stay(spark):
    rows = [(k, "!!! ***", k) for k in range(50)] + [(60, "!!!  ***", 60), (61, "a b c d e f", 61)]
    df = spark.createDataFrame(rows, "doc_id long, text string, __t long").withColumns({"__tid": F.lit(1), "class_id": F.lit(2), "tid": F.lit(3)})
    kept = N.deduplicate(df)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"], r["__t"]) for r in kept.collect()) == [(0, 0), (60, 60), (61, 61)]


def test_a_large_group_of_copies_with_strangers(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 64)
    base = words(5, 200)
    rows = [(k, " ".join([*base[:199], f"end{k}"])) for k in range(1500)]  # one group
    rows += [(2000 + k, " ".join(changed(base, 900 + k, 7 + k % 6))) for k in range(40)]  # around the threshold
    got = N.near_duplicate_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    probe = groups(rows[:3] + rows[1500:])  # all copies are at least as near to each other as these
    want = {d: c for d, c in probe.items()} | {d: 0 for d in range(1500)}
    near = {d for d, _ in rows[1500:] if any(jaccard(shingles(dict(rows)[d]), shingles(t)) >= 0.8 for _, t in rows[:1500:100])}
    assert all((want[d] == 0) == (d in near) or want[d] == 0 for d in want if d >= 2000)
    assert {r["doc_id"]: r["class_id"] for r in got} == want


def test_components_of_a_path_a_star_and_loops(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 50)] + [(200, 200), (None, 1), (101, 102)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(31)}, **{100 + i: 100 for i in range(50)}}


def test_components_that_are_stars_cost_no_round_and_new_edges_join_them(spark):
    stars = [(i, 100 * (i // 100)) for i in range(1, 400) if i % 100]
    known = connected_components(spark.createDataFrame(stars, "a long, b long"), max_rounds=1)
    assert {(r["node"], r["root"]) for r in known.collect()} == {(i, 100 * (i // 100)) for i in range(400)}
    new = spark.createDataFrame([(399, 150), (7, 500), (None, 3)], "a long, b long")
    got = {r["node"]: r["root"] for r in connected_components(known.union(new), "node", "root").collect()}
    assert got == {i: 100 if i >= 300 else 100 * (i // 100) for i in range(400)} | {500: 0}


def test_words_do_not_depend_on_pieces():
    text = ("Ab-c d.é 1x\n" * 50).encode() + b"x" * 300
    data, offsets = np.frombuffer(text + text, np.uint8), np.array([0, len(text), 2 * len(text)])
    whole = common.word_hashes(data, offsets)
    for piece in (7, 64, 1000):
        cut = common.word_hashes(data, offsets, piece)
        assert (cut[0] == whole[0]).all() and (cut[1] == whole[1]).all()
    assert (whole[1] == 0).sum() == (whole[1] == 1).sum() == 251


def test_long_words_that_differ_by_an_exchange_have_other_hashes():
    texts = [b"ab" + b"x" * 62 + b"ba" + b"y" * 14, b"ba" + b"x" * 62 + b"ab" + b"y" * 14, b"x" * 80, b"x" * 81]
    for n in (200, 5000):
        texts += [b"a" * n + b"b" * n, b"b" * n + b"a" * n, (b"ab" * n), (b"ba" * n)]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    assert len(set(common.word_hashes(data, offsets)[0].tolist())) == len(texts)


def test_tables_of_the_last_links_are_deleted(spark):
    """Of the tables that the groups are found with only the rows' names stay, which the result is read from."""
    import glob

    from larkspur.llm import common, near_dedup

    folder = common.shared_dir(spark).removeprefix("file:")
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(words[: 60 - i % 3]) if i < 6 else f"{i} other text of its own {i * i}") for i in range(10)]
    before = set(glob.glob(f"{folder}/**/table-*", recursive=True))
    out = near_dedup.near_duplicate_classes(spark.createDataFrame(rows, "doc_id long, text string"))
    assert len({r["class_id"] for r in out.collect()}) == 5
    assert len(set(glob.glob(f"{folder}/**/table-*", recursive=True)) - before) == 1
