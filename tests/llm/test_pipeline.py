import duckdb
import pytest

import corpus_pipeline
from larkspur.llm import queries

from .helpers import awkward, changed, empty, words

SF = "/root/testdata/sf0.001"


def test_each_stage_takes_effect(spark, tmp_path):
    item = " ".join(words(900, 30))
    base = words(1, 80)
    rows = [(1, " ".join(base), "en", "a", 1), (2, " ".join(changed(base, 1, 1)), "en", "a", 1), (3, "12 34 !!", "en", "a", 1), (4, " ".join(words(4, 50)) + " " + item, "en", "b", 1)]
    rows += [(10 + i, " ".join(words(50 + i, 40)), "en", "ab"[i % 2], 1) for i in range(40)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, ids = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, str(tmp_path))
        if stage is not corpus_pipeline.STAGES[-1][1]:
            assert after.columns == docs.columns
        docs = after.cache()
        ids.append([r["doc_id"] for r in docs.collect()])
    everyone = {r[0] for r in rows}
    assert set(ids[0]) == everyone - {3} and set(ids[1]) == everyone - {2, 3} and set(ids[2]) == everyone - {2, 3, 4}
    assert len(ids[0]) == len(set(ids[0])) and len(ids[2]) == len(set(ids[2]))
    assert set(ids[3]) <= set(ids[2]) and sorted(ids[4]) == sorted(ids[3])


@pytest.mark.parametrize(("make", "kept"), [(awkward, {None, 3, 4, 6}), (empty, set())])
def test_awkward_tables_run_through(spark, tmp_path, make, kept):
    """Texts without letters go, one of two equal rows stays; sources of one document each keep it; slots are gapless."""
    docs = make(spark)
    spark.createDataFrame([(1, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
    rows = docs.collect()
    assert {r["doc_id"] for r in rows} <= kept and bool(rows) == bool(kept)
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(x) == list(range(len(x))) for x in by_shard.values())


def test_run_leaves_only_the_last_stage_input(spark, tmp_path):
    """run() equals its stages called one by one, and deletes the folders of the stages before the last but one."""
    import os

    from larkspur.llm import common

    rows = [(i, " ".join(words(i, 30)), "en", "ab"[i % 2], 1) for i in range(40)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, rows[3][1])], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    folder = common.shared_dir(spark).removeprefix("file:")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
    want = sorted(map(str, docs.collect()))
    written, kept = [], common.table
    try:
        common.table = lambda df: written.append(kept(df)) or written[-1]
        got = corpus_pipeline.run(spark, str(tmp_path))
        own = [t.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://") for t in written if set(t.columns) == {"doc_id", "text", "lang", "source", "n_chars"}]
    finally:
        common.table = kept
    assert sorted(map(str, got.collect())) == want and all(r["doc_id"] != 3 for r in got.collect())
    assert all(f.startswith(folder) for f in own) and [os.path.exists(f) for f in own[:-1]] == [False] * (len(own) - 1) and os.path.exists(own[-1])


def test_names_and_order():
    assert [n.split("_")[0] for n, _ in corpus_pipeline.STAGES] == ["op10", "op7", "op1", "op2", "op6"]
    assert sorted(int(n.split("_")[0][2:]) for n in queries.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = queries.QUERIES[name](spark, SF).toPandas()
    want = con.sql(queries.ORACLE[name]).df()
    cols = sorted(want.columns)
    tidy = lambda d: sorted(map(tuple, d[cols].astype(object).where(d[cols].notna(), None).values.tolist()), key=str)
    assert sorted(got.columns) == cols and tidy(got) == tidy(want)
