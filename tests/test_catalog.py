"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import glob
import os
import subprocess
import sys

import duckdb
import pandas as pd
import pytest

from larkspur.plans import catalog, price_queries

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


def tidy(df, cols):
    def one(x):
        if x is None or x is pd.NA or x is pd.NaT or (isinstance(x, float) and x != x):
            return "null"
        return repr(round(float(x), 6) + 0.0) if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x)

    return sorted(tuple(one(x) for x in row) for row in df[cols].astype(object).itertuples(index=False))


ALL, SQL = {**catalog.QUERIES, **price_queries.QUERIES}, {**catalog.ORACLE, **price_queries.ORACLE}


@pytest.mark.parametrize("name", sorted(ALL))
def test_query_equals_sql(spark, con, name):
    got, want = ALL[name](spark, SF).toPandas(), con.sql(SQL[name]).df()
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    assert tidy(got, cols) == tidy(want, cols)


def test_entry_without_the_llm_folder(tmp_path):
    """The entry imports and has the other queries where the subpackage and the pipeline are gone."""
    import shutil

    for name in ("larkspur", "__spark_entry__.py"):
        source = os.path.join(ROOT, name)
        (shutil.copytree if os.path.isdir(source) else shutil.copy)(source, tmp_path / name)
    shutil.rmtree(tmp_path / "larkspur" / "llm")
    code = "import __spark_entry__ as e; q = e.queries(); assert 'primary_coverage' in q and not any(k.startswith('op') and k[2].isdigit() for k in q) and set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 3


def test_audits_and_merges_over_all_events(spark):
    """Every user and every key of the events counts, whatever the value or the id."""
    sf = "/root/testdata/sf0.1"
    con, q = duckdb.connect(), catalog.QUERIES
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{sf}/events.parquet'")
    users = [con.execute(f"SELECT count(DISTINCT user_id) FROM events WHERE event_type = '{t}'").fetchone()[0] for t in ("click", "signup")]
    got = q["coverage_audit"](spark, sf).toPandas()
    assert [got["cards_with_click"].sum(), got["cards_with_signup"].sum()] == users == [1500, 1500]
    keys = con.execute("SELECT count(*) FROM (SELECT DISTINCT user_id, event_type FROM events)").fetchone()[0]
    assert q["upsert_last_wins"](spark, sf).count() == q["insert_ignore"](spark, sf).count() == keys


@pytest.fixture(scope="module")
def searched():
    """Of every vector of sf0.01 by brute force: label, true id, nearest other vector and the place of the true one."""
    import numpy as np

    t = duckdb.sql("SELECT vec_id, label, embedding FROM '/root/testdata/sf0.01/embeddings.parquet' ORDER BY vec_id").df()
    ids, labels, x = t["vec_id"].to_numpy(), t["label"].to_numpy(), np.stack(t["embedding"]).astype(np.float64)
    out = {}
    for i in range(len(ids)):
        score = (x * x[i]).sum(axis=1)
        order = [j for j in np.lexsort((ids, -score)) if j != i]
        true = next((j for j in range(i + 1, len(ids)) if labels[j] == labels[i]), None)
        out[int(ids[i])] = (int(labels[i]), None if true is None else int(ids[true]), int(ids[order[0]]), int(labels[order[0]]), len(ids) + 1 if true is None else order.index(true) + 1)
    return out


def test_metrics_by_label_ask_with_every_vector(spark, searched):
    """Label 7 of sf0.01 has no vector whose id is divisible by 20."""
    got = {r["query_group"]: (r["sample_count"], r["mean_rank"]) for r in catalog.metrics_by_label(spark, "/root/testdata/sf0.01").collect()}
    ranks = {g: [s[4] for s in searched.values() if s[0] == g] for g in {s[0] for s in searched.values()}}
    assert 7 in got and got == {g: (len(r), pytest.approx(sum(r) / len(r), abs=6e-5)) for g, r in ranks.items()}


def test_confusion_asks_with_every_vector(spark, searched):
    got = {(r["query_id"], r["top1_id"], r["correct_rank"]) for r in catalog.confusion(spark, "/root/testdata/sf0.01").collect()}
    assert got == {(q, top, rank) for q, (label, true, top, top_label, rank) in searched.items() if top != true and top_label == label}
    assert any(q % 20 for q, _, _ in got)


def test_retrieval_metrics_ask_with_every_vector(spark, searched):
    got = catalog.retrieval_metrics(spark, "/root/testdata/sf0.01").first()
    ranks = [s[4] for s in searched.values()]
    assert got["sample_count"] == len(ranks) == 500
    assert got["mean_rank"] == pytest.approx(sum(ranks) / 500, abs=6e-5)
    assert got["mean_reciprocal_rank"] == pytest.approx(sum(1 / r for r in ranks) / 500, abs=6e-5)
