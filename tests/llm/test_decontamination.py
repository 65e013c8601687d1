from pyspark.sql import functions as F

from larkspur.llm import decontamination as D

from .helpers import awkward, changed, empty, shingles, words


def brute(docs, items, t=0.8):
    out = set()
    for i, x in docs:
        own = set(k for k in shingles(x) if len(k) == 5)
        for j, y in items:
            want = set(k for k in shingles(y) if len(k) == 5)
            if want and len(want & own) >= t * len(want) - 1e-9:
                out.add((i, j, len(want & own)))
            if not want and f" {' '.join(y.lower().split())} " in f" {' '.join(x.lower().split())} ":  # the item of four words
                out.add((i, j, 1))
    return out


def test_equals_brute_force(spark):
    items = [(j, " ".join(words(100 + j, n))) for j, n in enumerate([5, 6, 9, 17, 33, 60, 130, 4])]
    docs = []
    for i in range(60):
        base = words(i, 300)
        item = items[i % 8][1].split()
        cut = changed(item, i, min(len(item), i % 5))
        docs.append((i, " ".join(base[:100] + cut + base[100:]).upper() if i % 3 else " ".join(base)))
    docs.append((60, items[4][1] + ", " + items[5][1] + "! " + items[4][1]))
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    assert len(want) > 12
    for limit in (10**6, 0):  # with and without broadcasts
        got = {(r["doc_id"], r["item_id"], r["shared"]) for r in D.matches(d, b, broadcast_rows=limit).collect()}
        assert got == want
    left = {r["doc_id"] for r in D.decontaminate(d, b).collect()}
    assert left == {i for i, _ in docs} - {i for i, _, _ in want}


def test_awkward_rows(spark):
    docs = awkward(spark)
    items = spark.createDataFrame([(1, None), (None, "a b c d e f"), (2, ""), (3, "too short"), (4, "Some words, here AND there again"), (4, "some words here and there again")], "item_id long, text string")
    assert [(r["doc_id"], r["item_id"]) for r in D.matches(docs, items).collect()] == [(None, 4)]
    kept = D.decontaminate(docs, items)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 1
    assert D.matches(empty(spark), items).count() == 0
    assert D.matches(docs, items.limit(0)).count() == 0 and D.decontaminate(docs, items.limit(0)).count() == docs.count()


def test_rows_of_one_doc_id_are_one_document(spark):
    item = words(7, 14)  # ten shingles
    rows = [(1, " ".join(item[:9])), (1, "other words between " + " ".join(item[5:])), (2, " ".join(item[:9]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"__leak": F.lit(1), "__item": F.lit(2)})
    items = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    for limit in (10**6, 0):
        assert [(r["doc_id"], r["shared"]) for r in D.matches(docs, items, broadcast_rows=limit).collect()] == [(1, 10)]
    left = D.decontaminate(docs, items)
    assert left.columns == docs.columns and [r["doc_id"] for r in left.collect()] == [2]


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g")], "doc_id long, text string")
    plan = D.matches(docs, docs.withColumnRenamed("doc_id", "item_id"))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_items_of_one_to_four_words(spark):
    """Three and four words are found anywhere, one and two in texts of nothing else; by brute force and by SQL."""
    import duckdb

    from larkspur.llm import queries

    items = [(1, "Paris"), (2, "blue whale"), (3, "one two three"), (4, "alpha, beta gamma DELTA"), (5, "w1x w2x w3x w4x w5x w6x"), (6, "?!"), (6, None), (7, "one two three"), (7, "red fox runs"), (8, "tail"), (8, "w1x w2x w3x w4x w5x w6x")]
    far = " ".join(words(3, 500))
    docs = [(1, "paris!"), (2, "we went to paris"), (3, "Blue  whale"), (4, "a blue whale swam"), (5, f"{far} one, two three {far}"), (6, "alpha beta gamma delta"), (7, f"{far} alpha beta; gamma delta"), (8, "one two"), (9, ""), (10, None), (11, "one two three red fox runs"), (12, "tail"), (13, "w1x w2x w3x w4x w5x w6x"), (6, "alpha beta gamma delta")]
    want = {(1, 1, 1), (3, 2, 1), (5, 3, 1), (6, 4, 1), (7, 4, 1), (11, 3, 1), (11, 7, 2), (13, 5, 2), (13, 8, 2)}
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for limit in (10**6, 0):
        got = D.matches(d, b, broadcast_rows=limit).collect()
        assert {(r["doc_id"], r["item_id"], r["shared"]) for r in got} == want and len(got) == len(want)
    con = duckdb.connect()
    con.register("documents", d.toPandas())
    con.register("benchmark", b.toPandas())
    assert {r[:2] + (r[3],) for r in con.sql(queries.ORACLE["op1_decontamination"]).fetchall()} == want
    everywhere = {(r["doc_id"], r["item_id"]) for r in D.matches(d, b, inside=1).collect()}
    assert everywhere == {x[:2] for x in want} | {(2, 1), (4, 2)}
    assert {r["doc_id"] for r in D.decontaminate(d, b).collect()} == {2, 4, 8, 9, 10, 12}
