import random

import pytest
from pyspark.sql import functions as F

from larkspur.streaming import breaker, keyed, views


def test_first_hits_of_a_stream(spark, tmp_path):
    rows = [("a", "2026-01-01 00:00:01", 0, 9), ("a", "2026-01-01 00:00:02", 1, 1), ("b", "2026-01-01 00:00:03", 0, 4), ("z", "2026-01-01 05:00:00", 0, 1)]
    df = spark.createDataFrame(rows, "clip string, ts string, frame int, rank int").withColumn("ts", F.col("ts").cast("timestamp"))
    df.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in")
    q = views.first_hits(stream, "clip", "ts", "frame", F.col("rank") == 1).writeStream.format("memory").queryName("hits").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert {(r["clip"], r["first_frame"]) for r in spark.table("hits").collect()} == {("a", 1), ("b", None), ("z", 0)}


KEYED = "k string, v int, o int"


def table(spark, path, batch=None):
    return sorted((r["k"], r["v"], r["o"]) for r in keyed.read_keyed(spark, path, batch).collect())


def test_upsert_stream_keeps_the_last_row(spark, tmp_path):
    for rows in [[("a", 1, 0), ("a", 2, 1)], [("a", 3, 2), ("b", 9, 0)], [("a", 0, 1), (None, 5, 5)]]:
        spark.createDataFrame(rows, KEYED).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(KEYED).parquet(f"{tmp_path}/in")
        keyed.upsert_stream(stream, f"{tmp_path}/t", f"{tmp_path}/ck", ["k"], "o").awaitTermination(120)
    assert keyed.read_keyed(spark, f"{tmp_path}/t", 1).orderBy("k").collect()[0]["v"] == 3
    assert {(r["k"], r["v"]) for r in keyed.read_keyed(spark, f"{tmp_path}/t").collect()} == {("a", 3), ("b", 9), (None, 5)}


def test_batches_replayed_broken_off_and_split_otherwise_give_one_state(spark, tmp_path):
    draw = random.Random(2)
    rows = [(f"k{draw.randrange(60)}", i, i if i % 9 else 0) for i in range(300)]
    want = {}
    for k, v, o in sorted(rows, key=lambda r: (r[2], r[1])):
        want[k] = (k, v, o)
    parts = [rows[:120], rows[120:130], rows[130:]]
    path = f"{tmp_path}/t"
    for i, part in enumerate(parts):
        batch = spark.createDataFrame(part, KEYED)
        if i == 1:  # a writer that dies before its manifest is in place
            commit, keyed.manifests.commit = keyed.manifests.commit, lambda *a: False
            try:
                assert keyed.upsert_batch(batch, i, path, ["k"], "o", 16) == []
            finally:
                keyed.manifests.commit = commit
            before = table(spark, path)
            assert before == table(spark, path, 0)
        touched = keyed.upsert_batch(batch, i, path, ["k"], "o", 16)
        assert touched and (i != 1 or len(touched) <= 10)  # ten rows rewrite ten buckets at most
    assert keyed.upsert_batch(spark.createDataFrame(parts[0], KEYED), 0, path, ["k"], "o") == [] == keyed.upsert_batch(spark.createDataFrame(parts[2], KEYED), 2, path, ["k"], "o")
    got = table(spark, path)
    assert [(k, o) for k, _, o in got] == sorted((k, o) for k, _, o in want.values())
    assert [v for _, v, o in got if o] == [v for _, v, o in sorted(want.values()) if o]
    gone = keyed.vacuum(spark, path, keep=1)
    assert gone and table(spark, path) == got
    with pytest.raises(FileNotFoundError):
        keyed.read_keyed(spark, path, 1)


def test_breaker_of_a_stream_in_any_batches(spark, tmp_path):
    """The run's state over batches equals the batch operator over all rows, however they are split."""
    from larkspur.operators import ranking

    draw = random.Random(5)
    rows = [(draw.choice("abcd"), i, draw.choice(["error", "error", "ok", "hit"] if i > 40 else ["error", "ok"]), float(draw.randrange(4))) for i in range(120)]
    schema = "p string, i int, kind string, cost double"
    error, hit = F.col("kind") == "error", F.col("kind") == "hit"
    every = spark.createDataFrame(rows, schema)
    want = {(r["p"], r["i"]): (r["errors_before"], r["hits_before"], r["attempted"]) for r in ranking.circuit_breaker(every, "p", "i", error, hit, 5).collect()}
    for k, v in breaker.STORE.items():
        spark.conf.set(k, v)
    try:
        got = {}
        for a, z in [(0, 7), (7, 70), (70, 120)]:
            spark.createDataFrame(rows[a:z], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
            out = breaker.attempts(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), "p", "i", error, hit, F.col("cost"))
            out.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start().awaitTermination(200)
        got = {(r["p"], r["i"]): (r["errors_before"], r["hits_before"], r["attempted"]) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    finally:
        for k in breaker.STORE:
            spark.conf.unset(k)
    assert got == want and any(not x[2] for x in want.values())


def test_budget_of_a_stream(spark, tmp_path):
    rows = [("a", i, "ok", 3.0) for i in range(6)] + [("b", 9, "ok", 0.0)]
    schema = "p string, i int, kind string, cost double"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in")
    for k, v in breaker.STORE.items():
        spark.conf.set(k, v)
    try:
        out = breaker.attempts(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), "p", "i", F.lit(False), F.lit(False), F.col("cost"), budget=7)
        out.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start().awaitTermination(200)
    finally:
        for k in breaker.STORE:
            spark.conf.unset(k)
    got = {(r["p"], r["i"]): (r["spent_before"], r["attempted"]) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert [got["a", i] for i in range(6)] == [(0, True), (3, True), (6, True), (9, False), (9, False), (9, False)] and got["b", 9] == (0, True)


def test_a_silent_provider_is_forgotten(spark, tmp_path):
    """Three errors stop a; the watermark that b moves on forgets it, so it is attempted again."""
    schema = "p string, i int, t timestamp"
    for k, v in breaker.STORE.items():
        spark.conf.set(k, v)
    try:
        for rows in [[("a", i, f"2026-01-01 00:00:0{i}") for i in range(4)], [("b", 0, "2026-01-01 03:00:00")], [("b", 1, "2026-01-01 03:00:01")], [("a", 9, "2026-01-01 04:00:00")]]:
            df = spark.createDataFrame(rows, "p string, i int, t string").withColumn("t", F.col("t").cast("timestamp"))
            df.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
            out = breaker.attempts(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), "p", "i", F.lit(True), F.lit(False), threshold=3, event_time="t", idle_seconds=60)
            out.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start().awaitTermination(100)
    finally:
        for k in breaker.STORE:
            spark.conf.unset(k)
    got = {(r["p"], r["i"]): (r["errors_before"], r["attempted"]) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {("a", 0): (0, True), ("a", 1): (1, True), ("a", 2): (2, True), ("a", 3): (3, False), ("b", 0): (0, True), ("b", 1): (1, True), ("a", 9): (0, True)}
