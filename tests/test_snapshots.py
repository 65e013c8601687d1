import hashlib
import random
from collections import defaultdict

from pyspark.sql import functions as F

from larkspur.operators import snapshots as S

SCHEMA = "k long, market string, line string"


def by_hand(rows, depth):
    """The digests of all nodes, by hashlib."""
    leaves = defaultdict(list)
    for k, market, line in rows:
        name = hashlib.md5(f"{'' if k is None else k}|{market or ''}".encode()).hexdigest()[:depth]
        leaves[name].append(hashlib.sha256((line or "").encode()).hexdigest())
    nodes = {n: hashlib.sha256("|".join(map(str, [len(v), *[sum(int(h[7 * i : 7 * i + 7], 16) for h in v) for i in range(6)]])).encode()).hexdigest() for n, v in leaves.items()}
    out = dict(nodes)
    for level in range(depth - 1, -1, -1):
        up = defaultdict(list)
        for n, h in nodes.items():
            up[n[:level]].append(f"{n}:{h}")
        nodes = {n: hashlib.sha256("\n".join(sorted(v)).encode()).hexdigest() for n, v in up.items()}
        out |= nodes
    return out


def some(n, seed=1):
    draw = random.Random(seed)
    return [(i, draw.choice(["us", "eu", None]), f"line {i} {draw.random()}") for i in range(n)]


def test_tree_equals_hashlib_whatever_the_order(spark):
    rows = [*some(900), (None, None, None), (5, "us", "twice"), (5, "us", "twice")] + [(7, "hot", f"h{i}") for i in range(600)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = S.ranges(df, ["k", "market"], F.col("line"), range_rows=10)
    assert S.depth_of(found) == S.depth_for(len(rows), 10) == 2
    want = by_hand(rows, 2)
    assert {r["range"]: r["digest"] for r in S.tree(found).collect()} == want
    assert {r["range"]: r["digest"] for r in S.tree(S.ranges(df.repartition(7, "line"), ["k", "market"], F.col("line"), depth=2)).collect()} == want
    assert [r["rows"] for r in S.tree(found).where("level = 0").collect()] == [len(rows)]
    flat = {r["range"]: r["digest"] for r in S.tree(S.flatter(found, 1)).collect()}
    assert flat == by_hand(rows, 1)


def test_depth_follows_the_rows():
    assert [S.depth_for(n) for n in (0, 1, 4096, 16 * 4096, 16 * 4096 + 1, 10**10)] == [1, 1, 1, 1, 2, 6]


def test_differing_ranges_and_changed_keys(spark):
    """Trees of different depth; a repeated line, a null key, two lines that change places."""
    old = [*some(500), (None, None, "null key"), (1000, "us", "a"), (1001, "us", "b"), (1002, "eu", "same"), (1003, "eu", "copy")]
    new = [r for r in old if r[0] not in (11, 1000, 1001, 1003, None)] + [(1000, "us", "b"), (1001, "us", "a"), (1003, "eu", "copy"), (1003, "eu", "copy"), (None, None, "other"), *[(2000 + i, "us", "new") for i in range(3)]]
    a, b = spark.createDataFrame(old, SCHEMA), spark.createDataFrame(new, SCHEMA)
    key, line = ["k", "market"], F.col("line")
    gone = next(r[1] for r in old if r[0] == 11)
    want = {(11, gone, "removed"), (1000, "us", "changed"), (1001, "us", "changed"), (1003, "eu", "changed"), (None, None, "changed")} | {(2000 + i, "us", "added") for i in range(3)}
    for left, right in [(3, 3), (3, 2), (1, 2)]:
        ra, rb = S.ranges(a, key, line, depth=left), S.ranges(b, key, line, depth=right)
        found = S.differing(ra, rb)
        names = {r["range"] for r in found.collect()}
        hashed = {hashlib.md5(f"{'' if k is None else k}|{m or ''}".encode()).hexdigest()[: min(left, right)] for k, m, _ in want}
        assert names == hashed
        got = [tuple(r) for r in S.changes(a, b, key, line, found).collect()]
        assert set(got) == want and len(got) == len(want)


def test_equal_and_empty_tables(spark):
    a = spark.createDataFrame(some(40), SCHEMA)
    none = a.limit(0)
    key, line = ["k", "market"], F.col("line")
    ra, rn = S.ranges(a, key, line), S.ranges(none, key, line)
    assert S.differing(ra, ra).count() == 0 and S.changes(a, a, key, line, S.differing(ra, ra)).count() == 0
    assert S.tree(rn).count() == 0 and S.differing(rn, rn).count() == 0
    assert S.differing(rn, ra).agg(F.sum("left_rows"), F.sum("right_rows")).first() == (0, 40)
    assert {r["change"] for r in S.changes(none, a, key, line, S.differing(rn, ra)).collect()} == {"added"}


def test_columns_with_clashing_names(spark):
    a = spark.createDataFrame([(1, "x", 2, 3)], "k long, line string, rows long, s0 long")
    assert S.ranges(a, ["k"], F.col("line")).count() == 1
    b = a.withColumn("line", F.lit("y"))
    found = S.differing(S.ranges(a, ["k"], F.col("line")), S.ranges(b, ["k"], F.col("line")))
    assert [tuple(r) for r in S.changes(a, b, ["k"], F.col("line"), found).collect()] == [(1, "changed")]
