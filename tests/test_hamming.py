import random

import pytest

from larkspur.operators import hamming


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def apart(a, b):
    return ((a ^ b) & ((1 << 64) - 1)).bit_count()


def walk(draw, n, flips):
    """Hashes of a slow film: each differs from the one before in a few bits, so one range depends on the next."""
    h, out = draw.getrandbits(64), []
    for _ in range(n):
        for _ in range(draw.randrange(flips + 1)):
            h ^= 1 << draw.randrange(64)
        out.append(signed(h))
    return out


def loop(rows, distance, most=0):
    out = []
    for v in {r[0] for r in rows}:
        kept = []
        for o, h in sorted((o, h) for g, o, h in rows if g == v and h is not None):
            if all(apart(h, x) > distance for _, x in kept) and not (most and len(kept) >= most):
                kept.append((o, h))
        out += [(v, o, h) for o, h in kept]
    return sorted(out)


@pytest.mark.parametrize(("distance", "flips", "size", "most"), [(3, 2, 40, 0), (6, 1, 25, 7), (24, 6, 30, 0), (0, 1, 4096, 0)])
def test_greedy_equals_the_loop(spark, distance, flips, size, most):
    """Chains that cross many ranges, copies, two rows at one place, null hashes, with bands and without."""
    draw = random.Random(distance)
    rows = [(v, i, h) for v, n in (("a", 180), ("b", 45)) for i, h in enumerate(walk(draw, n, flips))]
    rows += [("a", 200 + i, h) for i, (_, _, h) in enumerate(rows[:30])] + [("a", 5, rows[60][2]), ("c", 1, None), ("b", 9, None)]
    df = spark.createDataFrame(rows, "v string, i int, h long")
    assert sorted(tuple(r) for r in hamming.greedy_dedupe(df, "v", "i", "h", distance, most, size).collect()) == loop(rows, distance, most)


def test_nothing_to_dedupe(spark):
    assert hamming.greedy_dedupe(spark.createDataFrame([], "v string, i int, h long"), "v", "i", "h", 3).count() == 0


@pytest.mark.parametrize("distance", [0, 3, 11, 30])
def test_join_equals_brute_force(spark, distance):
    draw = random.Random(distance)
    some = walk(draw, 60, 4)
    left, right = [(draw.choice("ab"), i, h) for i, h in enumerate(some)], [(draw.choice("ab"), i, h) for i, h in enumerate(some[::2] + [-1, 0, signed(1 << 63)])]
    left += [("a", 98, None), (None, 99, 0), ("a", 97, -1)]
    got = hamming.hamming_join(spark.createDataFrame(left, "g string, i int, a long"), spark.createDataFrame(right, "g string, j int, b long"), "g", "a", "b", distance)
    want = sorted((i, j, apart(a, b)) for g, i, a in left for k, j, b in right if g == k and a is not None and apart(a, b) <= distance)
    assert sorted((r["i"], r["j"], r["distance"]) for r in got.collect()) == want


@pytest.mark.parametrize("distance", [0, 3, 30])
def test_classes_equal_brute_force(spark, distance):
    """Every row has its class and links, copies count, and the pairs of classes with their rows are all pairs of rows."""
    draw = random.Random(distance)
    some = walk(draw, 40, 4)
    rows = [(draw.choice("ab"), i, h) for i, h in enumerate(some + some[:15] + [some[0]] * 5)] + [("a", 98, None), (None, 99, 0)]
    members, pairs = hamming.hamming_classes(spark.createDataFrame(rows, "g string, i int, h long"), "g", "i", "h", distance)
    whole = [r for r in rows if r[0] is not None and r[2] is not None]
    near = {(i, j) for g, i, a in whole for k, j, b in whole if i < j and g == k and apart(a, b) <= distance}
    first = {i: min(j for k, j, b in whole if (k, b) == (g, h)) for g, i, h in whole}
    want = sorted((i, first.get(i), sum(i in p for p in near)) for _, i, _ in rows)
    assert sorted((r["i"], r["class_key"], r["links"]) for r in members.collect()) == want
    got = {(r["left_key"], r["right_key"]): (r["left_rows"], r["right_rows"]) for r in pairs.collect()}
    copies = sum(n * (n - 1) // 2 for n in (list(first.values()).count(c) for c in set(first.values())))
    assert sum(a * b for a, b in got.values()) + copies == len(near)
    assert set(got) == {tuple(sorted((first[i], first[j]))) for i, j in near if first[i] != first[j]}


def test_copies_are_not_expanded_into_pairs(spark):
    """50,000 copies have 1.25 billion pairs; they are one class."""
    df = spark.range(50_000).selectExpr("'a' AS g", "id AS i", "if(id < 2, 1L, 0L) AS h")
    members, pairs = hamming.hamming_classes(df, "g", "i", "h", 1)
    assert [tuple(r) for r in members.groupBy("class_key", "links").count().orderBy("class_key").collect()] == [(0, 49_999, 2), (2, 49_999, 49_998)]
    assert [tuple(r) for r in pairs.collect()] == [("a", 0, 2, 2, 49_998, 1)]


def test_a_long_film_is_decided_in_few_rounds(spark, monkeypatch):
    """Frames without near ones in other ranges are decided in the first round, whatever the number of ranges."""
    draw, count = random.Random(3), [0]
    rows = [("v", i, signed(draw.getrandbits(64))) for i in range(400)]
    df = spark.createDataFrame(rows, "v string, i int, h long")
    kept = hamming.written
    monkeypatch.setattr(hamming, "written", lambda x: (count.__setitem__(0, count[0] + 1), kept(x))[1])
    assert hamming.greedy_dedupe(df, "v", "i", "h", 6, size=50).count() == 400 and count[0] == 4
