import hashlib
import random
import statistics

import pytest
from pyspark.sql import functions as F

from larkspur.operators import order_statistics


@pytest.mark.parametrize("bins", [2, 1024])
def test_median_equals_the_library(spark, bins):
    """Odd and even groups, one value, copies, a null group, values far apart, nulls and non-finite values."""
    draw = random.Random(1)
    groups = {"a": [draw.gauss(0, 1) for _ in range(101)], "b": [float(draw.randrange(5)) for _ in range(40)], "c": [7.5], None: [1.5e308, -1.5e308, 3.0, 4.0], "d": [1.0, 1.0 + 2**-52]}
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("a", None), ("b", float("nan")), ("c", float("inf")), ("e", None)]
    got = {r["g"]: r["m"] for r in order_statistics.exact_median(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", "m", bins).collect()}
    assert got.keys() == groups.keys() and all(got[g] == pytest.approx(statistics.median(vs), abs=1e-12) for g, vs in groups.items())


def test_median_of_all_and_of_nothing(spark):
    df = spark.createDataFrame([(float(i),) for i in range(10)], "v double")
    assert [r["m"] for r in order_statistics.exact_median(df, [], "v", "m").collect()] == [4.5]
    assert order_statistics.exact_median(df.limit(0), [], "v", "m").count() == 0


@pytest.mark.parametrize("digits", [0, 1, 3])
def test_rank_equals_a_sort(spark, digits):
    rows = [(i, "hot" if i % 10 else None) for i in range(200)]
    df = spark.createDataFrame(rows, "i int, g string")
    got = {r["i"]: r["n"] for r in order_statistics.hashed_rank(df, ["g"], F.md5(F.col("i").cast("string")), "n", digits).collect()}
    for g in ("hot", None):
        order = sorted((i for i, x in rows if x == g), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())
        assert [got[i] for i in order] == list(range(1, len(order) + 1))
