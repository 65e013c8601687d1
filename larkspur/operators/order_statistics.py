"""Medians and ranks of groups of any size, by histograms and offsets: no task ever sorts a whole group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..tables import written

BINS = 1_024


def exact_median(df: DataFrame, by: Sequence[str], value: str, name: str, bins: int = BINS) -> DataFrame:
    """`by` and the median of the finite values of each group (the mean of the middle two of an even number).

    Each round counts the values between the bounds of a wanted place in `bins` equal ranges, pre-aggregated in every task,
    and goes on within the range that holds it, until its bounds are one value. Null and non-finite values do not count; a
    group that has no other gives no row.
    """
    keys = [f"g{i}" for i in range(len(by))]
    finite = F.col("v").isNotNull() & ~F.isnan("v") & (F.abs("v") != float("inf"))
    held = written(df.select(*[F.col(b).alias(k) for b, k in zip(by, keys, strict=True)], F.col(value).cast("double").alias("v")).where(finite))
    middle = F.explode(F.array(F.struct(F.lit(0).alias("which"), F.floor((F.col("n") - 1) / 2).alias("k")), F.struct(F.lit(1).alias("which"), F.floor(F.col("n") / 2).alias("k"))))
    found = held.groupBy(*keys).agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).withColumn("p", middle).where("n > 0").select(*keys, "p.which", "p.k", "lo", "hi")
    found = written(found)
    while not (open_ := found.where("lo < hi")).isEmpty():
        wanted = open_.toDF(*[f"t_{c}" for c in open_.columns])
        same = F.lit(True)
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(f"t_{k}"))
        inside = held.join(wanted, same & F.col("v").between(F.col("t_lo"), F.col("t_hi")))
        # halves first: the width of two large bounds may be no double
        place = F.floor((F.col("v") / 2 - F.col("t_lo") / 2) / (F.col("t_hi") / 2 - F.col("t_lo") / 2) * bins)
        counted = inside.groupBy(*keys, "t_which", "t_k", F.least(F.lit(bins - 1), place).alias("bin")).agg(F.count("*").alias("c"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        upto = F.sum("c").over(W.partitionBy(*keys, "t_which").orderBy("bin"))
        narrowed = counted.withColumn("upto", upto).where("t_k < upto and t_k >= upto - c").select(*keys, F.col("t_which").alias("which"), (F.col("t_k") - F.col("upto") + F.col("c")).alias("k"), "lo", "hi")
        found = written(found.where("lo = hi").unionByName(narrowed))
    halves = found.groupBy(*keys).agg(F.sum(F.col("lo") / 2).alias(name)).where(F.col(name).isNotNull())
    return halves.withColumnsRenamed(dict(zip(keys, by, strict=True)))


def hashed_rank(df: DataFrame, by: Sequence[str], key: Column, name: str, digits: int = 3) -> DataFrame:
    """`name`: the place from 1 of each row in its group by `key`, a hash in hexadecimal digits.

    Rows are numbered among those that share the first `digits` of their key, after the rows of all smaller ones; so a task
    has one 16 ** digits-th of a group, and the offsets are as few rows a group.
    """
    rows = df.withColumns({"__key": key, "__part": F.substring(key, 1, digits)})
    sums = rows.groupBy(*by, "__part").agg(F.count("*").alias("__n"))
    ahead = sums.withColumn("__ahead", F.coalesce(F.sum("__n").over(W.partitionBy(*by).orderBy("__part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("__n")
    ahead = ahead.toDF(*[f"__a{i}" for i in range(len(by))], "__p", "__ahead")
    same = F.col("__part") == F.col("__p")
    for i, b in enumerate(by):
        same = same & F.col(b).eqNullSafe(F.col(f"__a{i}"))
    numbered = rows.withColumn("__in", F.row_number().over(W.partitionBy(*by, "__part").orderBy("__key")))
    return numbered.join(ahead, same).withColumn(name, F.col("__in") + F.col("__ahead")).drop("__key", "__part", "__in", "__ahead", "__p", *[f"__a{i}" for i in range(len(by))])
