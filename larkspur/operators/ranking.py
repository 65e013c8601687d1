"""Rankings: stratified samples, budgets, circuit breaker, retention, splits.

A global running total is computed over per-row costs after the rows have been reduced to what it needs (sets, not cards);
where rows are many, `running_total` sums ranges first, so no task holds all rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .order_statistics import hashed_rank


def running_total(df: DataFrame, order: Sequence[str], value: Column, name: str, groups: int = 128) -> DataFrame:
    """`name`: the sum of `value` over all earlier rows by `order` (0 for the first), without a single-partition window.

    Rows are dealt to ranges by bounds that are read once, from a sample by hash of about 16 rows a range, and then stand in
    the plan as values; so both uses of a range (its sum, the running sum within it) mean the same rows. Each range is
    summed, the sums (one a range) are accumulated, and the offset is added to the running sum within the range. `order`
    must be total; nulls come first.
    """
    key = F.struct(*[F.col(c) for c in order])
    rows = df.count()
    sampled = df.select(*order).where(F.pmod(F.xxhash64(*order), F.lit(max(1, rows // (16 * groups)))) == 0).distinct().orderBy(*order).collect()
    bounds = sampled[:: max(1, len(sampled) // groups)][1:]
    dealt = df.withColumn("__value", value)
    if not bounds:
        dealt = dealt.withColumn("__part", F.lit(0))
    else:
        types = df.select(*order).schema
        held = df.sparkSession.createDataFrame(bounds, types).agg(F.sort_array(F.collect_list(F.struct(*order))).alias("__bounds"))
        dealt = dealt.crossJoin(F.broadcast(held)).withColumn("__part", F.size(F.filter("__bounds", lambda b: b <= key))).drop("__bounds")  # one row on that side
    sums = dealt.groupBy("__part").agg(F.sum("__value").alias("__sum"))
    before = sums.withColumn("__offset", F.coalesce(F.sum("__sum").over(W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).select("__part", "__offset")
    inside = F.coalesce(F.sum("__value").over(W.partitionBy("__part").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    out = dealt.withColumn("__inside", inside).join(F.broadcast(before), "__part")
    return out.withColumn(name, F.col("__inside") + F.col("__offset")).drop("__part", "__value", "__inside", "__offset")


def round_robin_sample(df: DataFrame, stratum: str, order: Sequence[Column], size: int, pinned: Column | None = None, pinned_order: Column | None = None, strata: Sequence[str] | None = None, cap_pinned: bool = True) -> DataFrame:
    """`size` rows with sample_index from 1: pinned ones first, then one of each stratum in turn.

    strata: their fixed order; rows of others are never taken unless pinned. None: strata in their own order. With
    cap_pinned false all pinned rows stay even beyond `size`. `order` must be total within a stratum.
    """
    pin = F.lit(False) if pinned is None else F.coalesce(pinned, F.lit(False))
    rank = F.col(stratum) if strata is None else F.array_position(F.array(*map(F.lit, strata)), F.col(stratum))
    rows = df.withColumns({"__pin": pin, "__rank": rank})
    if strata is not None:
        rows = rows.where(F.col("__pin") | (F.col("__rank") > 0))
    # no stratum gives more than `size` rows: the window keeps that many a stratum and no more reach the last sort
    turn = F.row_number().over(W.partitionBy("__pin", stratum).orderBy(*order))
    rows = rows.withColumn("__turn", turn).where(F.col("__pin") | (F.col("__turn") <= size))
    first = F.when(F.col("__pin"), 0).otherwise(1)
    lead = F.when(F.col("__pin"), F.lit(0) if pinned_order is None else pinned_order).otherwise(F.col("__turn"))
    key = [first, lead, F.when(F.col("__pin"), F.lit(None)).otherwise(F.col("__rank")), *order]
    ranked = rows.orderBy(*key)
    if cap_pinned:
        ranked = ranked.limit(size)
    numbered = ranked.withColumn("sample_index", F.row_number().over(W.orderBy(*key)))
    if not cap_pinned:
        pins = F.count_if("__pin").over(W.partitionBy())
        numbered = numbered.withColumn("__pins", pins).where(F.col("sample_index") <= F.greatest(F.lit(size), F.col("__pins"))).drop("__pins")
    return numbered.drop("__pin", "__rank", "__turn")


def within_budget(df: DataFrame, order: Sequence[str], cost: Column, budget: int | None) -> DataFrame:
    """Rows begun while some budget was left: overspending by the last is allowed, free rows cost 0. None: no limit."""
    spent = running_total(df, order, cost, "spent_before")
    return spent.withColumn("taken", F.lit(True) if budget is None else F.col("spent_before") < budget)


def first_budgeted(df: DataFrame, order: Sequence[str], budget: int | None) -> DataFrame:
    """The first `budget` rows by `order`; None: all."""
    return df if budget is None else df.orderBy(*order).limit(budget)


def circuit_breaker(df: DataFrame, provider: str, order: str, error: Column, hit: Column, threshold: int = 5) -> DataFrame:
    """attempted: whether a provider was still enabled before this row; it stops after `threshold` errors without a hit."""
    before = W.partitionBy(provider).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    errors, hits = F.coalesce(F.count_if(error).over(before), F.lit(0)), F.coalesce(F.count_if(hit).over(before), F.lit(0))
    state = df.withColumns({"errors_before": errors, "hits_before": hits})
    # once open it stays open: rows after the stop are not attempted, so their hits do not count
    opened = (F.col("errors_before") >= threshold) & (F.col("hits_before") == 0)
    stop = F.min(F.when(opened, F.col(order))).over(W.partitionBy(provider))
    return state.withColumn("attempted", stop.isNull() | (F.col(order) < stop))


def breaker_attempts(df: DataFrame, provider: str, order: str, error: Column, hit: Column, threshold: int = 5) -> DataFrame:
    """`attempted` alone, as circuit_breaker tells it, without ordering a provider's rows: a provider stops after its
    `threshold`-th error if that comes before its first hit. Both are aggregates, so one provider may hold all rows."""
    marked = df.select(F.col(provider).alias("__p"), F.col(order).alias("__o"), error.alias("__e"), hit.alias("__h"))
    errors = limit_per_group(marked.where("__e"), ["__p"], [F.col("__o")], threshold).groupBy("__p").agg(F.count("*").alias("n"), F.max("__o").alias("__last"))
    hits = marked.where("__h").groupBy("__p").agg(F.min("__o").alias("__first"))
    stops = errors.where(F.col("n") >= threshold).join(hits, "__p", "left").where("__first is null or __first > __last").select("__p", "__last")
    out = df.join(stops, F.col(provider).eqNullSafe(F.col("__p")), "left")
    return out.withColumn("attempted", F.col("__last").isNull() | (F.col(order) <= F.col("__last"))).drop("__p", "__last")


def keep_newest(df: DataFrame, keep: int, order: Sequence[Column], by: Sequence[str] = ()) -> DataFrame:
    """stale: whether a row is beyond the first `keep` by `order` within `by`.

    Without `by` all rows meet in one task: that is for listings of releases, of which there are dozens.
    """
    return df.withColumn("stale", F.row_number().over(W.partitionBy(*by).orderBy(*order)) > keep)


def hash_split(df: DataFrame, stratum: str, key: Column, fraction: float) -> DataFrame:
    """is_validation: the first max(1, floor(n * fraction)) rows of each stratum by `key`, a hexadecimal hash that names the row."""
    sizes = df.groupBy(F.col(stratum).alias("__stratum")).agg(F.greatest(F.lit(1), F.floor(F.count("*") * fraction)).alias("__most"))
    ranked = hashed_rank(df, [stratum], key, "__rank").join(sizes, F.col(stratum).eqNullSafe(F.col("__stratum")))
    return ranked.withColumn("is_validation", F.col("__rank") <= F.col("__most")).drop("__rank", "__most", "__stratum")


def random_sample(df: DataFrame, size: int, key: Column, weight: Column | None = None) -> DataFrame:
    """`size` rows without replacement (all, if there are no more), the same at every run; `key`: a hexadecimal hash with the seed in it.

    Each row has a priority of its own, and the least ones win: a task keeps `size` of its rows at most, and what tasks keep
    merges in any order. With `weight`, priorities are exponential with that rate, which draws in proportion to what is left;
    rows of null weight or one not above 0 are never drawn. Ties go to the smaller key.
    """
    rows = df.withColumn("__key", key)
    if weight is None:
        return rows.orderBy("__key").limit(size).drop("__key")
    even = (F.conv(F.substring("__key", 1, 13), 16, 10).cast("double") + 0.5) / 2**52
    rows = rows.withColumns({"__weight": weight.cast("double"), "__even": even}).where("__weight > 0")
    return rows.withColumn("__due", -F.log("__even") / F.col("__weight")).orderBy("__due", "__key").limit(size).drop("__key", "__weight", "__even", "__due")


def limit_per_group(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """At most n rows of each group; Spark's group limit cuts before the shuffle."""
    return df.withColumn("__n", F.row_number().over(W.partitionBy(*by).orderBy(*order))).where(F.col("__n") <= n).drop("__n")


def promote_primary(rows: DataFrame, key: str, priority: Sequence[Column], flag: str = "is_primary") -> DataFrame:
    """Exactly one primary row a key: the first by (already primary, priority)."""
    rank = F.row_number().over(W.partitionBy(key).orderBy(F.desc(flag), *priority))
    return rows.withColumn(flag, (rank == 1).cast("int"))


def hard_and_singletons(df: DataFrame, group: str, key: Column, size: int, ratio: float) -> DataFrame:
    """A selection in three tiers with selection_index from 0: one of each of the first int(size * ratio) groups of several
    rows, then singletons, then the other groups' rows; `key` is a hash that orders rows and groups."""
    rows = df.withColumns({"__n": F.count("*").over(W.partitionBy(group)), "__key": key})
    rows = rows.withColumns({"__in": F.row_number().over(W.partitionBy(group).orderBy("__key")), "__first": F.min("__key").over(W.partitionBy(group))})
    target = int(size * ratio)
    heads = rows.where("__n > 1 and __in = 1").orderBy("__first").limit(target).withColumn("__tier", F.lit(0))
    used = heads.select(group)
    alone = rows.where("__n = 1").orderBy("__key").limit(size).withColumn("__tier", F.lit(1))
    rest = rows.where("__n > 1").join(used, group, "left_anti").orderBy("__key").limit(size).withColumn("__tier", F.lit(2))
    out = heads.unionByName(alone).unionByName(rest).orderBy("__tier", "__key").limit(size)
    out = out.withColumn("selection_index", F.row_number().over(W.orderBy("__tier", "__key")) - 1)
    return out.withColumnRenamed("__n", "group_size").drop("__key", "__in", "__first", "__tier")


def group_preserving_subset(df: DataFrame, group: str, key: Column, limit: int) -> DataFrame:
    """`limit` rows: several of each of the first limit / 4 groups of several rows, then singletons, then other groups."""
    rows = df.withColumns({"__n": F.count("*").over(W.partitionBy(group)), "__key": key})
    rows = rows.withColumns({"__in": F.row_number().over(W.partitionBy(group).orderBy("__key")), "__first": F.min("__key").over(W.partitionBy(group))})
    heads = rows.where("__n > 1 and __in = 1").orderBy("__first").limit(max(0, limit // 4)).select(group)
    chosen = heads.count()
    take = max(2, limit // max(1, chosen * 4))
    hard = rows.join(heads, group, "left_semi").where(F.col("__in") <= take).withColumn("__tier", F.lit(0))
    alone = rows.where("__n = 1").orderBy("__key").limit(limit).withColumn("__tier", F.lit(1))
    rest = rows.where("__n > 1").join(heads, group, "left_anti").orderBy("__key").limit(limit).withColumn("__tier", F.lit(2))
    out = hard.unionByName(alone).unionByName(rest).orderBy("__tier", F.when(F.col("__tier") == 0, F.col("__first")), "__key").limit(limit)
    return out.drop("__n", "__key", "__in", "__first", "__tier")
