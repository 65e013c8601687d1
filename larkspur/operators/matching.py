"""Joins that pick one row: ordered alias lookups, indexes with first or last wins, anti joins, reconciliation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def pick_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column], columns: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the smallest by `order`, of equal ones the smallest by its columns, so that arrival decides nothing.

    An aggregate, so a key with many rows is combined before the shuffle.
    """
    names = [c for c in (columns or df.columns) if c not in keys]
    kinds = dict(df.dtypes)
    last = [F.col(c) for c in names if not any(k in kinds[c] for k in ("map<", "variant"))]  # those have no order
    rank = F.struct(*[o.alias(f"o{i}") for i, o in enumerate([*order, *last])])
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*[F.col(c) for c in names]), rank).alias("__row"))
    return best.select(*keys, *[F.col("__row")[c].alias(c) for c in names])


def first_wins_index(df: DataFrame, keys: Sequence[str], order: str, priced: Column | None = None) -> DataFrame:
    """One row per non-blank key: the first by `order`; a row with a usable price goes before one without."""
    usable = df
    for k in keys:
        usable = usable.where(F.col(k).isNotNull() & (F.trim(F.col(k).cast("string")) != ""))
    rank = [F.col(order)] if priced is None else [F.when(priced, 0).otherwise(1), F.col(order)]
    return pick_first(usable, keys, rank)


def last_wins_index(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """One row per key: the last by `order`."""
    names = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in names]), F.col(order)).alias("__row"))
    return best.select(*keys, *[F.col("__row")[c].alias(c) for c in names])


def alias_join(left: DataFrame, left_id: str, candidates: Column, index: DataFrame, index_key: Sequence[str], payload: Sequence[str]) -> DataFrame:
    """For each left row the index row of its first candidate key that exists: left_id, match_pos (from 0), `payload`.

    `candidates`: an array of structs with `index_key` fields. Rows without a match are not returned; join them back left.
    """
    tried = left.select(F.col(left_id).alias("__id"), F.posexplode(candidates).alias("match_pos", "__key"))
    side = index.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(index_key)], F.struct(*payload).alias("__payload"))
    same = [F.col("__key")[k] == F.col(f"__k{i}") for i, k in enumerate(index_key)]
    on = same[0]
    for c in same[1:]:
        on = on & c
    hit = tried.join(side, on).groupBy("__id").agg(F.min("match_pos").alias("match_pos"), F.min_by("__payload", "match_pos").alias("__payload"))
    return hit.select(F.col("__id").alias(left_id), "match_pos", *[F.col("__payload")[p].alias(p) for p in payload])


def map_names(names: DataFrame, provider: DataFrame, overrides: DataFrame | None = None, slugify: Column | None = None) -> DataFrame:
    """key -> slug: the provider's own name (last row wins), else the override, else `slugify` of the name; null if none.

    names: key, name (the first by `ord` counts). provider: slug, name, ord. overrides: key, slug.
    """
    own = pick_first(names.where("trim(key) <> '' and trim(name) <> ''"), ["key"], [F.col("ord")], ["key", "name"])
    live = provider.select(F.trim("slug").alias("live"), F.lower(F.trim("name")).alias("lowered"), "ord").where("live <> '' and lowered <> ''")
    live = live.groupBy("lowered").agg(F.max_by("live", "ord").alias("live"))
    out = own.join(live, F.lower(F.col("name")) == F.col("lowered"), "left")
    choice = [F.col("live")]
    if overrides is not None:
        kept = overrides.select(F.trim("key").alias("__key"), F.trim("slug").alias("__over")).where("__key <> '' and __over <> ''")
        out = out.join(kept, F.col("key") == F.col("__key"), "left")
        choice.append(F.col("__over"))
    if slugify is not None:
        choice.append(F.nullif(slugify, F.lit("")))
    return out.select("key", F.coalesce(*choice).alias("slug"))


def search_match(candidates: DataFrame, key: str, matches: Column, position: str, allow_unmatched: bool = False) -> DataFrame:
    """One candidate per key: the first that matches; with `allow_unmatched` the first at all where none does."""
    kept = candidates if allow_unmatched else candidates.where(matches)
    return pick_first(kept, [key], [F.when(matches, 0).otherwise(1), F.col(position)])


def not_in(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of `left` without a partner; a null key has none."""
    return left.join(right.select(*on), [*on], "left_anti")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str, limit: int | None = 10) -> DataFrame:
    """Distinct keys of `child` that `parent` lacks, in order; the first `limit`."""
    gone = child.join(parent.select(F.col(parent_key).alias("__p")).distinct(), F.col(child_key) == F.col("__p"), "left_anti").select(child_key).where(F.col(child_key).isNotNull()).distinct().orderBy(child_key)
    return gone if limit is None else gone.limit(limit)


def collected_sources(left: DataFrame, right: DataFrame, left_key: str, right_key: str, source: str) -> DataFrame:
    """Every left row with source_names: the sorted distinct sources of its right rows, empty where it has none."""
    names = right.groupBy(F.col(right_key).alias("__r")).agg(F.sort_array(F.collect_set(source)).alias("__names"))
    out = left.join(names, F.col(left_key) == F.col("__r"), "left")
    return out.withColumn("source_names", F.coalesce("__names", F.array().cast("array<string>"))).drop("__r", "__names")


def gap_groups(left: DataFrame, only: str) -> DataFrame:
    """gap_group: missing for no source, `only`_only for exactly that one; others go."""
    names = F.col("source_names")
    group = F.when(F.size(names) == 0, "missing").when(names == F.array(F.lit(only)), f"{only}_only")
    return left.withColumn("gap_group", group).where(F.col("gap_group").isNotNull())


def reconcile(counts: Sequence[tuple[str, DataFrame]], key: str) -> DataFrame:
    """Full outer join of count tables (key, n) under their names, 0 where absent."""
    out = None
    for name, df in counts:
        side = df.select(key, F.col("n").alias(name))
        out = side if out is None else out.join(side, key, "full")
    return out.select(key, *[F.coalesce(name, F.lit(0)).alias(name) for name, _ in counts])
