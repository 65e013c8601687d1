"""Set operations and keyed merges of old and new rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .matching import last_wins_index, pick_first


def concat_rows(*frames: DataFrame) -> DataFrame:
    """UNION ALL by name; columns that a frame lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def insert_ignore(old: DataFrame, new: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """`old` and the new rows whose key it lacks; of new rows with one key the first by `order`."""
    fresh = pick_first(new, keys, [F.col(order)], [c for c in new.columns if c != order])
    return concat_rows(old, fresh.join(old.select(*keys).distinct(), [*keys], "left_anti"))


def upsert_last_wins(old: DataFrame, new: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Per key the last new row by `order`, else the old row."""
    last = last_wins_index(new, keys, order)
    return concat_rows(old.join(last.select(*keys), [*keys], "left_anti"), last)


def add_missing_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Additive migration: each column that is absent comes in as null of its type."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns})


def distinct_union(*columns: tuple[DataFrame, str]) -> DataFrame:
    """Distinct non-null values of several columns, as `value`."""
    return concat_rows(*[df.select(F.col(c).alias("value")) for df, c in columns]).where("value is not null").distinct()


def same_set(a: Column, b: Column) -> Column:
    return (F.size(F.array_except(a, b)) == 0) & (F.size(F.array_except(b, a)) == 0)


def reuse_snapshot(cards: DataFrame, snapshot: DataFrame, source: str, updated_prefix: str) -> tuple[DataFrame, DataFrame]:
    """(rows to reuse, cards still to do): a card is reused if the snapshot has a row of `source` updated on that prefix."""
    hit = snapshot.where((F.col("source_name") == source) & F.col("updated_at").startswith(updated_prefix)).select("card_id").distinct()
    reused = snapshot.join(hit, "card_id", "left_semi").join(cards.select(F.col("id").alias("card_id")), "card_id", "left_semi")
    return reused, cards.join(hit, cards["id"] == hit["card_id"], "left_anti")
