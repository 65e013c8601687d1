"""Audits and scorecards: conditional counts, group counts, content hashes."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .ranking import limit_per_group, running_total


def source_coverage(rows: DataFrame, card: str, group: Column, source: str, primary: str, first: str = "tcgplayer", second: str = "cardmarket", cards: DataFrame | None = None) -> DataFrame:
    """Per group eleven counters of cards with either, both, one or no source, primaries and rows.

    rows: one per card and source. cards: all cards (with the same `card` and group columns), else only cards with rows count.
    """
    has = lambda s: F.max((F.col(source) == s).cast("int"))
    leads = lambda s: F.max(((F.col(source) == s) & (F.col(primary) == 1)).cast("int"))
    per_card = rows.groupBy(card, group.alias("__group")).agg(has(first).alias("a"), has(second).alias("b"), leads(first).alias("pa"), leads(second).alias("pb"))
    if cards is not None:
        everyone = cards.select(F.col(card).alias("__c"), group.alias("__g"))
        per_card = everyone.join(per_card.drop("__group"), F.col("__c") == F.col(card), "left").withColumn("__group", F.col("__g")).fillna(0, ["a", "b", "pa", "pb"])
    n = lambda c: F.count_if(c)
    a, b = F.col("a") == 1, F.col("b") == 1
    return per_card.groupBy(F.col("__group").alias("group")).agg(
        F.count("*").alias("cards_total"), n(a).alias(f"cards_with_{first}"), n(b).alias(f"cards_with_{second}"), n(a & b).alias("cards_with_both_sources"),
        n(a & ~b).alias(f"cards_with_{first}_only"), n(b & ~a).alias(f"cards_with_{second}_only"), n(~a & ~b).alias("cards_without_prices"),
        n(F.col("pa") == 1).alias(f"cards_primary_{first}"), n(F.col("pb") == 1).alias(f"cards_primary_{second}"), n(a).alias(f"{first}_rows"), n(b).alias(f"{second}_rows"),
    )


def group_counts(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("n"))


def count_range(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """keys, rows, and the least and most rows of one key."""
    per = df.groupBy(*key).agg(F.count("*").alias("n"))
    return per.agg(F.count("*").alias("keys"), F.sum("n").alias("rows"), F.min("n").alias("min_per_key"), F.max("n").alias("max_per_key"))


def set_difference(df: DataFrame, column: str, expected: Sequence[str]) -> DataFrame:
    """missing and unexpected distinct values, sorted."""
    found, want = F.collect_set(column), F.array(*[F.lit(x) for x in expected])
    one = df.agg(found.alias("found"))
    return one.select(F.sort_array(F.array_except(want, "found")).alias("missing"), F.sort_array(F.array_except("found", want)).alias("unexpected"))


def population_summary(df: DataFrame, bucket: str, kind: str, stratum: str) -> DataFrame:
    """Counts by bucket, kind, stratum and in all, in one pass of grouping sets."""
    names = [bucket, kind, stratum]
    grouped = df.groupingSets([[bucket], [kind], [stratum], []], *names).agg(F.grouping_id().alias("g"), F.count("*").alias("n"))
    level = F.element_at(F.create_map(*[F.lit(x) for x in (3, bucket, 5, kind, 6, stratum, 7, "all")]), F.col("g").cast("int"))
    return grouped.select(level.alias("dimension"), F.coalesce(*[F.col(c).cast("string") for c in names], F.lit("")).alias("value"), "n")


def scorecard(df: DataFrame, by: str, found: Column, priced: Column, mapping_failed: Column, failed: Column) -> DataFrame:
    """Tested, found, priced and failed per provider, with rates in percent to one decimal (half to even)."""
    rate = lambda c: F.bround(F.col(c) * 100.0 / F.col("cards_tested"), 1)
    out = df.groupBy(by).agg(F.count("*").alias("cards_tested"), F.count_if(found).alias("cards_found"), F.count_if(priced).alias("cards_with_price"), F.count_if(mapping_failed).alias("set_mapping_failures"), F.count_if(failed).alias("errors"))
    return out.withColumns({"coverage_rate": rate("cards_found"), "price_rate": rate("cards_with_price")})


def ranked_gaps(df: DataFrame, key: str, order: str) -> DataFrame:
    """Rows per non-blank key, most first; ties in order of first appearance."""
    out = df.where(F.trim(key) != "").groupBy(key).agg(F.count("*").alias("gaps"), F.min(order).alias("first_seen"))
    return out.orderBy(F.desc("gaps"), "first_seen")


def price_totals(rows: DataFrame) -> DataFrame:
    """Rows, rows with any price, and cards."""
    any_price = F.coalesce("low_price", "market_price", "high_price").isNotNull()
    return rows.agg(F.count("*").alias("rows"), F.count_if(any_price).alias("priced_rows"), F.count_distinct("card_id").alias("cards"))


def label_map(df: DataFrame, column: str) -> DataFrame:
    """Distinct values with a dense index from 0 in their order; no task holds all values."""
    distinct = df.select(column).where(F.col(column).isNotNull()).distinct()
    return running_total(distinct, [column], F.lit(1), "label").withColumn("label", F.col("label").cast("int"))


def flagged(df: DataFrame, key: str, flags: dict[str, Column], most: int = 1000) -> DataFrame:
    """For each flag its count and the first `most` keys that have it, in order; the keys are an excerpt by definition."""
    each = df.select(F.col(key).cast("string").alias("key"), F.explode(F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in flags.items()]))).alias("flag"))
    counts = each.groupBy("flag").agg(F.count("*").alias("n"))
    keys = limit_per_group(each, ["flag"], [F.col("key")], most).groupBy("flag").agg(F.sort_array(F.collect_list("key")).alias("keys"))
    return counts.join(keys, "flag")


def skip_report(df: DataFrame, locale: str, reason: str, example: str | None = None, examples: int = 20) -> DataFrame:
    """Skips by locale and by reason; with `example` (a name of rows) also the first `examples` of them, n their place."""
    grouped = df.groupingSets([[locale], [reason]], locale, reason).agg(F.grouping_id().alias("g"), F.count("*").alias("n"))
    out = grouped.select(F.when(F.col("g") == 1, "locale").otherwise("reason").alias("dimension"), F.coalesce(locale, reason).alias("value"), "n")
    if example is None:
        return out
    from pyspark.sql import Window as W

    first = df.select(F.col(example).alias("__x")).orderBy("__x").limit(examples)
    return out.union(first.select(F.lit("example"), F.col("__x").cast("string"), F.row_number().over(W.orderBy("__x")).cast("long")))


def line_hash(df: DataFrame, line: Column, keys: Sequence[str], digits: int = 3) -> DataFrame:
    """content_hash of all rows whatever their order or partitions: sha256 over the hashes of buckets of lines.

    A bucket is the first `digits` hex digits of a line's md5; its hash is sha256 over its lines sorted by `keys`. So one
    group holds 1 / 16 ** digits of the lines, and the last aggregate as many hashes as there are buckets; raise `digits`
    with the table. Two tables have one hash if and only if they have the same lines.
    """
    lines = df.select(F.struct(*keys).alias("k"), line.alias("line"))
    bucket = lines.groupBy(F.substring(F.md5("line"), 1, digits).alias("part")).agg(F.sort_array(F.collect_list(F.struct("k", "line"))).alias("rows"))
    each = bucket.select("part", F.sha2(F.array_join(F.transform("rows", lambda r: r["line"]), "\n"), 256).alias("h"))
    return each.agg(F.sha2(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "h"))), lambda r: r["h"]), "\n"), 256).alias("content_hash"))


@F.pandas_udf(StringType())
def json_line(rows: pd.DataFrame) -> pd.Series:
    """A row as a compact JSON list, as Python's json writes it."""
    import json
    import math

    def clean(x: object) -> object:
        if x is None or (isinstance(x, float) and math.isnan(x)):
            return None
        return x.item() if hasattr(x, "item") else x

    return pd.Series([json.dumps([clean(x) for x in row], separators=(",", ":")) for row in rows.itertuples(index=False)])


def snapshot_hash(rows: DataFrame) -> str:
    """sha256 over the snapshot's JSON lines by (card_id, source_name), the form other tools publish; for snapshots that fit a driver."""
    import hashlib

    names = ["card_id", "market_code", "currency_code", "source_name", "low_price", "market_price", "high_price", "updated_at", "is_primary"]
    digest = hashlib.sha256()
    ordered = rows.select("card_id", "source_name", json_line(F.struct(*names)).alias("line")).orderBy("card_id", "source_name")
    for row in ordered.toLocalIterator():
        digest.update(row["line"].encode())
        digest.update(b"\n")
    return digest.hexdigest()
