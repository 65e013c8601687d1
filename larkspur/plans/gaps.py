"""Gap populations and samples, provider evaluation, retrieval evaluation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import text as T
from ..operators import coverage, matching, ranking, retrieval
from ..sources import readers


def gap_population(cards: DataFrame, prices: DataFrame, sets: DataFrame, pinned: Sequence[str] = (), only: str = "cardmarket", prefix: str = "pokemon:en:") -> DataFrame:
    """Cards without a price and with only one source, with release bucket, class, stratum and note."""
    own = cards.where(F.col("id").ilike(f"{prefix}%"))
    sourced = matching.collected_sources(own, prices.where(F.col("card_id").ilike(f"{prefix}%")), "id", "card_id", "source_name")
    grouped = readers.release_dates(matching.gap_groups(sourced, only), sets).withColumnRenamed("id", "card_id")
    bucket, kind = T.release_bucket(F.col("release_date")), T.card_class(F.col("set_id"), F.col("set_name"), F.col("rarity"))
    note = F.when(F.col("card_id").isin(*pinned) if pinned else F.lit(False), "screenshot-example").otherwise("")
    return grouped.withColumns({"release_bucket": bucket, "card_class": kind, "stratum": F.concat_ws(":", bucket, kind), "notes": note})


def gap_order() -> list[Column]:
    """Recent before modern before legacy before unknown, then date (none first), set, number, id."""
    age = F.array_position(F.array(*map(F.lit, ("recent", "modern", "legacy", "unknown"))), F.col("release_bucket"))
    return [age, F.coalesce(F.col("release_date").cast("string"), F.lit("")), F.col("set_id"), F.col("card_number"), F.col("card_id")]


def pin_order(pinned: Sequence[str]) -> Column:
    return F.array_position(F.array(*map(F.lit, pinned)), F.col("card_id")) if pinned else F.lit(0)


def gap_sample(population: DataFrame, size: int = 100, pinned: Sequence[str] = ()) -> DataFrame:
    """`size` cards of each gap group: pinned ones, then the twelve strata in turn."""
    out = []
    for group in [r[0] for r in population.select("gap_group").distinct().orderBy("gap_group").collect()]:
        rows = population.where(F.col("gap_group") == group)
        mark = F.col("card_id").isin(*pinned) if pinned else None
        out.append(ranking.round_robin_sample(rows, "stratum", gap_order(), size, mark, pin_order(pinned), T.STRATA))
    sample = out[0]
    for more in out[1:]:
        sample = sample.unionByName(more)
    return sample.select(*schemas.GAP_SAMPLE_COLUMNS)


def population_summary(population: DataFrame) -> DataFrame:
    return coverage.population_summary(population, "release_bucket", "card_class", "stratum")


def evaluation_sample(sample: DataFrame, order: Sequence[Column], size: int, pinned: Sequence[str] = ()) -> DataFrame:
    """Cards to ask providers for: all pinned ones, then the strata in their own order in turn."""
    mark = F.col("card_id").isin(*pinned) if pinned else None
    return ranking.round_robin_sample(sample, "stratum", order, size, mark, pin_order(pinned), None, cap_pinned=False)


def provider_scorecard(lookups: DataFrame) -> DataFrame:
    notes = F.coalesce("notes", F.lit(""))
    return coverage.scorecard(lookups, "provider", F.coalesce("found", F.lit(False)), F.col("market_price").isNotNull(), notes.contains("no set mapping"), notes.contains("error:"))


def pinned_examples(lookups: DataFrame, pinned: Sequence[str]) -> DataFrame:
    return lookups.where(F.col("card_id").isin(*pinned)).select("provider", "card_id", "found", "market_price", "low_price", "high_price", "provider_card_name", "notes")


def evaluate_retrieval(queries: DataFrame, references: DataFrame, k: int = 5) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(metrics, metrics by locale, per-query rows, neighbours).

    queries: query_id, card_id, vector, name, locale, group_key. references: card_id, vector, name, group_key.
    """
    top = retrieval.knn(queries, references, k, query_id="query_id", ref_id="card_id", vector="vector", true_id="card_id")
    rows = retrieval.per_query(top).join(queries.select("query_id", F.col("card_id").alias("true_id"), F.col("name").alias("query_raw_name"), T.locale_or_unknown(F.col("locale")).alias("locale"), F.col("group_key").alias("query_group"), T.normalize_text(F.col("name")).alias("query_name")), "query_id")
    rows = retrieval.confusions(rows, references, "card_id", F.col("group_key"), T.normalize_text(F.col("name")))
    return retrieval.metrics(rows, k=k), retrieval.metrics(rows, "locale", k=k), rows, top
