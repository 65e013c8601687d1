"""Which price source a card gets, why not, and the rows that follow."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import payloads as P
from ..functions import text as T
from .matching import alias_join, first_wins_index
from .ranking import promote_primary

# Why a card has no price of the main provider.
NO_MATCH = "no_pokemontcgio_match"
MISSING_PAYLOAD = "pokemontcgio_missing_tcgplayer_payload"
NO_NUMBERS = "pokemontcgio_tcgplayer_without_numeric_prices"
NO_DATE = "pokemontcgio_tcgplayer_missing_updated_at"
BAD_DATE = "pokemontcgio_tcgplayer_invalid_updated_at"
OLD_DATE = "pokemontcgio_tcgplayer_older_than_max_age"
AFTER_FALLBACK = "no_usd_provider_after_fallback"


def provider_index(provider: DataFrame, order: str = "ord") -> DataFrame:
    """provider: set_id, number, tcgplayer (JSON text), ord. One row per key; a priced row goes before an unpriced one."""
    rows = provider.select(F.trim("set_id").alias("set_id"), F.trim("number").alias("number"), "tcgplayer", order)
    return first_wins_index(rows, ["set_id", "number"], order, P.usd_source(F.col("tcgplayer")).isNotNull())


def select_usd(cards: DataFrame, index: DataFrame, now: Column, max_age_days: int, aliases: dict[str, list[str]] | None = None) -> DataFrame:
    """English cards (id, set_id, card_number, ...) with match_pos, source and reason (null where the source is taken)."""
    keys = T.candidate_keys(F.col("set_id"), F.col("card_number"), aliases)
    hits = alias_join(cards, "id", keys, index, ["set_id", "number"], ["tcgplayer"])
    out = cards.join(hits, "id", "left")
    payload = F.when(F.coalesce(F.schema_of_variant(F.try_parse_json("tcgplayer")).startswith("OBJECT"), F.lit(False)), F.col("tcgplayer"))
    out = out.withColumns({"__payload": payload, "attempted_keys": F.transform(keys, T.match_key)})
    out = out.withColumn("__source", P.usd_source(F.col("__payload")))
    updated = F.col("__source.updated")
    reason = (
        F.when(F.col("match_pos").isNull(), NO_MATCH).when(F.col("__payload").isNull(), MISSING_PAYLOAD).when(F.col("__source").isNull(), NO_NUMBERS)
        .when(updated.isNull(), NO_DATE).when(P.invalid_updated(updated), BAD_DATE).when(~P.is_fresh(updated, now, max_age_days), OLD_DATE)
    )
    out = out.withColumn("reason", reason)
    return out.withColumn("source", F.when(F.col("reason").isNull(), F.col("__source"))).drop("__payload", "__source", "tcgplayer")


def selection_counters(selected: DataFrame) -> DataFrame:
    """All counters of the audit from reason and match_pos."""
    why = lambda *r: F.count_if(F.col("reason").isin(*r))
    return selected.agg(
        F.count("*").alias("english_cards_considered"), F.count_if(F.col("match_pos").isNotNull()).alias("english_cards_with_match"), why(NO_MATCH).alias("english_cards_without_match"),
        F.count_if(F.col("reason").isNull()).alias("english_cards_with_tcgplayer"), why(MISSING_PAYLOAD, NO_NUMBERS).alias("english_cards_without_tcgplayer"),
        F.count_if(F.col("match_pos") > 0).alias("alias_required_matches"), why(NO_DATE, BAD_DATE, OLD_DATE).alias("stale_tcgplayer_rows"),
        why(MISSING_PAYLOAD, NO_NUMBERS, NO_DATE, BAD_DATE, OLD_DATE).alias("stale_or_missing_tcgplayer"),
        why(NO_DATE).alias("missing_updated_at"), why(BAD_DATE).alias("invalid_updated_at"), why(OLD_DATE).alias("older_than_max_age"),
    )


def usd_rows(df: DataFrame, card: str = "id", source: str = "source") -> DataFrame:
    """Price rows of US sources: struct(unit, updated, variant) in `source`."""
    v = F.col(source)["variant"]
    return df.where(F.col(source).isNotNull()).select(
        F.col(card).alias("card_id"), F.lit("US").alias("market_code"), F.col(source)["unit"].alias("currency_code"), F.lit("tcgplayer").alias("source_name"),
        P.first_number(v, P.LOW_KEYS).alias("low_price"), P.first_number(v, P.MARKET_KEYS).alias("market_price"), P.first_number(v, P.HIGH_KEYS).alias("high_price"),
        F.col(source)["updated"].alias("updated_at"), F.lit(1).alias("is_primary"),
    )


def eur_rows(df: DataFrame, card: str = "id", source: str = "source") -> DataFrame:
    """Price rows of European sources; not primary until promoted."""
    v = F.col(source)["variant"]
    return df.where(F.col(source).isNotNull()).select(
        F.col(card).alias("card_id"), F.lit("EU").alias("market_code"), F.col(source)["unit"].alias("currency_code"), F.lit("cardmarket").alias("source_name"),
        P.first_number(v, P.EURO_LOW_KEYS).alias("low_price"), P.first_number(v, P.EURO_MARKET_KEYS).alias("market_price"), P.first_number(v, P.EURO_HIGH_KEYS).alias("high_price"),
        F.col(source)["updated"].alias("updated_at"), F.lit(0).alias("is_primary"),
    )


def fallback_rows(df: DataFrame, card: str = "id", price: str = "price") -> DataFrame:
    """Price rows of fallback providers: struct(unit, updated, low, market, high); their date is not checked."""
    p = F.col(price)
    return df.where(p.isNotNull()).select(F.col(card).alias("card_id"), F.lit("US").alias("market_code"), p["unit"].alias("currency_code"), F.lit("tcgplayer").alias("source_name"), p["low"].alias("low_price"), p["market"].alias("market_price"), p["high"].alias("high_price"), p["updated"].alias("updated_at"), F.lit(1).alias("is_primary"))


def source_priority() -> Column:
    return F.when(F.col("source_name") == "tcgplayer", 0).otherwise(1)


def promoted(rows: DataFrame) -> DataFrame:
    return promote_primary(rows, "card_id", [source_priority(), F.col("source_name")])


def embedded_rows(cards: DataFrame, tcgplayer: str = "tcgplayer", cardmarket: str = "cardmarket") -> DataFrame:
    """Price rows straight from payloads that cards carry, without freshness or locale rules."""
    usd = usd_rows(cards.withColumn("source", P.usd_source(F.col(tcgplayer))))
    eur = eur_rows(cards.withColumn("source", P.eur_source(F.col(cardmarket))))
    return promoted(usd.unionByName(eur))


def fallback_choice(bulk: Column, single: Column, other: Column) -> tuple[Column, Column]:
    """(price, transport): the first provider that has one."""
    price = F.coalesce(bulk, single, other)
    transport = F.when(bulk.isNotNull(), "ppt_bulk").when(single.isNotNull(), "ppt").when(other.isNotNull(), "poketrace")
    return price, transport


def gap_audit(selected: DataFrame, rows: DataFrame, limit: int = 10) -> DataFrame:
    """English cards without a US row, with their reason, sorted and cut to `limit`."""
    priced = rows.where((F.col("source_name") == "tcgplayer") & (F.col("currency_code") == "USD")).select(F.col("card_id").alias("__c")).distinct()
    gaps = selected.join(priced, F.col("id") == F.col("__c"), "left_anti")
    return gaps.select(F.col("id").alias("card_id"), F.coalesce("reason", F.lit(AFTER_FALLBACK)).alias("reason"), "attempted_keys").orderBy("card_id").limit(limit)


def reason_chain(pairs: Sequence[tuple[Column, str]]) -> Column:
    """The text of the first condition that holds; null if none."""
    out = F.lit(None).cast("string")
    for condition, text in reversed(pairs):
        out = F.when(condition, F.lit(text)).otherwise(out)
    return out
