"""The price snapshot: reuse, selection, fallbacks, promotion, audit, checks, publication."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import payloads as P
from ..functions import text as T
from ..operators import checks, coverage, matching, merging, ranking, selection
from ..sources import writers


@dataclass
class PriceBuild:
    """Tables of one build; `rows` is the snapshot."""

    rows: DataFrame
    selected: DataFrame
    transports: DataFrame
    coverage: DataFrame
    counters: DataFrame
    gaps: DataFrame


def fallback_prices(gaps: DataFrame, bulk: DataFrame | None, single: DataFrame | None, other: DataFrame | None, slugs: DataFrame | None, max_cards: int | None, bulk_budget: int | None, error_threshold: int = 5) -> DataFrame:
    """id, price, transport for cards that lack a US price. Prices of fallbacks are not checked for age.

    gaps: id, set_id, set_name, card_number, ord. bulk: set_name, card, ord (a set's captured cards; sets are ranked by gaps
    and taken while budget is left). single: id, pos, card, error (captured search results per card). other: slug, number,
    card, error. max_cards: cards that may ask the single providers, in card order (None: all; 0: no fallback at all).
    """
    names = "id", "set_id", "set_name", "card_number", "ord"
    out = gaps.select(*names)
    if max_cards == 0:
        return out.limit(0).select("id", F.lit(None).cast("struct<unit:string,updated:string,low:double,market:double,high:double>").alias("price"), F.lit(None).cast("string").alias("transport"))
    none = F.lit(None).cast("struct<unit:string,updated:string,low:double,market:double,high:double>")
    if bulk is not None:
        sets = coverage.ranked_gaps(gaps, "set_name", "ord")
        sized = sets.join(bulk.groupBy("set_name").agg(F.count("*").alias("cards")), "set_name", "left").withColumn("rank", F.struct(-F.col("gaps"), "first_seen"))
        taken = ranking.within_budget(sized.fillna(0, ["cards"]).withColumns({"r1": -F.col("gaps"), "r2": F.col("first_seen")}), ["r1", "r2", "set_name"], F.col("cards"), bulk_budget).where("taken").select("set_name", "r1", "r2")
        cards = bulk.join(taken, "set_name").withColumn("number", T.provider_card_number([P.text(F.col("card"), k) for k in ("cardNumber", "number", "collectorNumber")], P.text(F.col("card"), "name")))
        cards = cards.withColumn("set_key", T.provider_set_name(F.col("set_name")))
        # sets that share a normalized name: the one fetched last stands for all
        last = cards.groupBy("set_key").agg(F.max(F.struct("r1", "r2", "set_name"))["set_name"].alias("set_name"))
        index = matching.pick_first(cards.join(last, ["set_key", "set_name"], "left_semi").where("number <> ''"), ["set_key", "number"], [F.col("ord")], ["set_key", "number", "card"])
        keyed = out.withColumns({"set_key": T.provider_set_name(F.col("set_name")), "number": T.provider_number(F.col("card_number"))})
        out = keyed.join(index, ["set_key", "number"], "left").withColumn("bulk", P.bulk_price(F.col("card"))).select(*names, "bulk").persist()
    else:
        out = out.withColumn("bulk", none)
    lacking = ranking.first_budgeted(out.where("bulk is null"), ["ord"], max_cards).select("id", "ord", "set_id", "set_name", "card_number")
    if single is not None:
        found = single.withColumn("no", T.provider_card_number([P.text(F.col("card"), k) for k in ("cardNumber", "number", "collectorNumber")], P.text(F.col("card"), "name")))
        found = found.join(lacking, "id").withColumn("set_given", F.coalesce(F.nullif(P.text(F.col("card"), "set"), F.lit("")), F.nullif(P.text(F.col("card"), "setName"), F.lit("")), P.text(F.col("card"), "set_name")))
        fits = T.provider_matches(F.col("set_given"), F.col("no"), F.col("set_name"), F.col("card_number"))
        best = matching.search_match(found, "id", fits & ~F.coalesce("error", F.lit(False)), "pos").select("id", P.bulk_price(F.col("card")).alias("single"))
        asked = lacking.join(best, "id", "left").join(single.groupBy("id").agg(F.max("error").alias("error")), "id", "left").withColumn("provider", F.lit("ppt"))
        open_ = ranking.breaker_attempts(asked, "provider", "ord", F.coalesce("error", F.lit(False)), F.col("single").isNotNull(), error_threshold)
        out = out.join(open_.where("attempted").select("id", "single"), "id", "left")
    else:
        out = out.withColumn("single", none)
    if other is not None and slugs is not None:
        rest = out.where("single is null").join(lacking.select("id"), "id", "left_semi").join(slugs.select(F.col("key").alias("set_id"), "slug"), "set_id")
        side = matching.pick_first(other, ["slug", "number"], [F.lit(0)])
        asked = rest.join(side.withColumnRenamed("number", "card_number"), ["slug", "card_number"], "left").withColumn("provider", F.lit("poketrace")).withColumn("other", P.condition_price(F.col("card")))
        open_ = ranking.breaker_attempts(asked, "provider", "ord", F.coalesce("error", F.lit(False)), F.col("other").isNotNull(), error_threshold)
        out = out.join(open_.where("attempted").select("id", "other"), "id", "left")
    else:
        out = out.withColumn("other", none)
    price, transport = selection.fallback_choice(F.col("bulk"), F.col("single"), F.col("other"))
    return out.select("id", price.alias("price"), transport.alias("transport")).where("price is not null")


def build_prices(cards: DataFrame, provider: DataFrame, now: dt.datetime, max_age_days: int = 14, seed: DataFrame | None = None, reuse_prefix: str | None = None, bulk: DataFrame | None = None, single: DataFrame | None = None, other: DataFrame | None = None, slugs: DataFrame | None = None, max_fallback_cards: int | None = None) -> PriceBuild:
    """cards: normalized cards with `pricing` (JSON text) and ord. provider: set_id, number, tcgplayer, ord. `now` is UTC."""
    spark = cards.sparkSession
    if seed is not None and reuse_prefix:
        reused, todo = merging.reuse_snapshot(cards, seed, "tcgplayer", reuse_prefix)
    else:
        reused, todo = spark.createDataFrame([], schemas.PRICES), cards
    as_of = F.lit(now.replace(tzinfo=dt.timezone.utc) if now.tzinfo is None else now)
    english = todo.where(F.col("locale") == "en")
    # kept, since rows, gaps, counters and audit all read it; a lost part is computed again
    selected = selection.select_usd(english, selection.provider_index(provider).persist(), as_of, max_age_days).persist()
    usd = selection.usd_rows(selected)
    gaps = selected.where("reason is not null")
    more = fallback_prices(gaps, bulk, single, other, slugs, max_fallback_cards, max_fallback_cards).persist()
    abroad = todo.where(F.col("locale") != "en").withColumn("source", P.eur_source(P.member(F.col("pricing"), "cardmarket")))
    eur = selection.eur_rows(abroad)
    rows = selection.promoted(merging.concat_rows(reused, usd, selection.fallback_rows(more), eur)).persist()
    transports = merging.concat_rows(
        usd.agg(F.count("*").alias("n")).select(F.lit("tcgplayer").alias("source"), F.lit("pokemontcgio").alias("transport"), "n"),
        more.groupBy("transport").agg(F.count("*").alias("n")).select(F.lit("tcgplayer").alias("source"), "transport", "n"),
        eur.agg(F.count("*").alias("n")).select(F.lit("cardmarket").alias("source"), F.lit("tcgdex").alias("transport"), "n"),
    ).where("n > 0")
    everyone = cards.select(F.col("id").alias("card_id"), "locale")
    covered = coverage.source_coverage(rows.join(everyone, "card_id"), "card_id", F.col("locale"), "source_name", "is_primary", cards=everyone)
    return PriceBuild(rows, selected, transports, covered, selection.selection_counters(selected), selection.gap_audit(selected, rows))


def publish_prices(build: PriceBuild, path: str, min_rows: int = 1000, cards: DataFrame | None = None) -> None:
    """Checks on the table as written, then its manifest."""
    writers.publish(build.rows, path, schemas.PRICES_VERSION, lambda t, m: checks.check_prices(t, m, schemas.PRICES_VERSION, min_rows, cards))


def summarize(build: PriceBuild) -> dict:
    """The build's summary: totals, coverage by locale, counters, gaps, transports, content hash."""
    totals = coverage.price_totals(build.rows).first().asDict()
    moved: dict = {}
    for r in build.transports.collect():
        moved.setdefault(r["source"], {})[r["transport"]] = r["n"]
    return {
        **totals,
        "coverage_by_locale": {r["group"]: {k: v for k, v in r.asDict().items() if k != "group"} for r in build.coverage.collect()},
        "selection": build.counters.first().asDict(),
        "sample_gaps": [r.asDict() for r in build.gaps.collect()],
        "transport_counts": moved,
        "content_hash": coverage.snapshot_hash(build.rows),
    }


def inspect(prices: DataFrame) -> DataFrame:
    """Coverage of an existing snapshot by the locale in its ids; cards without rows are not seen."""
    return coverage.source_coverage(prices, "card_id", T.locale_of_id(F.col("card_id")), "source_name", "is_primary")
