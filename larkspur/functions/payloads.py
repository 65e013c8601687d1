"""Prices from semi-structured provider payloads.

A payload column is a JSON string; numbers are read through VARIANT under a type guard, so numeric text is no number and a
boolean counts as 1 or 0. Where the order of keys matters the JSON text itself is read, for VARIANT sorts keys.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The numeric keys of each provider's payload, and the order in which variants are preferred.
TCGPLAYER_KEYS = ("low", "mid", "high", "market", "directLow", "lowPrice", "midPrice", "highPrice", "marketPrice", "directLowPrice", "averageSellPrice")
VARIANT_PREFERENCE = ("normal", "reverse", "holo", "holofoil", "reverseHolofoil", "1stEditionHolofoil", "1stEditionNormal", "unlimitedHolofoil", "unlimitedNormal")
CARDMARKET_KEYS = ("low", "avg", "trend", "avg1", "avg7", "avg30", "lowPrice", "averageSellPrice", "trendPrice")
ANCHOR_KEYS = ("marketPrice", "market", "midPrice", "mid", "averageSellPrice")
LOW_KEYS, HIGH_KEYS = ("lowPrice", "low"), ("highPrice", "high")
MARKET_KEYS = ("marketPrice", "market", "midPrice", "mid", "directLowPrice", "directLow", "averageSellPrice")
EURO_LOW_KEYS, EURO_MARKET_KEYS, EURO_HIGH_KEYS = ("low", "lowPrice"), ("avg", "averageSellPrice", "trend", "trendPrice"), ("trend", "trendPrice", "avg1", "avg7", "avg30")

_MAP = "map<string,string>"


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value) with value evaluated once: a lambda over a one-element array, so nested uses do not multiply the expression."""
    return F.get(F.transform(F.array(value), f), 0)


def _in(v: Column, key: str) -> Column:
    return F.try_variant_get(v, f"$['{key}']", "variant")


def _kind(v: Column, key: str) -> Column:
    return F.schema_of_variant(_in(v, key))


def _number(v: Column, key: str) -> Column:
    """The member of a VARIANT as double if it is a number or a boolean, else null."""
    what, path = _kind(v, key), f"$['{key}']"
    flag = F.try_variant_get(v, path, "boolean").cast("int").cast("double")
    plain = what.isin("BIGINT", "DOUBLE", "FLOAT") | what.startswith("DECIMAL")
    return F.when(what == "BOOLEAN", flag).when(plain, F.try_variant_get(v, path, "double"))


def _first(v: Column, keys: Sequence[str]) -> Column:
    return F.coalesce(*[_number(v, k) for k in keys])


def parsed(json: Column) -> Column:
    """VARIANT of a JSON text; null if it is none."""
    return F.try_parse_json(json)


def kind(json: Column, key: str) -> Column:
    """The type of a member, as schema_of_variant names it; null if absent."""
    return _kind(parsed(json), key)


def number(json: Column, key: str) -> Column:
    """The member as double if it is a number or a boolean, else null."""
    return let(parsed(json), lambda v: _number(v, key))


def text(json: Column, key: str) -> Column:
    """The member as text; null if absent or null."""
    return F.try_variant_get(parsed(json), f"$['{key}']", "string")


def is_object(json: Column, key: str) -> Column:
    return F.coalesce(kind(json, key).startswith("OBJECT"), F.lit(False))


def member(json: Column, key: str) -> Column:
    """The member as JSON text, its keys in their order, if it is an object; else null."""
    own = F.try_element_at(F.from_json(json, _MAP), F.lit(key))
    return F.when(is_object(json, key), own)


def entries(json: Column) -> Column:
    """Members in the order of the text, as an array of (key, value text)."""
    return F.coalesce(F.map_entries(F.from_json(json, _MAP)), F.array().cast("array<struct<key:string,value:string>>"))


def first_number(json: Column, keys: Sequence[str]) -> Column:
    """The first of `keys` that holds a number; 0 counts."""
    return let(parsed(json), lambda v: _first(v, keys))


def has_number(json: Column, keys: Sequence[str]) -> Column:
    return first_number(json, keys).isNotNull()


def _score(v: Column) -> tuple[Column, Column]:
    count = sum((_number(v, k).isNotNull().cast("int") for k in TCGPLAYER_KEYS), F.lit(0))
    return count, F.coalesce(_first(v, ANCHOR_KEYS), F.lit(0.0))


def variant_score(json: Column) -> Column:
    """(numeric keys present, market anchor or 0): larger is better."""

    def scored(v: Column) -> Column:
        count, anchor = _score(v)
        return F.struct(count.alias("keys"), anchor.alias("anchor"))

    return let(parsed(json), scored)


def best_variant(json: Column) -> Column:
    """struct(name, json): the payload itself if it holds prices, else the preferred variant, else the best scored one (ties: first in the text)."""
    direct = F.when(has_number(json, TCGPLAYER_KEYS), F.struct(F.lit(None).cast("string").alias("name"), json.alias("json")))
    wanted = F.array(*map(F.lit, VARIANT_PREFERENCE))
    rest = F.lit(len(VARIANT_PREFERENCE) + 1)

    def ranked(e: Column, i: Column) -> Column:
        def one(v: Column) -> Column:
            count, anchor = _score(v)
            at = F.nullif(F.array_position(wanted, e["key"]), F.lit(0).cast("long"))
            free = at.isNull()
            return F.struct(F.coalesce(at, rest).alias("at"), F.when(free, -count).otherwise(0).alias("a"), F.when(free, -anchor).otherwise(0.0).alias("b"), i.alias("i"), count.alias("n"), e["key"].alias("name"), e["value"].alias("json"))

        return let(parsed(F.when(e["value"].startswith("{"), e["value"])), one)

    usable = F.filter(F.transform(entries(json), ranked), lambda x: x["n"] > 0)
    chosen = let(F.get(F.array_sort(usable), 0), lambda t: F.when(t.isNotNull(), F.struct(t["name"].alias("name"), t["json"].alias("json"))))
    return F.coalesce(direct, chosen)


def _clean(*candidates: Column) -> Column:
    """The first that is not null or empty, trimmed; blank becomes null."""
    return F.nullif(F.trim(F.coalesce(*[F.nullif(c, F.lit("")) for c in candidates])), F.lit(""))


def usd_source(payload: Column) -> Column:
    """struct(unit, updated, variant_name, variant) of a US payload with any price; null otherwise."""

    def made(best: Column) -> Column:
        updated = _clean(text(payload, "updated"), text(payload, "updatedAt"), text(best["json"], "updated"), text(best["json"], "updatedAt"))
        unit = F.coalesce(F.nullif(text(payload, "unit"), F.lit("")), F.lit("USD"))
        return F.when(best.isNotNull(), F.struct(unit.alias("unit"), updated.alias("updated"), best["name"].alias("variant_name"), best["json"].alias("variant")))

    return let(let(F.coalesce(member(payload, "prices"), payload), best_variant), made)


def eur_source(payload: Column) -> Column:
    """struct(unit, updated, variant_name, variant) of a European payload with any of its nine price keys; null otherwise."""

    def made(own: Column) -> Column:
        unit = F.coalesce(F.nullif(text(payload, "unit"), F.lit("")), F.lit("EUR"))
        updated = _clean(text(payload, "updated"), text(payload, "updatedAt"))
        return F.when(has_number(own, CARDMARKET_KEYS), F.struct(unit.alias("unit"), updated.alias("updated"), F.lit(None).cast("string").alias("variant_name"), own.alias("variant")))

    return let(F.coalesce(member(payload, "prices"), payload), made)


def or_number(json: Column, keys: Sequence[str]) -> Column:
    """The first member that is set (0, empty and null are not; of the last 0 counts), if it is a number."""

    def made(v: Column) -> Column:
        out = _number(v, keys[-1])
        for key in reversed(keys[:-1]):
            own = _number(v, key)
            unset = F.coalesce(_kind(v, key), F.lit("VOID")) == "VOID"
            empty = F.coalesce(own == 0, F.lit(False)) | F.coalesce(F.try_variant_get(v, f"$['{key}']", "string") == "", F.lit(False))
            out = F.when(unset | empty, out).otherwise(own)
        return out

    return let(parsed(json), made)


def price_triple(low: Column, market: Column, high: Column, updated: Column) -> Column:
    """A provider's price, null unless it has a market or low price."""
    return F.when(market.isNotNull() | low.isNotNull(), F.struct(F.lit("USD").alias("unit"), updated.alias("updated"), low.alias("low"), market.alias("market"), high.alias("high")))


def bulk_price(card: Column) -> Column:
    """Price of a set-level provider card: market, or mid where market is missing or 0; never dated."""
    made = lambda p: price_triple(number(p, "low"), or_number(p, ("market", "mid")), number(p, "high"), F.lit(None).cast("string"))
    return let(member(card, "prices"), made)


def _condition(venue: Column) -> Column:
    """The near-mint entry of a venue, else its first entry that is an object; empty objects do not count."""
    named = [F.nullif(member(venue, k), F.lit("{}")) for k in ("NEAR_MINT", "near_mint")]
    first = F.get(F.filter(entries(venue), lambda e: e["value"].startswith("{")), 0)["value"]
    return F.coalesce(*named, F.nullif(first, F.lit("{}")))


def condition_price(card: Column) -> Column:
    """Price of a condition-level provider card: near mint or first condition of the first venue, else of the second."""
    near = lambda p: F.coalesce(let(member(p, "tcgplayer"), _condition), let(member(p, "ebay"), _condition))
    made = lambda n: price_triple(number(n, "low"), or_number(n, ("avg", "market")), number(n, "high"), _clean(text(card, "lastUpdated")))
    return let(let(member(card, "prices"), near), made)


def variants_price(card: Column) -> Column:
    """struct(low, market, high) over all USD entries of a list of variants; the top level only where no market was found."""
    empty = F.array().cast("array<string>")
    lists = F.from_json(F.to_json(_in(parsed(card), "variants")), "array<struct<prices:array<string>>>")
    flat = F.flatten(F.transform(F.coalesce(lists, F.array().cast("array<struct<prices:array<string>>>")), lambda v: F.coalesce(v["prices"], empty)))

    def made(usd: Column) -> Column:
        pick = lambda key, agg: agg(F.filter(F.transform(usd, lambda p: number(p, key)), lambda x: x.isNotNull()))
        market = pick("market", F.array_max)
        low = F.when(market.isNull(), F.coalesce(number(card, "low"), pick("low", F.array_min))).otherwise(pick("low", F.array_min))
        return F.struct(low.alias("low"), F.coalesce(market, number(card, "market")).alias("market"), pick("high", F.array_max).alias("high"))

    return let(F.filter(flat, lambda p: F.upper(F.coalesce(text(p, "currency"), F.lit(""))) == "USD"), made)


_FORMATS = ("yyyy-M-d'T'H:m:s[.SSSSSS][.SSSSS][.SSSS][.SSS][.SS][.S]'Z'", "yyyy/M/d", "yyyy/M/d H:m:s")


def parse_updated(value: Column) -> Column:
    """Timestamp (UTC) of one of four formats; null for blank or anything else."""
    clean = F.nullif(F.trim(value), F.lit(""))
    return F.coalesce(*[F.try_to_timestamp(clean, F.lit(f)) for f in _FORMATS])


def invalid_updated(value: Column) -> Column:
    """Not blank and of no known format."""
    return F.coalesce(F.trim(value) != "", F.lit(False)) & parse_updated(value).isNull()


def is_fresh(value: Column, now: Column, max_age_days: int) -> Column:
    """Not older than `max_age_days`, the bound included; a future date is fresh, no date is not."""
    return F.coalesce(parse_updated(value) >= now - F.make_dt_interval(F.lit(max_age_days)), F.lit(False))
