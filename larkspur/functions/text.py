"""Names, numbers, keys and classes of items as Column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Set ids that the price provider writes in another way.
SET_ALIASES = {"swsh3.5": ["swsh35"], "swsh4.5": ["swsh45"], "sv10.5b": ["zsv10pt5"], "sv10.5w": ["rsv10pt5"]}
# Sets of promotional cards; words in a rarity that mark an alternative picture; dates between age groups.
PROMO_SETS = ("basep", "bwp", "dpp", "g1", "hsp", "np", "pl", "pop", "smp", "svp", "swshp", "xyp")
ALT_RARITIES = ("illustration rare", "special illustration rare", "alt art", "alternate art", "hyper rare", "ultra rare", "secret rare")
RECENT_SINCE, MODERN_SINCE = "2024-01-01", "2020-01-01"
STRATA = tuple(f"{age}:{what}" for age in ("recent", "modern", "legacy", "unknown") for what in ("promo", "alt_art", "standard"))


def blank_to_null(x: Column) -> Column:
    return F.nullif(F.trim(x), F.lit(""))


def text_or_empty(x: Column) -> Column:
    return F.trim(F.coalesce(x, F.lit("")))


def slugify(x: Column) -> Column:
    """Lower case; runs of anything but letters and digits become one hyphen, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(x)), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def normalize_text(x: Column) -> Column:
    """Lower case; runs of anything but ASCII letters and digits become one space; null is empty."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(x, F.lit(""))), "[^a-z0-9]+", " "))


def sanitize_file_name(x: Column) -> Column:
    return F.regexp_replace(x, "[^A-Za-z0-9._-]+", "_")


def _no_zeros(x: Column) -> Column:
    return F.regexp_replace(x, "^0+(?=.)", "")


def compact_token(x: Column) -> Column:
    """043 becomes 43, TG02 becomes TG2; anything else stays."""
    clean = F.trim(x)
    return F.when(clean.rlike("^[0-9]+$"), _no_zeros(clean)).when(clean.rlike("^[A-Za-z]+0+[1-9][0-9]*$"), F.regexp_replace(clean, "^([A-Za-z]+)0+([1-9][0-9]*)$", "$1$2")).otherwise(clean)


def distinct_nonblank(values: Column) -> Column:
    """First occurrences, in order, of what is not null or empty."""
    return F.array_distinct(F.filter(values, lambda x: x.isNotNull() & (x != "")))


def set_id_aliases(set_id: Column, number: Column, aliases: dict[str, list[str]] | None = None) -> Column:
    """Set ids to try, in order: itself, its aliases, without zeros, half sets as pt5, then all with the gallery suffix."""
    clean = text_or_empty(set_id)
    table = F.create_map(*[x for k, v in (SET_ALIASES if aliases is None else aliases).items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    known = F.coalesce(F.try_element_at(table, clean), F.array().cast("array<string>"))
    compact = F.regexp_replace(clean, r"^([A-Za-z]+)0+([1-9][0-9]*(?:\.5)?)$", "$1$2")
    base = F.concat(F.array(clean), known, F.array(compact))
    base = F.concat(base, F.transform(F.filter(base, lambda x: x.contains(".5")), lambda x: F.replace(x, F.lit(".5"), F.lit("pt5"))))
    upper = F.upper(text_or_empty(number))
    suffix = F.when(upper.startswith("TG"), "tg").when(upper.startswith("GG"), "gg")
    return distinct_nonblank(F.when(suffix.isNotNull(), F.concat(base, F.transform(base, lambda x: F.concat(x, suffix)))).otherwise(base))


def candidate_keys(set_id: Column, number: Column, aliases: dict[str, list[str]] | None = None) -> Column:
    """array<struct<set_id, number>>: every alias with the number as it is, then compact; set-major."""
    clean = text_or_empty(number)
    numbers = distinct_nonblank(F.array(clean, compact_token(clean)))
    return F.flatten(F.transform(set_id_aliases(set_id, number, aliases), lambda s: F.transform(numbers, lambda n: F.struct(s.alias("set_id"), n.alias("number")))))


def match_key(key: Column) -> Column:
    return F.concat_ws("-", key["set_id"], key["number"])


def provider_number(x: Column) -> Column:
    """Upper case, before the slash, without leading zeros; letters at the end stay."""
    base = F.split_part(F.upper(text_or_empty(x)), F.lit("/"), F.lit(1))
    plain = base.rlike("^0*[0-9]+[A-Z]*$")
    return F.when(plain, F.concat(_no_zeros(F.regexp_extract(base, "^([0-9]+)", 1)), F.regexp_extract(base, "([A-Z]*)$", 1))).otherwise(base)


def provider_card_number(numbers: Sequence[Column], name: Column) -> Column:
    """The first number that is set, else what stands after the last hyphen of the name."""
    suffix = F.trim(F.element_at(F.split(F.trim(name), "-"), -1))
    tail = F.regexp_extract(suffix, r"\b([A-Z0-9]+(?:/[A-Z0-9]+)?)\s*$", 1)
    return F.coalesce(*[F.nullif(provider_number(n), F.lit("")) for n in numbers], provider_number(tail), F.lit(""))


def provider_set_name(x: Column) -> Column:
    """Lower case without the leading `CODE: `."""
    return F.lower(F.regexp_replace(F.upper(text_or_empty(x)), r"^[A-Z0-9.]+:\s*", ""))


def provider_matches(provider_set: Column, provider_no: Column, set_name: Column, number: Column) -> Column:
    """The set name is equal where the provider gives one, and the number is given and equal."""
    same_set = (text_or_empty(provider_set) == "") | (provider_set_name(provider_set) == provider_set_name(set_name))
    return same_set & (provider_no != "") & (provider_no == provider_number(number))


_IMAGE = r"(?i)\.(avif|gif|jpe?g|png|webp)(\?.*)?$"


def image_urls(large: Column, small: Column, plain: Column) -> Column:
    """struct(high, low): an object's large and small picture, else a file as it is, else both renditions of an asset root."""
    high, low, url = text_or_empty(large), blank_to_null(small), text_or_empty(plain)
    root = F.regexp_replace(url, "/+$", "")
    own = F.struct(high.alias("high"), low.alias("low"))
    none, file = F.struct(F.lit("").alias("high"), F.lit(None).cast("string").alias("low")), F.struct(url.alias("high"), F.lit(None).cast("string").alias("low"))
    both = F.struct(F.concat(root, F.lit("/high.webp")).alias("high"), F.concat(root, F.lit("/low.webp")).alias("low"))
    return F.when(high != "", own).when(url == "", none).when(url.rlike(_IMAGE), file).otherwise(both)


def canonical_id(locale: Column, set_id: Column, local_id: Column) -> Column:
    """`pokemon:{locale}:{set}:{local}`; null where set or local id is blank."""
    return F.when(blank_to_null(set_id).isNotNull() & blank_to_null(local_id).isNotNull(), F.concat_ws(":", F.lit("pokemon"), locale, F.trim(set_id), F.trim(local_id)))


def normalize_damage(x: Column) -> Column:
    """Full-width operators as plain ones; null is empty."""
    return F.translate(text_or_empty(x), "＋－−＝×Ｘ", "+--=xx")


def attack_signature(attacks: Column) -> Column:
    """`cost,cost:damage` of each attack (struct of cost and damage), joined by `|`; null is empty."""
    one = lambda a: F.concat(F.array_join(F.coalesce(a["cost"], F.array().cast("array<string>")), ","), F.lit(":"), normalize_damage(a["damage"]))
    return F.coalesce(F.array_join(F.transform(attacks, one), "|"), F.lit(""))


def upstream_key(upstream_id: Column) -> Column:
    return F.concat(F.lit("pokemon:tcgdex:"), F.trim(upstream_id))


def equivalence_key(category: Column, illustrator: Column, upstream_id: Column, dex_ids: Column, hp: Column, types: Column, stage: Column, suffix: Column, retreat: Column, abilities: Column, attacks: Column) -> Column:
    """One key for all printings of a design across locales; the upstream id's key where the fields do not tell designs apart."""
    dex = F.when(F.coalesce(F.size(dex_ids), F.lit(0)) > 0, F.array_join(F.transform(F.array_sort(dex_ids), lambda d: d.cast("string")), ",")).otherwise(F.lit("_"))
    kinds = F.coalesce(F.array_join(types, ","), F.lit(""))
    parts = [F.lit("pokemon"), dex, F.lower(F.trim(illustrator)), text_or_empty(hp), F.lower(kinds), F.lower(text_or_empty(stage)), F.lower(text_or_empty(suffix)), text_or_empty(retreat), F.greatest(F.coalesce(F.size(abilities), F.lit(0)), F.lit(0)).cast("string"), F.lower(attack_signature(attacks))]
    composite = (F.lower(text_or_empty(category)) == "pokemon") & (text_or_empty(illustrator) != "")
    return F.when(composite, F.concat(F.lit("pokemon:xlocale:"), F.concat_ws(":", *parts))).otherwise(upstream_key(upstream_id))


def same_art_key(equivalence: Column, upstream_id: Column, name: Column) -> Column:
    """Equivalence key, else upstream id, else name, each normalized and prefixed."""
    pick = lambda prefix, x: F.when(normalize_text(x) != "", F.concat(F.lit(prefix), normalize_text(x)))
    return F.coalesce(pick("equiv:", equivalence), pick("upstream:", upstream_id), F.concat(F.lit("name:"), normalize_text(name)))


def release_bucket(released: Column) -> Column:
    """recent, modern or legacy by date; unknown for null."""
    return F.when(released.isNull(), "unknown").when(released >= F.lit(RECENT_SINCE).cast("date"), "recent").when(released >= F.lit(MODERN_SINCE).cast("date"), "modern").otherwise("legacy")


def card_class(set_id: Column, set_name: Column, rarity: Column) -> Column:
    """promo before alt_art before standard."""
    promo = F.lower(set_id).isin(*PROMO_SETS) | F.contains(F.lower(set_name), F.lit("promo"))
    alt = F.lit(False)
    for word in ALT_RARITIES:
        alt = alt | F.contains(F.lower(rarity), F.lit(word))
    return F.when(F.coalesce(promo, F.lit(False)), "promo").when(F.coalesce(alt, F.lit(False)), "alt_art").otherwise("standard")


def locale_or_unknown(x: Column) -> Column:
    return F.coalesce(blank_to_null(x), F.lit("unknown"))


def locale_of_id(card_id: Column) -> Column:
    """The second part of an id of more than two parts, else unknown."""
    parts = F.split(card_id, ":")
    return F.when(F.size(parts) > 2, F.get(parts, 1)).otherwise(F.lit("unknown"))


def variant_seed(card_id: Column, variant_idx: Column) -> Column:
    """The first 64 bits of sha256(`id|variant`), unsigned."""
    digest = F.sha2(F.concat_ws("|", card_id, variant_idx.cast("string")), 256)
    return F.conv(F.substring(digest, 1, 16), 16, 10).cast("decimal(20,0)")
