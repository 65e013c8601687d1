"""Readers of captured provider responses, caches, manifests and samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import text as T
from ..operators.matching import last_wins_index, pick_first


def json_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """line, file, offset-like `ord` (increasing within a file) of every non-blank line that parses as JSON; others are skipped."""
    lines = spark.read.text([*path] if not isinstance(path, str) else path)
    kept = lines.where(F.try_parse_json("value").isNotNull() & (F.trim("value") != ""))
    return kept.select(F.col("value").alias("line"), F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("ord"))


def detail_cache(spark: SparkSession, path: str | Sequence[str], key: Sequence[str]) -> DataFrame:
    """The last cached line of each key (members of the line, all set): key columns and line."""
    lines = json_lines(spark, path)
    keyed = lines.select(*[F.try_variant_get(F.try_parse_json("line"), f"$['{k}']", "string").alias(k) for k in key], "line", "ord")
    for k in key:
        keyed = keyed.where(F.coalesce(F.col(k), F.lit("")) != "")
    return last_wins_index(keyed, key, "ord").drop("ord")


def parse_locales(text: str | None, known: tuple[str, ...] = ("en",)) -> tuple[str, ...]:
    """A list of locales: parts are trimmed and repeats left out; blank means all `known`. Only commas, or a locale that is
    not known, is an error."""
    if not (text or "").strip():
        return known
    out = tuple(dict.fromkeys(p.strip().lower() for p in text.split(",") if p.strip()))
    if not out or not set(out) <= set(known):
        raise ValueError(f"locales must be among {', '.join(known)}: {text!r}")
    return out


def cached_listing(cache: DataFrame, locale: str, complete: bool = False) -> DataFrame | None:
    """The cached rows of a locale as its listing; only where the caller says that the cache is complete."""
    return cache.where(F.col("locale") == locale) if complete else None


def paged_listing(spark: SparkSession, pages: str | Sequence[str], page_size: int, items: str | None = None, id_key: str = "id") -> DataFrame:
    """Items of captured pages (one JSON text a row or file, with page numbers in `page`), up to the first empty or short page.

    Repeated ids count once, in the page order; items without an id stay. `items`: the member that holds the list.
    """
    raw = spark.read.option("wholetext", True).text([*pages] if not isinstance(pages, str) else pages)
    body = F.try_parse_json("value")
    whole = raw.select(F.coalesce(F.try_variant_get(body, "$.page", "int"), F.regexp_extract(F.input_file_name(), r"(\d+)\D*$", 1).try_cast("int")).alias("page"), F.to_json(F.try_variant_get(body, f"$['{items}']" if items else "$", "variant")).alias("list"))
    rows = whole.withColumn("list", F.from_json("list", "array<string>"))
    stop = rows.where(F.coalesce(F.size("list"), F.lit(0)) < page_size).agg(F.min("page").alias("stop"))
    used = rows.crossJoin(F.broadcast(stop)).where("stop is null or page <= stop")
    each = used.select("page", F.posexplode("list").alias("pos", "item"))
    each = each.withColumn("id", F.try_variant_get(F.try_parse_json("item"), f"$['{id_key}']", "string"))
    named = pick_first(each.where("id <> ''"), ["id"], [F.col("page"), F.col("pos")])
    return named.unionByName(each.where("id is null or id = ''"))


def card_payloads(df: DataFrame, item: str = "item") -> DataFrame:
    """Provider cards from JSON items: set_id, number and the price payload as text, with the order they came in."""
    v = F.try_parse_json(item)
    get = lambda p: F.try_variant_get(v, p, "string")
    return df.select(get("$.set.id").alias("set_id"), get("$.number").alias("number"), F.to_json(F.try_variant_get(v, "$.tcgplayer", "variant")).alias("tcgplayer"), (F.col("page") * 1_000_000 + F.col("pos")).alias("ord"))


def normalized_cards(df: DataFrame, locale: str = "locale", item: str = "item") -> tuple[DataFrame, DataFrame]:
    """(cards, rejects) from raw JSON payloads: trimmed fields, defaults, canonical id, equivalence key and image URLs.

    A payload without id, set id or local id is rejected, with a reason. `pricing` stays JSON text.
    """
    v = F.try_parse_json(item)
    get = lambda p, kind="string": F.try_variant_get(v, p, kind)
    attacks = F.from_json(F.to_json(get("$.attacks", "variant")), "array<struct<cost:array<string>,damage:string>>")
    upstream, set_id, local = T.blank_to_null(get("$.id")), T.blank_to_null(get("$.set.id")), T.blank_to_null(get("$.localId"))
    pick = lambda key: T.image_urls(F.coalesce(F.nullif(get(f"$.{key}.large"), F.lit("")), get(f"$.{key}.high")), F.coalesce(F.nullif(get(f"$.{key}.small"), F.lit("")), get(f"$.{key}.low")), F.coalesce(get(f"$.{key}.url"), F.when(~F.coalesce(F.schema_of_variant(get(f"$.{key}", "variant")).startswith("OBJECT"), F.lit(False)), get(f"$.{key}"))))
    image = F.when(pick("image")["high"] != "", pick("image")).otherwise(pick("images"))
    equivalence = T.equivalence_key(get("$.category"), get("$.illustrator"), upstream, get("$.dexId", "array<int>"), get("$.hp"), get("$.types", "array<string>"), get("$.stage"), get("$.suffix"), get("$.retreat"), get("$.abilities", "array<variant>"), attacks)
    canonical = T.canonical_id(F.col(locale), set_id, local)
    reason = F.when(upstream.isNull(), "missing id").when(set_id.isNull(), "missing set.id").when(local.isNull(), "missing localId")
    out = df.select(
        canonical.alias("id"), F.col(locale).alias("locale"), F.lit("tcgdex").alias("upstream_source"), upstream.alias("upstream_id"), set_id.alias("set_id"), T.text_or_empty(get("$.set.name")).alias("set_name"), local.alias("card_number"),
        F.trim(F.coalesce(F.nullif(get("$.name"), F.lit("")), canonical)).alias("name"), F.coalesce(T.blank_to_null(get("$.rarity")), F.lit("Unknown")).alias("rarity"), image["high"].alias("image_url"), image["low"].alias("image_url_low"),
        equivalence.alias("equivalence_key"), T.blank_to_null(get("$.hp")).alias("hp"), F.to_json(get("$.pricing", "variant")).alias("pricing"), reason.alias("reason"), F.col(item).alias("item"),
    )
    return out.where("reason is null").drop("reason", "item"), out.where("reason is not null").select("locale", "reason", "item")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Training records, one JSON line each; optional fields null."""
    return spark.read.schema(schemas.MANIFEST).json(path)


def benchmark_frames(spark: SparkSession, path: str) -> DataFrame:
    """Ordered frames; the group key is same_art_key, else equivalence_key."""
    return spark.read.schema(schemas.BENCHMARK_FRAMES).json(path).withColumn("group_key", F.coalesce("same_art_key", "equivalence_key"))


def sample_csv(spark: SparkSession, path: str, schema: str = schemas.SAMPLE_CARDS) -> DataFrame:
    """A CSV with a header; columns by name, all text, missing ones null."""
    rows = spark.read.option("header", True).csv(path)
    wanted = [c.strip().split(" ")[0] for c in schema.split(",")]
    return rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in wanted])


def lookups_csv(spark: SparkSession, path: str) -> DataFrame:
    """Provider lookups with typed columns; unreadable numbers are null."""
    text = spark.read.option("header", True).csv(path)
    cols = [c.strip().split(" ") for c in schemas.LOOKUPS.split(",")]
    return text.select(*[(F.col(n).try_cast(t) if n in text.columns else F.lit(None).cast(t)).alias(n) for n, t in cols])


def mapping_file(spark: SparkSession, path: str) -> DataFrame:
    """key, slug of a JSON object of texts; blanks are dropped, a file that is no object gives no rows."""
    raw = spark.read.option("wholetext", True).text(path)
    pairs = raw.where(F.coalesce(F.schema_of_variant(F.try_parse_json("value")).startswith("OBJECT"), F.lit(False))).select(F.explode(F.from_json("value", "map<string,string>")).alias("key", "slug"))
    return pairs.select(F.trim("key").alias("key"), F.trim("slug").alias("slug")).where("key <> '' and slug <> ''")


def lookup(wanted: DataFrame, captured: DataFrame, on: Sequence[str], order: Column | None = None) -> DataFrame:
    """Left join to captured responses, the first of each key; rows without one keep nulls."""
    side = pick_first(captured, on, [order if order is not None else F.lit(0)])
    return wanted.join(side, [*on], "left")


def targeted(cards: DataFrame, card_id: str, probes: Column, captured: DataFrame, probe_key: str) -> DataFrame:
    """For each distinct card the first probe (text) with a captured response: card_id, probe_pos and the response's columns."""
    tried = cards.select(F.col(card_id).alias("__id"), probes.alias("__probes")).dropDuplicates(["__id"]).select("__id", F.posexplode("__probes").alias("probe_pos", "__probe"))
    hit = tried.join(captured, F.col("__probe") == F.col(probe_key)).drop("__probe")
    return pick_first(hit, ["__id"], [F.col("probe_pos")]).withColumnRenamed("__id", card_id)


def release_dates(cards: DataFrame, sets: DataFrame) -> DataFrame:
    """cards with release_date of their set; null where the set is not known. A malformed date raises (ANSI)."""
    dates = sets.select(F.col("set_id").alias("__s"), F.to_date(T.blank_to_null(F.col("release_date")), "yyyy-M-d").alias("release_date"))
    return cards.join(dates, F.col("set_id") == F.col("__s"), "left").drop("__s")
