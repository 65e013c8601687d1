"""The card corpus with vectors: scoring in variants, int8 table, equivalents, checks, publication; manifests and retention."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import text as T
from ..functions import vectors as V
from ..operators import checks, coverage, matching, merging, ranking
from ..sources import images, writers


def expand_variants(cards: DataFrame, tags: Sequence[str] = images.VARIANTS) -> DataFrame:
    """Each card in each variant, with its seed."""
    out = cards.select("*", F.posexplode(F.array(*map(F.lit, tags))).alias("variant_idx", "variant_tag"))
    return out.withColumn("variant_seed", T.variant_seed(F.col("id"), F.col("variant_idx")))


def expand_frames(clips: DataFrame, frames: int, step_ms: int) -> DataFrame:
    """Each clip in `frames` frames with their times."""
    return clips.withColumn("frame_index", F.explode(F.sequence(F.lit(0), F.lit(frames - 1)))).withColumn("timestamp_millis", F.col("frame_index") * step_ms)


def int8_table(embeddings: DataFrame) -> DataFrame:
    """Quantized clean vectors; a vector whose length is not its dim raises."""
    clean = embeddings.where("variant_idx = 0")
    sound = F.when(F.size("vector") == F.col("dim"), F.col("vector")).otherwise(F.raise_error(F.concat(F.lit("dimension of "), "card_id")).cast("array<float>"))
    return clean.select("card_id", "dim", V.quantize(sound).alias("vector_int8"))


def equivalents(cards: DataFrame) -> DataFrame:
    return cards.select(F.col("id").alias("card_id"), "equivalence_key", "upstream_source", "upstream_id", "locale", "set_id", F.col("card_number").alias("local_id"))


def image_status(cards: DataFrame, downloads: DataFrame, valid: DataFrame) -> DataFrame:
    """id, locale and the reason a card has no usable picture (null if it has). downloads: id, error. valid: id, valid."""
    out = cards.select("id", "locale", "image_url").join(downloads, "id", "left").join(valid, "id", "left")
    return out.select("id", "locale", images.skip_reason(F.col("image_url"), F.col("error").isNotNull(), F.col("valid")).alias("reason"))


def reconciliation(cards: DataFrame, embedded: DataFrame, skipped: DataFrame) -> DataFrame:
    """Cards, embedded and skipped by locale; they must add up."""
    embedded_cards = cards.join(embedded.select(F.col("card_id").alias("id")).distinct(), "id", "left_semi")
    n = lambda df: coverage.group_counts(df, "locale")
    return matching.reconcile([("detailed", n(cards)), ("embedded", n(embedded_cards)), ("skipped", n(skipped))], "locale")


def merge_corpus(old: dict[str, DataFrame], cards: DataFrame, embeddings: DataFrame) -> dict[str, DataFrame]:
    """First row wins for cards, embeddings and int8; last wins for equivalents."""
    numbered = lambda df: df.withColumn("__ord", F.lit(0))
    int8 = int8_table(embeddings)
    return {
        "cards": merging.insert_ignore(old["cards"], numbered(cards), ["id"], "__ord"),
        "embeddings": merging.insert_ignore(old["embeddings"], numbered(embeddings), ["card_id", "model_name", "variant_idx"], "__ord"),
        "embeddings_int8": merging.insert_ignore(old["embeddings_int8"], numbered(int8), ["card_id"], "__ord"),
        "card_equivalents": merging.upsert_last_wins(old["card_equivalents"], numbered(equivalents(cards)), ["card_id"], "__ord").drop("__ord"),
    }


def publish_corpus(tables: dict[str, DataFrame], path: str, least: int = 1000, tags: Sequence[str] = images.VARIANTS, identical_limit: int | None = None) -> None:
    """Every table written, checked and published; cards first, so that the others are checked against what was published."""
    spark = tables["cards"].sparkSession
    writers.publish(tables["cards"], f"{path}/cards", schemas.EMBEDDINGS_VERSION, lambda t, m: checks.union([checks.version(m, schemas.EMBEDDINGS_VERSION), checks.min_rows(t, least), checks.unique(t, ["id"])]), ["locale"])
    cards = writers.read_published(spark, f"{path}/cards")[0]
    writers.publish(tables["embeddings"], f"{path}/embeddings", schemas.EMBEDDINGS_VERSION, lambda t, m: checks.union([checks.check_embeddings(t, cards, m, schemas.EMBEDDINGS_VERSION, tags, least, identical_limit), checks.unique(t, ["card_id", "model_name", "variant_idx"]), checks.references_exist(t, "card_id", cards, "id")]))
    embeddings = writers.read_published(spark, f"{path}/embeddings")[0]
    writers.publish(tables["embeddings_int8"], f"{path}/embeddings_int8", schemas.EMBEDDINGS_VERSION, lambda t, m: checks.check_int8(embeddings, t))
    writers.publish(tables["card_equivalents"], f"{path}/card_equivalents", schemas.EMBEDDINGS_VERSION, lambda t, m: checks.union([checks.unique(t, ["card_id"]), checks.references_exist(t, "card_id", cards, "id")]))


def training_manifest(cards: DataFrame, files: DataFrame) -> DataFrame:
    """Training records of cards that have a picture. files: id, image_path."""
    out = cards.join(files, "id")
    return out.select(F.col("id").alias("card_id"), "name", "set_name", F.col("card_number").alias("number"), "image_path", "image_url", "locale", "upstream_id", "set_id", "equivalence_key")


def with_art_group(records: DataFrame) -> DataFrame:
    return records.withColumn("same_art_key", T.same_art_key(F.col("equivalence_key"), F.col("upstream_id"), F.col("name")))


def row_hash(seed: int, *columns: str) -> Column:
    """A hash that orders rows repeatably; both Spark and other engines compute md5 alike."""
    return F.md5(F.concat_ws("_", *[F.col(c).cast("string") for c in columns], F.lit(str(seed))))


def split(records: DataFrame, fraction: float = 0.1, seed: int = 42) -> DataFrame:
    """is_validation, stratified by locale."""
    return ranking.hash_split(records.withColumn("locale_group", T.locale_or_unknown(F.col("locale"))), "locale_group", row_hash(seed, "card_id"), fraction)


def benchmark_manifest(records: DataFrame, max_clips: int = 512, frames: int = 6, step_ms: int = 100, ratio: float = 0.6, seed: int = 42) -> DataFrame:
    """Frames of a benchmark: one clip a chosen record, designs of several printings first."""
    chosen = ranking.hard_and_singletons(with_art_group(records), "same_art_key", row_hash(seed, "card_id"), max_clips, ratio)
    clips = chosen.withColumn("clip_id", F.format_string("clip_%05d", "selection_index")).withColumnRenamed("group_size", "same_art_group_size")
    out = expand_frames(clips, frames, step_ms)
    return out.withColumn("perturbation_seed", F.pmod(F.xxhash64("clip_id", "frame_index", F.lit(seed)), F.lit(2**31 - 1))).drop("selection_index")


def subset_manifest(records: DataFrame, limit: int, seed: int = 42) -> DataFrame:
    return ranking.group_preserving_subset(with_art_group(records), "same_art_key", row_hash(seed, "card_id"), limit)


def stale_releases(releases: DataFrame, keep: int = 3, prefix: str = "embeddings-v") -> DataFrame:
    """Versioned releases with `stale`: beyond the newest `keep` by published, created and tag."""
    own = releases.where(F.col("tag_name").startswith(prefix))
    text = lambda c: F.coalesce(c, F.lit(""))
    return ranking.keep_newest(own, keep, [F.desc(text("published_at")), F.desc(text("created_at")), F.desc(text("tag_name"))])
