"""Data-quality checks: each is a row (check, observed, expected, passed); `enforce` raises with all that failed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vectors as V


class CheckFailed(RuntimeError):
    """Names every check that did not pass."""


def _row(df: DataFrame, name: str, observed: Column, expected: str, passed: Column) -> DataFrame:
    return df.select(F.lit(name).alias("check"), observed.cast("string").alias("observed"), F.lit(expected).alias("expected"), F.coalesce(passed, F.lit(False)).alias("passed"))


def union(checks: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), checks)


def enforce(checks: DataFrame) -> None:
    """Raise CheckFailed unless every check passed; the table of checks is small by construction."""
    failed = [r for r in checks.collect() if not r["passed"]]
    if failed:
        raise CheckFailed("; ".join(f"{r['check']}: {r['observed']}, expected {r['expected']}" for r in failed))


def min_rows(df: DataFrame, least: int, name: str = "row_count") -> DataFrame:
    return _row(df.agg(F.count("*").alias("n")), name, F.col("n"), f">= {least}", F.col("n") >= least)


def version(metadata: DataFrame, expected: int) -> DataFrame:
    one = metadata.agg(F.max("schema_version").alias("v"), F.count("*").alias("n"))
    return _row(one, "schema_version", F.col("v"), str(expected), (F.col("v") == expected) & (F.col("n") == 1))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that stand in more than one row, with their number."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return _row(duplicate_keys(df, keys).agg(F.count("*").alias("n")), f"unique({', '.join(keys)})", F.col("n"), "0", F.col("n") == 0)


def not_one_primary(df: DataFrame, key: str, flag: str) -> DataFrame:
    """Keys whose primary rows are not exactly one."""
    return df.groupBy(key).agg(F.sum(flag).alias("primaries")).where("not (primaries <=> 1)")


def one_primary(df: DataFrame, key: str = "card_id", flag: str = "is_primary") -> DataFrame:
    return _row(not_one_primary(df, key, flag).agg(F.count("*").alias("n")), "one_primary", F.col("n"), "0", F.col("n") == 0)


def references_exist(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    gone = child.join(parent.select(F.col(parent_key).alias("__p")).distinct(), F.col(key) == F.col("__p"), "left_anti")
    return _row(gone.agg(F.count("*").alias("n")), f"references({key})", F.col("n"), "0", F.col("n") == 0)


def check_prices(prices: DataFrame, metadata: DataFrame, expected_version: int, least: int, cards: DataFrame | None = None) -> DataFrame:
    """Version, row count, one primary a card, one row a card and source, and (with cards) no orphans, reused rows included."""
    out = [version(metadata, expected_version), min_rows(prices, least), one_primary(prices), unique(prices, ["card_id", "source_name"])]
    if cards is not None:
        out.append(references_exist(prices, "card_id", cards, "id"))
    return union(out)


def check_embeddings(embeddings: DataFrame, cards: DataFrame, metadata: DataFrame, expected_version: int, tags: Sequence[str], least: int, identical_limit: int | None = None) -> DataFrame:
    """Version; rows per card and tag; dimensions; unit-like norms and finite values of all rows; distinct clean vectors."""
    per_card = embeddings.groupBy("card_id").agg(F.count("*").alias("n")).agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    n_tags = len(tags)
    counts = embeddings.agg(F.count("*").alias("n")).crossJoin(cards.agg(F.count("*").alias("cards")))
    found = embeddings.agg(F.sort_array(F.collect_set("variant_tag")).alias("tags"))
    bad = F.col("d.norm").isNull() | (F.col("d.norm") < 0.5) | F.col("d.has_nan") | F.col("d.has_inf") | (F.col("d.dim") != F.col("dim")) | (F.col("dim") <= 0)
    vectors = embeddings.select("dim", V.diagnostics(F.col("vector")).alias("d")).agg(F.count_if(F.coalesce(bad, F.lit(True))).alias("n"))
    clean = embeddings.where("variant_idx = 0").agg(F.count("*").alias("n"), F.count_distinct(F.xxhash64("vector")).alias("d"))
    models = embeddings.select("model_name", "dim").distinct().agg(F.count("*").alias("n"))
    out = [
        version(metadata, expected_version), min_rows(cards, least, "card_count"),
        _row(counts, "rows_per_card", F.col("n"), f"cards * {n_tags}", F.col("n") == F.col("cards") * n_tags),
        _row(per_card, "variants", F.concat_ws("..", "lo", "hi"), str(n_tags), (F.col("lo") == n_tags) & (F.col("hi") == n_tags)),
        _row(found, "tags", F.array_join("tags", ","), ",".join(sorted(tags)), F.col("tags") == F.array(*map(F.lit, sorted(tags)))),
        _row(vectors, "bad_vectors", F.col("n"), "0", F.col("n") == 0),
        _row(clean, "distinct_vectors", F.col("d"), ">= max(2, rows / 2)", F.col("d") >= F.greatest(F.lit(2), F.floor(F.col("n") / 2))),
        _row(models, "one_model", F.col("n"), "1", F.col("n") == 1),
    ]
    if identical_limit is not None:
        same = embeddings.where("variant_idx = 0").groupBy(F.xxhash64("vector").alias("h")).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n"))
        out.append(_row(same, "identical_vectors", F.col("n"), f"<= {identical_limit}", F.col("n") <= identical_limit))
    return union(out)


def int8_errors(embeddings: DataFrame, int8: DataFrame) -> DataFrame:
    """Mean and largest cosine and distance error of all clean rows, and rows that had to be skipped."""
    both = embeddings.where("variant_idx = 0").join(int8.select("card_id", "vector_int8"), "card_id")
    e = both.select(V.quantization_error(F.col("vector"), F.col("vector_int8")).alias("e"))
    return e.agg(F.count("e").alias("rows"), F.count_if(F.col("e").isNull()).alias("skipped"), F.avg("e.cosine_error").alias("mean_cosine_error"), F.max("e.cosine_error").alias("max_cosine_error"), F.avg("e.l2_error").alias("mean_l2_error"), F.max("e.l2_error").alias("max_l2_error"))


def check_int8(embeddings: DataFrame, int8: DataFrame, most: float = 0.01) -> DataFrame:
    """The mean cosine error is small enough, and every clean row has its quantized row."""
    n = embeddings.where("variant_idx = 0").agg(F.count("*").alias("n")).crossJoin(int8.agg(F.count("*").alias("m")))
    return union([_row(int8_errors(embeddings, int8), "int8_cosine_error", F.col("mean_cosine_error"), f"<= {most}", F.col("mean_cosine_error") <= most), _row(n, "int8_rows", F.col("m"), "clean rows", F.col("n") == F.col("m"))])


def check_reconciled(counts: DataFrame, whole: str, parts: Sequence[str], key: str) -> DataFrame:
    """Per key the parts add up to the whole."""
    off = counts.where(F.col(whole) != sum((F.col(p) for p in parts), F.lit(0)))
    return _row(off.agg(F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_list(key)), ",").alias("at")), "reconciled", F.concat_ws(" at ", F.col("n").cast("string"), F.nullif("at", F.lit(""))), "0", F.col("n") == 0)


def gate(values: Mapping[str, float | str | None], thresholds: Mapping[str, float], equal: Mapping[str, str] | None = None) -> list[str]:
    """Names of measures under their threshold or unequal to what they must be; promotion and production gates pass on []."""
    low = [f"{k} {values.get(k)} < {t}" for k, t in thresholds.items() if values.get(k) is None or float(values[k]) < t]  # type: ignore[arg-type]
    return low + [f"{k} differs" for k, v in (equal or {}).items() if values.get(k) != v]
