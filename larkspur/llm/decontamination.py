"""Benchmark decontamination: size-partitioned MinHash containment search, then exact shingle containment. DataFrame only.

Items are dealt into size classes by powers of two of their number of distinct shingles. Each item keeps its smallest
shingle hashes (its bottom-k MinHash sketch), k = floor((1 - threshold) * upper size of its class) + 1. A text that holds
`threshold` of an item's shingles misses at most (1 - threshold) of them, so it must hold one of any k: no leak escapes the
sketch, whatever the length of the text around it. Texts probe the sketches with their shingles below the largest kept
hash. The candidates are then counted exactly, by the words themselves. Where the items are too many to broadcast, a
document's equal shingles meet before the join, and the join's keys are split by AQE where many documents share a shingle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: ASCII space, control and punctuation: what stands between words.
BETWEEN = r"[\x00-/:-@\[-`{-\x7F]+"


def words(text: Column) -> Column:
    """The lower-cased words of a text as an array."""
    return F.array_remove(F.split(F.lower(text), BETWEEN), "")


def shingles(df: DataFrame, keep: list[str], text: str, width: int, spelt: bool = False) -> DataFrame:
    """A row for each run of `width` words: `keep`, __h (hash of the run) and, if `spelt`, __s (its words, one space between)."""
    w = F.col("__w")
    runs = F.arrays_zip(*[w if k == 0 else F.slice(w, F.lit(k + 1), F.greatest(F.size(w), F.lit(1))) for k in range(width)])
    cols = ["__z.__w", *(f"__z.`{k}`" for k in range(1, width))]
    return (
        df.select(*keep, words(F.col(text)).alias("__w"))
        .where(F.size("__w") >= width)
        .select(*keep, F.explode(runs).alias("__z"))
        .where(F.col(cols[-1]).isNotNull())
        .select(*keep, F.xxhash64(*[F.col(c) for c in cols]).alias("__h"), *([F.concat_ws(" ", *cols).alias("__s")] if spelt else []))
    )


def matches(docs: DataFrame, items: DataFrame, threshold: float = 0.8, width: int = 5, inside: int = 3, text: str = "text", doc_id: str = "doc_id", item_id: str = "item_id", item_text: str = "text", broadcast_rows: int = common.BROADCAST_ROWS) -> DataFrame:
    """Pairs of a document and an item of whose distinct shingles it holds at least `threshold`.

    Returns __key (see common.row_key), doc_id, item_id, item_shingles, shared, containment. Rows with one doc_id are one
    document: the shingles of all its rows count together. An item without a run of `width` words has its whole run of
    words as its one shingle: with `inside` words or more it is found anywhere in a text, with fewer (it would be found in
    clean texts) in a text that holds nothing else. Null, empty and wordless texts or items match nothing; items without
    an id are left out, and repeated item rows count once. An empty table gives no rows.
    """
    named = items.select(F.col(item_id).alias("__item"), F.col(item_text).alias("__text")).where("__item is not null")
    item_rows = shingles(named, ["__item"], "__text", width, spelt=True)
    item_rows = common.cut(item_rows.select("__item", "__h", "__s").distinct())
    sizes = item_rows.groupBy("__item").agg(F.count("*").alias("__size"))
    upper = F.pow(F.lit(2), F.ceil(F.log2("__size")))
    sketch = item_rows.join(sizes.withColumn("__k", F.floor((1 - threshold) * upper + 1e-9) + 1), "__item")
    lists = sketch.groupBy("__item").agg(F.first("__k").alias("__k"), F.sort_array(F.collect_list("__h")).alias("__all"))
    sketch = common.cut(lists.select("__item", F.explode(F.slice("__all", F.lit(1), F.col("__k").cast("int"))).alias("__h")))
    bound = sketch.agg(F.max("__h")).first()[0]

    base = docs.select(common.row_key(doc_id, text).alias("__key"), F.col(doc_id).alias("doc_id"), F.col(text).alias("__text"))
    probe = shingles(base, ["__key", "doc_id"], "__text", width).where(F.col("__h") <= F.lit(bound).cast("long"))
    few = _few(sketch, broadcast_rows)
    found = probe.join(F.broadcast(sketch), "__h") if few else probe.distinct().join(sketch, "__h")
    candidates = common.cut(found.select("__key", "doc_id", "__item").distinct())

    again = base.join(common.broadcast_if_small(candidates.select("__key").distinct(), broadcast_rows), "__key", "left_semi")
    asked = item_rows.join(common.broadcast_if_small(candidates.select("__item").distinct(), broadcast_rows), "__item", "left_semi")
    held = shingles(again, ["__key", "doc_id"], "__text", width, spelt=True)
    if _few(item_rows, broadcast_rows):
        hits = held.join(F.broadcast(asked), ["__h", "__s"])
    else:
        hits = held.distinct().join(asked, ["__h", "__s"])
    shared = hits.groupBy("__key", "doc_id", "__item", "__s").agg(F.lit(1).alias("__one")).groupBy("__key", "doc_id", "__item").agg(F.count("*").alias("shared"))
    kept = shared.join(candidates, ["__key", "__item"], "left_semi").join(common.broadcast_if_small(sizes, broadcast_rows), "__item")
    brief = _brief(base, named.join(item_rows.select("__item").distinct(), "__item", "left_anti"), width, inside, broadcast_rows)
    kept = kept.select("__key", "doc_id", "__item", "__size", "shared")
    every = kept if brief is None else kept.unionByName(brief)
    return every.where(F.col("shared") >= F.ceil(F.col("__size") * threshold - 1e-9)).select("__key", "doc_id", F.col("__item").alias("item_id"), F.col("__size").alias("item_shingles"), "shared", (F.col("shared") / F.col("__size")).alias("containment"))


def _brief(base: DataFrame, items: DataFrame, width: int, inside: int, limit: int) -> DataFrame | None:
    """Documents and items of fewer than `width` words, with the number of an item's runs and of those found; None if no item is so short."""
    spelt = items.select("__item", words(F.col("__text")).alias("__w")).where(F.size("__w") > 0)
    runs = common.cut(spelt.select("__item", F.size("__w").alias("__n"), F.concat_ws(" ", "__w").alias("__s")).distinct())
    lengths = sorted(r["__n"] for r in runs.select("__n").distinct().collect())  # fewer than `width` numbers
    if not lengths:
        return None
    parts = [shingles(base, ["__key", "doc_id"], "__text", n, spelt=True).select("__key", "doc_id", "__s") for n in lengths if n >= inside]
    alone = [n for n in lengths if n < inside]
    if alone:
        whole = base.select("__key", "doc_id", words(F.col("__text")).alias("__w")).where(F.size("__w").isin(alone))
        parts.append(whole.select("__key", "doc_id", F.concat_ws(" ", "__w").alias("__s")))
    held = reduce(DataFrame.unionByName, parts)
    hits = held.join(F.broadcast(runs), "__s") if _few(runs, limit) else held.distinct().join(runs, "__s")
    found = hits.groupBy("__key", "doc_id", "__item", "__s").agg(F.lit(1).alias("__one")).groupBy("__key", "doc_id", "__item").agg(F.count("*").alias("shared"))
    return found.join(common.broadcast_if_small(runs.groupBy("__item").agg(F.count("*").alias("__size")), limit), "__item").select("__key", "doc_id", "__item", "__size", "shared")


def _few(df: DataFrame, limit: int) -> bool:
    return df.limit(limit + 1).count() <= limit


def decontaminate(docs: DataFrame, items: DataFrame, **options: object) -> DataFrame:
    """`docs` without the documents that hold an item; all columns as they were. Null and short texts stay."""
    text, doc_id = str(options.pop("text", "text")), str(options.pop("doc_id", "doc_id"))
    inner, at = common.numbered(docs)
    leaks = matches(inner, items, text=at[text], doc_id=at[doc_id], **options).select(F.col("__key").alias("__leak")).distinct()
    keyed = inner.withColumn("__leak", common.row_key(at[doc_id], at[text]))
    return keyed.join(common.broadcast_if_small(common.cut(leaks)), "__leak", "left_anti").drop("__leak").toDF(*docs.columns)
