"""Metrics of nearest-neighbour retrieval, and clips of ordered frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .hamming import greedy_dedupe as greedy_dedupe
from .neighbours import knn as knn
from .order_statistics import exact_median
def per_query(top: DataFrame) -> DataFrame:
    """One row a query from knn(): top1_id, top1_score, margin (to the second, or the score itself), correct_rank, top_ids."""
    two = top.groupBy("query_id").agg(
        F.max(F.when(F.col("rank") == 1, F.col("ref_id"))).alias("top1_id"), F.max(F.when(F.col("rank") == 1, F.col("score"))).alias("top1_score"),
        F.max(F.when(F.col("rank") == 2, F.col("score"))).alias("second"), F.max("correct_rank").alias("correct_rank"),
        F.transform(F.sort_array(F.collect_list(F.struct("rank", "ref_id", "score"))), lambda x: F.struct(x["ref_id"].alias("ref_id"), x["score"].alias("score"))).alias("top"),
    )
    return two.withColumn("margin", F.col("top1_score") - F.coalesce("second", F.lit(0.0))).drop("second")


def confusions(rows: DataFrame, references: DataFrame, ref_id: str, group: Column, name: Column, query_group: str = "query_group", query_name: str = "query_name", true_id: str = "true_id") -> DataFrame:
    """rows (per query, with its group, name and true id) with `confused`: top 1 is wrong but of the same group or name."""
    side = references.select(F.col(ref_id).alias("__r"), group.alias("predicted_group"), name.alias("predicted_name"))
    wrong = F.col("top1_id") != F.col(true_id)
    alike = (F.col("predicted_group") == F.col(query_group)) | (F.col("predicted_name") == F.col(query_name))
    return rows.join(side, F.col("top1_id") == F.col("__r"), "left").drop("__r").withColumn("confused", F.coalesce(wrong & alike, F.lit(False)))


def metrics(rows: DataFrame, *by: str, k: int = 5) -> DataFrame:
    """Recall at 1 and k, reciprocal and mean rank, top-1 score, margin and confusion rate of per-query rows, per group."""
    share = lambda c: F.avg(c.cast("double"))
    grouped = rows.groupBy(*by) if by else rows.groupBy()
    out = grouped.agg(
        F.count("*").alias("sample_count"), share(F.col("correct_rank") == 1).alias("recall_at_1"), share(F.col("correct_rank") <= k).alias(f"recall_at_{k}"),
        F.avg(1.0 / F.col("correct_rank")).alias("mean_reciprocal_rank"), F.avg("correct_rank").alias("mean_rank"),
        F.avg("top1_score").alias("mean_top1_score"), F.avg("margin").alias("mean_top1_margin"), share(F.col("confused")).alias("same_art_top1_confusion_rate"),
    )
    median = exact_median(rows, by, "top1_score", "median_top1_score").withColumnsRenamed({b: f"__{b}" for b in by})
    same = F.lit(True)
    for b in by:
        same = same & F.col(b).eqNullSafe(F.col(f"__{b}"))
    return out.join(median, same, "left").drop(*[f"__{b}" for b in by])  # without `by` one row on either side


def failure_examples(rows: DataFrame, k: int = 5, limit: int = 20) -> DataFrame:
    """The first queries, by id, whose true reference is not among the first k."""
    return rows.where(F.col("correct_rank") > k).orderBy("query_id").limit(limit)


def clip_first_hits(frames: DataFrame, clip: str, frame: str, rank: str, k: int = 5) -> DataFrame:
    """Per clip the first frame whose correct rank is 1, and the first where it is within k; null where none is."""
    first = lambda c: F.min(F.when(c, F.col(frame)))
    return frames.groupBy(clip).agg(first(F.col(rank) == 1).alias("first_top1_frame"), first(F.col(rank) <= k).alias("first_topk_frame"))


def clip_metrics(frames: DataFrame, clip: str, frame: str, rank: str, k: int = 5) -> DataFrame:
    """Clips, share with any frame within k, mean first frames (null when none)."""
    per = clip_first_hits(frames, clip, frame, rank, k)
    return per.agg(F.count("*").alias("clip_count"), F.avg(F.col("first_topk_frame").isNotNull().cast("double")).alias("clip_topk_success_rate"), F.avg("first_top1_frame").alias("mean_first_top1_frame"), F.avg("first_topk_frame").alias("mean_first_topk_frame"))


def sampled_pairs(vectors: DataFrame, key: str, left: int = 4, right: int = 6) -> DataFrame:
    """Pairs i < j of the first rows by key, i among the first `left` and j among the first `right`, with their inner product."""
    from ..functions.vectors import dot

    first = vectors.orderBy(key).limit(right).withColumn("i", F.row_number().over(W.orderBy(key)))
    a, b = first.alias("a"), first.alias("b")
    pairs = a.join(b, (F.col("a.i") < F.col("b.i")) & (F.col("a.i") <= left))
    return pairs.select(F.col(f"a.{key}").alias("left_id"), F.col(f"b.{key}").alias("right_id"), dot(F.col("a.vector"), F.col("b.vector")).alias("cosine"))
