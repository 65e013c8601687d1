"""Joins and greedy selection by the Hamming distance of 64-bit hashes.

Two hashes within a distance d agree in at least one of d + 1 bands of their bits (pigeonhole), so candidates meet by band.
Beyond MOST_BANDS bands would be so narrow that they tell nothing apart, and rows of a group meet in dealt portions instead.
Rows of equal hashes are one class: classes are joined, and each row has its class and the number of its links.

The greedy pass (a frame is kept if it is farther than d from every kept frame before it) is the lexicographically first
maximal independent set of the near pairs. It is found in rounds: ranges of frames decide in parallel what depends on
nothing outside of them; then what lies near a newly kept frame goes, and the next round has only what is still open.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..tables import written

MOST_BANDS = 16
#: Frames of a range, which one task goes through in order.
RANGE = 4_096
#: Rows of a portion where there are no bands.
PORTION = 50_000
#: Classes that may be broadcast, after a count.
BROADCAST_ROWS = 250_000


def _masks(distance: int) -> list[int]:
    """The bits of each band, as signed 64-bit numbers; one band without bits if they would be too narrow."""
    if distance + 1 > MOST_BANDS:
        return [0]
    edges = [64 * i // (distance + 1) for i in range(distance + 2)]
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _banded(df: DataFrame, bits: str, masks: list[int], portions: int, copies: bool) -> DataFrame:
    """Each row once a band, and dealt to one portion or copied to all."""
    bands = F.array(*[F.struct(F.lit(i).alias("band"), F.col(bits).bitwiseAND(F.lit(m).cast("long")).alias("value")) for i, m in enumerate(masks)])
    out = df.withColumn("__b", F.explode(bands)).select("*", "__b.band", "__b.value").drop("__b")
    if portions == 1:
        return out.withColumn("portion", F.lit(0))
    return out.withColumn("portion", F.explode(F.sequence(F.lit(0), F.lit(portions - 1))) if copies else F.pmod(F.xxhash64(bits, F.lit(5)), F.lit(portions)).cast("int"))


def _portions(masks: list[int], rows: int) -> int:
    return 1 if len(masks) > 1 else min(256, max(1, -(-rows // PORTION)))


def hamming_join(left: DataFrame, right: DataFrame, by: str, left_bits: str, right_bits: str, distance: int) -> DataFrame:
    """Pairs of a left and a right row of one `by` whose hashes are within `distance`, each once, with `distance`.

    The frames share the column `by` alone. A pair counts in the first band that it agrees in, so none has to be told apart
    afterwards. Null hashes and groups take no part.
    """
    masks = _masks(distance)
    portions = _portions(masks, left.count())
    a, b = _banded(left, left_bits, masks, portions, False), _banded(right, right_bits, masks, portions, True)
    both = a.join(b, [by, "band", "value", "portion"])
    apart = F.col(left_bits).bitwiseXOR(F.col(right_bits))
    first = F.coalesce(*[F.when(apart.bitwiseAND(F.lit(m).cast("long")) == 0, F.lit(i)) for i, m in enumerate(masks)])
    return both.withColumn("distance", F.bit_count(apart)).where((F.col("distance") <= distance) & (F.col("band") == first)).drop("band", "value", "portion")


def hamming_classes(rows: DataFrame, by: str, key: str, bits: str, distance: int) -> tuple[DataFrame, DataFrame]:
    """(members, pairs): the rows of one `by` whose hashes are within `distance`, without a pair for each two copies.

    members: by, key, class_key (the smallest key with this hash in its `by`), and links (other rows within `distance`, copies
    included), one for each row; without a hash or a group there is no class and no link. pairs: by, left_key, right_key (the
    class keys of two different hashes, the smaller first), left_rows, right_rows, distance.
    """
    classes = rows.where(F.col(by).isNotNull() & F.col(bits).isNotNull()).groupBy(by, bits).agg(F.min(key).alias("class_key"), F.count("*").alias("rows"))
    classes = written(classes)
    left = classes.select(by, F.col(bits).alias("__left"), F.col("class_key").alias("left_key"), F.col("rows").alias("left_rows"))
    right = classes.select(by, F.col(bits).alias("__right"), F.col("class_key").alias("right_key"), F.col("rows").alias("right_rows"))
    met = written(hamming_join(left, right, by, "__left", "__right", distance))
    # a class meets itself too, and a row is none of its own links
    links = met.groupBy(by, F.col("__left").alias(bits)).agg((F.sum("right_rows") - 1).alias("links"))
    told = classes.drop("rows").join(links, [by, bits])
    members = rows.select(by, key, bits).join(F.broadcast(told) if classes.count() <= BROADCAST_ROWS else told, [by, bits], "left")
    pairs = met.where("left_key < right_key").select(by, "left_key", "right_key", "left_rows", "right_rows", "distance")
    return members.select(by, key, "class_key", F.coalesce("links", F.lit(0)).alias("links")), pairs


def _near_earlier(rows: DataFrame, others: DataFrame, distance: int, total: int, more: Column | None = None) -> DataFrame:
    """(g, h) of rows (g, h, o, ...) that have a row of `others` before them within `distance`; no pair is made."""
    masks = _masks(distance)
    portions = _portions(masks, total)
    a = _banded(rows, "h", masks, portions, False).alias("a")
    b = _banded(others.select(*[F.col(c).alias(c) for c in others.columns]), "h", masks, portions, True).alias("b")
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("g", "band", "value", "portion")]
    before = F.struct(F.col("b.o"), F.col("b.h")) < F.struct(F.col("a.o"), F.col("a.h"))
    near = F.bit_count(F.col("a.h").bitwiseXOR(F.col("b.h"))) <= distance
    condition = same[0] & same[1] & same[2] & same[3] & before & near
    return a.join(b, condition if more is None else condition & more, "left_semi").select("g", "h").distinct()


def greedy_dedupe(frames: DataFrame, by: str, order: str, bits: str, distance: int, max_kept: int = 0, size: int = RANGE) -> DataFrame:
    """by, order, bits of the frames that a greedy pass keeps, going through each `by` (one video) in order.

    A frame is kept if it is farther than `distance` from every kept one before it; max_kept 0: no limit. Of equal hashes
    only the first can be kept, so the others go beforehand; of one place in the order the smaller hash is first. Null
    hashes take no part. A round holds `size` frames in a task, and no frame waits for more rounds than there are ranges
    before it in its video.
    """
    g_type, o_type = dict(frames.dtypes)[by], dict(frames.dtypes)[order]
    rows = frames.where(F.col(bits).isNotNull()).groupBy(F.col(by).alias("g"), F.col(bits).cast("long").alias("h")).agg(F.min(order).alias("o"))
    open_, kept = written(rows.select(F.col("g"), "h", "o")), None
    schema = f"g {g_type}, h long, o {o_type}, range int, kept boolean"

    def decide(pdf: pd.DataFrame) -> pd.DataFrame:
        """Kept (true) and open (null) frames of a range; what is near a kept one before it is left out."""
        pdf = pdf.sort_values(["o", "h"], kind="stable")
        out = []
        for _, one in pdf.groupby("g", sort=False, dropna=False):
            h, outside = one["h"].to_numpy().astype(np.int64).view(np.uint64), one["outside"].to_numpy()
            verdict = np.zeros(len(h), np.int8)  # 1 kept, 2 open
            live: list[int] = []
            for i in range(len(h)):
                near = [j for j, n in zip(live, np.bitwise_count(h[live] ^ h[i]), strict=True) if n <= distance] if live else []
                if any(verdict[j] == 1 for j in near):
                    continue
                verdict[i] = 2 if near or outside[i] else 1
                live.append(i)
            mine = one[verdict > 0]
            out.append(mine.assign(kept=pd.array([True if v == 1 else None for v in verdict[verdict > 0]], "boolean")))
        return pd.concat(out)[["g", "h", "o", "range", "kept"]]

    while total := open_.count():
        ranges = -(-total // size)
        if ranges > 1:
            dealt = written(open_.select("g", "h", "o").repartitionByRange(ranges, "g", "o").withColumn("range", F.spark_partition_id()))
            waiting = _near_earlier(dealt, dealt, distance, total, F.col("a.range") != F.col("b.range")).withColumn("outside", F.lit(True))
            dealt = dealt.join(waiting.withColumnRenamed("g", "g2").withColumnRenamed("h", "h2"), F.col("g").eqNullSafe(F.col("g2")) & (F.col("h") == F.col("h2")), "left").select("g", "h", "o", "range", F.coalesce("outside", F.lit(False)).alias("outside"))
        else:
            dealt = open_.select("g", "h", "o", F.lit(0).alias("range"), F.lit(False).alias("outside"))
        decided = written(dealt.groupBy("range").applyInPandas(decide, schema))
        new = decided.where("kept").select("g", "h", "o", "range")
        kept = new.select("g", "h", "o") if kept is None else kept.unionByName(new.select("g", "h", "o"))
        rest = decided.where("kept is null").select("g", "h", "o", "range")
        if ranges == 1:
            break
        gone = _near_earlier(rest, new, distance, total, F.col("a.range") != F.col("b.range"))
        open_ = written(rest.join(gone, ["g", "h"], "left_anti").select("g", "h", "o"))
    kept = open_ if kept is None else kept
    if max_kept:
        from .ranking import limit_per_group

        kept = limit_per_group(kept, ["g"], [F.col("o"), F.col("h")], max_kept)
    return kept.select(F.col("g").alias(by), F.col("o").alias(order), F.col("h").cast(dict(frames.dtypes)[bits]).alias(bits))
