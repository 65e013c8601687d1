"""Mixing sources to target weights by the cube method.

A source's rate is its target over its size. Every document of the source is taken floor(rate) times, and once more with
the probability that is left. Those extra copies are drawn by the cube method: in blocks of a source's documents the
vector of probabilities moves through the null space of the balancing constraints (words, documents) until at most two
probabilities of a block are open; the open ones meet in fewer blocks, round by round, until one block a source is left
and lands: its at most two open documents are closed, and exchanges of one document for another, which keep the count,
bring the words near their total. Each round hands on two documents a block, so no task ever holds more than a block.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

WEIGHTS = (5.0, 2.0, 1.0)
MAX_REPEATS = 3.0
#: Documents that one flight holds.
BLOCK = 4096


def word_count(text: Column) -> Column:
    """Runs of anything but ASCII white space; null has none."""
    words = F.size(F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), ""))
    return F.when(text.isNull(), F.lit(0)).otherwise(words).cast("long")


def targets(sizes: Sequence[tuple[str | None, int]], weights: Sequence[float] = WEIGHTS, total: float = 1.0, most: float = MAX_REPEATS) -> dict[str | None, float]:
    """Target of each source: a share of `total` x all sizes by weight; above `most` x its size the excess is dealt to the rest again."""
    order = sorted(sizes, key=lambda s: (s[0] is None, s[0] or ""))
    weight = {s: weights[i % len(weights)] for i, (s, _) in enumerate(order)}
    limit = {s: most * n for s, n in order}
    left, free, out = total * sum(n for _, n in order), [s for s, _ in order], {}
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > limit[s]]
        if not over:
            return out | share
        for s in over:
            out[s] = limit[s]
            left -= limit[s]
        free = [s for s in free if s not in over]
    return out


def flight(p: np.ndarray, sizes: np.ndarray, draw: np.random.Generator) -> np.ndarray:
    """Move probabilities through the null space of (size, 1) rows until at most two are open; sums of both are kept."""
    p = p.copy()
    eps = 1e-9
    own: list[int] = []
    rest = iter(np.flatnonzero((p > eps) & (p < 1 - eps)))
    while True:
        for i in rest:
            own.append(int(i))
            if len(own) == 3:
                break
        if len(own) < 3:
            return p
        a, b, c = (float(sizes[i]) for i in own)
        u = (b - c, c - a, a - b)
        if not any(u):
            u = (1.0, -1.0, 0.0)
        up = down = float("inf")
        for i, v in zip(own, u, strict=True):
            if v > 0:
                up, down = min(up, (1 - p[i]) / v), min(down, p[i] / v)
            elif v < 0:
                up, down = min(up, p[i] / -v), min(down, (1 - p[i]) / -v)
        step = up if draw.random() * (up + down) < down else -down
        for i, v in zip(own, u, strict=True):
            q = p[i] + step * v
            p[i] = 0.0 if q < eps else 1.0 if q > 1 - eps else q
        own = [i for i in own if 0 < p[i] < 1]


def landing(p: np.ndarray, sizes: np.ndarray, due: float, docs: float, tolerance: float = 1e-3, most: int = 16, coarse: float = 0.02) -> np.ndarray:
    """Close the last open probabilities with their number next to `docs` and then the words nearest to `due`; then, while
    the words are off by more than `tolerance`, exchange a taken for a left document, which keeps the number of documents.
    Where that leaves them off by more than `coarse`, one document is turned alone.
    """
    p = p.copy()
    left = np.flatnonzero((p > 0) & (p < 1))
    if len(left):
        closed, number = float(sizes[p >= 1].sum()), int((p >= 1).sum())
        ways = [[(w >> k) & 1 for k in range(len(left))] for w in range(1 << len(left))]
        ways = [w for w in ways if abs(number + sum(w) - docs) < 1 + 1e-6] or ways
        p[left] = min(ways, key=lambda w: (abs(closed + float(np.dot(w, sizes[left])) - due), w))
    for _ in range(most):
        off = float(sizes[p >= 1].sum()) - due
        on, out = np.flatnonzero(p >= 1), np.flatnonzero(p <= 0)
        if abs(off) <= tolerance * due or not len(on) or not len(out):
            break
        out = out[np.argsort(sizes[out], kind="stable")]
        come = sizes[out]
        spot = np.clip(np.searchsorted(come, sizes[on] - off), 1, max(1, len(come) - 1))
        near = np.stack([np.minimum(spot - k, len(come) - 1) for k in (0, 1)])
        gaps = np.abs(off - sizes[on] + come[near])
        k, i = np.unravel_index(gaps.argmin(), gaps.shape)
        if gaps[k, i] >= abs(off):
            break
        p[on[i]], p[out[near[k, i]]] = 0.0, 1.0
    off = float(sizes[p >= 1].sum()) - due
    if abs(off) > coarse * due:  # few documents: one more or less comes nearer than any exchange
        turn = np.where(p >= 1, -sizes, sizes)
        i = int(np.abs(off + turn).argmin())
        if abs(off + turn[i]) < abs(off):
            p[i] = 1.0 - p[i]
    return p


def _round(seed: int):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["__order", "__unit"], kind="stable")
        draw = np.random.default_rng([seed, int(pdf["__order"].iloc[0]) & 0xFFFFFFFF, len(pdf)])
        sizes, due, docs = pdf["__size"].to_numpy(float), float((pdf["__p"] * pdf["__size"]).sum()), float(pdf["__p"].sum())
        p = flight(pdf["__p"].to_numpy(float), sizes, draw)
        if pdf["__last"].iloc[0]:  # the source's only block
            p = landing(p, sizes, due, docs)
        return pdf.assign(__p=p)[["__unit", "__source", "__size", "__order", "__p"]]

    return run


def select_copies(units: DataFrame, block: int = BLOCK, seed: int = 11) -> DataFrame:
    """units: __unit, __source, __size (of all its rows), __p (0 to 1). Returns __unit, __source and __extra (0 or 1)."""
    schema = f"__unit string, __source {dict(units.dtypes)['__source']}, __size long, __order long, __p double"
    level = units.select("__unit", "__source", "__size", F.xxhash64("__unit", F.lit(seed)).alias("__order"), "__p")
    done = None
    turn = 0
    while True:
        live = level.where("__p > 0 and __p < 1")
        # a source of n open units is cut into blocks of about half a block, one block alone if they fit
        counts = live.groupBy(F.col("__source").alias("__c")).agg(F.count("*").alias("n"))
        counts = common.cut(counts.withColumn("__blocks", F.when(F.col("n") <= block, 1).otherwise(F.ceil(2 * F.col("n") / block))))
        most = counts.agg(F.max("n")).first()[0] or 0
        closed = level.where("__p <= 0 or __p >= 1")
        done = closed if done is None else done.unionByName(closed)
        if not most:
            break
        placed = live.join(common.broadcast_if_small(counts.drop("n")), F.col("__source").eqNullSafe(F.col("__c")))
        cell = F.pmod(F.xxhash64("__order", F.lit(turn)), F.col("__blocks"))
        placed = placed.withColumns({"__cell": cell, "__last": F.col("__blocks") == 1}).drop("__c", "__blocks")
        flown = placed.groupBy("__source", "__cell").applyInPandas(_round(seed + turn), schema)
        level = common.cut(flown)
        turn += 1
    return done.select("__unit", "__source", F.col("__p").cast("int").alias("__extra"))


def mix_plan(docs: DataFrame, weights: Sequence[float] = WEIGHTS, total: float = 1.0, most: float = MAX_REPEATS, seed: int = 11, block: int = BLOCK, text: str = "text", source: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """A row for each row of `docs`: doc_id, source, size, source_size, target, copies, taken, and __unit.

    Rows with one doc_id in one source (with one text where doc_id is null) are one unit, taken alike, so repeated rows
    agree. Null and empty texts have size 0 and are balanced by document counts alone; a source of size 0 has target 0 and
    nothing taken. The null source is a source, the last. An empty table gives no rows. The number of sources must
    fit on the driver (one number each); documents never do.
    """
    base = docs.select(F.col(doc_id).alias("doc_id"), common.row_key(doc_id, text).alias("__unit"), F.col(source).cast("string").alias("__source"), word_count(F.col(text)).alias("size"))
    base = common.cut(base)
    sums = [(r[0], r[1]) for r in base.groupBy("__source").agg(F.sum("size")).collect()]
    due = targets(sums, weights, total, most)
    rates = [(s, n, float(due[s]), float(due[s] / n) if n else 0.0) for s, n in sums]
    rates = base.sparkSession.createDataFrame(rates, "__s string, source_size long, target double, __rate double")
    rates = common.broadcast_if_small(rates)
    units = base.groupBy("__unit", "__source").agg(F.sum("size").alias("__size")).join(rates, F.col("__source").eqNullSafe(F.col("__s")))
    whole = F.floor(F.col("__rate") + 1e-9)
    units = units.select("__unit", "__source", "__size", F.greatest(F.lit(0.0), F.col("__rate") - whole).alias("__p"))
    extra = select_copies(units, block, seed).withColumnRenamed("__unit", "__u").withColumnRenamed("__source", "__t")
    out = base.join(extra, (F.col("__unit") == F.col("__u")) & F.col("__source").eqNullSafe(F.col("__t"))).join(rates, F.col("__source").eqNullSafe(F.col("__s")))
    copies = (whole + F.col("__extra")).cast("int")
    return out.select("doc_id", F.col("__source").alias("source"), "size", "source_size", "target", copies.alias("copies"), (F.col("size") * copies).cast("long").alias("taken"), "__unit")


def mix(docs: DataFrame, **options: object) -> DataFrame:
    """The mix itself: each row of `docs` as often as the plan takes it, columns as they were, whatever their names."""
    text, doc_id, source = (str(options.pop(n, n)) for n in ("text", "doc_id", "source"))
    inner, at = common.numbered(docs)
    plan = mix_plan(inner, text=at[text], doc_id=at[doc_id], source=at[source], **options)
    # rows of one unit have one count
    counts = plan.select(F.col("__unit").alias("__u"), F.col("source").alias("__t"), F.col("copies").alias("__copies")).where("__copies > 0").distinct()
    counts = common.broadcast_if_small(common.cut(counts))
    keyed = inner.withColumn("__k", common.row_key(at[doc_id], at[text]))
    joined = keyed.join(counts, (F.col("__k") == F.col("__u")) & F.col(at[source]).cast("string").eqNullSafe(F.col("__t")))
    return joined.withColumn("__turn", F.explode(F.expr("sequence(1, __copies)"))).select(*inner.columns).toDF(*docs.columns)
