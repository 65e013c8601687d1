"""Divergence of sources within a language, by systolic rotation.

Each (lang, source) group is a sparse vector of smoothed shares over the terms of its language. The terms of a language are
dealt to slices of bounded width, its groups to blocks; a block of one slice is what a task holds. Blocks stay where they are
(partitioned once, persisted), and the compressed vectors of their peers come round: by the circle method every two blocks of
a language meet once in as many rounds as there are blocks, and a meeting serves both sides. In the first round a block meets
itself and its language, and heaps keep each group's terms of the largest excess. What slices give adds up.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import common, words

#: Terms of a slice on average; groups of a block at most, and blocks of a language at least (if it has as many groups).
SLICE, BLOCK, BLOCKS = 1 << 14, 64, 4
#: Rounds that are written as one table.
ROUNDS = 8

TERM = ~words.byte_set(range(0x00, 0x41), range(0x5B, 0x61), range(0x7B, 0x80))


def _named(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """lang, source, term, n, docs: occurrences of each term in a group and the documents (rows) of the group that hold it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end, data, offsets in common.text_slices(batch.column(0), words.SPAN):
                found, row, _ = words.split(data, offsets, TERM)
                if not len(found):
                    continue
                terms = found.dictionary_encode()
                lang, source = (batch.column(i).slice(start, end - start).dictionary_encode() for i in (1, 2))
                group = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
                size = len(terms.dictionary)
                each, times = np.unique(row * size + terms.indices.to_numpy(), return_counts=True)
                named, at = np.unique(group[each // size] * size + each % size, return_inverse=True)
                order = np.argsort(at, kind="stable")
                n = np.add.reduceat(times[order], np.searchsorted(at[order], np.arange(len(named))))
                g = named // size
                yield pa.RecordBatch.from_arrays([lang.dictionary.take(pa.array(g // len(source.dictionary))), source.dictionary.take(pa.array(g % len(source.dictionary))), terms.dictionary.take(pa.array(named % size)), pa.array(n.astype(np.int64)), pa.array(np.bincount(at).astype(np.int64))], names=["lang", "source", "term", "n", "docs"])

    taken = common.batched(docs.select(_named(text), _named(lang), _named(source)))
    each = taken.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return each.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(count: str, total: str, terms: str) -> Column:
    """1 + floor(1000000000 (count + 5) / (total + 5 terms)), in decimals."""
    return F.expr(f"cast(1 + cast(1000000000 as decimal(10,0)) * cast({count} + 5 as decimal(19,0)) div cast(greatest({total} + 5 * {terms}, 5) as decimal(19,0)) as int)")


def _packed(ids: np.ndarray, p: np.ndarray) -> bytes:
    return zlib.compress(np.diff(ids, prepend=0).astype("<i4").tobytes() + p.astype("<i4").tobytes(), 1)


def _dense(table: pa.Table) -> tuple[list, np.ndarray, list[np.ndarray]]:
    """Sources, their shares over all terms of the slice, and the places of the terms that they have."""
    sources, places = table["source"].to_pylist(), []
    rows = np.empty((len(sources), table["width"][0].as_py()), np.int64)
    for i, (base, packed) in enumerate(zip(table["base"].to_pylist(), table["packed"].to_pylist(), strict=True)):
        flat = np.frombuffer(zlib.decompress(packed), "<i4")
        at = np.cumsum(flat[: len(flat) // 2])
        rows[i] = base
        rows[i, at] = flat[len(flat) // 2 :]
        places.append(at)
    return sources, rows, places


_OUT = "lang string, source string, part string, item string, value long"


def _results(lang: str, rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
    types = (pa.string(), pa.string(), pa.string(), pa.int64())
    return pa.table([pa.array([lang] * len(rows), pa.string()), *[pa.array(list(c), t) for c, t in zip(columns, types, strict=True)]], names=["lang", "source", "part", "item", "value"])


def _meet(key: tuple, own: pa.Table, guests: pa.Table) -> pa.Table:
    """Every group of a block with every group of a visiting block; each distance goes to both."""
    rows = []
    if own.num_rows and guests.num_rows:
        mine, here, _ = _dense(own)
        theirs, there, _ = _dense(guests)
        for j, guest in enumerate(theirs):
            for host, value in zip(mine, np.abs(here - there[j]).sum(axis=1).tolist(), strict=True):
                rows += [(host, "pair", guest, value), (guest, "pair", host, value)]
    return _results(key[0].as_py(), rows)


def _at_home(top: int):
    """A block with itself and with its language: distances within, and each group's `top` terms of the slice."""

    def run(key: tuple, own: pa.Table, language: pa.Table) -> pa.Table:
        rows = []
        if own.num_rows:
            sources, here, places = _dense(own)
            for i, a in enumerate(sources):
                for b, value in zip(sources[i + 1 :], np.abs(here[i + 1 :] - here[i]).sum(axis=1).tolist(), strict=True):
                    rows += [(a, "pair", b, value), (b, "pair", a, value)]
            if language.num_rows:
                terms, q = language["terms"][0].as_py(), np.asarray(language["shares"][0].as_py(), np.int64)
                for a, p, at in zip(sources, here, places, strict=True):
                    more = p[at] - q[at]
                    at, more = at[more > 0], more[more > 0]
                    if len(at) > top:  # no value under the least of the best can win
                        least = np.partition(more, len(more) - top)[len(more) - top]
                        at, more = at[more >= least], more[more >= least]
                    best = heapq.nsmallest(top, ((-int(f), terms[t]) for t, f in zip(at, more, strict=True)))
                    rows += [(a, "term", t, -f) for f, t in best]
        return _results(key[0].as_py(), rows)

    return run


def rounds(blocks: int) -> list[list[tuple[int, int]]]:
    """The circle method: in each round every block has one meeting at most (host, guest), and over all rounds any two meet once."""
    last = blocks - 1 + blocks % 2  # stands still; the others turn, and with an odd number its guest has a rest
    out = []
    for r in range(last):
        turned = [(a, b if (b := (r - a) % last) != a else last) for a in range(last)]
        out.append([(a, b) if (a + b + r) % 2 else (b, a) for a, b in turned if a < b < blocks])
    return out


def audit(docs: DataFrame, least_docs: int = 30, top: int = 50, text: str = "text", lang: str = "lang", source: str = "source", width: int = SLICE, block: int = BLOCK, blocks: int = BLOCKS) -> DataFrame:
    """lang, source, part, item, value, rank for each (lang, source) group of `docs` (null text, lang and source: empty).

    Part `pair`: every other source of the language with the distance of their shares over the language's terms, summed (0
    without a kept term). Part `term`: the `top` terms that the group has and whose share there most exceeds the language's.
    A term is kept if `least_docs` rows of its language hold it. Ranks by value descending, then by item. Shares are whole
    numbers of a billionth plus one; all arithmetic is exact. Repeated rows count each; an empty table gives no rows.
    """
    spark = docs.sparkSession
    counts = common.table(term_counts(docs, text, lang, source))
    groups = common.cut(docs.select(_named(lang).alias("lang"), _named(source).alias("source")).distinct())
    kept = common.table(counts.groupBy("lang", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")).where(F.col("docs") >= least_docs).drop("docs"))
    vocabulary = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("n").alias("total"))
    sizes = groups.groupBy("lang").agg(F.count("*").alias("groups")).join(vocabulary, "lang", "left").fillna(0)
    blocked = F.least("groups", F.greatest(F.lit(blocks), F.ceil(F.col("groups") / block))).cast("int")
    sizes = common.cut(sizes.withColumns({"slices": F.greatest(F.lit(1), F.ceil(F.col("terms") / width)).cast("int"), "blocks": blocked}))
    about = common.broadcast_if_small(sizes)
    placed = kept.join(about, "lang").withColumn("slice", F.pmod(F.xxhash64("term"), "slices").cast("int"))
    placed = placed.withColumn("id", F.row_number().over(W.partitionBy("lang", "slice").orderBy("term")) - 1)
    placed = common.table(placed.select("lang", "term", "slice", "id", _share("n", "total", "terms").alias("q")))
    language = placed.groupBy("lang", "slice").agg(F.sort_array(F.collect_list(F.struct("id", "q", "term"))).alias("x")).select("lang", "slice", F.size("x").alias("width"), F.col("x.q").alias("shares"), F.col("x.term").alias("terms"))
    language = common.table(language)

    # a group's vector in a slice, as one row
    held = common.table(counts.join(placed.select("lang", "term", "slice", "id"), ["lang", "term"]).select("lang", "source", "slice", "id", "n"))
    totals = held.groupBy("lang", "source").agg(F.sum("n").alias("own"))
    index = F.row_number().over(W.partitionBy("lang").orderBy("source")) - 1
    members = groups.join(totals, ["lang", "source"], "left").fillna(0, ["own"]).withColumn("index", index).join(about, "lang")
    members = common.cut(members.select("lang", "source", "own", "terms", "slices", F.pmod("index", "blocks").alias("block")))
    shares = held.join(common.broadcast_if_small(members.select("lang", "source", "own", "terms")), ["lang", "source"]).select("lang", "source", "slice", "id", _share("n", "own", "terms").alias("p"))
    vectors = shares.groupBy("lang", "source", "slice").agg(F.sort_array(F.collect_list(F.struct("id", "p"))).alias("x"))
    every = members.select("lang", "source", "block", _share("0", "own", "terms").alias("base"), F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"))
    every = every.join(language.select("lang", "slice", "width"), ["lang", "slice"], "left").join(vectors, ["lang", "source", "slice"], "left")
    every = every.select("lang", "slice", "block", "source", "base", F.coalesce("width", F.lit(0)).alias("width"), F.col("x.id").alias("ids"), F.col("x.p").alias("p"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            packed = [_packed(np.asarray(i or [], np.int64), np.asarray(p or [], np.int64)) for i, p in zip(b.column("ids").to_pylist(), b.column("p").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in ("lang", "slice", "block", "source", "base", "width")], pa.array(packed, pa.binary())], names=["lang", "slice", "block", "source", "base", "width", "packed"])

    packed = common.table(common.batched(every).mapInArrow(pack, "lang string, slice int, block int, source string, base int, width int, packed binary"))
    tournament = sizes.agg(F.max("blocks"), F.sum(F.col("blocks").cast("long") * F.col("slices"))).first()
    place, parts = ["lang", "slice", "block"], max(1, min(tournament[1] or 1, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    resident = packed.repartition(parts, *place).persist(StorageLevel.DISK_ONLY)
    try:
        hosts = members.select("lang", "block").distinct()
        guests = language.join(hosts, "lang")
        met = [resident.groupBy(*place).cogroup(guests.groupBy(*place)).applyInArrow(_at_home(top), _OUT)]
        schedules = {b: rounds(b) for b in {r[0] for r in sizes.select("blocks").distinct().collect()}}
        found = []
        for r in range(max(0, (tournament[0] or 0) - 1 + (tournament[0] or 0) % 2)):
            meetings = [(b, host, guest) for b, all_ in schedules.items() if r < len(all_) for host, guest in all_[r]]
            if meetings:
                plan = F.broadcast(spark.createDataFrame(meetings, "blocks int, host int, block int"))
                moving = packed.join(about.select("lang", "blocks"), "lang").join(plan, ["blocks", "block"])
                moving = moving.select(*[F.col("host" if c == "block" else c).alias(c) for c in packed.columns])
                met.append(resident.groupBy(*place).cogroup(moving.groupBy(*place)).applyInArrow(_meet, _OUT))
            if len(met) == ROUNDS:
                found.append(common.table(_all(met)))
                met = []
        found += [common.table(_all(met))] if met else []
    finally:
        resident.unpersist()
    results = _all(found)
    pairs = results.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    rank = F.row_number().over(W.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    terms = results.where("part = 'term'").withColumn("rank", rank).where(F.col("rank") <= top)
    return pairs.withColumn("rank", rank).unionByName(terms)


def _all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
