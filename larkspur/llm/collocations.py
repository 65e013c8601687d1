"""Phrase collocations by pivot partitioning (as in MG-FSM).

Words have a total order by rarity. An n-gram belongs to its rarest word, its pivot. Each occurrence of a word sends one
fragment of text to that word: itself and up to two neighbours on either side, cut where a neighbour is rarer (that n-gram
has another pivot), is too rare for any candidate, or stands in another piece. Fragments of one word meet in one bucket,
which counts the n-grams around the pivot; so an n-gram is counted, and held against the least count, in one place.

Rarity is the count of a word, by a table of RARITY_CELLS cells: a cell holds the largest count of the words that hash to it,
so it is never too low, and what it calls too rare is so. Ties, and words of one cell, are ordered by their hash. The table
has one size whatever the vocabulary; any order gives the same counts, a good one balances them.

A word of more than SPLIT occurrences is dealt over several buckets by fragment and its counts are added up afterwards: such
a word meets only words that are more frequent still, so its n-grams are few.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import common, words

#: Cells of the rarity table, 8 bytes each; every Python worker holds it.
RARITY_CELLS = 1 << 21
#: Occurrences of a word whose fragments go to one bucket, and fragments that a bucket holds on average.
SPLIT, BUCKET = 50_000, 150_000
UNDETERMINED = "und"

BREAK = words.byte_set(".,;:!?", range(0x0A, 0x0E))
WORD = ~(BREAK | words.byte_set(" \t"))
_IN_FRAGMENT, _FRAGMENT_END = ~words.byte_set(" \t\n"), words.byte_set("\n")
_PLACES = (-2, -1, 0, 1, 2)
#: n-grams of two and three words around the pivot, by first and last place
_AROUND = ((-1, 0), (0, 1), (-2, 0), (-1, 1), (0, 2))


def _tokens(batch: pa.RecordBatch) -> Iterator[tuple[pa.DictionaryArray, np.ndarray, pa.DictionaryArray, np.ndarray]]:
    """Slices of a batch (__text, __lang): words, their pieces (equal only within one row and piece), languages, language of each word."""
    text, lang = batch.column(0), batch.column(1)
    for start, end, data, offsets in common.text_slices(text, words.SPAN):
        found, rows, broken = words.split(data, offsets, WORD, BREAK)
        if len(found):
            langs = lang.slice(start, end - start).dictionary_encode()
            yield found.dictionary_encode(), rows + broken, langs, langs.indices.to_numpy()[rows]


def _pairs(found: pa.DictionaryArray, lang_of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (language, word): their languages, their words, and the pair of each token."""
    size = len(found.dictionary)
    ids, at = np.unique(lang_of.astype(np.int64) * size + found.indices.to_numpy(), return_inverse=True)
    return ids // size, ids % size, at


def word_counts(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """lang, word, n: occurrences of every word in the texts of each language (null: `und`)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for found, _, langs, lang_of in _tokens(batch):
                of, word, at = _pairs(found, lang_of)
                yield pa.RecordBatch.from_arrays([langs.dictionary.take(pa.array(of)), found.dictionary.take(pa.array(word)), pa.array(np.bincount(at).astype(np.int64))], names=["lang", "word", "n"])

    each = common.batched(_input(docs, text, lang)).mapInArrow(run, "lang string, word string, n long")
    return each.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _input(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(text), F.lit("")).alias("__text"), F.coalesce(F.col(lang).cast("string"), F.lit(UNDETERMINED)).alias("__lang"))


def rarity_table(counts: DataFrame, least: int, cells: int = RARITY_CELLS) -> np.ndarray:
    """The largest count of the words of each cell; the driver gets one row a cell at most, whatever the vocabulary."""
    per = counts.where(F.col("n") >= least).groupBy(F.pmod(F.xxhash64("lang", "word"), F.lit(cells)).cast("int").alias("cell")).agg(F.max("n").alias("n")).toArrow()
    table = np.zeros(cells, np.int64)
    table[per["cell"].to_numpy()] = per["n"].to_numpy()
    return table


def _cell(hashes: np.ndarray, cells: int) -> np.ndarray:
    return np.mod(hashes.view(np.int64), cells)


def fragments(docs: DataFrame, rarity: np.ndarray, least: int, buckets: int, text: str = "text", lang: str = "lang", split: int = SPLIT) -> DataFrame:
    """bucket, lang, split, lines, counts: what goes to the pivots, told apart and counted once a slice of texts.

    `lines` are the fragments, one a line: their words with spaces between them and a tab before the pivot. `counts` are as
    many 32-bit numbers. split: the pivot's counts are spread over several buckets.
    """
    shared = docs.sparkSession.sparkContext.broadcast(rarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            for found, piece, langs, lang_of in _tokens(batch):
                of, word, at = _pairs(found, lang_of)
                texts = found.dictionary.take(pa.array(word))
                hashes = words.seeded_hashes(langs.dictionary.to_pylist(), texts.to_pylist(), of)
                ceiling = table[_cell(hashes, len(table))]
                rank = np.empty(len(hashes), np.int32)
                rank[np.lexsort((hashes, -ceiling))] = np.arange(len(hashes), dtype=np.int32)
                rank[ceiling < least] = np.iinfo(np.int32).max
                if len(out := _route(at.astype(np.int32), rank[at], piece, texts, of, hashes, np.maximum(1, -(-ceiling // split)), buckets, langs.dictionary)):
                    yield out

    schema = "bucket int, lang string, split boolean, lines string, counts binary"
    return common.batched(_input(docs, text, lang)).mapInArrow(run, schema)


def _route(pair: np.ndarray, rank: np.ndarray, piece: np.ndarray, texts: pa.Array, lang_of: np.ndarray, hashes: np.ndarray, parts: np.ndarray, buckets: int, langs: pa.Array) -> pa.RecordBatch:
    """The fragments of a slice. A pivot that stands twice in an n-gram owns it once: at its left occurrence."""
    n = len(pair)
    slots = {0: pair}
    reach = rank != np.iinfo(np.int32).max
    for side in (-1, 1):
        open_ = reach.copy()
        for step in (side, 2 * side):
            i = np.arange(n) + step
            inside = (i >= 0) & (i < n)
            i = np.where(inside, i, 0)
            open_ = open_ & inside & (piece[i] == piece) & ((rank[i] < rank) if side < 0 else (rank[i] <= rank))
            slots[step] = np.where(open_, pair[i], -1).astype(np.int32)
    own = (slots[-1] >= 0) | (slots[1] >= 0)
    table = pa.Table.from_arrays([pa.array(slots[p][own]) for p in _PLACES], names=[str(p) for p in _PLACES])
    table = table.group_by(table.column_names, use_threads=False).aggregate([([], "count_all")])
    ids = {p: table[str(p)].to_numpy() for p in _PLACES}
    pivot = ids[0]
    with np.errstate(over="ignore"):
        named = sum((np.where(ids[p] >= 0, hashes[ids[p]], np.uint64(0)) * np.uint64(2 * p + 11) for p in _PLACES), np.zeros(len(pivot), np.uint64))
        salt = np.mod(common.mix(named), parts[pivot].astype(np.uint64))
        bucket = np.mod(common.mix(hashes[pivot] + salt * np.uint64(0x9E3779B97F4A7C15)), np.uint64(buckets)).astype(np.int32)
    lang, spread = lang_of[pivot], parts[pivot] > 1
    order = np.lexsort((spread, lang, bucket))
    take = lambda p: texts.take(pa.array(ids[p][order], mask=ids[p][order] < 0))
    marked = pc.binary_join_element_wise("\t", texts, "").take(pa.array(pivot[order]))
    lines = pc.binary_join_element_wise(take(-2), take(-1), marked, take(1), take(2), " ", null_handling="skip")
    lines = pc.binary_join_element_wise(lines, "", "\n")
    counts = table["count_all"].to_numpy()[order].astype("<u4")
    b, l, s = bucket[order], lang[order], spread[order]  # noqa: E741
    first = np.flatnonzero(np.r_[True, (b[1:] != b[:-1]) | (l[1:] != l[:-1]) | (s[1:] != s[:-1])]) if len(b) else np.zeros(0, np.int64)
    edges = np.r_[first, len(b)]
    line_ends, line_data = np.frombuffer(lines.buffers()[1], np.int32, len(lines) + 1, lines.offset * 4), lines.buffers()[2]
    packed = pa.Array.from_buffers(pa.string(), len(first), [None, pa.py_buffer(line_ends[edges].copy()), line_data])
    sums = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer((edges * 4).astype(np.int32)), pa.py_buffer(counts)])
    return pa.RecordBatch.from_arrays([pa.array(b[first]), langs.take(pa.array(l[first])), pa.array(s[first]), packed, sums], names=["bucket", "lang", "split", "lines", "counts"])


def mine(routed: DataFrame, least: int) -> DataFrame:
    """lang, phrase, words, a: n-grams of two and three words with at least `least` occurrences, counted by their pivots."""

    def local(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        lines, langs = group["lines"].chunk(0), group["lang"].chunk(0).dictionary_encode()
        found, row, line, sums, before = [], [], [], [], 0
        for start, end, data, offsets in common.text_slices(lines, words.SPAN):
            w, r, ended = words.split(data, offsets, _IN_FRAGMENT, _FRAGMENT_END)
            found.append(w)
            row.append(r + start)
            line.append(ended + before)
            before += int(np.count_nonzero(data == 10))
            sums.append(np.frombuffer(b"".join(x.as_py() for x in group["counts"].chunk(0).slice(start, end - start)), "<u4"))
        tabs = _after_tab(lines)
        every = pa.concat_arrays(found).dictionary_encode()
        code, row, line, sums = every.indices.to_numpy(), np.concatenate(row), np.concatenate(line), np.concatenate(sums).astype(np.int64)
        pivot = np.flatnonzero(tabs)
        n, spread = len(code), group["split"].chunk(0).to_numpy(zero_copy_only=False)
        columns: list[list[np.ndarray]] = [[] for _ in range(6)]
        for first, last in _AROUND:
            a, z = pivot + first, pivot + last
            ok = (a >= 0) & (z < n)
            p, a, z = pivot[ok], a[ok], z[ok]
            ok = (line[a] == line[p]) & (line[z] == line[p])
            p, a, z = p[ok], a[ok], z[ok]
            third = code[z] if last - first == 2 else np.full(len(a), -1, np.int32)
            for column, values in zip(columns, (langs.indices.to_numpy()[row[p]], code[a], code[a + 1], third, spread[row[p]], sums[line[p]]), strict=True):
                column.append(values)
        lang, one, two, three, wide, times = map(np.concatenate, columns)
        table = pa.table({"lang": lang, "one": one, "two": two, "three": three, "split": wide, "n": times})
        table = table.group_by(["lang", "one", "two", "three", "split"], use_threads=False).aggregate([("n", "sum")])
        table = table.filter(pc.or_(table["split"], pc.greater_equal(table["n_sum"], least))).combine_chunks()
        text = lambda c: every.dictionary.take(pa.array(np.asarray(table[c]), mask=np.asarray(table[c]) < 0))
        phrase = pc.binary_join_element_wise(text("one"), text("two"), text("three"), " ", null_handling="skip")
        length = pa.array(np.where(np.asarray(table["three"]) < 0, 2, 3).astype(np.int32))
        return pa.table([langs.dictionary.take(pa.array(np.asarray(table["lang"]))), phrase, length, table["split"], table["n_sum"]], names=["lang", "phrase", "words", "split", "a"])

    each = common.table(routed.groupBy("bucket").applyInArrow(local, "lang string, phrase string, words int, split boolean, a long"))
    spread = each.where("split").groupBy("lang", "phrase", "words").agg(F.sum("a").alias("a")).where(F.col("a") >= least)
    return each.where("not split").select("lang", "phrase", "words", "a").unionByName(spread)


def _after_tab(lines: pa.Array) -> np.ndarray:
    """For each word of the fragments whether a tab stands before it."""
    out = []
    for _, _, data, _ in common.text_slices(lines, words.SPAN):
        inside = _IN_FRAGMENT[data]
        begin = inside & ~np.r_[False, inside[:-1]]
        out.append(np.r_[np.uint8(0), data[:-1]][begin] == 9)
    return np.concatenate(out)


def collocations(docs: DataFrame, least: int = 10, top: int = 2000, inside_percent: int = 50, text: str = "text", lang: str = "lang", buckets: int | None = None, split: int = SPLIT) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first `top` phrases of two or three words of each language.

    a: occurrences of the phrase within pieces of text, `least` at least; n: word occurrences of the language (null: `und`).
    l and r: those of its parts before and after the cut that gives the least score, floor(1000000 a a / (l r)); ties go to
    the first cut. A phrase inside a longer one goes if that has at least `inside_percent` % of its occurrences. Order:
    score and a descending, phrase by its bytes. All arithmetic is in whole numbers (decimals of 38 digits). Null texts are
    empty; repeated rows count each; a language without a candidate, and an empty table, give no rows.
    """
    counts = common.table(word_counts(docs, text, lang))
    totals = common.cut(counts.groupBy("lang").agg(F.sum("n").alias("n")))
    tokens = totals.agg(F.sum("n")).first()[0] or 0
    routed = fragments(docs, rarity_table(counts, least), least, buckets or max(12, -(-tokens // BUCKET)), text, lang, split)
    grams = common.table(mine(routed, least))
    known = counts.where(F.col("n") >= least).select("lang", F.col("word").alias("part"), F.col("n").alias("f")).unionByName(grams.where("words = 2").select("lang", F.col("phrase").alias("part"), F.col("a").alias("f")))
    w = F.split("phrase", " ")
    cut = lambda k: F.struct(F.lit(k).alias("cut"), F.array_join(F.slice(w, 1, k), " ").alias("first"), F.array_join(F.slice(w, k + 1, 3), " ").alias("rest"))
    cuts = grams.select("lang", "phrase", "words", "a", F.explode(F.when(F.col("words") == 2, F.array(cut(1))).otherwise(F.array(cut(1), cut(2)))).alias("c")).select("lang", "phrase", "words", "a", "c.*")
    both = cuts.join(known.toDF("lang", "first", "l"), ["lang", "first"]).join(known.toDF("lang", "rest", "r"), ["lang", "rest"])
    both = common.table(both.withColumn("score", F.expr("cast(1000000 as decimal(7,0)) * cast(a as decimal(15,0)) * cast(a as decimal(15,0)) div (cast(l as decimal(15,0)) * cast(r as decimal(15,0)))")))
    scored = both.groupBy("lang", "phrase").agg(F.min("a").alias("a"), F.min(F.struct("score", "cut", "l", "r")).alias("best")).select("lang", "phrase", "a", "best.l", "best.r", "best.score")
    shorter = F.when(F.col("cut") == 1, F.struct(F.col("rest").alias("phrase"), F.col("r").alias("f"))).otherwise(F.struct(F.col("first").alias("phrase"), F.col("l").alias("f")))
    inside = both.where("words = 3").select("lang", shorter.alias("s"), "a").where(F.col("a") * 100 >= F.col("s.f") * inside_percent).select("lang", "s.phrase").distinct()
    ranked = scored.join(inside, ["lang", "phrase"], "left_anti").withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))).where(F.col("rank") <= top)
    return ranked.join(common.broadcast_if_small(totals), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
