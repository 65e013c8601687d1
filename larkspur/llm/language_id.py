"""Language identification by cross-parsing entropy.

Each language is a suffix automaton of labelled text. A text is cut into the longest phrases that occur in a language's
reference: walk the automaton until no step fits, then start a new phrase. phrases * log2(reference length) / length
estimates the cross entropy; the language with the smallest value wins.

The automaton with its restarts is a table of states by byte classes, so thousands of text segments are parsed in
lockstep by numpy. Texts are parsed whole, in segments of SEGMENT bytes that start with a new phrase each, in every
language alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: Bytes in a segment; phrases end at its end.
SEGMENT = 512
UNDETERMINED = "und"
#: 0: padding, 1: anything that is not in words; then the letters; then bytes above 127.
_CLASS = np.ones(256, np.uint8)
_CLASS[[*range(97, 123)]] = np.arange(2, 28)
_CLASS[[*range(65, 91)]] = np.arange(2, 28)
_CLASS[128:] = np.arange(28, 156)
_LETTER = regex.compile(r"\p{L}")


def suffix_automaton(symbols: bytes) -> list[dict[int, int]]:
    """The transitions of each state of the automaton of all substrings; state 0 is the empty one."""
    steps: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in symbols:
        cur = len(steps)
        steps.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in steps[p]:
            steps[p][c] = cur
            p = link[p]
        if p >= 0:
            q = steps[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                twin = len(steps)
                steps.append(dict(steps[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                link[q] = link[cur] = twin
                while p >= 0 and steps[p].get(c) == q:
                    steps[p][c] = twin
                    p = link[p]
        last = cur
    return steps


class Parser:
    """Counts the phrases of byte strings in one language's reference."""

    def __init__(self, reference: bytes):
        classes = _CLASS[np.frombuffer(reference, np.uint8)]
        steps = suffix_automaton(classes.tobytes())
        used = sorted(steps[0])
        #: Column of each class in the table: 0 padding, 1 never seen.
        self.column = np.ones(156, np.int32)
        self.column[0] = 0
        for k, c in enumerate(used):
            self.column[c] = k + 2
        self.width = len(used) + 2
        table = np.full((len(steps), self.width), -1, np.int32)
        for s, row in enumerate(steps):
            if row:
                table[s, self.column[list(row)]] = list(row.values())
        first = table[0].copy()
        first[first < 0] = 0  # a symbol that never occurs is a phrase of its own
        starts = table < 0
        table = np.where(starts, first, table)
        starts[0] = True
        table[:, 0], starts[:, 0] = 0, False
        #: Offset of the next state's row, and in the lowest bit whether a phrase starts.
        self.table = ((table * self.width) << 1 | starts).astype(np.int32).reshape(-1)
        self.bits = float(np.log2(max(2, len(reference))))

    def phrases(self, lanes: np.ndarray) -> np.ndarray:
        """lanes: classes, (step, lane). Phrases of each lane."""
        state = np.zeros(lanes.shape[1], np.int32)
        count = np.zeros(lanes.shape[1], np.int32)
        for classes in lanes:
            step = self.table[state + self.column[classes]]
            count += step & 1
            state = step >> 1
        return count


_PARSERS: dict[tuple, list[tuple[str, Parser]]] = {}


def parsers(references: tuple[tuple[str, bytes], ...]) -> list[tuple[str, Parser]]:
    """Built once in each Python worker."""
    if references not in _PARSERS:
        _PARSERS.clear()
        _PARSERS[references] = [(lang, Parser(text)) for lang, text in references]
    return _PARSERS[references]


def _shares(texts: list[list[bytes]], budget: int) -> bytes:
    """Slices of every text, in their order, joined by spaces: what short texts leave of an equal part goes to the longer ones."""
    joined = [b" ".join(t) for t in texts]
    sizes, left = [0] * len(joined), max(0, budget - len(joined) + 1)
    order = sorted(range(len(joined)), key=lambda i: len(joined[i]))
    for k, i in enumerate(order):
        sizes[i] = min(len(joined[i]), left // (len(order) - k))
        left -= sizes[i]
    return b" ".join(t[:n] for t, n in zip(joined, sizes, strict=True))


def _slices(text: Column, size: int, most: int) -> Column:
    """Up to `most` distinct slices of about `size` characters from all over a text, cut between words where it has any.

    Those of which letters are at least half come first, each kind in the order of a hash; slices without a letter are none.
    """
    every = F.array_distinct(F.regexp_extract_all(text, F.lit(rf"(?s)\S.{{0,{size - 1}}}(?!\S)|\S.{{0,{size - 1}}}"), F.lit(0)))
    count = lambda x, pattern: F.length(F.regexp_replace(x, pattern, ""))
    wordy = lambda x: 2 * count(x, r"[^\p{L}\p{M}]") >= count(x, r"\s")
    ranked = F.transform(F.filter(every, lambda x: x.rlike(r"\p{L}")), lambda x: F.struct((~wordy(x)).alias("a"), F.xxhash64(x).alias("h"), x.alias("x")))
    return F.transform(F.slice(F.sort_array(ranked), 1, most), lambda r: r["x"])


def references(docs: DataFrame, per_language: int = 64, row_bytes: int = 8_000, lang_bytes: int = 24_000, slice_chars: int = 400, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> tuple[tuple[str, bytes], ...]:
    """For each language a reference text from a bounded sample of labelled rows.

    The sample: of the distinct texts with a letter, the first by the hash of text for each of `per_language` remainders of
    that hash. Each is cut as a whole into slices of `slice_chars` characters, and gives those that come first by a hash,
    wordy ones (at least half letters) before others, up to `row_bytes` characters; so a text may open with numbers of any
    length. All sampled texts share the `lang_bytes` of their language's reference, however many languages there are. That
    and the number of rows are the only bounds; the driver holds one language's slices and the references.
    """
    rows = docs.select(F.col(lang).alias("lang"), F.xxhash64(text).alias("h"), F.col(text).alias("text")).where("lang is not null and text is not null")
    rows = rows.where(F.col("text").rlike(r"\p{L}"))
    # partial aggregation keeps one hash for each salt and language, so no language meets in one task
    first = rows.groupBy("lang", F.pmod("h", F.lit(per_language)).alias("salt")).agg(F.min("h").alias("h"))
    keys = common.cut(first.select("lang", "h"))
    chosen = rows.join(common.broadcast_if_small(keys), ["lang", "h"], "left_semi").select("lang", "h", _slices(F.col("text"), slice_chars, -(-row_bytes // slice_chars)).alias("slices"))
    found = chosen.groupBy("lang", "h").agg(F.first("slices").alias("slices")).orderBy("lang", "h").toLocalIterator()
    return tuple((k, _shares([[x.encode() for x in row["slices"]] for row in group], lang_bytes)) for k, group in groupby(found, key=itemgetter("lang")))


def _predict(refs: tuple[tuple[str, bytes], ...], source: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = parsers(refs)
        names = np.array([lang for lang, _ in known] or [UNDETERMINED], object)
        for batch in batches:
            text = batch.column(batch.schema.get_field_index(source))
            for start, end, data, offsets in common.text_slices(text):
                n = end - start
                sizes = np.diff(offsets)
                lane_count = -(-sizes // SEGMENT)
                classes = _CLASS[data]
                lettered = np.zeros(n, bool)
                alpha = np.concatenate([[0], np.cumsum((classes > 1) & (classes < 28))])
                lettered[:] = alpha[offsets[1:]] > alpha[offsets[:-1]]
                for r in np.flatnonzero(~lettered & (sizes > 0)):
                    lettered[r] = bool(_LETTER.search(data[offsets[r] : offsets[r + 1]].tobytes().decode("utf-8", "ignore")))
                values = np.full((n, len(names)), 1.0)
                if known and lane_count.sum():
                    row = np.repeat(np.arange(n), lane_count)
                    turn = np.arange(len(row)) - np.repeat(np.cumsum(lane_count) - lane_count, lane_count)
                    left = offsets[row] + turn * SEGMENT
                    size = np.minimum(SEGMENT, offsets[row + 1] - left)
                    lanes = np.zeros((len(row), SEGMENT), np.uint8)
                    lanes[np.arange(SEGMENT) < size[:, None]] = classes
                    lanes = np.ascontiguousarray(lanes.T)
                    for k, (_, parser) in enumerate(known):
                        found = np.bincount(row, parser.phrases(lanes), n)
                        values[:, k] = found * parser.bits / np.maximum(sizes, 1)
                best = values.argmin(axis=1)
                low = values[np.arange(n), best][:, None]
                score = 1.0 / ((low / np.maximum(values, 1e-12)) ** 8).sum(axis=1)
                known_text = lettered & bool(known)
                lang = np.where(known_text, names[best], UNDETERMINED)
                cols = [batch.column(i).slice(start, n) for i, name in enumerate(batch.schema.names) if name != "__text"]
                kept = [x for x in batch.schema.names if x != "__text"]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(lang.tolist(), pa.string()), pa.array(np.where(known_text, np.minimum(score, 1.0), 0.0)), pa.array(np.where(known_text, low[:, 0], 0.0))], names=[*kept, "lang_pred", "score", "bits_per_byte"])

    return run


def identify(docs: DataFrame, refs: tuple[tuple[str, bytes], ...], keep: list[str], text: str = "text") -> DataFrame:
    """`keep` columns, lang_pred, score (0 to 1: the share of the best language) and bits_per_byte for each row.

    `und` with score 0: the text is null or has no letter, or no language was learned. Ties go to the first language by
    code point. Repeated rows get equal results; texts of any length are parsed whole.
    """
    schema = ", ".join(f"`{c}` {t}" for c, t in docs.select(*keep).dtypes) if keep else ""
    # a kept text is not sent to Python twice
    chosen = docs.select(*keep) if text in keep else docs.select(*keep, F.col(text).alias("__text"))
    return common.batched(chosen).mapInArrow(_predict(refs, text if text in keep else "__text"), (schema + ", " if schema else "") + "lang_pred string, score double, bits_per_byte double")


def keep_identified(docs: DataFrame, refs: tuple[tuple[str, bytes], ...], text: str = "text") -> DataFrame:
    """`docs` without the rows whose language is undetermined; columns as they were."""
    names = docs.columns
    inner = docs.toDF(*[f"c{i}" for i in range(len(names))])
    at = f"c{names.index(text)}"
    marked = identify(inner, refs, inner.columns, at)
    return marked.where(F.col("lang_pred") != UNDETERMINED).drop("lang_pred", "score", "bits_per_byte").toDF(*names)
