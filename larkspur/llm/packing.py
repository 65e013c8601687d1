"""Packing of tokenized documents into sequences by shortest-pack-first over the histogram of lengths.

A document longer than a sequence gives whole sequences first; what remains is shorter than one. The driver has only the
histogram of these rests, one number a length. It places lengths longest first, each into the pack with the most room that
takes it, all packs of one pattern at a time, and so gets patterns with counts, however many documents there are. Packs that
then still have room are closed by free cuts: the emptiest are dissolved, and their tokens fill the room of the others in one
run; what is left at the end, less than a sequence, becomes sequences of powers of two, which are not padded.

Documents find their place by rank: a rest has a rank among those of its length, and a run of ranks is a slot of a pattern.
"""

from __future__ import annotations

import heapq
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import common

LENGTH = 2048
#: Room of fewer tokens than this is padded rather than filled by cutting another document.
LEAST_CUT = 8
#: Rests of one length that are numbered in one task.
NUMBERED = 20_000
#: Distinct words whose ids a worker remembers.
REMEMBERED = 1 << 19
#: Bytes of text whose words are told apart together.
SLICE = 1 << 22
#: Words that are turned into ids at once.
AT_ONCE = 1 << 20
_RANK_BITS = 48


# -- the plan, from the histogram alone ----------------------------------------------------------------------------------


def patterns(histogram: dict[int, int], length: int = LENGTH) -> list[tuple[int, int, list[tuple[int, int]]]]:
    """(packs, room left in each, runs of (length, times)): packs of one pattern, from numbers of pieces by length < `length`.

    The shortest pack takes a piece first; a new one is opened only where none has room.
    """
    packs: dict[int, list[tuple[int, tuple | None]]] = {}
    rooms: list[int] = []

    def add(room: int, count: int, chain: tuple) -> None:
        if room not in packs:
            packs[room] = []
            heapq.heappush(rooms, -room)
        packs[room].append((count, chain))

    for size in sorted((s for s, n in histogram.items() if n > 0), reverse=True):
        left = histogram[size]
        while left:
            room = -rooms[0] if rooms else -1
            if room < size:
                times = length // size
                whole, rest = divmod(left, times)
                if whole:
                    add(length - times * size, whole, (None, size, times))
                if rest:
                    add(length - rest * size, 1, (None, size, rest))
                break
            count, chain = packs[room].pop()
            taken = min(count, left)
            if count > taken:
                packs[room].append((count - taken, chain))
            elif not packs[room]:
                del packs[room]
                heapq.heappop(rooms)
            add(room - size, taken, (chain, size, 1))
            left -= taken
    out = []
    for room in sorted(packs):
        for count, chain in packs[room]:
            runs = []
            while chain:
                chain, size, times = chain
                runs.append((size, times))
            out.append((count, room, runs[::-1]))
    return out


@dataclass
class Plan:
    """Slots by (length, first rank), sorted: `first` sequence, `base` offset there, `times` pieces a pack; a dissolved one has
    times 0 and `first` is the place of its first token in the run that fills `gaps` (start, first sequence, base, room)."""

    key: np.ndarray
    first: np.ndarray
    base: np.ndarray
    times: np.ndarray
    gaps: np.ndarray
    sequences: int

    def pieces(self, size: int, rank: int) -> list[tuple[int, int, int, int]]:
        """(start in the rest, length, sequence, offset) of the rest of this length and rank."""
        i = int(np.searchsorted(self.key, (size << _RANK_BITS) + rank, "right")) - 1
        nth = rank - (int(self.key[i]) - (size << _RANK_BITS))
        times = int(self.times[i])
        if times:
            return [(0, size, int(self.first[i]) + nth // times, int(self.base[i]) + nth % times * size)]
        at = int(self.first[i]) + nth * size
        end, out, start = at + size, [], 0
        while at < end:
            begun, first, base, room = map(int, self.gaps[int(np.searchsorted(self.gaps[:, 0], at, "right")) - 1])
            which, inside = divmod(at - begun, room)
            n = min(end - at, room - inside)
            out.append((start, n, first + which, base + inside))
            at, start = at + n, start + n
        return out


def plan(histogram: dict[int, int], length: int = LENGTH, least_cut: int = LEAST_CUT) -> Plan:
    """Where the rests go. Every pack but those of less room than `least_cut` is full, or a power of two."""
    packed = patterns(histogram, length)
    closed = [g for g in packed if g[1] < least_cut or (length - g[1]) & (length - g[1] - 1) == 0]
    open_ = [g for g in packed if not (g[1] < least_cut or (length - g[1]) & (length - g[1] - 1) == 0)]
    room, spare, dissolved = sum(c * r for c, r, _ in open_), 0, []
    while room > spare:  # the emptiest first: each that goes takes its own room along
        count, own, runs = open_.pop()
        gone = min(count, -(-(room - spare) // length))
        dissolved.append((gone, runs))
        room, spare = room - gone * own, spare + gone * (length - own)
        if count > gone:
            open_.append((count - gone, own, runs))
    taken = dict.fromkeys(histogram, 0)
    slots, gaps, sequence, at = [], [], 0, 0
    for count, own, runs in closed + open_:
        base = 0
        for size, times in runs:
            slots.append(((size << _RANK_BITS) + taken[size], sequence, base, times))
            taken[size] += count * times
            base += size * times
        if own >= least_cut and base & (base - 1):
            gaps.append((at, sequence, base, own))
            at += count * own
        sequence += count
    for bit in reversed(range(length.bit_length())):
        if (spare - at) >> bit & 1 and spare > at:
            gaps.append((at, sequence, 0, 1 << bit))
            at, sequence = at + (1 << bit), sequence + 1
    at = 0
    for count, runs in dissolved:
        for size, times in runs:
            slots.append(((size << _RANK_BITS) + taken[size], at, 0, 0))
            taken[size] += count * times
            at += count * times * size
    columns = np.array(sorted(slots), np.int64).reshape(-1, 4).T
    return Plan(*columns, np.array(gaps, np.int64).reshape(-1, 4), sequence)


# -- ids -------------------------------------------------------------------------------------------------------------------


class _Merges:
    """The tokenizer's own merges on single words of Latin letters, by tiktoken's core: the same ids for far less time.

    It reads byte-level BPE files with an end of word. The end is a byte that no text holds; it joins the last byte before
    anything else, as the tokenizer begins with these two as one symbol.
    """

    END = b"\xff"
    SIMPLE = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model, end = file["model"], file["model"].get("end_of_word_suffix")
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printable]
        byte_of = {chr(b): bytes([b]) for b in printable} | {chr(256 + i): bytes([b]) for i, b in enumerate(others)}

        def raw(token: str) -> bytes:
            whole = end and token.endswith(end)
            return b"".join(byte_of[c] for c in (token[: -len(end)] if whole else token)) + (self.END if whole else b"")

        ranks = {bytes([b]) + self.END: b for b in range(255)} | {bytes([b]): 256 + b for b in range(256)}
        for i, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            ranks.setdefault(raw(left) + raw(right), 512 + i)
        self.ids = np.zeros(512 + len(model["merges"]), np.int64)
        for token, i in model["vocab"].items():
            if (r := ranks.get(raw(token))) is not None:
                self.ids[r] = i
        self.core = tiktoken.Encoding("merges", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe

    def word(self, word: str) -> list[int]:
        return self.core.encode_single_piece(word.lower().encode() + self.END)

    @classmethod
    def fits(cls, path: str) -> bool:
        """Whether the file is of this kind: NFC, spaces and lower case, letters split off, bytes, an end of word and no more."""
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        steps = [x["type"] for x in (file["normalizer"] or {}).get("normalizers", [])]
        split = (file["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        model, pattern = file["model"], split[0].get("pattern", {}).get("Regex", "")
        plain = model["type"] == "BPE" and model.get("end_of_word_suffix") and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "ignore_merges"))
        return bool(plain and steps == ["NFC", "Replace", "Lowercase"] and [x.get("type") for x in split] == ["Split", "ByteLevel"] and "[\\p{L}]+" in pattern and not split[1]["add_prefix_space"])


class _Ids:
    """Ids of words by a tokenizer whose normaliser and splitting never look across a space; words met before are remembered."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = np.uint16 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else np.uint32
        self.merges = _Merges(path) if _Merges.fits(path) else None
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.size, self.flat = np.zeros(0, np.int64), np.zeros(0, self.kind)
        self.begin = np.zeros(0, np.int64)

    def _encode(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _learn(self, words: list[str]) -> None:
        simple = [bool(self.merges and self.merges.SIMPLE.fullmatch(w)) for w in words]
        for of in (True, False):
            part = [w for w, s in zip(words, simple, strict=True) if s is of]
            for at in range(0, len(part), 8192):
                some = part[at : at + 8192]
                each = [self.merges.word(w) for w in some] if of else self._encode(some)
                flat = np.fromiter(chain.from_iterable(each), np.int64)
                flat = (self.merges.ids[flat] if of else flat).astype(self.kind)
                size = np.fromiter(map(len, each), np.int64, len(each))
                self.known.update(zip(some, range(len(self.known), len(self.known) + len(some)), strict=True))
                self.begin = np.concatenate([self.begin, len(self.flat) + np.cumsum(size) - size])
                self.size, self.flat = np.concatenate([self.size, size]), np.concatenate([self.flat, flat])

    def places(self, words: list[str]) -> np.ndarray:
        """The number of each word among those remembered."""
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > REMEMBERED:
            self.forget()
            new = words
        self._learn(new)
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))

    def texts(self, column: pa.Array, end_id: int) -> Iterator[np.ndarray]:
        """The ids of each text, with `end_id` after them."""
        for start, end, data, offsets in common.text_slices(column, SLICE):
            words, row = _cut_words(data, offsets)
            words = words.dictionary_encode()
            place = self.places(words.dictionary.to_pylist())[words.indices.to_numpy()]
            size = self.size[place]
            ends = np.searchsorted(row, np.arange(end - start), "right")
            for first, last in zip(np.concatenate([[0], ends[:-1]]), ends, strict=True):
                out = []
                for at in range(first, last, AT_ONCE):
                    p, n = place[at : min(last, at + AT_ONCE)], size[at : min(last, at + AT_ONCE)]
                    out.append(self.flat[np.repeat(self.begin[p] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))])
                yield np.concatenate([*out, np.array([end_id], self.kind)])


_SPACE = ord(" ")
_ALNUM = np.array([chr(b).isalnum() and b < 128 for b in range(256)])
_POINT = np.array([chr(b) in ".,;:!?" for b in range(256)])


def _cut_words(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """What stands between spaces, cut once more between an ASCII letter or digit and a point after it; and the row of each.

    No step of the tokenizer looks across these places: points are no letters, join none and begin a new run.
    """
    inside = data != _SPACE
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | (_POINT[data[1:]] & _ALNUM[data[:-1]])
    edge = offsets[:-1][offsets[:-1] < len(data)]
    begin[edge] = inside[edge]
    starts = np.flatnonzero(begin)
    if not len(starts):
        return pa.array([], pa.string()), starts
    ends = np.cumsum(np.add.reduceat(inside, starts, dtype=np.int32), dtype=np.int32)
    words = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(np.concatenate([np.zeros(1, np.int32), ends])), pa.py_buffer(data[inside])])
    return words, np.searchsorted(offsets[1:], starts, "right")


_LOADED: dict[str, _Ids] = {}


def _ids(path: str) -> _Ids:
    """Read once in each Python worker."""
    if path not in _LOADED:
        _LOADED.clear()
        _LOADED[path] = _Ids(path)
    return _LOADED[path]


def tokenize(docs: DataFrame, tokenizer: str, keep: list[str], text: str = "text", end_id: int = 1) -> DataFrame:
    """`keep` columns, __row (a name of the row, once this is written), __n, __ids: each whole text's ids and `end_id`, as
    little-endian numbers of 16 bits (32, if the vocabulary needs them). A null text has `end_id` alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, row = _ids(tokenizer), TaskContext.get().partitionId() << 40
        for batch in batches:
            texts = batch.column(len(keep)).fill_null("").cast(pa.large_string())
            for start, end, _, _ in common.text_slices(texts, SLICE):
                made = list(ids.texts(texts.slice(start, end - start), end_id))
                names = np.arange(row, row + len(made))
                row += len(made)
                own = [batch.column(i).slice(start, end - start) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*own, pa.array(names), pa.array([len(m) for m in made], pa.int64()), pa.array([m.tobytes() for m in made], pa.binary())], names=[*own_names, "__row", "__n", "__ids"])

    own_names = [f"c{i}" for i in range(len(keep))]
    taken = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, own_names, strict=True)], F.col(text).cast("string").alias("__text"))
    schema = "".join(f"{n} {t}, " for n, t in taken.dtypes[:-1]) + "__row long, __n long, __ids binary"
    return common.batched(taken).mapInArrow(run, schema)


def pack(docs: DataFrame, tokenizer: str, keep: list[str], text: str = "text", length: int = LENGTH, end_id: int = 1, least_cut: int = LEAST_CUT) -> DataFrame:
    """A row for each piece of a document: `keep` columns, start, length, ids, doc_tokens, sequence_id, offset.

    ids: the piece's ids as little-endian 32-bit numbers; start: the document's ids before it; offset: its place in the
    sequence, gapless from 0. Sequences are numbered from 0 without gaps and hold at most `length` ids; each id of a document,
    and `end_id` after them, lies in exactly one piece. A null or empty text is its `end_id`; repeated rows are packed each;
    an empty table gives no rows. A `keep` column that bears the name of a result is returned as `kept_` and its name.
    """
    if length & (length - 1):
        raise ValueError("length must be a power of two")
    made = common.table(tokenize(docs, tokenizer, keep, text, end_id))
    wide = _ids(tokenizer).kind is np.uint32
    rests = made.select("__row", (F.col("__n") % length).cast("int").alias("rest"), F.floor(F.col("__n") / length).alias("whole"))
    histogram = {r["rest"]: r["n"] for r in rests.groupBy("rest").agg(F.count("*").alias("n")).collect()}  # one row a length
    planned = plan({s: n for s, n in histogram.items() if s}, length, least_cut)
    # ranks within (rest, part), after all rows of earlier parts; whole sequences are numbered alike
    parts = docs.sparkSession.createDataFrame([(s, -(-n // NUMBERED)) for s, n in histogram.items()], "rest int, parts int")
    dealt = rests.join(F.broadcast(parts), "rest").withColumn("part", F.pmod(F.xxhash64("__row"), "parts").cast("int"))  # `length` rows at most
    before = W.partitionBy("rest", "part").orderBy("__row").rowsBetween(W.unboundedPreceding, -1)
    inner = dealt.select("__row", "rest", "part", (F.row_number().over(W.partitionBy("rest", "part").orderBy("__row")) - 1).alias("rank"), F.coalesce(F.sum("whole").over(before), F.lit(0)).alias("wholes"))
    sums = dealt.groupBy("rest", "part").agg(F.count("*").alias("n"), F.sum("whole").alias("w"))
    ahead = lambda c, w: F.coalesce(F.sum(c).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = common.cut(sums.select("rest", "part", ahead("n", W.partitionBy("rest").orderBy("part")).alias("n0"), ahead("w", W.orderBy("rest", "part")).alias("w0")))
    placed = inner.join(common.broadcast_if_small(starts), ["rest", "part"]).select("__row", (F.col("rank") + F.col("n0")).alias("__rank"), (F.col("wholes") + F.col("w0") + planned.sequences).alias("__first"))
    shared = docs.sparkSession.sparkContext.broadcast(planned)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        for batch in batches:
            row, out = [], []
            for i, (n, ids, rank, first) in enumerate(zip(*[batch.column(c).to_pylist() for c in ("__n", "__ids", "__rank", "__first")], strict=True)):
                ids = np.frombuffer(ids, "<u4" if wide else "<u2").astype("<u4")
                whole, rest = divmod(n, length)
                found = [(k * length, length, first + k, 0) for k in range(whole)]
                found += [(whole * length + s, *x) for s, *x in p.pieces(rest, rank)] if rest else []
                row += [i] * len(found)
                out += [(s, m, ids[s : s + m].tobytes(), n, q, o) for s, m, q, o in found]
            columns = list(zip(*out, strict=True)) or [()] * 6
            types = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
            own = [batch.column(c).take(pa.array(row, pa.int32())) for c in own_names]
            yield pa.RecordBatch.from_arrays([*own, *[pa.array(list(c), t) for c, t in zip(columns, types, strict=True)]], names=[*own_names, *results])

    results = ["start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    own_names = made.columns[: len(keep)]
    schema = "".join(f"{n} {t}, " for n, t in made.dtypes[: len(keep)]) + "start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    pieces = common.batched(made.join(placed, "__row").select(*own_names, "__n", "__ids", "__rank", "__first")).mapInArrow(cut, schema)
    return pieces.toDF(*[f"kept_{c}" if c in results else c for c in keep], *results)
