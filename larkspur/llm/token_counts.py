"""Token counts under a unigram vocabulary by a count-only Viterbi pass.

An Aho-Corasick automaton lists the vocabulary pieces that end at each character; dynamic programming over the characters
keeps only the best score and its number of pieces. Ties are broken as the usual unigram tokenizers do: an end keeps the
first path found, with starts tried from left to right, so of equal scores the longest last piece wins. A character that
is no piece by itself may be unknown, at the lowest score less 10; unknown characters count their UTF-8 bytes with byte
fallback, and a run of them as one token without.

No piece has the space mark after another character, so the best path splits at each word; words are counted once a task.

A unigram model file is taken with its scores and its normaliser. A merge-rank (BPE) file has no scores: its ranks are an
order, not log-probabilities. Read as a unigram vocabulary, its pieces get the log-probabilities of the Zipf-Mandelbrot law
by rank, (rank + MANDELBROT) ** -1 over their sum; nothing is fitted. Counts are then those of a unigram model, near to but
not those of the file's own merges.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: The usual shift of ranks in the Zipf-Mandelbrot law.
MANDELBROT = 2.7
#: Words that one task remembers, at most; it starts anew beyond.
REMEMBERED = 400_000


def message_fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a serialized protocol-buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = number()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, number()
            continue
        size = number() if kind == 2 else {1: 8, 5: 4}[kind]
        yield tag >> 3, data[at : at + size]
        at += size


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with scores; control and byte pieces are not among them, for they never match text.

    normaliser: the model file whose normaliser texts go through; None: spaces become marks, with one mark before a text.
    """

    pieces: tuple[tuple[str, float], ...]
    byte_fallback: bool
    normaliser: bytes | None = None

    @staticmethod
    def from_sentencepiece(path: str) -> Vocabulary:
        """Read a unigram model file as it is, or a merge-rank one by the Zipf-Mandelbrot law; other kinds are refused."""
        import sentencepiece

        with open(path, "rb") as f:
            data = f.read()
        # fixed values of the file format: in the model, 2 is the trainer's and 3 the normaliser's part; in the first, 3 is the
        # kind (1 unigram, 2 merges) and 24 whether marks follow words; in the second, 2 is the character map, 3 whether a mark
        # comes first, 4 whether repeated spaces go and 5 whether spaces become marks
        parts = {k: dict(message_fields(v)) for k, v in message_fields(data) if k in (2, 3) and isinstance(v, bytes)}
        trainer, normal = parts.get(2, {}), parts.get(3, {})
        kind = trainer.get(3, 1)
        if kind not in (1, 2):
            raise ValueError(f"{path} is neither a unigram nor a merge-rank model")
        plain_text = not normal.get(2) and normal.get(3, 1) and not normal.get(4, 1) and normal.get(5, 1) and not trainer.get(24)
        model = sentencepiece.SentencePieceProcessor(model_proto=data)
        ids = [i for i in range(model.vocab_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        total = math.log(sum(1 / (rank + MANDELBROT) for rank in range(1, len(ids) + 1)))
        scores = [model.get_score(i) if kind == 1 else -math.log(rank + MANDELBROT) - total for rank, i in enumerate(ids, 1)]
        fallback = any(model.is_byte(i) for i in range(model.vocab_size()))
        return Vocabulary(tuple(zip(map(model.id_to_piece, ids), scores, strict=True)), fallback, None if plain_text else data)


class Counter(dict):
    """word -> (tokens, score); counts a word when it is first asked for."""

    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick

        super().__init__()
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary.pieces:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.longest = max((len(p) for p, _ in vocabulary.pieces), default=1)
        self.normaliser = None
        if vocabulary.normaliser is not None:
            import sentencepiece

            self.normaliser = sentencepiece.SentencePieceProcessor(model_proto=vocabulary.normaliser)
        self.fallback = vocabulary.byte_fallback
        self.unknown = min((s for _, s in vocabulary.pieces), default=0.0) - UNKNOWN_PENALTY
        self.by_word = not any(MARK in p.lstrip(MARK) for p, _ in vocabulary.pieces) and any(p == MARK for p, _ in vocabulary.pieces)
        # characters of no piece: words can be cut there as well
        used = {c for p, _ in vocabulary.pieces for c in p}
        self.foreign = re.compile("([" + "".join(c for c in "\n\t\r" if c not in used) + "])") if any(c not in used for c in "\n\t\r") and self.fallback else None

    def viterbi(self, s: str) -> tuple[int, float]:
        """Only as many states as the longest piece has characters are held, however long the text."""
        size = self.longest + 1
        best, count, run = [0.0] * size, [0] * size, [False] * size  # run: the best path ends in an unknown character

        def close(e: int, matches: list[tuple[int, float]]) -> None:
            top, pieces, unknown, single = float("-inf"), 0, False, False
            for length, score in matches:  # the longest first: its start is the leftmost
                if length == 1:
                    single = True
                start = (e + 1 - length) % size
                value = best[start] + score
                if value > top:
                    top, pieces, unknown = value, count[start] + 1, False
            if not single:
                value = best[e % size] + self.unknown
                if value > top:
                    added = len(s[e].encode("utf-8", "surrogatepass")) if self.fallback else int(not run[e % size])
                    top, pieces, unknown = value, count[e % size] + added, True
            at = (e + 1) % size
            best[at], count[at], run[at] = top, pieces, unknown

        at, matches = 0, []
        for end, match in self.automaton.iter(s) if len(self.automaton) else ():
            while at < end:
                close(at, matches)
                at, matches = at + 1, []
            matches.append(match)
        while at < len(s):
            close(at, matches)
            at, matches = at + 1, []
        return count[len(s) % size], best[len(s) % size]

    def __missing__(self, word: str | tuple[str]) -> tuple[int, float]:
        if len(self) >= REMEMBERED:
            self.clear()
        if isinstance(word, tuple):  # what follows a cut inside a word has no mark before it
            out = self.viterbi(word[0])
            self[word] = out
            return out
        if self.foreign and len(parts := self.foreign.split(word)) > 1:
            each = [self[p] if i == 0 else self[(p,)] for i, p in enumerate(parts) if p]
            return sum(c for c, _ in each), sum(v for _, v in each)
        out = self.viterbi(word)
        self[word] = out
        return out

    def text(self, text: str) -> tuple[int, float]:
        """(tokens, score) of a whole text; the empty text has none."""
        if not text:
            return 0, 0.0
        marked = self.normaliser.normalize(text) if self.normaliser else MARK + text.replace(" ", MARK)
        if not self.by_word:
            return self.viterbi(marked)
        tokens, score = 0, 0.0
        for word in self.words(marked):
            c, v = self[word]
            tokens += c
            score += v
        return tokens, score

    @staticmethod
    def words(marked: str) -> Iterable[str]:
        return (m[0] for m in re.finditer(f"{MARK}+[^{MARK}]*|^[^{MARK}]+", marked))

    def texts(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Tokens and scores of several texts; null is empty. Words are split and told apart by Arrow, and looked up once."""
        column = column.cast(pa.large_string()).fill_null("")
        tokens, scores = np.zeros(len(column), np.int64), np.zeros(len(column))
        slow = pc.or_(pc.match_substring(column, "  "), pc.or_(pc.match_substring(column, MARK), pc.starts_with(column, " "))).to_numpy(zero_copy_only=False)
        slow = slow | bool(self.normaliser) | (not self.by_word)
        for i in np.flatnonzero(slow):
            tokens[i], scores[i] = self.text(column[int(i)].as_py())
        fast = np.flatnonzero(~slow & (pc.binary_length(column).to_numpy(zero_copy_only=False) > 0))
        if len(fast):
            split = pc.split_pattern(column.take(pa.array(fast)), " ")
            words = split.flatten().dictionary_encode()
            each = [self[MARK + w] for w in words.dictionary.to_pylist()]
            where, starts = words.indices.to_numpy(), split.offsets.to_numpy()[:-1] - split.offsets[0].as_py()
            tokens[fast] = np.add.reduceat(np.array([c for c, _ in each], np.int64)[where], starts)
            scores[fast] = np.add.reduceat(np.array([v for _, v in each], float)[where], starts)
        return tokens, scores


_COUNTERS: dict[Vocabulary, Counter] = {}


def counter(vocabulary: Vocabulary) -> Counter:
    """Built once in each Python worker."""
    if vocabulary not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[vocabulary] = Counter(vocabulary)
    return _COUNTERS[vocabulary]


def count_tokens(docs: DataFrame, vocabulary: Vocabulary, keep: list[str], text: str = "text") -> DataFrame:
    """`keep` columns, n_tokens and best_score for each row, over the whole text.

    Null and empty texts have 0 tokens and score 0. Repeated rows are counted alike. The vocabulary is broadcast; its size
    is that of its file.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    names = [*keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(shared.value)
        for batch in batches:
            text = batch.column(batch.schema.get_field_index("__text"))
            for start, end, _, _ in common.text_slices(text, 1 << 22):
                tokens, scores = count.texts(text.slice(start, end - start))
                cols = [batch.column(i).slice(start, end - start) for i in range(len(names))]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(tokens), pa.array(scores)], names=[*names, "n_tokens", "best_score"])

    schema = "".join(f"`{c}` {t}, " for c, t in docs.select(*keep).dtypes) + "n_tokens long, best_score double"
    return common.batched(docs.select(*keep, F.col(text).alias("__text"))).mapInArrow(run, schema)
