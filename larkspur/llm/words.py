"""Words of whole texts as Arrow arrays, found byte by byte with numpy; nothing runs once a word in Python."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

#: Bytes that one pass looks at; a longer text is read in several, cut between words.
SPAN = 1 << 22

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def byte_set(*members: str | range) -> np.ndarray:
    """A mask over the 256 bytes."""
    mask = np.zeros(256, bool)
    for m in members:
        mask[[ord(c) for c in m] if isinstance(m, str) else list(m)] = True
    return mask


def split(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray, breaks: np.ndarray | None = None, span: int = SPAN) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(words, row of each, number of `breaks` bytes before each) of texts that lie in `data` from offset to offset.

    A word is a run of `inside` bytes within a text; A-Z are lower-cased.
    """
    words, rows, broken, at, n, before = [], [], [], 0, len(data), 0
    while at < n:
        stop = min(n, at + span)
        if stop < n and inside[data[stop - 1]] and inside[data[stop]]:
            back = np.flatnonzero(~inside[data[at:stop]])
            ahead = np.flatnonzero(~inside[data[stop:]]) if not len(back) else ()
            stop = at + int(back[-1]) + 1 if len(back) else stop + int(ahead[0]) if len(ahead) else n
        part = LOWER[data[at:stop]]
        is_word = inside[part]
        begin = is_word.copy()
        begin[1:] &= ~is_word[:-1]
        inner = offsets[(offsets > at) & (offsets < stop)] - at
        begin[inner] = is_word[inner]
        starts = np.flatnonzero(begin)
        if len(starts):
            ends = np.cumsum(np.add.reduceat(is_word, starts, dtype=np.int32), dtype=np.int32)
            words.append(pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(np.concatenate([np.zeros(1, np.int32), ends])), pa.py_buffer(part[is_word])]))
            rows.append(np.searchsorted(offsets[1:], starts + at, "right"))
        if breaks is not None:
            where = np.flatnonzero(breaks[part])
            broken.append(before + np.searchsorted(where, starts))
            before += len(where)
        at = stop
    none = np.zeros(0, np.int64)
    joined = pa.concat_arrays(words) if words else pa.array([], pa.string())
    return joined, np.concatenate(rows) if rows else none, np.concatenate(broken) if broken else none


def seeded_hashes(seeds: list[str], words: list[str], seed_of: np.ndarray) -> np.ndarray:
    """The 64-bit hash of each (seed, word), the same as Spark's xxhash64 of the two columns (as unsigned)."""
    first = [xxhash.xxh64_intdigest(s.encode(), 42) for s in seeds]
    return np.fromiter((xxhash.xxh64_intdigest(w.encode(), first[s]) for s, w in zip(seed_of, words, strict=True)), np.uint64, len(words))
