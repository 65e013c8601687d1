"""Quality classifier: a sparse rule ensemble.

Statistics of each whole text come from one numpy pass over its bytes. Small trees are grown on a bounded sample of
labelled rows; every path from a root to a node is a rule, a conjunction of bounds on statistics. A lasso logistic
regression gives most rules weight 0; the others become one Spark column expression.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

STATISTICS = ["n_bytes", "n_words", "n_lines", "letters", "upper", "digits", "stops", "symbols", "high", "word_length", "short_words", "long_words", "distinct_words", "same_as_last", "distinct_lines", "repeated_shingles", "symbol_ends"]
#: Labelled rows that a fit takes, at most.
SAMPLE = 4_000

_KIND = np.zeros(256, np.uint8)  # 0 other controls, 1 lower, 2 upper, 3 digit, 4 sentence mark, 5 symbol, 6 high, 7 space
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[128:] = 1, 2, 3, 6
_KIND[[33, *range(35, 39), *range(42, 44), 47, *range(60, 65), *range(91, 97), *range(123, 127)]] = 5
_KIND[[34, 39, 40, 41, 44, 45, 46, 58, 59]] = 4
_KIND[[32, *range(9, 14)]] = 7
_NOT_SPACE, _NOT_LINE = _KIND != 7, np.arange(256) != 10


def _distinct(hashes: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Distinct hashes of each row."""
    order = np.lexsort((hashes, rows))
    h, r = hashes[order], rows[order]
    new = np.append(True, (h[1:] != h[:-1]) | (r[1:] != r[:-1])) if len(h) else np.zeros(0, bool)
    return np.bincount(r[new], minlength=n)


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(texts, STATISTICS): counts, and shares of bytes, words or lines; an empty text has 0 everywhere."""
    n = len(offsets) - 1
    out = np.zeros((n, len(STATISTICS)))
    sizes = np.diff(offsets)
    out[:, 0] = sizes
    if not len(data):
        return out
    kinds = np.bincount(np.repeat(np.arange(n), sizes) * 8 + _KIND[data], minlength=8 * n).reshape(n, 8)
    words, rows = common.word_hashes(data, offsets, inside=_NOT_SPACE)
    lines, line_rows = common.word_hashes(data, offsets, inside=_NOT_LINE)
    n_words, n_lines = np.bincount(rows, minlength=n), np.bincount(line_rows, minlength=n)
    some, by_word, by_line = np.maximum(sizes, 1), np.maximum(n_words, 1), np.maximum(n_lines, 1)
    inside = _NOT_SPACE[data]
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    firsts = offsets[1:-1][(offsets[1:-1] < len(data)) & (offsets[1:-1] > 0)]
    begin[firsts], end[firsts - 1] = inside[firsts], inside[firsts - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end)
    length = ends - starts + 1
    same = np.append(False, (words[1:] == words[:-1]) & (rows[1:] == rows[:-1])) if len(words) else np.zeros(0, bool)
    shingles, shingle_rows = common.shingle_hashes(words, rows, n, 3)
    n_shingles = np.bincount(shingle_rows, minlength=n)
    share = [kinds[:, 1] + kinds[:, 2], kinds[:, 2], kinds[:, 3], kinds[:, 4], kinds[:, 5], kinds[:, 6]]
    for k, x in enumerate(share):
        out[:, 3 + k] = x / some
    out[:, 1], out[:, 2] = n_words, n_lines
    out[:, 9] = np.bincount(rows, length, n) / by_word
    out[:, 10] = np.bincount(rows[length <= 2], minlength=n) / by_word
    out[:, 11] = np.bincount(rows[length >= 16], minlength=n) / by_word
    out[:, 12] = _distinct(words, rows, n) / by_word
    out[:, 13] = np.bincount(rows[same], minlength=n) / by_word
    out[:, 14] = _distinct(lines, line_rows, n) / by_line
    out[:, 15] = np.where(n_shingles > 0, 1 - _distinct(shingles, shingle_rows, n) / np.maximum(n_shingles, 1), 0.0)
    out[:, 16] = np.bincount(rows[_KIND[data[ends]] == 5], minlength=n) / by_word
    return out


def _measure(keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(batch.schema.get_field_index("__text"))
            for start, end, data, offsets in common.text_slices(text):
                found = statistics(data, offsets)
                cols = [batch.column(i).slice(start, end - start) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*cols, *map(pa.array, found.T.copy())], names=[*keep, *STATISTICS])

    return run


def measured(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """`keep` columns and STATISTICS for each row; null texts are empty. Repeated rows stay, each with its own."""
    schema = "".join(f"`{c}` {t}, " for c, t in docs.select(*keep).dtypes) + ", ".join(f"{s} double" for s in STATISTICS)
    return common.batched(docs.select(*keep, F.col(text).alias("__text"))).mapInArrow(_measure(keep), schema)


Rule = tuple[tuple[int, bool, float], ...]


def grow(x: np.ndarray, y: np.ndarray, draw: np.random.Generator, depth: int, rule: Rule = (), cuts: int = 24) -> list[Rule]:
    """Rules of a tree: at each node the cut that lowers the Gini impurity most, of quantiles of half the statistics."""
    if depth == 0 or len(y) < 12 or y.min() == y.max():
        return []
    best = (1e-6, None)
    gini = y.mean() * (1 - y.mean())
    for f in draw.permutation(x.shape[1])[: (x.shape[1] + 1) // 2]:
        at = np.unique(np.quantile(x[:, f], np.linspace(0.02, 0.98, cuts)))
        below = x[:, f][:, None] <= at
        n = below.sum(axis=0)
        ones = (below & (y[:, None] > 0.5)).sum(axis=0)
        ok = (n >= 5) & (len(y) - n >= 5)
        if not ok.any():
            continue
        a, b = ones / np.maximum(n, 1), (y.sum() - ones) / np.maximum(len(y) - n, 1)
        gain = np.where(ok, gini - (n * a * (1 - a) + (len(y) - n) * b * (1 - b)) / len(y), 0)
        k = int(gain.argmax())
        if gain[k] > best[0]:
            best = (gain[k], (int(f), float(at[k])))
    if best[1] is None:
        return []
    f, t = best[1]
    out: list[Rule] = []
    for side in (True, False):
        inside = (x[:, f] <= t) == side
        own = (*rule, (f, side, t))
        out += [own, *grow(x[inside], y[inside], draw, depth - 1, own, cuts)]
    return out


def applies(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for f, below, t in rule:
        out &= (x[:, f] <= t) == below
    return out


def lasso(m: np.ndarray, y: np.ndarray, penalty: float, steps: int = 600) -> tuple[float, np.ndarray]:
    """Logistic weights under an L1 penalty (free intercept) by accelerated proximal gradient steps."""
    n = len(y)
    step = 4.0 / (np.linalg.norm(np.column_stack([np.ones(n), m]), 2) ** 2 / n + 1e-9)
    rate = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    b, w = float(np.log(rate / (1 - rate))), np.zeros(m.shape[1])
    bb, ww, t = b, w.copy(), 1.0
    for _ in range(steps):
        error = (1 / (1 + np.exp(-np.clip(bb + m @ ww, -30, 30))) - y) / n
        b2 = bb - step * error.sum()
        w2 = ww - step * (m.T @ error)
        w2 = np.sign(w2) * np.maximum(np.abs(w2) - step * penalty, 0)
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        bb, ww = b2 + (t - 1) / t2 * (b2 - b), w2 + (t - 1) / t2 * (w2 - w)
        b, w, t = b2, w2, t2
    return float(b), w


class RuleEnsemble:
    """An intercept and weighted rules."""

    def __init__(self, intercept: float, rules: list[tuple[Rule, float]]):
        self.intercept, self.rules = intercept, rules

    def column(self) -> Column:
        """The probability of label 1 as one expression over STATISTICS."""
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            holds = F.lit(True)
            for f, below, t in rule:
                bound = F.col(STATISTICS[f]) <= t if below else F.col(STATISTICS[f]) > t
                holds = holds & bound
            total = total + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 30, depth: int = 3, penalty: float = 2e-3, seed: int = 3) -> RuleEnsemble:
    """Without labels the score is 0.5; with one label alone it is near that label for all."""
    if not len(y):
        return RuleEnsemble(0.0, [])
    if y.min() == y.max():
        return RuleEnsemble(4.0 if y[0] > 0.5 else -4.0, [])
    draw = np.random.default_rng(seed)
    rules: dict[Rule, None] = {}
    for _ in range(trees):
        part = draw.integers(0, len(y), len(y))
        rules |= dict.fromkeys(grow(x[part], y[part], draw, depth))
    names = [*rules]
    matrix = np.column_stack([applies(r, x) for r in names]).astype(float) if names else np.zeros((len(y), 0))
    intercept, weights = lasso(matrix, y, penalty)
    return RuleEnsemble(intercept, [(r, float(w)) for r, w in zip(names, weights, strict=True) if abs(w) > 1e-6])


def train(stats: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", sample: int = SAMPLE) -> RuleEnsemble:
    """Fit on at most `sample` labelled rows of `stats`, those that come first by the hash of doc_id. Null labels do not count."""
    marks = labels.select(F.col(doc_id).alias("__id"), F.col(label).cast("double").alias("__label")).where("__id is not null and __label is not null")
    marks = marks.groupBy("__id").agg(F.max("__label").alias("__label"))
    rows = stats.join(marks, F.col(doc_id) == F.col("__id")).orderBy(F.xxhash64("__id"), "__id", *STATISTICS).limit(sample).select("__label", *STATISTICS)
    table = rows.toArrow()
    x = np.column_stack([table[s].to_numpy() for s in STATISTICS]) if table.num_rows else np.zeros((0, len(STATISTICS)))
    return fit(x, table["__label"].to_numpy() if table.num_rows else np.zeros(0))


def score(stats: DataFrame, model: RuleEnsemble) -> DataFrame:
    """`stats` with score, the probability of label 1; empty texts are scored by their statistics, all 0."""
    return stats.withColumn("score", model.column())
