"""Language-model scores by context-tree weighting over binary-decomposed bytes.

Each byte is eight binary decisions; each decision has a tree of contexts, the 0 to DEPTH bytes before it. Every node holds
a Krichevsky-Trofimov estimate of its decision, and the tree mixes the estimates of all depths by their evidence: a node's
weighted probability is half its own block probability and half the product of its children's. Trained on counts and then
fixed, the mixture gives one probability for each (context, byte): the deepest node that training saw for a decision has
the mixture of all depths down to it. Texts count with A-Z in lower case, so the byte of `A` is free: it stands before a text
and ends it, and no two texts share a sequence.

All contexts of all training texts are kept. Their counts are a table in the shared folder; the tree is built in slices of
whole subtrees under the two nearest bytes, and only the depths above, bounded by the alphabet, are built on the driver. The
mixtures are a table again: the most frequent contexts with a byte (HEAD_GRAMS at most) are broadcast, the rest is joined.

The word-unigram base score uses exact counts of all training tokens by 64-bit hash. The at most 2 ** 20 tokens that are
each at least that part of all tokens are broadcast; the rest, rare by that bound, are joined by a shuffle without skew.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

DEPTH = 6
#: The symbol around texts: no lower-cased text has it.
END = 65
#: Mixtures (context, byte) that are broadcast, at most; the others are joined.
HEAD_GRAMS = 1 << 21
#: Entries (context, byte) of a slice of the tree, on average.
SLICE_ENTRIES = 50_000
#: Bytes of text that counting and scoring work on at a time, and rows of a batch on its way to Spark.
PIECE_BYTES, BATCH_ROWS = 1 << 18, 1 << 17
#: A token is in the broadcast head if it is at least one in so many of all tokens; so the head has no more tokens.
HEAD = 1 << 20
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series after a shift by 8; exact to 1e-12 for x >= 0.5."""
    shift, y = np.zeros_like(x), x.copy()
    for _ in range(8):
        shift += np.log(y)
        y = y + 1
    r = 1 / (y * y)
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + (1 / 12 - r * (1 / 360 - r * (1 / 1260 - r / 1680))) / y - shift


def grams(data: np.ndarray, offsets: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """For each byte of each text and its end: the key (preceding bytes, nearest first, then the byte itself), and its row."""
    n = len(offsets) - 1
    buf = np.full(depth + len(data) + n * depth, END, np.uint8)
    rows = np.repeat(np.arange(n), np.diff(offsets))
    buf[np.arange(len(data)) + depth * (rows + 1)] = _LOWER[data]
    key = np.zeros(len(buf) - depth, np.uint64)
    for d in range(1, depth + 1):
        key |= buf[depth - d : len(buf) - d].astype(np.uint64) << np.uint64(8 * (depth - d + 1))
    key |= buf[depth:]
    told = np.zeros(len(key), bool)
    told[np.arange(len(data)) + depth * rows] = True
    told[offsets[1:] + depth * np.arange(n)] = True
    return key[told], np.repeat(np.arange(n), np.diff(offsets) + 1)


class Table:
    """uint64 -> float64 in open addressing, looked up for whole arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 1.6))))
        size = 1 << self.bits
        self.keys = np.full(size, np.uint64((1 << 64) - 1))
        self.values = np.zeros(size, values.dtype)
        left = np.arange(len(keys))
        spot = self._spot(keys)
        while len(left):
            free = self.keys[spot] == np.uint64((1 << 64) - 1)
            put, at = left[free], spot[free]
            _, first = np.unique(at, return_index=True)
            self.keys[at[first]] = keys[put[first]]
            self.values[at[first]] = values[put[first]]
            rest = self.keys[spot] != keys[left]
            left, spot = left[rest], (spot[rest] + 1) & (size - 1)

    def _spot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(values, whether found)."""
        size = 1 << self.bits
        spot = self._spot(keys)
        got = self.keys[spot]
        found = got == keys
        out = np.where(found, self.values[spot], 0)
        open_ = np.flatnonzero(~found & (got != np.uint64((1 << 64) - 1)))
        spot = spot[open_]
        while len(open_):
            spot = (spot + 1) & (size - 1)
            got, want = self.keys[spot], keys[open_]
            hit = got == want
            out[open_[hit]] = self.values[spot[hit]]
            found[open_[hit]] = True
            on = ~hit & (got != np.uint64((1 << 64) - 1))
            open_, spot = open_[on], spot[on]
        return out, found


class ContextTree:
    """The fixed mixture: built from keys and counts of (context, byte). Each of a byte's eight decisions has a tree of its own."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, depth: int, top: Top | None = None):
        """With `top`, a slice of the tree: whole subtrees under the contexts that are one byte longer than those of `top`."""
        levels = self._levels(keys, counts, depth, top.depth + 1 if top else 0)
        self.trees = [self._tree(levels, k, top) for k in range(8)]

    def log10(self, keys: np.ndarray) -> np.ndarray:
        """log10 probability of the byte of each key after its context; without any training, one in 256."""
        return sum((self._said(tree, keys, k) for k, tree in enumerate(self.trees)), np.zeros(len(keys)))

    @classmethod
    def answers(cls, keys: np.ndarray, counts: np.ndarray, depth: int, top: Top, asked: np.ndarray) -> np.ndarray:
        """What log10 of the same slice says of `asked`; one decision's tree is in memory at a time."""
        levels = cls._levels(keys, counts, depth, top.depth + 1)
        return sum((cls._said(cls._tree(levels, k, top), asked, k) for k in range(8)), np.zeros(len(asked)))

    @classmethod
    def evidence(cls, keys: np.ndarray, counts: np.ndarray, depth: int, first: int) -> tuple[np.ndarray, np.ndarray]:
        """What the nodes of the contexts of `first` bytes add to their parents: the parents and log probabilities."""
        levels = cls._levels(keys, counts, depth, first)
        found = [cls._weigh({d: cls._decisions(*levels[d], k) for d in levels}, None)[1] for k in range(8)]
        return np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found])

    @staticmethod
    def _levels(keys: np.ndarray, counts: np.ndarray, depth: int, first: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """The keys of the contexts of `first` to `depth` bytes, sorted, with their counts."""
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order].astype(np.float64)
        levels = {}
        for d in range(depth, first - 1, -1):
            levels[d] = keys, counts
            if d > first:
                shorter = ((keys >> np.uint64(16)) << np.uint64(8)) | (keys & np.uint64(255))
                order = np.argsort(shorter, kind="stable")
                shorter, counts = shorter[order], counts[order]
                new = np.flatnonzero(np.append(True, shorter[1:] != shorter[:-1])) if len(shorter) else np.zeros(0, int)
                keys, counts = shorter[new], np.add.reduceat(counts, new) if len(new) else counts
        return levels

    @classmethod
    def _tree(cls, levels: dict, k: int, top: Top | None) -> list[tuple[np.ndarray, np.ndarray]]:
        """For the decision after `k` bits, by number of bytes of context: its nodes, sorted, and their mixtures."""
        counted = {d: cls._decisions(*levels[d], k) for d in levels}
        weights, _ = cls._weigh(counted, None)
        ones, _ = cls._mix(counted, weights, top.below[k] if top else None)
        return [*(top.trees[k] if top else []), *((counted[d][0], ones[d].astype(np.float32)) for d in sorted(levels))]

    @staticmethod
    def _weigh(levels: dict, below: tuple[np.ndarray, np.ndarray] | None) -> tuple[dict[int, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        """Each node's own part in its block probability, deepest first, and what the lowest level adds to its parents.

        `below` has log probabilities of the nodes under the deepest level, by parent.
        """
        weights = {}
        for d in sorted(levels, reverse=True):
            node, n0, n1 = levels[d][0], levels[d][1].astype(np.float64), levels[d][2].astype(np.float64)
            own = log_gamma(n0 + 0.5) + log_gamma(n1 + 0.5) - np.log(np.pi) - log_gamma(n0 + n1 + 1)
            if below is None:
                weighted, weights[d] = own, np.ones(len(own), np.float32)
            else:
                parent, values = below
                at = np.searchsorted(node, parent)
                total = np.bincount(at, values, len(node)) if len(node) else np.zeros(0)
                has = np.bincount(at, minlength=len(node)) > 0
                weighted = np.where(has, np.logaddexp(own, total) - np.log(2), own)
                weights[d] = np.where(has, np.exp(own - np.log(2) - weighted), 1.0).astype(np.float32)
            below = ((node >> np.uint64(16)) << np.uint64(8)) | (node & np.uint64(255)), weighted
        return weights, below

    @staticmethod
    def _mix(levels: dict, weights: dict[int, np.ndarray], above: tuple[np.ndarray, np.ndarray, np.ndarray] | None) -> tuple[dict[int, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Mixtures, shallowest first, and of the deepest nodes the share of what deeper nodes get and what these ones say."""
        ones = {}
        for d in sorted(levels):
            node, n0, n1 = levels[d]
            estimate = (n1 + 0.5) / (n0 + n1 + 1)
            if above is None:
                share, said = np.ones(len(node)), np.zeros(len(node))
            else:
                parent = ((node >> np.uint64(16)) << np.uint64(8)) | (node & np.uint64(255))
                at = np.searchsorted(above[0], parent)
                share, said = above[1][at], above[2][at]
            ones[d] = said + share * estimate
            above = node, share * (1 - weights[d]), said + share * weights[d] * estimate
        return ones, above

    @staticmethod
    def _decisions(keys: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(context << 8 | decision) of sorted keys after `k` bits of the byte, sorted, with the counts of its 0 and 1."""
        if not len(keys):
            return np.zeros(0, np.uint64), np.zeros(0), np.zeros(0)
        byte = keys & np.uint64(255)
        name = ((keys >> np.uint64(8)) << np.uint64(8)) | (np.uint64(1) << np.uint64(k)) | (byte >> np.uint64(8 - k))
        new = np.flatnonzero(np.append(True, name[1:] != name[:-1]))
        one = ((byte >> np.uint64(7 - k)) & np.uint64(1)).astype(bool)
        return name[new], np.add.reduceat(np.where(one, 0, counts), new).astype(np.float32), np.add.reduceat(np.where(one, counts, 0), new).astype(np.float32)

    @staticmethod
    def _said(tree: list[tuple[np.ndarray, np.ndarray]], keys: np.ndarray, k: int) -> np.ndarray:
        """log10 probability of the bit after `k` bits of each key's byte, by the longest context that the tree has."""
        context, byte = keys >> np.uint64(8), keys & np.uint64(255)
        decision = (np.uint64(1) << np.uint64(k)) | (byte >> np.uint64(8 - k))
        p, left = np.full(len(keys), 0.5), np.arange(len(keys))
        for d in range(len(tree) - 1, -1, -1):
            names, values = tree[d]
            name = ((context[left] >> np.uint64(8 * (len(tree) - 1 - d))) << np.uint64(8)) | decision[left]
            at = np.searchsorted(names, name)
            found = at < len(names)
            found[found] = names[at[found]] == name[found]
            p[left[found]] = values[at[found]]
            left = left[~found]
            if not len(left):
                break
        one = ((byte >> np.uint64(7 - k)) & np.uint64(1)).astype(bool)
        return np.log10(np.where(one, p, 1 - p))


class Top:
    """The depths of the tree above its slices: contexts of 0 to `depth` bytes."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, depth: int, under: tuple[np.ndarray, np.ndarray]):
        """`under`: for nodes of the deepest contexts, the log probabilities of all nodes right under them."""
        self.depth, self.trees, self.below = depth, [], []
        levels = ContextTree._levels(keys, counts, depth, 0)
        for k in range(8):
            counted = {d: ContextTree._decisions(*levels[d], k) for d in levels}
            own = ((under[0] & np.uint64(255)) >> np.uint64(k)) == 1
            weights, _ = ContextTree._weigh(counted, (under[0][own], under[1][own]))
            ones, below = ContextTree._mix(counted, weights, None)
            self.below.append(below)
            self.trees.append([(counted[d][0], ones[d].astype(np.float32)) for d in range(depth + 1)])


class Counts:
    """How often each 64-bit key was added: keys gather as they come, and each full block of them goes into one sorted run."""

    def __init__(self, block: int):
        self.fresh, self.filled = np.empty(block, np.uint64), 0
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def add(self, keys: np.ndarray) -> None:
        at = 0
        while at < len(keys):
            n = min(len(keys) - at, len(self.fresh) - self.filled)
            self.fresh[self.filled : self.filled + n] = keys[at : at + n]
            self.filled, at = self.filled + n, at + n
            if self.filled == len(self.fresh):
                self._merge()

    def _merge(self) -> None:
        new = self.fresh[: self.filled]
        new.sort()
        first = np.flatnonzero(np.append(True, new[1:] != new[:-1])) if len(new) else np.zeros(0, int)
        keys, counts = new[first], np.diff(np.append(first, len(new)))
        at = np.searchsorted(self.keys, keys)
        old = at < len(self.keys)
        old[old] = self.keys[at[old]] == keys[old]
        self.counts[at[old]] += counts[old]
        at = at[~old]
        self.keys, self.counts = np.insert(self.keys, at, keys[~old]), np.insert(self.counts, at, counts[~old])
        self.filled = 0

    def taken(self) -> tuple[np.ndarray, np.ndarray]:
        """All distinct keys, sorted, and their counts; none is left."""
        self._merge()
        out = self.keys, self.counts
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        return out


def _count(depth: int, spill: int = 3_000_000):
    """(kind, key, n): 0 for contexts with a byte, 1 for tokens, 2 for documents; summed within a task as far as `spill` rows."""

    def batches_of(kind: int, keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(keys), BATCH_ROWS):
            part = keys[at : at + BATCH_ROWS].view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), kind, np.int32)), pa.array(part), pa.array(counts[at : at + BATCH_ROWS].astype(np.int64))], names=["kind", "key", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [Counts(min(spill, 1 << 21)), Counts(min(spill, 1 << 19))]
        docs = 0
        for batch in batches:
            docs += batch.num_rows
            for _, _, data, offsets in common.text_slices(batch.column(0), PIECE_BYTES):
                held[0].add(grams(data, offsets, depth)[0])
                held[1].add(common.word_hashes(data, offsets, inside=~_SPACE)[0])
                for kind in (0, 1):
                    if len(held[kind].keys) >= spill:
                        yield from batches_of(kind, *held[kind].taken())
        for kind in (0, 1):
            yield from batches_of(kind, *held[kind].taken())
        held.clear()
        common.released()
        yield from batches_of(2, np.zeros(1, np.uint64), np.array([docs]))

    return run


def _numbers(column: pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy().astype(np.int64).view(np.uint64)


class Mixtures:
    """The tree in slices: counts of (context, byte) as a table, and the depths above the slices."""

    def __init__(self, entries: DataFrame, n_entries: int, depth: int):
        self.entries, self.depth = entries, depth
        self.split = min(2, depth)
        self.slices = max(1, -(-n_entries // SLICE_ENTRIES))
        split = self.split

        def up(part: pa.Table) -> pa.Table:
            parent, values = ContextTree.evidence(_numbers(part["key"]), part["n"].to_numpy(), depth, split)
            names, at = np.unique(parent, return_inverse=True)
            common.released()
            return pa.table({"node": pa.array(names.view(np.int64)), "total": pa.array(np.bincount(at, values, len(names)))})

        under = self._sliced(entries.select("key", "n")).applyInArrow(up, "node long, total double").groupBy("node").agg(F.sum("total").alias("total")).toArrow()
        context = F.shiftrightunsigned("key", 8 * (depth - split + 2))
        name = F.shiftleft(context, 8).bitwiseOR(F.col("key").bitwiseAND(F.lit(255)))
        top = entries.select(name.alias("key"), "n").groupBy("key").agg(F.sum("n").alias("n")).toArrow()
        self.top = Top(_numbers(top["key"]), top["n"].to_numpy(), split - 1, (_numbers(under["node"]), under["total"].to_numpy()))

    def _sliced(self, rows: DataFrame):
        subtree = F.shiftrightunsigned("key", 8 * (self.depth - self.split + 1))
        return rows.withColumn("slice", F.pmod(F.xxhash64(subtree), F.lit(self.slices))).repartition(self.slices, "slice").groupBy("slice")

    def answers(self, unseen: DataFrame | None = None) -> DataFrame:
        """(key, n, value): the log10 probability of each counted (context, byte), or of those of `unseen` alone."""
        depth, top, alone = self.depth, self.entries.sparkSession.sparkContext.broadcast(self.top), unseen is not None

        def run(part: pa.Table) -> pa.Table:
            keys, n = _numbers(part["key"]), part["n"].to_numpy()
            asked = n == 0 if alone else n > 0
            value = np.zeros(0)
            if asked.any():
                value = ContextTree.answers(keys[n > 0], n[n > 0], depth, top.value, keys[asked])
            common.released()
            return pa.table({"key": pa.array(keys[asked].view(np.int64)), "n": pa.array(n[asked].astype(np.int64)), "value": pa.array(value.astype(np.float32))})

        rows = self.entries.select("key", "n")
        if alone:
            rows = rows.unionAll(unseen.select("key", F.lit(0).cast("long").alias("n")))
        return common.table(self._sliced(rows).applyInArrow(run, "key long, n long, value float"))


class Model:
    """What scoring needs: the tree, heads of its mixtures and of the vocabulary, totals, and the tables of the rarer ones."""

    def __init__(self, tree: Mixtures, known: Table, rest: DataFrame, head: Table, total: int, distinct: int, ends: int, tail: DataFrame):
        self.tree, self.known, self.rest, self.head, self.total, self.distinct, self.ends, self.tail = tree, known, rest, head, total, distinct, ends, tail


def train(docs: DataFrame, depth: int = DEPTH, head: int = HEAD, text: str = "text", head_grams: int = HEAD_GRAMS) -> Model:
    """Count all of `docs` and build the model. Null texts are empty; an empty table gives a model that knows nothing."""
    counted = common.batched(docs.select(F.col(text).alias("t"))).mapInArrow(_count(depth), "kind int, key long, n long")
    # a task's rows are summed already, so they are dealt out first: Spark's own table of them for each task would hold them all once more
    counts = common.table(counted.repartition("kind", "key").groupBy("kind", "key").agg(F.sum("n").alias("n")))
    sums = {r["kind"]: r for r in counts.groupBy("kind").agg(F.sum("n").alias("n"), F.count("*").alias("rows")).collect()}
    ends = int(sums[2]["n"]) if 2 in sums else 0
    total, distinct = (int(sums[1]["n"]) if 1 in sums else 0) + ends, (int(sums[1]["rows"]) if 1 in sums else 0) + (ends > 0)
    entries = counts.where("kind = 0").select("key", "n")
    n_bytes, n_entries = (int(sums[0]["n"]), int(sums[0]["rows"])) if 0 in sums else (0, 0)
    tree = Mixtures(entries, n_entries, depth)
    answers = tree.answers()
    # the frequent ones that fit into the head, by a bound on their part of all bytes
    parts = [n_bytes / 2.0**b for b in range(64)]
    fits = answers.agg(*[F.count(F.when(F.col("n") >= p, 1)).alias(f"p{b}") for b, p in enumerate(parts)]).first()
    least_part = parts[max([b for b in range(64) if fits[b] <= head_grams], default=0)]
    frequent = answers.where(F.col("n") >= least_part).select("key", "value").toArrow()
    known = Table(_numbers(frequent["key"]), frequent["value"].to_numpy())
    rest = answers.where(F.col("n") < least_part).select("key", "value")
    tokens = counts.where("kind = 1").select("key", "n")
    often = tokens.where(F.col("n") * head >= total).toArrow()
    table = Table(often["key"].to_numpy().astype(np.int64).view(np.uint64), often["n"].to_numpy().astype(np.float64))
    return Model(tree, known, rest, table, total, distinct, ends, tokens.where(F.col("n") * head < total))


def _lists(values: np.ndarray, rows: np.ndarray, n: int) -> pa.ListArray:
    bounds = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=n))]).astype(np.int32)
    return pa.ListArray.from_arrays(bounds, pa.array(values.view(np.int64)))


def _score(shared, depth: int, total: int, distinct: int, ends: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, head = shared.value
        common.released()  # of the pickled form
        norm = np.log10(total + 0.1 * (distinct + 1))
        row_id = TaskContext.get().partitionId() << 40
        for batch in batches:
            text = batch.column(batch.schema.get_field_index("__text"))
            for start, end, data, offsets in common.text_slices(text, PIECE_BYTES):
                n = end - start
                keys, rows = grams(data, offsets, depth)
                value, found = known.find(keys)
                score = np.bincount(rows, value, n)
                tokens, token_rows = common.word_hashes(data, offsets, inside=~_SPACE)
                count, often = head.find(tokens)
                base = np.bincount(token_rows[often], np.log10(count[often] + 0.1) - norm, n) + (np.log10(ends + 0.1) - norm)
                n_known = np.bincount(token_rows[often], minlength=n) + (ends > 0)
                lists = [_lists(tokens[~often], token_rows[~often], n), _lists(keys[~found], rows[~found], n)]
                cols = [batch.column(i).slice(start, n) for i, name in enumerate(batch.schema.names) if name != "__text"]
                out = [np.arange(row_id, row_id + n), np.bincount(token_rows, minlength=n) + 1, n_known.astype(np.int64), base, score]
                row_id += n
                yield pa.RecordBatch.from_arrays([*cols, *map(pa.array, out), *lists], names=[*names, "__row", "n_tokens", "__known", "__base", "__score", "__rare", "__grams"])

    return run


def score(docs: DataFrame, model: Model, keep: list[str], text: str = "text", trained: Column | None = None) -> DataFrame:
    """`keep` columns, n_tokens, n_known, train_tokens, base_score and score (log10 of the text's probability) for each row.

    trained: rows that the model learned from; all their contexts are known, so only the others' are looked for among those
    it has not seen. Null and empty texts are an end alone. Repeated rows are scored alike; texts of any length are scored
    whole.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((model.known, model.head))
    chosen = docs.select(*keep, F.coalesce(F.lit(False) if trained is None else trained, F.lit(False)).alias("__trained"), F.col(text).alias("__text"))
    schema = "".join(f"`{c}` {t}, " for c, t in docs.select(*keep).dtypes) + "__trained boolean, __row long, n_tokens long, __known long, __base double, __score double, __rare array<long>, __grams array<long>"
    told = common.table(common.batched(chosen).mapInArrow(_score(shared, model.tree.depth, model.total, model.distinct, model.ends, [*keep, "__trained"]), schema))
    norm = float(np.log10(model.total + 0.1 * (model.distinct + 1)))
    each = told.select("__row", F.explode("__rare").alias("key")).join(model.tail, "key", "left")
    seen = F.coalesce(F.col("n"), F.lit(0))
    sums = each.groupBy("__row").agg(F.sum(F.log10(seen + 0.1) - norm).alias("__more"), F.count("n").alias("__seen"))
    asked = told.select("__row", F.explode("__grams").alias("key"))
    new = told.where(~F.col("__trained")).select(F.explode("__grams").alias("key")).distinct()
    unseen = common.table(new.join(model.rest, "key", "left_anti"))
    rest = model.rest if unseen.isEmpty() else model.rest.unionAll(model.tree.answers(unseen).select("key", "value"))
    more = asked.join(rest, "key").groupBy("__row").agg(F.sum("value").alias("__others"))
    out = told.drop("__rare", "__grams").join(sums, "__row", "left").join(more, "__row", "left")
    n_known, base = F.col("__known") + F.coalesce("__seen", F.lit(0)), F.col("__base") + F.coalesce("__more", F.lit(0.0))
    return out.select(*keep, "n_tokens", n_known.alias("n_known"), F.lit(model.total).cast("long").alias("train_tokens"), base.alias("base_score"), (F.col("__score") + F.coalesce("__others", F.lit(0.0))).alias("score"))
