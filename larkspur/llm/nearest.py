"""Approximate nearest neighbours with an inverted multi-index.

Both halves of a vector are quantised separately, so K centroids a half make K * K cells. A query sorts each half's
centroids by inner product and visits cells by rising summed distance with a heap, until the visited cells hold a share of
all vectors; their entries are reranked by the exact inner product in double precision. The share is measured, not set:
for a bounded sample of queries the true neighbours are found by one pass over all rows, and the share is the least that
gives this sample the recall asked for. Vectors in clusters need a small share; for vectors spread evenly over a sphere of
many dimensions it rises towards all, which no index avoids at such a recall.

Queries are dealt into chunks of the same neighbourhood and entries into blocks by hash, so a cell that holds a third of
all vectors is spread over all blocks. An entry goes only to the chunks that visit its cell.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import common

CENTROIDS = 64
#: Vectors that the centroids are fitted on, at most; those first by the hash of vec_id.
SAMPLE = 8_192
#: Queries whose true neighbours the share is measured by, at most; those first by hash.
MEASURED = 256
#: Recall of that sample.
RECALL = 0.95
#: Entries of a block and queries of a chunk, at most; a block also has at most BLOCK_VALUES components.
BLOCK, CHUNK, BLOCK_VALUES = 65_536, 1_024, 1 << 23
#: Entries that one matrix product takes.
SLICE = 8_192


def usable(vector: Column) -> Column:
    """Not null, not empty, not zero, all components finite and not null."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.coalesce(bad, F.lit(True)) & F.exists(vector, lambda x: x != 0)


def kmeans(x: np.ndarray, k: int, steps: int = 12, seed: int = 0) -> np.ndarray:
    """At most k centroids; starts from distinct rows."""
    distinct = np.unique(x, axis=0)
    draw = np.random.default_rng(seed)
    centres = distinct[draw.permutation(len(distinct))[:k]]
    for _ in range(steps):
        near = nearest_centre(x, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        counts = np.bincount(near, minlength=len(centres))
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


def nearest_centre(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(axis=1) - 2 * x @ centres.T).argmin(axis=1)


class MultiIndex:
    """Centroids of both halves, and the number of vectors in each cell."""

    def __init__(self, sample: np.ndarray, centroids: int = CENTROIDS):
        self.half = sample.shape[1] // 2
        self.first, self.second = kmeans(sample[:, : self.half], centroids), kmeans(sample[:, self.half :], centroids, seed=1)
        self.counts = np.zeros(len(self.first) * len(self.second), np.int64)

    def cells(self, x: np.ndarray) -> np.ndarray:
        return nearest_centre(x[:, : self.half], self.first) * len(self.second) + nearest_centre(x[:, self.half :], self.second)

    def order(self, query: np.ndarray, due: float) -> np.ndarray:
        """Cells by rising summed distance, until they hold `due` vectors."""
        a, b = -(self.first @ query[: self.half]), -(self.second @ query[self.half :])
        order_a, order_b = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
        da, db = a[order_a].tolist(), b[order_b].tolist()
        counts = self.counts.reshape(len(a), len(b))[np.ix_(order_a, order_b)].tolist()
        heap = [(da[0] + db[0], 0, 0)]
        taken, seen = [], 0
        while heap and seen < due:
            _, i, j = heap[0]
            if j == 0 and i + 1 < len(da):
                heapq.heappush(heap, (da[i + 1] + db[0], i + 1, 0))
            # the pair just read is still the smallest: only larger ones came in
            if j + 1 < len(db):
                heapq.heapreplace(heap, (da[i] + db[j + 1], i, j + 1))
            else:
                heapq.heappop(heap)
            taken.append((i, j))
            seen += counts[i][j]
        ij = np.array(taken, np.int64).reshape(-1, 2)
        return order_a[ij[:, 0]] * len(b) + order_b[ij[:, 1]]

    def visit(self, query: np.ndarray, due: float) -> np.ndarray:
        """A flag for each cell: visited before the cells held `due` vectors."""
        flags = np.zeros(len(self.counts), bool)
        flags[self.order(query, due)] = True
        return flags

    def share_of(self, queries: np.ndarray, owners: np.ndarray, cells: np.ndarray, recall: float) -> float:
        """The least share of all vectors that holds `recall` of the neighbours: rows of `owners` (a query) and `cells`."""
        total, needed = max(1, self.counts.sum()), np.zeros(len(cells))
        for q in np.unique(owners):
            order = self.order(queries[q], float("inf"))
            reached = np.zeros(len(self.counts))
            reached[order] = np.cumsum(self.counts[order]) / total
            needed[owners == q] = reached[cells[owners == q]]
        return float(np.sort(needed)[max(0, int(np.ceil(recall * len(needed))) - 1)]) if len(needed) else 1.0


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Lists of one length as a matrix of doubles."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def best(x: np.ndarray, own: np.ndarray, ids: np.ndarray, q: np.ndarray, asked: np.ndarray, k: int, seen: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, entry, score): the k entries of largest product for each row of q, but for itself; ties to smaller ids.

    own, asked: names of entries and queries. seen: whether a query may take an entry.
    """
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for at in range(0, len(x), SLICE):
        part = x[at : at + SLICE]
        near = q @ part.T
        near[asked[:, None] == own[None, at : at + SLICE]] = -np.inf
        if seen is not None:
            near[~seen[:, at : at + SLICE]] = -np.inf
        if len(part) > k:
            least = np.partition(near, len(part) - k, axis=1)[:, len(part) - k]
            # products of a matrix differ in their last bits by place: take what may tie, then sum each row alike
            least = np.where(np.isfinite(least), least - 1e-9 * (1 + np.abs(least)), -np.inf)
            who, which = np.nonzero((near >= least[:, None]) & np.isfinite(near))
        else:
            who, which = np.nonzero(np.isfinite(near))
        out.append((who, which + at, (part[which] * q[who]).sum(axis=1)))
    who, which, score = (np.concatenate([o[c] for o in out]) for c in range(3))
    order = np.lexsort((ids[which], -score, who))
    who, which, score = who[order], which[order], score[order]
    starts = np.flatnonzero(np.append(True, who[1:] != who[:-1])) if len(who) else np.zeros(0, int)
    turn = np.arange(len(who)) - np.repeat(starts, np.diff(np.append(starts, len(who))))
    return who[turn < k], which[turn < k], score[turn < k]


def search(vectors: DataFrame, queries: Column, k: int = 20, recall: float = RECALL, centroids: int = CENTROIDS, sample: int = SAMPLE, measured: int = MEASURED, block: int = BLOCK, chunk: int = CHUNK, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for each row that `queries` (a condition on vec_id) selects, its k best found.

    Candidates are all other rows, a vec_id's other vectors too; rows that repeat vec_id and vector are one. Null ids and
    vectors that are not usable take no part. A product needs one length: rows of each length are searched among
    themselves, by an index of their own. Ties go to the smaller vec_id. An empty table gives no rows.
    """
    base = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("v")).where(F.col("vec_id").isNotNull() & usable(F.col("v")))
    kind, values = dict(base.dtypes)["vec_id"], dict(base.dtypes)["v"]
    base = common.table(base.groupBy("vec_id", "v").count().select("vec_id", "v", F.monotonically_increasing_id().alias("row"), F.size("v").alias("d")))
    lengths = [(r["d"], r["n"]) for r in base.groupBy("d").agg(F.count("*").alias("n")).orderBy("d").collect()]
    found = [_search(base.where(F.col("d") == d).drop("d"), n, d, kind, values, queries, k, recall, centroids, sample, measured, block, chunk) for d, n in lengths]
    if not found:
        return vectors.sparkSession.createDataFrame([], f"query_id {kind}, rank int, vec_id {kind}, score double")
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    order = W.partitionBy("asked").orderBy(F.desc("score"), "vec_id")
    return out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _search(base: DataFrame, n: int, d: int, kind: str, values: str, queries: Column, k: int, recall: float, centroids: int, sample: int, measured: int, block: int, chunk: int) -> DataFrame:
    """asked, query_id, vec_id, score: the k best of each block, for vectors of d components."""
    context = base.sparkSession.sparkContext
    fitted = base.orderBy(F.xxhash64("vec_id"), "vec_id", "row").limit(sample).select("v").toArrow()
    index = MultiIndex(_matrix(fitted["v"]), centroids)
    shared = context.broadcast(index)

    def to_cells(batches):
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(shared.value.cells(_matrix(b.column(1))).astype(np.int32))], names=["vec_id", "v", "row", "cell"])

    rows = common.table(base.select("vec_id", "v", "row").mapInArrow(to_cells, f"vec_id {kind}, v {values}, row long, cell int"))
    for r in rows.groupBy("cell").agg(F.count("*").alias("n")).collect():  # one number a cell
        index.counts[r["cell"]] = r["n"]

    # the true neighbours of a bounded sample, k for each task and query
    trial = rows.where(queries).orderBy(F.xxhash64("vec_id", F.lit(1)), "vec_id", "row").limit(measured).select("row", "v").toArrow()
    if not trial.num_rows:
        return base.sparkSession.createDataFrame([], f"asked long, query_id {kind}, vec_id {kind}, score double")
    tried = context.broadcast((_matrix(trial["v"]), trial["row"].to_numpy()))

    def to_true(batches):
        q, asked = tried.value
        held = [np.zeros((0, d)), np.zeros(0, np.int64), np.zeros(0, np.int32)]
        for b in batches:
            held = [np.concatenate([h, c]) for h, c in zip(held, (_matrix(b.column(0)), b.column(1).to_numpy(), b.column(2).to_numpy()), strict=True)]
            keep = np.unique(best(held[0], held[1], held[1], q, asked, k)[1])
            held = [h[keep] for h in held]
        if len(held[0]):
            who, which, score = best(held[0], held[1], held[1], q, asked, k)
            yield pa.RecordBatch.from_arrays([pa.array(who), pa.array(held[2][which]), pa.array(score), pa.array(held[1][which])], names=["who", "cell", "score", "row"])

    true = rows.select("v", "row", "cell").mapInArrow(to_true, "who long, cell int, score double, row long")
    top = W.partitionBy("who").orderBy(F.desc("score"), "row")
    true = true.withColumn("rank", F.row_number().over(top)).where(F.col("rank") <= k).select("who", "cell").toArrow()
    share = index.share_of(tried.value[0], true["who"].to_numpy(), true["cell"].to_numpy(), recall)
    due = max(k + 1, int(np.ceil(share * n)))
    counted = context.broadcast(index)

    def to_visits(batches):
        for b in batches:
            if b.num_rows:
                orders = [counted.value.order(q, due) for q in _matrix(b.column(1))]
                flags = np.zeros((len(orders), len(counted.value.counts)), bool)
                for own, order in zip(flags, orders, strict=True):
                    own[order] = True
                packed = [np.packbits(f).tobytes() for f in flags]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array([int(o[0]) for o in orders], pa.int32()), pa.array(packed, pa.binary())], names=["query_id", "q", "asked", "start", "visited"])

    asked = rows.where(queries).select("vec_id", "v", "row").repartition(max(1, min(1024, n // 256)), "row")
    asked = common.table(asked.mapInArrow(to_visits, f"query_id {kind}, q {values}, asked long, start int, visited binary"))
    # neighbouring first cells make a chunk; a cell of more queries than a chunk takes is dealt over several
    first, chunks, filled = [], 0, chunk
    for r in asked.groupBy("start").agg(F.count("*").alias("n")).orderBy("start").collect():  # one number a cell
        if filled + r["n"] > chunk:
            own = -(-r["n"] // chunk)
            first.append((r["start"], chunks, own))
            chunks, filled = chunks + own, r["n"] if own == 1 else chunk
        else:
            first.append((r["start"], chunks - 1, 1))
            filled += r["n"]
    dealt = F.broadcast(base.sparkSession.createDataFrame(first, "start int, first int, parts int"))
    asked = common.table(asked.join(dealt, "start").select("query_id", "q", "asked", "visited", (F.col("first") + F.pmod(F.xxhash64("asked"), F.col("parts"))).cast("int").alias("chunk")))

    def to_cells_of_chunk(part: pa.Table) -> pa.Table:
        seen = np.bitwise_or.reduce(np.stack([np.frombuffer(v, np.uint8) for v in part["visited"].to_pylist()]))
        cells = np.flatnonzero(np.unpackbits(seen)).astype(np.int32)
        return pa.table({"chunk": pa.array(np.full(len(cells), part["chunk"][0].as_py(), np.int32)), "cell": pa.array(cells)})

    reached = common.cut(asked.select("chunk", "visited").groupBy("chunk").applyInArrow(to_cells_of_chunk, "chunk int, cell int"))
    size = max(min(block, n // 64), min(block, SLICE), 1)
    blocks = max(1, -(-n // max(1, min(size, max(1024, BLOCK_VALUES // d)))))
    left = rows.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")).join(common.broadcast_if_small(reached), "cell")
    right = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def rerank(own: pa.Table, ask: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], []]
        if own.num_rows and ask.num_rows:
            x, names, ids, cell = _matrix(own["v"]), own["row"].to_numpy(), own["vec_id"].to_numpy(), own["cell"].to_numpy()
            q, asking, qid = _matrix(ask["q"]), ask["asked"].to_numpy(), ask["query_id"].to_numpy()
            visited = ask["visited"].to_pylist()
            for at in range(0, len(q), 256):
                seen = np.unpackbits(np.stack([np.frombuffer(v, np.uint8) for v in visited[at : at + 256]]), axis=1).astype(bool)
                who, which, score = best(x, names, ids, q[at : at + 256], asking[at : at + 256], k, seen[:, cell])
                for o, c in zip(out, (asking[at + who], qid[at + who], ids[which], score), strict=True):
                    o.append(c)
        made = [np.concatenate(o) if o else [] for o in out]
        types = own.schema.field("vec_id").type
        return pa.table({"asked": pa.array(made[0], pa.int64()), "query_id": pa.array(made[1], types), "vec_id": pa.array(made[2], types), "score": pa.array(made[3], pa.float64())})

    return left.select("vec_id", "v", "row", "cell", "block", "chunk").groupBy("block", "chunk").cogroup(right.groupBy("block", "chunk")).applyInArrow(rerank, f"asked long, query_id {kind}, vec_id {kind}, score double")
