"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

A document stands on the ring where the hash of its text falls, so equal texts stand together. The ring is cut into equal
cells, which are its keys. A cell belongs to the next virtual node clockwise; where that node's shard has no room (its load
would pass (1 + slack) x mean), the cell goes on clockwise to the next shard with room. Cells arrive in the order of their
hashes, which does not depend on their loads, but for the few that hold more than LARGE of a shard: those come first.

What fits nowhere is cut: first by text, so that equal texts still stand together, then by document, into as many pieces as
the slack asks for; the pieces overflow clockwise in the same way. As the free room of all shards is slack x the total, a
piece of at most slack x mean always fits somewhere. A document cannot be cut, so one that is larger than any room left goes
to the least loaded shard; so do equal texts that are together no larger than COPIES times the largest document. What the driver holds is one number a cell or piece, however many rows there are.
"""

from __future__ import annotations

import bisect

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import common

#: Cells of the ring: this many at least, and MOST_CELLS at most; between them 2,048 for each shard.
CELLS, MOST_CELLS = 1 << 14, 1 << 18
#: With so many, one more shard moves little more than its own share.
VIRTUAL_NODES = 512
#: A shard holds at most (1 + SLACK) x the mean; with 8 shards none then holds less than 0.9986 x the mean.
SLACK = 0.0002
#: Cells of more than this part of a shard are placed before all others, so that they find room as a whole.
LARGE = 0.002
#: Equal texts of up to so many times the size of the largest document are never cut.
COPIES = 8
#: Rows of a cell that are numbered in one task, on average.
NUMBERED = 1_000


def _hash(name: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(name.encode())


def ring(shards: int, virtual_nodes: int = VIRTUAL_NODES) -> list[tuple[int, int]]:
    """(position, shard) of each virtual node, clockwise; positions are 64-bit."""
    return sorted((_hash(f"shard-{s}/{v}"), s) for s in range(shards) for v in range(virtual_nodes))


class BoundedRing:
    """Places loads one after the other: on the owner of their position or the next shard clockwise with room."""

    def __init__(self, shards: int, total: int, slack: float, virtual_nodes: int = VIRTUAL_NODES):
        self.nodes = ring(shards, virtual_nodes)
        self.at = [p for p, _ in self.nodes]
        self.capacity = (1 + slack) * total / shards
        self.load = [0] * shards

    def place(self, position: int, load: int) -> int | None:
        """The shard, or None if no shard has room for a load of this size."""
        k = bisect.bisect_left(self.at, position)
        seen: set[int] = set()
        for j in range(len(self.nodes)):
            s = self.nodes[(k + j) % len(self.nodes)][1]
            if s in seen:
                continue
            if self.load[s] + load <= self.capacity:
                self.load[s] += load
                return s
            seen.add(s)
            if len(seen) == len(self.load):
                return None
        return None

    def least(self, load: int) -> int:
        """The least loaded shard, for what is larger than any room left and is not cut."""
        s = min(range(len(self.load)), key=lambda i: (self.load[i], i))
        self.load[s] += load
        return s


def _pieces(hashed: Column, pieces: int) -> Column:
    return F.pmod(hashed, F.lit(pieces)).cast("int")


def assign(docs: DataFrame, shards: int = 8, slack: float = SLACK, cells: int | None = None, virtual_nodes: int = VIRTUAL_NODES, text: str = "text", doc_id: str = "doc_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """A row for each row of `docs`: doc_id, the `keep` columns, size, text_crc32, shard, slot.

    size: UTF-8 bytes of the text (null: none) plus 1. A shard's sum of sizes passes the mean by at most `slack` and COPIES
    times the largest document (all rows of one doc_id and text are one). Equal texts share a shard unless they are more
    than half a shard, or fit nowhere and are larger than COPIES times the largest document. slot numbers a shard's rows from 0 without gaps; rows that agree in doc_id and
    text are interchangeable. Null doc_ids hash as the text's. A `keep` column that bears the name of a result is
    returned as `kept_` and its name. An empty table gives no rows.
    """
    spark = docs.sparkSession
    cells = cells or min(MOST_CELLS, max(CELLS, 1 << (2048 * shards - 1).bit_length()))
    content = F.coalesce(F.col(text), F.lit("")).cast("binary")
    base = docs.select(F.col(doc_id).alias("doc_id"), (F.length(content) + 1).cast("long").alias("size"), F.crc32(content).alias("text_crc32"), F.xxhash64(content).alias("__place"), common.row_key(doc_id, text).alias("__key"), *[F.col(c).alias(f"__keep{i}") for i, c in enumerate(keep)])
    # a cell is a run of the ring, named by its place in it
    base = common.cut(base.withColumn("__cell", F.shiftrightunsigned("__place", 65 - cells.bit_length()).cast("int")))
    sizes = base.groupBy("__cell").agg(F.sum("size"), F.max("size")).collect()
    loads, largest = [(r[0], int(r[1])) for r in sizes], max((r[2] for r in sizes), default=0)
    total = sum(n for _, n in loads)
    circle = BoundedRing(shards, max(1, total), slack, virtual_nodes)
    step = (1 << 64) // cells
    large = LARGE * total / shards

    def settle(named: list[tuple], where, cut: float = 0) -> tuple[list[tuple], list[tuple]]:
        """Placed names with their shards, and the names and loads that fit nowhere; up to a load of `cut` everything is placed."""
        done, left = [], []
        for *name, load in sorted(named, key=lambda x: (-x[-1] if x[-1] > large or cut else 0, x[:-1])):
            shard = None if circle.capacity / 2 < load > cut else circle.place(where(*name), load)
            if shard is None and load <= cut:
                shard = circle.least(load)
            if shard is None:
                left.append((*name, load))
            else:
                done.append((*name, shard))
        return done, left

    def asked(left: list[tuple]) -> int:
        """Pieces to cut each of these into, so that a piece is about half of the room that always remains."""
        return int(min(1 << 20, max(2, 2 * max(x[-1] for x in left) / max(1.0, slack * total / shards)))) if left else 1

    def sums(cut: list[tuple], of: list[str], by: Column, name: str) -> list[tuple]:
        """Loads of the pieces of what was cut: the driver gets as many numbers as were asked for in all."""
        names = spark.createDataFrame([x[:-1] for x in cut], ", ".join(f"{c} int" for c in of))
        rows = base.join(common.broadcast_if_small(names), of, "left_semi").groupBy(*of, by.alias(name)).agg(F.sum("size").alias("n"))
        return [(*r[:-1], int(r[-1])) for r in rows.collect()]

    whole, open_cells = settle(loads, lambda c: c * step)
    by_text, n_text = F.xxhash64("__place", F.lit(3)), asked(open_cells)
    texts, open_texts = settle(sums(open_cells, ["__cell"], _pieces(by_text, n_text), "__text"), lambda c, t: c * step + t * (step // n_text), cut=COPIES * largest) if open_cells else ([], [])
    base = base.withColumn("__text", _pieces(by_text, n_text))
    by_doc, n_docs = F.xxhash64("__key", F.lit(5)), asked(open_texts)
    ones, _ = settle(sums(open_texts, ["__cell", "__text"], _pieces(by_doc, n_docs), "__doc"), lambda c, t, d: c * step + d * (step // n_docs), cut=float("inf")) if open_texts else ([], [])
    base = base.withColumn("__doc", _pieces(by_doc, n_docs))
    placed = base
    for rows, names in ((whole, ["__cell"]), (texts, ["__cell", "__text"]), (ones, ["__cell", "__text", "__doc"])):
        if rows or names == ["__cell"]:
            known = spark.createDataFrame(rows, ", ".join(f"{c} int" for c in (*names, f"__s{len(names)}")))
            placed = placed.join(common.broadcast_if_small(known), names, "left")
    found = [f"__s{k}" for k in (1, 2, 3) if f"__s{k}" in placed.columns]
    placed = placed.withColumn("shard", F.coalesce(*found) if len(found) > 1 else F.col(found[0]))
    # slots: rows are numbered within (shard, cell, part of the cell), after all rows of earlier parts
    crowded = base.groupBy("__cell").agg(F.ceil(F.count("*") / NUMBERED).cast("int").alias("__parts")).where("__parts > 1")
    placed = placed.join(common.broadcast_if_small(common.cut(crowded)), "__cell", "left")
    placed = placed.withColumn("__part", F.pmod(F.xxhash64("__key", F.lit(9)), F.coalesce("__parts", F.lit(1))).cast("int"))
    counted = placed.groupBy("shard", "__cell", "__part").agg(F.count("*").alias("__rows"))
    before = W.partitionBy("shard").orderBy("__cell", "__part").rowsBetween(W.unboundedPreceding, -1)
    starts = common.cut(counted.withColumn("__start", F.coalesce(F.sum("__rows").over(before), F.lit(0))).drop("__rows"))
    ranked = placed.withColumn("__rank", F.row_number().over(W.partitionBy("shard", "__cell", "__part").orderBy("__place", "__key", "size")) - 1)
    own = {"doc_id", "size", "text_crc32", "shard", "slot"}
    kept = [F.col(f"__keep{i}").alias(f"kept_{c}" if c in own else c) for i, c in enumerate(keep)]
    return ranked.join(common.broadcast_if_small(starts), ["shard", "__cell", "__part"]).select("doc_id", *kept, "size", "text_crc32", "shard", (F.col("__start") + F.col("__rank")).cast("long").alias("slot"))
