"""Comparable snapshots: a hash tree over ranges of hashed keys whose depth follows the number of rows.

A row lies in the range named by the first hex digits of its key's md5. A range keeps its number of rows and the sums of six
28-bit pieces of its lines' sha256. Sums meet before the shuffle, so a range is never an array, however many rows one key has,
and ranges of a deep tree add up to those of a flatter one: snapshots of any two sizes compare. A node's digest is sha256 over
that (a leaf) or over its at most 16 children. Equal multisets of lines have equal trees; different ones differ but by
accident (the sums are no defence against lines made to collide).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..tables import written

#: Rows of a range, on average at most.
RANGE_ROWS = 4096
_PIECES = [f"s{i}" for i in range(6)]


def depth_for(rows: int, range_rows: int = RANGE_ROWS) -> int:
    """Hex digits that name a range of a table of so many rows, so that one holds at most `range_rows` on average."""
    return max(1, math.ceil(round(math.log(max(1, rows) / range_rows, 16), 9)))


def _key(key: Sequence[str]) -> Column:
    return F.md5(F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key]))


def _sums(line: Column) -> list[Column]:
    """The number of lines and the sums of the pieces of their hashes; a null line counts as the empty one."""
    digest = F.sha2(F.coalesce(line, F.lit("")), 256)
    pieces = [F.sum(F.conv(F.substring(digest, 1 + 7 * i, 7), 16, 10).cast("long")).alias(c) for i, c in enumerate(_PIECES)]
    return [F.count("*").alias("rows"), *pieces]


def ranges(df: DataFrame, key: Sequence[str], line: Column, range_rows: int = RANGE_ROWS, depth: int | None = None) -> DataFrame:
    """range, rows, s0 to s5 for each range that holds rows, written once. Null parts of a key count as empty; an empty table has no range."""
    if depth is None:
        depth = depth_for(df.count(), range_rows)
    return written(df.groupBy(F.substring(_key(key), 1, depth).alias("range")).agg(*_sums(line)))


def flatter(found: DataFrame, depth: int) -> DataFrame:
    """The ranges of a tree of a smaller depth, without reading the rows again."""
    return found.groupBy(F.substring("range", 1, depth).alias("range")).agg(*[F.sum(c).alias(c) for c in ("rows", *_PIECES)])


def digests(found: DataFrame) -> DataFrame:
    """range, rows, digest."""
    return found.select("range", "rows", F.sha2(F.concat_ws("|", "rows", *_PIECES), 256).alias("digest"))


def depth_of(found: DataFrame) -> int:
    """The depth that ranges were made with; 0 if there are none."""
    row = found.select(F.length("range").alias("n")).first()
    return row["n"] if row else 0


def tree(found: DataFrame) -> DataFrame:
    """level, range, rows, digest of all nodes; level 0 is the root. No ranges have no node.

    Each level above the leaves is one aggregate over a sixteenth of the nodes of the one below.
    """
    levels = [digests(found)]
    for n in range(depth_of(found) - 1, -1, -1):
        child = F.sort_array(F.collect_list(F.concat("range", F.lit(":"), "digest")))
        above = levels[-1].groupBy(F.substring("range", 1, n).alias("__up")).agg(F.sum("rows").alias("rows"), F.sha2(F.array_join(child, "\n"), 256).alias("digest"))
        levels.append(above.withColumnRenamed("__up", "range"))
    parts = [x.select(F.length("range").alias("level"), "range", "rows", "digest") for x in levels]
    return reduce(DataFrame.unionByName, parts)


def differing(left: DataFrame, right: DataFrame) -> DataFrame:
    """range, left_rows, right_rows of the ranges that differ, at the smaller depth of the two trees."""
    depths = [d for d in (depth_of(left), depth_of(right)) if d]
    if not depths:
        return left.select("range", F.col("rows").alias("left_rows"), F.col("rows").alias("right_rows"))
    a, b = (digests(x if depth_of(x) == min(depths) else flatter(x, min(depths))) for x in (left, right))
    both = a.select("range", F.col("rows").alias("left_rows"), F.col("digest").alias("__a")).join(b.select("range", F.col("rows").alias("right_rows"), F.col("digest").alias("__b")), "range", "full")
    return written(both.where(~F.col("__a").eqNullSafe(F.col("__b"))).select("range", F.coalesce("left_rows", F.lit(0)).alias("left_rows"), F.coalesce("right_rows", F.lit(0)).alias("right_rows")))


def changes(left: DataFrame, right: DataFrame, key: Sequence[str], line: Column, found: DataFrame) -> DataFrame:
    """`key`, change (added, removed, changed) of the keys whose lines differ; only rows of the ranges in `found` are compared.

    found: what `differing` returned for the two. A key's lines are a multiset, so repeated rows count. Keys are told apart
    as the ranges tell them: a null part is the empty text.
    """
    depth = depth_of(found)
    wanted = found.select("range")
    near = F.broadcast(wanted) if wanted.limit(250_001).count() <= 250_000 else wanted
    name = F.struct(*[F.coalesce(F.col(k).cast("string"), F.lit("")).alias(k) for k in key])

    def per_key(df: DataFrame, flag: str) -> DataFrame:
        rows = df.withColumn("range", F.substring(_key(key), 1, depth)).join(near, "range", "left_semi")
        sums = rows.groupBy(name.alias("__key")).agg(*_sums(line), *[F.first(k).alias(f"{flag}{i}") for i, k in enumerate(key)])
        return sums.select("__key", *[f"{flag}{i}" for i in range(len(key))], F.struct("rows", *_PIECES).alias(flag))

    both = per_key(left, "__a").join(per_key(right, "__b"), "__key", "full").where(~F.col("__a").eqNullSafe(F.col("__b")))
    change = F.when(F.col("__a").isNull(), "added").when(F.col("__b").isNull(), "removed").otherwise("changed")
    return both.select(*[F.coalesce(f"__a{i}", f"__b{i}").alias(k) for i, k in enumerate(key)], change.alias("change"))
