"""Near-duplicate groups with DartMinHash signatures, banded joining and exact weighted Jaccard.

A text is the multiset of its word shingles; the weight of a shingle is how often it stands there. An element's weight is
cut into regions of 1, 1, 2, 4, 8, 16, 16, ... units. In each strip of ranks a region of an element is thrown a Poisson
number of darts by hash, each with a coordinate, a rank and a height; a dart hits the text if its height is below the
weight. A coordinate of the signature is the dart with the smallest rank that hit. Strips are visited by rising rank and
only until every coordinate of a text is hit, so a long text stops at the first narrow strips. Two texts agree in a
coordinate with the probability of their weighted Jaccard similarity.

Equal texts are one node from the start. Nodes that share a band are tried against the bucket's leader, another one in each
band, and against NEIGHBOURS texts before them in the bucket's order by another band. Links are counted exactly: first
those to one hub per node, then, for the pairs whose ends are still in different groups, all others. What leaders and
neighbours leave open is settled in the end: in a bucket that holds several groups, the texts outside of its largest group
are held against all texts of other groups. One minus the similarity is a metric, so two texts whose distances from the
leader differ by more than 1 - threshold are no link, and the join skips them by its key. So the groups are those of all
pairs that share a band. Sets travel as 32-bit names; a pair so near to the threshold that a collision could decide it is
counted again by 64-bit names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .components import connected_components

#: Bands of rows: the chance to miss a pair of similarity 0.8 is (1 - 0.8 ** 4) ** 18, under 1 in 10,000.
BANDS, ROWS = 18, 4
#: The first strip holds ranks below 2 ** -FIRST; each further one doubles the end.
FIRST = 10
_RANK_BITS = 40
#: Texts before it in a bucket's order that a text is held against.
NEIGHBOURS = 3
#: Texts of a bucket that one task holds against those outside of the bucket's largest group.
BLOCK = 2048
#: Weight that one region of an element covers, at most.
REGION = 16


def weighted_elements(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct shingles of each text, their rows and how often they stand there; sorted by row and shingle."""
    n = len(offsets) - 1
    words, rows = common.word_hashes(data, offsets)
    hashes, rows = common.shingle_hashes(words, rows, n, width)
    order = np.lexsort((hashes, rows))
    hashes, rows = hashes[order], rows[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
    at = np.flatnonzero(new)
    return hashes[at], rows[at], np.diff(np.append(at, len(hashes)))


def _turns(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... for each count, one after the other."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def units(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A name for each unit of weight: two multisets share as many names as the sum of the smaller weights."""
    turn, name = _turns(counts), np.repeat(hashes, counts)
    return np.where(turn == 0, name, common.mix(name + turn.astype(np.uint64)))


def regions(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of regions that each weight reaches into, and the ends of all regions that any does."""
    ends = [1, 2]
    while ends[-1] < REGION:
        ends.append(2 * ends[-1])
    most = int(counts.max(initial=1))
    ends += [*range(2 * REGION, most + REGION, REGION)]
    return np.searchsorted(ends, counts, "left") + 1, np.array(ends)


def _poisson(mean: float) -> np.ndarray:
    p, total, out, k = np.exp(-mean), 0.0, [], 0
    while total < 1 - 1e-15 and k < 20 + 4 * mean:
        total += p
        out.append(min(total, 1.0))
        k += 1
        p *= mean / k
    return np.array(out)


def dart_signatures(elements: np.ndarray, rows: np.ndarray, counts: np.ndarray, n_rows: int, size: int) -> np.ndarray:
    """(n_rows, size) signature values; 0 all over for a row without elements."""
    none = np.uint64((1 << 64) - 1)
    best = np.full(n_rows * size, none, np.uint64)
    open_rows = np.bincount(rows, minlength=n_rows) > 0
    number, ends = regions(counts)
    turn = _turns(number)
    region, rows, weight = np.repeat(elements, number), np.repeat(rows, number), np.repeat(counts, number)
    region = np.where(turn == 0, region, common.mix(region + turn.astype(np.uint64)))
    begin = np.where(turn == 0, 0, ends[turn - 1])
    height = ends[turn] - begin
    strip = 0
    while open_rows.any():
        width = 2.0**-FIRST if strip == 0 else 2.0 ** (strip - 1 - FIRST)
        if not open_rows.all():
            live = open_rows[rows]
            region, rows, weight, begin, height = region[live], rows[live], weight[live], begin[live], height[live]
        seed = common.mix(np.array([strip + 1000], np.uint64))[0]
        draw = common.mix(region ^ seed)
        u = (draw >> np.uint64(11)).astype(np.float64) * 2.0**-53
        thrown = np.zeros(len(region), np.int64)
        for tall in np.flatnonzero(np.bincount(height, minlength=1)):
            own = np.flatnonzero(height == tall) if height.max() > 1 else slice(None)
            thrown[own] = np.searchsorted(_poisson(size * width * tall), u[own], "right")
        hit = np.flatnonzero(thrown)
        at = np.repeat(hit, thrown[hit])
        if len(at):
            dart = common.mix(draw[at] + (_turns(thrown[hit]).astype(np.uint64) + np.uint64(1)) * np.uint64(0xD1342543DE82EF95))
            partly = begin[at] + height[at] > weight[at]
            if partly.any():
                high = (common.mix(dart) >> np.uint64(11)).astype(np.float64) * 2.0**-53
                below = ~partly | (begin[at] + high * height[at] < weight[at])
                at, dart = at[below], dart[below]
            spot = rows[at] * size + (((dart >> np.uint64(44)) * np.uint64(size)) >> np.uint64(20)).astype(np.int64)
            rank = (np.uint64(strip) << np.uint64(_RANK_BITS)) | (dart & np.uint64((1 << _RANK_BITS) - 1))
            np.minimum.at(best, spot, rank)
        open_rows &= (best.reshape(n_rows, size) == none).any(axis=1)
        strip += 1
    best[best == none] = 0
    return best.reshape(n_rows, size)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _sketch(width: int, bands: int, rows_per_band: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(batch.schema.get_field_index("__text"))
            for start, end, data, offsets in common.text_slices(text):
                elements, rows, counts = weighted_elements(data, offsets, width)
                n = end - start
                filled = np.bincount(rows, counts, n)
                sig = dart_signatures(elements, rows, counts, n, bands * rows_per_band).reshape(n, bands, rows_per_band)
                band = np.zeros((n, bands), np.uint64)
                with np.errstate(over="ignore"):
                    for k in range(rows_per_band):
                        band = common.mix(band * np.uint64(31) + sig[:, :, k])
                    band = common.mix(band + np.arange(bands, dtype=np.uint64) * np.uint64(0x5851F42D4C957F2D))
                lists = pa.ListArray.from_arrays(np.arange(0, n * bands + 1, bands, dtype=np.int32), _signed(band.reshape(-1)))
                cols = [batch.column(i).slice(start, n) for i, name in enumerate(batch.schema.names) if name != "__text"]
                names = [x for x in batch.schema.names if x != "__text"]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(filled.astype(np.int64)), lists], names=[*names, "__size", "__bands"])

    return run


def _shingle_sets(width: int, wide: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end, data, offsets in common.text_slices(batch.column(1)):
                elements, rows, counts = weighted_elements(data, offsets, width)
                bounds = np.concatenate([[0], np.cumsum(np.bincount(rows, counts, end - start))]).astype(np.int32)
                names = units(elements, counts)
                lists = pa.ListArray.from_arrays(bounds, _signed(names) if wide else (names >> np.uint64(32)).astype(np.uint32).view(np.int32))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, end - start), lists], names=["__tid", "__set"])

    return run


def _sets(base: DataFrame, ends: DataFrame, width: int, wide: bool) -> DataFrame:
    """__tid and __set, the names of all units of weight, of the texts in `ends`."""
    shown = base.select("__tid", "__text").join(common.broadcast_if_small(ends), "__tid", "left_semi")
    sets = common.batched(shown).mapInArrow(_shingle_sets(width, wide), f"__tid binary, __set array<{'long' if wide else 'int'}>")
    return common.table(sets.groupBy("__tid").agg(F.first("__set").alias("__set")))


def _neighbours(reach: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = None
        for pdf in frames:
            old = 0 if last is None else len(last)
            if last is not None:
                pdf = pd.concat([last, pdf], ignore_index=True)
            tid, bucket = pdf["tid"].values, pdf["bucket"].values
            for k in range(1, reach + 1):
                at = np.arange(max(k, old), len(pdf))
                at = at[bucket[at] == bucket[at - k]]
                yield pd.DataFrame({"a": tid[at - k], "b": tid[at]})
            last = pdf.iloc[-reach:]

    return run


def _similar(x: str, y: str, threshold: float, doubt: Column | float = 0.0) -> Column:
    """Whether two multisets have at least this weighted Jaccard similarity, if `doubt` units more were shared; their sizes are looked at first."""
    shared = F.size(F.array_intersect(x, y))
    able = F.least(F.size(x), F.size(y)) >= threshold * F.greatest(F.size(x), F.size(y)) - 1e-9
    return able & ((shared + doubt) * (1 + threshold) >= threshold * (F.size(x) + F.size(y)) - 1e-9)  # names `shared` once, so it is computed once


def _doubt(x: str, y: str) -> Column:
    """Units by which 32-bit names may miscount what two texts share: their collisions are a Poisson number of mean n * n / 2 ** 33."""
    both = (F.size(x) + F.size(y)).cast("double")
    return 2 + 8 * both * both / 2.0**33


def _settled(found: DataFrame, base: DataFrame, threshold: float, width: int, made: list[DataFrame]) -> DataFrame:
    """(a, b) of the pairs of `found` that are links: those that are `sure`, and of the others those that 64-bit names confirm. `made` gets the tables that it is read from."""
    found = common.table(found)
    made.append(found)
    unsure = found.where("not sure").select("a", "b")
    if unsure.isEmpty():
        return found.select("a", "b")
    ends = common.table(unsure.select(F.col("a").alias("__tid")).union(unsure.select("b")).distinct())
    sets = _sets(base, ends, width, wide=True)
    left, right = (sets.select(F.col("__tid").alias(n), F.col("__set").alias(f"set_{n}")) for n in ("a", "b"))
    exact = common.table(unsure.join(left, "a").join(right, "b").where(_similar("set_a", "set_b", threshold)).select("a", "b"))
    common.forget(sets, ends)
    made.append(exact)
    return found.where("sure").select("a", "b").union(exact)


def _verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """a, b and sure of the pairs whose multisets may have at least this weighted Jaccard similarity."""
    left = sets.select(F.col("__tid").alias("a"), F.col("__set").alias("x"))
    right = sets.select(F.col("__tid").alias("b"), F.col("__set").alias("y"))
    likely = pairs.join(left, "a").join(right, "b").where(_similar("x", "y", threshold, _doubt("x", "y")))
    return likely.select("a", "b", _similar("x", "y", threshold, -_doubt("x", "y")).alias("sure"))


def _links_across(members: DataFrame, nodes: DataFrame, grouped: DataFrame, sets: DataFrame, threshold: float) -> tuple[DataFrame, list[DataFrame]]:
    """a, b and sure of likely links, and the tables that they are read from, between texts that share a bucket but are in different groups; a pair is counted in its
    first bucket.

    Only buckets that hold several groups are looked at. Their texts outside of the largest group (the strangers, b) are
    held against all others (a) whose distance from the leader lies within reach; the test stands in the join, so pairs
    that are no links are never rows. A task holds about BLOCK texts of a bucket at a time against the strangers in reach.
    """
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    roots = nodes.select(F.col("__tid").alias("tid")).join(grouped.select(F.col("node").alias("tid"), "root"), "tid", "left").select("tid", F.coalesce("root", "tid").alias("root"))
    placed = common.table(members.select("bucket", "tid", "leader").join(roots, "tid"))
    groups = placed.groupBy("bucket", "root").agg(F.count("*").alias("n"))
    mixed = groups.groupBy("bucket").agg(F.max(F.struct("n", "root")).alias("most"), F.sum("n").alias("n"), F.count("*").alias("groups")).where("groups > 1")
    mixed = common.table(mixed.select("bucket", F.col("most.root").alias("main"), F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")))
    if mixed.isEmpty():
        return members.select(F.col("tid").alias("a"), F.col("tid").alias("b"), F.lit(True).alias("sure")).limit(0), [placed, mixed]
    several = placed.join(common.broadcast_if_small(mixed), "bucket")
    heads = several.select("bucket", F.col("leader").alias("__tid")).distinct().join(sets, "__tid").select("bucket", F.col("__set").alias("head"))
    before = F.slice("__bands", F.lit(1), F.array_position("__bands", F.col("bucket")).cast("int") - 1)
    several = several.join(nodes.select(F.col("__tid").alias("tid"), "__bands"), "tid").select("bucket", "tid", "root", "main", "blocks", before.alias("before"))
    full = several.join(sets.withColumnRenamed("__tid", "tid"), "tid").join(heads, "bucket")
    shared, x = F.size(F.array_intersect("__set", "head")), F.col("__set")
    # distances by 32-bit names are off by what they may miscount
    reach = 1 - threshold + 0.02
    full = full.select("bucket", "tid", "root", "main", "blocks", "before", x, (F.size(x) + F.size("head")).alias("both"), shared.alias("shared"))
    far = 1 - F.col("shared") / (F.col("both") - F.col("shared"))
    full = common.table(full.withColumn("far", far).withColumn("ring", F.floor(F.col("far") / reach).cast("int")).drop("both", "shared"))
    common.forget(placed)
    common.cleaned(full.sparkSession)
    names = ("tid", "root", "far", "before", "__set")
    strangers = full.where("root <> main")
    rings = common.table(strangers.select("bucket", F.explode(F.sequence(F.col("ring") - 1, F.col("ring") + 1)).alias("ring")).distinct())
    reached = full.join(common.broadcast_if_small(rings), ["bucket", "ring"], "left_semi")
    left = reached.select("bucket", "ring", F.pmod(F.xxhash64("tid"), "blocks").cast("int").alias("block"), "main", *[F.col(c).alias(f"{c}_a") for c in names]).repartition(parts, "bucket", "ring", "block")
    near = F.explode(F.sequence(F.col("ring") - 1, F.col("ring") + 1))
    right = strangers.select(F.col("bucket").alias("bucket_b"), near.alias("ring_b"), "blocks", *[F.col(c).alias(f"{c}_b") for c in names])
    right = right.withColumn("block_b", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks").repartition(parts, "bucket_b", "ring_b", "block_b")
    same = (F.col("bucket") == F.col("bucket_b")) & (F.col("ring") == F.col("ring_b")) & (F.col("block") == F.col("block_b"))
    once = (F.col("root_a") == F.col("main")) | (F.col("tid_a") < F.col("tid_b"))
    open_ = once & (F.col("root_a") != F.col("root_b")) & (F.abs(F.col("far_a") - F.col("far_b")) <= reach) & ~F.arrays_overlap("before_a", "before_b")
    doubt = _doubt("__set_a", "__set_b")
    likely = left.join(right, same & open_ & _similar("__set_a", "__set_b", threshold, doubt))
    return likely.select(F.least("tid_a", "tid_b").alias("a"), F.greatest("tid_a", "tid_b").alias("b"), _similar("__set_a", "__set_b", threshold, -doubt).alias("sure")), [full, mixed, rings]


def near_duplicate_classes(docs: DataFrame, threshold: float = 0.8, width: int = 5, bands: int = BANDS, rows: int = ROWS, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """A row for each row of `docs`: doc_id, __tid (names its text), class_id, class_key, keep.

    Classes are the connected groups of equal texts and of texts with similarity of `threshold` or more; class_id is the
    smallest doc_id in it, and class_key names the class even where all its doc_ids are null. keep: it is the class's
    first row by doc_id. Words are runs of ASCII letters, digits and bytes above 127, ASCII case folded; a text of 1 to
    width - 1 words has one shingle of them all; wordless texts equal only themselves, null counts as the empty text. Null
    doc_ids come after all others. Repeated rows are equal texts: of rows with the same doc_id and text all are marked
    alike, and deduplicate() leaves one of them. Shingles are compared by 64-bit hashes where 32 bits leave a pair in doubt.
    """
    base = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("__text"))
    base = base.select("doc_id", F.unhex(F.md5("__text")).alias("__tid"), "__text")
    kind = dict(base.dtypes)["doc_id"]
    signed = common.batched(base).mapInArrow(_sketch(width, bands, rows), f"doc_id {kind}, __tid binary, __size long, __bands array<long>")
    signed = common.table(signed)
    nodes = signed.groupBy("__tid").agg(F.min("doc_id").alias("first_id"), F.max("__size").alias("__size"), F.first("__bands").alias("__bands"))
    nodes = common.table(nodes)
    common.cleaned(docs.sparkSession)

    marked = nodes.where("__size > 0").select(F.col("__tid").alias("tid"), F.posexplode("__bands").alias("pos", "bucket"), "__bands").select("tid", "bucket", F.element_at("__bands", F.pmod(F.col("pos") + 1, F.lit(bands)) + 1).alias("near"))
    # another leader in each band, so that a text is held against many of its group
    lead = F.min(F.struct(F.xxhash64("bucket", "tid").alias("h"), "tid"))["tid"]
    buckets = marked.groupBy("bucket").agg(F.count("*").alias("n"), lead.alias("leader")).where("n > 1").drop("n")
    members = common.table(marked.join(buckets, "bucket"))
    common.cleaned(docs.sparkSession)
    beside = members.select("bucket", "near", "tid").repartitionByRange("bucket", "near", "tid").sortWithinPartitions("bucket", "near", "tid")
    beside = beside.select("bucket", "tid").mapInPandas(_neighbours(NEIGHBOURS), "a binary, b binary")
    pairs = members.where("tid <> leader").select(F.col("leader").alias("a"), F.col("tid").alias("b")).union(beside)
    pairs = common.table(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct())

    ends = common.table(pairs.select(F.col("a").alias("__tid")).union(pairs.select("b")).distinct())
    made = [pairs, ends]
    sets = _sets(base, ends, width, wide=False)
    common.cleaned(docs.sparkSession)

    hubs = pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    grouped = connected_components(_settled(_verified(hubs, sets, threshold), base, threshold, width, made))
    rest = pairs.join(hubs, ["a", "b"], "left_anti")
    for end in ("a", "b"):
        rest = rest.join(grouped.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}")), end, "left")
    rest = rest.where("not (coalesce(root_a, a) <=> coalesce(root_b, b))").select("a", "b")
    common.cleaned(docs.sparkSession)
    made.append(grouped)
    known = grouped.select(F.col("node").alias("a"), F.col("root").alias("b"))
    grouped = connected_components(known.union(_settled(_verified(rest, sets, threshold), base, threshold, width, made)))
    made.append(grouped)
    common.cleaned(docs.sparkSession)
    across, read = _links_across(members, nodes, grouped, sets, threshold)
    last = _settled(across, base, threshold, width, made)
    common.forget(*read)
    common.cleaned(docs.sparkSession)
    if not last.isEmpty():
        grouped = connected_components(grouped.select(F.col("node").alias("a"), F.col("root").alias("b")).union(last))
        made.append(grouped)

    roots = nodes.select("__tid", "first_id").join(grouped.select(F.col("node").alias("__tid"), "root"), "__tid", "left")
    roots = common.cut(roots.select("__tid", "first_id", F.coalesce("root", "__tid").alias("root")))
    common.forget(members, sets, nodes, *made)
    heads = roots.groupBy("root").agg(F.min(F.struct(F.col("first_id").isNull(), "first_id", "__tid")).alias("__head")).select("root", F.col("__head.first_id").alias("class_id"), F.col("__head.__tid").alias("__head"))
    classes = roots.join(heads, "root").select("__tid", "class_id", F.lower(F.hex("__head")).alias("class_key"), "first_id", (F.col("__head") == F.col("__tid")).alias("__heads"))
    out = signed.select("doc_id", "__tid").join(classes, "__tid")
    return out.select("doc_id", "__tid", "class_id", "class_key", (F.col("__heads") & F.col("doc_id").eqNullSafe(F.col("first_id"))).alias("keep"))


def deduplicate(docs: DataFrame, **options: object) -> DataFrame:
    """One document of each class, with all columns as they were, whatever their names; rows that repeat a kept doc_id and
    text are dropped too."""
    inner, at = common.numbered(docs)
    text, doc_id = at[str(options.pop("text", "text"))], at[str(options.pop("doc_id", "doc_id"))]
    marks = near_duplicate_classes(inner, text=text, doc_id=doc_id, **options).where("keep")
    kept = common.cut(marks.groupBy(F.col("doc_id").alias("__doc"), F.col("__tid").alias("__kept")).agg(F.count("*").alias("__n")))
    several = kept.where("__n > 1").select("__doc", "__kept")
    keyed = inner.withColumn("__t", F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")))))
    same = (F.col("__t") == F.col("__kept")) & F.col(doc_id).eqNullSafe(F.col("__doc"))
    plain = keyed.join(common.broadcast_if_small(kept.where("__n = 1").select("__doc", "__kept")), same, "left_semi")
    if not several.isEmpty():
        plain = plain.unionByName(keyed.join(several, same, "left_semi").dropDuplicates([doc_id, "__t"]))
    return plain.drop("__t").toDF(*docs.columns)
