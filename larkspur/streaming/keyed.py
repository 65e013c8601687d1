"""A keyed table that a stream keeps up to date, in hash buckets under a manifest.

Rows lie in buckets by the hash of their key, and a manifest names the folder of each bucket. A micro-batch reads and
rewrites the buckets of its keys alone; then its manifest appears under the batch's number, by one rename. Readers follow the
latest manifest, so they see a batch whole or not at all. A batch that comes again finds its manifest and changes nothing;
one that broke off leaves folders that no manifest names, and `vacuum` deletes them.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources import manifests

BUCKETS = 64


def upsert_batch(batch: DataFrame, batch_id: int, path: str, keys: Sequence[str], order: str, buckets: int = BUCKETS) -> list[int]:
    """Merge one batch into the table at `path` as number `batch_id`; the buckets that were rewritten.

    Of all rows with one key the last by `order` stays, whatever the batches they came in; of the same order one of the
    later batch, and within a batch one by a hash of the row. Batches have rising numbers; one that is there already is left as it is. `buckets` holds for a new table.
    """
    spark = batch.sparkSession
    done = manifests.numbers(spark, path)
    if batch_id in done:
        return []
    before = [b for b in done if b < batch_id]
    manifest = manifests.load(spark, path, before[-1]) if before else {"buckets": buckets, "folders": {}, "schema": batch.schema.jsonValue()}
    n = manifest["buckets"]
    own = lambda df, new: df.select(*batch.columns).withColumns({"__bucket": F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int"), "__new": F.lit(new)})
    new = own(batch, 1).persist()
    try:
        touched = sorted(r[0] for r in new.select("__bucket").distinct().collect())  # `buckets` at most
        folders = [manifest["folders"][str(b)] for b in touched if str(b) in manifest["folders"]]
        rows = new
        if folders:
            old = spark.read.schema(batch.schema).parquet(*[f"{path}/{f}" for f in folders])
            rows = own(old, 0).unionByName(new)
        others = [c for c in batch.columns if c not in (*keys, order)]
        best = rows.groupBy("__bucket", *keys).agg(F.max_by(F.struct(*batch.columns), F.struct(order, "__new", F.xxhash64(F.lit(0), *others))).alias("__row"))
        version = f"data/{batch_id}-{uuid.uuid4().hex[:12]}"
        best.select("__bucket", "__row.*").repartition(max(1, len(touched)), "__bucket").write.partitionBy("__bucket").parquet(f"{path}/{version}")
    finally:
        new.unpersist()
    named = manifest["folders"] | {str(b): f"{version}/__bucket={b}" for b in touched}
    return touched if manifests.commit(spark, path, batch_id, manifest | {"folders": named}) else []


def upsert_stream(stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], order: str, buckets: int = BUCKETS) -> StreamingQuery:
    """Merge every micro-batch of `stream`, until what is there now has been read."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        upsert_batch(batch, batch_id, path, keys, order, buckets)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_keyed(spark: SparkSession, path: str, batch: int | None = None) -> DataFrame:
    """The table after the last batch, or after `batch`."""
    from pyspark.sql.types import StructType

    done = [b for b in manifests.numbers(spark, path) if batch is None or b <= batch]
    if not done:
        raise FileNotFoundError(f"no batch of {path} is complete")
    manifest = manifests.load(spark, path, done[-1])
    schema = StructType.fromJson(manifest["schema"])
    folders = [f"{path}/{f}" for f in manifest["folders"].values()]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete all but the last `keep` manifests and what none of these names; not while a batch runs. The folders deleted."""
    fs, to_path = manifests.file_system(spark, path)
    done = manifests.numbers(spark, path)
    named = {f for b in done[-keep:] for f in manifests.load(spark, path, b)["folders"].values()}
    for b in done[:-keep]:
        fs.delete(to_path(f"{path}/manifests/{b}.json"), False)
    gone = []
    for version in fs.listStatus(to_path(f"{path}/data")) if fs.exists(to_path(f"{path}/data")) else []:
        parts = [f"data/{version.getPath().getName()}/{p.getPath().getName()}" for p in fs.listStatus(version.getPath()) if p.isDirectory()]
        for p in parts:
            if p not in named:
                fs.delete(to_path(f"{path}/{p}"), True)
                gone.append(p)
        if not any(p in named for p in parts):
            fs.delete(version.getPath(), True)
    return sorted(gone)
