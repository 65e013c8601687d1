"""Sinks: tables that are published by a manifest only after their checks passed, files with a fixed layout, caches, retention."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.checks import enforce
from . import manifests


class Conflict(RuntimeError):
    """Another writer published first, or rows are there already."""


def _write(df: DataFrame, folder: str, version: int, partition_by: Sequence[str]) -> None:
    writer = df.write
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{folder}/data")
    df.sparkSession.createDataFrame([(version,)], "schema_version int").coalesce(1).write.parquet(f"{folder}/metadata")


def _put(spark: SparkSession, path: str, number: int, folder: str, data: list[str], keep: int) -> None:
    if not manifests.commit(spark, path, number, {"metadata": f"{folder}/metadata", "data": data}):
        raise Conflict(f"version {number} of {path} is another writer's")
    known = manifests.numbers(spark, path)
    kept = [manifests.load(spark, path, n) for n in known[-keep:]]
    named = {x.split("/")[1] for m in kept for x in (*m["data"], m["metadata"])}
    for n in known[:-keep]:
        for x in manifests.load(spark, path, n)["data"]:
            if x.split("/")[1] not in named:
                manifests.delete(spark, f"{path}/{x.rsplit('/', 1)[0]}")
        manifests.delete(spark, f"{path}/manifests/{n}.json")


def publish(df: DataFrame, path: str, version: int, checks: Callable[[DataFrame, DataFrame], DataFrame] | None = None, partition_by: Sequence[str] = (), keep: int = 2) -> None:
    """Write `df` and its one-row metadata to a folder of their own, run `checks(table, metadata)` on what was written, and
    only then let a new manifest point there. On failure the folder goes and readers see what they saw before.

    There is no moment without a table: the manifest comes into being by one rename. Of two writers that began with the same
    version one gets Conflict. The last `keep` versions stay, for readers that have begun.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    number = max(manifests.numbers(spark, path), default=-1) + 1
    folder = f"versions/{number}-{uuid.uuid4().hex[:12]}"
    try:
        _write(df, f"{path}/{folder}", version, partition_by)
        if checks:
            enforce(checks(spark.read.parquet(f"{path}/{folder}/data"), spark.read.parquet(f"{path}/{folder}/metadata")))
        _put(spark, path, number, folder, [f"{folder}/data"], keep)
    except BaseException:
        manifests.delete(spark, f"{path}/{folder}")
        raise


def insert(df: DataFrame, path: str, keys: Sequence[str], version: int, attempts: int = 3, keep: int = 2) -> None:
    """Add rows to a published table; Conflict if a key stands twice among them or is there already.

    Only the new rows are written, once. Where another writer publishes meanwhile, the keys are held against its version and
    the commit is tried again.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    folder = f"versions/i-{uuid.uuid4().hex[:12]}"
    try:
        _write(df, f"{path}/{folder}", version, ())
        new = spark.read.parquet(f"{path}/{folder}/data").select(*keys)
        if twice := new.groupBy(*keys).count().where("count > 1").limit(1).collect():
            raise Conflict(f"{path}: {twice[0].asDict()} stands twice among the new rows")
        for left in range(attempts - 1, -1, -1):
            known = manifests.numbers(spark, path)
            data = manifests.load(spark, path, known[-1])["data"] if known else []
            if data and (there := new.join(_rows(spark, path, data).select(*keys), [*keys], "left_semi").limit(1).collect()):
                raise Conflict(f"{path}: {there[0].asDict()} is there already")
            try:
                return _put(spark, path, (known[-1] if known else -1) + 1, folder, [*data, f"{folder}/data"], keep)
            except Conflict:
                if not left:
                    raise
    except BaseException:
        manifests.delete(spark, f"{path}/{folder}")
        raise


def read_published(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(table, metadata) of the latest version."""
    path = path.rstrip("/")
    latest = manifests.load(spark, path, manifests.numbers(spark, path)[-1])
    return _rows(spark, path, latest["data"]), spark.read.parquet(f"{path}/{latest['metadata']}")


def _rows(spark: SparkSession, path: str, data: Sequence[str]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), [spark.read.parquet(f"{path}/{x}") for x in data])


def publish_if_changed(new_hash: str, old_hash: str | None, act: Callable[[], None]) -> bool:
    """Run `act` only where the content hash differs from the published one."""
    if new_hash == old_hash:
        return False
    act()
    return True


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("error").option("ignoreNullFields", False).json(path)


def write_csv(df: DataFrame, path: str, columns: Sequence[str], order: Sequence[str]) -> None:
    """One CSV with a header, fixed columns and order; for reports of bounded size. Arrays are joined by commas."""
    cols = [F.array_join(c, ",").alias(c) if t.startswith("array") else F.col(c) for c, t in df.select(*columns).dtypes]
    df.orderBy(*order).select(*cols).coalesce(1).write.mode("error").option("header", True).option("emptyValue", "").csv(path)


def write_summary(summary: dict, path: str) -> None:
    """A summary as JSON with sorted keys."""
    with open(path, "w", encoding="utf-8") as f:
        json.dump(summary, f, indent=2, sort_keys=True, ensure_ascii=False)
        f.write("\n")


def append_cache(cache: DataFrame | None, new: DataFrame, keys: Sequence[str], path: str) -> None:
    """Append only rows whose key the cache lacks."""
    fresh = new.dropDuplicates([*keys])
    if cache is not None:
        fresh = fresh.join(cache.select(*keys), [*keys], "left_anti")
    fresh.write.mode("append").json(path)


def download(df: DataFrame, key: str, url: str, fetch: Callable[[str], bytes | None], partitions: int = 16) -> DataFrame:
    """key, content, error: each URL fetched once in a task; write it as a binary column or hand it to prepare()."""
    import pandas as pd

    def run(frames):
        for pdf in frames:
            rows = []
            for k, u in zip(pdf[key], pdf[url], strict=True):
                try:
                    rows.append((k, fetch(u), None))
                except Exception as e:  # noqa: BLE001  the failure is the row's result
                    rows.append((k, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=[key, "content", "error"])

    return df.select(key, url).repartition(partitions, key).mapInPandas(run, f"{key} string, content binary, error string")


def archive(folder: str, target: str) -> str:
    """A zip of a finished folder, on the driver."""
    import shutil

    return shutil.make_archive(target.removesuffix(".zip"), "zip", folder)


def prune(stale: DataFrame, delete: Callable[[str], None], key: str = "tag_name", dry_run: bool = True) -> list[str]:
    """Names of what is (or in a dry run would be) deleted, in order; the list is as short as a release page."""
    names = [r[0] for r in stale.where("stale").select(key).orderBy(key).collect()]
    if not dry_run:
        for name in names:
            delete(name)
    return names
