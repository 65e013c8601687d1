"""Numbered manifests: small JSON files that come into being whole, by one rename, and name the folders of a table's state."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """(the file system of `path`, the class of its paths)."""
    to_path = spark._jvm.org.apache.hadoop.fs.Path
    return to_path(path).getFileSystem(spark._jsc.hadoopConfiguration()), to_path


def numbers(spark: SparkSession, path: str) -> list[int]:
    """The manifests there are, in order."""
    fs, to_path = file_system(spark, path)
    folder = to_path(f"{path}/manifests")
    names = [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []
    return sorted(int(n[:-5]) for n in names if n.endswith(".json"))


def load(spark: SparkSession, path: str, number: int) -> dict:
    fs, to_path = file_system(spark, path)
    stream = fs.open(to_path(f"{path}/manifests/{number}.json"))
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def commit(spark: SparkSession, path: str, number: int, manifest: dict) -> bool:
    """Put a manifest in place; False if that number is taken."""
    fs, to_path = file_system(spark, path)
    hidden, final = to_path(f"{path}/manifests/.{number}-{uuid.uuid4().hex}"), to_path(f"{path}/manifests/{number}.json")
    out = fs.create(hidden, True)
    out.write(bytearray(json.dumps(manifest, sort_keys=True).encode()))
    out.close()
    if fs.exists(final) or not fs.rename(hidden, final):
        fs.delete(hidden, False)
        return False
    return True


def delete(spark: SparkSession, path: str) -> None:
    fs, to_path = file_system(spark, path)
    fs.delete(to_path(path), True)
