"""Frames that are written once and read again, in the folder that driver and executors share."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a temporary folder only in local mode, where the session names none."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None) or sc._jsc.sc().getCheckpointDir().getOrElse(None)
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="larkspur-checkpoint-"))
        named = sc._jsc.sc().getCheckpointDir().get()
    return named


def written(df: DataFrame) -> DataFrame:
    """`df` as Parquet in the shared folder, read back: its lineage ends there, and a lost executor costs nothing."""
    path = f"{shared_folder(df.sparkSession)}/written-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(*frames: DataFrame) -> None:
    """Delete the folders of frames that `written` made, once nothing reads them any more."""
    for df in frames:
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if folder.rsplit("/", 1)[-1].startswith("written-"):
                path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def let_go(spark: SparkSession) -> None:
    """Ask both collectors to run, so that Spark deletes shuffle files of steps that nothing refers to any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
