"""Structured Streaming views of ordered frames; `keyed` and `breaker` hold what keeps a table or a run's state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_hits(frames: DataFrame, clip: str, event_time: str, frame: str, hit: Column, delay: str = "10 minutes", window: str = "1 hour") -> DataFrame:
    """Per clip and window the first frame that qualifies; state goes with the watermark, late frames are dropped."""
    timed = frames.withColumn("__t", F.col(event_time).cast("timestamp")).withWatermark("__t", delay)
    return timed.groupBy(F.window("__t", window), clip).agg(F.min(F.when(hit, F.col(frame))).alias("first_frame"), F.count("*").alias("frames"))
