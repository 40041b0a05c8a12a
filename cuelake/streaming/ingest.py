"""Structured Streaming: an extension of this library.

The same plans run over a stream: sessions close when a user is silent for a while,
and late rows are dropped by the watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENTS = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"


def read(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """(user_id, start, end, n): runs of events with less than `gap` between them. Works on a table and on a stream."""
    timed = events.withWatermark("ts", late) if events.isStreaming else events
    return timed.groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n")).select("user_id", "w.start", "w.end", "n")
