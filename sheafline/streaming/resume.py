"""Resumable file streams: each file is taken once, whatever run it arrives in.

The archive's tools resume batches from done lists; here a file source with a checkpoint does the
same. A run takes what is there (``availableNow``) and ends; a run after a failure goes on where
the last one ended, because writes are committed per batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def run_available(spark: SparkSession, schema: T.StructType, source: str, target: str, checkpoint: str, step: Callable[[DataFrame], DataFrame] = lambda df: df, files_per_batch: int = 64) -> int:
    """Take the files of ``source`` not taken before through ``step`` into ``target``; the number of batches."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    query = step(stream).writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return sum(1 for p in query.recentProgress if p["numInputRows"])


def windowed_counts(stream: DataFrame, time: str, key: str, width: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """(window, key, n) of a stream of events, with rows later than ``late`` left out. An extra: the archive has no streams."""
    at = F.col(time).cast("timestamp")
    return stream.withColumn("_t", at).withWatermark("_t", late).groupBy(F.window("_t", width), key).agg(F.count(F.lit(1)).alias("n"))


def retry(step: Callable[[], object], times: int = 2) -> object:
    """The result of a step, tried again after a failure."""
    for left in range(times, 0, -1):
        try:
            return step()
        except Exception:
            if left == 1:
                raise
    raise ValueError("times must be at least 1")
