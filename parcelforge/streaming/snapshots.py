"""An extension: keep a snapshot up to date from a stream of files, and count events by event-time windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.incremental import upsert
from ..sources.files import exists
from ..sources.sinks import write_parquet


def keep_snapshot(spark: SparkSession, source: str, schema: str, target: str, key: list[str], checkpoint: str):
    """A query that upserts every micro-batch of JSON-line files into a Parquet snapshot. It ends when all files that
    are there have been read. A batch that is run again after a failure gives the same snapshot."""

    def apply(batch: DataFrame, number: int) -> None:
        old = spark.read.parquet(target) if exists(spark, target) else batch.limit(0)
        write_parquet(upsert(old, batch, key), target)

    stream = spark.readStream.schema(schema).json(source)
    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, time: str = "ts", key: str = "event_type", width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events of each key in tumbling windows; on a stream, those later than ``late`` are left out."""
    marked = events.withWatermark(time, late) if events.isStreaming else events
    return marked.groupBy(F.window(time, width).alias("w"), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("window_start"), key, "n")
