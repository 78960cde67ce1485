"""Rows per feed and hour of a stream, with bounded state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def hourly(rows: DataFrame, feed: str, at: str, late_by: str, window: str = "1 hour") -> DataFrame:
    """(feed, window_start, row_count, first_seen, last_seen) per feed and event-time window.

    In a stream a window is kept until the watermark, the newest time of the
    batches before less `late_by`, has passed its end; it is then emitted once
    and forgotten. Rows that come for a window that was let go before are dropped.
    Rows without a time are in no window.
    """
    timed = rows.filter(F.col(at).isNotNull())
    if timed.isStreaming:
        timed = timed.withWatermark(at, late_by)
    return (timed.groupBy(F.col(feed).alias("feed"), F.window(at, window).alias("w"))
            .agg(F.count("*").alias("row_count"), F.min(at).alias("first_seen"),
                 F.max(at).alias("last_seen"))
            .select("feed", F.col("w.start").alias("window_start"), "row_count", "first_seen",
                    "last_seen"))


def start_volumes(spark: SparkSession, folder: str, schema: StructType, target: str,
                  checkpoint: str, feed: str, at: str, late_by: str, once: bool = False,
                  files_per_batch: int | None = None):
    """Start the stream that appends finished windows of the files in `folder` to `target`."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    writer = (hourly(reader.parquet(folder), feed, at, late_by).writeStream.format("parquet")
              .outputMode("append").option("checkpointLocation", checkpoint)
              .option("path", target))
    return (writer.trigger(availableNow=True) if once else writer).start()
