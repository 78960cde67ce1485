"""Continuous ingestion: CSV feeds as a stream, merged into current rows by key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.casts import clean_value
from ..operators.typed import newest_rows
from ..sources.delimited import MISSING
from ..sources.layout import LINEAGE, SOURCES, Source
from ..sources.lineage import with_lineage

def stream_landed(spark: SparkSession, folder: str, source: Source,
                  files_per_batch: int | None = None) -> DataFrame:
    """Landed rows from CSV files as they appear in `folder`.

    A file whose header does not name the declared columns in their order fails
    the stream instead of putting values in wrong columns. The load time is the
    file's modification time, so replays give the same rows.
    """
    text = T.StructType([T.StructField(c, T.StringType()) for c in source.columns])
    reader = (spark.readStream.schema(text).option("header", True).option("quote", '"')
              .option("escape", '"').option("multiLine", source.multi_line)
              .option("enforceSchema", False))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = reader.csv(folder)
    values = [F.when(~F.col(c).isin(*MISSING), F.col(c)).alias(c) for c in source.columns]
    return with_lineage(rows.select(*values, F.col("_metadata.file_modification_time")
                                    .alias("_seen")), source, "_seen")


def append_batch(batch: DataFrame, batch_id: int, target: str, source: Source) -> None:
    """Add the newest row per key of one batch under `target`, as a folder of its own.

    A batch costs what it brings, whatever is there already. Repeating a batch
    after a failure replaces its folder.
    """
    (newest_rows(batch, source).withColumn("batch", F.lit(batch_id).cast("long"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch").parquet(target))


def start_upsert(spark: SparkSession, folder: str, target: str, checkpoint: str, table: str,
                 once: bool = False, files_per_batch: int | None = None):
    """Start the stream that keeps the rows of `table` up to date under `target`."""
    source = SOURCES[table]
    writer = (stream_landed(spark, folder, source, files_per_batch).writeStream
              .option("checkpointLocation", checkpoint)
              .foreachBatch(lambda batch, i: append_batch(batch, i, target, source)))
    return (writer.trigger(availableNow=True) if once else writer).start()


def _batches(spark: SparkSession, target: str, source: Source) -> DataFrame:
    schema = source.landed_schema().add("batch", T.LongType())
    return spark.read.schema(schema).parquet(target).drop("batch")


def current_rows(spark: SparkSession, target: str, table: str) -> DataFrame:
    """Cleaned rows of a merged table: the newest row per key over all batches.

    Late, repeated and replayed rows give the same result in any order.
    """
    source = SOURCES[table]
    newest = newest_rows(_batches(spark, target, source), source)
    return newest.select(*[clean_value(*f).alias(f[0]) for f in source.fields], *LINEAGE)


def compact(spark: SparkSession, target: str, compacted: str, table: str) -> None:
    """Write the newest row per key of `target` to the new folder `compacted`, as one batch.

    Run while the stream is stopped, then go on with `compacted` as its target.
    """
    source = SOURCES[table]
    append_batch(_batches(spark, target, source), -1, compacted, source)


def drop_repeats(stream: DataFrame, keys: list[str], late_by: str) -> DataFrame:
    """Drop rows of a stream whose key was seen within `late_by`, with bounded state."""
    timed = stream.withColumn("_event_time", F.col("_ingested_at").cast("timestamp"))
    return (timed.withWatermark("_event_time", late_by)
            .dropDuplicatesWithinWatermark(keys).drop("_event_time"))
