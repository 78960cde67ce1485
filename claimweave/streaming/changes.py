"""Change feeds: rows with an operation and a sequence number, merged into current rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

OPERATION, SEQUENCE = "_op", "_seq"
DELETE = "delete"


def newest_changes(changes: DataFrame, keys: list[str]) -> DataFrame:
    """The change with the highest sequence number of each key, deletions among them.

    Each task keeps one change a key before the shuffle, so a key that changes
    all the time costs no more than others. Of equal numbers a deletion counts,
    then the largest values. Changes without a number are older than all others.
    """
    rest = [c for c in changes.columns if c not in keys]
    order = F.struct(F.coalesce(F.col(SEQUENCE), F.lit(-(1 << 63))).alias("s"),
                     F.coalesce(F.col(OPERATION) == DELETE, F.lit(False)).alias("d"), *rest)
    return (changes.groupBy(*keys).agg(F.max(order).alias("_newest"))
            .select(*[F.col(c) if c in keys else F.col(f"_newest.{c}") for c in changes.columns]))


def append_changes(batch: DataFrame, batch_id: int, target: str, keys: list[str]) -> None:
    """Add one batch under `target`, as a folder of its own; a repeated batch replaces it."""
    (newest_changes(batch, keys).withColumn("batch", F.lit(batch_id).cast("long"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch").parquet(target))


def start_changes(spark: SparkSession, folder: str, schema: StructType, target: str,
                  checkpoint: str, keys: list[str], once: bool = False,
                  files_per_batch: int | None = None):
    """Start the stream that takes up the changes of the files in `folder`."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    writer = (reader.parquet(folder).writeStream.option("checkpointLocation", checkpoint)
              .foreachBatch(lambda batch, i: append_changes(batch, i, target, keys)))
    return (writer.trigger(availableNow=True) if once else writer).start()


def _batches(spark: SparkSession, target: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(target).drop("batch")


def current(spark: SparkSession, target: str, schema: StructType, keys: list[str]) -> DataFrame:
    """Rows as they are after all changes so far.

    Late and repeated changes give the same rows in any order: a key's deletion
    is kept, so an older change that comes after it brings nothing back.
    """
    return (newest_changes(_batches(spark, target, schema), keys).filter(F.coalesce(F.col(OPERATION) != DELETE, F.lit(True)))
            .drop(OPERATION, SEQUENCE))


def compact(spark: SparkSession, target: str, compacted: str, schema: StructType,
            keys: list[str]) -> None:
    """Write the newest change of each key to the new folder `compacted`, deletions too.

    Run while the stream is stopped, then go on with `compacted` as its target.
    """
    append_changes(_batches(spark, target, schema), -1, compacted, keys)
