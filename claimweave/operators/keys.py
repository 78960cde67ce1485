"""Surrogate keys from sorted positions, without a one-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import stored
from .skew import attach

_LOCAL_BITS = 33  # monotonically_increasing_id keeps the row's place in its low 33 bits


def row_positions(df: DataFrame, order: list, column: str = "position") -> DataFrame:
    """Add the 1-based position of each row in the global order.

    Rows are range-partitioned and sorted within partitions; the stored result
    fixes the partition contents. Positions are the place within the partition
    plus the sizes of the partitions before it: one small row per partition.
    """
    placed = (df.repartitionByRange(*order).sortWithinPartitions(*order)
              .withColumn("_place", F.monotonically_increasing_id()))
    kept = stored(placed, "positions")
    part = F.shiftright("_place", _LOCAL_BITS)
    local = F.col("_place").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (kept.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
               .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before")))
    # one row per partition, so the broadcast is bounded by the partition count
    return (kept.withColumn("_part", part)
            .join(F.broadcast(offsets), "_part")
            .withColumn(column, local + F.col("_before") + 1)
            .drop("_part", "_place", "_before"))


def rank_within(df: DataFrame, group: str, order: list, column: str) -> DataFrame:
    """Add the 1-based rank of each row inside its group, however large the group.

    Ranks are differences of global positions, so a group may span partitions.
    Rows equal in `group` and `order` are interchangeable and spread by a tie.
    """
    tied = df.withColumn("_tie", F.monotonically_increasing_id())
    placed = row_positions(tied, [group, *order, "_tie"], "_at")
    starts = placed.groupBy(group).agg(F.min("_at").alias("_start"), F.count("*").alias("n"))
    ranked = attach(placed, starts, group, "_at", placed.count())
    return (ranked.withColumn(column, (F.col("_at") - F.col("_start") + 1).cast("int"))
            .drop("_tie", "_at", "_start", "n"))


def padded_key(prefix: str, number: Column, width: int) -> Column:
    """`prefix` and the zero-padded number; longer numbers are kept whole."""
    text = number.cast("string")
    return F.concat(F.lit(prefix),
                    F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0")))


def number_rows(df: DataFrame, order: list, key: str, prefix: str, width: int) -> DataFrame:
    """Add a surrogate key column `key` numbered in `order`, placed first."""
    columns = df.columns
    return (row_positions(df, order, "_number")
            .select(padded_key(prefix, F.col("_number"), width).alias(key), *columns))


def stable_key(prefix: str, *columns) -> Column:
    """Key that depends only on the row's own natural key, not on its position."""
    return F.concat(F.lit(prefix), F.md5(F.concat_ws("\x1f", *columns)))
