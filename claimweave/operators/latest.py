"""One row per key."""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, Window, functions as F

from ..session import shuffles_dropped
from .skew import BROADCAST_KEYS

HOT_ROWS = 10_000  # rows of one key from which on a limit is placed before the shuffle
ROWS_PER_SORT = 1_000_000  # rows that one task sorts after the shuffle
ROWS_PER_SPLIT = 100_000  # rows of a split from which on few splits are dealt to more tasks


def latest_per_key(df: DataFrame, keys: list, order: list) -> DataFrame:
    """Keep the first row of each key in `order`.

    Written as a rank filter so that Spark places a group limit before the
    shuffle: every map task sends at most one row per key, however hot the key.
    """
    slot = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_slot", F.row_number().over(slot)).filter("_slot = 1").drop("_slot")


def _sorted_after_shuffle(df: DataFrame, keys: list, order: list, rows: int) -> DataFrame:
    """`latest_per_key` for keys with few rows each: rows are sorted once, in bounded tasks.

    The group limit sorts whole input splits before the shuffle, which spills.
    """
    names = [f"_key{i}" for i in range(len(keys))]
    keyed = df.select("*", *[k.alias(n) for k, n in zip(keys, names)])
    parts = ceil(rows / ROWS_PER_SORT)
    if parts > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        keyed = keyed.repartition(parts, *names)
    # the first row of a key is the one without a row before it
    before = F.lag(F.lit(True)).over(Window.partitionBy(*names).orderBy(*order))
    return (keyed.withColumn("_before", before).filter("_before IS NULL")
            .drop("_before", *names))


def _dealt(df: DataFrame, keys: list, rows: int, splits: int) -> DataFrame:
    """`df` over all cores, if it lies in fewer splits with many rows each; no key repeats."""
    if splits < df.sparkSession.sparkContext.defaultParallelism and rows > splits * ROWS_PER_SPLIT:
        return df.repartition(*keys)
    return df


def newest_per_key(df: DataFrame, keys: list, order: list) -> DataFrame:
    """The rows of `latest_per_key`, of which only those with repeated keys are sorted.

    The rows of each key are counted first, by an 8-byte hash. Rows whose key is
    their own stay where they are; where many keys repeat, all rows are shuffled, and
    limited before that only if a key is hot. A hash collision only sends more
    rows through the exact comparison.
    """
    keys = [F.col(k) if isinstance(k, str) else k for k in keys]
    own = F.xxhash64(*keys)
    counts = df.select(own.alias("_h"), F.spark_partition_id().alias("_split")).groupBy("_h").agg(
        F.count("*").alias("_n"), F.max("_split").alias("_split"))
    repeats = F.col("_n") > 1
    with shuffles_dropped(df.sparkSession):
        rows, repeated, repeated_rows, hottest, last = counts.agg(
            F.sum("_n"), F.count_if(repeats), F.sum(F.when(repeats, F.col("_n"))), F.max("_n"),
            F.max("_split")).first()
    if not repeated:
        return _dealt(df, keys, rows or 0, (last or 0) + 1)

    def latest(some: DataFrame, most: int) -> DataFrame:
        if hottest > HOT_ROWS:
            return latest_per_key(some, keys, order)
        return _sorted_after_shuffle(some, keys, order, most)

    if repeated > BROADCAST_KEYS or repeated_rows * 10 > rows:
        return latest(df, rows)
    listed = F.broadcast(counts.filter(repeats).select("_h"))
    marked = df.withColumn("_h", own)
    alone = _dealt(marked.join(listed, "_h", "left_anti").drop("_h"), keys, rows, last + 1)
    return alone.unionByName(latest(marked.join(listed, "_h", "left_semi").drop("_h"),
                                    repeated_rows))
