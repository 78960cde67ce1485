"""Joins that stay balanced when one key holds a large share of the rows.

The work of a task is bounded by fixed settings, not by shares of the data:
`attach` gives a task at most a number of rows of one key, `meet` at most a
number of row pairs, or more where a key's rows would be copied too often for
it. Keys above that are spread over more tasks. The list of such keys holds
their 8-byte hashes and is broadcast only where its largest possible length is
small; otherwise Spark joins it like any other table.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, functions as F

from ..session import shuffles_dropped

ROW_LIMIT_SETTING = "spark.claimweave.rowsPerChunk"
PAIR_LIMIT_SETTING = "spark.claimweave.pairsPerCell"
ROWS_PER_CHUNK = 1_000_000
PAIRS_PER_CELL = 4_000_000
COPIES_PER_ROW = 32  # how often `meet` copies the rows of a key at most, on average
CELLS_PER_TASK = 64  # full cells that one task of a large join takes
MOST_TASKS = 20_000
BROADCAST_KEYS = 1_000_000  # of 12 bytes each


def _setting(df: DataFrame, name: str, default: int) -> int:
    return int(df.sparkSession.conf.get(name, str(default)))


def _listed(hot: DataFrame, most: int) -> DataFrame:
    """Broadcast where `most`, the largest possible number of rows, allows it."""
    return F.broadcast(hot) if most <= BROADCAST_KEYS else hot


def dealt(side: DataFrame) -> DataFrame:
    """`side` of a join that is to be shuffled: it grows with the input, so it may not pass
    through the driver, however small its stored files look."""
    return side.hint("merge")


def _parts(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(1))


def attach(many: DataFrame, one: DataFrame, key: str, spread: str, rows: int,
           count: str = "n", how: str = "inner") -> DataFrame:
    """Join `one` (one row per key, with the key's row count in `many`) to `many`.

    `rows` is an upper bound for the rows of `many`. Rows of a key above the
    limit are spread over chunks by a hash of `spread`; its single row in `one`
    is copied once per chunk. Up to as many rows in all there is nothing to spread.
    """
    limit = _setting(many, ROW_LIMIT_SETTING, ROWS_PER_CHUNK)
    if rows <= limit:
        return many.join(one, [key], how)
    hot = (one.filter(F.col(count) > limit)
           .groupBy(F.xxhash64(key).alias("_h"))
           .agg(F.max(F.ceil(F.col(count) / F.lit(limit))).cast("int").alias("_k")))
    hot = _listed(hot, rows // limit)

    def marked(side: DataFrame) -> DataFrame:
        return side.withColumn("_h", F.xxhash64(key)).join(hot, "_h", "left").drop("_h")

    left = marked(many).withColumn(
        "_salt", F.pmod(F.xxhash64(spread), _parts("_k")).cast("int")).drop("_k")
    right = marked(one).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), _parts("_k") - 1))).drop("_k")
    return left.join(right, [key, "_salt"], how).drop("_salt")


def pairs_per_cell(left: Column, right: Column, pairs: int) -> Column:
    """`pairs`, or more where cells of that size would copy a key's rows more than
    COPIES_PER_ROW times: what is written then grows with the rows, not with their square."""
    # cells of x by x rows have the rows of both sides copied 2 * left * right / x times in all
    side = 2 * left.cast("double") * right / ((left + right) * COPIES_PER_ROW)
    return F.greatest(F.lit(float(pairs)), side * side)


def cells(left: Column, right: Column, pairs: int | Column) -> tuple[Column, Column]:
    """Into how many parts to cut each side of a key, so that a cell has at most `pairs` pairs.

    A side that is short enough to stay whole is not cut.
    """
    side = F.floor(F.sqrt(pairs)) if isinstance(pairs, Column) else int(pairs ** 0.5)
    both = F.ceil(left.cast("double") * right / pairs)
    cut_left = F.when(right <= side, both).when(left <= side, 1).otherwise(F.ceil(left / side))
    cut_right = F.when(right <= side, 1).when(left <= side, both).otherwise(F.ceil(right / side))
    return cut_left.cast("int"), cut_right.cast("int")


def meet(left: DataFrame, right: DataFrame, key: str, left_spread: str, right_spread: str,
         rows: int) -> DataFrame:
    """Equi-join of two sides that may both have the same hot key.

    A key with more pairs than the limit is cut into a grid: each side is spread
    over its own parts and copied across the parts of the other side, so every
    cell is one task's work and each pair of rows meets exactly once. `rows`
    bounds the rows of either side. The pairs are counted first, from one row
    per key: rows say little about the work, so a large join is dealt to tasks
    by its pairs, and without a hot key nothing is cut.
    """
    pairs = _setting(left, PAIR_LIMIT_SETTING, PAIRS_PER_CELL)
    counts = (
        left.select(F.xxhash64(key).alias("_h"), F.lit(1).alias("_l"), F.lit(0).alias("_r"))
        .unionByName(right.select(F.xxhash64(key).alias("_h"), F.lit(0).alias("_l"),
                                  F.lit(1).alias("_r")))
        .groupBy("_h").agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r")))
    met = F.col("_l").cast("double") * F.col("_r")
    with shuffles_dropped(left.sparkSession):
        total, hottest = counts.agg(F.sum(met), F.max(met)).first()
    tasks = min(ceil((total or 0) / (pairs * CELLS_PER_TASK)), MOST_TASKS)

    def joined(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
        if tasks > 1:
            # neither joined in place by few tasks nor in partitions put together by their bytes
            parts = max(tasks, int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")))
            a, b = a.repartition(parts, *on).hint("merge"), b.repartition(parts, *on)
        return a.join(b, on)

    if (hottest or 0) <= pairs:
        return joined(left, right, [key])
    sizes = F.col("_l"), F.col("_r")
    row_parts, column_parts = cells(*sizes, pairs_per_cell(*sizes, pairs))
    hot = (counts.filter(met > pairs)
           .select("_h", row_parts.alias("_kl"), column_parts.alias("_kr")))
    # a key with more pairs than the limit has more rows than twice its root
    hot = _listed(hot, int(rows / pairs ** 0.5))

    def cut(side: DataFrame, spread: str, own: str, other: str, own_k: str,
            other_k: str) -> DataFrame:
        return (side.withColumn("_h", F.xxhash64(key)).join(hot, "_h", "left")
                .withColumn(own, F.pmod(F.xxhash64(spread), _parts(own_k)).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), _parts(other_k) - 1)))
                .drop("_h", "_kl", "_kr"))

    cut_left = cut(left, left_spread, "_row", "_col", "_kl", "_kr")
    cut_right = cut(right, right_spread, "_col", "_row", "_kr", "_kl")
    return joined(cut_left, cut_right, [key, "_row", "_col"]).drop("_row", "_col")
