"""Members of dimensions by load day, kept as mergeable sketches.

A load's sketch is made once, from that load alone, and stored. Whether a load
brings unusually many new members follows from merged sketches, so history is
never read again. Theta sketches tell unions, differences and intersections; up
to 2 ** `log_entries` members they are exact, beyond that the relative error of
a union is about 2 / sqrt(2 ** log_entries) in 95 of 100 cases.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import stored

LOG_ENTRIES = 16


def load_sketches(members: DataFrame, log_entries: int = LOG_ENTRIES) -> DataFrame:
    """(dimension, load_day, sketch) from rows of (dimension, member, load_day).

    Aggregated before the shuffle, so a load costs a sketch a task, whatever its rows.
    """
    return (members.filter("member IS NOT NULL").groupBy("dimension", "load_day")
            .agg(F.theta_sketch_agg(F.col("member").cast("string"), log_entries).alias("sketch")))


def _count(sketch: Column) -> Column:
    return F.coalesce(F.theta_sketch_estimate(sketch), F.lit(0)).cast("long")


def growth_by_load(sketches: DataFrame, tolerance: float,
                   log_entries: int = LOG_ENTRIES) -> DataFrame:
    """Per dimension and load day: members in the load, new ones, those known before, those
    shared with the load before, growth and whether it is a spike.

    Reads one small row per dimension and load; several rows of one day are merged.
    """
    entries = F.lit(log_entries)
    daily = stored(sketches.groupBy("dimension", "load_day").agg(
        F.theta_union_agg("sketch", log_entries).alias("sketch")), "load-sketches")
    days = Window.partitionBy("dimension").orderBy("load_day")
    earlier = daily.select("dimension", F.col("load_day").alias("_day"),
                           F.col("sketch").alias("_sketch"))
    # each load with the union of those before: one row a load and earlier load, both few
    before = (daily.select("dimension", "load_day").join(earlier, "dimension")
              .filter("_day < load_day").groupBy("dimension", "load_day")
              .agg(F.theta_union_agg("_sketch", log_entries).alias("known")))
    told = (daily.withColumn("last", F.lag("sketch").over(days))
            .join(before, ["dimension", "load_day"], "left"))
    known = F.when(F.col("known").isNotNull(), _count(F.col("known")))
    both = F.theta_union("known", "sketch", entries)
    new = F.when(F.col("known").isNull(), _count(F.col("sketch"))).otherwise(
        _count(both) - _count(F.col("known")))
    growth = F.round(F.col("new_members").cast("double") / F.col("known_before"), 4)
    return (told.select(
        "dimension", "load_day", _count(F.col("sketch")).alias("load_members"),
        new.alias("new_members"), known.alias("known_before"),
        F.when(F.col("last").isNotNull(), _count(F.theta_intersection("sketch", "last")))
        .alias("shared_with_last"))
        .withColumn("growth", growth)
        .withColumn("spike", F.coalesce(F.col("growth") > tolerance, F.lit(False))))
