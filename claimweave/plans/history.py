"""Versions of the crosswalk over load days, and facts joined to the version of their day."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..session import stored
from .incremental import KEY, rematch
from .spine import numbered

DECISION = ("patient_id", "cluster_id", "match_confidence", "match_method")
BIN_DAYS = 30


def _same() -> Column:
    return reduce(Column.__and__, [F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}")) for c in DECISION])


def advance(history: DataFrame | None, walk: DataFrame, day) -> DataFrame:
    """History after the crosswalk `walk` of `day`: rows valid from a day to before another.

    An open version (`effective_to` NULL) whose decision has changed, or whose
    record is gone, ends on `day`; new and changed records open one. Closed
    versions are only carried along. A second run of the same day and crosswalk
    changes nothing.
    """
    now = walk.select(*KEY, *DECISION)
    since = F.lit(day).cast("date")
    if history is None:
        return now.withColumns({"effective_from": since, "effective_to": F.lit(None).cast("date")})
    columns = history.columns
    closed = history.filter("effective_to IS NOT NULL")
    opened = history.filter("effective_to IS NULL")
    joined = opened.alias("o").join(now.alias("n"), KEY, "full")
    was, is_ = F.col("o.effective_from").isNotNull(), F.col("n.patient_id").isNotNull()
    carried = F.struct(*[F.col(f"o.{c}").alias(c) for c in DECISION],
                       F.col("o.effective_from").alias("effective_from"),
                       F.when(~(is_ & _same()), since).alias("effective_to"))
    fresh = F.struct(*[F.col(f"n.{c}").alias(c) for c in DECISION], since.alias("effective_from"),
                     F.lit(None).cast("date").alias("effective_to"))
    versions = F.filter(F.array(F.when(was, carried),
                                F.when(is_ & ~F.coalesce(was & _same(), F.lit(False)), fresh)),
                        lambda v: v.isNotNull())
    moved = joined.select(*KEY, F.explode(versions).alias("v")).select(*KEY, "v.*")
    # a version that began on the day it ends was never valid
    return closed.unionByName(moved.filter(
        "effective_to IS NULL OR effective_from < effective_to")).select(*columns)


def over_days(spine: DataFrame, load_days: DataFrame) -> DataFrame:
    """History of all load days: each day's records are matched with those before.

    `load_days` has a `load_day` for each record's key. One pass a load, which
    is how loads arrive; only the days reach the driver.
    """
    dated = stored(spine.drop("nid", "node").join(load_days, KEY), "dated-spine")
    days = [r[0] for r in dated.select("load_day").distinct().orderBy("load_day").collect()]
    history = walk = None
    for day in days:
        known = numbered(dated.filter(F.col("load_day") <= F.lit(day)).drop("load_day"))
        walk = stored(rematch(known.select(spine.columns), walk), "crosswalk-of-day")
        history = stored(advance(history, walk, day), "crosswalk-history")
    return history


def as_of(rows: DataFrame, history: DataFrame, key: dict[str, Column], day: str,
          values: tuple[str, ...] = DECISION, bin_days: int = BIN_DAYS) -> DataFrame:
    """`rows` with the values of the version that was valid on their `day` (NULL if none).

    `key` gives the row's expression for each key column of the history. Versions
    are laid out over bins of days up to the last day asked for, so a row meets
    only the versions of its bin, however many its key has had.
    """
    def bin_of(x: Column) -> Column:
        return F.floor(F.datediff(x, F.lit("1970-01-01").cast("date")) / bin_days).cast("int")

    last = F.lit(rows.agg(F.max(day)).first()[0]).cast("date")
    names = [f"_k{i}" for i in range(len(key))]
    ends = F.least(last, F.date_sub("effective_to", 1))
    versions = (history.filter(F.col("effective_from") <= ends)
                .select(*[F.col(c).alias(n) for c, n in zip(key, names)], *values,
                        F.col("effective_from").alias("_from"), F.col("effective_to").alias("_to"),
                        F.explode(F.sequence(bin_of(F.col("effective_from")), bin_of(ends)))
                        .alias("_bin")))
    asked = rows.withColumns({n: e for n, e in zip(names, key.values())}).withColumn(
        "_bin", bin_of(F.col(day)))
    r, v = asked.alias("r"), versions.alias("v")
    on = [F.col(f"r.{n}") == F.col(f"v.{n}") for n in (*names, "_bin")]
    within = (F.col(f"r.{day}") >= F.col("v._from")) & (
        F.col("v._to").isNull() | (F.col(f"r.{day}") < F.col("v._to")))
    return r.join(v, reduce(Column.__and__, [*on, within]), "left").select(
        *[F.col(f"r.{c}") for c in rows.columns], *[F.col(f"v.{c}") for c in values])
