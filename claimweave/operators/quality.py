"""Data-quality checks as aggregations.

Row checks of a table share one scan; uniqueness and references each add one
shuffle. NULL passes every check but `not_null`, and a combination of columns
may repeat NULLs no more than values.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F


@dataclass(frozen=True)
class Check:
    table: str
    kind: str
    columns: tuple[str, ...]
    args: tuple = ()
    severity: str = "error"

    @property
    def label(self) -> str:
        return f"{self.table}.{self.kind}({', '.join(self.columns)})"


def _fails(check: Check) -> Column | None:
    """Row condition that fails the check, or None if it is no row check."""
    c = F.col(check.columns[0])
    if check.kind == "not_null":
        return c.isNull()
    if check.kind == "accepted_values":
        return ~c.isin(*check.args)
    if check.kind == "matches":
        return ~c.rlike(check.args[0])
    if check.kind == "length":
        return F.length(c) != check.args[0]
    if check.kind == "between":
        return ~c.between(*check.args)
    return None


def _row(check: Check, failures: Column):
    return F.struct(F.lit(check.table).alias("table_name"), F.lit(check.kind).alias("check_kind"),
                    F.lit(", ".join(check.columns)).alias("column_names"),
                    F.lit(check.severity).alias("severity"),
                    failures.cast("long").alias("failures"))


def _row_checks(df: DataFrame, checks: list[Check]) -> DataFrame:
    counts = [F.count_if(_fails(c)).alias(f"c{i}") for i, c in enumerate(checks)]
    rows = F.array(*[_row(c, F.col(f"c{i}")) for i, c in enumerate(checks)])
    return df.agg(*counts).select(F.explode(rows).alias("r")).select("r.*")


def _unique(df: DataFrame, check: Check) -> DataFrame:
    rows = df.filter(F.col(check.columns[0]).isNotNull()) if check.kind == "unique" else df
    return (rows.groupBy(*check.columns).count().filter("count > 1")
            .agg(_row(check, F.count("*")).alias("r")).select("r.*"))


def _reference(df: DataFrame, parent: DataFrame, check: Check) -> DataFrame:
    key = check.columns[0]
    known = parent.select(F.col(check.args[1]).alias(key)).distinct()
    lost = (df.groupBy(key).agg(F.count("*").alias("n")).filter(F.col(key).isNotNull())
            .join(known, key, "left_anti"))
    return lost.agg(_row(check, F.coalesce(F.sum("n"), F.lit(0))).alias("r")).select("r.*")


def run_checks(tables: dict[str, DataFrame], checks: list[Check]) -> DataFrame:
    """(table_name, check_kind, column_names, severity, failures), one row per check.

    `tables` maps names to DataFrames; only the tables the checks name are read.
    """
    parts = []
    for table in dict.fromkeys(c.table for c in checks):
        mine = [c for c in checks if c.table == table]
        simple = [c for c in mine if _fails(c) is not None]
        if simple:
            parts.append(_row_checks(tables[table], simple))
        for c in mine:
            if c.kind in ("unique", "unique_combination"):
                parts.append(_unique(tables[table], c))
            elif c.kind == "relationship":
                parts.append(_reference(tables[table], tables[c.args[0]], c))
    return reduce(DataFrame.unionByName, parts)


def load_quality(landed: DataFrame, columns: list[str]) -> DataFrame:
    """Per feed and column: rows, repeated hashes, newest load time, filled share of the column.

    Repeats are counted from one row per hash, so a hot hash is added up before the shuffle.
    """
    feed = ["_source_system", "_source_file"]
    per_hash = landed.groupBy(*feed, "_row_hash").agg(
        F.count("*").alias("_n"), F.max("_ingested_at").alias("_at"),
        *[F.count(c).alias(c) for c in columns])
    counted = per_hash.groupBy(*feed).agg(
        F.sum("_n").alias("landed_rows"), (F.sum("_n") - F.count("*")).alias("repeated_rows"),
        F.max("_at").alias("newest_load"), *[F.sum(c).alias(c) for c in columns])
    listed = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"),
                 F.round(F.col(c).cast("double") / F.col("landed_rows"), 4).alias("filled_share"))
        for c in columns]))
    return counted.select(*feed, "landed_rows", "repeated_rows", "newest_load",
                          listed.alias("c")).select(
        *feed, "landed_rows", "repeated_rows", "newest_load", "c.*")


def _by_load(landed: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        df.groupBy("_source_file", F.col("_ingested_at").cast("date").alias("load_day"))
        .agg(F.count("*").alias("row_count")) for df in landed])


def load_volumes(landed: list[DataFrame], tolerance: float) -> DataFrame:
    """Rows per feed and load day, the change from the load before, and whether it is unusual."""
    # one row per feed and load after the aggregation
    before = F.lag("row_count").over(Window.partitionBy("_source_file").orderBy("load_day"))
    change = F.round((F.col("row_count") - F.col("previous_count")).cast("double")
                     / F.col("previous_count"), 4)
    return (_by_load(landed).withColumn("previous_count", before)
            .withColumn("change", change)
            .withColumn("unusual", F.coalesce(F.abs("change") > tolerance, F.lit(False))))


def cardinality(members: DataFrame, tolerance: float) -> DataFrame:
    """Members of each dimension by the load day they are first seen on, and unusual growth.

    `members` has (dimension, member, load_day). Growth is the number of new
    members over that of all known before; above `tolerance` it is a spike.
    """
    first = (members.filter("member IS NOT NULL").groupBy("dimension", "member")
             .agg(F.min("load_day").alias("load_day")))
    # one row per dimension and load day after the aggregation
    before = Window.partitionBy("dimension").orderBy("load_day").rowsBetween(
        Window.unboundedPreceding, -1)
    growth = F.round(F.col("new_members").cast("double") / F.col("known_before"), 4)
    return (first.groupBy("dimension", "load_day").agg(F.count("*").alias("new_members"))
            .withColumn("known_before", F.sum("new_members").over(before))
            .withColumn("growth", growth)
            .withColumn("spike", F.coalesce(F.col("growth") > tolerance, F.lit(False))))


def fact_volumes(facts: dict[str, tuple[DataFrame, str]], tolerance: float) -> DataFrame:
    """Rows of each fact by month of its date, the change from the month before, and whether
    that is unusual. Rows without a date are a month of their own, without a change."""
    months = reduce(DataFrame.unionByName, [
        df.groupBy(F.date_format(day, "yyyy-MM").alias("month"))
        .agg(F.count("*").alias("row_count"))
        .select(F.lit(name).alias("fact"), "month", "row_count")
        for name, (df, day) in facts.items()])
    # one row per fact and month
    lag = F.lag("row_count").over(
        Window.partitionBy("fact", F.col("month").isNull()).orderBy("month"))
    change = F.round((F.col("row_count") - F.col("previous_count")).cast("double")
                     / F.col("previous_count"), 4)
    return (months.withColumn("previous_count", lag).withColumn("change", change)
            .withColumn("unusual", F.coalesce(F.abs("change") > tolerance, F.lit(False))))


def freshness(landed: list[DataFrame], as_of: str, max_days: int) -> DataFrame:
    """Newest load per feed, its age in days, and whether that is too old."""
    age = F.datediff(F.lit(as_of).cast("date"), "newest_load")
    return (_by_load(landed).groupBy("_source_file").agg(F.max("load_day").alias("newest_load"))
            .withColumn("age_days", age).withColumn("stale", F.col("age_days") > max_days))


def reconcile(fact: DataFrame, source: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """Sum of each measure in the fact and in its source, and the difference."""
    empty = F.lit(None).cast("decimal(38,2)")

    def sums(df, side, columns):
        totals = df.agg(*[F.sum(c).cast("decimal(38,2)").alias(m) for m, c in columns.items()])
        rows = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias("total"))
                         for m in columns])
        value = F.col("r.total")
        return totals.select(F.explode(rows).alias("r")).select(
            "r.measure", (value if side == "fact" else empty).alias("fact_sum"),
            (value if side == "source" else empty).alias("source_sum"))

    both = (sums(fact, "fact", {m: a for m, (a, _) in pairs.items()})
            .unionByName(sums(source, "source", {m: b for m, (_, b) in pairs.items()}))
            .groupBy("measure").agg(F.max("fact_sum").alias("fact_sum"),
                                    F.max("source_sum").alias("source_sum")))
    return both.withColumn("difference",
                           (F.col("fact_sum") - F.col("source_sum")).cast("decimal(38,2)"))


MASKING_KEY_SETTING = "spark.claimweave.maskingKey"
TEST_KEY = "key for tests, set your own"


def keyed_digest(value: Column, key: str) -> Column:
    """Digest that cannot be found by trying all values without the key."""
    inner = F.sha2(F.concat(F.lit(key + "|inner|"), value.cast("string")), 256)
    return F.sha2(F.concat(F.lit(key + "|outer|"), inner), 256)


def masked(df: DataFrame, hashed: list[str], shortened: list[str], key: str) -> DataFrame:
    """Hide personal values: keyed digest of `hashed`, only the last two digits of `shortened`."""
    changes = {c: keyed_digest(F.col(c), key) for c in hashed}
    changes |= {c: F.when(F.col(c) != "", F.concat(F.lit("***"), F.right(F.col(c), F.lit(2))))
                for c in shortened}
    return df.withColumns(changes)
