"""Match keys of all records seen so far, kept in bucketed tables and probed by fresh records.

The tables lie in buckets of their key, so a join with fresh keys reads each
bucket where it is: only the fresh side is shuffled. A profile is named by the
digest of its traits and a record by its digest, so rows of changed and
withdrawn records need no deletion: what a probe finds is joined to the records
as they are, and stale rows fall away. `compact` drops them and merges the
files of many additions.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.agreement import Model
from ..session import checkpoint_dir, shuffles_dropped
from . import fuzzy
from .rules import rule_members

BUCKETS = 32
SHIFTED, PLAIN = 0, 1  # a profile's keys in its two parts in a join
PROFILE_COLUMNS = ("k", "part", "profile", "system")
RULE_COLUMNS = ("k", "source_system", "source_patient_key", "digest")


class MatchIndex:
    """Keys of profiles and of exact rules, in two tables of the session's catalog.

    `base` is the folder of their files and `name` the beginning of their names;
    `buckets` should be so many that a bucket fits a task. The model is fixed:
    its agreements are what the keys stand for.
    """

    def __init__(self, spark: SparkSession, name: str | None = None, base: str | None = None,
                 model: Model = Model(), buckets: int = BUCKETS):
        self.spark = spark
        self.name = name or f"match_index_{uuid.uuid4().hex}"
        self.base = base or f"{checkpoint_dir(spark)}/{self.name}"
        self.model = model
        self.buckets = buckets

    def _write(self, rows: DataFrame, table: str) -> None:
        name = f"{self.name}_{table}"
        # after `compact` the files lie elsewhere than at first
        path = (self.base_of(table) if self.spark.catalog.tableExists(name)
                else f"{self.base}/{table}")
        with shuffles_dropped(self.spark):
            (rows.write.format("parquet").bucketBy(self.buckets, "k").sortBy("k").mode("append")
             .option("path", path).saveAsTable(name))

    def _read(self, table: str) -> DataFrame:
        return self.spark.table(f"{self.name}_{table}")

    def _in_buckets(self, fresh: DataFrame) -> DataFrame:
        """Fresh keys dealt as the tables are; of two other dealings Spark may choose the finer
        one and shuffle the tables."""
        return fresh.repartition(self.buckets, "k")

    def _profile_keys(self, tagged: DataFrame) -> DataFrame:
        people = tagged.select("profile", "system", *fuzzy.TRAITS).dropDuplicates(["profile"])
        shifted, plain = fuzzy.match_keys(self.model)
        return people.select(shifted.alias("k"), F.lit(SHIFTED).alias("part"), "profile", "system"
                             ).unionByName(people.select(plain.alias("k"), F.lit(PLAIN)
                                                         .alias("part"), "profile", "system"))

    def _rule_keys(self, records: DataFrame) -> DataFrame:
        named = records.select("nid", "source_system", "source_patient_key", "digest")
        return (rule_members(records).select("nid", "grp").join(named, "nid")
                .select(F.xxhash64("grp").alias("k"), "source_system", "source_patient_key",
                        "digest"))

    def add(self, records: DataFrame) -> None:
        """Add the keys of spine records with their digests. Adding a record again is harmless."""
        self._write(self._profile_keys(fuzzy.with_profile(records)).select(*PROFILE_COLUMNS),
                    "profiles")
        self._write(self._rule_keys(records).select(*RULE_COLUMNS), "rules")

    def profile_pairs(self, tagged: DataFrame) -> DataFrame:
        """(profile_a, profile_b): pairs of systems in order that agree enough, one of them fresh.

        `tagged` holds the fresh records, which must have been added before.
        """
        told = self._read("profiles").select(
            "k", F.col("part").alias("other_part"), F.col("profile").alias("other"),
            F.col("system").alias("other_system"))
        met = (self._in_buckets(self._profile_keys(tagged)).join(told, "k")
               .filter((F.col("part") != F.col("other_part"))
                       & (F.col("system") != F.col("other_system"))))
        first = F.col("system") < F.col("other_system")
        # the keys of the smaller system are the shifted ones, as in the search without an index
        return (met.filter(first == (F.col("part") == SHIFTED))
                .select(F.when(first, F.col("profile")).otherwise(F.col("other")).alias("profile_a"),
                        F.when(first, F.col("other")).otherwise(F.col("profile"))
                        .alias("profile_b")).distinct())

    def rule_records(self, records: DataFrame) -> DataFrame:
        """Keys and digests of all records that share a rule's key with the given ones.

        Keys are compared by hash, so a few others may be among them.
        """
        touched = rule_members(records).select(F.xxhash64("grp").alias("k")).distinct()
        return (self._in_buckets(touched).join(self._read("rules"), "k")
                .select("source_system", "source_patient_key", "digest").distinct())

    def compact(self, records: DataFrame) -> None:
        """Rewrite the tables in one file a bucket, without rows of records that are no more."""
        now = records.select("source_system", "source_patient_key", "digest")
        alive = fuzzy.with_profile(records).select("profile").distinct()
        rules = (self._read("rules").join(now, now.columns, "left_semi")
                 .dropDuplicates(["k", *now.columns]).select(*RULE_COLUMNS))
        profiles = (self._read("profiles").join(alive, "profile", "left_semi")
                    .distinct().select(*PROFILE_COLUMNS))
        generation = f"-{uuid.uuid4().hex}"
        for table, rows in (("profiles", profiles), ("rules", rules)):
            kept = f"{self.base}/{table}{generation}"
            (rows.repartition(self.buckets, "k").write.format("parquet")
             .bucketBy(self.buckets, "k").sortBy("k").option("path", kept)
             .saveAsTable(f"{self.name}_{table}_new"))
            self.spark.sql(f"DROP TABLE {self.name}_{table}")
            self.spark.sql(f"ALTER TABLE {self.name}_{table}_new RENAME TO {self.name}_{table}")

    def base_of(self, table: str) -> str:
        """The folder that holds a table's files now."""
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name}_{table}")
        return rows.filter("col_name = 'Location'").first()["data_type"]

    def drop(self) -> None:
        """Forget the tables; their files lie in the shared folder and go with it."""
        for table in ("profiles", "rules"):
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name}_{table}")
