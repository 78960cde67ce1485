"""Session settings and lineage cutting."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app: str = "claimweave", **extra) -> SparkSession:
    """Session with the settings the jobs expect; `extra` keys use `__` for `.`."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints; only local mode may fall back to a temp folder."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="claimweave-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
    sc.setCheckpointDir(named)
    return named


_DROPPED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What runs inside leaves no shuffle files: they go with the end of each action.

    Else they stay until the driver's garbage collection, and many steps after
    each other fill the disk. For actions whose DataFrame is not run again.
    """
    before = spark.conf.get(_DROPPED, "false")
    spark.conf.set(_DROPPED, "true")
    try:
        yield
    finally:
        spark.conf.set(_DROPPED, before)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder that a job has written and needs no more."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark._jsc.hadoopConfiguration()).delete(found, True)


_STORED: list[str] = []


def release(spark: SparkSession) -> None:
    """Delete the tables that `stored` has written so far; DataFrames over them end here."""
    while _STORED:
        discard(spark, _STORED.pop())


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write `df` as a table in the shared folder and continue from the stored rows.

    As safe as a checkpoint, and later reads take only the columns and row
    groups they need.
    """
    path = f"{checkpoint_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    _STORED.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialise(df: DataFrame) -> DataFrame:
    """Write `df` to the shared checkpoint folder and continue from the stored rows.

    For the rounds of iterative jobs: stored rows survive the loss of executors,
    and their files go with the object that stands for them.
    """
    checkpoint_dir(df.sparkSession)
    with shuffles_dropped(df.sparkSession):
        return df.select("*").checkpoint(eager=True)  # the setting holds for new DataFrames
