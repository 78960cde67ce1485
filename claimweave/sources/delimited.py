"""CSV feeds: tolerant scan, landing, and the log of what was landed."""

from __future__ import annotations

import os
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from .layout import SOURCES, Source
from .lineage import with_lineage
from .sinks import COMPRESSION

# Cell texts that mean "missing".
MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
           "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


@dataclass(frozen=True)
class Landed:
    table_name: str
    source_file: str
    row_count: int
    status: str  # loaded, missing, empty or failed
    detail: str = ""


def read_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """All columns as text, missing-value texts as NULL; `path` is a file or a folder of files.

    Files are split over tasks. `multi_line` allows line breaks inside quotes,
    which keeps each file in one task.
    """
    df = (spark.read.option("header", True).option("multiLine", multi_line)
          .option("quote", '"').option("escape", '"').option("inferSchema", False).csv(path))
    return df.select(*[
        F.when(~F.col(f"`{c}`").isin(*MISSING), F.col(f"`{c}`")).alias(c.strip())
        for c in df.columns])


def land(spark: SparkSession, path: str, source: Source, file: str | None = None) -> tuple[DataFrame | None, Landed]:
    """Read one feed into the landed shape; (None, reason) where there is nothing to load.

    Columns the table does not have are dropped, columns the file does not have
    are NULL; the hash covers the columns of the file in file order.
    """
    file = file or source.file
    try:
        raw = read_csv(spark, path, source.multi_line)
        if raw.isEmpty():
            return None, Landed(source.name, file, 0, "empty")
    except AnalysisException as error:
        status = "missing" if error.getCondition() == "PATH_NOT_FOUND" else "failed"
        return None, Landed(source.name, file, 0, status, str(error).splitlines()[0])
    except Exception as error:  # an unreadable feed must not stop the others
        return None, Landed(source.name, file, 0, "failed", str(error).splitlines()[0])
    now = raw.withColumn("_now", F.date_trunc("second", F.current_timestamp()))
    landed = with_lineage(now, source, "_now", file, raw.columns)
    return landed, Landed(source.name, file, -1, "loaded")


def land_folder(spark: SparkSession, folder: str, target: str, batch_id: str,
                sources: Iterable[Source] = tuple(SOURCES.values()), parallel: int = 4) -> list[Landed]:
    """Land `folder/<system>/<file>` for every source under `target/<table>`.

    Every load adds a batch; repeating a batch replaces it. One feed that is
    missing, empty or broken leaves its own entry in the result and no more.
    """
    def one(source: Source) -> Landed:
        df, log = land(spark, os.path.join(folder, source.system, source.file), source)
        if df is None:
            return log
        seen = Observation()
        try:
            (df.withColumn("batch_id", F.lit(batch_id)).observe(seen, F.count("*").alias("rows"))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .option("compression", COMPRESSION)
             .partitionBy("batch_id").parquet(os.path.join(target, source.name)))
        except Exception as error:
            return Landed(source.name, source.file, 0, "failed", str(error).splitlines()[0])
        return Landed(source.name, source.file, seen.get["rows"], "loaded")

    with ThreadPoolExecutor(parallel) as pool:
        return list(pool.map(one, sources))


def read_landed(spark: SparkSession, target: str, name: str) -> DataFrame:
    """All batches of a landed table in its declared shape."""
    source = SOURCES[name]
    return spark.read.schema(source.landed_schema()).parquet(os.path.join(target, name))


def landing_log(spark: SparkSession, results: list[Landed]) -> DataFrame:
    return spark.createDataFrame(
        [asdict(r) for r in results],
        "table_name string, source_file string, row_count long, status string, detail string")


def register_views(spark: SparkSession, target: str, prefix: str = "stg_") -> list[str]:
    """Pass-through views over the landed tables, named for use in SQL."""
    names = []
    for name in SOURCES:
        read_landed(spark, target, name).createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names
