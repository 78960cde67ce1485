"""Writing and reading tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import shuffles_dropped

COMPRESSION = "zstd"  # halves the row hashes, the largest part of landed and cleaned rows


def write_table(df: DataFrame, path: str, month_of: str | None = None) -> None:
    """Full rebuild of a parquet table, optionally split by the month of a date column.

    Months are brought together by a rebalance, which adaptive execution cuts
    into even files, also when one month holds most of the rows.
    """
    with shuffles_dropped(df.sparkSession):
        if month_of is None:
            df.write.mode("overwrite").option("compression", COMPRESSION).parquet(path)
            return
        month = f"{month_of.removesuffix('_date')}_month"
        monthly = df.withColumn(month, F.date_format(month_of, "yyyy-MM"))
        (monthly.hint("rebalance", month).write.mode("overwrite").option("compression", COMPRESSION)
         .partitionBy(month).parquet(path))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Text files with a header that `read_csv` of this package reads back."""
    (df.write.mode(mode).option("header", True).option("quote", '"')
     .option("escape", '"').option("emptyValue", "").option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))
