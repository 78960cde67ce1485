"""Tables in the shared checkpoint folder, which cut lineage and survive lost executors."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from ..session import checkpoint_dir


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write `df` as parquet to the shared folder and continue from the stored rows."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/llm-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused(name: str, df: DataFrame) -> str:
    """`name`, with underscores before it until no column of `df` has that name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
