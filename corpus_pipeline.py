"""Training-corpus pipeline over `documents`; the stages are in claimweave/llm/stages.py."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from claimweave.llm import stages
from claimweave.llm.storage import stored

# most steps have no counterpart in SQL; tests hold them against plain versions
ORACLE_SQL = None

STAGES = [
    ("toxicity", stages.drop_toxic),
    ("line_dedup", stages.delete_line_runs),
    ("near_dedup", stages.drop_near_copies),
    ("decontamination", stages.drop_contaminated),
    ("encoding", stages.encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each stored and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
