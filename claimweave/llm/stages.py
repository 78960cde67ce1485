"""Stages of the training-corpus pipeline: each works on all that the one before it kept.

Rows are taken as they come: a null or empty text is scored, linked and encoded
like any other, a row without an id stays unless its text decides otherwise, and
columns besides those of `documents` pass through all stages but the last.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import bpe, decontaminate, langid, line_runs, simhash, toxicity
from .storage import stored, unused


def _only(docs: DataFrame, found: DataFrame, how: str) -> DataFrame:
    """Rows of `docs` whose id is in `found`, or is not; every row of an id fares alike."""
    name = unused("_id", docs)
    ids = found.select(F.col("doc_id").alias(name)).distinct()
    return docs.join(ids, F.col("doc_id").eqNullSafe(F.col(name)), how)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the threshold of a classifier learned from the labelled ones."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(
        langid.fold("doc_id", 4) != 2)
    model = toxicity.fit(docs, labels)
    return toxicity.keep_below(docs, model)


def delete_line_runs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without later copies of line runs."""
    return line_runs.delete_repeats(docs, count_column=None)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near copies: that with the smallest id.

    Fingerprints of three-word shingles link at three differing bits or fewer.
    """
    return simhash.first_of_groups(docs, distance=3, shingle=3)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = stored(decontaminate.contaminated(docs, benchmark), "contaminated")
    return _only(docs, found, "left_anti")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256): token ids of every document as little-endian
    unsigned 32-bit integers, and the digest of the bytes that they decode to."""
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), decoded=True)
