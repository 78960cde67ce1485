"""From landed text to the cleaned, typed layer."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.casts import clean_value, key_text
from ..sources.layout import LINEAGE, Source
from .latest import newest_per_key


class ContractError(ValueError):
    """A table does not have the declared columns and types."""


def newest_rows(landed: DataFrame, source: Source, raw_key: bool = False) -> DataFrame:
    """Latest load per key; rows of one load that tie are settled by their hash.

    Keys are compared trimmed and in canonical case unless `raw_key` asks for
    the text as it arrived. All rows with a NULL key count as one key.
    """
    keys = [F.col(k) if raw_key else key_text(k, source.rule(k)[0]) for k in source.key]
    return newest_per_key(landed, keys, [F.desc("_ingested_at"), F.asc("_row_hash")])


def clean(landed: DataFrame, source: Source, raw_key: bool = False) -> DataFrame:
    """Deduplicate, type and validate one source table."""
    values = [clean_value(*f).alias(f[0]) for f in source.fields]
    return newest_rows(landed, source, raw_key).select(
        *values, *LINEAGE, F.current_timestamp().alias("_silver_loaded_at"))


def check_contract(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Fail unless `df` has exactly the expected columns and types, in order."""
    def shape(schema):
        return [(f.name, f.dataType.simpleString()) for f in schema]
    if shape(df.schema) != shape(expected):
        wrong = [(a, b) for a, b in zip(shape(df.schema), shape(expected)) if a != b]
        raise ContractError(f"columns differ from the contract: {wrong or 'different count'}")
    return df
