"""Lineage columns of landed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .layout import Source


def row_hash(*columns) -> Column:
    """MD5 over the `|`-joined values, NULL written as `nan`."""
    return F.md5(F.concat_ws("|", *[F.coalesce(F.col(c) if isinstance(c, str) else c,
                                               F.lit("nan")) for c in columns]))


def with_lineage(df: DataFrame, source: Source, loaded_at: str, file: str | None = None,
                 file_columns: list[str] | None = None) -> DataFrame:
    """Bring `df` to the landed shape of `source` and add the lineage columns.

    `loaded_at` names a date or timestamp column of `df`. The hash covers the
    columns the file really had (`file_columns`), then system and file name.
    """
    hashed = file_columns or [c for c in source.columns if c in df.columns]
    file = file or source.file
    present = [
        (F.col(c).cast("string") if c in df.columns else F.lit(None).cast("string")).alias(c)
        for c in source.columns
    ]
    return df.select(
        *present,
        F.col(loaded_at).cast("timestamp_ntz").alias("_ingested_at"),
        F.lit(source.system).alias("_source_system"),
        F.lit(file).alias("_source_file"),
        row_hash(*hashed, F.lit(source.system), F.lit(file)).alias("_row_hash"),
    )


def audit_columns(df: DataFrame, record_id: list[str], batch_id: str) -> DataFrame:
    """Extra lineage: the record's own id, the batch it came in, and the raw row as JSON."""
    data = [c for c in df.columns if not c.startswith("_")]
    return df.select(
        "*",
        F.concat_ws("::", *record_id).alias("source_record_id"),
        F.lit(batch_id).alias("batch_id"),
        F.to_json(F.struct(*data), {"ignoreNullFields": "false"}).alias("payload_json"),
    )
