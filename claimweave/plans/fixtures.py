"""Filling the gaps of incomplete feeds by rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def fill_missing(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Fill gaps per column from a rule; values that are there stay."""
    return df.withColumns({
        c: F.coalesce(F.col(c), rule) if c in df.columns else rule for c, rule in rules.items()})
