"""Reproducible draws: functions of a key and a purpose, not of partitioning."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def draw(key, purpose: str) -> Column:
    """A number in [0, 1) from the MD5 of purpose and key."""
    k = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(F.lit(purpose + ":"), k.cast("string")))
    return F.conv(F.left(digest, F.lit(8)), 16, 10).cast("long") / F.lit(4294967296.0)


def draw_int(key, purpose: str, low: int, high: int) -> Column:
    """A whole number from `low` to `high`, both included."""
    return (F.floor(draw(key, purpose) * (high - low + 1)) + low).cast("int")


def pick(key, purpose: str, values) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]),
                        draw_int(key, purpose, 1, len(values)))
