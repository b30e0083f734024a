"""Label and scaling expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def scale(value: Column, mean: float, std: float) -> Column:
    """``(value - mean) / std``; a column without spread (``std == 0``) becomes 0."""
    if std == 0.0:
        return F.when(value.isNotNull(), F.lit(0.0))
    return (value - F.lit(mean)) / F.lit(std)


def unscale(value: Column, mean: float, std: float) -> Column:
    return value * F.lit(std) + F.lit(mean)


def two_way_label(value: Column, equals: float, match: str, other: str) -> Column:
    """``match`` where ``value == equals``, ``other`` elsewhere, null included."""
    return F.when(value == F.lit(equals), F.lit(match)).otherwise(F.lit(other))
