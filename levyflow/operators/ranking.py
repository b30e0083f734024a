"""Latest-by-key, dedupe-by-key and top-k.

``row_number() = 1`` is planned with a rank limit on both sides of the shuffle: each
task sends at most one row per key, so a key that holds a third of the table still
arrives as one row per task and never as a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def _first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)


def latest_by(
    df: DataFrame,
    keys: Sequence[str],
    recency: Sequence[str],
    attributes: Sequence[str],
    ties: Sequence[str] = (),
) -> DataFrame:
    """``keys`` and ``attributes`` of the newest row per key.

    Newest means highest ``recency`` columns, nulls last. Ties go to the highest
    ``ties`` columns and then to the highest attributes, which makes the result a
    function of the rows alone.
    """
    order = [F.desc_nulls_last(c) for c in dict.fromkeys((*recency, *ties, *attributes))]
    needed = list(dict.fromkeys((*keys, *attributes, *recency, *ties)))
    return _first_per_key(df.select(*needed), keys, order).select(*keys, *attributes)


def dedupe_by(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] | None = None
) -> DataFrame:
    """One whole row per key, null keys counting as equal.

    The row kept is the first under ``order`` (names sort ascending, nulls first) and
    then under all remaining columns, so it depends on the rows and not on their
    placement.
    """
    named = {c for c in order or () if isinstance(c, str)}
    explicit = [F.asc_nulls_first(c) if isinstance(c, str) else c for c in order or ()]
    rest = [F.asc_nulls_first(c) for c in df.columns if c not in named and c not in set(keys)]
    ordering = explicit + rest or [F.lit(1).asc()]
    return _first_per_key(df, keys, ordering)


def top_k(df: DataFrame, k: int, by: str, ties: Sequence[str] = ()) -> DataFrame:
    """The ``k`` rows with the highest ``by``; nulls last, ties in ascending ``ties``."""
    return df.orderBy(F.desc_nulls_last(by), *[F.asc_nulls_first(c) for c in ties]).limit(k)
