"""Sums of doubles that are exact until they are rounded once, whatever the order and the partitions.

Every value is an integer times a power of two. The powers are taken in steps of ``STEP`` binary digits, the
bins; within its bin a value is a long, whose three limbs are added as longs without loss. The few bins of a
group are put together as one whole number at the end, and sum and average are rounded from that.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from levyflow.shipping import ship_package

# A value is below 2**62 in its bin. Limbs of 21 digits leave room for 2**42 rows of a group in a bin.
STEP, LIMB = 8, 21
LIMBS = ("high", "middle", "low")
# Digits of a double behind its first.
_DIGITS = 52
# Bins of all doubles, from the smallest one's.
_FIRST, _LAST = -1076 // STEP, 1024 // STEP


def _scales(half: int) -> Column:
    """By bin, one of two powers of two that together bring it to whole numbers; the product can be beyond doubles."""
    powers = [_DIGITS - STEP * b for b in range(_FIRST, _LAST + 1)]
    # One literal in SQL: a column for each number would be a call to the JVM for each.
    return F.expr(f"array({', '.join(f'{2.0 ** (p // 2 if half else p - p // 2)!r}D' for p in powers)})")


def bin_of(value: Column) -> Column:
    # One less than the binary exponent: the logarithm may be a hair too large.
    return F.when(value == 0, 0).otherwise(F.floor((F.floor(F.log2(F.abs(value))) - 1) / STEP)).cast("int")


def in_bin(value: Column, number: Column) -> Column:
    """The value of a bin as a long: it is that times ``2**(STEP * number - 52)``."""
    place = number - _FIRST
    return (value * F.get(_scales(0), place) * F.get(_scales(1), place)).cast("long")


def limbs(whole: Column) -> dict[str, Column]:
    mask = F.lit((1 << LIMB) - 1)
    return {"high": F.shiftright(whole, 2 * LIMB), "middle": F.shiftright(whole, LIMB).bitwiseAND(mask), "low": whole.bitwiseAND(mask)}


def ratio(bins: Sequence[tuple[int, int, int, int]]) -> tuple[int, int]:
    """The exact sum of some bins, given as number and sums of limbs, as numerator and denominator."""
    least = min(b[0] for b in bins)
    total = sum((((high << LIMB) + middle << LIMB) + low) << STEP * (b - least) for b, high, middle, low in bins)
    power = STEP * least - _DIGITS
    return (total << power, 1) if power >= 0 else (total, 1 << -power)


def rounded(numerator: int, denominator: int) -> float:
    """The nearest double; infinite beyond the largest."""
    try:
        return numerator / denominator
    except OverflowError:
        return float("inf") if numerator > 0 else float("-inf")


def exact_sums(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``by``, ``rows`` and ``sums``: for each of ``columns``, in their order, ``total, average, values``.

    Totals and averages are the exact ones of the doubles, rounded once to a double; null where a group has no
    value. An infinity or NaN in a group gives what adding it gives. A task sends one row for each group, column
    and bin, of which there are 264, into the first shuffle, and a group has one row behind the second. More than
    2**42 rows of a group in a bin are an error.
    """
    ship_package(df.sparkSession)
    by = list(by)
    entry = [F.struct(F.lit(i).alias("__column"), F.col(c).cast("double").alias("__value")) for i, c in enumerate(columns)]
    # A marker for the row itself keeps groups whose values are all null, and counts rows.
    entry.append(F.struct(F.lit(len(columns)).alias("__column"), F.lit(0.0).alias("__value")))
    long = df.select(*by, F.inline(F.array(*entry))).where(F.col("__value").isNotNull())
    finite = F.abs("__value") < float("inf")
    # One step after the other: what is used several times is computed once.
    value, number, whole = F.col("__value"), F.col("__bin"), F.col("__whole")
    sums = (
        long.withColumn("__odd", F.when(~finite | F.isnan(value), value))
        .withColumn("__value", F.when(F.col("__odd").isNull(), value))
        .withColumn("__bin", bin_of(value))
        .withColumn("__whole", in_bin(value, number))
        .groupBy(*by, "__column", "__bin")
        .agg(*[F.try_sum(c).alias(f"__{n}") for n, c in limbs(whole).items()], F.sum("__odd").alias("__odd"), F.count("*").alias("__n"))
    )
    lists = sums.groupBy(*by).agg(F.collect_list(F.struct("__column", "__bin", *[f"__{n}" for n in LIMBS], "__odd", "__n")).alias("__bins"))
    return lists.select(*by, _put_together(len(columns))("__bins").alias("__all")).select(
        *by, F.col("__all.rows").alias("rows"), F.col("__all.sums").alias("sums"))


def _put_together(columns: int):
    kind = pa.struct([("rows", pa.int64()), ("sums", pa.list_(pa.struct([
        ("total", pa.float64()), ("average", pa.float64()), ("values", pa.int64())])))])

    def one(bins: list[dict]) -> dict:
        own: list[list[dict]] = [[] for _ in range(columns + 1)]
        for b in bins:
            own[b["__column"]].append(b)
        return {"rows": sum(b["__n"] for b in own[columns]), "sums": [_sum_of(c) for c in own[:columns]]}

    @F.arrow_udf("rows long, sums array<struct<total:double,average:double,values:long>>")
    def put_together(bins: pa.Array) -> pa.Array:
        return pa.array([one(b) for b in bins.to_pylist()], kind)

    return put_together


def _sum_of(bins: list[dict]) -> dict:
    values = sum(b["__n"] for b in bins)
    if not bins:
        return {"total": None, "average": None, "values": 0}
    odd = [b["__odd"] for b in bins if b["__odd"] is not None]
    if odd:
        return {"total": sum(odd), "average": sum(odd), "values": values}
    parts = [(b["__bin"], *[b[f"__{n}"] for n in LIMBS]) for b in bins]
    if any(None in p for p in parts):
        raise OverflowError("too many rows in a group for exact sums")
    numerator, denominator = ratio(parts)
    return {"total": rounded(numerator, denominator), "average": rounded(numerator, denominator * values), "values": values}
