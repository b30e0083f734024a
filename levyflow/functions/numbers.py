"""Text-to-number cleaning and money arithmetic."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, sub

from pyspark.sql import Column
from pyspark.sql import functions as F

# Wide enough for sums of any number of rows; four decimals hold an amount times a percentage.
MONEY = "decimal(28,4)"

# A comma may only stand between groups of three digits before the decimal point.
GROUPED_NUMBER = r"^\s*[+-]?(\d{1,3}(,\d{3})+|\d+)?(\.\d*)?([eE][+-]?\d+)?\s*$"


def _parsed(text: Column, strict: bool) -> Column:
    number = F.replace(text, F.lit(","), F.lit("")).try_cast("double")
    return F.when(text.rlike(GROUPED_NUMBER), number) if strict else number


def malformed(text: Column, strict: bool = False) -> Column:
    """True where there is text but no number can be read from it."""
    return text.isNotNull() & (text != "") & _parsed(text, strict).isNull()


def clean_number(text: Column, on_error: str = "fail", strict: bool = False) -> Column:
    """Double from text with thousands commas; null and ``''`` give null.

    All commas are dropped, wherever they stand, so ``1.257,60`` reads as 1.2576;
    ``strict=True`` treats such text as malformed instead. Malformed text fails the
    job by default, whatever the session's ANSI setting is; ``on_error='null'``
    turns it into null (count those rows with ``malformed``).
    """
    number = F.when(text != "", _parsed(text, strict))
    if on_error == "null":
        return number
    if on_error != "fail":
        raise ValueError(f"on_error must be 'fail' or 'null', not {on_error!r}")
    complaint = F.raise_error(F.concat(F.lit("malformed number: "), text)).cast("double")
    return F.coalesce(number, F.when(text != "", complaint))


def to_integer(text: Column) -> Column:
    """Int from text, null where it is not a number; ``2025.7`` is cut to 2025.

    This is the lenient (non-ANSI) cast, for which ``.5`` and even ``.`` are 0. The regular expressions only
    run on rows that a plain cast rejects.
    """
    whole = F.regexp_extract(text, r"^\s*([+-]?\d+)\.\d*\s*$", 1)
    fraction = F.when(text.rlike(r"^\s*[+-]?\.\d*\s*$"), 0)
    return F.coalesce(text.try_cast("int"), whole.try_cast("int"), fraction)


def to_money(value: Column | str, digits: int = 18, places: int = 4) -> Column:
    """Exact money, wide enough for an amount times a percentage.

    Sums no longer depend on row order, and ties round the same everywhere.
    """
    column = F.col(value) if isinstance(value, str) else value
    return column.cast(f"decimal({digits},{places})")


def net_amount(plus: Sequence[Column | str], minus: Sequence[Column | str] = (), places: int = 2) -> Column:
    """Sum of ``plus`` less ``minus``, rounded half-up; null when any term is null."""
    as_column = [F.col(c) if isinstance(c, str) else c for c in plus]
    less = [F.col(c) if isinstance(c, str) else c for c in minus]
    return F.round(reduce(sub, less, reduce(add, as_column)), places)
