"""Lenient text conversion (E1, E6, E7, F6): a value that does not parse becomes null.

Spark 4 runs in ANSI mode, where a plain ``cast`` of bad text fails the job. Each
conversion therefore checks the shape first and then uses ``try_cast``. The shape
check also rejects text that Spark would read but the input contract does not
allow, such as a date without time, or a number with a Java type suffix (``12d``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted text forms.
TIMESTAMP_SHAPE = r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$"
DATE_SHAPE = r"^\d{4}-\d{1,2}-\d{1,2}$"
NOT_IN_A_NUMBER = r"[^0-9eE.+ -]"
SPECIAL_NUMBERS = ("inf", "+inf", "-inf", "infinity", "+infinity", "-infinity", "nan", "+nan", "-nan")
INTEGER_SHAPE = r"^\s*[+-]?\d+\s*$"
WHOLE_SHAPE = r"^\s*([+-]?\d+)(\.0*)?\s*$"


def _shaped(text: Column, shape: str, target: str) -> Column:
    return F.when(text.rlike(shape), text.try_cast(target))


def to_timestamp(text: Column) -> Column:
    """``2024-01-05 07:03:00``, zero padding optional, no time zone."""
    return _shaped(text, TIMESTAMP_SHAPE, "timestamp_ntz")


def to_date(text: Column) -> Column:
    return _shaped(text, DATE_SHAPE, "date")


def to_number(text: Column) -> Column:
    """Text to double; ``nan`` and ``inf`` are numbers, predicates deal with them."""
    number = text.try_cast("double")
    special = F.lower(F.trim(text)).isin(*SPECIAL_NUMBERS)
    return F.when(~text.rlike(NOT_IN_A_NUMBER) | special, number)


def to_id(text: Column) -> Column:
    """``"123"`` and ``"123.0"`` to 123, exact over all 64 bits; other numbers truncated.

    Null for ``nan``, ``inf`` and text.
    """
    digits = F.nullif(F.regexp_extract(text, WHOLE_SHAPE, 1), F.lit(""))
    return F.coalesce(digits.try_cast("bigint"), whole(to_number(text)))


def whole(number: Column, target: str = "bigint") -> Column:
    """A double to a whole number, truncating; null where it has none."""
    return number.try_cast("bigint").try_cast(target)


def to_integer(text: Column, target: str = "int") -> Column:
    return _shaped(text, INTEGER_SHAPE, target)


def non_blank(text: Column) -> Column:
    """the empty string counts as missing."""
    return F.nullif(F.trim(text), F.lit(""))
