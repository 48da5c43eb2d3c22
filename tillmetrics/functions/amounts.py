"""Amounts: predicates that are safe for NaN, and exact sums.

Sums run over whole cents in a BIGINT. A sum of doubles depends on the order in
which tasks finish; a DECIMAL sum is exact but slower and shuffles wider buffers.
BIGINT cents hold 9.2e16 currency units per group, and ANSI mode raises an error
beyond that instead of wrapping around.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_number(amount: Column) -> Column:
    """Not null and not NaN."""
    return amount.isNotNull() & ~F.isnan(amount)


def at_least(amount: Column, minimum: float) -> Column:
    """F4. Spark ranks NaN above every number, so NaN is excluded explicitly."""
    return (amount >= F.lit(float(minimum))) & ~F.isnan(amount)


def positive(amount: Column) -> Column:
    """F5."""
    return (amount > F.lit(0.0)) & ~F.isnan(amount)


def to_cents(amount: Column) -> Column:
    """Amount in whole cents; null when it has no finite value."""
    return F.rint(amount * F.lit(100.0)).try_cast("bigint")


def total_cents(amount: Column) -> Column:
    """Exact sum of an amount column, in cents (A1, A2)."""
    return F.sum(to_cents(amount))


def units(cents: Column) -> Column:
    """Cents back to currency units."""
    return cents.cast("double") / F.lit(100.0)
