"""Top-1, top-N and orderings."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Number of places in the lower half of a packed key: every 64-bit number, and null.
_PLACES = Decimal(2**64 + 1)
_HIGHEST = Decimal(2**63)


def leader_of(measure: str, tie_break: str) -> Column:
    """A4, A5: aggregate giving the highest measure, lowest ``tie_break`` on a tie, null last.

    Returns a struct with ``measure`` and ``tie_break``, both whole numbers. They are packed into one number of fixed
    width that rises with the measure and falls with the tie-break, so that a plain maximum finds the
    leader in a hash aggregation, without sorting. A measure may be up to 5.4e18; beyond that ANSI mode
    raises an error. Several leaders can be taken in one ``agg``; each task sends one
    row per group, so a group may be of any size.
    """
    place = F.coalesce(F.lit(_HIGHEST) - F.col(tie_break).cast("decimal(20,0)"), F.lit(0))
    packed = F.max(F.col(measure).cast("decimal(20,0)") * F.lit(_PLACES) + place)
    place = F.pmod(packed, F.lit(_PLACES))
    highest = ((packed - place) / F.lit(_PLACES)).cast("bigint")
    lowest = F.when(place > 0, (F.lit(_HIGHEST) - place).cast("bigint"))
    return F.struct(highest.alias(measure), lowest.alias(tie_break))


def top_n_per_group(
    rows: DataFrame, groups: Sequence[str], order: Sequence[Column], n: int, rank_name: str = "rank"
) -> DataFrame:
    """The first ``n`` rows of every group under ``order``, then under all other columns.

    Catalyst turns ``row_number() <= n`` into a group limit before the shuffle as
    well, so a task sends at most ``n`` rows per group however large the group is
    (for ``n`` up to ``spark.sql.optimizer.windowGroupLimitThreshold``).
    """
    rest = [F.col(name) for name in rows.columns if name not in groups]
    window = Window.partitionBy(*groups).orderBy(*order, *rest)
    return rows.withColumn(rank_name, F.row_number().over(window)).filter(F.col(rank_name) <= n)


def sort_all(rows: DataFrame) -> DataFrame:
    """Normal form for display, ordered by all columns."""
    return rows.orderBy(*rows.columns)
