"""Grouped sums and counts (A1-A3) and the union of shards.

Each is one hash aggregation with map-side combine over fixed-width buffers: a hot
group leaves a task as a single row, so no group is gathered in one place.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmetrics.functions.amounts import total_cents


def count_and_total(
    rows: DataFrame,
    keys: Sequence[str],
    amount: Column,
    count_name: str = "sold_count",
    total_name: str = "total_cents",
) -> DataFrame:
    """A1: number of rows (not quantities) and exact amount per key."""
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(count_name), total_cents(amount).alias(total_name)
    )


def total_by(
    rows: DataFrame, keys: Sequence[str], amount: Column, total_name: str = "total_cents"
) -> DataFrame:
    """A2: exact amount per key."""
    return rows.groupBy(*keys).agg(total_cents(amount).alias(total_name))


def count_by(rows: DataFrame, keys: Sequence[str], count_name: str = "purchases") -> DataFrame:
    """A3: number of rows per key."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name))


def union_all(*shards: DataFrame) -> DataFrame:
    """Result shards of several sources as one set, matched by column name."""
    return reduce(lambda left, right: left.unionByName(right), shards)
