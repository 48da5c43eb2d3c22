"""Lookups and filters against other tables.

No join carries a broadcast hint. Catalyst broadcasts a side whose estimated size,
and AQE one whose measured size, is below ``spark.sql.autoBroadcastJoinThreshold``;
anything larger is joined by shuffle, with skewed partitions split at run time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmetrics.schemas import CLIENT

UNKNOWN = "Unknown"


def lookup_name(
    rows: DataFrame,
    names: DataFrame,
    id_column: str,
    name_column: str,
    key: str = "item_id",
    value: str = "item_name",
    on: Sequence[str] = (CLIENT,),
) -> DataFrame:
    """Add the name of ``id_column``, ``Unknown`` when there is none.

    ``names`` holds one row per (``on``, key); see :func:`last_wins`.
    """
    table = names.select(
        *on, F.col(key).alias(id_column), F.coalesce(value, F.lit(UNKNOWN)).alias(name_column)
    )
    joined = rows.join(table, [*on, id_column], "left")
    return joined.withColumn(name_column, F.coalesce(name_column, F.lit(UNKNOWN)))


def last_wins(
    rows: DataFrame, keys: Sequence[str], order: str, asked: DataFrame | None = None
) -> DataFrame:
    """One row per key, the one that arrived last.

    Rows of variable width are aggregated by sorting. With ``asked`` only the keys that some row of it holds are
    kept, before that: a dimension of any size is then reduced while it is read, by a join
    with the few keys, and only what is left is sorted.
    """
    if asked is not None:
        rows = keep_referenced(rows, asked, keys)
    values = [name for name in rows.columns if name not in (*keys, order)]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*values, order), order).alias("last"))
    return last.select(*keys, "last.*")


def enrich(rows: DataFrame, profiles: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Add profile columns; rows without a profile keep nulls."""
    return rows.join(profiles.select(*keys, *columns), list(keys), "left")


def keep_referenced(dimension: DataFrame, facts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Only the dimension rows some fact row asks for."""
    return dimension.join(facts.select(*keys), list(keys), "left_semi")


def drop_closed(rows: DataFrame, closed: DataFrame, keys: Sequence[str] = (CLIENT,)) -> DataFrame:
    """Ignore rows of clients that are already completed."""
    return rows.join(closed.select(*keys), list(keys), "left_anti")
