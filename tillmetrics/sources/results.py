"""Result sets: one versioned set per question, with a folder per client (S7), and previews.

A result set is replaced for some clients or for all of them at once: readers by :func:`read_result` see
the old answer until the new one is complete. Folders of replaced answers are removed right after
that, so other tools may read the folder of a question as it is; while an answer is being
replaced they can meet both.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from tillmetrics.schemas import CLIENT
from tillmetrics.sources.versions import EVERYTHING, VersionedSet


def result_path(root: str, query: str) -> str:
    return f"{root.rstrip('/')}/{query}"


def _set(spark: SparkSession, query: str, root: str, fmt: str) -> VersionedSet:
    return VersionedSet(spark, result_path(root, query), [CLIENT], fmt)


def write_result(
    df: DataFrame,
    query: str,
    root: str,
    fmt: str = "parquet",
    compact: bool = False,
    whole: bool = False,
    clients: Sequence[str] | None = None,
) -> None:
    """Replace the results of the clients in ``df``; other clients stay as they are.

    A client without any result row keeps its old result: name it in ``clients``, which are then the ones
    replaced, or pass ``whole`` when ``df`` answers for every client there is, which replaces
    all of the question. ``compact`` shuffles the result into
    evenly sized files first, for a result that leaves little of every scan task; AQE
    merges small clients and splits large ones.
    """
    if compact:
        df = df.hint("rebalance", CLIENT)
    scope = EVERYTHING if whole else None if clients is None else {CLIENT: list(clients)}
    _set(df.sparkSession, query, root, fmt).load(df, scope)


def clear_result(
    spark: SparkSession,
    schema: T.StructType,
    query: str,
    root: str,
    client_id: str,
    fmt: str = "parquet",
) -> None:
    """Start of a client's session: its old result set becomes empty."""
    _set(spark, query, root, fmt).load(None, {CLIENT: [client_id]})


def has_result(spark: SparkSession, query: str, root: str) -> bool:
    """Whether the question has ever been answered below ``root``."""
    return _set(spark, query, root, "parquet").current()[0] > 0


def read_result(
    spark: SparkSession, schema: T.StructType, query: str, root: str, fmt: str = "parquet"
) -> DataFrame:
    fields = [field for field in schema.fields if field.name != CLIENT]
    fields.append(T.StructField(CLIENT, T.StringType()))
    return _set(spark, query, root, fmt).read(T.StructType(fields))


def print_rows(df: DataFrame) -> None:
    """All rows as text lines, fetched one partition at a time."""
    print(",".join(df.columns))
    for row in df.toLocalIterator():
        print(",".join("" if value is None else str(value) for value in row))


def preview(df: DataFrame, order: Sequence[Column | str], n: int = 5) -> DataFrame:
    """First ``n`` rows in a stated order; each task keeps only its best ``n``."""
    return df.orderBy(*order).limit(n)
