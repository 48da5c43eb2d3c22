"""Columnar landing copy of the fact datasets, partitioned for pruning.

Parsing text is the most expensive step of every question, and three of them read
the same transactions. Landing pays for it once: each question then reads a few
parquet columns of the year and month folders it needs.

A landing copy is a versioned set (see ``versions``): each load stands for all files, for the
files of some clients or for those of some months, and replaces what earlier loads held of
these, also of clients that are no longer in the input. Copies landed without versions
(folders of clients right below the path) are not read; load them again.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmetrics.schemas import CLIENT, DATASETS
from tillmetrics.sources.redelivery import origin_fields, without_copies
from tillmetrics.sources.versions import EVERYTHING, Scope, VersionedSet

#: Month of the delivered file, as in its name. Rows of one file may have dates of other months.
FILE_MONTH = "file_month"
#: Folder levels of a landing copy made in one go.
BY_MONTH = (CLIENT, FILE_MONTH, "year", "month")
#: Folder levels where many small deliveries arrive: fewer, larger files.
BY_YEAR = (CLIENT, "year")
#: Loads whose replaced versions stay on disk, for readers that have begun.
KEPT_LOADS = 1

_PARTS = {"year": F.year, "month": F.month}


def landing_schema(kind: str, partitions: Sequence[str]) -> T.StructType:
    """Typed columns of a dataset followed by its folder levels."""
    levels = {CLIENT: T.StringType(), FILE_MONTH: T.StringType(), "epoch": T.LongType(), "through": T.StringType()}
    folders = [T.StructField(name, levels.get(name, T.IntegerType())) for name in partitions]
    return T.StructType([*DATASETS[kind].typed_schema.fields, *folders])


def _kind_of(rows: DataFrame) -> str:
    """The monthly dataset that all columns belong to, but for those that begin with ``_``."""
    given = {name for name in rows.columns if not name.startswith("_")} - {CLIENT, FILE_MONTH}
    fitting = [name for name, dataset in DATASETS.items() if dataset.monthly and given <= set(dataset.names)]
    if len(fitting) != 1 or not {CLIENT, "created_at"} <= set(rows.columns):
        raise ValueError(f"columns {rows.columns} are not those of one fact dataset with {CLIENT} and created_at")
    return fitting[0]


def as_typed(rows: DataFrame, kind: str) -> DataFrame:
    """The typed columns of a dataset, whatever types they come with; those not given are null.

    All files of a copy then have the types that readers expect. Values that do not fit
    raise an error (ANSI mode) rather than being lost.
    """
    fields = DATASETS[kind].typed_schema.fields
    typed = [(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields]
    others = [name for name in rows.columns if name not in DATASETS[kind].names]
    return rows.select(*typed, *others)


def _with_levels(rows: DataFrame, partitions: Sequence[str]) -> DataFrame:
    return rows.withColumns({name: _PARTS[name]("created_at") for name in partitions if name in _PARTS})


def land_folder(rows: DataFrame, path: str, partitions: Sequence[str]) -> None:
    """Replace one folder of typed rows; a stream has one for each of its epochs."""
    rows = _with_levels(as_typed(rows, _kind_of(rows)), partitions)
    rows.write.mode("overwrite").partitionBy(*partitions).parquet(path)


def land(rows: DataFrame, path: str, scope: Scope = EVERYTHING, file_month: Column | None = None) -> None:
    """Write typed rows of one dataset as what ``scope`` consists of from now on.

    No shuffle: monthly files mostly map to one folder. A client with most of the rows is written by all
    tasks that read it. Rows without a valid date are kept too, in the folder for a null year. ``file_month`` is
    the month of a row's file where the scope names months, else the month of its date.
    """
    kind = _kind_of(rows)
    month = F.date_format("created_at", "yyyyMM") if file_month is None else file_month
    rows = _with_levels(as_typed(rows.withColumn(FILE_MONTH, month), kind), BY_MONTH)
    VersionedSet(rows.sparkSession, path, BY_MONTH).load(rows, scope, keep=KEPT_LOADS)


def read_landed(
    spark: SparkSession,
    path: str,
    kind: str,
    years: Iterable[int] | None = None,
    months: Iterable[int] | None = None,
    file_months: Iterable[str] | None = None,
    clients: Iterable[str] | None = None,
    once: bool = False,
) -> DataFrame:
    """Typed rows again; ``years``, ``months`` and the others skip whole folders.

    The folder filter comes on top of the timestamp predicates of the plans, it
    never replaces them. ``once`` leaves out files that were delivered before, for copies landed
    with the origin of their rows (see ``redelivery``).
    """
    schema = landing_schema(kind, BY_MONTH)
    if once:
        schema = T.StructType([*T.StructType.fromDDL(origin_fields()).fields, *schema.fields])
    rows = VersionedSet(spark, path, BY_MONTH).read(schema)
    if once:
        rows = without_copies(rows)
    for name, wanted in (("year", years), ("month", months), (FILE_MONTH, file_months), (CLIENT, clients)):
        if wanted is not None:
            rows = rows.filter(F.col(name).isin(*wanted))
    return rows.drop("year", "month", FILE_MONTH)
