"""T2 for batch reads: files that were delivered more than once count once.

A delivery is known by client, sender, file name and content, as in streams. Copies lie in another folder
below that of their client and sender. Content is compared by order-free sums over hashes of a file's rows,
one small row per file; a file of a known name with other rows is a delivery of its own.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmetrics.schemas import CLIENT
from tillmetrics.sources.csv_files import dataset_glob

FILE = "_file"
_MARKS = ("_mark0", "_mark1")


def _origin(path: Column) -> dict[str, Column]:
    return {
        "_sender": F.regexp_extract(path, "/sender=([^/]+)/", 1),
        "_name": F.element_at(F.split(path, "/"), -1),
    }


def has_repeated_names(
    spark: SparkSession, root: str, kind: str, months: Iterable[str] | None = None
) -> bool:
    """Whether some client and sender has several files of one name. Only names are listed, no file is read."""
    names = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    paths = names.option("pathGlobFilter", dataset_glob(kind, months)).load(root).select("path")
    client = F.regexp_extract("path", f"/{CLIENT}=([^/]+)/", 1).alias("_client")
    origins = [column.alias(name) for name, column in _origin(F.col("path")).items()]
    return bool(paths.groupBy(client, *origins).count().filter("count > 1").take(1))


def with_origin(rows: DataFrame) -> DataFrame:
    """Rows of files with their file and two hashes of themselves, which stay with a landing copy."""
    columns = [F.col(name) for name in rows.columns]
    marks = {name: F.xxhash64(F.lit(seed), *columns) for seed, name in enumerate(_MARKS)}
    return rows.withColumns({FILE: F.col("_metadata.file_path"), **marks})


def origin_fields() -> str:
    """DDL of the columns that :func:`with_origin` adds."""
    return ", ".join([f"{FILE} STRING", *[f"{name} BIGINT" for name in _MARKS]])


def without_copies(rows: DataFrame) -> DataFrame:
    """Rows with their origin, of each delivery once, the origin left out.

    Rows without an origin stay. Sums over files are combined on the map side, and the list of copies is
    broadcast when its measured size allows; rows are not shuffled for it then.
    """
    sums = [F.sum(F.col(name).cast("decimal(38,0)")).alias(name) for name in _MARKS]
    files = rows.filter(F.col(FILE).isNotNull()).groupBy(CLIENT, FILE).agg(F.count(F.lit(1)).alias("_rows"), *sums)
    files = files.withColumns(_origin(F.col(FILE)))
    key = [CLIENT, "_sender", "_name", "_rows", *_MARKS]
    first = files.groupBy(*key).agg(F.min(FILE).alias("_first"), F.count(F.lit(1)).alias("_times")).filter("_times > 1")
    copies = files.join(first, key).filter(F.col(FILE) != F.col("_first")).select(CLIENT, FILE)
    return rows.join(copies, [CLIENT, FILE], "left_anti").drop(FILE, *_MARKS)
