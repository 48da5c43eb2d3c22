"""CSV datasets (S1-S5): one header line per file, commas never quoted.

Layout: ``root/[client_id=<id>/]<dataset>_<YYYYMM>.csv`` and
``root/[client_id=<id>/]menu_items.csv``. With client folders the client comes
from partition discovery; without them pass ``client_id``.

Files are uncompressed text without multi-line fields, so Spark splits large files
freely (``spark.sql.files.maxPartitionBytes``).

Dates are converted by the scan rather than by an expression above it: Catalyst
pushes filters below such expressions and repeats them in every predicate, while a
date converted by the scan is parsed once, and the year range is checked inside the
CSV parser before the other columns are converted.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmetrics.functions.parsing import to_date, to_id, to_integer, to_number, to_timestamp
from tillmetrics.operators.lookups import last_wins
from tillmetrics.schemas import CLIENT, DATASETS, MENU_ITEMS, TRANSACTION_ITEMS, TRANSACTIONS, USERS

#: Cannot occur in a text line, so a line read with it stays one field.
NO_SEPARATOR = "\u0001"
_MONTH_DIGITS = "[0-9]" * 6

#: Delivery order of a row: files by modification time and full path, then position inside the file.
ARRIVAL = "arrival"


def dataset_glob(kind: str, months: Iterable[str | int] | None = None) -> str:
    """File name pattern. ``months`` (``202401``) prunes files before listing ends."""
    if not DATASETS[kind].monthly:
        return f"{kind}.csv"
    if months is None:
        return f"{kind}_{_MONTH_DIGITS}.csv"
    chosen = sorted(str(month) for month in months)
    if not chosen or any(len(month) != 6 or not month.isdigit() for month in chosen):
        raise ValueError("months must be a non-empty list of YYYYMM values")
    return f"{kind}_{{{','.join(chosen)}}}.csv"


# Date forms of the files, zero padding optional.
TIMESTAMP_FORMAT = "y-M-d H:m:s"
DATE_FORMAT = "y-M-d"


def csv_options(reader, schema: T.StructType):
    """Reader (batch or stream) of the file form; a bad field becomes null, its row stays."""
    return (
        reader.schema(schema)
        .option("header", True)
        .option("quote", "")
        .option("mode", "PERMISSIVE")
        .option("timestampNTZFormat", TIMESTAMP_FORMAT)
        .option("dateFormat", DATE_FORMAT)
    )


def with_client_folder(schema: T.StructType) -> T.StructType:
    """The client folder read as text, whatever it looks like."""
    return T.StructType([*schema.fields, T.StructField(CLIENT, T.StringType())])


def _scan(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    glob: str,
    client_id: str | None,
    separator: str = ",",
) -> DataFrame:
    """Columns of the schema and the client; no column for further folder levels."""
    names = schema.names
    if client_id is None:
        schema = with_client_folder(schema)
    reader = csv_options(spark.read, schema).option("pathGlobFilter", glob).option("sep", separator)
    rows = reader.csv(root)
    if client_id is not None:
        rows = with_client(rows, client_id)
    return rows.select(*names, CLIENT)


def read_raw(
    spark: SparkSession,
    root: str,
    kind: str,
    months: Iterable[str | int] | None = None,
    client_id: str | None = None,
    bad_rows: str = "pad",
) -> DataFrame:
    """The text columns of one dataset plus ``client_id``, before any conversion.

    A short row is padded with nulls and surplus fields are ignored. With
    ``bad_rows="flag"`` such rows also get ``is_bad_row``: lines are then split
    here, because the CSV parser cannot report a bad row when it prunes columns.
    """
    glob = dataset_glob(kind, months)
    if bad_rows == "pad":
        return _scan(spark, root, DATASETS[kind].text_schema, glob, client_id)
    if bad_rows != "flag":
        raise ValueError("bad_rows must be 'pad' or 'flag'")
    return split_lines(read_lines(spark, root, glob, client_id), kind).drop("line")


def split_lines(lines: DataFrame, kind: str) -> DataFrame:
    """Text columns from a ``line`` column, flagging lines of the wrong length.

    Empty fields are null, as they are for the CSV scan.
    """
    names = DATASETS[kind].names
    fields = F.split("line", ",")
    columns = {name: F.nullif(F.get(fields, F.lit(i)), F.lit("")) for i, name in enumerate(names)}
    return lines.withColumns({**columns, "is_bad_row": F.size(fields) != len(names)})


def delivered_month() -> Column:
    """Month of a row's file, from the name; null for files without one."""
    return F.nullif(F.regexp_extract(F.col("_metadata.file_name"), rf"_({_MONTH_DIGITS})\.csv$", 1), F.lit(""))


def read_lines(
    spark: SparkSession, root: str, glob: str = "*.csv", client_id: str | None = None
) -> DataFrame:
    """Data lines of any mix of files, headers skipped: ``line``, ``client_id``."""
    schema = T.StructType([T.StructField("line", T.StringType())])
    return _scan(spark, root, schema, glob, client_id, NO_SEPARATOR)


def with_dataset_kind(rows: DataFrame, name_column: str | Column = "_metadata.file_name") -> DataFrame:
    """S3: dataset of a row from its file name, null when unknown.

    The order of the tests matters for names that hold more than one dataset name.
    """
    name = F.col(name_column) if isinstance(name_column, str) else name_column
    kind = F.lit(None).cast("string")
    for dataset in (TRANSACTIONS, TRANSACTION_ITEMS, USERS, MENU_ITEMS):
        kind = F.when(name.contains(dataset), F.lit(dataset)).otherwise(kind)
    return rows.withColumn("dataset", kind)


def with_client(rows: DataFrame, client_id: str) -> DataFrame:
    """Tag rows with the client they belong to."""
    return rows.withColumn(CLIENT, F.lit(client_id))


_CONVERSIONS = {
    T.TimestampNTZType(): to_timestamp,
    T.DateType(): to_date,
    T.DoubleType(): to_number,
    T.LongType(): to_id,
    T.IntegerType(): to_integer,
}


def _converted(kind: str) -> dict[str, Column]:
    """Conversion of every column of a dataset that is not text."""
    columns = {
        name: _CONVERSIONS[data_type](F.col(name))
        for name, data_type in DATASETS[kind].columns
        if data_type in _CONVERSIONS
    }
    if "voucher_id" in columns:  # arrives as "7.0", like every optional id
        columns["voucher_id"] = to_id(F.col("voucher_id")).try_cast("int")
    return columns


def typed(raw: DataFrame, kind: str) -> DataFrame:
    """Convert text columns; what does not parse becomes null.

    Other columns (client, flags) pass through. This is the form for rows that were
    text first, such as flagged lines or messages; see ``scanned`` for files.
    """
    return raw.withColumns(_converted(kind))


def scanned(rows: DataFrame, kind: str) -> DataFrame:
    """E6, E7 for what the scan left to do: ids to whole numbers, amounts from text."""
    columns = {}
    if "voucher_id" in rows.columns:
        columns["voucher_id"] = to_id(F.col("voucher_id")).try_cast("int")
    for name, data_type in DATASETS[kind].columns:
        if data_type == T.LongType():
            columns[name] = to_id(F.col(name))
        elif data_type == T.DoubleType():
            columns[name] = to_number(F.col(name))
    return rows.withColumns(columns)


def rejected(raw: DataFrame, kind: str, required: Iterable[str]) -> DataFrame:
    """the text rows whose ``required`` columns do not all parse, for a side table.

    ``reason`` names the first such column. ``raw`` comes from :func:`read_raw`.
    """
    parsed = _converted(kind)
    reasons = [F.when(parsed[name].isNull(), F.lit(name)) for name in required]
    return raw.withColumn("reason", F.coalesce(*reasons)).filter(F.col("reason").isNotNull())


def read_dataset(
    spark: SparkSession,
    root: str,
    kind: str,
    months: Iterable[str | int] | None = None,
    client_id: str | None = None,
    bad_rows: str = "pad",
) -> DataFrame:
    """Typed rows of one dataset; see :func:`read_raw` for the arguments."""
    if bad_rows == "pad":
        glob = dataset_glob(kind, months)
        return scanned(_scan(spark, root, DATASETS[kind].scan_schema, glob, client_id), kind)
    return typed(read_raw(spark, root, kind, months, client_id, bad_rows), kind)


def read_dimension(
    spark: SparkSession,
    root: str,
    kind: str,
    months: Iterable[str | int] | None = None,
    client_id: str | None = None,
    deduplicate: bool = True,
) -> DataFrame:
    """Menu items or users, with the delivery order of each row and last row wins.

    Rows of one file split are numbered in file order by
    ``monotonically_increasing_id``; together with modification time, full path and
    split offset that is the order in which the files were written. Pass ``deduplicate=False`` to
    reduce the rows first and apply ``last_wins`` afterwards.
    """
    rows = read_dataset(spark, root, kind, months, client_id)
    arrival = F.struct(
        F.col("_metadata.file_modification_time").alias("delivered"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("offset"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = rows.withColumn(ARRIVAL, arrival)
    if not deduplicate:
        return rows
    key = DATASETS[kind].names[0]
    return last_wins(rows, [CLIENT, key], ARRIVAL).drop(ARRIVAL)
