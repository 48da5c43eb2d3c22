"""Incremental ingest (T1) that ignores redelivered batches.

A batch is one file below ``client_id=<id>/[sender=<id>/][any folder/]``. It is
identified by client, sender, file name and a fingerprint of its lines, so a true
copy counts once and a file of a known name with other lines is a batch of its own.
The ledger holds one small row per batch, never per row of data, and has no time
limit: a repeated batch may come back at any time. Copies are listed beside it.

Files may carry any modification time: the age limit of Spark's file source is set
beyond any real one. Its list of seen paths, in the driver, then keeps every path:
some 200 MB for a million files.

Two ways in, by batch size:

* :func:`land_stream` for files of any size. The stream carries file *names*; an ordinary job, which splits the
  files over all tasks, stages the typed rows together with hashes of
  their lines. Fingerprints are sums over those hashes, and the staged folder
  becomes the landed one by a rename. Where a client, sender and name come again, nothing is staged: the files of that
  dataset are read for their fingerprints, and those accepted a second time for their rows.
* :func:`stream_messages` for message-sized files (tens of kilobytes). One file is
  one row until it is accepted, which also allows the content fingerprint.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmetrics.functions import batch_fingerprint
from tillmetrics.operators import drop_closed, union_all
from tillmetrics.schemas import CLIENT, DATASETS, TRANSACTION_ITEMS, TRANSACTIONS
from tillmetrics.sources.csv_files import (
    NO_SEPARATOR,
    csv_options,
    dataset_glob,
    scanned,
    split_lines,
    typed,
    with_client_folder,
    with_dataset_kind,
)
from tillmetrics.sources.landing import BY_YEAR, landing_schema
from tillmetrics.sources.landing import land_folder as land
from tillmetrics.sources.shared_files import SharedFiles
from tillmetrics.streaming.running import EPOCH, read_epochs, write_epoch

BATCH_KEY = (CLIENT, "sender", "batch_id")
CONTENT_KEY = (*BATCH_KEY, "content")
#: No file is ever too old; Spark's own limit of seven days drops late files without a word.
MAX_FILE_AGE = "36500d"
#: Names of the contract, for streams as for batch reads.
_CONTRACT_NAME = "^({})$".format(
    "|".join(f"{name}_[0-9]{{6}}[.]csv" if dataset.monthly else f"{name}[.]csv" for name, dataset in DATASETS.items())
)
NO_SENDER = "unknown"
#: Columns of staged rows, beside those of their dataset.
_FILE, _MARKS = "_file", ("_mark0", "_mark1")
FOLDERS = (EPOCH, *BY_YEAR)

MAX_FILES = 10_000

#: One row per accepted batch.
LEDGER_SCHEMA = (
    "path STRING, length BIGINT, client_id STRING, sender STRING, batch_id STRING, dataset STRING, content STRING"
)
_FILE_SCHEMA = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def _folder_value(path: Column, name: str) -> Column:
    return F.nullif(F.regexp_extract(path, f"/{name}=([^/]+)/", 1), F.lit(""))


def sender_columns(path: Column) -> dict[str, Column]:
    """Client and sender of a file, from its folders."""
    return {
        CLIENT: _folder_value(path, CLIENT),
        "sender": F.coalesce(_folder_value(path, "sender"), F.lit(NO_SENDER)),
    }


def _batch_columns(path: Column) -> dict[str, Column]:
    return {**sender_columns(path), "batch_id": F.element_at(F.split(path, "/"), -1)}


def announced_files(spark: SparkSession, root: str, max_files: int = MAX_FILES) -> DataFrame:
    """A stream with one row per new file: path, size, dataset and batch key.

    The file content is a column of this source that is not selected, so it is not read.
    """
    files = (
        spark.readStream.format("binaryFile")
        .schema(_FILE_SCHEMA)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .option("maxFilesPerTrigger", max_files)
        .option("maxFileAge", MAX_FILE_AGE)
        .load(root)
        .select("path", "length")
    )
    keyed = files.withColumns(_batch_columns(F.col("path"))).filter(F.col("batch_id").rlike(_CONTRACT_NAME))
    return with_dataset_kind(keyed, "batch_id")


def _comparable(path: Column, encoded: bool) -> Column:
    """A path in the one form that file listings and row metadata share."""
    if encoded:
        path = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(path, "^([a-z]+):/+", "$1:/")


def _marked_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Lines of the named files, with their client, their file and two hashes."""
    reader = csv_options(spark.read, T.StructType([T.StructField("line", T.StringType())]))
    lines = reader.option("sep", NO_SEPARATOR).option("recursiveFileLookup", True).csv(list(paths))
    return lines.select(
        "line",
        _folder_value(F.col("_metadata.file_path"), CLIENT).alias(CLIENT),
        _comparable(F.col("_metadata.file_path"), True).alias(_FILE),
        *[F.xxhash64(F.lit(seed), "line").alias(name) for seed, name in enumerate(_MARKS)],
    )


def staged_rows(spark: SparkSession, paths: Sequence[str], kind: str) -> DataFrame:
    """Typed rows of the named files, with their file and two hashes of their line."""
    return typed(split_lines(_marked_lines(spark, paths), kind).drop("line", "is_bad_row"), kind)


def content_marks(staged: DataFrame) -> DataFrame:
    """(file, content): a fingerprint of the lines of each file, whatever their order.

    Reads three columns of the staged rows or marked lines; each task sends one row per file.
    """
    sums = [F.sum(F.col(name).cast("decimal(38,0)")).cast("string") for name in _MARKS]
    marks = staged.groupBy(F.col(_FILE).alias("file"))
    return marks.agg(F.concat_ws("/", F.count(F.lit(1)).cast("string"), *sums).alias("content"))


def fresh_batches(announced: DataFrame, marks: DataFrame, known: DataFrame) -> DataFrame:
    """Of the announced files each batch once, and none that is in ``known``."""
    named = announced.withColumn("file", _comparable(F.col("path"), False)).join(marks, "file", "left").drop("file")
    marked = named.withColumn("content", F.coalesce("content", F.lit("empty")))
    fields = [name for name in marked.columns if name not in CONTENT_KEY]
    once = marked.groupBy(*CONTENT_KEY).agg(F.min_by(F.struct(*fields), "path").alias("file"))
    return once.select(*CONTENT_KEY, "file.*").join(known.select(*CONTENT_KEY), list(CONTENT_KEY), "left_anti")


def _repeated_kinds(announced: DataFrame, known: DataFrame) -> set[str]:
    """Datasets of which some file may be a copy: another one or a known batch has its client, sender and name."""
    keyed = announced.groupBy("dataset", *BATCH_KEY).agg(F.count(F.lit(1)).alias("files"))
    seen = keyed.join(known.select(*BATCH_KEY), list(BATCH_KEY), "left_semi")
    found = union_all(keyed.filter("files > 1").select("dataset"), seen.select("dataset"))
    return {row["dataset"] for row in found.distinct().collect()}


def read_batch_files(spark: SparkSession, paths: Sequence[str], kind: str) -> DataFrame:
    """Typed rows of the named files, client taken from the folder name."""
    reader = csv_options(spark.read, DATASETS[kind].scan_schema).option("recursiveFileLookup", True)
    rows = reader.csv(list(paths))
    return scanned(rows.withColumn(CLIENT, _folder_value(F.col("_metadata.file_path"), CLIENT)), kind)


def land_stream(
    spark: SparkSession,
    root: str,
    landing: str,
    ledger: str,
    checkpoint: str,
    closed: DataFrame | None = None,
    kinds: Sequence[str] = (TRANSACTIONS, TRANSACTION_ITEMS),
    max_files: int = MAX_FILES,
) -> None:
    """Bring everything available into the columnar landing area, once.

    A micro-batch overwrites its own ``epoch`` folder, so a repeated micro-batch after
    a failure does not repeat rows. Files of closed clients are left out before any of
    them is read, and every other file is read once, or twice where names come again. The accepted batches of each epoch are kept in ``ledger``, and copies
    of known ones in ``<ledger>-copies``; the driver sees their file names only, at
    most ``max_files`` at a time.
    """

    for kind in kinds:
        _prepare_landing(spark, landing, kind)

    schema = T.StructType.fromDDL(LEDGER_SCHEMA)

    files = SharedFiles(spark)

    def land_epoch(announced: DataFrame, epoch: int) -> None:
        announced = announced.filter(F.col("dataset").isin(*kinds))
        if closed is not None:
            announced = drop_closed(announced, closed)
        found = announced.select("dataset", "path").collect()
        if not found:
            return
        paths = {kind: [row["path"] for row in found if row["dataset"] == kind] for kind in kinds}
        known = read_epochs(spark, schema, ledger).filter(F.col(EPOCH) < epoch)
        repeated, staged, marked = _repeated_kinds(announced, known), {}, []
        for kind in kinds:
            if kind in repeated:  # what a copy holds is not written
                marked.append(_marked_lines(spark, paths[kind]))
            elif paths[kind]:
                folder = f"{landing}/_staged/{kind}"
                land(staged_rows(spark, paths[kind], kind), folder, BY_YEAR)
                staged[kind] = spark.read.schema(_staged_schema(kind)).parquet(folder)
                marked.append(staged[kind])
        marks = union_all(*[content_marks(rows) for rows in marked])
        write_epoch(fresh_batches(announced, marks, known).select(*schema.names), ledger, epoch)
        batches = spark.read.schema(schema).parquet(f"{ledger}/{EPOCH}={epoch}")
        copies = announced.join(batches.select("path"), "path", "left_anti")
        write_epoch(copies, f"{ledger}-copies", epoch)
        for kind in kinds:
            target = f"{landing}/{kind}/{EPOCH}={epoch}"
            if kind in repeated:
                accepted = [row["path"] for row in batches.filter(F.col("dataset") == kind).select("path").collect()]
                files.delete(target)  # of the same epoch before a failure
                if accepted:
                    land(staged_rows(spark, accepted, kind).drop(_FILE, *_MARKS), target, BY_YEAR)
            elif kind in staged:
                files.delete(target)
                files.move(f"{landing}/_staged/{kind}", target)

    read_epochs(spark, schema, ledger)  # makes the folder
    query = (
        announced_files(spark, root, max_files)
        .writeStream.foreachBatch(land_epoch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _staged_schema(kind: str) -> T.StructType:
    extra = [T.StructField(_FILE, T.StringType()), *[T.StructField(name, T.LongType()) for name in _MARKS]]
    typed_fields = landing_schema(kind, BY_YEAR).fields
    return T.StructType([*typed_fields[: -len(BY_YEAR)], *extra, *typed_fields[-len(BY_YEAR) :]])


def _prepare_landing(spark: SparkSession, landing: str, kind: str) -> None:
    """The folder must exist even when no file of this dataset ever arrives."""
    empty = spark.createDataFrame([], landing_schema(kind, FOLDERS))
    empty.write.mode("ignore").partitionBy(*FOLDERS).parquet(f"{landing}/{kind}")


def stream_landed(spark: SparkSession, landing: str, kind: str, max_files: int = MAX_FILES) -> DataFrame:
    """Typed rows of the landing area as a stream, in parquet files."""
    reader = spark.readStream.schema(landing_schema(kind, FOLDERS)).option("maxFilesPerTrigger", max_files)
    reader = reader.option("maxFileAge", MAX_FILE_AGE)
    return reader.parquet(f"{landing}/{kind}").drop(EPOCH, "year")


def stream_dataset(spark: SparkSession, root: str, kind: str, max_files: int = MAX_FILES) -> DataFrame:
    """Typed rows straight from the CSV files, for inputs that are never redelivered.

    The source remembers file paths, so a path is read once even after a restart.
    """
    schema = DATASETS[kind].scan_schema
    reader = (
        csv_options(spark.readStream, with_client_folder(schema))
        .option("pathGlobFilter", dataset_glob(kind))
        .option("maxFilesPerTrigger", max_files)
        .option("maxFileAge", MAX_FILE_AGE)
    )
    return scanned(reader.csv(root).select(*schema.names, CLIENT), kind)


def stream_messages(
    spark: SparkSession,
    root: str,
    kind: str,
    key: str = "content",
    max_files: int = MAX_FILES,
    glob: str = "*",
) -> DataFrame:
    """T2 for message-sized files without header line: typed rows of each message, once.

    ``key="content"`` identifies a message by the fingerprint of its text (E9), so two
    equal messages of one sender collapse; ``key="name"`` uses the file name.
    """
    if key not in ("content", "name"):
        raise ValueError("key must be 'content' or 'name'")
    messages = (
        spark.readStream.format("text")
        .option("wholetext", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", max_files)
        .option("maxFileAge", MAX_FILE_AGE)
        .load(root)
    )
    keyed = messages.withColumns(_batch_columns(F.col("_metadata.file_path")))
    if key == "content":
        fingerprint = batch_fingerprint(F.col("value"), F.col("sender"), F.col(CLIENT))
        keyed = keyed.withColumn("batch_id", fingerprint)
    once = keyed.dropDuplicates(list(BATCH_KEY))
    lines = once.select(CLIENT, F.explode(F.split("value", "\r?\n")).alias("line"))
    rows = split_lines(lines.filter(F.trim("line") != ""), kind)
    return typed(rows.drop("line", "is_bad_row"), kind)
