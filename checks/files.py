"""Contract-named CSV files written by Spark from the given tables.

``<root>/client_id=<c>/sender=<n>/<dataset>_<YYYYMM>.csv``. Spark names its own part
files, so each part gets its contract name by a rename; parts of one month go to
different ``sender`` folders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmetrics.schemas import CLIENT
from tillmetrics.session import new_work_dir

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
MONTH = "file_month"
DELIVERY = "delivery"


def time_text(ts: Column) -> Column:
    return F.date_format(ts, TIME_FORMAT)


def _file_system(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path, jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())


def _files(spark: SparkSession, path: str) -> list:
    """All data files below a folder."""
    folder, fs = _file_system(spark, path)
    listing, found = fs.listFiles(folder, True), []
    while listing.hasNext():
        file = listing.next().getPath()
        if not file.getName().startswith(("_", ".")):
            found.append(file)
    return sorted(found, key=lambda file: file.toString())


def write_contract_files(
    rows: DataFrame,
    kind: str,
    root: str,
    header: bool = True,
    sender: str = "part",
    single_line: bool = False,
    again: str | None = None,
) -> None:
    """Write text rows that carry ``client_id`` and, for monthly datasets, ``file_month``.

    With ``again`` the task that writes a file also writes a copy of it, as :func:`copy_delivery` leaves it.
    """
    spark = rows.sparkSession
    keys = [CLIENT, MONTH] if MONTH in rows.columns else [CLIENT]
    staging = f"{root}/_staging-{kind}-{sender}"
    if again:
        rows = rows.withColumn(DELIVERY, F.explode(F.lit(["first", again])))
        keys.append(DELIVERY)
    writer = rows.write.partitionBy(*keys).mode("error").option("header", header)
    if single_line:  # the line already is the row
        writer.option("sep", "\u0001").option("quote", "").csv(staging)
    else:
        writer.csv(staging)
    numbers: dict[tuple, int] = {}
    for file in _files(spark, staging):
        folder = dict(part.split("=") for part in file.toString().split("/") if "=" in part)
        copied = folder.pop(DELIVERY, "first") != "first"
        number = numbers.setdefault((*folder.values(), file.getName()), len(numbers))  # a copy has that of its file
        month = f"_{folder[MONTH]}" if MONTH in folder else ""
        target = f"{root}/{CLIENT}={folder[CLIENT]}/sender={sender}{number}" + (f"/{again}" if copied else "")
        target_path, fs = _file_system(spark, target)
        fs.mkdirs(target_path)
        fs.rename(file, _file_system(spark, f"{target}/{kind}{month}.csv")[0])


def write_announcements(lines: DataFrame, root: str) -> None:
    """``announced.csv`` of each sender from rows of client, dataset, number and sender."""
    spark, staging = lines.sparkSession, f"{root}/_staging-announced"
    lines.repartition(CLIENT, "sender").write.partitionBy(CLIENT, "sender").option("header", True).csv(staging)
    for file in _files(spark, staging):
        folder = dict(part.split("=") for part in file.toString().split("/") if "=" in part)
        target = f"{root}/{CLIENT}={folder[CLIENT]}/sender={folder['sender']}/announced.csv"
        _, fs = _file_system(spark, target)
        fs.rename(file, _file_system(spark, target)[0])


def copy_delivery(spark: SparkSession, root: str, again: str) -> None:
    """Deliver every file a second time: same client, sender and name, another folder.

    The copies are written by a Spark job, one file each, as their senders would write them.
    """
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*_[0-9]*.csv").text(root)
    path = F.col("_metadata.file_path")
    kept = [F.regexp_extract(path, f"/{name}=([^/]+)/", 1).alias(name) for name in (CLIENT, "sender")]
    inside = F.regexp_extract(path, "/sender=[^/]+/(.*)$", 1)
    header = F.col("value").startswith("transaction_id,")
    keyed = lines.filter(~path.contains("_staging")).select(*kept, F.replace(inside, F.lit("/"), F.lit("~")).alias("file_name"), header.alias("_header"), "value")
    # A file's rows come together in one partition, its header first.
    by_file = keyed.repartition(CLIENT, "sender", "file_name").sortWithinPartitions(CLIENT, "sender", "file_name", F.desc("_header"))
    staging = f"{root}/_staging-{again}"
    by_file.drop("_header").write.partitionBy(CLIENT, "sender", "file_name").text(staging)
    for file in _files(spark, staging):
        folder = dict(part.split("=") for part in file.toString().split("/") if "=" in part)
        *above, name = folder["file_name"].split("~")
        target, fs = _file_system(spark, "/".join([root, f"{CLIENT}={folder[CLIENT]}", f"sender={folder['sender']}", *above, again]))
        fs.mkdirs(target)
        fs.rename(file, _file_system(spark, f"{target.toString()}/{name}")[0])


def move_delivery(spark: SparkSession, source: str, root: str, folder: str) -> None:
    """Put the files of one root into another: same client, sender and name, in a sub-folder."""
    for file in _files(spark, source):
        inside = file.toString().split(source.rstrip("/") + "/", 1)[1]
        where, name = inside.rsplit("/", 1)
        target, fs = _file_system(spark, f"{root}/{where}/{folder}")
        fs.mkdirs(target)
        fs.rename(file, _file_system(spark, f"{root}/{where}/{folder}/{name}")[0])


def set_age(spark: SparkSession, root: str, days: int) -> None:
    """Date all files below a folder some days back."""
    for file in _files(spark, root):
        _, fs = _file_system(spark, root)
        fs.setTimes(file, fs.getFileStatus(file).getModificationTime() - days * 86_400_000, -1)


def transaction_text(transactions: DataFrame) -> DataFrame:
    """Transactions as the text columns of their files; user ids as ``12.0``."""
    return transactions.select(
        F.col("transaction_id").cast("string"),
        F.col("store_id").cast("string"),
        F.col("payment_method_id").cast("string"),
        F.col("voucher_id").cast("string"),
        F.concat(F.col("user_id").cast("string"), F.lit(".0")).alias("user_id"),
        F.col("original_amount").cast("string"),
        F.col("discount_applied").cast("string"),
        F.col("final_amount").cast("string"),
        time_text(F.col("created_at")).alias("created_at"),
        CLIENT,
        F.date_format("created_at", "yyyyMM").alias(MONTH),
    )


def item_text(items: DataFrame) -> DataFrame:
    return items.select(
        F.col("transaction_id").cast("string"),
        F.col("item_id").cast("string"),
        F.col("quantity").cast("int").cast("string").alias("quantity"),
        F.col("subtotal").cast("string").alias("unit_price"),
        F.col("subtotal").cast("string"),
        time_text(F.col("created_at")).alias("created_at"),
        CLIENT,
        F.date_format("created_at", "yyyyMM").alias(MONTH),
    )


def menu_text(menu: DataFrame) -> DataFrame:
    blank = [F.lit("").alias(name) for name in ("category", "price", "is_seasonal", "available_from", "available_to")]
    return menu.select(F.col("item_id").cast("string"), "item_name", *blank, CLIENT)


def new_root(spark: SparkSession, label: str) -> str:
    return new_work_dir(spark, label)
