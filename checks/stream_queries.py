"""Streaming operators; every stream runs until its input is exhausted."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.batch_queries import HOURLY_TPV_SQL, LEADERS_SQL, Q1_SQL, TPV_SQL
from checks.file_queries import EVENT_COLUMNS_SQL, LAST_BUYERS_SQL, event_files, leader_files, monthly, user_files
from checks.files import (
    copy_delivery,
    move_delivery,
    new_root,
    set_age,
    transaction_text,
    write_announcements,
    write_contract_files,
)
from checks.registry import query
from checks.tables import (
    ALL_SEMESTERS,
    ORDER_PARAMS,
    SCHEMAS,
    event_client,
    event_store,
    events_as_transactions,
    orders_as_transactions,
    part_as_menu,
    table,
)
from tillmetrics.functions import in_hours
from tillmetrics.operators import keep_referenced, union_all
from tillmetrics.plans import (
    buyer_counts,
    high_value_transactions,
    item_month_totals,
    rank_buyers,
    rank_items,
    semester_store_totals,
    semester_store_tpv,
    store_volume,
)
from tillmetrics.plans.buyers import BUYER
from tillmetrics.plans.items import ITEM_MONTH
from tillmetrics.plans.stores import SEMESTER_STORE
from tillmetrics.schemas import CLIENT, MENU_ITEMS, TRANSACTIONS, USERS
from tillmetrics.sources import read_dimension
from tillmetrics.streaming import (
    Session,
    batch_counts,
    close_clients,
    current_totals,
    finish,
    observed,
    read_epochs,
    run_session,
    start_append,
    start_totals,
    stream_dataset,
    stream_messages,
)
from tillmetrics.streaming.session import ingest


def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table as a file stream."""
    return spark.readStream.schema(SCHEMAS[name]).option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_as_transactions(_stream(spark, sf_dir, "events"))


def _totals(totals: DataFrame, label: str, keys) -> DataFrame:
    spark = totals.sparkSession
    work = new_root(spark, label)
    finish(start_totals(totals, keys, f"{work}/out", f"{work}/checkpoint"))
    return current_totals(spark, totals.schema, keys, f"{work}/out")


@query("stream_q1", Q1_SQL.format(75))
def stream_q1(spark, sf_dir):
    """Stateless stream with stage counters, rows appended by epoch."""
    events = _stream(spark, sf_dir, "events")
    counted = observed(events, "stage", after_hours=in_hours(F.col("ts"), 6, 22))
    found = high_value_transactions(events_as_transactions(counted)).select(
        F.col("transaction_id").alias("event_id"),
        "user_id",
        F.col("store_id").alias("event_type"),
        F.col("final_amount").alias("value"),
        F.col("created_at").alias("ts"),
    )
    work = new_root(spark, "stream-q1")
    finish(start_append(found, f"{work}/out", f"{work}/checkpoint"))
    return read_epochs(spark, found.schema, f"{work}/out").drop("epoch")


@query(
    "stream_leaders", LEADERS_SQL.format(client="'client_1'", menu="") + "SELECT * EXCLUDE (client_id) FROM leaders"
)
def stream_leaders(spark, sf_dir):
    """Running item totals, leaders ranked over them."""
    items = _stream(spark, sf_dir, "lineitem").select(
        F.lit("client_1").alias(CLIENT),
        F.col("l_partkey").alias("item_id"),
        F.col("l_extendedprice").alias("subtotal"),
        F.col("l_shipdate").alias("created_at"),
    )
    totals = _totals(item_month_totals(items, ORDER_PARAMS), "stream-leaders", ITEM_MONTH)
    return rank_items(totals, part_as_menu(spark, sf_dir)).drop(CLIENT)


@query("stream_q3", HOURLY_TPV_SQL)
def stream_q3(spark, sf_dir):
    """Running volume, equal to the batch answer."""
    totals = _totals(semester_store_totals(_event_stream(spark, sf_dir)), "stream-q3", SEMESTER_STORE)
    return store_volume(totals).drop(CLIENT)


@query(
    "stream_top3",
    """
    SELECT event_type AS store_id, user_id, count(*) AS "count" FROM events
    WHERE hour(ts) BETWEEN 6 AND 22 AND year(ts) IN (2024, 2025) GROUP BY event_type, user_id
    QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY count(*) DESC, user_id DESC) <= 3""",
)
def stream_top3(spark, sf_dir):
    """Running counts, top three per store ranked over them."""
    open_hours = _event_stream(spark, sf_dir).filter(in_hours(F.col("created_at"), 6, 22))
    return rank_buyers(_totals(buyer_counts(open_hours), "stream-top3", BUYER)).drop(CLIENT)


STORE_TPV_SQL = """
    SELECT {client} CAST(year(ts) AS INTEGER) AS year, 1 AS semester, CAST(user_id % 10 AS VARCHAR) AS store_id,
           CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS tpv
    FROM events WHERE hour(ts) BETWEEN 6 AND 22 AND year(ts) IN (2024, 2025) AND month(ts) <= 6 AND value > 0
    {where} GROUP BY ALL"""
CLIENT_SQL = "'client_' || CAST(user_id % 3 AS VARCHAR) AS client_id,"


@query("stream_files", STORE_TPV_SQL.format(client=CLIENT_SQL, where=""))
def stream_files(spark, sf_dir):
    """Several clients' CSV files straight into one running aggregate."""
    root = event_files(spark, sf_dir, "stream-files")
    totals = semester_store_totals(stream_dataset(spark, root, TRANSACTIONS))
    return store_volume(_totals(totals, "stream-files-out", SEMESTER_STORE))


@query(
    "stream_batches",
    f"""SELECT {CLIENT_SQL} 'transactions' AS dataset, count(DISTINCT strftime(ts, '%Y%m')) AS months,
        count(*) AS rows, 0 AS batches_after, CAST(0 AS BIGINT) AS bytes_after FROM events GROUP BY ALL""",
)
def stream_batches(spark, sf_dir):
    """Months and rows of accepted batches per client, and what the second delivery added."""
    root = event_files(spark, sf_dir, "stream-batches")
    session = Session(new_root(spark, "stream-batches-work"))
    ingest(spark, root, session)
    before = batch_counts(spark, session)
    copy_delivery(spark, root, "again")
    ingest(spark, root, session)
    after = batch_counts(spark, session)
    ledger = spark.read.parquet(session.ledger)
    months = ledger.groupBy(CLIENT, "dataset").agg(F.count_distinct("batch_id").alias("months"))
    both = after.join(before.withColumnsRenamed({"batches": "batches_before", "bytes": "bytes_before"}), [CLIENT, "dataset"])
    landed = spark.read.parquet(f"{session.landing}/{TRANSACTIONS}").groupBy(CLIENT).agg(F.count(F.lit(1)).alias("rows"))
    more = {name: F.col(name) - F.col(f"{name}_before") for name in ("batches", "bytes")}
    counted = months.join(both, [CLIENT, "dataset"], "left").join(landed, CLIENT, "left")
    added = [more["batches"].cast("int").alias("batches_after"), more["bytes"].alias("bytes_after")]
    return counted.select(CLIENT, "dataset", "months", "rows", *added)


@query("stream_redelivery", STORE_TPV_SQL.format(client=CLIENT_SQL, where=""))
def stream_redelivery(spark, sf_dir):
    """Every file is delivered twice at once and a third time later, and counted once."""
    root = event_files(spark, sf_dir, "stream-redelivery")
    copy_delivery(spark, root, "again")
    session = Session(new_root(spark, "stream-redelivery-work"))
    ingest(spark, root, session)
    copy_delivery(spark, root, "later")
    ingest(spark, root, session)
    landed = spark.read.parquet(f"{session.landing}/{TRANSACTIONS}")
    return semester_store_tpv(landed)


def _two_deliveries(spark, sf_dir, label: str) -> tuple[str, str]:
    """Transactions of even users below one root, those of odd users below another, under the same names."""
    transactions = events_as_transactions(table(spark, sf_dir, "events"), event_client(), event_store())
    roots = new_root(spark, f"{label}-first"), new_root(spark, f"{label}-second")
    for rest, root in enumerate(roots):
        chosen = transactions.filter(F.pmod("user_id", F.lit(2)) == rest)
        write_contract_files(transaction_text(chosen), TRANSACTIONS, root)
    return roots


@query("stream_backdated", STORE_TPV_SQL.format(client=CLIENT_SQL, where=""))
def stream_backdated(spark, sf_dir):
    """Files that are dated 30 days before all seen ones still count."""
    root, late = _two_deliveries(spark, sf_dir, "stream-backdated")
    session = Session(new_root(spark, "stream-backdated-work"))
    ingest(spark, root, session)
    set_age(spark, late, 30)
    move_delivery(spark, late, root, "late")
    ingest(spark, root, session)
    return semester_store_tpv(spark.read.parquet(f"{session.landing}/{TRANSACTIONS}"))


@query("stream_same_name", STORE_TPV_SQL.format(client=CLIENT_SQL, where=""))
def stream_same_name(spark, sf_dir):
    """Other content under a known name counts, true copies do not."""
    root, other = _two_deliveries(spark, sf_dir, "stream-same-name")
    copy_delivery(spark, root, "again")
    session = Session(new_root(spark, "stream-same-name-work"))
    ingest(spark, root, session)
    move_delivery(spark, other, root, "next")
    copy_delivery(spark, root, "later")
    ingest(spark, root, session)
    return semester_store_tpv(spark.read.parquet(f"{session.landing}/{TRANSACTIONS}"))


@query(
    "stream_messages",
    f"""SELECT {EVENT_COLUMNS_SQL} FROM events""",
)
def stream_messages_query(spark, sf_dir):
    """Message-sized batches recognised by their content, each delivered twice."""
    root = new_root(spark, "stream-messages")
    transactions = events_as_transactions(table(spark, sf_dir, "events"), event_client(), event_store())
    text = transaction_text(transactions).drop("file_month")
    for delivery in ("first", "second"):
        (
            text.write.partitionBy(CLIENT)
            .option("maxRecordsPerFile", 400)
            .csv(f"{root}/{delivery}")
        )
    rows = stream_messages(spark, root, TRANSACTIONS)
    work = new_root(spark, "stream-messages-out")
    finish(start_append(rows, f"{work}/out", f"{work}/checkpoint"))
    return read_epochs(spark, rows.schema, f"{work}/out").drop("epoch")


@query("stream_closed", STORE_TPV_SQL.format(client=CLIENT_SQL, where=""))
def stream_closed(spark, sf_dir):
    """Files of clients that are complete are ignored when more of them arrive."""
    root = event_files(spark, sf_dir, "stream-closed")
    session = Session(new_root(spark, "stream-closed-work"))
    ingest(spark, root, session)
    close_clients(spark.read.parquet(f"{session.landing}/{TRANSACTIONS}"), session)
    transactions = events_as_transactions(table(spark, sf_dir, "events"), event_client(), event_store())
    write_contract_files(transaction_text(transactions), TRANSACTIONS, root, sender="late")
    ingest(spark, root, session)
    return semester_store_tpv(spark.read.parquet(f"{session.landing}/{TRANSACTIONS}"))


def _session_files(spark: SparkSession, sf_dir: str, label: str) -> str:
    """Items, menu, transactions and users of one client, the facts delivered twice."""
    root = leader_files(spark, sf_dir, label, again="again")
    orders = orders_as_transactions(spark, sf_dir).withColumns(
        {
            "payment_method_id": F.lit(1),
            "voucher_id": F.lit(None).cast("int"),
            "original_amount": F.col("final_amount"),
            "discount_applied": F.lit(0.0),
        }
    )
    write_contract_files(transaction_text(monthly(orders)), TRANSACTIONS, root, again="again")
    user_files(spark, sf_dir, root, 6)
    return root


def _session_answers(spark: SparkSession, sf_dir: str, label: str, params) -> dict[str, DataFrame]:
    root = _session_files(spark, sf_dir, label)
    menu = read_dimension(spark, root, MENU_ITEMS, deduplicate=False)
    users = read_dimension(spark, root, USERS, deduplicate=False)
    return run_session(spark, root, new_root(spark, f"{label}-work"), menu, users, params)


@query(
    "stream_session",
    LEADERS_SQL.format(client="'client_1'", menu="") + "SELECT * FROM leaders",
)
def stream_session(spark, sf_dir):
    """T1-T8 from files to the answers of all questions; the item leaders are returned."""
    return _session_answers(spark, sf_dir, "stream-session", ORDER_PARAMS)["q2"]


@query(
    "stream_session_answers",
    f"""SELECT 'q1' AS question, c_nationkey AS store_id, o_custkey AS user_id, CAST(o_orderkey AS VARCHAR) AS detail, o_totalprice AS value
    FROM orders JOIN customer ON o_custkey = c_custkey WHERE year(o_orderdate) IN (1996, 1997) AND o_totalprice >= 75
    UNION ALL SELECT 'q3', store_id, NULL, year || '-' || semester, tpv FROM ({TPV_SQL.format(client="", semesters="")})
    UNION ALL SELECT 'q4', store_id, user_id, CAST(birthday AS VARCHAR), CAST("count" AS DOUBLE) FROM ({LAST_BUYERS_SQL})""",
)
def stream_session_answers(spark, sf_dir):
    """Q1, Q3 and Q4 of one session; hours open all day, birthdates from six deliveries."""
    found = _session_answers(spark, sf_dir, "stream-session-answers", ALL_SEMESTERS)
    store, nobody = F.col("store_id").cast("int").alias("store_id"), F.lit(None).cast("bigint").alias("user_id")
    details = {
        "q1": ("user_id", F.col("transaction_id"), F.col("final_amount")),
        "q3": (nobody, F.concat_ws("-", "year", "semester"), F.col("tpv")),
        "q4": ("user_id", F.col("birthday").cast("string"), F.col("count").cast("double")),
    }
    rows = [
        found[name].select(F.lit(name).alias("question"), store, user, detail.alias("detail"), value.alias("value"))
        for name, (user, detail, value) in details.items()
    ]
    return union_all(*rows)


def _announce(spark: SparkSession, root: str, added: dict[str, int]) -> None:
    """Each sender's announcement: as many batches as it has sent, and those that are still to come."""
    sent = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*_[0-9]*.csv")
    path = F.col("path")
    keys = [F.regexp_extract(path, f"/{name}=([^/]+)/", 1).alias(name) for name in (CLIENT, "sender")]
    counts = sent.load(root).filter(~path.contains("_staging")).groupBy(*keys).agg(F.count(F.lit(1)).alias("batches"))
    more = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in added.items() for x in pair]), F.col(CLIENT)), F.lit(0))
    lines = counts.select(CLIENT, F.lit(TRANSACTIONS).alias("dataset"), (F.col("batches") + more).cast("string").alias("batches"), "sender")
    write_announcements(lines, root)


@query("stream_completed", STORE_TPV_SQL.format(client=CLIENT_SQL, where="AND user_id % 3 > 0"))
def stream_completed(spark, sf_dir):
    """T4: clients whose announced batches have all come are answered, and closed without being named.

    The first client announces a batch that never comes. What arrives later for the others is ignored.
    """
    root = event_files(spark, sf_dir, "stream-completed")
    _announce(spark, root, {"client_0": 1})
    copy_delivery(spark, root, "again")
    menu = spark.createDataFrame([], f"{CLIENT} string, item_id bigint, item_name string")
    work = new_root(spark, "stream-completed-work")
    first = run_session(spark, root, work, menu, None, only_complete=True)["q3"]
    kept = new_root(spark, "stream-completed-first")
    first.write.parquet(kept)
    late = events_as_transactions(table(spark, sf_dir, "events"), event_client(), event_store())
    write_contract_files(transaction_text(late.filter(F.col(CLIENT) != "client_0")), TRANSACTIONS, root, sender="late")
    after = run_session(spark, root, work, menu, None)["q3"]
    same = keep_referenced(after, spark.read.parquet(kept), [CLIENT])
    return same.select("client_id", "year", "semester", "store_id", "tpv")


@query(
    "stream_stages",
    f"""SELECT {CLIENT_SQL} count(*) AS rows_in, count(*) FILTER (WHERE hour(ts) BETWEEN 6 AND 22 AND year(ts) IN (2024, 2025)) AS in_hours,
           count(*) FILTER (WHERE hour(ts) BETWEEN 6 AND 22 AND year(ts) IN (2024, 2025) AND value >= 75) AS high_value
    FROM events GROUP BY ALL""",
)
def stream_stages(spark, sf_dir):
    """Rows in, after the hours and after the amount per client, from a session in two calls, files sent twice."""
    root, late = _two_deliveries(spark, sf_dir, "stream-stages")
    copy_delivery(spark, root, "again")
    menu = spark.createDataFrame([], f"{CLIENT} string, item_id bigint, item_name string")
    work = new_root(spark, "stream-stages-work")
    run_session(spark, root, work, menu, None)
    move_delivery(spark, late, root, "late")
    stages = run_session(spark, root, work, menu, None).stages
    return stages.select(CLIENT, "rows_in", "in_hours", "high_value")
