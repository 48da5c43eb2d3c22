"""Sources and sinks: CSV files that Spark derives from the given tables, read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.batch_queries import LEADERS_SQL, TPV_SQL
from checks.files import copy_delivery, item_text, menu_text, new_root, time_text, transaction_text, write_contract_files
from checks.registry import query
from checks.tables import (
    ALL_SEMESTERS,
    ORDER_PARAMS,
    event_client,
    event_store,
    events_as_transactions,
    lineitem_as_items,
    orders_as_transactions,
    part_as_menu,
    table,
)
from tillmetrics.__main__ import load
from tillmetrics.plans import high_value_transactions, monthly_item_leaders, semester_store_tpv, top_buyers_per_store
from tillmetrics.schemas import CLIENT, MENU_ITEMS, TRANSACTION_ITEMS, TRANSACTIONS, USERS
from tillmetrics.sources import (
    clear_result,
    land,
    read_dataset,
    read_dimension,
    read_landed,
    read_lines,
    read_raw,
    read_result,
    rejected,
    with_client,
    with_dataset_kind,
    write_result,
)

EVENT_CLIENT_SQL = "'client_' || CAST(user_id % 3 AS VARCHAR)"
EVENT_COLUMNS_SQL = f"""
    {EVENT_CLIENT_SQL} AS client_id, CAST(event_id AS VARCHAR) AS transaction_id,
    CAST(user_id % 10 AS VARCHAR) AS store_id, '1' AS payment_method_id, CAST(NULL AS INTEGER) AS voucher_id,
    user_id, value AS original_amount, CAST(0 AS DOUBLE) AS discount_applied, value AS final_amount,
    date_trunc('second', ts) AS created_at"""


def _event_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_as_transactions(table(spark, sf_dir, "events"), event_client(), event_store())


def monthly(rows: DataFrame) -> DataFrame:
    """Rows of one client and month together, as monthly files bring them."""
    return rows.repartition(CLIENT, F.date_format("created_at", "yyyyMM"))


def event_files(spark: SparkSession, sf_dir: str, label: str, sender: str = "part") -> str:
    """Transactions files of three clients, written from all events."""
    root = new_root(spark, label)
    write_contract_files(transaction_text(_event_transactions(spark, sf_dir)), TRANSACTIONS, root, sender=sender)
    return root


@query(
    "csv_store_text",
    f"""SELECT {EVENT_CLIENT_SQL} AS client_id, CAST(year(ts) AS INTEGER) AS year,
           CASE WHEN month(ts) <= 6 THEN 1 ELSE 2 END AS semester,
           CASE WHEN user_id % 10 < 5 THEN CAST(user_id % 10 AS VARCHAR) || '.0' ELSE 'S' || CAST(user_id % 10 AS VARCHAR) END AS store_id,
           CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS tpv
    FROM events WHERE hour(ts) BETWEEN 6 AND 22 AND year(ts) IN (2024, 2025) AND month(ts) <= 6 AND value > 0 GROUP BY ALL""",
)
def csv_store_text(spark, sf_dir):
    """Stores that are not plain numbers stay apart."""
    number = event_store().cast("string")
    name = F.when(event_store() < 5, F.concat(number, F.lit(".0"))).otherwise(F.concat(F.lit("S"), number))
    rows = events_as_transactions(table(spark, sf_dir, "events"), event_client(), name)
    root = new_root(spark, "csv-store-text")
    write_contract_files(transaction_text(rows), TRANSACTIONS, root)
    return semester_store_tpv(read_dataset(spark, root, TRANSACTIONS))


@query(
    "csv_big_ids",
    "SELECT 9007199254740992 + user_id AS user_id, count(*) AS rows FROM events GROUP BY ALL",
)
def csv_big_ids(spark, sf_dir):
    """Ids beyond 2^53 stay apart."""
    events = table(spark, sf_dir, "events").withColumn("user_id", F.col("user_id") + F.lit(9007199254740992))
    root = new_root(spark, "csv-big-ids")
    write_contract_files(transaction_text(events_as_transactions(events, F.lit("c"), F.lit("1"))), TRANSACTIONS, root)
    return read_dataset(spark, root, TRANSACTIONS).groupBy("user_id").agg(F.count(F.lit(1)).alias("rows"))


@query("csv_transactions", f"SELECT {EVENT_COLUMNS_SQL} FROM events")
def csv_transactions(spark, sf_dir):
    """Typed scan of CSV files, client from the folder."""
    return read_dataset(spark, event_files(spark, sf_dir, "csv-transactions"), TRANSACTIONS)


@query(
    "csv_high_value",
    f"""SELECT {EVENT_COLUMNS_SQL} FROM events
    WHERE year(ts) IN (2024, 2025) AND hour(ts) BETWEEN 6 AND 22 AND value >= 75""",
)
def csv_high_value(spark, sf_dir):
    """Q1 from files to result."""
    root = event_files(spark, sf_dir, "csv-high-value")
    return high_value_transactions(read_dataset(spark, root, TRANSACTIONS))


@query(
    "csv_months",
    """SELECT 'tagged' AS client_id, strftime(o_orderdate, '%Y%m') AS month, count(*) AS orders
    FROM orders WHERE strftime(o_orderdate, '%Y%m') IN ('199601', '199702', '199812') GROUP BY ALL""",
)
def csv_months(spark, sf_dir):
    """Only the files of three months are listed; the client is given, not read."""
    orders = orders_as_transactions(spark, sf_dir).withColumns(
        {
            "payment_method_id": F.lit(1),
            "voucher_id": F.lit(None).cast("int"),
            "original_amount": F.col("final_amount"),
            "discount_applied": F.lit(0.0),
        }
    )
    root = new_root(spark, "csv-months")
    write_contract_files(transaction_text(orders), TRANSACTIONS, root)
    rows = read_dataset(spark, root, TRANSACTIONS, months=["199601", "199702", "199812"]).drop(CLIENT)
    month = F.date_format("created_at", "yyyyMM").alias("month")
    return with_client(rows, "tagged").groupBy(CLIENT, month).agg(F.count(F.lit(1)).alias("orders"))


def leader_files(spark: SparkSession, sf_dir: str, label: str, again: str | None = None) -> str:
    """Line items, with ``again`` delivered twice, and two menu deliveries; the later one holds the right names."""
    root = new_root(spark, label)
    write_contract_files(item_text(monthly(lineitem_as_items(spark, sf_dir))), TRANSACTION_ITEMS, root, again=again)
    menu = menu_text(part_as_menu(spark, sf_dir))
    outdated = menu.withColumn("item_name", F.concat(F.lit("old "), F.col("item_name")))
    both = outdated.withColumn("_delivery", F.lit(0)).union(menu.withColumn("_delivery", F.lit(1)))
    # An item's rows stay in one file, the outdated one first, as its owner writes them.
    ordered = both.repartition("item_id").sortWithinPartitions("_delivery", "item_id").drop("_delivery")
    write_contract_files(ordered, MENU_ITEMS, root)
    return root


@query("csv_leaders", LEADERS_SQL.format(client="'client_1'", menu="") + "SELECT * FROM leaders")
def csv_leaders(spark, sf_dir):
    """Q2 from files to result, with outdated rows in the menu."""
    root = leader_files(spark, sf_dir, "csv-leaders")
    items = read_dataset(spark, root, TRANSACTION_ITEMS)
    return monthly_item_leaders(items, read_dimension(spark, root, MENU_ITEMS), ORDER_PARAMS)


@query(
    "csv_users",
    """SELECT 'client_1' AS client_id, c_custkey AS user_id, c_mktsegment AS gender,
           CASE WHEN c_custkey % 3 > 0 THEN CAST(DATE '1950-01-01' + CAST(c_custkey % 20000 AS INTEGER) AS DATE) END AS birthdate,
           CASE WHEN c_custkey % 5 > 0 THEN TIMESTAMP '2023-07-01 08:13:07' END AS registered_at FROM customer""",
)
def csv_users(spark, sf_dir):
    """Users; names in the birthdate column and empty dates do not parse and become null."""
    customers = table(spark, sf_dir, "customer")
    text = customers.select(
        F.col("c_custkey").cast("string").alias("user_id"),
        F.col("c_mktsegment").alias("gender"),
        F.when(F.col("c_custkey") % 3 == 0, F.col("c_name"))
        .otherwise(F.date_add(F.to_date(F.lit("1950-01-01")), (F.col("c_custkey") % 20000).cast("int")).cast("string"))
        .alias("birthdate"),
        F.when(F.col("c_custkey") % 5 == 0, F.lit("")).otherwise(F.lit("2023-07-01 08:13:07")).alias("registered_at"),
        F.lit("client_1").alias(CLIENT),
        F.lit("202401").alias("file_month"),
    )
    root = new_root(spark, "csv-users")
    write_contract_files(text, USERS, root)
    return read_dimension(spark, root, USERS)


@query(
    "csv_kinds",
    """SELECT 'client_1' AS client_id, 'transaction_items' AS dataset, count(*) AS lines FROM lineitem
    UNION ALL SELECT 'client_1', 'menu_items', 2 * count(*) FROM part""",
)
def csv_kinds(spark, sf_dir):
    """S3: dataset of every line of a mixed folder, from the file name."""
    lines = with_dataset_kind(read_lines(spark, leader_files(spark, sf_dir, "csv-kinds")))
    return lines.groupBy(CLIENT, "dataset").agg(F.count(F.lit(1)).alias("lines"))


@query(
    "csv_bad_rows",
    """SELECT CAST(event_id AS VARCHAR) AS transaction_id,
           CASE WHEN event_type = 'view' THEN NULL ELSE value END AS subtotal,
           CASE WHEN event_type = 'view' THEN NULL ELSE date_trunc('second', ts) END AS created_at,
           event_type IN ('view', 'click') AS is_bad_row
    FROM events""",
)
def csv_bad_rows(spark, sf_dir):
    """Views are short rows, clicks long ones; both keep their good fields and are flagged."""
    events = table(spark, sf_dir, "events")
    fields = [F.col("event_id"), F.lit(5), F.lit(1)]
    whole = [*fields, F.col("value"), F.col("value"), time_text(F.col("ts"))]
    line = (
        F.when(F.col("event_type") == "view", F.concat_ws(",", *fields))
        .when(F.col("event_type") == "click", F.concat_ws(",", *whole, F.lit("surplus"), F.lit("more")))
        .otherwise(F.concat_ws(",", *whole))
    )
    rows = events.select(line.alias("line"), F.lit("client_1").alias(CLIENT), F.lit("202401").alias("file_month"))
    root = new_root(spark, "csv-bad-rows")
    write_contract_files(rows, TRANSACTION_ITEMS, root, single_line=True)
    read = read_dataset(spark, root, TRANSACTION_ITEMS, bad_rows="flag")
    return read.select("transaction_id", "subtotal", "created_at", "is_bad_row")


@query(
    "csv_padded_rows",
    """SELECT CAST(event_id AS VARCHAR) AS transaction_id, '5' AS item_id,
           CASE WHEN event_type = 'view' THEN NULL ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS created_at
    FROM events""",
)
def csv_padded_rows(spark, sf_dir):
    """The default scan pads short rows and drops surplus fields."""
    events = table(spark, sf_dir, "events")
    fields = [F.col("event_id"), F.lit(5), F.lit(1)]
    whole = F.concat_ws(",", *fields, F.col("value"), F.col("value"), time_text(F.col("ts")), F.lit("surplus"))
    line = F.when(F.col("event_type") == "view", F.concat_ws(",", *fields)).otherwise(whole)
    rows = events.select(line.alias("line"), F.lit("client_1").alias(CLIENT), F.lit("202401").alias("file_month"))
    root = new_root(spark, "csv-padded")
    write_contract_files(rows, TRANSACTION_ITEMS, root, single_line=True)
    return read_raw(spark, root, TRANSACTION_ITEMS).select("transaction_id", "item_id", "created_at")


@query(
    "csv_rejected",
    """SELECT CAST(event_id AS VARCHAR) AS transaction_id,
           CASE WHEN event_type = 'error' THEN 'created_at' ELSE 'final_amount' END AS reason
    FROM events WHERE event_type IN ('error', 'signup')""",
)
def csv_rejected(spark, sf_dir):
    """rows with a spoiled date (errors) or amount (signups), as a side table."""
    text = transaction_text(events_as_transactions(table(spark, sf_dir, "events"), store=F.col("event_type")))
    spoiled = text.withColumns(
        {
            "created_at": F.when(F.col("store_id") == "error", F.lit("yesterday")).otherwise(F.col("created_at")),
            "final_amount": F.when(F.col("store_id") == "signup", F.lit("free")).otherwise(F.col("final_amount")),
        }
    )
    root = new_root(spark, "csv-rejected")
    write_contract_files(spoiled, TRANSACTIONS, root)
    raw = read_raw(spark, root, TRANSACTIONS)
    return rejected(raw, TRANSACTIONS, ["created_at", "final_amount"]).select("transaction_id", "reason")


@query("landed_tpv", TPV_SQL.format(client="o_orderpriority AS client_id,", semesters=""))
def landed_tpv(spark, sf_dir):
    """Q3 over the columnar landing copy, folders pruned to the years."""
    orders = monthly(orders_as_transactions(spark, sf_dir, F.col("o_orderpriority")))
    path = new_root(spark, "landed")
    land(orders, path)
    tpv = semester_store_tpv(read_landed(spark, path, TRANSACTIONS, years=(1996, 1997)), ALL_SEMESTERS)
    return tpv.withColumn("store_id", F.col("store_id").cast("int"))


@query(
    "landed_replaced",
    TPV_SQL.format(
        client="o_orderpriority AS client_id,",
        semesters="""AND o_orderpriority <> '5-LOW' AND (o_orderpriority <> '1-URGENT' OR o_custkey % 2 = 0)
            AND NOT (o_orderpriority = '2-HIGH' AND strftime(o_orderdate, '%Y%m') IN ('199601', '199703'))""",
    ),
)
def landed_replaced(spark, sf_dir):
    """Loads that replace everything, one client, and two months of one client."""
    orders = monthly(orders_as_transactions(spark, sf_dir, F.col("o_orderpriority")))
    path = new_root(spark, "landed-replaced")
    land(orders, path)
    land(orders.filter(F.col(CLIENT) != "5-LOW"), path)  # a client has left the input
    urgent = orders.filter((F.col(CLIENT) == "1-URGENT") & (F.col("user_id") % 2 == 0))
    land(urgent, path, {CLIENT: ["1-URGENT"]})
    nothing = orders.filter(F.lit(False))
    land(nothing, path, {CLIENT: ["2-HIGH"], "file_month": ["199601", "199703"]})
    tpv = semester_store_tpv(read_landed(spark, path, TRANSACTIONS, years=(1996, 1997)), ALL_SEMESTERS)
    return tpv.withColumn("store_id", F.col("store_id").cast("int"))


@query(
    "csv_redelivered",
    f"""SELECT {EVENT_CLIENT_SQL} AS client_id, CAST(year(ts) AS INTEGER) AS year, 1 AS semester,
           CAST(user_id % 10 AS VARCHAR) AS store_id, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS tpv
    FROM events WHERE hour(ts) BETWEEN 6 AND 22 AND year(ts) IN (2024, 2025) AND month(ts) <= 6 AND value > 0 GROUP BY ALL""",
)
def csv_redelivered(spark, sf_dir):
    """T2 in a batch run, Q3: every file twice, the copies in another folder of their sender."""
    root = event_files(spark, sf_dir, "csv-redelivered")
    copy_delivery(spark, root, "again")
    transactions, *_ = load(spark, root, landing=new_root(spark, "csv-redelivered-landing"), with_users=False)
    return semester_store_tpv(transactions)


def user_files(spark: SparkSession, sf_dir: str, root: str, deliveries: int) -> None:
    """Users of all customers, delivered several times under one file name, from a sender folder each.

    Every delivery moves the birthdates by a day, so the last one is told from the others.
    """
    customers = table(spark, sf_dir, "customer")
    born = F.date_add(F.to_date(F.lit("1950-01-01")), (F.col("c_custkey") * 7 % 20000).cast("int"))
    for delivery in range(deliveries):
        text = customers.select(
            F.col("c_custkey").cast("string").alias("user_id"),
            F.col("c_mktsegment").alias("gender"),
            F.date_add(born, delivery).cast("string").alias("birthdate"),
            F.lit("2023-07-01 08:13:07").alias("registered_at"),
            F.lit("client_1").alias(CLIENT),
            F.lit("202401").alias("file_month"),
        )
        write_contract_files(text, USERS, root, sender=f"d{delivery}x")


LAST_BUYERS_SQL = """
    SELECT 'client_1' AS client_id, c_nationkey AS store_id, o_custkey AS user_id, count(*) AS "count",
           CAST(DATE '1950-01-01' + CAST(o_custkey * 7 % 20000 + 5 AS INTEGER) AS DATE) AS birthday
    FROM orders JOIN customer ON o_custkey = c_custkey WHERE year(o_orderdate) IN (1996, 1997)
    GROUP BY c_nationkey, o_custkey
    QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY count(*) DESC, o_custkey DESC) <= 3"""


@query("csv_last_wins", LAST_BUYERS_SQL)
def csv_last_wins(spark, sf_dir):
    """Birthdates from six deliveries of one file name; only users asked for are put in order."""
    root = new_root(spark, "csv-last-wins")
    user_files(spark, sf_dir, root, 6)
    users = read_dimension(spark, root, USERS, deduplicate=False)
    return top_buyers_per_store(orders_as_transactions(spark, sf_dir), users, ORDER_PARAMS)


@query(
    "result_sets",
    TPV_SQL.format(client="o_orderpriority AS client_id,", semesters="AND o_orderpriority <> '5-LOW'"),
)
def result_sets(spark, sf_dir):
    """Results replaced per client; a client whose session restarts is empty again."""
    orders = orders_as_transactions(spark, sf_dir, F.col("o_orderpriority"))
    tpv = semester_store_tpv(orders, ALL_SEMESTERS)
    root = new_root(spark, "results")
    write_result(tpv.withColumn("tpv", F.lit(-1.0)), "q3", root)  # outdated answer
    write_result(tpv, "q3", root)
    clear_result(spark, tpv.schema, "q3", root, "5-LOW")
    return read_result(spark, tpv.schema, "q3", root)
