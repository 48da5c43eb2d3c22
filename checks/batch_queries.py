"""The four questions and every relational operator over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import query
from checks.tables import (
    ALL_SEMESTERS,
    EVENT_PARAMS,
    ORDER_PARAMS,
    customer_as_users,
    event_client,
    events_as_transactions,
    lineitem_as_items,
    orders_as_transactions,
    part_as_menu,
    table,
)
from tillmetrics.functions import (
    batch_fingerprint,
    non_blank,
    semester,
    semester_key,
    to_id,
    to_number,
    to_timestamp,
    units,
    year_month_label,
)
from tillmetrics.operators import (
    agreement,
    count_by,
    diff_rows,
    diff_sample,
    diff_sample_pairs,
    diff_summary,
    drop_closed,
    keep_referenced,
    last_wins,
    pairwise_diff,
    pairwise_verdicts,
    sort_all,
    union_all,
)
from tillmetrics.plans import (
    buyer_counts,
    high_value_transactions,
    item_month_totals,
    monthly_item_leaders,
    rank_buyers,
    semester_store_tpv,
    top_buyers_per_store,
    transaction_funnel,
    yearly_best_month,
)
from tillmetrics.params import Params
from tillmetrics.schemas import CLIENT
from tillmetrics.sources import preview

MONEY = "CAST(sum(CAST({0} AS DECIMAL(18,2))) AS DOUBLE)"
EVENT_CLIENT_SQL = "'client_' || CAST(user_id % 3 AS VARCHAR)"

# ---------------------------------------------------------------- Q1


def _events(spark: SparkSession, sf_dir: str, min_amount: float = 75.0) -> DataFrame:
    transactions = events_as_transactions(table(spark, sf_dir, "events"))
    found = high_value_transactions(transactions, Params(min_amount=min_amount))
    return found.select(
        F.col("transaction_id").alias("event_id"),
        "user_id",
        F.col("store_id").alias("event_type"),
        F.col("final_amount").alias("value"),
        F.col("created_at").alias("ts"),
    )


Q1_SQL = """
    SELECT event_id, user_id, event_type, value, ts FROM events
    WHERE year(ts) IN (2024, 2025) AND hour(ts) BETWEEN 6 AND 22 AND value >= {0}"""


@query("q1_high_value", Q1_SQL.format(75))
def q1_high_value(spark, sf_dir):
    """F1 F3 F4."""
    return _events(spark, sf_dir)


@query(
    "q1_all_columns",
    f"""
    SELECT {EVENT_CLIENT_SQL} AS client_id, event_id AS transaction_id, event_type AS store_id,
           1 AS payment_method_id, CAST(NULL AS INTEGER) AS voucher_id, user_id,
           value AS original_amount, CAST(0 AS DOUBLE) AS discount_applied,
           value AS final_amount, ts AS created_at
    FROM events
    WHERE year(ts) IN (2024, 2025) AND hour(ts) BETWEEN 6 AND 22 AND value >= 75""",
)
def q1_all_columns(spark, sf_dir):
    """Q1 with all nine columns for several clients at once."""
    return high_value_transactions(events_as_transactions(table(spark, sf_dir, "events"), event_client()))


@query(
    "q1_orders",
    """
    SELECT o_orderpriority AS client_id, o_orderkey AS transaction_id, c_nationkey AS store_id,
           o_custkey AS user_id, o_totalprice AS final_amount, o_orderdate AS created_at
    FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE year(o_orderdate) IN (1996, 1997) AND o_totalprice >= 250000""",
)
def q1_orders(spark, sf_dir):
    orders = orders_as_transactions(spark, sf_dir, F.col("o_orderpriority"))
    return high_value_transactions(orders, ORDER_PARAMS)


# ---------------------------------------------------------------- Q2

ITEM_MONTH_SQL = f"""
    SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
           l_partkey AS item_id, count(*) AS sold_count, {MONEY.format('l_extendedprice')} AS total
    FROM lineitem WHERE year(l_shipdate) IN (1996, 1997) GROUP BY 1, 2, 3"""

LEADERS_SQL = """
    WITH totals AS (
        SELECT {client} AS client_id, CAST(year(l_shipdate) AS INTEGER) AS year,
               CAST(month(l_shipdate) AS INTEGER) AS month, l_partkey AS item_id,
               count(*) AS sold_count, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS total
        FROM lineitem WHERE year(l_shipdate) IN (1996, 1997) GROUP BY ALL),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY client_id, year, month ORDER BY sold_count DESC, item_id) AS c,
               row_number() OVER (PARTITION BY client_id, year, month ORDER BY total DESC, item_id) AS s
        FROM totals),
    menu AS (SELECT p_partkey AS item_id, p_name AS item_name FROM part {menu}),
    leaders AS (
        SELECT a.client_id, a.year, a.month, a.item_id AS top_count_item_id,
               coalesce(m.item_name, 'Unknown') AS top_count_item_name, a.sold_count AS top_count,
               b.item_id AS top_sum_item_id, coalesce(n.item_name, 'Unknown') AS top_sum_item_name,
               CAST(b.total AS DOUBLE) AS top_sum
        FROM ranked a JOIN ranked b ON a.client_id = b.client_id AND a.year = b.year AND a.month = b.month
             AND a.c = 1 AND b.s = 1
        LEFT JOIN menu m ON m.item_id = a.item_id LEFT JOIN menu n ON n.item_id = b.item_id)
"""
ONE_CLIENT_LEADERS_SQL = LEADERS_SQL.format(client="'client_1'", menu="")


@query("q2_item_month", ITEM_MONTH_SQL)
def q2_item_month(spark, sf_dir):
    """F2 A1."""
    totals = item_month_totals(lineitem_as_items(spark, sf_dir), ORDER_PARAMS)
    return totals.select("year", "month", "item_id", "sold_count", units(F.col("total_cents")).alias("total"))


def _leaders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly_item_leaders(lineitem_as_items(spark, sf_dir), part_as_menu(spark, sf_dir), ORDER_PARAMS)


@query("q2_leaders", ONE_CLIENT_LEADERS_SQL + "SELECT * EXCLUDE (client_id) FROM leaders")
def q2_leaders(spark, sf_dir):
    """A1 A4 J1 E8."""
    return _leaders(spark, sf_dir).drop(CLIENT)


@query("q2_leaders_per_client", LEADERS_SQL.format(client="l_returnflag", menu="") + "SELECT * FROM leaders")
def q2_leaders_per_client(spark, sf_dir):
    """Several clients, each with its own menu."""
    menus = part_as_menu(spark, sf_dir).withColumn(CLIENT, F.explode(F.lit(["A", "N", "R"])))
    return monthly_item_leaders(
        lineitem_as_items(spark, sf_dir, F.col("l_returnflag")), menus, ORDER_PARAMS
    )


@query(
    "q2_unknown_items",
    LEADERS_SQL.format(client="'client_1'", menu="WHERE p_type <> 'LARGE' AND p_size > 25")
    + "SELECT * EXCLUDE (client_id) FROM leaders",
)
def q2_unknown_items(spark, sf_dir):
    """Items missing from the menu keep their row and get the default name."""
    on_menu = table(spark, sf_dir, "part").filter("p_type <> 'LARGE' AND p_size > 25")
    menu = on_menu.select(
        F.lit("client_1").alias(CLIENT), F.col("p_partkey").alias("item_id"), F.col("p_name").alias("item_name")
    )
    return monthly_item_leaders(lineitem_as_items(spark, sf_dir), menu, ORDER_PARAMS).drop(CLIENT)


@query(
    "q2_best_month",
    ONE_CLIENT_LEADERS_SQL
    + """, reports AS (
        SELECT 'top_selling' AS report, year, month, top_count_item_name AS item_name,
               CAST(top_count AS DOUBLE) AS value FROM leaders
        UNION ALL SELECT 'top_profit', year, month, top_sum_item_name, top_sum FROM leaders)
    SELECT report, year, month, year || '-' || month AS year_month, item_name, value FROM reports
    QUALIFY row_number() OVER (PARTITION BY report, year ORDER BY value DESC, month) = 1""",
)
def q2_best_month(spark, sf_dir):
    """A5 R4 E5, both reports."""
    best = yearly_best_month(_leaders(spark, sf_dir)).drop(CLIENT)
    return best.orderBy("report", "year")


# ---------------------------------------------------------------- Q3

TPV_SQL = """
    SELECT {client} CAST(year(o_orderdate) AS INTEGER) AS year,
           CASE WHEN month(o_orderdate) <= 6 THEN 1 ELSE 2 END AS semester, c_nationkey AS store_id,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS tpv
    FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE year(o_orderdate) IN (1996, 1997) AND o_totalprice > 0 {semesters} GROUP BY ALL"""


@query("q3_semester_tpv", TPV_SQL.format(client="", semesters=""))
def q3_semester_tpv(spark, sf_dir):
    """F1 F5 E3 A2."""
    return semester_store_tpv(orders_as_transactions(spark, sf_dir), ALL_SEMESTERS).drop(CLIENT)


@query("q3_selected", TPV_SQL.format(client="", semesters="AND month(o_orderdate) <= 6"))
def q3_selected(spark, sf_dir):
    """F8: only the first semesters are asked for."""
    return semester_store_tpv(orders_as_transactions(spark, sf_dir), ORDER_PARAMS).drop(CLIENT)


@query("q3_per_client", TPV_SQL.format(client="o_orderpriority AS client_id,", semesters=""))
def q3_per_client(spark, sf_dir):
    orders = orders_as_transactions(spark, sf_dir, F.col("o_orderpriority"))
    return semester_store_tpv(orders, ALL_SEMESTERS)


HOURLY_TPV_SQL = """
    SELECT CAST(year(ts) AS INTEGER) AS year, CASE WHEN month(ts) <= 6 THEN 1 ELSE 2 END AS semester,
           event_type AS store_id, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS tpv
    FROM events WHERE hour(ts) BETWEEN 6 AND 22 AND year(ts) IN (2024, 2025) AND value > 0 GROUP BY ALL"""


@query("q3_hourly_tpv", HOURLY_TPV_SQL)
def q3_hourly_tpv(spark, sf_dir):
    """F3 F5 A2."""
    return semester_store_tpv(events_as_transactions(table(spark, sf_dir, "events"))).drop(CLIENT)


@query(
    "q3_sorted",
    HOURLY_TPV_SQL + " ORDER BY ALL",
)
def q3_sorted(spark, sf_dir):
    """Normal form, ordered by all columns."""
    tpv = semester_store_tpv(events_as_transactions(table(spark, sf_dir, "events"))).drop(CLIENT)
    return sort_all(tpv)


# ---------------------------------------------------------------- Q4

TOP_SQL = """
    SELECT {client} c_nationkey AS store_id, o_custkey AS user_id, count(*) AS "count"
    FROM orders JOIN customer ON o_custkey = c_custkey WHERE year(o_orderdate) IN (1996, 1997)
    GROUP BY {partition} c_nationkey, o_custkey
    QUALIFY row_number() OVER (PARTITION BY {partition} c_nationkey ORDER BY count(*) DESC, o_custkey DESC) <= 3"""


@query("q4_counts", TOP_SQL.format(client="", partition="").split("QUALIFY")[0])
def q4_counts(spark, sf_dir):
    """F6 A3 before ranking."""
    return buyer_counts(orders_as_transactions(spark, sf_dir), ORDER_PARAMS).drop(CLIENT)


@query("q4_top3", TOP_SQL.format(client="", partition=""))
def q4_top3(spark, sf_dir):
    """A3 R1."""
    counts = buyer_counts(orders_as_transactions(spark, sf_dir), ORDER_PARAMS)
    return rank_buyers(counts, ORDER_PARAMS).drop(CLIENT)


@query(
    "q4_top3_per_client",
    TOP_SQL.format(client="o_orderpriority AS client_id,", partition="o_orderpriority,"),
)
def q4_top3_per_client(spark, sf_dir):
    orders = orders_as_transactions(spark, sf_dir, F.col("o_orderpriority"))
    return rank_buyers(buyer_counts(orders, ORDER_PARAMS), ORDER_PARAMS)


@query(
    "q4_profile",
    f"WITH top AS ({TOP_SQL.format(client='', partition='')}) "
    'SELECT store_id, user_id, "count", c_name AS birthday FROM top LEFT JOIN customer ON c_custkey = user_id',
)
def q4_profile(spark, sf_dir):
    """Users are reduced to those asked for, then looked up."""
    orders = orders_as_transactions(spark, sf_dir)
    return top_buyers_per_store(orders, customer_as_users(spark, sf_dir), ORDER_PARAMS).drop(CLIENT)


@query(
    "q4_missing_buyers",
    """
    SELECT event_type AS store_id, user_id, count(*) AS "count" FROM events
    WHERE event_type NOT IN ('error', 'signup') AND year(ts) IN (2024, 2025) GROUP BY ALL""",
)
def q4_missing_buyers(spark, sf_dir):
    """blank stores (errors) and blank users (signups) never count."""
    events = table(spark, sf_dir, "events")
    store = F.when(F.col("event_type") == "error", F.lit("  ")).otherwise(F.col("event_type"))
    user = F.when(F.col("event_type") == "signup", F.lit("")).otherwise(F.col("user_id").cast("string"))
    rows = events_as_transactions(events.withColumns({"event_type": non_blank(store), "user_id": to_id(user)}))
    return buyer_counts(rows).drop(CLIENT)


# ---------------------------------------------------------------- expressions


@query(
    "lenient_parse",
    """
    SELECT event_id, date_trunc('second', ts) AS ts, value, user_id FROM events
    WHERE event_id % 10 NOT IN (0, 1)""",
)
def lenient_parse(spark, sf_dir):
    """Text with spoiled dates and amounts; bad rows are dropped."""
    events = table(spark, sf_dir, "events")
    digit = F.col("event_id") % 10
    spoiled = events.select(
        "event_id",
        F.when(digit == 0, F.lit("2024-13-45 10:00:00"))
        .otherwise(F.date_format("ts", "y-M-d H:m:s"))
        .alias("ts"),
        F.when(digit == 1, F.lit("12.5d")).otherwise(F.col("value").cast("string")).alias("value"),
        F.concat(F.col("user_id").cast("string"), F.lit(".0")).alias("user_id"),
    )
    parsed = spoiled.select(
        "event_id",
        to_timestamp(F.col("ts")).alias("ts"),
        to_number(F.col("value")).alias("value"),
        to_id(F.col("user_id")).alias("user_id"),
    )
    return parsed.filter("ts IS NOT NULL AND value IS NOT NULL")


@query(
    "date_labels",
    """
    SELECT 'semester.' || year(o_orderdate) || '-' || CASE WHEN month(o_orderdate) <= 6 THEN 1 ELSE 2 END
               AS semester_key,
           year(o_orderdate) || '-' || month(o_orderdate) AS year_month, count(*) AS orders
    FROM orders GROUP BY ALL""",
)
def date_labels(spark, sf_dir):
    """E2 E3 E4 E5."""
    orders = table(spark, sf_dir, "orders")
    year = F.year("o_orderdate")
    labelled = orders.select(
        semester_key(year, semester(F.col("o_orderdate"))).alias("semester_key"),
        year_month_label(year, F.month("o_orderdate")).alias("year_month"),
    )
    return count_by(labelled, ["semester_key", "year_month"], "orders")


@query(
    "message_fingerprints",
    """
    SELECT sha256(role || chr(31) || 'unknown' || chr(31) || text) AS batch_id, count(*) AS deliveries
    FROM conversations GROUP BY ALL""",
)
def message_fingerprints(spark, sf_dir):
    """Conversation turns as message contents, their roles as clients; equal messages collapse."""
    turns = table(spark, sf_dir, "conversations")
    key = batch_fingerprint(F.col("text"), F.lit("unknown"), F.col("role"))
    return count_by(turns.select(key.alias("batch_id")), ["batch_id"], "deliveries")


# ---------------------------------------------------------------- joins and sets


@query(
    "late_clients",
    """
    SELECT event_id, user_id, event_type, value, ts FROM events
    WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 10)""",
)
def late_clients(spark, sf_dir):
    """Customers of ten nations stand in for completed clients."""
    closed = table(spark, sf_dir, "customer").filter("c_nationkey < 10").select(F.col("c_custkey").alias("user_id"))
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "ts")
    return drop_closed(events, closed, ["user_id"])


@query(
    "referenced_users",
    "SELECT c_custkey AS user_id, c_name AS birthdate FROM customer WHERE c_custkey IN (SELECT user_id FROM events)",
)
def referenced_users(spark, sf_dir):
    """User columns are pruned and only users some event asks for are kept."""
    users = customer_as_users(spark, sf_dir).select("user_id", "birthdate")
    return keep_referenced(users, table(spark, sf_dir, "events"), ["user_id"])


@query(
    "last_row_wins",
    """
    SELECT user_id, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""",
)
def last_row_wins(spark, sf_dir):
    """Events as updates of a user row."""
    updates = table(spark, sf_dir, "events").select("user_id", "event_type", "value", "event_id")
    return last_wins(updates, ["user_id"], "event_id").drop("event_id")


@query("dedup_union", "SELECT DISTINCT event_type, user_id FROM events")
def dedup_union(spark, sf_dir):
    """D3 in batch form: everything delivered twice, kept once."""
    sent = table(spark, sf_dir, "events").select("event_type", "user_id")
    return union_all(sent.distinct(), sent).dropDuplicates()


@query(
    "shard_union",
    f"""
    SELECT event_type AS store_id, count(*) AS purchases FROM events GROUP BY ALL
    UNION ALL SELECT 'all orders', count(*) FROM orders""",
)
def shard_union(spark, sf_dir):
    """Results of two sources as one set."""
    by_type = count_by(table(spark, sf_dir, "events").select(F.col("event_type").alias("store_id")), ["store_id"])
    orders = table(spark, sf_dir, "orders").select(F.lit("all orders").alias("store_id"))
    return union_all(by_type, count_by(orders, ["store_id"]))


# ---------------------------------------------------------------- reconciliation


@query(
    "funnel",
    """
    SELECT event_type AS client_id, count(*) AS rows_in, count(ts) AS dated,
           count(*) FILTER (WHERE year(ts) IN (2024, 2025)) AS in_years,
           count(*) FILTER (WHERE year(ts) IN (2024, 2025) AND hour(ts) BETWEEN 6 AND 22) AS in_hours,
           count(value) FILTER (WHERE year(ts) IN (2024, 2025) AND hour(ts) BETWEEN 6 AND 22) AS priced,
           count(*) FILTER (WHERE year(ts) IN (2024, 2025) AND hour(ts) BETWEEN 6 AND 22 AND value >= 75)
               AS high_value
    FROM events GROUP BY ALL""",
)
def funnel(spark, sf_dir):
    """Stage counters, event types as clients."""
    return transaction_funnel(events_as_transactions(table(spark, sf_dir, "events"), F.col("event_type")), EVENT_PARAMS)


DIFF_SQL = f"""
    WITH a AS ({Q1_SQL.format(75)}), b AS ({Q1_SQL.format(80)}),
    net AS (
        SELECT event_id, user_id, event_type, value, ts, sum(w) AS net FROM (
            SELECT *, 1 AS w FROM a UNION ALL SELECT *, -1 FROM b) GROUP BY ALL)
    SELECT event_id, user_id, event_type, value, ts,
           CASE WHEN net > 0 THEN 'left_only' ELSE 'right_only' END AS side, CAST(abs(net) AS BIGINT) AS copies
    FROM net WHERE net <> 0"""


@query("diff_sets", DIFF_SQL)
def diff_sets(spark, sf_dir):
    """Q1 at two thresholds."""
    return diff_rows(_events(spark, sf_dir, 75.0), _events(spark, sf_dir, 80.0))


@query(
    "diff_summary",
    f"""
    WITH d AS ({DIFF_SQL})
    SELECT (SELECT count(*) FROM a) AS left_rows, (SELECT count(*) FROM b) AS right_rows,
           CAST((SELECT coalesce(sum(copies), 0) FROM d WHERE side = 'left_only') AS BIGINT) AS left_only_rows,
           CAST((SELECT coalesce(sum(copies), 0) FROM d WHERE side = 'right_only') AS BIGINT) AS right_only_rows,
           5 AS left_columns, 5 AS right_columns, (SELECT count(*) FROM d) = 0 AS identical
    """.replace("WITH d AS (", f"WITH a AS ({Q1_SQL.format(75)}), b AS ({Q1_SQL.format(80)}), d AS (", 1),
)
def diff_summary_query(spark, sf_dir):
    """Counts of both sides and of the differing rows."""
    return diff_summary(_events(spark, sf_dir, 75.0), _events(spark, sf_dir, 80.0))


@query("diff_sample", DIFF_SQL + " ORDER BY side, event_id LIMIT 10")
def diff_sample_query(spark, sf_dir):
    """The first ten differing rows."""
    return diff_sample(_events(spark, sf_dir, 75.0), _events(spark, sf_dir, 80.0), 10)


PAIRS_SQL = f"""
    WITH n AS (
        SELECT event_type, CAST(hour(ts) AS INTEGER) AS hour, {EVENT_CLIENT_SQL} AS client_id, count(*) AS n
        FROM events GROUP BY ALL),
    keys AS (SELECT DISTINCT event_type, hour FROM n),
    pairs AS (
        SELECT * FROM (VALUES ('client_0', 'client_1'), ('client_0', 'client_2'), ('client_1', 'client_2'))
            AS p(left_client, right_client)),
    compared AS (
        SELECT k.event_type, k.hour, p.left_client, p.right_client,
               coalesce(a.n, 0) AS left_copies, coalesce(b.n, 0) AS right_copies
        FROM keys k, pairs p
        LEFT JOIN n a ON a.event_type = k.event_type AND a.hour = k.hour AND a.client_id = p.left_client
        LEFT JOIN n b ON b.event_type = k.event_type AND b.hour = k.hour AND b.client_id = p.right_client)
"""
THREE_CLIENTS = ["client_0", "client_1", "client_2"]
VERDICTS_SQL = (
    PAIRS_SQL
    + """, verdicts AS (
        SELECT left_client, right_client, CAST(sum(left_copies) AS BIGINT) AS left_rows,
               CAST(sum(right_copies) AS BIGINT) AS right_rows,
               CAST(sum(abs(left_copies - right_copies)) AS BIGINT) AS differing_rows,
               sum(abs(left_copies - right_copies)) = 0 AS identical
        FROM compared GROUP BY ALL)
"""
)


def _client_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        event_client().alias(CLIENT), "event_type", F.hour("ts").alias("hour")
    )


@query("pairwise_diff", PAIRS_SQL + "SELECT * FROM compared WHERE left_copies <> right_copies")
def pairwise_diff_query(spark, sf_dir):
    """Rows three clients hold a different number of times."""
    return pairwise_diff(_client_rows(spark, sf_dir), THREE_CLIENTS)


@query("pairwise_verdicts", VERDICTS_SQL + "SELECT * FROM verdicts")
def pairwise_verdicts_query(spark, sf_dir):
    """One line per pair."""
    return pairwise_verdicts(_client_rows(spark, sf_dir), THREE_CLIENTS)


@query(
    "agreement",
    VERDICTS_SQL + "SELECT count(*) AS comparisons, bool_and(identical) AS all_identical FROM verdicts",
)
def agreement_query(spark, sf_dir):
    """The closing line of the report."""
    return agreement(pairwise_verdicts(_client_rows(spark, sf_dir), THREE_CLIENTS))


@query(
    "diff_sample_pairs",
    PAIRS_SQL
    + """, differing AS (SELECT * FROM compared WHERE left_copies <> right_copies)
    SELECT left_client, right_client, CAST(place AS INTEGER) AS place, event_type, hour, left_copies, right_copies,
           greatest(total - 10, 0) AS remaining
    FROM (SELECT *, count(*) OVER (PARTITION BY left_client, right_client) AS total,
                 row_number() OVER (PARTITION BY left_client, right_client ORDER BY event_type, hour) AS place FROM differing)
    WHERE place <= 10""",
)
def diff_sample_pairs_query(spark, sf_dir):
    """The first ten differing rows of each pair, and how many more there are."""
    return diff_sample_pairs(_client_rows(spark, sf_dir), THREE_CLIENTS, 10)


USER_BAGS_SQL = """
    WITH n AS (SELECT event_type, CAST(hour(ts) AS INTEGER) AS hour, CAST(user_id % 50 AS VARCHAR) AS client_id, count(*) AS n FROM events GROUP BY ALL),
    clients AS (SELECT CAST(r.range AS VARCHAR) AS client_id, CAST(coalesce(sum(n), 0) AS BIGINT) AS held
                FROM range(50) r LEFT JOIN n ON client_id = CAST(r.range AS VARCHAR) GROUP BY r.range),
    pairs AS (SELECT a.client_id AS left_client, b.client_id AS right_client, a.held AS left_rows, b.held AS right_rows
              FROM clients a JOIN clients b ON CAST(a.client_id AS INTEGER) < CAST(b.client_id AS INTEGER)),
    shared AS (SELECT a.client_id AS left_client, b.client_id AS right_client, CAST(sum(least(a.n, b.n)) AS BIGINT) AS both_hold
               FROM n a JOIN n b ON a.event_type = b.event_type AND a.hour = b.hour GROUP BY ALL)
    SELECT left_client, right_client, left_rows, right_rows,
           left_rows + right_rows - 2 * coalesce(both_hold, 0) AS differing_rows,
           left_rows + right_rows - 2 * coalesce(both_hold, 0) = 0 AS identical
    FROM pairs LEFT JOIN shared USING (left_client, right_client)"""


@query("pairwise_many", USER_BAGS_SQL)
def pairwise_many(spark, sf_dir):
    """Fifty unlike clients, all pairs of them."""
    rows = table(spark, sf_dir, "events").select(
        (F.col("user_id") % 50).cast("string").alias(CLIENT), "event_type", F.hour("ts").alias("hour")
    )
    return pairwise_verdicts(rows, [str(c) for c in range(50)])


@query("preview", Q1_SQL.format(75) + " ORDER BY value DESC, event_id LIMIT 5")
def preview_query(spark, sf_dir):
    """The five most valuable rows of Q1."""
    return preview(_events(spark, sf_dir), [F.col("value").desc(), "event_id"], 5)
