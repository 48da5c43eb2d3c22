"""The given tables in the shape of the engine's datasets.

Orders and events stand in for transactions, line items for transaction items, parts
for the menu, customers for users. Stores are nations or event types. Orders and
line items have no time of day, so questions about hours use events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmetrics.params import Params
from tillmetrics.schemas import CLIENT

#: The years 1996 and 1997 of orders and line items stand in for 2024 and 2025.
ORDER_PARAMS = Params(
    years=(1996, 1997), start_hour=0, end_hour=23, min_amount=250000.0, semesters=("1996-1", "1997-1")
)
ALL_SEMESTERS = Params(
    years=(1996, 1997), start_hour=0, end_hour=23, semesters=("1996-1", "1996-2", "1997-1", "1997-2")
)
EVENT_PARAMS = Params()

ONE_CLIENT = "client_1"

#: Column types of the given tables; stating them saves a job per read that would infer them.
SCHEMAS = {
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
        "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
        "l_shipdate TIMESTAMP_NTZ"
    ),
    "part": (
        "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE"
    ),
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "events": (
        "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
    ),
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def event_client() -> Column:
    """Three stand-in clients."""
    return F.concat(F.lit("client_"), (F.col("user_id") % 3).cast("string"))


def event_store() -> Column:
    """Ten numbered stores, where a file format asks for a number."""
    return (F.col("user_id") % 10).cast("int")


def events_as_transactions(
    events: DataFrame, client: Column | None = None, store: Column | None = None
) -> DataFrame:
    return events.select(
        (F.lit(ONE_CLIENT) if client is None else client).alias(CLIENT),
        F.col("event_id").alias("transaction_id"),
        (F.col("event_type") if store is None else store).alias("store_id"),
        F.lit(1).alias("payment_method_id"),
        F.lit(None).cast("int").alias("voucher_id"),
        "user_id",
        F.col("value").alias("original_amount"),
        F.lit(0.0).alias("discount_applied"),
        F.col("value").alias("final_amount"),
        F.col("ts").alias("created_at"),
    )


def orders_as_transactions(spark: SparkSession, sf_dir: str, client: Column | None = None) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    stores = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    return orders.join(stores, "o_custkey").select(
        (F.lit(ONE_CLIENT) if client is None else client).alias(CLIENT),
        F.col("o_orderkey").alias("transaction_id"),
        F.col("c_nationkey").alias("store_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_totalprice").alias("final_amount"),
        F.col("o_orderdate").alias("created_at"),
    )


def lineitem_as_items(spark: SparkSession, sf_dir: str, client: Column | None = None) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        (F.lit(ONE_CLIENT) if client is None else client).alias(CLIENT),
        F.col("l_orderkey").alias("transaction_id"),
        F.col("l_partkey").alias("item_id"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("subtotal"),
        F.col("l_shipdate").alias("created_at"),
    )


def part_as_menu(spark: SparkSession, sf_dir: str, client: Column | None = None) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        (F.lit(ONE_CLIENT) if client is None else client).alias(CLIENT),
        F.col("p_partkey").alias("item_id"),
        F.col("p_name").alias("item_name"),
    )


def customer_as_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers have no birthdate; the name stands in for it."""
    return table(spark, sf_dir, "customer").select(
        F.lit(ONE_CLIENT).alias(CLIENT),
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("birthdate"),
    )
