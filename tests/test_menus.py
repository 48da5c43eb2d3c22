"""Menus that are larger than the answer."""

from pyspark.sql import functions as F

from tests.conftest import plan, rows
from tillmetrics.plans import rank_items


def test_a_menu_meets_the_leaders_before_it_is_joined(spark):
    """Only leading items get into the joins with the answer."""
    columns = "client_id string, year int, month int, item_id bigint, sold_count bigint, total_cents bigint"
    totals = spark.createDataFrame([("c", 2024, 1, 5, 3, 100), ("c", 2024, 1, 6, 2, 300), ("d", 2024, 1, None, 1, 9)], columns)
    clients = F.explode(F.array(F.lit("c"), F.lit("d"), F.lit(None))).alias("client_id")
    menu = spark.range(1000).select(clients, F.col("id").alias("item_id"), F.concat(F.lit("n"), "id").alias("item_name"))
    ranked, names = rank_items(totals, menu), ["client_id", "top_count_item_name", "top_sum_item_name"]
    assert rows(ranked, *names) == [("c", "n5", "n6"), ("d", "Unknown", "Unknown")]
    assert "LeftSemi" in plan(ranked)
    assert rows(rank_items(totals, menu.withColumn("arrival", F.lit(1))), *names) == rows(ranked, *names)
