"""What a query may ask of the driver and of one task, whatever the size of its tables."""

from __future__ import annotations

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cartwheel.operators import metrics
from cartwheel.operators.synthesis import weighted_pick
from cartwheel.registry import QUERIES
from cartwheel.sources.files import _number


@pytest.fixture(scope="module")
def many_orders(spark, tmp_path_factory):
    """Half a million orders in order of their key take few bytes on disk, fewer than the lines."""
    folder = str(tmp_path_factory.mktemp("many-orders"))
    for name in ("part", "customer", "nation", "lineitem"):
        Path(f"{folder}/{name}.parquet").symlink_to(f"/root/testdata/sf0.1/{name}.parquet")
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").limit(1).select("o_custkey", "o_orderdate")
    spark.range(0, 500_000, 1, 1).withColumnRenamed("id", "o_orderkey").join(F.broadcast(orders)).write.parquet(
        f"{folder}/orders.parquet")
    return folder


@pytest.mark.parametrize("name", ["broken_cart_constraints", "broken_constraints", "cart_removals_not_found",
                                  "repeated_order_keys"])
def test_orders_are_not_broadcast(spark, many_orders, name):
    plan = QUERIES[name](spark, many_orders)._jdf.queryExecution().sparkPlan().toString()
    assert re.search(r"Join \[l_orderkey", plan) and not re.search(r"Broadcast\w+ \[l_orderkey.*BuildRight", plan)


def test_users_of_many_minutes_are_near(spark):
    """Of very many minutes with four users each, none may lose two of them."""
    events = spark.range(400_000).select(
        F.col("id").alias("user_id"), F.lit("view").alias("event_type"), F.lit(1.0).alias("price"),
        F.timestamp_seconds(F.floor(F.col("id") / 4) * 60).alias("event_time"))
    guess = metrics.traffic_stats(events)
    assert guess.count() == 100_000
    assert guess.filter(F.abs(F.col("unique_users") - 4) > 1 + 0.2 * 4).count() == 0


def test_segments_follow_the_rows(spark):
    """Four partitions are named by the session; a task still gets its share of bytes only."""
    from cartwheel.operators.ordering import ordered_segments
    placed = ordered_segments(spark.range(3_000_000).withColumn("text", F.sha2(F.col("id").cast("string"), 256)), ["id"])
    assert placed.select("segment").distinct().count() > 8


def test_numbers_without_a_digit(spark):
    texts = ["six", "6.0", " 7 ", "1e2", "6.5", "NaN", "Infinity", "", None]
    found = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string").select(
        "i", _number(F.col("text"), "int").alias("n")).orderBy("i").collect()
    assert [r["n"] for r in found] == [None, 6, 7, 100, None, None, None, None, None]


def test_csv_is_read_once(spark):
    df = QUERIES["invoice_csv_rejected"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Scan csv") == 1 or plan.count("FileScan csv") == 1


def test_rows_that_draw_are_not_sorted_and_draws_not_shuffled(spark):
    """Rows that draw may be far more than what is drawn: only they go to its cells, as they came."""
    dim = spark.range(100).select(F.col("id").alias("k"), F.lit(1).alias("w"))
    plan = weighted_pick(spark.range(10), ["id"], dim, "k", F.col("w"), "x")._jdf.queryExecution().sparkPlan().toString()
    pick = next(line for line in plan.splitlines() if "Join" in line)
    assert "ShuffledHashJoin" in pick and "BuildRight" in pick
    assert "_at" not in plan
