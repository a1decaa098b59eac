"""Draws are checked by what must hold for any draw, and by their frequencies."""

from __future__ import annotations

from collections import Counter
from datetime import timedelta

from pyspark.sql import functions as F

from cartwheel.operators import synthesis
from cartwheel.operators.dimensions import purchase_weights
from cartwheel.plans import loading, preparation
from cartwheel.schemas import INVOICE_CSV, PRODUCTS, TRANSACTIONS, USERS
from cartwheel.sinks.files import write_csv
from cartwheel.sinks.snapshots import read_snapshot
from conftest import at, rows
from test_cleaning import frame, line

T0 = at("2024-01-01 10:00:30")


def purchases(spark, n, copies=1):
    return spark.createDataFrame(
        [(str(i), i % 7, f"P{i % 5}", 1, 1000.0, T0 + timedelta(minutes=13 * i))
         for i in range(n) for _ in range(copies)], TRANSACTIONS)


def dims(spark):
    products = spark.createDataFrame([(f"P{i}", f"p{i}", 1000.0 * (i + 1), c, 5)
                                      for i, c in enumerate((600, 200, 100, 100, 0))], PRODUCTS)
    users = spark.createDataFrame([(i, "UK", None, None) for i in range(7)], USERS)
    return products, users


def test_path_order_and_distances(spark):
    bought = purchases(spark, 200)
    by_user = {}
    for r in synthesis.conversion_path(bought.withColumn("user_id", F.col("invoice_no").cast("long"))).collect():
        by_user.setdefault(r.user_id, {})[r.event_type] = r.timestamp
    for i, steps in by_user.items():
        minute = (T0 + timedelta(minutes=13 * i)).replace(second=0)
        cart = (minute - steps["add_to_cart"]).seconds // 60
        view = (steps["add_to_cart"] - steps["view"]).seconds // 60
        assert 1 <= cart <= 14 and 5 <= view <= 59
        assert steps["purchase"] == T0 + timedelta(minutes=13 * i)
    assert len(by_user) == 200
    assert len({s["add_to_cart"].minute for s in by_user.values()}) > 20


def test_funnel_ratio_is_exact_and_repeatable(spark):
    products, users = dims(spark)
    bought = purchases(spark, 60, copies=2)
    refunds = purchases(spark, 9)
    made = synthesis.synthesize_events(bought, refunds, users, products)
    assert Counter(r.event_type for r in made.collect()) == {
        "view": 1200, "add_to_cart": 360, "purchase": 120, "refund": 9}
    again = synthesis.synthesize_events(bought.repartition(3), refunds, users.repartition(2), products)
    assert rows(made) == rows(again)
    assert rows(synthesis.synthesize_events(bought, refunds, users, products, seed=7)) != rows(made)
    assert synthesis.filler_counts(120) == {"view": 1080, "add_to_cart": 240}
    assert synthesis.filler_counts(0) == {"view": 0, "add_to_cart": 0}


def test_copies_make_draws_of_their_own(spark):
    products, users = dims(spark)
    bought = purchases(spark, 1, copies=3000).withColumn("timestamp", F.lit(T0))
    made = synthesis.conversion_path(synthesis.number_copies(bought))
    carts = Counter(r.timestamp for r in made.filter("event_type = 'add_to_cart'").collect())
    assert len(carts) == 14 and sum(carts.values()) == 3000


def test_random_visits_lie_in_the_period_at_catalog_price(spark):
    products, users = dims(spark)
    bought = purchases(spark, 60)
    slots = spark.range(4000).select(F.col("id").alias("slot"), F.lit("view").alias("event_type"))
    seen = synthesis.browse_events(slots, users, products, bought).collect()
    first, last = T0, T0 + timedelta(minutes=13 * 59)
    assert len(seen) == 4000
    assert all(first <= r.timestamp < last for r in seen)
    assert all(r.price == 1000.0 * (int(r.product_id[1:]) + 1) for r in seen)
    assert set(Counter(r.user_id for r in seen)) == set(range(7))


def test_no_purchases_no_events_and_a_single_minute(spark):
    products, users = dims(spark)
    none = purchases(spark, 3).limit(0)
    assert synthesis.synthesize_events(none, none, users, products).count() == 0
    one = synthesis.synthesize_events(purchases(spark, 1), none, users, products)
    assert one.count() == 14
    assert one.filter("event_type = 'view'").agg(F.max("timestamp")).first()[0] == T0


def test_draws_follow_the_weights(spark):
    products, _ = dims(spark)
    n = 20000
    picked = synthesis.weighted_pick(spark.range(n), ["id"], products, "product_id",
                                     F.col("total_purchase_count"), "test")
    got = Counter(r.product_id for r in picked.collect())
    assert sum(got.values()) == n and "P4" not in got
    for name, share in (("P0", 0.6), ("P1", 0.2), ("P2", 0.1), ("P3", 0.1)):
        assert abs(got[name] - n * share) < 5 * (n * share * (1 - share)) ** 0.5
    assert dict(rows(purchase_weights(products)))["P0"] == 0.6


def test_intervals_cover_the_axis_without_overlap(spark):
    dim = spark.range(3000).select(F.concat(F.lit("p"), "id").alias("k"), (F.col("id") % 11).alias("w"))
    spans = sorted((r.lo, r.hi) for r in synthesis.cumulative_intervals(dim, "k", F.col("w")).collect())
    assert spans[0][0] == 0 and spans[-1][1] == sum(i % 11 for i in range(3000))
    assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))


def test_a_hot_product_is_spread_over_cells(spark):
    """The draws on one product do not meet on one join key."""
    dim = spark.range(100).select(F.col("id").alias("k"), F.when(F.col("id") == 0, 100).otherwise(1).alias("w"))
    plan = synthesis.weighted_pick(spark.range(10), ["id"], dim, "k", F.col("w"), "x")
    assert "_cell" in plan._jdf.queryExecution().analyzed().toString()
    cells = (synthesis.cumulative_intervals(dim, "k", F.col("w")).filter("k = 0")
             .select(F.floor(F.col("hi") / 2) - F.floor(F.col("lo") / 2)).first()[0])
    assert cells >= 49


def test_random_mix(spark):
    products, users = dims(spark)
    slots = spark.range(8000).withColumnRenamed("id", "slot")
    mix = synthesis.random_event_mix(slots, users, products).collect()
    kinds = Counter(r.event_type for r in mix)
    assert len(mix) == 8000 and set(kinds) == {"view", "search", "add_to_cart", "purchase"}
    for kind, share in (("view", 10 / 16), ("search", 2 / 16), ("add_to_cart", 3 / 16), ("purchase", 1 / 16)):
        assert abs(kinds[kind] - 8000 * share) < 5 * (8000 * share * (1 - share)) ** 0.5
    assert all((r.product_id is None) == (r.event_type == "search") == (r.price is None) for r in mix)


def test_replay_gaps(spark):
    log = spark.createDataFrame([(at(f"2024-01-01 00:{m}"),) for m in
                                 ("00:00", "01:00", "01:00", "01:30", "59:00")], "timestamp timestamp")
    gaps = [(r.events, r.wait_seconds) for r in synthesis.replay_gaps(log).orderBy("timestamp").collect()]
    assert gaps == [(1, 0.0), (2, 1.0), (1, 0.5), (1, 5.0)]
    assert {r.wait_seconds for r in synthesis.replay_gaps(log, speed=0).collect()} == {0.0}


def test_files_in_files_out_and_load(spark, tmp_path):
    source, target, tables = (str(tmp_path / n) for n in ("in", "out", "tables"))
    lines = [line(invoice=str(i), code=f"K{i % 4}", quantity=-1 if i % 5 == 0 else 2,
                  when=f"1/{1 + i % 28}/2011 9:0{i % 10}", customer=float(i % 6) if i % 7 else None)
             for i in range(40)]
    df = frame(spark, *lines, line(when="x"))
    write_csv(df.toDF(*INVOICE_CSV.names), source)
    made = preparation.prepare_files(spark, source, target)
    read = {n: spark.read.option("header", True).csv(f"{target}/{n}").count()
            for n in ("products", "users", "purchases", "refunds", "events")}
    n = made.purchases.count()
    assert read == {"products": 4, "users": 6, "purchases": n, "refunds": made.refunds.count(),
                    "events": 14 * n + made.refunds.count()}
    for _ in range(2):   # loading the same dataset again changes nothing
        loading.load_dimensions(spark, target, tables, "day-1")
    assert read_snapshot(spark, f"{tables}/products", PRODUCTS).count() == 4
    assert read_snapshot(spark, f"{tables}/users", USERS).count() == 6
