from __future__ import annotations

from datetime import timedelta

from cartwheel.operators import commerce
from cartwheel.plans.checkout import checkout
from cartwheel.schemas import PRODUCTS
from conftest import at, rows

CART = "user_id bigint, product_id string, quantity int, added_at timestamp"
T0 = at("2024-01-01 10:00")


def cart(spark, *lines):
    return spark.createDataFrame([(u, p, q, T0 + timedelta(minutes=m)) for u, p, q, m in lines], CART)


def catalog(spark, *lines):
    return spark.createDataFrame([(p, p.lower(), price, 0, stock) for p, price, stock in lines], PRODUCTS)


def test_adding_merges_quantities(spark):
    have = cart(spark, (999001, "TEST001", 1, 0))
    adds = cart(spark, (999001, "TEST001", 2, 5), (999001, "OTHER", 1, 6))
    assert rows(commerce.cart_add(have, adds)) == [
        (999001, "OTHER", 1, T0 + timedelta(minutes=6)), (999001, "TEST001", 3, T0)]


def test_default_quantity_is_one(spark):
    adds = cart(spark, (1, "A", 9, 0)).drop("quantity")
    assert rows(commerce.cart_add(cart(spark), adds))[0][2] == 1


def test_unknown_products(spark):
    lines = cart(spark, (1, "TEST001", 1, 0), (1, "NO_SUCH_PRODUCT", 1, 0))
    known = catalog(spark, ("TEST001", 9.99, 0))
    assert [r.product_id for r in commerce.known_products(lines, known).collect()] == ["TEST001"]
    assert [r.product_id for r in commerce.unknown_products(lines, known).collect()] == ["NO_SUCH_PRODUCT"]


def test_removal_and_what_was_not_there(spark):
    have = cart(spark, (1, "A", 1, 0), (2, "A", 1, 0))
    keys = cart(spark, (1, "A", 1, 0), (1, "B", 1, 0)).select("user_id", "product_id")
    assert [r.user_id for r in commerce.cart_remove(have, keys).collect()] == [2]
    assert rows(commerce.not_in_cart(have, keys)) == [(1, "B")]
    assert [r.user_id for r in commerce.user_cart(have, 2).collect()] == [2]


def test_checkout_of_one_cart(spark):
    out = checkout(cart(spark, (999001, "TEST001", 2, 0)), catalog(spark, ("TEST001", 9.99, 10)), T0)
    assert rows(out.totals) == [(999001, 1, 19.98)]
    assert rows(out.events) == [(999001, "purchase", "TEST001", 9.99, T0)] * 2
    assert rows(out.cart) == []
    assert rows(out.products) == [("TEST001", "test001", 9.99, 2, 8)]


def test_checkout_without_stock_is_refused_whole(spark):
    lines = cart(spark, (1, "A", 1, 0), (1, "B", 2, 0), (2, "A", 1, 0))
    out = checkout(lines, catalog(spark, ("A", 1.0, 5), ("B", 1.0, 1)), T0)
    assert rows(out.totals) == [(2, 1, 1.0)]
    assert rows(out.shortages)[0][:3] == ("B", 1, 2)
    assert {r.user_id for r in out.cart.collect()} == {1}
    assert {r.product_id: r.stock for r in out.products.collect()} == {"A": 4, "B": 1}


def test_unknown_product_voids_the_order(spark):
    out = checkout(cart(spark, (1, "A", 1, 0), (1, "GONE", 1, 0)), catalog(spark, ("A", 1.0, 5)), T0)
    assert out.events.count() == 0 and out.cart.count() == 2


def test_contenders_are_returned_undecided(spark):
    lines = cart(spark, (1, "A", 3, 0), (2, "A", 3, 1), (3, "B", 1, 2), (2, "B", 1, 1))
    known = catalog(spark, ("A", 1.0, 5), ("B", 1.0, 5))
    out = checkout(lines, known, T0)
    assert {r.user_id for r in out.contested.collect()} == {1, 2}
    assert [r.user_id for r in out.totals.collect()] == [3]
    assert min(r.stock for r in out.products.collect()) >= 0
    assert rows(commerce.oversell_report(lines, known)) == [("A", 6, 2, 5, 1)]


def test_first_line_over_the_stock(spark):
    lines = cart(spark, *[(u, "A", 2, u) for u in range(1, 6)], (9, "B", 1, 0))
    out = commerce.running_demand(lines, catalog(spark, ("A", 1.0, 5), ("B", 1.0, 5)))
    assert sorted((r.user_id, r.demand_so_far, r.over_stock, r.first_over) for r in out.collect()) == [
        (1, 2, False, False), (2, 4, False, False), (3, 6, True, True), (4, 8, True, False),
        (5, 10, True, False)]


def test_missing_product_counts_as_free(spark):
    priced = commerce.price_cart(cart(spark, (1, "A", 2, 0), (1, "X", 3, 0)), catalog(spark, ("A", 1.5, 0)))
    assert rows(commerce.order_totals(priced)) == [(1, 2, 3.0)]


def test_the_join_on_a_hot_product_is_split(spark):
    """Neither side small enough to broadcast, half of the lines on one product."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
                "spark.sql.adaptive.coalescePartitions.enabled": "false",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    before = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        lines = spark.range(0, 60000, 1, 12).selectExpr(
            "id AS user_id", "IF(id % 2 = 0, 'HOT', concat('P', id % 500)) AS product_id",
            "CAST(1 AS INT) AS quantity", "timestamp_seconds(id) AS added_at")
        known = spark.range(500).selectExpr(
            "IF(id = 0, 'HOT', concat('P', id)) AS product_id", "'x' AS description",
            "CAST(1 AS DOUBLE) AS price", "0 AS total_purchase_count", "9 AS stock")
        out = commerce.price_cart(lines, known)
        assert len(out.collect()) == 60000
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
