from __future__ import annotations

from pyspark.sql import functions as F

from cartwheel.operators import dimensions, quality
from cartwheel.schemas import CART_ITEMS, PRODUCTS, USERS
from conftest import at, rows

CLEANED = ("invoice_no string, stock_code string, description string, quantity int, "
           "invoice_date timestamp, unit_price int, customer_id bigint, country string")


def cleaned(spark, *lines):
    """(code, description, price, customer, country, day)"""
    return spark.createDataFrame(
        [("1", c, d, 1, at(f"2011-01-{day:02d}"), p, u, k) for c, d, p, u, k, day in lines], CLEANED)


def test_products_mode_median_count(spark):
    df = cleaned(spark, ("A", "mug", 1000, 1, "UK", 1), ("A", "cup", 2000, 1, "UK", 1),
                 ("B", "plate", 3000, 1, "UK", 1), ("B", "plate", 4000, 1, "UK", 1),
                 ("B", "dish", 9000, 1, "UK", 1), (None, "gone", 1000, 1, "UK", 1))
    # A: tied descriptions, smallest; median 1500 -> 2000 (even)
    assert rows(dimensions.build_products(df)) == [("A", "cup", 2000.0, 2), ("B", "plate", 4000.0, 3)]


def test_users_mode_and_dates(spark):
    df = cleaned(spark, ("A", "m", 1, 7, "UK", 5), ("A", "m", 1, 7, "France", 2),
                 ("A", "m", 1, 7, "France", 9), ("A", "m", 1, 8, "UK", 1), ("A", "m", 1, 8, "EIRE", 1),
                 ("A", "m", 1, 9, None, 3), ("A", "m", 1, None, "UK", 3))
    assert rows(dimensions.build_users(df)) == [
        (7, "France", at("2011-01-02"), at("2011-01-09")),
        (8, "EIRE", at("2011-01-01"), at("2011-01-01")),
        (9, None, at("2011-01-03"), at("2011-01-03"))]


def test_stock_bounds_and_placement_independence(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("product_id"),
                                 F.col("id").cast("int").alias("total_purchase_count"))
    one = rows(dimensions.assign_stock(df.repartition(7)))
    two = rows(dimensions.assign_stock(df.coalesce(1)))
    assert one == two
    for _, count, stock in one:
        base = int(max(0.3 * count, 5))
        assert max(0, base - 3) <= stock <= base + 9
    assert len({stock - int(max(0.3 * count, 5)) for _, count, stock in one}) == 13
    assert rows(dimensions.assign_stock(df, seed=1)) != one


def test_upsert_products_keeps_stock(spark):
    cur = spark.createDataFrame([("A", "old", 1.0, 5, 70), ("B", "stays", 2.0, 1, 3)], PRODUCTS)
    new = spark.createDataFrame([("A", "new", 9.0, 6, 11), ("C", "fresh", 4.0, 2, 8)], PRODUCTS)
    assert rows(dimensions.upsert_products(cur, new)) == [
        ("A", "new", 9.0, 6, 70), ("B", "stays", 2.0, 1, 3), ("C", "fresh", 4.0, 2, 8)]


def test_upsert_users_overwrites_even_with_null(spark):
    day = at("2011-01-01")
    cur = spark.createDataFrame([(1, "UK", day, day), (2, "FR", day, day)], USERS)
    new = spark.createDataFrame([(1, None, None, day), (3, "DE", day, day)], USERS)
    assert rows(dimensions.upsert_users(cur, new)) == [
        (1, None, None, day), (2, "FR", day, day), (3, "DE", day, day)]


def test_constraints(spark):
    df = spark.createDataFrame([("A", "x", 1.0, 0, -1), ("A", None, 1.0, 0, 1), ("B", "x", None, 0, 0)],
                               PRODUCTS)
    assert dict(rows(quality.check_constraints(df, "products"))) == {
        "stock below 0": 1, "description missing": 1, "price missing": 1, "product_id not unique": 2}
    fine = spark.createDataFrame([("A", "x", 1.0, 0, 0)], PRODUCTS)
    assert rows(quality.check_constraints(fine, "products")) == []


def test_broken_rows_are_shown(spark):
    cart = spark.createDataFrame([(1, 1, "A", 2, None), (2, 9, "A", None, None), (2, None, "Z", 1, None)], CART_ITEMS)
    users = spark.createDataFrame([(1,)], "user_id long")
    products = spark.createDataFrame([("A",)], "product_id string")
    got = sorted((r.violation, r.id, r.product_id) for r in quality.broken_rows(
        cart, "cart_items", {"users": users, "products": products}).collect())
    assert got == [("id not unique", 2, "A"), ("id not unique", 2, "Z"), ("product_id unknown", 2, "Z"),
                   ("quantity missing", 2, "A"), ("user_id missing", 2, "Z"), ("user_id unknown", 2, "A")]
