"""Carts, checkout and inventory in bulk.

``owner`` is the column that says whose cart a line belongs to: the user, or an order where
one user has several.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cartwheel.functions.times import Instant, instant
from cartwheel.operators.ordering import running_total
from cartwheel.operators.rows import repeat_rows


def with_parent(df: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    return df.join(parent.select(key), key, "left_semi")


def orphans(df: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows whose ``key`` names no row of ``parent``: broken references."""
    return df.join(parent.select(key), key, "left_anti")


def known_products(df: DataFrame, products: DataFrame) -> DataFrame:
    return with_parent(df, products, "product_id")


def unknown_products(df: DataFrame, products: DataFrame) -> DataFrame:
    return orphans(df, products, "product_id")


def user_cart(cart: DataFrame, user_id: int) -> DataFrame:
    return cart.filter(F.col("user_id") == user_id)


def merge_lines(lines: DataFrame, owner: str = "user_id") -> DataFrame:
    """One line per owner and product: quantities add up, the first time added stays."""
    extra = [F.min(c).alias(c) for c in lines.columns
             if c not in (owner, "product_id", "quantity", "added_at")]
    merged = lines.groupBy(owner, "product_id").agg(
        F.sum("quantity").alias("quantity"), F.min("added_at").alias("added_at"), *extra)
    return merged.select(*lines.columns)


def cart_add(cart: DataFrame, adds: DataFrame, owner: str = "user_id") -> DataFrame:
    """Cart after the additions; a product already there gets a higher quantity."""
    quantity = F.coalesce("quantity", F.lit(1)) if "quantity" in adds.columns else F.lit(1)
    return merge_lines(
        cart.unionByName(adds.withColumn("quantity", quantity), allowMissingColumns=True), owner)


def cart_remove(cart: DataFrame, keys: DataFrame, owner: str = "user_id") -> DataFrame:
    return cart.join(keys.select(owner, "product_id"), [owner, "product_id"], "left_anti")


def not_in_cart(cart: DataFrame, keys: DataFrame, owner: str = "user_id") -> DataFrame:
    """Removals that name no line of the cart."""
    return keys.join(cart.select(owner, "product_id"), [owner, "product_id"], "left_anti")


def price_cart(cart: DataFrame, products: DataFrame) -> DataFrame:
    """Lines with catalog price and total; a missing product counts as price 0."""
    return (cart.join(products.select("product_id", "price"), "product_id", "left")
            .withColumn("price", F.coalesce("price", F.lit(0.0)))
            .withColumn("line_total", F.col("price") * F.col("quantity")))


def order_totals(priced: DataFrame, owner: str = "user_id") -> DataFrame:
    """Number of lines (not units) and sum per owner."""
    return priced.groupBy(owner).agg(
        F.count(F.lit(1)).alias("purchased_items"),
        F.bround(F.sum(F.col("price") * F.col("quantity")), 2).alias("total_price"))


def with_catalog(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Lines with ``stock`` and ``price`` of their product, null where it is unknown."""
    return lines.join(products.select("product_id", "stock", "price"), "product_id", "left").select(*lines.columns, "stock", "price")


def is_short() -> Column:
    """Whether a line ``with_catalog`` wants what is unknown, or more than there is."""
    return F.col("stock").isNull() | (F.col("stock") < F.col("quantity"))


def wants_oversold(known: DataFrame, owner: str = "user_id") -> DataFrame:
    """Owners with a line, of lines ``with_catalog``, of which all together want more than there is."""
    oversold = (known.groupBy("product_id").agg(F.sum("quantity").alias("_demand"), F.max("stock").alias("_stock"))
                .filter("_demand > _stock").select("product_id"))
    return known.join(oversold, "product_id", "left_semi").select(owner).distinct()


def stock_shortages(cart: DataFrame, products: DataFrame) -> DataFrame:
    """Lines whose product is unknown or has less stock than asked for."""
    return (cart.join(products.select("product_id", "stock"), "product_id", "left")
            .filter(F.col("stock").isNull() | (F.col("stock") < F.col("quantity"))))


def order_verdicts(cart: DataFrame, products: DataFrame, owner: str = "user_id") -> DataFrame:
    """Per owner: lines, lines short of stock, and whether the order stands."""
    short = F.col("stock").isNull() | (F.col("stock") < F.col("quantity"))
    return (cart.join(products.select("product_id", "stock"), "product_id", "left")
            .groupBy(owner)
            .agg(F.count(F.lit(1)).alias("lines"), F.count_if(short).alias("short_lines"))
            .withColumn("admissible", F.col("short_lines") == 0))


def admissible_orders(cart: DataFrame, products: DataFrame, owner: str = "user_id") -> DataFrame:
    """Lines of the orders with no shortage, each order judged alone."""
    refused = stock_shortages(cart, products).select(owner).distinct()
    return cart.join(refused, owner, "left_anti")


def oversell_report(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Products whose combined demand exceeds the stock."""
    demand = lines.groupBy("product_id").agg(F.sum("quantity").alias("demand"),
                                             F.count(F.lit(1)).alias("lines"))
    return (demand.join(products.select("product_id", "stock"), "product_id")
            .filter(F.col("demand") > F.col("stock"))
            .withColumn("excess", F.col("demand") - F.col("stock")))


def running_demand(lines: DataFrame, products: DataFrame, owner: str = "user_id") -> DataFrame:
    """Oversold products' lines by arrival, with demand so far. Runs a job.

    ``first_over`` marks the line with which demand passes the stock. ``lines`` must hold one
    line per owner and product. Lines of products with stock enough are not ordered at all.
    """
    short = oversell_report(lines, products).select("product_id", "stock")
    wanted = (lines.select(owner, "product_id", "quantity", "added_at")
              .join(short, "product_id"))
    summed = running_total(wanted, ["added_at", owner], "quantity", "demand_so_far",
                           keys=["product_id"])
    over = F.col("demand_so_far") > F.col("stock")
    return (summed.withColumn("over_stock", over)
            .withColumn("first_over",
                        over & (F.col("demand_so_far") - F.col("quantity") <= F.col("stock"))))


def split_contested(lines: DataFrame, products: DataFrame,
                    owner: str = "user_id") -> tuple[DataFrame, DataFrame]:
    """(uncontested, contested) orders: the contested ones want an oversold product."""
    oversold = oversell_report(lines, products).select("product_id")
    contested = lines.join(oversold, "product_id", "left_semi").select(owner).distinct()
    return lines.join(contested, owner, "left_anti"), lines.join(contested, owner, "left_semi")


def checkout_events(lines: DataFrame, products: DataFrame, at: Instant = None) -> DataFrame:
    """One purchase event per unit, at catalog price and one common time."""
    return unit_events(lines.join(products.select("product_id", "price"), "product_id"), at)


def unit_events(priced: DataFrame, at: Instant = None) -> DataFrame:
    """The same of lines that have their ``price``."""
    units = repeat_rows(priced.select("user_id", "product_id", "price", "quantity"),
                        "quantity", "unit")
    return units.select("user_id", F.lit("purchase").alias("event_type"), "product_id", "price",
                        instant(at).alias("timestamp"))


def apply_stock(products: DataFrame, sold: DataFrame) -> DataFrame:
    """Catalog after the sale: units leave the stock and add to the count."""
    units = sold.groupBy("product_id").agg(F.sum("quantity").alias("_units"))
    gone = F.coalesce("_units", F.lit(0))
    return (products.join(units, "product_id", "left")
            .withColumn("stock", (F.col("stock") - gone).cast("long"))
            .withColumn("total_purchase_count",
                        (F.coalesce("total_purchase_count", F.lit(0)) + gone).cast("long"))
            .select(*products.columns))


def clear_carts(cart: DataFrame, bought: DataFrame, owner: str = "user_id") -> DataFrame:
    return cart.join(bought.select(owner, "product_id"), [owner, "product_id"], "left_anti")
