"""Product and user dimensions, and their upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cartwheel.functions.draws import whole
from cartwheel.functions.money import to_step
from cartwheel.schemas import SEED, STOCK_LEAST, STOCK_NOISE, STOCK_SHARE


def build_products(cleaned: DataFrame) -> DataFrame:
    """Per stock code: most frequent description, rounded median price, number of lines.

    Equal (code, description) and equal (code, price) lines are counted in the map tasks,
    both in one pass, so a code that holds much of the data reaches the last step as counted
    rows. Prices are whole thousands, hence few per code, which bounds the median's state.
    Of descriptions equally frequent the smallest is taken.
    """
    sets = [["stock_code", "description"], ["stock_code", "unit_price"]]
    counted = (cleaned.filter(F.col("stock_code").isNotNull())
               .groupingSets(sets, "stock_code", "description", "unit_price")
               .agg(F.count(F.lit(1)).alias("n"), F.grouping("unit_price").alias("of_text")))
    votes = F.when(F.col("of_text") == 1, F.struct(-F.col("n"), F.col("description")))
    priced = F.when(F.col("of_text") == 0, F.col("n"))
    return counted.groupBy(F.col("stock_code").alias("product_id")).agg(
        F.min_by("description", votes).alias("description"),
        to_step(F.percentile("unit_price", 0.5, F.col("n"))).cast("double").alias("price"),
        F.sum(priced).cast("long").alias("total_purchase_count"))


def assign_stock(products: DataFrame, seed: int = SEED) -> DataFrame:
    """Stock in proportion to past lines, plus seeded noise of -3 to 9, never negative."""
    base = F.greatest(F.col("total_purchase_count") * STOCK_SHARE, F.lit(STOCK_LEAST)).cast("long")
    noise = whole([F.col("product_id")], "stock", *STOCK_NOISE, seed)
    return products.withColumn("stock", F.greatest(base + noise, F.lit(0)))


def build_users(cleaned: DataFrame) -> DataFrame:
    """Per member: usual country, first and last purchase."""
    counted = (cleaned.filter(F.col("customer_id").isNotNull())
               .groupBy(F.col("customer_id").cast("long").alias("user_id"), "country")
               .agg(F.count(F.lit(1)).alias("n"),
                    F.min("invoice_date").alias("first"), F.max("invoice_date").alias("last")))
    # a line without a country does not vote; a member with none keeps a null country
    votes = F.when(F.col("country").isNotNull(), F.struct(-F.col("n"), F.col("country")))
    return counted.groupBy("user_id").agg(
        F.min_by("country", votes).alias("country"),
        F.min("first").alias("first_purchase_at"),
        F.max("last").alias("last_purchase_at"))


def purchase_weights(products: DataFrame) -> DataFrame:
    """Share of each product in all purchase lines."""
    total = products.select(F.sum("total_purchase_count")).scalar()
    return products.select("product_id",
                           (F.col("total_purchase_count") / total).alias("weight"))


def _upsert(current: DataFrame, new: DataFrame, key: str, columns: dict[str, str]) -> DataFrame:
    """Full outer join on ``key``; ``columns`` tells which side wins where both have the row."""
    cur, inc = current.alias("cur"), new.alias("new")
    both = cur.join(inc, F.col(f"cur.{key}") == F.col(f"new.{key}"), "full_outer")
    arrived = F.col(f"new.{key}").isNotNull()
    held = F.col(f"cur.{key}").isNotNull()

    def merged(name: str, winner: str):
        wins, other, present = (("new", "cur", arrived) if winner == "new"
                                else ("cur", "new", held))
        return (F.when(present, F.col(f"{wins}.{name}"))
                .otherwise(F.col(f"{other}.{name}")).alias(name))

    return both.select(F.coalesce(f"cur.{key}", f"new.{key}").alias(key),
                       *[merged(n, w) for n, w in columns.items()])


def upsert_products(current: DataFrame, new: DataFrame) -> DataFrame:
    """New description, price and count; stock of a known product is left alone."""
    return _upsert(current, new, "product_id",
                   {"description": "new", "price": "new", "total_purchase_count": "new",
                    "stock": "cur"})


def upsert_users(current: DataFrame, new: DataFrame) -> DataFrame:
    return _upsert(current, new, "user_id",
                   {"country": "new", "first_purchase_at": "new", "last_purchase_at": "new"})
