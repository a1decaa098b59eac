"""Invoice lines to cleaned, priced lines; purchases and refunds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from cartwheel.functions.money import gbp_to_krw
from cartwheel.functions.text import normal_code, stripped
from cartwheel.functions.times import parse_invoice_date
from cartwheel.schemas import NON_PRODUCT_CODES


def is_product_code(code: Column) -> Column:
    return ~normal_code(code).isin(*NON_PRODUCT_CODES)


def parse_dates(df: DataFrame) -> DataFrame:
    """``invoice_date`` text to a timestamp; lines without a readable date are dropped."""
    return (df.withColumn("invoice_date", parse_invoice_date(F.col("invoice_date")))
              .dropna(subset=["invoice_date"]))


def drop_non_products(df: DataFrame) -> DataFrame:
    """Drop charges and adjustments; codes that stay are not altered."""
    return df.filter(is_product_code(F.col("stock_code")))


def positive_price(df: DataFrame, price: str = "unit_price") -> DataFrame:
    return df.filter(F.col(price) > 0)


def require_description(df: DataFrame) -> DataFrame:
    return df.dropna(subset=["description"]).withColumn(
        "description", stripped(F.col("description")))


def price_to_krw(df: DataFrame) -> DataFrame:
    """Convert to whole thousands of won; prices that round to nothing are dropped."""
    return positive_price(df.withColumn("unit_price", gbp_to_krw(F.col("unit_price"))))


def clean_invoice_lines(df: DataFrame, observation: Observation | None = None) -> DataFrame:
    """All cleaning steps; with an observation the count of cleaned lines comes for free."""
    for step in (parse_dates, drop_non_products, positive_price, require_description,
                 price_to_krw):
        df = step(df)
    if observation is not None:
        df = df.observe(observation, F.count(F.lit(1)).alias("cleaned_lines"))
    return df


def stage_row_counts(df: DataFrame) -> DataFrame:
    """Lines left after each cleaning step, in one pass over the raw lines."""
    stages = {
        "read": F.lit(True),
        "dated": parse_invoice_date(F.col("invoice_date")).isNotNull(),
        "product_code": is_product_code(F.col("stock_code")),
        "priced": F.col("unit_price") > 0,
        "described": F.col("description").isNotNull(),
        "priced_in_krw": gbp_to_krw(F.col("unit_price")) > 0,
    }
    counts, so_far = [], F.lit(True)
    for name, holds in stages.items():
        so_far = so_far & holds
        counts.append(F.count_if(so_far).alias(name))
    wide = df.agg(*counts)
    return wide.unpivot([], list(stages), "stage", "line_count")


def members_only(df: DataFrame) -> DataFrame:
    return (df.filter(F.col("customer_id").isNotNull())
              .withColumn("customer_id", F.col("customer_id").cast("long")))


def _transactions(df: DataFrame) -> DataFrame:
    return df.select(
        "invoice_no", F.col("customer_id").alias("user_id"), F.col("stock_code").alias("product_id"),
        "quantity", F.col("unit_price").alias("price"), F.col("invoice_date").alias("timestamp"))


def split_transactions(cleaned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Purchases (quantity above 0) and refunds (below 0) of members; zero is neither."""
    members = members_only(cleaned)
    return (_transactions(members.filter(F.col("quantity") > 0)),
            _transactions(members.filter(F.col("quantity") < 0)))
