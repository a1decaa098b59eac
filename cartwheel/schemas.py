"""Fixed table schemas and value domains."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# Fixed values of the event contract.
EVENT_TYPES = ("view", "search", "add_to_cart", "purchase", "refund", "signup", "login")

# Stock codes that are charges and adjustments, not products.
NON_PRODUCT_CODES = ("POST", "D", "C2", "DOT", "M", "BANK CHARGES",
                     "PADS", "CRUK", "AMAZONFEE", "S", "B")

# Money and funnel constants.
GBP_TO_KRW = 1950
KRW_STEP = 1000
FUNNEL = {"view": 10, "add_to_cart": 3, "purchase": 1}
RANDOM_MIX = {"view": 10, "search": 2, "add_to_cart": 3, "purchase": 1}
SEED = 42

# Bounds of draws, the upper one not included. Minutes from cart to purchase and from
# view to cart; units added to a share of past lines for a product's stock, and the least of that.
CART_MINUTES = (1, 15)
VIEW_MINUTES = (5, 60)
STOCK_SHARE = 0.3
STOCK_LEAST = 5.0
STOCK_NOISE = (-3, 10)


_TYPES = {"STRING": T.StringType(), "INT": T.IntegerType(), "BIGINT": T.LongType(),
          "DOUBLE": T.DoubleType(), "TIMESTAMP": T.TimestampType(), "DATE": T.DateType(),
          "MAP": T.MapType(T.StringType(), T.StringType())}


def _struct(spec: str) -> T.StructType:
    """Schema from 'name TYPE, ...'; unlike a parsed DDL string it needs no session."""
    fields = [part.split() for part in spec.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


# Column names as they stand in the CSV header, and the names used from there on.
INVOICE_CSV = _struct(
    "InvoiceNo STRING, StockCode STRING, Description STRING, Quantity INT, "
    "InvoiceDate STRING, UnitPrice DOUBLE, CustomerID DOUBLE, Country STRING")
INVOICE_LINES = _struct(
    "invoice_no STRING, stock_code STRING, description STRING, quantity INT, "
    "invoice_date STRING, unit_price DOUBLE, customer_id DOUBLE, country STRING")

PRODUCTS = _struct(
    "product_id STRING, description STRING, price DOUBLE, total_purchase_count BIGINT, stock BIGINT")
USERS = _struct(
    "user_id BIGINT, country STRING, first_purchase_at TIMESTAMP, last_purchase_at TIMESTAMP")
TRANSACTIONS = _struct(
    "invoice_no STRING, user_id BIGINT, product_id STRING, quantity INT, price DOUBLE, "
    "timestamp TIMESTAMP")
CART_ITEMS = _struct(
    "id BIGINT, user_id BIGINT, product_id STRING, quantity BIGINT, added_at TIMESTAMP")

EVENT_WIRE = _struct(
    "user_id BIGINT, event_type STRING, product_id STRING, price DOUBLE, timestamp STRING")
# The same record with every field as text: shows which field of a bad record is bad.
EVENT_WIRE_TEXT = _struct(
    "user_id STRING, event_type STRING, product_id STRING, price STRING, timestamp STRING")
EVENT_LOG = _struct(
    "user_id DOUBLE, event_type STRING, product_id STRING, price DOUBLE, timestamp TIMESTAMP")

RAW_EVENTS = _struct(
    "user_id BIGINT, event_type STRING, product_id STRING, price DOUBLE, timestamp TIMESTAMP")
PRODUCT_STATS = _struct(
    "product_id STRING, view_count BIGINT, purchase_count BIGINT, revenue DOUBLE")
TRAFFIC_STATS = _struct(
    "window_start TIMESTAMP, window_end TIMESTAMP, unique_users BIGINT, event_count BIGINT, "
    "revenue DOUBLE")
DAILY_METRICS = _struct(
    "metric_date DATE, dau BIGINT, view_count BIGINT, purchase_count BIGINT, "
    "conversion_rate DOUBLE, revenue DOUBLE, event_count BIGINT")

METRIC_SAMPLES = _struct(
    "ts TIMESTAMP, metric STRING, labels MAP, value DOUBLE")
LOG_LINES = _struct("ts TIMESTAMP, container STRING, stream STRING, line STRING")

TABLES = {
    "products": PRODUCTS, "users": USERS, "cart_items": CART_ITEMS, "raw_events": RAW_EVENTS,
    "product_stats": PRODUCT_STATS, "traffic_stats": TRAFFIC_STATS,
    "daily_metrics": DAILY_METRICS,
}


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])
