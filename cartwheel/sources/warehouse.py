"""Shop tables derived from a TPC-H-like warehouse, by projection and joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cartwheel.sources.events import read_event_files


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def invoice_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Invoice lines with text dates; returned lines carry a negative quantity."""
    line, order, part, customer, nation = (
        table(spark, folder, n) for n in ("lineitem", "orders", "part", "customer", "nation"))
    amount = F.col("l_quantity").cast("int")
    return (line
            .join(order, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(part, F.col("l_partkey") == F.col("p_partkey"))
            .join(customer, F.col("o_custkey") == F.col("c_custkey"))
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("l_orderkey").cast("string").alias("invoice_no"),
                F.col("l_partkey").cast("string").alias("stock_code"),
                F.col("p_name").alias("description"),
                F.when(F.col("l_returnflag") == "R", -amount).otherwise(amount).alias("quantity"),
                F.date_format("o_orderdate", "M/d/yyyy H:mm").alias("invoice_date"),
                (F.col("l_extendedprice") / F.col("l_quantity") / 100).alias("unit_price"),
                F.when(F.col("o_custkey") % 10 == 0, F.lit(None))
                 .otherwise(F.col("o_custkey")).alias("customer_id"),
                F.col("n_name").alias("country")))


def _event_columns(events: DataFrame) -> DataFrame:
    return events.select(
        F.when(F.col("event_id") % 10 == 0, F.lit(None)).otherwise(F.col("user_id"))
         .alias("user_id"),
        F.when(F.col("event_type") == "click", "add_to_cart").otherwise(F.col("event_type"))
         .alias("event_type"),
        F.when(F.col("event_type") != "signup", F.get_json_object("props", "$.k"))
         .alias("product_id"),
        F.col("value").alias("price"),
        F.col("ts").cast("timestamp").alias("event_time"))


def shop_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events with some anonymous users; sign-ups have no product; 'error' is no valid type."""
    return _event_columns(table(spark, folder, "events"))


def shop_event_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The same events as a stream over the same table, one file or a folder of them."""
    schema = table(spark, folder, "events").schema
    # as a pattern the path may name a file; a plain path would have to be a folder
    return _event_columns(read_event_files(spark, f"{folder}/event[s].parquet", schema, "parquet"))


def raw_events(spark: SparkSession, folder: str) -> DataFrame:
    return shop_events(spark, folder).withColumnRenamed("event_time", "timestamp")


def shop_products(spark: SparkSession, folder: str) -> DataFrame:
    """Catalog; small parts were given a new code, so their old code is unknown to it."""
    code = F.col("p_partkey").cast("string")
    return table(spark, folder, "part").select(
        F.when(F.col("p_size") <= 5, F.concat(F.lit("R"), code)).otherwise(code)
         .alias("product_id"),
        F.col("p_name").alias("description"),
        F.col("p_retailprice").alias("price"),
        (F.col("p_partkey") * 37 % 1000).cast("int").alias("total_purchase_count"),
        (F.col("p_size") * 30).alias("stock"))


def shop_users(spark: SparkSession, folder: str) -> DataFrame:
    customer, nation = (table(spark, folder, n) for n in ("customer", "nation"))
    return (customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(F.col("c_custkey").alias("user_id"), F.col("n_name").alias("country")))


def carts(spark: SparkSession, folder: str) -> DataFrame:
    """One cart per order. The owner column is ``order_id``."""
    line, order = (table(spark, folder, n) for n in ("lineitem", "orders"))
    return (line.join(order, F.col("l_orderkey") == F.col("o_orderkey"))
            .select(F.col("o_orderkey").alias("order_id"),
                    F.col("o_custkey").alias("user_id"),
                    F.col("l_partkey").cast("string").alias("product_id"),
                    F.col("l_quantity").cast("int").alias("quantity"),
                    F.col("o_orderdate").cast("timestamp").alias("added_at")))


def metric_samples(spark: SparkSession, folder: str) -> DataFrame:
    """Each event as one scrape of a counter that restarts now and then."""
    return table(spark, folder, "events").select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.lit("http_requests_total").alias("metric"),
        F.create_map(
            F.lit("handler"), F.concat(F.lit("/"), F.col("event_type")),
            F.lit("status"), F.when(F.col("event_type") == "error", "500").otherwise("200"),
            F.lit("instance"), (F.col("user_id") % 4).cast("string")).alias("labels"),
        (F.col("event_id") % 997).cast("double").alias("value"))


def log_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Each conversation turn as one log line of a container named after its role."""
    return table(spark, folder, "conversations").select(
        F.timestamp_seconds(F.col("conv_id") * 60 + F.col("turn")).alias("ts"),
        F.concat(F.lit("/chat-"), F.col("role")).alias("container"),
        F.when(F.col("role") == "user", "stdout").otherwise("stderr").alias("stream"),
        F.col("text").alias("line"))
