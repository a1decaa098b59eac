"""Named queries over the warehouse tables, one or more per operator.

Every entry takes (spark, folder) and reads whole tables. ``AS_OF`` stands for "now" where a
query needs it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from cartwheel import schemas
from cartwheel.functions.times import date_label, minute_label
from cartwheel.operators import (cleaning, commerce, dimensions, events as ev, metrics, quality,
                                 serving, synthesis, telemetry)
from cartwheel.operators import sketches
from cartwheel.operators.allocation import decide_by_arrival
from cartwheel.operators.text_index import TextIndex
from cartwheel.plans import checkout as checkout_plan, daily as daily_plan, preparation
from cartwheel.session import apply_settings, cut_lineage, scratch_folder
from cartwheel.sinks.files import write_csv
from cartwheel.sinks.batches import append_raw, compact_days, raw_table, read_raw, windows_table
from cartwheel.sinks.kafka import to_messages
from cartwheel.sinks.keyed import KeyedTable
from cartwheel.sinks.snapshots import publish_snapshot, read_snapshot
from cartwheel.sources import warehouse as w
from cartwheel.sources.events import decode_checked, decode_events, decode_events_as_text
from cartwheel.sources.files import (check_invoice_lines, read_csv, read_event_log, read_invoice_lines, read_products,
                                     rejected_rows, sample_lines)
from cartwheel.sources.tables import ensure_tables, query_table
from cartwheel.streaming import jobs, replay
from cartwheel.streaming.progress import lag_samples

AS_OF = "2024-01-30 23:57:12"
REPORT_DAY = "2024-01-15"
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return fn(apply_settings(spark), folder.rstrip("/"))
    QUERIES[fn.__name__] = run
    return fn


def _round(df: DataFrame, *columns: str, digits: int = 2) -> DataFrame:
    """Sums of doubles depend on the order of rows in their last digits."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _valid_events(spark: SparkSession, folder: str) -> DataFrame:
    return ev.split_valid(ev.validate_events(w.shop_events(spark, folder)))[0]


def _raw_events(spark: SparkSession, folder: str) -> DataFrame:
    return _valid_events(spark, folder).withColumnRenamed("event_time", "timestamp")


def _cleaned(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean_invoice_lines(w.invoice_lines(spark, folder))


def _daily(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.daily_metrics_by_day(_raw_events(spark, folder))


def _with_day_text(df: DataFrame) -> DataFrame:
    return _round(df, "revenue").withColumn("metric_date", date_label(F.col("metric_date")))


def _traffic(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.traffic_stats(_valid_events(spark, folder), exact=True)


def _stats(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.product_stats(_valid_events(spark, folder))


# -- sources --------------------------------------------------------------------------------

@query
def invoice_csv_source(spark, folder):
    """Lines written as CSV under the original header and read by the fixed-schema reader."""
    path = scratch_folder(spark, "invoice-csv")
    lines = w.invoice_lines(spark, folder)
    write_csv(lines.select(*[F.col(new).alias(old) for new, old in zip(
        schemas.INVOICE_LINES.names, schemas.INVOICE_CSV.names)]), path)
    return read_invoice_lines(spark, path)


@query
def sample_exact_size(spark, folder):
    lines = w.invoice_lines(spark, folder)
    return sample_lines(lines, 0.25, exact=True).agg(F.count(F.lit(1)).alias("line_count"))


@query
def sample_bernoulli(spark, folder):
    """Each line kept on its own draw; the size is random, so only its plausibility is told."""
    lines = w.invoice_lines(spark, folder)
    kept = sample_lines(lines, 0.25).agg(F.count(F.lit(1))).scalar()
    n = F.count(F.lit(1))
    spread = 6 * F.sqrt(n * 0.25 * 0.75)
    return lines.agg(n.alias("line_count"),
                     (F.abs(F.first(kept) - n * 0.25) <= spread).alias("size_plausible"))


@query
def decoded_events(spark, folder):
    return decode_events(to_messages(w.shop_events(spark, folder)))


@query
def product_csv_source(spark, folder):
    path = scratch_folder(spark, "product-csv")
    write_csv(w.shop_products(spark, folder).select(*schemas.PRODUCTS.names), path)
    return read_products(spark, path)


@query
def event_log_source(spark, folder):
    path = scratch_folder(spark, "event-csv")
    write_csv(w.raw_events(spark, folder), path)
    return read_event_log(spark, path)


@query
def first_events_of_log(spark, folder):
    path = scratch_folder(spark, "event-csv")
    write_csv(w.raw_events(spark, folder), path)
    return read_event_log(spark, path, limit=500)


@query
def parameterised_sql(spark, folder):
    _raw_events(spark, folder).createOrReplaceTempView("raw_events")
    return query_table(
        spark, "raw_events",
        "SELECT event_type, count(*) AS event_count FROM raw_events "
        "WHERE price >= :least GROUP BY event_type", {"least": 5.0})


@query
def missing_table(spark, folder):
    """The table does not exist: an empty frame of its schema, beside the events there are."""
    none = query_table(spark, "no_such_table", "SELECT * FROM no_such_table",
                       schema=schemas.PRODUCT_STATS)
    return _stats(spark, folder).unionByName(none).agg(
        F.count(F.lit(1)).alias("product_count"))


# -- cleaning and dimensions ----------------------------------------------------------------

@query
def cleaned_lines(spark, folder):
    return _cleaned(spark, folder)


@query
def cleaning_stage_counts(spark, folder):
    return cleaning.stage_row_counts(w.invoice_lines(spark, folder))


@query
def member_purchases(spark, folder):
    return cleaning.split_transactions(_cleaned(spark, folder))[0]


@query
def member_refunds(spark, folder):
    return cleaning.split_transactions(_cleaned(spark, folder))[1]


@query
def product_dimension(spark, folder):
    return dimensions.build_products(_cleaned(spark, folder))


@query
def user_dimension(spark, folder):
    return dimensions.build_users(_cleaned(spark, folder))


@query
def product_purchase_weights(spark, folder):
    return dimensions.purchase_weights(dimensions.build_products(_cleaned(spark, folder)))


@query
def product_stock_bounds(spark, folder):
    """Assigned stock is a seeded draw; its bounds are not."""
    stocked = dimensions.assign_stock(dimensions.build_products(_cleaned(spark, folder)))
    base = F.greatest(F.col("total_purchase_count") * 0.3, F.lit(5.0)).cast("int")
    return stocked.select(
        "product_id", "total_purchase_count",
        F.col("stock").between(F.greatest(base - 3, F.lit(0)), base + 9).alias("in_bounds"))


@query
def products_upserted(spark, folder):
    new = (dimensions.build_products(_cleaned(spark, folder))
           .withColumn("stock", F.col("total_purchase_count") + 1))
    return dimensions.upsert_products(w.shop_products(spark, folder), new)


@query
def users_upserted(spark, folder):
    never = F.lit(None).cast("timestamp")
    current = (w.shop_users(spark, folder).withColumn("first_purchase_at", never)
               .withColumn("last_purchase_at", never).withColumn("country", F.lit("unknown")))
    return dimensions.upsert_users(current, dimensions.build_users(_cleaned(spark, folder)))


@query
def broken_constraints(spark, folder):
    """Selling every cart regardless of stock drives some stocks below zero."""
    sold = commerce.apply_stock(w.shop_products(spark, folder), w.carts(spark, folder))
    return quality.check_constraints(sold, "products")


@query
def repeated_order_keys(spark, folder):
    return quality.check_constraints(w.carts(spark, folder), "carts", key="order_id")


# -- events ---------------------------------------------------------------------------------

@query
def valid_events(spark, folder):
    return _valid_events(spark, folder)


@query
def rejected_events(spark, folder):
    checked = ev.validate_events(decode_events_as_text(to_messages(w.shop_events(spark, folder))))
    return ev.split_valid(checked)[1].select(
        "user_id", "event_type", "product_id", "price", "timestamp", "reason", "rejected_value")


@query
def events_with_default_time(spark, folder):
    """Search-like gaps: events without a product are taken to have come without a time."""
    timeless = w.raw_events(spark, folder).withColumn(
        "timestamp", F.when(F.col("product_id").isNotNull(), F.col("timestamp")))
    return ev.default_event_time(timeless, as_of=AS_OF)


@query
def events_with_identity(spark, folder):
    """Customers are the known users; odd payload ids arrive authenticated, shifted by one."""
    claimed = w.shop_events(spark, folder).withColumn(
        "auth_user_id", F.when(F.col("user_id") % 2 == 1, F.col("user_id") * 20))
    return ev.resolve_identity(claimed, w.shop_users(spark, folder))


@query
def events_repaired_for_sending(spark, folder):
    """Float ids with NaN for missing ones, as a data frame library would deliver them."""
    nan = F.lit(float("nan"))
    floated = (w.raw_events(spark, folder)
               .withColumn("user_id", F.coalesce(F.col("user_id").cast("double"), nan))
               .withColumn("price", F.when(F.col("product_id").isNull(), nan)
                           .otherwise(F.col("price"))))
    return ev.clean_event_row(floated)


@query
def events_with_product(spark, folder):
    return ev.has_product(_raw_events(spark, folder))


@query
def event_messages(spark, folder):
    return to_messages(w.shop_events(spark, folder))


@query
def time_ordered_events(spark, folder):
    return serving.time_ordered(_raw_events(spark, folder))


# -- metrics --------------------------------------------------------------------------------

@query
def product_stats(spark, folder):
    return _round(_stats(spark, folder), "revenue")


@query
def traffic_per_minute(spark, folder):
    return _round(_traffic(spark, folder), "revenue")


@query
def traffic_users_estimated(spark, folder):
    """Estimated against exact users per minute: the rest of the row must agree."""
    events = _valid_events(spark, folder)
    guess = metrics.traffic_stats(events).withColumnRenamed("unique_users", "estimate")
    exact = metrics.traffic_stats(events, exact=True).select("window_start", "unique_users")
    near = F.abs(F.col("estimate") - F.col("unique_users")) <= 1 + 0.2 * F.col("unique_users")
    return guess.join(exact, "window_start").select(
        "window_start", "window_end", "event_count", near.alias("estimate_near"))


@query
def daily_metrics_all_days(spark, folder):
    return _with_day_text(_daily(spark, folder))


@query
def daily_metrics_one_day(spark, folder):
    return _with_day_text(metrics.daily_metrics(_raw_events(spark, folder), REPORT_DAY))


@query
def daily_metrics_empty_day(spark, folder):
    return _with_day_text(metrics.daily_metrics(_raw_events(spark, folder), "2031-01-01"))


@query
def daily_metrics_stored(spark, folder):
    """Backfill, then one day again over its stored result."""
    path = scratch_folder(spark, "daily")
    raw = _raw_events(spark, folder)
    daily_plan.backfill(raw, path)
    daily_plan.run_day(raw, REPORT_DAY, path)
    return _with_day_text(daily_plan.read_daily(spark, path))


@query
def daily_report_lines(spark, folder):
    daily = _daily(spark, folder).withColumn("revenue", F.round("revenue", 2))
    return metrics.daily_report(daily).withColumn("metric_date", date_label(F.col("metric_date")))


@query
def current_visitors(spark, folder):
    return metrics.current_visitors(_raw_events(spark, folder), 5, AS_OF)


@query
def visitors_last_day(spark, folder):
    return metrics.current_visitors(_raw_events(spark, folder), 24 * 60, AS_OF)


@query
def purchases_today(spark, folder):
    return metrics.purchases_today(_raw_events(spark, folder), AS_OF)


@query
def revenue_today(spark, folder):
    return _round(metrics.revenue_today(_raw_events(spark, folder), AS_OF), "revenue")


@query
def events_in_last_hour(spark, folder):
    return metrics.in_last(_raw_events(spark, folder), 60, AS_OF)


@query
def events_on_day(spark, folder):
    return metrics.events_on_day(_raw_events(spark, folder), REPORT_DAY)


@query
def recent_event_total(spark, folder):
    return metrics.recent_event_total(
        serving.recent_traffic(_traffic(spark, folder), 60, AS_OF))


@query
def event_type_counts(spark, folder):
    return metrics.event_type_counts(w.shop_events(spark, folder))


@query
def purchase_span(spark, folder):
    return metrics.event_span(cleaning.split_transactions(_cleaned(spark, folder))[0])


@query
def samples_within_retention(spark, folder):
    return metrics.keep_recent(w.metric_samples(spark, folder), 168, AS_OF).select(
        "ts", "metric", F.col("labels")["handler"].alias("handler"), "value")


# -- serving --------------------------------------------------------------------------------

@query
def product_stats_named(spark, folder):
    return _round(serving.name_products(_stats(spark, folder), w.shop_products(spark, folder)),
                  "revenue")


@query
def top_products(spark, folder):
    return _round(serving.top_products(_stats(spark, folder), w.shop_products(spark, folder)),
                  "revenue")


@query
def recent_traffic(spark, folder):
    shown = serving.recent_traffic_of_events(_valid_events(spark, folder), 60, AS_OF, exact=True)
    return _round(shown, "revenue").withColumn("minute", minute_label(F.col("window_start")))


@query
def recent_traffic_fallback(spark, folder):
    """Asked long after the last event: the last 60 windows are shown."""
    return _round(serving.recent_traffic_of_events(_valid_events(spark, folder), 60, "2030-01-01 00:00:00", exact=True),
                  "revenue")


@query
def daily_trend(spark, folder):
    return _with_day_text(serving.daily_trend(_daily(spark, folder), 7))


@query
def latest_day(spark, folder):
    return _with_day_text(serving.latest_day(_daily(spark, folder)))


@query
def daily_card_texts(spark, folder):
    daily = _daily(spark, folder).withColumn("revenue", F.round("revenue", 2))
    return metrics.daily_cards(daily)


@query
def products_by_popularity(spark, folder):
    return serving.by_popularity(w.shop_products(spark, folder))


@query
def product_search(spark, folder):
    return serving.search_products(w.shop_products(spark, folder), "RED")


@query
def product_search_wildcards(spark, folder):
    return serving.search_products(w.shop_products(spark, folder), "r_d%g")


@query
def product_page(spark, folder):
    return serving.list_products(w.shop_products(spark, folder), skip=40, limit=20, search="blue")


@query
def product_lookup(spark, folder):
    return serving.lookup(w.shop_products(spark, folder), "product_id", "17")


# -- commerce -------------------------------------------------------------------------------

@query
def cart_lines_known(spark, folder):
    return commerce.known_products(w.carts(spark, folder), w.shop_products(spark, folder))


@query
def cart_lines_unknown(spark, folder):
    return commerce.unknown_products(w.carts(spark, folder), w.shop_products(spark, folder))


@query
def cart_owners_unknown(spark, folder):
    """Carts against the users that placed member purchases: guests' carts are orphans."""
    return commerce.orphans(w.carts(spark, folder),
                            dimensions.build_users(_cleaned(spark, folder)), "user_id")


@query
def cart_of_user(spark, folder):
    return commerce.user_cart(w.carts(spark, folder), 7)


@query
def cart_merged(spark, folder):
    return commerce.merge_lines(w.carts(spark, folder), "order_id")


@query
def cart_after_additions(spark, folder):
    """Every line is added once more with the default quantity."""
    cart = commerce.merge_lines(w.carts(spark, folder), "order_id")
    return commerce.cart_add(cart, cart.drop("quantity"), "order_id")


def _returned(spark: SparkSession, folder: str) -> DataFrame:
    """(order, product) of returned lines; 'unknown' orders get a product they never had."""
    return w.table(spark, folder, "lineitem").filter(F.col("l_returnflag") == "R").select(
        F.col("l_orderkey").alias("order_id"),
        F.when(F.col("l_linestatus") == "O", F.concat(F.lit("X"), F.col("l_partkey").cast("string")))
         .otherwise(F.col("l_partkey").cast("string")).alias("product_id"))


@query
def cart_after_removals(spark, folder):
    return commerce.cart_remove(w.carts(spark, folder), _returned(spark, folder), "order_id")


@query
def cart_removals_not_found(spark, folder):
    return commerce.not_in_cart(w.carts(spark, folder), _returned(spark, folder), "order_id")


@query
def cart_priced(spark, folder):
    return _round(commerce.price_cart(w.carts(spark, folder), w.shop_products(spark, folder)),
                  "line_total")


@query
def cart_order_totals(spark, folder):
    lines = commerce.merge_lines(w.carts(spark, folder), "order_id")
    return commerce.order_totals(
        commerce.price_cart(lines, w.shop_products(spark, folder)), "order_id")


@query
def stock_shortages(spark, folder):
    return commerce.stock_shortages(w.carts(spark, folder), w.shop_products(spark, folder))


@query
def order_verdicts(spark, folder):
    return commerce.order_verdicts(w.carts(spark, folder), w.shop_products(spark, folder),
                                   "order_id")


@query
def admissible_orders(spark, folder):
    return commerce.admissible_orders(w.carts(spark, folder), w.shop_products(spark, folder),
                                      "order_id")


@query
def oversell_report(spark, folder):
    return commerce.oversell_report(w.carts(spark, folder), w.shop_products(spark, folder))


@query
def running_demand(spark, folder):
    lines = commerce.merge_lines(w.carts(spark, folder), "order_id")
    return commerce.running_demand(lines, w.shop_products(spark, folder), "order_id")


def _checkout(spark: SparkSession, folder: str) -> checkout_plan.Checkout:
    return checkout_plan.checkout(w.carts(spark, folder), w.shop_products(spark, folder), AS_OF,
                                  "order_id")


@query
def checkout_purchase_events(spark, folder):
    return _checkout(spark, folder).events


@query
def checkout_totals(spark, folder):
    return _checkout(spark, folder).totals


@query
def checkout_catalog_after(spark, folder):
    return _checkout(spark, folder).products


@query
def checkout_carts_after(spark, folder):
    return _checkout(spark, folder).cart


@query
def checkout_contested(spark, folder):
    return _checkout(spark, folder).contested


# -- synthesis ------------------------------------------------------------------------------

@query
def conversion_path_bounds(spark, folder):
    """Events per type, and how many lie outside the allowed distance from their purchase."""
    purchases, _ = cleaning.split_transactions(_cleaned(spark, folder))
    keyed = purchases.withColumn("user_id", F.xxhash64(*purchases.columns))
    made = synthesis.conversion_path(keyed).join(
        keyed.select("user_id", F.col("timestamp").alias("bought_at")).distinct(), "user_id")
    minutes = F.timestamp_diff("MINUTE", F.col("timestamp"),
                               F.date_trunc("minute", F.col("bought_at")))
    fits = (F.when(F.col("event_type") == "view", minutes.between(6, 73))
            .when(F.col("event_type") == "add_to_cart", minutes.between(1, 14))
            .otherwise(F.col("timestamp") == F.col("bought_at")))
    return made.groupBy("event_type").agg(F.count(F.lit(1)).alias("event_count"),
                                          F.count_if(~fits).alias("out_of_bounds"))


def _synthetic(spark: SparkSession, folder: str) -> tuple[DataFrame, preparation.Prepared]:
    made = preparation.prepare(w.invoice_lines(spark, folder))
    return made.events, made


@query
def synthetic_event_counts(spark, folder):
    events, _ = _synthetic(spark, folder)
    return events.groupBy("event_type").agg(F.count(F.lit(1)).alias("event_count"))


@query
def prepared_row_counts(spark, folder):
    return preparation.row_counts(preparation.prepare(w.invoice_lines(spark, folder)))


@query
def synthetic_event_integrity(spark, folder):
    """Synthetic events whose user, product or time lies outside what the purchases allow."""
    _, made = _synthetic(spark, folder)
    first = made.purchases.agg(F.min("timestamp") - F.expr("INTERVAL 73 MINUTES")).scalar()
    last = made.purchases.unionByName(made.refunds).agg(F.max("timestamp")).scalar()
    earliest = F.least(first, made.refunds.agg(F.min("timestamp")).scalar())
    parts = preparation.event_totals(made, lambda events: events.groupBy("event_type").agg(
        F.count_if(F.col("user_id").isNull() | F.col("product_id").isNull()
                   | F.col("price").isNull()).alias("incomplete"),
        F.count_if(~F.col("timestamp").between(earliest, last)).alias("out_of_period")))
    return parts.groupBy("event_type").agg(*[F.sum(c).alias(c) for c in ("incomplete", "out_of_period")])


@query
def popularity_weighted_draws(spark, folder):
    """Each event draws one product: draws made, and draws of products that cannot be drawn."""
    products = cut_lineage(dimensions.build_products(_cleaned(spark, folder)))
    slots = w.table(spark, folder, "events").select(F.col("event_id").alias("slot"))
    drawn = synthesis.weighted_pick(slots, ["slot"], products, "product_id",
                                    F.col("total_purchase_count"), "draw")
    return drawn.agg(F.count(F.lit(1)).alias("draws"), F.count_distinct("slot").alias("slots"),
                     F.count_if(F.col("total_purchase_count") <= 0).alias("impossible"))


@query
def random_event_mix(spark, folder):
    """One random event per given event; a search has neither product nor price."""
    slots = w.table(spark, folder, "events").select(F.col("event_id").alias("slot"))
    products = cut_lineage(dimensions.build_products(_cleaned(spark, folder)))
    users = cut_lineage(dimensions.build_users(_cleaned(spark, folder)))
    mix = synthesis.random_event_mix(slots, users, products)
    bare = F.col("product_id").isNull() & F.col("price").isNull()
    full = F.col("product_id").isNotNull() & F.col("price").isNotNull()
    right = F.when(F.col("event_type") == "search", bare).otherwise(full)
    return mix.agg(F.count(F.lit(1)).alias("event_count"), F.count_if(~right).alias("wrong"),
                   F.count_distinct("event_type").alias("event_types"))


@query
def replay_waits(spark, folder):
    return synthesis.replay_gaps(w.raw_events(spark, folder), speed=60.0)


# -- telemetry ------------------------------------------------------------------------------

@query
def request_rate_by_handler(spark, folder):
    return _round(telemetry.counter_rate(w.metric_samples(spark, folder), "http_requests_total",
                                         ["handler"], "1 hour"), "rate", digits=6)


def _bucket_rates(spark: SparkSession, folder: str) -> DataFrame:
    """Per handler and day: rate of events with a value up to each bound."""
    bounds = ("1", "5", "10", "25", "50", "+Inf")
    counted = (w.table(spark, folder, "events")
               .groupBy(F.date_trunc("day", F.col("ts").cast("timestamp")).alias("window_start"),
                        F.col("event_type").alias("handler"))
               .agg(*[(F.count_if(F.lit(True) if b == "+Inf" else F.col("value") <= float(b)) / 86400)
                      .alias(b) for b in bounds]))
    return counted.unpivot(["window_start", "handler"], list(bounds), "le", "rate")


@query
def latency_p95_by_handler(spark, folder):
    rates = _bucket_rates(spark, folder)
    return _round(telemetry.histogram_quantile(rates, 0.95, ["window_start", "handler"]),
                  "quantile", digits=6)


@query
def latency_median_by_handler(spark, folder):
    rates = _bucket_rates(spark, folder)
    return _round(telemetry.histogram_quantile(rates, 0.5, ["window_start", "handler"]),
                  "quantile", digits=6)


@query
def error_percentage(spark, folder):
    return _round(telemetry.error_rate(w.metric_samples(spark, folder), "http_requests_total",
                                       "1 day"), "error_percent", digits=6)


@query
def gauge_by_state(spark, folder):
    gauge = w.table(spark, folder, "events").select(
        F.col("ts").cast("timestamp").alias("ts"), F.lit("connections").alias("metric"),
        F.create_map(F.lit("state"), F.col("event_type")).alias("labels"), "value")
    return telemetry.gauge_by_label(gauge, "connections", "state", "1 hour")


@query
def consumer_lag(spark, folder):
    lag = w.table(spark, folder, "events").select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.lit("kafka_consumergroup_lag").alias("metric"),
        F.create_map(F.lit("consumergroup"), F.col("event_type"), F.lit("topic"), F.lit("events"),
                     F.lit("partition"), (F.col("user_id") % 3).cast("string")).alias("labels"),
        (F.col("event_id") % 50).cast("double").alias("value"))
    return telemetry.lag_by_group(lag, span="1 hour")


@query
def container_logs(spark, folder):
    return telemetry.container_logs(w.log_lines(spark, folder), "chat-(user|system)")


def _requests(spark: SparkSession, folder: str) -> DataFrame:
    return w.table(spark, folder, "events").select(
        (F.col("value") * 10).alias("duration_ms"),
        (F.col("event_type") == "error").alias("failed"),
        F.col("event_type").alias("check"), (F.col("value") < 50).alias("passed"))


@query
def load_test_summary(spark, folder):
    return _round(telemetry.load_summary(_requests(spark, folder)), "failed_rate", "p90", "p95",
                  digits=6)


@query
def load_test_checks(spark, folder):
    return _round(telemetry.check_success(_requests(spark, folder)), "success_rate", digits=6)


# -- streaming ------------------------------------------------------------------------------

def _streamed(spark: SparkSession, folder: str, start) -> jobs.StreamFolders:
    folders = jobs.StreamFolders(scratch_folder(spark, "stream"))
    start(w.shop_event_stream(spark, folder), folders, once=True).awaitTermination()
    return folders


@query
def stream_raw_events(spark, folder):
    folders = _streamed(spark, folder, jobs.start_raw_events)
    return (spark.read.parquet(folders.table("raw_events"))
            .select("user_id", "event_type", "product_id", "price", "timestamp"))


@query
def stream_rejected_events(spark, folder):
    folders = _streamed(spark, folder, jobs.start_raw_events)
    return (spark.read.parquet(folders.table("rejected_events"))
            .select("user_id", "event_type", "product_id", "price", "event_time", "reason"))


@query
def stream_product_stats(spark, folder):
    folders = _streamed(spark, folder, jobs.start_product_stats)
    return _round(read_snapshot(spark, folders.table("product_stats"), schemas.PRODUCT_STATS),
                  "revenue")


@query
def stream_traffic_windows(spark, folder):
    """Closed minutes only; users are estimated on a stream and left out of the comparison."""
    folders = _streamed(spark, folder, jobs.start_traffic_stats)
    return _round(spark.read.parquet(folders.table("traffic_stats"))
                  .select("window_start", "window_end", "event_count", "revenue"), "revenue")


@query
def stream_replay(spark, folder):
    """The log replayed as time-ordered files, several batches, into the raw event job."""
    path = scratch_folder(spark, "replay")
    log = w.raw_events(spark, folder)
    replay.lay_out_replay(log, path, files=4)
    folders = jobs.StreamFolders(scratch_folder(spark, "stream"))
    events = replay.replay_as_stream(spark, path, log.schema)
    jobs.start_product_stats(events, folders, once=True).awaitTermination()
    return _round(read_snapshot(spark, folders.table("product_stats"), schemas.PRODUCT_STATS),
                  "revenue")


@query
def snapshot_published(spark, folder):
    """Two versions and a repeated publication: readers get the newest complete one."""
    base = scratch_folder(spark, "snapshot")
    products = w.shop_products(spark, folder).select(*schemas.PRODUCTS.names)
    publish_snapshot(products.withColumn("stock", F.lit(0)), base, "first")
    publish_snapshot(products, base, "second")
    publish_snapshot(products.withColumn("stock", F.lit(-1)), base, "second")
    return read_snapshot(spark, base, schemas.PRODUCTS)


def _messages(spark: SparkSession, folder: str) -> DataFrame:
    """Events as messages, some of them damaged by a rule on their number."""
    user = F.when(F.col("event_id") % 13 == 4, F.lit('"u17"')).otherwise(F.col("user_id").cast("string"))
    price = F.when(F.col("event_id") % 17 == 5, F.lit('"cheap"')).otherwise(F.format_string("%.2f", "value"))
    text = F.format_string('{"user_id":%s,"event_type":"%s","price":%s}', user, "event_type", price)
    return w.table(spark, folder, "events").select(
        F.when(F.col("event_id") % 19 == 6, F.left(text, F.lit(12))).otherwise(text).alias("value"))


@query
def live_malformed_rejected(spark, folder):
    """What the live decoder rejects, why, and the text as it came."""
    return (decode_checked(_messages(spark, folder)).filter("reason is not null")
            .groupBy("reason").agg(F.count(F.lit(1)).alias("messages"), F.min("raw").alias("first_text"),
                                   F.max(F.length("raw")).alias("longest")))


@query
def live_jobs_agree(spark, folder):
    """Closed minutes: events stored by the raw job against events counted by the traffic job, both
    started together over one stream, where one event in eleven comes without a time and gets that
    of its message, half a minute later."""
    folders = jobs.StreamFolders(scratch_folder(spark, "stream"))
    stream = (w.shop_event_stream(spark, folder)
              .withColumn("ingest_time", F.col("event_time") + F.expr("INTERVAL 30 SECONDS"))
              .withColumn("event_time", F.when(F.pmod(F.unix_seconds("event_time"), F.lit(11)) != 3, F.col("event_time"))))
    for started in jobs.start_all(stream, folders, once=True):
        started.awaitTermination()
    stored = (read_raw(spark, folders.table("raw_events"))
              .groupBy(F.date_trunc("minute", "timestamp").alias("window_start"))
              .agg(F.count(F.lit(1)).alias("stored_events")))
    counted = windows_table(folders.table("traffic_stats")).read(spark).select("window_start", "event_count")
    return counted.join(stored, "window_start", "left")


@query
def traffic_windows_merged(spark, folder):
    """Closed minutes, one folder per batch, gathered into few files and read back."""
    folders = _streamed(spark, folder, jobs.start_traffic_stats)
    stored = windows_table(folders.table("traffic_stats"))
    stored.merge(spark)
    return _round(stored.read(spark).select("window_start", "window_end", "event_count", "revenue"), "revenue")


@query
def invoice_csv_rejected(spark, folder):
    """Lines of which some are damaged by a rule on their number: how many are rejected, and why."""
    path = scratch_folder(spark, "invoice-csv")
    lines = w.table(spark, folder, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("InvoiceNo"), F.col("l_partkey").cast("string").alias("StockCode"),
        F.lit("x").alias("Description"),
        F.when(F.col("l_partkey") % 7 == 3, "six").otherwise(F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit(".0"))).alias("Quantity"),
        F.lit("12/1/2010 8:26").alias("InvoiceDate"), F.lit("2.5").alias("UnitPrice"),
        F.when(F.col("l_partkey") % 11 == 5, "abc").otherwise(F.col("l_suppkey").cast("string")).alias("CustomerID"),
        F.lit("UK").alias("Country"))
    write_csv(lines, path)
    # one pass over the file; that nothing could be read is told as well
    checked = check_invoice_lines(spark, path).groupBy(F.coalesce("reason", F.lit("read")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("line_count"), F.sum("quantity").alias("units"))
    none = spark.range(1).select(F.lit("read").alias("outcome"), F.lit(0).cast("long").alias("line_count"),
                                 F.lit(None).cast("long").alias("units"))
    return checked.unionByName(none).groupBy("outcome").agg(
        F.sum("line_count").alias("line_count"), F.sum("units").alias("units"))


@query
def csv_texts_come_back(spark, folder):
    """Texts with line breaks, backslashes and characters no text should have, written and read
    without loss."""
    path = scratch_folder(spark, "texts-csv")
    docs = w.table(spark, folder, "documents").select("doc_id", F.when(F.col("doc_id") % 50 == 7, "").when(
        F.col("doc_id") % 50 == 9, F.concat(F.lit("\\n\uffff\\"), F.col("text"), F.lit("\\\\\uffff\\e"))).when(
        F.col("doc_id") % 50 != 8, F.col("text")).alias("text"))
    write_csv(docs, path, lossless=True)
    return read_csv(spark, path, docs.schema, lossless=True)


@query
def product_search_backslash(spark, folder):
    return serving.search_products(w.shop_products(spark, folder), "r\\e\\d")


@query
def gauge_of_one_database(spark, folder):
    """Two series per state and database: the latest of each, summed, for one database."""
    events = w.table(spark, folder, "events")
    gauge = events.select(
        F.col("ts").cast("timestamp").alias("ts"), F.lit("connections").alias("metric"),
        F.create_map(F.lit("state"), F.col("event_type"), F.lit("datname"), F.concat(F.lit("db"), (F.col("user_id") % 2).cast("string")),
                     F.lit("host"), F.concat(F.lit("h"), (F.col("event_id") % 2).cast("string"))).alias("labels"), "value")
    return _round(telemetry.gauge_by_label(gauge, "connections", "state", "1 hour", {"datname": "db1"}), "value", digits=6)


@query
def broken_cart_constraints(spark, folder):
    """Cart lines that break a rule of their table, counted by rule."""
    cart = w.carts(spark, folder).select(
        F.col("order_id").alias("id"), F.when(F.col("order_id") % 5 != 2, F.col("user_id")).alias("user_id"), "product_id",
        F.when(F.col("order_id") % 9 != 4, F.col("quantity")).alias("quantity"), "added_at")
    broken = quality.broken_rows(cart, "cart_items", {"users": w.shop_users(spark, folder), "products": w.shop_products(spark, folder)})
    return broken.groupBy("violation").agg(F.count(F.lit(1)).alias("row_count"))


def _stored_days(spark: SparkSession, folder: str) -> str:
    path = scratch_folder(spark, "raw") + "/tables/raw_events"
    valid = _valid_events(spark, folder)
    for batch_id in range(2):
        append_raw(valid.filter(F.pmod(F.xxhash64("event_time"), F.lit(2)) == batch_id), batch_id, path, "main")
    return path


@query
def raw_events_compacted(spark, folder):
    path = _stored_days(spark, folder)
    compact_days(spark, path, REPORT_DAY)
    return read_raw(spark, path).groupBy("event_date").agg(
        F.count(F.lit(1)).alias("event_count"), F.round(F.sum("price"), 2).alias("price_sum"))


@query
def late_events_after_compaction(spark, folder):
    """A third of the events comes after its days were merged: counted at once, and again after the
    next merge took it in and the batches it stands for were removed."""
    path = scratch_folder(spark, "raw") + "/tables/raw_events"
    valid = _valid_events(spark, folder)
    part = F.pmod(F.xxhash64("event_time"), F.lit(3))
    for batch_id in range(2):
        append_raw(valid.filter(part == batch_id), batch_id, path, "main")
    compact_days(spark, path, REPORT_DAY)
    append_raw(valid.filter(part == 2), 2, path, "main")

    def per_day(stage: str) -> DataFrame:
        return read_raw(spark, path).groupBy(F.lit(stage).alias("stage"), "event_date").agg(
            F.count(F.lit(1)).alias("event_count"), F.round(F.sum("price"), 2).alias("price_sum"))

    late = cut_lineage(per_day("late"))
    compact_days(spark, path, REPORT_DAY)
    raw_table(path).forget(spark, keep_hours=0.0)
    return late.unionByName(per_day("merged"))


@query
def dimension_csv_rejected(spark, folder):
    """A products file damaged by a rule on its keys: what is rejected, and why."""
    path = scratch_folder(spark, "product-csv")
    number = F.col("p_partkey")
    write_csv(w.table(spark, folder, "part").select(
        F.when(number % 29 != 4, number.cast("string")).alias("product_id"), F.col("p_name").alias("description"),
        F.when(number % 7 == 3, "cheap").when(number % 7 != 5, F.col("p_retailprice").cast("string")).alias("price"),
        F.when(number % 11 == 6, "2.5").otherwise("3.0").alias("total_purchase_count"), F.lit("4").alias("stock")), path)
    good = read_products(spark, path).agg(
        F.lit("read").alias("outcome"), F.count(F.lit(1)).alias("row_count"),
        F.sum(F.col("product_id").cast("long")).alias("key_sum"), F.count("price").alias("priced"))
    bad = rejected_rows(spark, path, schemas.PRODUCTS).groupBy(F.col("reason").alias("outcome")).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum(F.col("product_id").cast("long")).alias("key_sum"), F.count("price").alias("priced"))
    return good.unionByName(bad)


@query
def contested_orders_decided(spark, folder):
    """Every order by arrival against the stock that earlier ones leave."""
    lines = commerce.merge_lines(w.carts(spark, folder), "order_id")
    return decide_by_arrival(lines, w.shop_products(spark, folder), "order_id").select("order_id", "admitted")


def _product_index(spark: SparkSession, folder: str) -> TextIndex:
    index = TextIndex(scratch_folder(spark, "text-index"))
    index.build(w.shop_products(spark, folder))
    return index


@query
def product_search_indexed(spark, folder):
    """The rows of ``product_search_wildcards``, for another text, by posting lists."""
    return _product_index(spark, folder).search(spark, "ALL%_lt")


@query
def product_search_short_text(spark, folder):
    """No three letters in a row: the index cannot tell, and the catalog is read."""
    return _product_index(spark, folder).search(spark, "r_d%g")


@query
def users_from_minute_sketches(spark, folder):
    """Users of hours and of the whole time from sketches stored per minute: within the stated
    error of the exact count, which is told as well."""
    valid = _valid_events(spark, folder)
    minutes = cut_lineage(sketches.minute_sketches(valid))
    checked = None
    for span in ("1 hour", "1 day"):
        exact = (valid.filter("event_time is not null").groupBy(F.window("event_time", span).start.alias("window_start"))
                 .agg(F.count_distinct("user_id").alias("users"), F.count(F.lit(1)).alias("events")))
        near = F.abs(F.col("unique_users") - F.col("users")) <= 1 + sketches.USERS_ERROR * F.col("users")
        one = sketches.traffic_over(minutes, span).join(exact, "window_start").select(
            F.lit(span).alias("span"), "window_start", "users", F.col("event_count").alias("events"), near.alias("near"))
        checked = one if checked is None else checked.unionByName(one)
    return checked


@query
def quantiles_from_minute_sketches(spark, folder):
    """p50 and p95 per event type and day from sketches stored per minute: the share of values below
    and up to each is within the stated rank error."""
    samples = w.table(spark, folder, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
    minutes = cut_lineage(sketches.value_sketches(samples, "value", ["event_type"]))
    found = sketches.quantiles_over(minutes, {"p50": 0.50, "p95": 0.95}, ["event_type"], "1 day")
    days = samples.filter("value is not null").withColumn("window_start", F.window("ts", "1 day").start)
    ranked = days.join(found, ["window_start", "event_type"]).groupBy("window_start", "event_type").agg(
        F.count(F.lit(1)).alias("values"), F.first("value_count").alias("sketched"),
        *[F.avg((F.col("value") < F.col(p)).cast("int")).alias(f"below_{p}") for p in ("p50", "p95")],
        *[F.avg((F.col("value") <= F.col(p)).cast("int")).alias(f"upto_{p}") for p in ("p50", "p95")])
    slack = sketches.RANK_ERROR + 1 / F.col("values")
    near = [(F.col(f"below_{p}") <= q + slack) & (F.col(f"upto_{p}") >= q - slack) for p, q in (("p50", 0.5), ("p95", 0.95))]
    return ranked.select("window_start", "event_type", "values", (F.col("values") == F.col("sketched")).alias("all_counted"),
                         near[0].alias("p50_near"), near[1].alias("p95_near"))


@query
def stream_product_totals(spark, folder):
    """Totals kept up by deltas: several batches, a base in between, merged on read."""
    path = scratch_folder(spark, "event-files")
    events = w.shop_events(spark, folder)
    events.repartitionByRange(6, "event_time").write.parquet(path)
    folders = jobs.StreamFolders(scratch_folder(spark, "stream"))
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(path)
    jobs.start_product_totals(stream, folders, once=True).awaitTermination()
    return _round(jobs.product_totals(folders).read(spark), "revenue")


@query
def products_upserted_by_slot(spark, folder):
    """The result of ``products_upserted``, where only the slots of arrivals were rewritten."""
    name = "products_" + scratch_folder(spark, "x").rsplit("-", 1)[-1]
    new = (dimensions.build_products(_cleaned(spark, folder))
           .withColumn("stock", F.col("total_purchase_count") + 1))
    held = KeyedTable(name, "product_id", slots=16, buckets=4)
    held.create(w.shop_products(spark, folder).to(schemas.PRODUCTS))
    held.upsert(new, dimensions.upsert_products)
    return held.read(spark)


@query
def tables_ensured(spark, folder):
    """One day of the catalog table that lies over the folders of the raw job."""
    root = _stored_days(spark, folder).removesuffix("/tables/raw_events")
    database = "ensured_" + root.rsplit("-", 1)[-1]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    ensure_tables(spark, database, root)
    return spark.table(f"{database}.raw_events").filter(F.col("event_date") == REPORT_DAY).select(
        "user_id", "event_type", "product_id", "price", "timestamp")


@query
def lag_from_reports(spark, folder):
    """Progress reports stored as JSON, one per event, to lag per group and topic."""
    offsets = lambda n: F.to_json(F.create_map(F.lit("clicks"), F.create_map((F.col("user_id") % 3).cast("string"), n)))
    done = F.col("event_id") * 2
    report = F.to_json(F.struct(
        F.lit("q").alias("id"), F.col("event_type").alias("name"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("timestamp"),
        F.array(F.struct(offsets(done).alias("endOffset"), offsets(done + F.col("event_id") % 50).alias("latestOffset"))).alias("sources")))
    reports = w.table(spark, folder, "events").select(report.alias("report"))
    return telemetry.lag_by_group(lag_samples(reports), span="1 hour")


@query
def draws_follow_weights(spark, folder):
    """One part in ten weighs fifty times as much: draws by weight class stay within six standard
    deviations of their share, and so do draws of users, who all weigh the same."""
    events = w.table(spark, folder, "events")
    slots = events.select(F.col("event_id").alias("slot"))
    parts = w.table(spark, folder, "part").select(
        F.col("p_partkey").alias("id"), F.when(F.col("p_partkey") % 10 == 0, 50).otherwise(1).alias("weight"))
    people = w.table(spark, folder, "customer").select(F.col("c_custkey").alias("id"), F.lit(1).alias("weight"))
    checked = None
    for kind, items, name in (("part", parts, "product"), ("user", people, "user")):
        drawn = synthesis.weighted_pick(slots, ["slot"], items, "id", F.col("weight"), name)
        group = F.when(F.lit(kind) == "part", F.col("weight")).otherwise(F.col("id") % 4).alias("class")
        share = items.groupBy(group).agg(F.sum("weight").alias("w"))
        whole, n = items.agg(F.sum("weight")).scalar(), slots.agg(F.count(F.lit(1))).scalar()
        got = (share.join(drawn.groupBy(group).agg(F.count(F.lit(1)).alias("draws")), "class", "left")
               .withColumn("n", n).withColumn("p", F.col("w") / whole))
        spread = 6 * F.sqrt(F.col("n") * F.col("p") * (1 - F.col("p"))) + 1
        near = F.abs(F.coalesce("draws", F.lit(0)) - F.col("n") * F.col("p")) <= spread
        one = got.select(F.lit(kind).alias("drawn"), F.col("class").cast("long").alias("class"), near.alias("plausible"))
        checked = one if checked is None else checked.unionByName(one)
    return checked
