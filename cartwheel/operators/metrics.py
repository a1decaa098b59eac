"""Activity, conversion and revenue aggregates; the same code serves batch and streams."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from cartwheel.functions.money import purchase_price, ratio_or_zero
from cartwheel.functions.text import percent, won
from cartwheel.functions.times import (Instant, date_label, day_partitions, instant, on_day,
                                       on_day_of, since)


def _count_type(name: str) -> Column:
    return F.count_if(F.col("event_type") == name)


def _revenue() -> Column:
    return F.sum(purchase_price(F.col("event_type"), F.col("price")))


def product_stats(events: DataFrame) -> DataFrame:
    """Views, purchases and revenue per product, over events that have a product."""
    return (events.filter(F.col("product_id").isNotNull()).groupBy("product_id")
            .agg(_count_type("view").alias("view_count"),
                 _count_type("purchase").alias("purchase_count"),
                 _revenue().alias("revenue")))


def traffic_stats(events: DataFrame, exact: bool = False, watermark: str | None = None) -> DataFrame:
    """Users, events and revenue per minute; events without a time are left out.

    Users are estimated as in the live job, by a sketch that has few users practically one by one
    and of many a standard error of 1.6 %; ``exact`` counts them (batch only). On a stream give the
    ``watermark``, after which a minute is closed.
    """
    if watermark:
        events = events.withWatermark("event_time", watermark)
    users = F.count_distinct("user_id") if exact else F.hll_sketch_estimate(F.hll_sketch_agg("user_id", F.lit(12)))
    return (events.groupBy(F.window("event_time", "1 minute"))
            .agg(users.alias("unique_users"),
                 F.count(F.lit(1)).alias("event_count"),
                 _revenue().alias("revenue"))
            .select(F.col("window.start").alias("window_start"),
                    F.col("window.end").alias("window_end"),
                    "unique_users", "event_count", "revenue"))


def _activity() -> list[Column]:
    paid = F.when(F.col("event_type") == "purchase", F.col("price"))
    return [F.count_distinct("user_id").alias("dau"),
            _count_type("view").alias("view_count"),
            _count_type("purchase").alias("purchase_count"),
            F.coalesce(F.sum(paid), F.lit(0.0)).alias("revenue"),
            F.count(F.lit(1)).alias("event_count")]


def _with_conversion(measured: DataFrame) -> DataFrame:
    rate = ratio_or_zero(F.col("purchase_count"), F.col("view_count"))
    return measured.select("metric_date", "dau", "view_count", "purchase_count",
                           rate.alias("conversion_rate"), "revenue", "event_count")


def daily_metrics(raw_events: DataFrame, day: date | str) -> DataFrame:
    """One row for ``day``, of zeros if nothing happened. Anonymous users do not count as active."""
    one = events_on_day(raw_events, day).agg(*_activity())
    return _with_conversion(one.withColumn("metric_date", F.lit(str(day)).cast("date")))


def daily_metrics_by_day(raw_events: DataFrame) -> DataFrame:
    """The same measures for every day that has events, for backfill."""
    return _with_conversion(
        raw_events.groupBy(F.to_date("timestamp").alias("metric_date")).agg(*_activity()))


def conversion_rate(purchases: Column, views: Column) -> Column:
    return ratio_or_zero(purchases, views)


def in_last(df: DataFrame, minutes: int, as_of: Instant = None, column: str = "timestamp") -> DataFrame:
    start = instant(as_of) - F.make_dt_interval(mins=F.lit(minutes))
    return day_partitions(df, start).filter(since(F.col(column), as_of, minutes=minutes))


def keep_recent(df: DataFrame, hours: int = 168, as_of: Instant = None, column: str = "ts") -> DataFrame:
    """Rows inside the retention period."""
    return df.filter(since(F.col(column), as_of, hours=hours))


def events_on_day(df: DataFrame, day: date | str, column: str = "timestamp") -> DataFrame:
    at = F.lit(str(day))
    return day_partitions(df, at, at).filter(on_day(F.col(column), day))


def purchases_today(raw_events: DataFrame, as_of: Instant = None) -> DataFrame:
    at = instant(as_of)
    return day_partitions(raw_events, at, at).filter(
        (F.col("event_type") == "purchase") & on_day_of(F.col("timestamp"), as_of))


def current_visitors(raw_events: DataFrame, minutes: int = 5, as_of: Instant = None) -> DataFrame:
    return in_last(raw_events, minutes, as_of).agg(F.count_distinct("user_id").alias("visitors"))


def revenue_today(raw_events: DataFrame, as_of: Instant = None) -> DataFrame:
    return purchases_today(raw_events, as_of).agg(
        F.coalesce(F.sum("price"), F.lit(0.0)).alias("revenue"))


def recent_event_total(traffic: DataFrame) -> DataFrame:
    return traffic.agg(F.coalesce(F.sum("event_count"), F.lit(0)).alias("recent_events"))


def event_type_counts(events: DataFrame) -> DataFrame:
    """Events per type, most frequent first."""
    return (events.groupBy("event_type").agg(F.count(F.lit(1)).alias("event_count"))
            .orderBy(F.desc("event_count"), "event_type"))


def event_span(events: DataFrame, column: str = "timestamp") -> DataFrame:
    """First and last time, and whole minutes between."""
    ends = events.agg(F.min(column).alias("first_at"), F.max(column).alias("last_at"))
    return ends.withColumn("span_minutes",
                           F.timestamp_diff("MINUTE", F.col("first_at"), F.col("last_at")))


def daily_report(daily: DataFrame) -> DataFrame:
    """One text per measure and day: thousands separators, percent, two decimals."""
    count = lambda name: F.format_number(F.col(name), 0)
    rate = percent(F.bround("conversion_rate", 4), 2)
    texts = {"date": date_label(F.col("metric_date")), "dau": count("dau"),
             "view_count": count("view_count"), "purchase_count": count("purchase_count"),
             "conversion_rate": rate, "revenue": F.format_number("revenue", 2),
             "event_count": count("event_count")}
    return (daily.select("metric_date", *[c.alias(f"_{n}") for n, c in texts.items()])
            .select("metric_date", F.expr(
                f"stack({len(texts)}, " + ", ".join(f"'{n}', _{n}" for n in texts)
                + ") AS (measure, text)")))


def daily_cards(latest: DataFrame) -> DataFrame:
    """Headline texts of a day: users, conversion to one decimal, revenue in won, events."""
    return latest.select(
        date_label(F.col("metric_date")).alias("metric_date"),
        F.col("dau").cast("string").alias("dau"),
        percent(F.col("conversion_rate"), 1).alias("conversion_rate"),
        won(F.col("revenue")).alias("revenue"),
        F.format_number("event_count", 0).alias("event_count"))
