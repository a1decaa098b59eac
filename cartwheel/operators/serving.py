"""Queries behind the catalog pages and the dashboard."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cartwheel.functions.draws import content_hash
from cartwheel.functions.text import contains_ci
from cartwheel.functions.times import Instant, since
from cartwheel.operators.metrics import traffic_stats
from cartwheel.operators.ordering import rows_between

FALLBACK_WINDOWS = 60  # fixed value: windows shown when none is recent


def by_popularity(products: DataFrame) -> DataFrame:
    """Most bought first; equal counts by id, so that pages do not overlap."""
    return products.orderBy(F.desc("total_purchase_count"), "product_id")


def search_products(products: DataFrame, text: str | None) -> DataFrame:
    return products.filter(contains_ci(F.col("description"), text))


def page(rows: DataFrame, order: list[str], skip: int = 0, limit: int = 20) -> DataFrame:
    """Rows ``skip`` to ``skip + limit`` by ``order``, however far down they lie."""
    if skip < 0 or not 1 <= limit <= 100:
        raise ValueError("skip must be 0 or more and limit from 1 to 100")
    return rows_between(rows, order, skip, skip + limit)


def list_products(products: DataFrame, skip: int = 0, limit: int = 20,
                  search: str | None = None) -> DataFrame:
    found = search_products(products, search).withColumn(
        "_rank", F.coalesce(-F.col("total_purchase_count").cast("long"), F.lit(1 << 62)))
    return page(found, ["_rank", "product_id"], skip, limit).drop("_rank")


def lookup(df: DataFrame, key: str, value) -> DataFrame:
    """The row with this key, or none."""
    return df.filter(F.col(key) == value).limit(1)


def name_products(stats: DataFrame, products: DataFrame) -> DataFrame:
    """Statistics with the product description; unknown products keep a null one."""
    return (stats.join(products.select("product_id", "description"), "product_id", "left")
            .select("product_id", "description", "view_count", "purchase_count", "revenue"))


def _best_first(stats: DataFrame) -> DataFrame:
    return stats.orderBy(F.desc("purchase_count"), F.desc("view_count"), "product_id")


def top_products(stats: DataFrame, products: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most bought products, named.

    A product id names at most one product, so the top ``n`` are settled before the join and
    only ``n`` rows meet the catalog.
    """
    return _best_first(name_products(_best_first(stats).limit(n), products))


def recent_traffic(traffic: DataFrame, minutes: int = 60, as_of: Instant = None) -> DataFrame:
    """Minutes since ``as_of`` less ``minutes``; if there is none, the last 60 there are."""
    shown = traffic.select("window_start", "unique_users", "event_count", "revenue")
    is_recent = since(F.col("window_start"), as_of, minutes=minutes)
    recent = shown.filter(is_recent)
    none_recent = recent.agg(F.count(F.lit(1)) == 0).scalar()
    last = (shown.orderBy(F.desc("window_start")).limit(FALLBACK_WINDOWS)
            .filter(none_recent))
    return recent.unionByName(last).orderBy("window_start")


def recent_traffic_of_events(events: DataFrame, minutes: int = 60, as_of: Instant = None, exact: bool = False) -> DataFrame:
    """What ``recent_traffic`` shows, from events: only those of the minutes shown are counted.

    Where the first of these minutes lies is asked first, of the times alone: of the recent events, or, if
    there are none, of the last minutes that have any. The events are then read from there on.
    """
    minute = F.date_trunc("minute", "event_time")
    is_recent = since(F.col("event_time"), as_of, minutes=minutes)      # bounds the scan
    begun = events.filter(is_recent).select(minute.alias("m")).filter(since(F.col("m"), as_of, minutes=minutes))
    last = (events.filter(F.col("event_time").isNotNull()).select(minute.alias("m")).distinct()
            .orderBy(F.desc("m")).limit(FALLBACK_WINDOWS))
    first = F.coalesce(begun.agg(F.min("m")).scalar(), last.agg(F.min("m")).scalar())
    counted = traffic_stats(events.filter(F.col("event_time") >= first), exact=exact)
    return counted.select("window_start", "unique_users", "event_count", "revenue").orderBy("window_start")


def daily_trend(daily: DataFrame, n: int = 30, newest_first: bool = False) -> DataFrame:
    """The latest ``n`` days, oldest first for charts or newest first for the table."""
    latest = daily.orderBy(F.desc("metric_date")).limit(n)
    return latest if newest_first else latest.orderBy("metric_date")


def latest_day(daily: DataFrame) -> DataFrame:
    row = F.max_by(F.struct(*daily.columns), "metric_date").alias("latest")
    return daily.agg(row).filter(F.col("latest").isNotNull()).select("latest.*")


def time_ordered(events: DataFrame, column: str = "timestamp") -> DataFrame:
    """By time. Events of one instant follow in the order of a hash of their content, which
    lets them be spread over the sort's ranges instead of all falling into one."""
    return events.orderBy(column, content_hash(events))
