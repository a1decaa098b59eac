"""What the dashboard shows, as one set of frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cartwheel.functions.times import Instant, date_label, minute_label
from cartwheel.operators import metrics, serving


def live(raw_events: DataFrame, stats: DataFrame, traffic: DataFrame, products: DataFrame,
         as_of: Instant = None) -> dict[str, DataFrame]:
    shown = serving.recent_traffic(traffic, 60, as_of)
    return {
        "current_visitors": metrics.current_visitors(raw_events, 5, as_of),
        "revenue_today": metrics.revenue_today(raw_events, as_of),
        "recent_events": metrics.recent_event_total(shown),
        "top_products": serving.top_products(stats, products, 10),
        "traffic": shown.withColumn("minute", minute_label(F.col("window_start"))),
    }


def daily(daily_metrics: DataFrame) -> dict[str, DataFrame]:
    return {
        "latest": serving.latest_day(daily_metrics),
        "cards": metrics.daily_cards(serving.latest_day(daily_metrics)),
        "chart": serving.daily_trend(daily_metrics, 30)
                        .withColumn("day", date_label(F.col("metric_date"))),
        "table": serving.daily_trend(daily_metrics, 30, newest_first=True),
    }
