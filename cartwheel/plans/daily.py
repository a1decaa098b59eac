"""The daily job."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from cartwheel.operators.metrics import daily_metrics, daily_metrics_by_day, daily_report
from cartwheel.schemas import DAILY_METRICS
from cartwheel.sinks.files import upsert_daily


def run_day(raw_events: DataFrame, day: date | str, path: str) -> DataFrame:
    """Compute one day, store it over any earlier result for that day, return its report."""
    upsert_daily(daily_metrics(raw_events, day), path)
    stored = read_daily(raw_events.sparkSession, path)
    return daily_report(stored.filter(stored.metric_date == str(day)))


def backfill(raw_events: DataFrame, path: str) -> None:
    """Every day with events, in one pass."""
    upsert_daily(daily_metrics_by_day(raw_events), path)


def read_daily(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DAILY_METRICS).parquet(path)
