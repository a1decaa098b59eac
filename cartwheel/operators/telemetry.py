"""Queries over service telemetry held as tables.

``samples`` is (ts, metric, labels, value); a series is one metric with one set of labels.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from cartwheel.functions.text import container_name, matches_fully
from cartwheel.operators.ordering import exact_quantiles


def _seconds(span: str) -> int:
    number, unit = span.split()
    return int(number) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]


def _windowed(samples: DataFrame, span: str) -> DataFrame:
    """Samples with their window and series. The hash of the series stands first among sort
    keys: sorting compares one number where it would compare label lists."""
    return (samples.filter(F.col("ts").isNotNull() & F.col("value").isNotNull())
            .withColumn("window_start", F.window("ts", span).start)
            .withColumn("series", F.array_sort(F.map_entries("labels")))
            .withColumn("series_hash", F.xxhash64("metric", "series")))


def _grown(now: Column, before: Column) -> Column:
    """Increase of a counter; after a restart it has grown by its whole value."""
    return F.when(before.isNull(), F.lit(0.0)).when(now >= before, now - before).otherwise(now)


def counter_increases(samples: DataFrame, span: str = "1 minute") -> DataFrame:
    """Increase of each series in each window, restarts tolerated; no extrapolation.

    Samples are ordered inside cells of at most a minute of one series, however long the
    window, so a busy series is not one task's burden. The step from one cell to the next is
    taken between their last and first samples, from one row per cell.
    """
    seconds = _seconds(span)
    cell = "1 minute" if seconds % 60 == 0 else span
    series = ["series_hash", "window_start", "metric", "series"]
    when = F.struct("ts", "value")
    before = F.lag("value").over(Window.partitionBy(*series).orderBy("ts", "value"))
    per_cell = (_windowed(samples, cell)
                  .withColumn("_step", _grown(F.col("value"), before))
                  .groupBy(*series)
                  .agg(F.sum("_step").alias("_inside"),
                       F.min_by("value", when).alias("_first"),
                       F.max_by("value", when).alias("_last")))
    carried = F.lag("_last").over(Window.partitionBy("series_hash", "metric", "series").orderBy("window_start"))
    grown = per_cell.withColumn("increase", F.col("_inside") + _grown(F.col("_first"), carried))
    if cell != span:
        grown = (grown.withColumn("window_start", F.window("window_start", span).start)
                 .groupBy(*series).agg(F.sum("increase").alias("increase")))
    return grown.select("window_start", "metric", F.map_from_entries("series").alias("labels"),
                        "increase")


def counter_rate(samples: DataFrame, metric: str, by: Sequence[str], span: str = "1 minute") -> DataFrame:
    """Growth per second of a counter, summed over the series that share the labels ``by``."""
    grown = counter_increases(samples.filter(F.col("metric") == metric), span)
    return (grown.groupBy("window_start", *[F.col("labels")[b].alias(b) for b in by])
            .agg((F.sum("increase") / _seconds(span)).alias("rate")))


def histogram_quantile(rates: DataFrame, q: float, by: Sequence[str]) -> DataFrame:
    """Quantile from cumulative bucket rates (``le``, ``rate``), linear inside a bucket.

    If the quantile lies in the open bucket, the highest finite bound is the answer. Without
    an open bucket or without any observation there is no answer (null).
    """
    bound = F.when(F.col("le") == "+Inf", F.lit(float("inf"))).otherwise(F.col("le").cast("double"))
    up = Window.partitionBy(*by).orderBy("_le")
    so_far = up.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ladder = (rates.withColumn("_le", bound)
              .withColumn("_upto", F.max("rate").over(so_far))    # never falls from bucket to bucket
              .withColumn("_below", F.coalesce(F.lag("_upto").over(up), F.lit(0.0)))
              .withColumn("_from", F.lag("_le").over(up))
              .withColumn("_all", F.max(F.when(F.col("_le") == float("inf"), F.col("_upto")))
                          .over(Window.partitionBy(*by))))
    rank = F.col("_all") * q
    # the first bucket starts at 0, or is answered by its bound if that is not positive
    start = F.coalesce("_from", F.when(F.col("_le") > 0, F.lit(0.0)).otherwise(F.col("_le")))
    inside = start + (F.col("_le") - start) * (rank - F.col("_below")) / (F.col("_upto") - F.col("_below"))
    value = F.when(F.col("_le") == float("inf"), F.col("_from")).otherwise(inside)
    hit = (F.col("_all") > 0) & (F.col("_upto") >= rank) & (F.col("_upto") > F.col("_below"))
    return ladder.groupBy(*by).agg(F.min_by(F.when(hit, value), F.when(hit, F.col("_le"))).alias("quantile"))


def latency_quantile(samples: DataFrame, metric: str, q: float = 0.95, by: Sequence[str] = ("handler",),
                     span: str = "1 minute") -> DataFrame:
    """``histogram_quantile`` over the rates of a bucketed counter."""
    rates = counter_rate(samples, metric, ["le", *by], span)
    return histogram_quantile(rates, q, ["window_start", *by])


def error_rate(samples: DataFrame, metric: str, span: str = "1 minute") -> DataFrame:
    """Percent of requests answered with a 5xx status, per window; null without requests."""
    by_status = counter_rate(samples, metric, ["status"], span)
    failed = F.sum(F.when(matches_fully(F.col("status"), "5.."), F.col("rate")).otherwise(0.0))
    return by_status.groupBy("window_start").agg(
        F.try_divide(F.lit(100.0) * failed, F.sum("rate")).alias("error_percent"))


def with_labels(samples: DataFrame, wanted: dict[str, str] | None) -> DataFrame:
    """Only the series whose labels have the ``wanted`` values."""
    for label, value in (wanted or {}).items():
        samples = samples.filter(F.col("labels")[label] == value)
    return samples


def _latest(samples: DataFrame, metric: str, span: str) -> DataFrame:
    """Last value of each series in each window; of equal times the largest value."""
    return (_windowed(samples.filter(F.col("metric") == metric), span)
            .groupBy("series_hash", "window_start", "series")
            .agg(F.max_by("value", F.struct("ts", "value")).alias("value")))


def gauge_by_label(samples: DataFrame, metric: str, label: str, span: str = "1 minute",
                   where: dict[str, str] | None = None) -> DataFrame:
    """Value of a gauge per window and label value: the latest of each series, summed."""
    latest = _latest(with_labels(samples, where), metric, span)
    return (latest.groupBy("window_start", F.map_from_entries("series")[label].alias(label))
            .agg(F.sum("value").alias("value")))


def lag_by_group(samples: DataFrame, metric: str = "kafka_consumergroup_lag",
                 span: str = "1 minute") -> DataFrame:
    """Messages behind, per consumer group and topic: latest of each partition, summed."""
    latest = _latest(samples, metric, span)
    labels = F.map_from_entries("series")
    return (latest.groupBy("window_start", labels["consumergroup"].alias("consumergroup"),
                           labels["topic"].alias("topic"))
            .agg(F.sum("value").alias("lag")))


def container_logs(lines: DataFrame, pattern: str) -> DataFrame:
    """Log lines of the containers whose whole name matches ``pattern``."""
    return (lines.withColumn("container", container_name(F.col("container")))
            .filter(matches_fully(F.col("container"), pattern)))


def load_summary(requests: DataFrame, max_failed: float = 0.01, max_p95: float = 500.0) -> DataFrame:
    """p90, p95 and failure rate of (duration_ms, failed) rows, with verdicts. Runs a job."""
    times = exact_quantiles(requests, "duration_ms", {"p90": 0.90, "p95": 0.95})
    totals = requests.agg(F.count(F.lit(1)).alias("requests"),
                          F.avg(F.col("failed").cast("double")).alias("failed_rate"))
    # two tables of exactly one row each
    return (totals.withColumn("p90", times.select("p90").scalar())
            .withColumn("p95", times.select("p95").scalar())
            .withColumn("failed_ok", F.col("failed_rate") < max_failed)
            .withColumn("p95_ok", F.col("p95") < max_p95)
            .withColumn("passed", F.col("failed_ok") & F.col("p95_ok")))


def check_success(checks: DataFrame) -> DataFrame:
    """Share of passed checks by name, of (check, passed) rows."""
    return checks.groupBy("check").agg(
        F.count(F.lit(1)).alias("runs"), F.avg(F.col("passed").cast("double")).alias("success_rate"))
