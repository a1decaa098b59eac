from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

Instant = datetime | str | Column | None


def instant(as_of: Instant) -> Column:
    """``as_of`` as a timestamp column; None means the current time of the query."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of.cast("timestamp")
    return F.lit(str(as_of)).cast("timestamp")


def parse_invoice_date(text: Column) -> Column:
    """Month/day/year hour:minute, padded or not; null where the text is no such date."""
    return F.try_to_timestamp(text, F.lit("M/d/yyyy H:mm"))


def on_day(ts: Column, day: date | str) -> Column:
    """Half-open range over the bare column, so that the scan can skip files by min/max."""
    start = date.fromisoformat(str(day))
    end = start + timedelta(days=1)
    return (ts >= F.lit(str(start)).cast("timestamp")) & (ts < F.lit(str(end)).cast("timestamp"))


def day_partitions(df: DataFrame, first: Column, last: Column | None = None) -> DataFrame:
    """Limit to the day folders the raw event table is laid out in, where ``df`` has them.

    A filter on the timestamp alone cannot skip folders; this one can.
    """
    if "event_date" not in df.columns:
        return df
    day = F.col("event_date")
    inside = day >= F.to_date(first)
    return df.filter(inside if last is None else inside & (day <= F.to_date(last)))


def since(ts: Column, as_of: Instant, *, minutes: int = 0, hours: int = 0) -> Column:
    """At or after ``as_of`` minus the span; no upper bound."""
    return ts >= instant(as_of) - F.make_dt_interval(hours=F.lit(hours), mins=F.lit(minutes))


def on_day_of(ts: Column, as_of: Instant) -> Column:
    start = F.date_trunc("day", instant(as_of))
    return (ts >= start) & (ts < start + F.make_dt_interval(days=F.lit(1)))


def minute_label(ts: Column) -> Column:
    return F.date_format(ts, "MM-dd HH:mm")


def date_label(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def iso_text(ts: Column) -> Column:
    """ISO text; microseconds are written only where there are any."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.when(F.date_trunc("second", ts) == ts, whole).otherwise(micros)


def plus_minutes(ts: Column, minutes: Column) -> Column:
    return F.timestamp_add("MINUTE", minutes, ts)
