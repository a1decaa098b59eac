"""Event validation, identity and repair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cartwheel.functions.draws import content_hash
from cartwheel.functions.times import Instant, instant, iso_text
from cartwheel.schemas import EVENT_TYPES

_TYPED = {"user_id": "bigint", "price": "double", "timestamp": "timestamp"}


def _as(name: str, kind: str) -> Column:
    """The field as its type, or null. A whole number may be written as 17850.0."""
    value = F.col(name)
    if kind != "bigint":
        return value.try_cast(kind)
    number = value.try_cast("double")
    return F.coalesce(value.try_cast(kind),
                      F.when(number == F.floor(number), number.try_cast(kind)))


def validate_events(df: DataFrame) -> DataFrame:
    """Typed events with a ``reason``, null where the event is valid.

    Fields may come as text. A field that has a value but not one of its type, an unknown
    type and a missing type are reasons; any other field may be absent. Values that do not
    fit stay readable in ``rejected_value``.
    """
    reason: Column = F.lit(None).cast("string")
    value: Column = F.lit(None).cast("string")
    checks = [("event_type", F.col("event_type").isNull(), "event_type missing"),
              ("event_type", ~F.col("event_type").isin(*EVENT_TYPES), "event_type unknown")]
    for name, kind in _TYPED.items():
        if name in df.columns:
            bad = F.col(name).isNotNull() & _as(name, kind).isNull()
            checks.append((name, bad, f"{name} malformed"))
    for name, bad, why in reversed(checks):   # the first check listed wins
        reason = F.when(bad, why).otherwise(reason)
        value = F.when(bad, F.col(name).cast("string")).otherwise(value)
    typed = {n: _as(n, k) for n, k in _TYPED.items() if n in df.columns}
    return (df.withColumn("reason", reason).withColumn("rejected_value", value)
              .withColumns(typed))


def split_valid(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) of ``validate_events``; rejected rows keep their reason."""
    return (checked.filter(F.col("reason").isNull()).drop("reason", "rejected_value"),
            checked.filter(F.col("reason").isNotNull()))


def default_event_time(df: DataFrame, column: str = "timestamp", as_of: Instant = None) -> DataFrame:
    """Fill a missing event time with the ingest time."""
    return df.withColumn(column, F.coalesce(F.col(column), instant(as_of)))


def resolve_identity(df: DataFrame, users: DataFrame, auth: str = "auth_user_id") -> DataFrame:
    """The authenticated user, if known, replaces the user id in the payload.

    Anonymous events would all meet in one task on their null key, so each gets a filler key
    from its content that only spreads them; the join condition keeps fillers from matching
    anyone.
    """
    known = users.select(F.col("user_id").alias("_known"))
    return (df.withColumn("_key", F.coalesce(F.col(auth), content_hash(df)))
              .join(known, (F.col("_key") == F.col("_known")) & F.col(auth).isNotNull(), "left")
              .withColumn("user_id", F.coalesce("_known", "user_id"))
              .drop("_key", "_known", auth))


def clean_event_row(df: DataFrame) -> DataFrame:
    """Wire form of a logged event: NaN to null, whole user id, ISO time text."""
    def known(name: str) -> Column:
        return F.when(~F.isnan(F.col(name).cast("double")), F.col(name))
    return df.select(known("user_id").cast("long").alias("user_id"), "event_type", "product_id",
                     known("price").alias("price"),
                     iso_text(F.col("timestamp")).alias("timestamp"))


def has_product(df: DataFrame) -> DataFrame:
    return df.filter(F.col("product_id").isNotNull())
