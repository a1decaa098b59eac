"""Event streams and their wire format."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cartwheel.operators.events import validate_events
from cartwheel.schemas import EVENT_WIRE, EVENT_WIRE_TEXT


def kafka_source_options(servers: str, topic: str, **extra: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "subscribe": topic,
            "startingOffsets": "latest", **extra}


def read_event_stream(spark: SparkSession, servers: str, topic: str, **extra: str) -> DataFrame:
    """One topic as a stream, from now on. Needs the Kafka connector on the class path."""
    return spark.readStream.format("kafka").options(
        **kafka_source_options(servers, topic, **extra)).load()


def read_event_files(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "json",
                     files_per_trigger: int | None = None, **options: str) -> DataFrame:
    """Event files as a stream; the offline stand-in for the topic."""
    reader = spark.readStream.schema(schema).format(fmt).options(**options)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def _decoded(df: DataFrame, schema: StructType) -> DataFrame:
    return df.select(F.from_json(F.col("value").cast("string"), schema).alias("e")).select("e.*")


def decode_events(df: DataFrame) -> DataFrame:
    """``value`` bytes to event columns and ``event_time``; a bad record gives nulls."""
    return _decoded(df, EVENT_WIRE).withColumn(
        "event_time", F.try_to_timestamp(F.col("timestamp")))


def decode_events_as_text(df: DataFrame) -> DataFrame:
    """As ``decode_events`` but untyped, for validation that names the bad field."""
    return _decoded(df, EVENT_WIRE_TEXT)


def decode_checked(df: DataFrame) -> DataFrame:
    """``value`` bytes to typed event columns, ``event_time``, and ``reason`` and ``rejected_value``
    where a message is no valid event; ``raw`` keeps its text as it came.

    A field with a value that is not of its type is a reason, and so is a message that is no
    JSON object; a field may be absent. The time the source gives a message (``timestamp``, as
    topics do) is kept as ``ingest_time``. The one decoder of the live jobs.
    """
    ingest = [F.col("timestamp").alias("ingest_time")] if "timestamp" in df.columns else []
    schema = StructType([*EVENT_WIRE_TEXT.fields, StructField("_broken", StringType())])
    raw = F.col("value").cast("string")
    parsed = (df.select(raw.alias("raw"), *ingest, F.from_json(raw, schema, {
        "columnNameOfCorruptRecord": "_broken"}).alias("e"))
        .select("raw", *(["ingest_time"] if ingest else []), "e.*"))
    checked = validate_events(parsed)
    broken = F.col("raw").isNull() | F.col("_broken").isNotNull()
    return (checked.withColumn("reason", F.when(broken, "message unreadable").otherwise(F.col("reason")))
            .withColumn("event_time", F.col("timestamp")).drop("_broken", "timestamp"))
