from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from cartwheel.functions.times import iso_text


def to_messages(events: DataFrame) -> DataFrame:
    """Key and JSON value of each event.

    The key is the user id as text, so that a user's events stay in one topic partition and
    in order; anonymous events have no key. Missing fields are written as JSON null.
    """
    body = F.struct("user_id", "event_type", "product_id", "price",
                    iso_text(F.col("event_time")).alias("timestamp"))
    return events.select(F.col("user_id").cast("string").alias("key"),
                         F.to_json(body, {"ignoreNullFields": "false"}).alias("value"))


def kafka_sink_options(servers: str, topic: str) -> dict[str, str]:
    # kafka.* options go to the producer: wait for all replicas, try three times
    return {"kafka.bootstrap.servers": servers, "topic": topic,
            "kafka.acks": "all", "kafka.retries": "3"}


def start_publishing(events: DataFrame, servers: str, topic: str, checkpoint: str) -> StreamingQuery:
    """Send a stream of events on to a topic."""
    return (to_messages(events).writeStream.format("kafka")
            .options(**kafka_sink_options(servers, topic))
            .option("checkpointLocation", checkpoint).start())


def publish_events(events: DataFrame, servers: str, topic: str) -> None:
    to_messages(events).write.format("kafka").options(**kafka_sink_options(servers, topic)).save()
