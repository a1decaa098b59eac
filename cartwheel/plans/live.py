"""From messages to the live tables: the whole flow in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from cartwheel.sources.events import decode_checked, read_event_files, read_event_stream
from cartwheel.streaming.jobs import StreamFolders, start_all


def start_live(messages: DataFrame, folders: StreamFolders, once: bool = False) -> list[StreamingQuery]:
    """``raw_events``, ``product_stats`` and ``traffic_stats`` from a stream of messages (``value``).

    Messages are decoded and checked once, the same way for all three tables, so they count the
    same events; what is no valid event goes to ``rejected_events`` with its text and a reason.
    """
    return start_all(decode_checked(messages), folders, once)


def start_from_topic(spark: SparkSession, servers: str, topic: str, folders: StreamFolders,
                     **options: str) -> list[StreamingQuery]:
    return start_live(read_event_stream(spark, servers, topic, **options), folders)


def start_from_files(spark: SparkSession, path: str, folders: StreamFolders, once: bool = False,
                     files_per_trigger: int | None = None) -> list[StreamingQuery]:
    """Text files with a message on each line stand in for the topic."""
    messages = read_event_files(spark, path, "value string", "text", files_per_trigger)
    return start_live(messages, folders, once)
