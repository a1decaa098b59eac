"""The live jobs: raw events, product totals and minute traffic from one event stream."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from cartwheel.operators.events import default_event_time, split_valid, validate_events
from cartwheel.operators.metrics import product_stats, traffic_stats
from cartwheel.sinks.batches import append_raw, append_windows, write_batch
from cartwheel.operators.sketches import minute_sketches
from cartwheel.schemas import PRODUCT_STATS
from cartwheel.sinks.snapshots import publish_snapshot
from cartwheel.sinks.totals import RunningTotals

WATERMARK = "10 minutes"  # fixed value: how late an event may come


@dataclass(frozen=True)
class StreamFolders:
    """Where the jobs write, and how often. ``run`` names one life of the stream: after the source log was
    wiped, start with a new run, which brings new checkpoints and leaves old results alone."""

    root: str
    run: str = "main"
    every: str | None = None   # trigger interval, e.g. "10 seconds"; by default as fast as it goes

    def table(self, name: str) -> str:
        return f"{self.root}/tables/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/checkpoints/{self.run}/{name}"


def _start(df: DataFrame, folders: StreamFolders, name: str, mode: str, write,
           once: bool) -> StreamingQuery:
    writer = (df.writeStream.foreachBatch(write).outputMode(mode).queryName(f"{name}_{folders.run}")
              .option("checkpointLocation", folders.checkpoint(name)))
    if once:
        writer = writer.trigger(availableNow=True)
    elif folders.every:
        writer = writer.trigger(processingTime=folders.every)
    return writer.start()


def checked(events: DataFrame) -> DataFrame:
    """The events with a ``reason`` where they are invalid, as every job sees them. Frames from
    ``decode_checked`` are checked already."""
    return events if "reason" in events.columns else validate_events(events)


def valid_only(events: DataFrame) -> DataFrame:
    return split_valid(checked(events))[0]


def start_raw_events(events: DataFrame, folders: StreamFolders, once: bool = False) -> StreamingQuery:
    """Valid events to ``raw_events``; the others, with a reason, to ``rejected_events``.

    A missing time becomes the ingest time, an unreadable one is a reason to reject; a bad
    event never fails a batch. The ingest time is set in the stream itself, where it is part
    of the logged batch: a replayed batch gets the same one.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            valid, rejected = split_valid(batch)
            append_raw(valid, batch_id, folders.table("raw_events"), folders.run)
            write_batch(rejected, batch_id, folders.table("rejected_events"), folders.run)
        finally:
            batch.unpersist()

    return _start(default_event_time(checked(events), "event_time"), folders, "raw_events", "append",
                  write, once)


def start_product_stats(events: DataFrame, folders: StreamFolders, once: bool = False) -> StreamingQuery:
    """Running totals per product over valid events; each batch publishes the whole table as a snapshot.

    State has one row per product and lives in the state store.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        publish_snapshot(batch, folders.table("product_stats"), f"{folders.run}-{batch_id}")

    return _start(product_stats(valid_only(events)), folders, "product_stats", "complete", write, once)


def start_product_totals(events: DataFrame, folders: StreamFolders, once: bool = False) -> StreamingQuery:
    """The same totals, but each batch writes only the products it changed; see ``product_totals``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        product_totals(folders).write(batch, batch_id)

    return _start(product_stats(valid_only(events)), folders, "product_totals", "update", write, once)


def product_totals(folders: StreamFolders) -> RunningTotals:
    """Where this run's totals are kept, to be read."""
    return RunningTotals(f"{folders.table('product_totals')}/{folders.run}", PRODUCT_STATS, "product_id")


def start_traffic_sketches(events: DataFrame, folders: StreamFolders, once: bool = False) -> StreamingQuery:
    """Closed minutes with a sketch of their users, from which ``operators.sketches`` counts the users
    of any longer span."""
    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, batch_id, folders.table("traffic_sketches"), folders.run)

    return _start(minute_sketches(valid_only(events), WATERMARK), folders, "traffic_sketches", "append", write, once)


def start_traffic_stats(events: DataFrame, folders: StreamFolders, once: bool = False) -> StreamingQuery:
    """Minute windows of valid events, each written once the watermark has passed its end."""
    def write(batch: DataFrame, batch_id: int) -> None:
        append_windows(batch, batch_id, folders.table("traffic_stats"), folders.run)

    return _start(traffic_stats(valid_only(events), watermark=WATERMARK), folders, "traffic_stats", "append",
                  write, once)


def timed(events: DataFrame) -> DataFrame:
    """Events without a time get that of their message (``ingest_time``), or where the source has
    none, the time of their batch."""
    ingest = F.col("ingest_time") if "ingest_time" in events.columns else F.current_timestamp()
    return events.withColumn("event_time", F.coalesce("event_time", ingest)).drop("ingest_time")


def start_all(events: DataFrame, folders: StreamFolders, once: bool = False) -> list[StreamingQuery]:
    """The three jobs over one stream; each reads and decodes the source on its own and keeps its
    own place in it. Missing times are filled before, so all of them count the same events."""
    events = timed(checked(events))
    return [start(events, folders, once)
            for start in (start_raw_events, start_product_stats, start_traffic_stats)]


def await_any(spark: SparkSession, queries: list[StreamingQuery]) -> None:
    """Block until one job ends or fails, then stop the others."""
    spark.streams.awaitAnyTermination()
    for query in queries:
        query.stop()
