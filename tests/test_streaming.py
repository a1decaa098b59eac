from __future__ import annotations

import json
import os
import time

from cartwheel.operators import metrics, telemetry
from cartwheel.schemas import PRODUCT_STATS, RAW_EVENTS
from cartwheel.operators.events import split_valid
from cartwheel.plans.live import start_live
from cartwheel.sinks.batches import (BatchTable, append_raw, append_windows, compact_days, raw_table, read_raw,
                                     windows_table)
from cartwheel.sinks.snapshots import publish_snapshot, read_snapshot
from cartwheel.sources.events import decode_checked, decode_events, read_event_files
from cartwheel.sources.tables import ensure_tables, refresh_tables
from cartwheel.streaming import jobs, replay
from cartwheel.streaming.progress import lag_samples
from conftest import at, rows


class Topic:
    """A folder of text files, each line one message; files are taken in order of their time."""

    def __init__(self, path):
        self.path, self.count, self.start = path, 0, time.time() - 10000
        os.makedirs(path)

    def send(self, *messages):
        name = os.path.join(self.path, f"{self.count:04d}.txt")
        with open(name, "w") as out:
            out.write("\n".join(m if isinstance(m, str) else json.dumps(m) for m in messages) + "\n")
        self.count += 1
        os.utime(name, (self.start + self.count, self.start + self.count))

    def stream(self, spark):
        raw = read_event_files(spark, str(self.path), "value string", "text", files_per_trigger=1)
        return decode_events(raw)

    def messages(self, spark):
        return read_event_files(spark, str(self.path), "value string", "text", files_per_trigger=1)


def event(when, kind="view", user=1, product="A", price=1.0):
    return {"user_id": user, "event_type": kind, "product_id": product, "price": price,
            "timestamp": when and f"2024-01-01T{when}"}


def test_late_events(spark, tmp_path):
    topic = Topic(tmp_path / "topic")
    topic.send(event("00:00:10"), event("00:00:50", user=2), event(None))
    topic.send(event("00:20:00"))
    topic.send(event("00:00:20", user=3), event("00:40:00"))   # late, but the watermark lags a batch
    topic.send(event("00:00:30", user=4), event("01:00:00"))   # too late: dropped
    folders = jobs.StreamFolders(str(tmp_path / "out"))
    jobs.start_traffic_stats(topic.stream(spark), folders, once=True).awaitTermination()
    got = sorted((r.window_start, r.unique_users, r.event_count) for r in
                 spark.read.parquet(folders.table("traffic_stats")).collect())
    assert got == [(at("2024-01-01 00:00"), 3, 3), (at("2024-01-01 00:20"), 1, 1),
                   (at("2024-01-01 00:40"), 1, 1)]   # the minute at 01:00 is still open


def test_three_jobs_equal_batch_and_survive_restart(spark, tmp_path):
    topic = Topic(tmp_path / "topic")
    topic.send(event("00:00:10"), event("00:00:11", "purchase", price=5.0), "{broken",
               event("00:01:00", "click"), event("soon"), event("00:01:30", user="abc"),
               event("00:01:31", price="zzz"))
    folders = jobs.StreamFolders(str(tmp_path / "out"))

    def run():
        queries = start_live(topic.messages(spark), folders, once=True)
        for q in queries:
            q.awaitTermination()

    run()
    topic.send(event("00:02:00", "purchase", user=None, product="B", price=7.0), event(None, "login"))
    run()
    run()   # nothing new

    raw = spark.read.parquet(folders.table("raw_events"))
    assert sorted(r.event_type for r in raw.collect()) == ["login", "purchase", "purchase", "view"]
    assert raw.filter("timestamp is null").count() == 0
    rejected = spark.read.parquet(folders.table("rejected_events")).collect()
    assert sorted(r.reason for r in rejected) == ["event_type unknown", "message unreadable", "price malformed",
                                                  "timestamp malformed", "user_id malformed"]
    assert [r.raw for r in rejected if r.reason == "message unreadable"] == ["{broken"]
    assert {r.rejected_value for r in rejected} >= {"abc", "zzz", "2024-01-01Tsoon", "click"}

    batch = split_valid(decode_checked(spark.read.text(str(tmp_path / "topic"))))[0]
    stored = read_snapshot(spark, folders.table("product_stats"), PRODUCT_STATS)
    assert rows(stored) == rows(metrics.product_stats(batch)) == [("A", 1, 1, 5.0), ("B", 0, 1, 7.0)]

    topic.send(event("00:30:00"))
    topic.send(event("00:31:00"))
    run()
    per_minute = {r.window_start: r.event_count for r in spark.read.parquet(folders.table("traffic_stats")).collect()}
    raw = [r.timestamp.replace(second=0) for r in spark.read.parquet(folders.table("raw_events")).collect()]
    assert per_minute and all(raw.count(minute) == n for minute, n in per_minute.items())
    assert at("2024-01-01 00:01") not in per_minute     # it had invalid events only


def test_days_are_compacted_once(spark, tmp_path):
    path = str(tmp_path / "raw")
    day = lambda d, n: spark.createDataFrame([(i, "view", "A", 1.0, at(f"2024-01-0{d} 10:00")) for i in range(n)],
                                             RAW_EVENTS).withColumnRenamed("timestamp", "event_time")
    for batch_id in range(4):
        append_raw(day(1, 3).unionByName(day(2, 2)), batch_id, path, "main")
    before = rows(read_raw(spark, path))
    assert compact_days(spark, path, "2024-01-02") == ["2024-01-01"]
    assert compact_days(spark, path, "2024-01-02") == []        # nothing new, nothing written
    assert rows(read_raw(spark, path)) == before and len(before) == 20
    append_raw(day(2, 1), 4, path, "main")
    assert read_raw(spark, path).count() == 21


def raw_day(spark, day, n, start=0):
    made = [(i, "view", "A", 1.0, at(f"2024-01-0{day} 10:00")) for i in range(start, start + n)]
    return spark.createDataFrame(made, RAW_EVENTS).withColumnRenamed("timestamp", "event_time")


def pieces(path):
    found = {}
    for root, _, files in os.walk(f"{path}_merged/data"):
        for f in files:
            if f.endswith(".parquet"):
                found.setdefault(os.path.basename(root), []).append((root, f, os.stat(f"{root}/{f}").st_mtime_ns))
    return {day: sorted(files) for day, files in found.items()}


def test_late_rows_of_a_merged_day_are_seen_and_taken_in(spark, tmp_path):
    path = str(tmp_path / "raw")
    for batch_id in range(3):
        append_raw(raw_day(spark, 1, 4, 10 * batch_id).unionByName(raw_day(spark, 2, 3, 10 * batch_id)), batch_id, path, "main")
    reader = read_raw(spark, path)                         # open before the merge
    compact_days(spark, path, "2024-01-03")
    first = pieces(path)
    append_raw(raw_day(spark, 1, 5, 100), 3, path, "main")     # late
    assert read_raw(spark, path).count() == 26             # at once
    append_raw(raw_day(spark, 1, 5, 100), 3, path, "main")     # delivered again
    assert compact_days(spark, path, "2024-01-03") == ["2024-01-01"]
    assert rows(read_raw(spark, path).groupBy("event_date").count()) == [(at("2024-01-01").date(), 17), (at("2024-01-02").date(), 9)]
    later = pieces(path)
    assert later["event_date=2024-01-02"] == first["event_date=2024-01-02"]                   # not touched
    assert set(first["event_date=2024-01-01"]) < set(later["event_date=2024-01-01"])    # one more piece
    assert reader.count() == 21
    append_raw(raw_day(spark, 1, 2, 200), 0, path, "second")      # another life counts from 0
    assert read_raw(spark, path).count() == 28

    raw_table(path).forget(spark, keep_hours=0.0)
    assert read_raw(spark, path).count() == 28
    assert spark.read.parquet(path).count() == 2           # the merged batches are gone
    plan = read_raw(spark, path).filter("event_date = date'2024-01-02'")._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: ")[1:]
    assert len(filters) == 2 and all("isnotnull(event_date" in f[:f.index("PushedFilters")] for f in filters)


def test_a_batch_in_the_middle_of_its_write_is_not_merged(spark, tmp_path):
    path = str(tmp_path / "raw")
    append_raw(raw_day(spark, 1, 3), 0, path, "main")
    half = raw_day(spark, 1, 2, 50).withColumnRenamed("event_time", "timestamp")
    half.write.parquet(f"{path}/event_date=2024-01-01/run=main/batch_id=1")      # no mark yet
    compact_days(spark, path, "2024-01-02")
    assert read_raw(spark, path).count() == 5
    append_raw(raw_day(spark, 1, 4, 50), 1, path, "main")
    assert read_raw(spark, path).count() == 7
    compact_days(spark, path, "2024-01-02")
    assert read_raw(spark, path).count() == 7


def test_many_pieces_are_gathered_again(spark, tmp_path):
    path = str(tmp_path / "raw")
    for batch_id in range(10):
        append_raw(raw_day(spark, 1, 2, 10 * batch_id), batch_id, path, "main")
        compact_days(spark, path, "2024-01-02")
    assert read_raw(spark, path).count() == 20
    raw_table(path).forget(spark, keep_hours=0.0)
    assert len(pieces(path)["event_date=2024-01-01"]) == 2       # nine gathered, one on top
    assert read_raw(spark, path).count() == 20


def test_one_large_day_is_written_by_several_tasks(spark, tmp_path):
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "100000")
    try:
        big = spark.range(100_000).selectExpr("id AS user_id", "'view' AS event_type", "cast(rand(1) AS string) AS product_id",
                                              "1.0D AS price", "timestamp'2024-01-01' AS event_time")
        append_raw(big, 0, str(tmp_path / "raw"), "main")
    finally:
        spark.conf.unset(size)
    assert len([f for f in os.listdir(tmp_path / "raw/event_date=2024-01-01/run=main/batch_id=0") if f.endswith(".parquet")]) > 3
    assert read_raw(spark, str(tmp_path / "raw")).count() == 100_000


def test_windows_and_rejects_are_merged_too(spark, tmp_path):
    path = str(tmp_path / "windows")
    stored = windows_table(path)
    assert stored.read(spark).count() == 0
    for n in range(4):
        append_windows(spark.createDataFrame([(at(f"2024-01-01 00:0{n}"), at(f"2024-01-01 00:0{n + 1}"), n, n, 0.0)], stored.fields), n, path, "main")
    append_windows(spark.createDataFrame([], stored.fields), 4, path, "main")        # an empty batch leaves nothing
    before = rows(stored.read(spark))
    assert stored.merge(spark) == [""] and stored.merge(spark) == []
    stored.forget(spark, keep_hours=0.0)
    assert rows(stored.read(spark)) == before and len(before) == 4
    assert not any(f.endswith(".parquet") for _, _, files in os.walk(path) for f in files)
    other = BatchTable(str(tmp_path / "any"), spark.range(1).schema)
    other.append(spark.range(5), 0, "a")
    other.merge(spark)
    assert other.read(spark).count() == 5


def test_missing_times_are_filled_before_all_jobs(spark, tmp_path):
    """An event without a time counts in its message's minute, in both tables."""
    lines = [(json.dumps(event(None)), at("2024-01-01 00:00:20")), (json.dumps(event("00:00:50")), at("2024-01-01 00:01:10")),
             (json.dumps(event("00:30:00")), at("2024-01-01 00:30:01"))]
    spark.createDataFrame(lines, "value string, timestamp timestamp").write.parquet(str(tmp_path / "topic"))
    stream = spark.readStream.schema("value string, timestamp timestamp").parquet(str(tmp_path / "topic"))
    folders = jobs.StreamFolders(str(tmp_path / "out"))
    for q in start_live(stream, folders, once=True):
        q.awaitTermination()
    assert sorted(r.timestamp for r in read_raw(spark, folders.table("raw_events")).collect()) == [
        at("2024-01-01 00:00:20"), at("2024-01-01 00:00:50"), at("2024-01-01 00:30")]
    assert [(r.window_start, r.event_count) for r in windows_table(folders.table("traffic_stats")).read(spark).collect()] == [
        (at("2024-01-01 00:00"), 2)]


def test_tables_show_what_the_sinks_wrote(spark, tmp_path):
    folders = jobs.StreamFolders(str(tmp_path / "out"))
    df = spark.createDataFrame([(1, "view", "A", 1.0, at("2024-01-01"))], RAW_EVENTS).withColumnRenamed("timestamp", "event_time")
    append_raw(df, 0, folders.table("raw_events"), "main")
    spark.sql("CREATE DATABASE IF NOT EXISTS live_shop")
    assert {"raw_events", "traffic_stats"} <= set(ensure_tables(spark, "live_shop", folders.root))
    assert spark.table("live_shop.raw_events").count() == 1
    append_raw(df, 1, folders.table("raw_events"), "main")
    refresh_tables(spark, "live_shop")
    assert spark.table("live_shop.raw_events").filter("event_date = '2024-01-01'").count() == 2


def test_a_batch_delivered_twice_is_stored_once(spark, tmp_path):
    df = spark.createDataFrame([(1, "view", "A", 1.0, at("2024-01-01")), (2, "view", "A", 1.0, at("2024-01-02"))],
                               RAW_EVENTS).withColumnRenamed("timestamp", "event_time")
    path = str(tmp_path / "raw")
    for batch_id in (0, 0, 1, 0):
        append_raw(df, batch_id, path, "main")
    assert spark.read.parquet(path).count() == 4
    append_raw(df, 0, path, "second-life")   # a new life counts from 0 and keeps the old rows
    assert spark.read.parquet(path).count() == 6
    assert spark.read.parquet(path).filter("event_date = '2024-01-01'").count() == 3


def test_snapshots(spark, tmp_path):
    base = str(tmp_path / "stats")
    assert read_snapshot(spark, base, PRODUCT_STATS).count() == 0

    def version(n):
        return spark.createDataFrame([("A", n, 0, 0.0)], PRODUCT_STATS)

    for n in range(5):
        assert publish_snapshot(version(n), base, f"main-{n}")
    assert rows(read_snapshot(spark, base, PRODUCT_STATS)) == [("A", 4, 0, 0.0)]
    assert not publish_snapshot(version(99), base, "main-4")
    assert len(os.listdir(base)) == 5   # young versions stay, however many

    # a write that broke off: no _SUCCESS, so readers do not see it and the next one clears it
    os.makedirs(f"{base}/version={6:012d}-main-5")
    assert rows(read_snapshot(spark, base, PRODUCT_STATS)) == [("A", 4, 0, 0.0)]
    publish_snapshot(version(5), base, "main-5")
    assert rows(read_snapshot(spark, base, PRODUCT_STATS)) == [("A", 5, 0, 0.0)]
    assert all(os.path.exists(f"{base}/{d}/_SUCCESS") for d in os.listdir(base))


def test_a_reader_keeps_its_version_while_the_next_is_published(spark, tmp_path):
    base = str(tmp_path / "stats")
    publish_snapshot(spark.createDataFrame([("A", 1, 0, 0.0)], PRODUCT_STATS), base, "1")
    reader = read_snapshot(spark, base, PRODUCT_STATS)
    publish_snapshot(spark.createDataFrame([("A", 2, 0, 0.0)], PRODUCT_STATS), base, "2")
    assert rows(reader) == [("A", 1, 0, 0.0)]


def test_versions_go_by_age_not_by_number(spark, tmp_path):
    base = str(tmp_path / "stats")
    version = lambda n: spark.createDataFrame([("A", n, 0, 0.0)], PRODUCT_STATS)
    publish_snapshot(version(0), base, "0")
    reader = read_snapshot(spark, base, PRODUCT_STATS)
    for n in range(1, 11):
        publish_snapshot(version(n), base, str(n))
    assert rows(reader) == [("A", 0, 0, 0.0)]      # ten publications later
    publish_snapshot(version(11), base, "11", keep_hours=0.0)
    assert sorted(int(d.split("-")[1]) for d in os.listdir(base)) == [10, 11]


def test_replay_is_in_time_order(spark, tmp_path):
    log = spark.createDataFrame([(1, "view", "A", 1.0, at(f"2024-01-01 {h:02d}:00")) for h in range(24)],
                                RAW_EVENTS).repartition(5)
    path = str(tmp_path / "replay")
    replay.lay_out_replay(log, path, files=4)
    seen = []
    stream = replay.replay_as_stream(spark, path, RAW_EVENTS)
    (stream.writeStream.foreachBatch(lambda df, _: seen.append(sorted(r.event_time for r in df.collect())))
     .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination())
    seen = [b for b in seen if b]
    assert len(seen) == 4
    assert [t for batch in seen for t in batch] == [at(f"2024-01-01 {h:02d}:00") for h in range(24)]


def test_replay_limit(spark, tmp_path):
    log = spark.createDataFrame([(1, "view", "A", 1.0, at(f"2024-01-01 {h:02d}:00")) for h in range(24)],
                                RAW_EVENTS)
    replay.lay_out_replay(log, str(tmp_path / "replay"), files=2, limit=5)
    assert sorted(r.timestamp.hour for r in spark.read.parquet(str(tmp_path / "replay")).collect()) == list(range(5))


def test_lag_from_progress(spark):
    report = {"id": "q", "name": "raw", "timestamp": "2024-01-01T00:00:10.000Z", "sources": [
        {"endOffset": '{"clicks":{"0":90,"1":50}}', "latestOffset": '{"clicks":{"0":100,"1":55,"2":3}}'}]}
    lag = lag_samples(spark.createDataFrame([(json.dumps(report),), ("{no",), (None,)], "report string"))
    assert rows(telemetry.lag_by_group(lag)) == [(at("2024-01-01 00:00"), "raw", "clicks", 18.0)]


def test_day_queries_read_one_day_folder(spark, tmp_path):
    df = spark.createDataFrame([(1, "purchase", "A", 1.0, at(f"2024-01-{d:02d} 10:00")) for d in range(1, 10)],
                               RAW_EVENTS).withColumnRenamed("timestamp", "event_time")
    path = str(tmp_path / "raw")
    append_raw(df, 0, path, "main")
    raw = spark.read.parquet(path)
    for out in (metrics.daily_metrics(raw, "2024-01-05"),
                metrics.revenue_today(raw, "2024-01-05 12:00:00"),
                metrics.current_visitors(raw, 180, "2024-01-05 12:00:00")):
        plan = out._jdf.queryExecution().executedPlan().toString()
        filters = plan[plan.index("PartitionFilters"):]
        assert "event_date" in filters[:filters.index("PushedFilters")]
        assert "GreaterThanOrEqual(ti" in filters   # the plan text is cut short here
    assert metrics.daily_metrics(raw, "2024-01-05").first().purchase_count == 1
