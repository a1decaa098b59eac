"""Sketches, the text index, totals by deltas, tables upserted by slots, first rows, stored reports."""

from __future__ import annotations

import json
import os
import random
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cartwheel.operators import metrics, serving, sketches, telemetry, text_index
from cartwheel.operators import ordering
from cartwheel.operators.dimensions import upsert_products
from cartwheel.operators.text_index import TextIndex, literals
from cartwheel.schemas import PRODUCT_STATS, PRODUCTS
from cartwheel.sinks.keyed import KeyedTable
from cartwheel.sinks.totals import RunningTotals
from cartwheel.sources import files
from cartwheel.sinks.files import write_csv
from cartwheel.streaming import jobs
from cartwheel.streaming.progress import ReportStore, lag_samples, progress_samples, read_reports
from conftest import at, rows

EVENTS = "user_id long, event_type string, product_id string, price double, event_time timestamp"


def events(n=5000, users=3000, seed=1):
    rng = random.Random(seed)
    return [(rng.choice([None, rng.randrange(users)]), rng.choice(["view", "purchase"]), f"p{rng.randrange(40)}", float(rng.randrange(9)),
             datetime(2024, 1, 1) + timedelta(seconds=rng.randrange(7200))) for _ in range(n)]


def test_users_of_an_hour_from_stored_minutes(spark, tmp_path):
    made = events() + [(1, "view", "A", 1.0, None)]
    df = spark.createDataFrame(made, EVENTS)
    sketches.minute_sketches(df).write.parquet(str(tmp_path / "minutes"))
    stored = spark.read.parquet(str(tmp_path / "minutes"))
    exact = {h: len({u for u, *_, t in made if u is not None and t and t.hour == h}) for h in (0, 1)}
    got = {r.window_start.hour: r for r in sketches.traffic_over(stored, "1 hour").collect()}
    for h in (0, 1):
        assert abs(got[h].unique_users - exact[h]) <= 1 + sketches.USERS_ERROR * exact[h]
        assert got[h].event_count == sum(t is not None and t.hour == h for *_, t in made)
    sums = {r.window_start.hour: r.s for r in metrics.traffic_stats(df).groupBy(F.window("window_start", "1 hour").start.alias("window_start"))
            .agg(F.sum("unique_users").alias("s")).collect()}
    assert sums[0] > 1.2 * got[0].unique_users         # which is why minute counts do not do
    last = sketches.visitors_since(stored, 10, "2024-01-01 02:00:00").first()
    near = {u for u, *_, t in made if u is not None and t and t >= datetime(2024, 1, 1, 1, 50)}
    assert abs(last.visitors - len(near)) <= 1 + 0.05 * len(near)
    assert tuple(sketches.visitors_since(stored.limit(0), 10, "2024-01-01").first()) == (0, 0)


def test_sketches_of_a_stream_equal_those_of_the_batch(spark, tmp_path):
    spark.createDataFrame(events(800), EVENTS).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(EVENTS).parquet(str(tmp_path / "in"))
    folders = jobs.StreamFolders(str(tmp_path / "out"))
    jobs.start_traffic_sketches(stream, folders, once=True).awaitTermination()
    got = sketches.traffic_over(spark.read.parquet(folders.table("traffic_sketches")), "1 hour").orderBy("window_start").first()
    want = sketches.traffic_over(sketches.minute_sketches(spark.read.parquet(str(tmp_path / "in"))), "1 hour").orderBy("window_start").first()
    assert (got.unique_users, got.event_count, got.revenue) == (want.unique_users, want.event_count, want.revenue)


def test_quantiles_of_a_day_from_stored_minutes(spark):
    rng = random.Random(2)
    made = [(datetime(2024, 1, 1) + timedelta(seconds=rng.randrange(86400)), "a" if i % 3 else "b", rng.lognormvariate(3, 1)) for i in range(20000)]
    df = spark.createDataFrame(made + [(None, "a", 1.0), (at("2024-01-01"), "a", None), (at("2024-01-01"), "a", float("nan"))],
                               "ts timestamp, kind string, value double")
    minutes = sketches.value_sketches(df, "value", ["kind"])
    for r in sketches.quantiles_over(minutes, {"p50": 0.5, "p95": 0.95, "p99": 0.99}, ["kind"], "1 day").collect():
        values = sorted(v for _, k, v in made if k == r.kind)
        assert r.value_count == len(values)
        for name, q in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99)):
            assert abs(sum(v <= r[name] for v in values) / len(values) - q) <= sketches.RANK_ERROR
    assert sketches.quantiles_over(minutes.limit(0), {"p50": 0.5}).count() == 0


@pytest.mark.parametrize("text, parts", [("red", ["red"]), ("R_d%Mug", ["r", "d", "mug"]), (r"50\% off", ["50% off"]), ("", []), ("%_", []),
                                         (r"r\e\d", ["red"]), ("\\\\a", ["\\a"])])
def test_literals_of_a_search_text(text, parts):
    assert literals(text) == parts


def test_index_finds_what_a_scan_finds(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(text_index, "BLOCK_ROWS", 20)
    rng = random.Random(6)
    names = ["".join(rng.choice("abcABC _%") for _ in range(rng.randint(0, 9))) for _ in range(600)]
    names += ["Red MUG", "red mug", None, "", "aé日本語", "ÉCLAIR éclair", "100% wool", "100 wool"] + ["same abc"] * 30
    catalog = spark.createDataFrame([(str(i), n, 1.0, 0, 0) for i, n in enumerate(names)], PRODUCTS)
    index = TextIndex(str(tmp_path / "index"))
    index.build(catalog)
    for text in ("abc", "ABCA", "bca%ab", "a_c", "red", "ED MU", "same abc", "日本語", "éclair", "zzz", r"0\% w", "00%wo", "ab", "", None):
        want = rows(serving.search_products(catalog, text))
        assert rows(index.search(spark, text)) == want, text
    found = index.search(spark, "ED MU")
    read = found._jdf.queryExecution().executedPlan().toString()
    assert "_block" in read[read.index("PartitionFilters"):]
    assert index.candidates(spark, "ED MU").count() == 2 and index.candidates(spark, "zzz").count() == 0
    assert index.candidates(spark, "ed") is None
    looked_up = index.candidates(spark, "same abc")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(gram" in looked_up
    empty = TextIndex(str(tmp_path / "none"))
    empty.build(catalog.limit(0))
    assert empty.search(spark, "abc").count() == 0


def stats(spark, *made):
    return spark.createDataFrame([(p, v, 0, 0.0) for p, v in made], PRODUCT_STATS)


def size_of(folder):
    return sum(os.path.getsize(f"{r}/{f}") for r, _, fs in os.walk(folder) for f in fs if f.endswith(".parquet"))


def test_totals_follow_what_changes(spark, tmp_path):
    held = RunningTotals(str(tmp_path / "t"), PRODUCT_STATS, "product_id", every=4)
    assert held.read(spark).count() == 0
    held.write(stats(spark, *[(f"p{i}", 1) for i in range(20000)]), 0)
    first = size_of(tmp_path / "t")
    held.write(stats(spark, ("p1", 2), ("new", 1)), 1)
    held.write(stats(spark, ("p1", 2), ("new", 1)), 1)        # delivered again
    assert size_of(tmp_path / "t") - first < first / 20     # two rows, not the table
    reader = held.read(spark)
    held.write(stats(spark, ("p1", 3)), 2)
    held.write(stats(spark), 3)
    held.write(stats(spark, ("p2", 9)), 4)
    held.write(stats(spark, ("p1", 5)), 5)
    got = {r.product_id: r.view_count for r in held.read(spark).collect()}
    assert len(got) == 20001 and (got["p1"], got["p2"], got["new"], got["p3"]) == (5, 9, 1, 1)
    assert {r.product_id: r.view_count for r in reader.collect()}["p1"] == 2
    for n in range(6, 15):
        held.write(stats(spark, ("p1", n)), n, keep_hours=0.0)
    assert len([d for d in os.listdir(tmp_path / "t/deltas") if d.startswith("batch_id")]) <= 9
    assert {r.product_id: r.view_count for r in held.read(spark).collect()} == got | {"p1": 14}


def test_stream_totals_over_batches_and_a_restart(spark, tmp_path):
    made = events(900)
    folders = jobs.StreamFolders(str(tmp_path / "out"))
    for part in range(3):
        spark.createDataFrame(made[part * 300:(part + 1) * 300], EVENTS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        jobs.start_product_totals(stream, folders, once=True).awaitTermination()
        want = metrics.product_stats(spark.createDataFrame(made[:(part + 1) * 300], EVENTS))
        assert rows(jobs.product_totals(folders).read(spark)) == rows(want)


def test_upsert_by_slots(spark):
    current = spark.createDataFrame([(f"p{i}", "old", 1.0, 1, i) for i in range(500)], PRODUCTS)
    new = spark.createDataFrame([("p3", "new", 2.0, 5, 99), ("p700", "new", 3.0, 6, 7), (None, "lost", 1.0, 1, 1)], PRODUCTS)
    held = KeyedTable("slots_of_products", "product_id", slots=16, buckets=4)
    held.create(current)
    folder = spark.sql("DESCRIBE EXTENDED slots_of_products").filter("col_name = 'Location'").first().data_type.removeprefix("file:")
    times = lambda: {d: max(os.stat(f"{folder}/{d}/{f}").st_mtime_ns for f in os.listdir(f"{folder}/{d}")) for d in os.listdir(folder) if "=" in d}
    before = times()
    arrivals = new.filter("product_id is not null")
    merged, touched = held.merged(arrivals, upsert_products)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    plan = merged._jdf.queryExecution().sparkPlan().toString(), merged._jdf.queryExecution().executedPlan().toString()
    scan = plan[1][plan[1].index("slots_of_products"):]
    assert "Bucketed: true" in scan and "_slot" in scan[scan.index("PartitionFilters"):scan.index("PushedFilters")]
    held_side = plan[1][:plan[1].index("slots_of_products")]
    assert "Exchange" not in held_side.split("SortMergeJoin")[-1], plan[1]
    assert held.upsert(new, upsert_products) == touched and len(touched) <= 2
    assert rows(held.read(spark)) == rows(upsert_products(current, arrivals))
    changed = {d for d, t in times().items() if before.get(d) != t}
    assert changed == {f"_slot={s}" for s in touched}
    held.upsert(new, upsert_products)       # once more: the same
    assert held.read(spark).count() == 501 and held.upsert(new.limit(0), upsert_products) == []
    assert old == spark.conf.get("spark.sql.autoBroadcastJoinThreshold")


def test_first_rows_without_one_task_for_all(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ordering, "FEW_ROWS", 10)
    monkeypatch.setattr(ordering, "SEGMENT_ROWS", 100)
    rng = random.Random(9)
    made = [(rng.randrange(50), i) for i in range(1000)]
    df = spark.createDataFrame(made, "k int, v int").repartition(6)
    whole = [r.k for r in ordering.rows_between(df, ["k"], 0, 2000).collect()]
    assert whole == sorted(k for k, _ in made)
    seen = [tuple(r) for start in range(0, 1000, 170) for r in ordering.rows_between(df, ["k"], start, start + 170).collect()]
    assert sorted(seen) == sorted(made) and [k for k, _ in seen] == whole
    got = ordering.rows_between(df, ["k"], 400, 480)
    assert "TakeOrdered" not in got._jdf.queryExecution().executedPlan().toString() and got.count() == 80
    products = spark.createDataFrame([(f"p{i:04d}", "x", 1.0, None if i == 3 else i // 7, 1) for i in range(900)], PRODUCTS)
    pages = [r.product_id for skip in range(0, 900, 90) for r in serving.list_products(products, skip, 90).collect()]
    assert pages == [r.product_id for r in serving.by_popularity(products).collect()]
    log = spark.createDataFrame([(float(i), "view", "A", 1.0, datetime(2024, 1, 1) + timedelta(seconds=i)) for i in range(500)],
                                "user_id double, event_type string, product_id string, price double, timestamp timestamp")
    write_csv(log.repartition(4), str(tmp_path / "log"))
    assert [r.user_id for r in files.read_event_log(spark, str(tmp_path / "log"), 333).collect()] == list(range(333))


def test_reports_of_a_real_run_are_kept(spark, tmp_path):
    store = ReportStore(spark, str(tmp_path / "reports"))
    assert read_reports(spark, str(tmp_path / "reports")).count() == 0
    for part in range(3):
        spark.createDataFrame(events(100, seed=part), EVENTS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    spark.streams.addListener(store)
    try:
        stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        folders = jobs.StreamFolders(str(tmp_path / "out"), run="kept")
        jobs.start_raw_events(stream, folders, once=True).awaitTermination()
        for _ in range(100):        # the listener hears of it a little later
            kept = read_reports(spark, str(tmp_path / "reports"))
            if kept.count() >= 3:
                break
            time.sleep(0.1)
        time.sleep(0.5)
    finally:
        spark.streams.removeListener(store)
    samples = progress_samples(read_reports(spark, str(tmp_path / "reports"))).filter("metric = 'streaming_input_rows'")
    assert samples.agg(F.sum("value")).first()[0] == 300
    assert {r.labels["query"] for r in samples.collect()} == {"raw_events_kept"}
    report = json.loads(kept.first().report)
    assert report["sources"] and lag_samples(kept).count() == 0      # files have no offsets of a topic
    # the same store, with the offsets of a topic as its reports hold them
    report["sources"] = [{"endOffset": {"clicks": {"0": 90}}, "latestOffset": {"clicks": {"0": 100}}}]
    os.makedirs(tmp_path / "reports/day=2024-01-01")
    (tmp_path / "reports/day=2024-01-01/topic.json").write_text(json.dumps(report) + "\n")
    lag = telemetry.lag_by_group(lag_samples(read_reports(spark, str(tmp_path / "reports"))))
    assert [(r.consumergroup, r.topic, r.lag) for r in lag.collect()] == [("raw_events_kept", "clicks", 10.0)]
