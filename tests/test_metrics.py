from __future__ import annotations

from datetime import date

from cartwheel.operators import metrics, serving
from cartwheel.plans import daily as daily_plan, dashboard
from cartwheel.schemas import DAILY_METRICS, PRODUCT_STATS, PRODUCTS, RAW_EVENTS, TRAFFIC_STATS
from conftest import at, rows
import pytest


def raw(spark, *events):
    return spark.createDataFrame([(u, t, p, c, at(w)) for u, t, p, c, w in events], RAW_EVENTS)


def test_daily_without_events_views_or_users(spark):
    df = raw(spark, (None, "purchase", "A", 5.0, "2024-01-02 10:00"),
             (None, "view", "A", 5.0, "2024-01-03 23:59:59.999999"),
             (1, "view", "A", 5.0, "2024-01-04 00:00"))
    assert rows(metrics.daily_metrics(df, "2024-01-01")) == [(date(2024, 1, 1), 0, 0, 0, 0.0, 0.0, 0)]
    assert rows(metrics.daily_metrics(df, "2024-01-02")) == [(date(2024, 1, 2), 0, 0, 1, 0.0, 5.0, 1)]
    assert rows(metrics.daily_metrics(df, "2024-01-03")) == [(date(2024, 1, 3), 0, 1, 0, 0.0, 0.0, 1)]
    assert len(rows(metrics.daily_metrics_by_day(df))) == 3


def test_conversion_may_exceed_one(spark):
    df = raw(spark, (1, "view", "A", 1.0, "2024-01-01"), *[(1, "purchase", "A", 2.0, "2024-01-01")] * 3)
    assert rows(metrics.daily_metrics(df, "2024-01-01"))[0][4] == 3.0


def test_refunds_do_not_reduce_revenue(spark):
    df = raw(spark, (1, "purchase", "A", 5.0, "2024-01-01"), (1, "refund", "A", 5.0, "2024-01-01"),
             (1, "refund", "B", 5.0, "2024-01-01"), (1, "search", None, None, "2024-01-01"))
    assert rows(metrics.product_stats(df)) == [("A", 0, 1, 5.0), ("B", 0, 0, 0.0)]


def test_traffic_leaves_out_timeless_events(spark):
    df = spark.createDataFrame(
        [(1, "view", "A", 1.0, at("2024-01-01 00:00:10")), (1, "purchase", "A", 2.0, at("2024-01-01 00:00:50")),
         (2, "view", "A", 1.0, at("2024-01-01 00:01:00")), (3, "view", "A", 1.0, None)],
        "user_id bigint, event_type string, product_id string, price double, event_time timestamp")
    want = [(at("2024-01-01 00:00"), at("2024-01-01 00:01"), 1, 2, 2.0),
            (at("2024-01-01 00:01"), at("2024-01-01 00:02"), 1, 1, 0.0)]
    assert rows(metrics.traffic_stats(df, exact=True)) == want
    assert rows(metrics.traffic_stats(df)) == want


def test_bounds_of_recent_are_inclusive(spark):
    df = raw(spark, (1, "view", "A", 1.0, "2024-01-01 11:55"), (2, "view", "A", 1.0, "2024-01-01 11:54:59"),
             (3, "view", "A", 1.0, "2024-01-01 12:30"))
    assert rows(metrics.current_visitors(df, 5, "2024-01-01 12:00:00")) == [(2,)]


def test_revenue_today_of_nothing_is_zero(spark):
    assert rows(metrics.revenue_today(raw(spark), "2024-01-01 12:00:00")) == [(0.0,)]
    assert rows(metrics.recent_event_total(spark.createDataFrame([], TRAFFIC_STATS))) == [(0,)]


def test_report_text(spark):
    df = spark.createDataFrame([(date(2024, 1, 1), 1234, 32, 1, 0.03125, 1234567.891, 5000)], DAILY_METRICS)
    text = {m: t for _, m, t in rows(metrics.daily_report(df))}
    assert text == {"date": "2024-01-01", "dau": "1,234", "view_count": "32", "purchase_count": "1",
                    "conversion_rate": "3.12%", "revenue": "1,234,567.89", "event_count": "5,000"}


def test_card_texts(spark):
    df = spark.createDataFrame([(date(2024, 1, 1), 12, 32, 2, 0.0625, 1234567.5, 5000)], DAILY_METRICS)
    assert rows(metrics.daily_cards(df)) == [("2024-01-01", "12", "6.2%", "₩1,234,568", "5,000")]


def test_stored_day_is_replaced_and_others_stay(spark, tmp_path):
    path = str(tmp_path / "daily")
    daily_plan.run_day(raw(spark, (1, "view", "A", 1.0, "2024-01-01")), "2024-01-01", path)
    daily_plan.run_day(raw(spark, (1, "view", "A", 1.0, "2024-01-02")), "2024-01-02", path)
    report = daily_plan.run_day(raw(spark, (1, "view", "A", 1.0, "2024-01-02"),
                                    (2, "view", "A", 1.0, "2024-01-02")), "2024-01-02", path)
    assert [(r.metric_date.day, r.dau) for r in
            daily_plan.read_daily(spark, path).orderBy("metric_date").collect()] == [(1, 1), (2, 2)]
    assert report.count() == 7


def test_traffic_fallback(spark):
    minutes = [(at(f"2024-01-01 {m // 60:02d}:{m % 60:02d}"), at("2024-01-01"), 1, m, 0.0) for m in range(100)]
    df = spark.createDataFrame(minutes, TRAFFIC_STATS)
    near = [r.event_count for r in serving.recent_traffic(df, 10, "2024-01-01 01:39:00").collect()]
    assert near == list(range(89, 100))
    far = [r.event_count for r in serving.recent_traffic(df, 10, "2025-01-01 00:00:00").collect()]
    assert far == list(range(40, 100))
    none = spark.createDataFrame([], TRAFFIC_STATS)
    assert serving.recent_traffic(none, 10, "2025-01-01 00:00:00").collect() == []


def products(spark, *rows_):
    return spark.createDataFrame(list(rows_), PRODUCTS)


def test_search(spark):
    df = products(spark, ("A1", "Blue Mug", 5.0, 0, 0), ("A2", "Red Plate", 3.0, 0, 0))
    assert [r.product_id for r in serving.search_products(df, "mug").collect()] == ["A1"]
    assert serving.search_products(df, "").count() == 2
    assert [r.product_id for r in serving.search_products(df, "r_d").collect()] == ["A2"]
    assert serving.lookup(df, "product_id", "NO_SUCH_ID").count() == 0


def test_pages_do_not_overlap(spark):
    df = products(spark, *[(f"P{i:03d}", "x", 1.0, i % 3, 0) for i in range(50)])
    seen = [r.product_id for skip in (0, 20, 40) for r in serving.list_products(df, skip, 20).collect()]
    assert len(seen) == 50 == len(set(seen))
    for skip, limit in ((-1, 20), (0, 0), (0, 101)):
        with pytest.raises(ValueError):
            serving.page(df, ["product_id"], skip, limit)


def test_top_products_keep_unknown_ones(spark):
    stats = spark.createDataFrame([("A", 5, 1, 1.0), ("B", 9, 1, 1.0), ("X", 0, 7, 7.0), ("D", 0, 0, 0.0)],
                                  PRODUCT_STATS)
    top = serving.top_products(stats, products(spark, ("A", "mug", 1.0, 0, 0), ("D", "dish", 1.0, 0, 0)), 3)
    assert [tuple(r)[:2] for r in top.collect()] == [("X", None), ("B", None), ("A", "mug")]


def test_dashboard_frames(spark):
    events = raw(spark, (1, "purchase", "A", 5.0, "2024-01-01 11:59"))
    traffic = metrics.traffic_stats(events.withColumnRenamed("timestamp", "event_time"))
    shown = dashboard.live(events, metrics.product_stats(events), traffic,
                           products(spark, ("A", "mug", 1.0, 0, 0)), "2024-01-01 12:00:00")
    assert rows(shown["current_visitors"]) == [(1,)]
    assert rows(shown["revenue_today"]) == [(5.0,)]
    assert rows(shown["recent_events"]) == [(1,)]
    assert [r.minute for r in shown["traffic"].collect()] == ["01-01 11:59"]
    day = dashboard.daily(metrics.daily_metrics_by_day(events))
    assert [r.day for r in day["chart"].collect()] == ["2024-01-01"]
    assert day["latest"].count() == 1
    assert dashboard.daily(spark.createDataFrame([], DAILY_METRICS))["latest"].count() == 0


def test_recent_traffic_of_events_counts_the_shown_minutes_only(spark):
    times = [at(f"2024-01-01 {h:02d}:{m:02d}:30") for h in range(4) for m in range(0, 60, 2)] + [None]
    events = spark.createDataFrame([(i % 7, "purchase", "A", 1.0, t) for i, t in enumerate(times)],
                                   "user_id long, event_type string, product_id string, price double, event_time timestamp")
    for as_of, minutes in (("2024-01-01 03:58:40", 20), ("2024-01-01 03:58:00", 20), ("2024-01-01 02:00:30", 1), ("2030-01-01 00:00:00", 5)):
        want = serving.recent_traffic(metrics.traffic_stats(events, exact=True), minutes, as_of)
        got = serving.recent_traffic_of_events(events, minutes, as_of, exact=True)
        assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()], as_of
    assert serving.recent_traffic_of_events(events.limit(0), 5, "2024-01-01").collect() == []
