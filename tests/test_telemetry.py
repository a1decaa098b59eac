from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest

from cartwheel.operators import metrics, telemetry
from cartwheel.schemas import LOG_LINES, METRIC_SAMPLES
from conftest import at, rows


def samples(spark, metric, *points):
    """(time, labels, value)"""
    return spark.createDataFrame([(at(f"2024-01-01 {t}"), metric, labels, v) for t, labels, v in points],
                                 METRIC_SAMPLES)


def test_rate_with_restart_and_window_step(spark):
    a = {"handler": "/a", "status": "200"}
    df = samples(spark, "c", ("00:00:00", a, 10.0), ("00:00:30", a, 40.0), ("00:01:10", a, 100.0),
                 ("00:01:40", a, 6.0))
    # minute 0: 30; minute 1: 60 across the border, then a restart worth 6
    assert rows(telemetry.counter_rate(df, "c", ["handler"])) == [
        (at("2024-01-01 00:00"), "/a", 0.5), (at("2024-01-01 00:01"), "/a", 1.1)]


def test_series_do_not_mix(spark):
    a, b = {"handler": "/a", "instance": "1"}, {"instance": "2", "handler": "/a"}
    df = samples(spark, "c", ("00:00:00", a, 0.0), ("00:00:01", b, 500.0), ("00:00:30", a, 60.0),
                 ("00:00:31", b, 560.0))
    assert rows(telemetry.counter_rate(df, "c", ["handler"]))[0][2] == 2.0


@pytest.mark.parametrize("span, seconds", [("10 seconds", 10), ("1 minute", 60), ("7 minutes", 420), ("1 day", 86400)])
def test_increases_against_brute_force(spark, span, seconds):
    rnd = random.Random(3)
    points, want, last = [], {}, {}
    for second in sorted(rnd.sample(range(7200), 900)):
        name = rnd.choice(["hot", "hot", "cold"])
        value = float(rnd.randrange(100))
        points.append((second, name, value))
        if name in last:
            step = value - last[name] if value >= last[name] else value
        else:
            step = 0.0
        last[name] = value
        start = (at("2024-01-01") - datetime(1970, 1, 1)).total_seconds() + second
        key = (datetime(1970, 1, 1) + timedelta(seconds=start // seconds * seconds), name)
        want[key] = want.get(key, 0.0) + step
    df = spark.createDataFrame([(at("2024-01-01") + timedelta(seconds=s), "c", {"handler": n}, v)
                                for s, n, v in points], METRIC_SAMPLES).repartition(5)
    got = {(r.window_start, r.labels["handler"]): r.increase
           for r in telemetry.counter_increases(df, span).collect()}
    assert got == want


def buckets(spark, *ladder):
    return spark.createDataFrame([("g", le, float(r)) for le, r in ladder], "g string, le string, rate double")


@pytest.mark.parametrize("ladder, q, want", [
    ([("0.1", 50), ("0.5", 90), ("+Inf", 100)], 0.5, 0.1),              # exactly at a bound
    ([("0.1", 50), ("0.5", 90), ("+Inf", 100)], 0.7, 0.1 + 0.4 * 20 / 40),
    ([("0.1", 50), ("0.5", 90), ("+Inf", 100)], 0.25, 0.05),            # first bucket starts at 0
    ([("0.1", 50), ("0.5", 90), ("+Inf", 100)], 0.95, 0.5),             # open bucket
    ([("0.1", 0), ("0.5", 0), ("+Inf", 0)], 0.95, None),
    ([("0.1", 5), ("0.5", 9)], 0.95, None),                             # no open bucket
    ([("10", 40), ("9", 20), ("+Inf", 40)], 0.75, 9.5),                 # bounds are numbers, not text
])
def test_histogram_quantile(spark, ladder, q, want):
    got = rows(telemetry.histogram_quantile(buckets(spark, *ladder), q, ["g"]))[0][1]
    assert got is None if want is None else got == pytest.approx(want)


def test_latency_from_bucket_counters(spark):
    points = []
    for le, start, end in (("0.1", 10, 60), ("0.5", 10, 100), ("+Inf", 10, 110)):
        labels = {"handler": "/a", "le": le}
        points += [("00:00:05", labels, float(start)), ("00:00:50", labels, float(end))]
    df = samples(spark, "h_bucket", *points)
    got = rows(telemetry.latency_quantile(df, "h_bucket", 0.7))
    assert got[0][:2] == (at("2024-01-01 00:00"), "/a") and got[0][2] == pytest.approx(0.3)


def test_error_rate(spark):
    ok, bad = {"status": "200"}, {"status": "503"}
    df = samples(spark, "c", ("00:00:00", ok, 0.0), ("00:00:30", ok, 30.0), ("00:00:00", bad, 0.0),
                 ("00:00:30", bad, 10.0), ("00:01:30", ok, 30.0))
    assert rows(telemetry.error_rate(df, "c")) == [
        (at("2024-01-01 00:00"), pytest.approx(25.0)), (at("2024-01-01 00:01"), None)]


def test_gauge_and_lag(spark):
    s = {"state": "idle"}
    df = samples(spark, "g", ("00:00:10", s, 3.0), ("00:00:50", s, 5.0), ("00:01:00", s, 1.0))
    assert [v for *_, v in rows(telemetry.gauge_by_label(df, "g", "state"))] == [5.0, 1.0]

    def part(p):
        return {"consumergroup": "etl", "topic": "t", "partition": p}
    lag = samples(spark, "kafka_consumergroup_lag", ("00:00:01", part("0"), 9.0),
                  ("00:00:30", part("0"), 4.0), ("00:00:10", part("1"), 3.0))
    assert rows(telemetry.lag_by_group(lag)) == [(at("2024-01-01 00:00"), "etl", "t", 7.0)]


def test_container_logs_match_the_whole_name(spark):
    df = spark.createDataFrame([(at("2024-01-01"), c, "stdout", "x")
                                for c in ("/shop-backend", "/shop-backend-2", "shop-backend", "/other")],
                               LOG_LINES)
    assert [r.container for r in telemetry.container_logs(df, "shop-backend").collect()] == ["shop-backend"]
    assert telemetry.container_logs(df, "shop-.*").count() == 2


def test_load_summary(spark):
    df = spark.createDataFrame([(float(i), i == 1) for i in range(1, 201)], "duration_ms double, failed boolean")
    got = telemetry.load_summary(df).first()
    assert (got.requests, got.failed_rate, got.p90, got.p95) == (200, 0.005, pytest.approx(180.1), pytest.approx(190.05))
    assert got.passed
    assert not telemetry.load_summary(df, max_failed=0.001).first().passed
    checks = spark.createDataFrame([("login", True), ("login", False)], "check string, passed boolean")
    assert rows(telemetry.check_success(checks)) == [("login", 2, 0.5)]


def test_retention(spark):
    df = spark.createDataFrame([(at("2024-01-01 00:00:00"),), (at("2023-12-31 23:59:59"),)], "ts timestamp")
    assert metrics.keep_recent(df, 168, "2024-01-08 00:00:00").count() == 1
