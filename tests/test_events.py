from __future__ import annotations

from cartwheel.functions.draws import content_hash
from cartwheel.operators import events as ev
from cartwheel.schemas import EVENT_WIRE_TEXT
from cartwheel.sinks.kafka import to_messages
from cartwheel.sources.events import decode_events, decode_events_as_text
from conftest import at, rows

GOOD = ('{"user_id": 17850, "event_type": "view", "product_id": "85123A", "price": 2.55, '
        '"timestamp": "2026-06-19T12:00:00"}')


def values(spark, *texts):
    return spark.createDataFrame([(bytearray(t, "utf-8"),) for t in texts], "value binary")


def test_decode(spark):
    df = values(spark, GOOD, "{broken", '{"event_type": "view", "timestamp": "soon"}',
                '{"event_type": "login"}')
    assert rows(decode_events(df)) == [
        (None, None, None, None, None, None),
        (None, "login", None, None, None, None),
        (None, "view", None, None, "soon", None),
        (17850, "view", "85123A", 2.55, "2026-06-19T12:00:00", at("2026-06-19 12:00:00"))]


def test_validation_names_the_reason(spark):
    df = values(spark, GOOD, "{broken", '{"event_type": "click"}',
                '{"event_type": "view", "user_id": "abc"}', '{"event_type": "view", "price": "dear"}',
                '{"event_type": "view", "timestamp": "soon"}',
                '{"event_type": "view", "product_id": "X1", "price": 1.5}')
    valid, rejected = ev.split_valid(ev.validate_events(decode_events_as_text(df)))
    assert rows(valid) == [(None, "view", "X1", 1.5, None),
                           (17850, "view", "85123A", 2.55, at("2026-06-19 12:00:00"))]
    assert sorted((r.reason, r.rejected_value) for r in rejected.collect()
                  if r.rejected_value) == [
        ("event_type unknown", "click"), ("price malformed", "dear"),
        ("timestamp malformed", "soon"), ("user_id malformed", "abc")]
    assert [r.reason for r in rejected.collect() if not r.rejected_value] == ["event_type missing"]


def test_default_time(spark):
    df = spark.createDataFrame([(None,), (at("2024-01-01"),)], "timestamp timestamp")
    out = ev.default_event_time(df, as_of="2024-02-02 00:00:00")
    assert rows(out) == [(at("2024-01-01"),), (at("2024-02-02"),)]


def test_identity(spark):
    users = spark.createDataFrame([(999001,)], "user_id bigint")
    df = spark.createDataFrame(
        [(111111, "spoofed", 999001), (5, "unknown", 42), (None, "anonymous", None),
         (6, "guest", None)], "user_id bigint, product_id string, auth_user_id bigint")
    assert rows(ev.resolve_identity(df, users)) == [
        (None, "anonymous"), (5, "unknown"), (6, "guest"), (999001, "spoofed")]


def test_anonymous_filler_keys_match_no_user(spark):
    """A filler key may happen to equal a real user id."""
    df = spark.createDataFrame([(None, None)] * 50, "user_id bigint, auth_user_id bigint")
    users = df.select(content_hash(df).alias("user_id")).distinct()
    assert rows(ev.resolve_identity(df, users)) == [(None,)] * 50


def test_whole_numbers_may_come_with_a_point(spark):
    df = values(spark, '{"event_type": "view", "user_id": 17850.0}', '{"event_type": "view", "user_id": 1.5}')
    checked = ev.validate_events(decode_events_as_text(df))
    assert sorted((r.user_id or 0, r.reason or "") for r in checked.collect()) == [
        (0, "user_id malformed"), (17850, "")]


def test_repair(spark):
    nan = float("nan")
    df = spark.createDataFrame([(17850.0, "view", "A", 2.5, at("2024-01-01 10:00:00")),
                                (nan, "search", None, nan, at("2024-01-01 10:00:00.25"))],
                               "user_id double, event_type string, product_id string, price double, "
                               "timestamp timestamp")
    assert rows(ev.clean_event_row(df)) == [
        (None, "search", None, None, "2024-01-01T10:00:00.250000"),
        (17850, "view", "A", 2.5, "2024-01-01T10:00:00")]


def test_messages_keep_nulls_and_come_back(spark):
    df = spark.createDataFrame([(8, "view", "A", 2.5, at("2024-01-01 10:00:00")),
                                (None, "search", None, None, at("2024-01-01 10:00:00"))],
                               "user_id bigint, event_type string, product_id string, price double, "
                               "event_time timestamp")
    sent = to_messages(df)
    assert rows(sent)[0] == (None, '{"user_id":null,"event_type":"search","product_id":null,'
                                   '"price":null,"timestamp":"2024-01-01T10:00:00"}')
    assert rows(sent)[1][0] == "8"
    assert rows(decode_events(sent).select(*df.columns)) == rows(df)


def test_text_schema_covers_the_wire_fields():
    assert EVENT_WIRE_TEXT.names == ["user_id", "event_type", "product_id", "price", "timestamp"]
