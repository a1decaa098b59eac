from __future__ import annotations

from types import SimpleNamespace

import pytest

from cartwheel import schemas
from cartwheel.session import apply_settings, shared_root
from cartwheel.sinks.files import write_csv
from cartwheel.sinks.kafka import kafka_sink_options
from cartwheel.sources import files, tables
from cartwheel.sources.events import kafka_source_options
from conftest import at, rows


def test_invoice_csv(spark, tmp_path):
    path = tmp_path / "lines.csv"
    path.write_text("InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
                    '536365,85123A,"HEART, ""RED""",6,12/1/2010 8:26,2.55,17850,United Kingdom\n'
                    "C536379,D,,-1,12/1/2010 9:41,27.5,,United Kingdom\n")
    assert rows(files.read_invoice_lines(spark, str(path))) == [
        ("536365", "85123A", 'HEART, "RED"', 6, "12/1/2010 8:26", 2.55, 17850.0, "United Kingdom"),
        ("C536379", "D", None, -1, "12/1/2010 9:41", 27.5, None, "United Kingdom")]


def test_another_header_is_refused(spark, tmp_path):
    path = tmp_path / "lines.csv"
    path.write_text("StockCode,InvoiceNo,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
                    "85123A,536365,x,6,12/1/2010 8:26,2.55,17850,United Kingdom\n")
    with pytest.raises(Exception, match="header"):
        files.read_invoice_lines(spark, str(path)).collect()


def test_event_log_sorted_and_limited(spark, tmp_path):
    log = spark.createDataFrame([(float(i), "view", "A", 1.0, at(f"2024-01-01 00:{59 - i:02d}"))
                                 for i in range(30)], schemas.EVENT_LOG)
    write_csv(log, str(tmp_path / "log"))
    got = files.read_event_log(spark, str(tmp_path / "log"), 3).collect()
    assert [r.user_id for r in got] == [29, 28, 27]
    assert files.read_event_log(spark, str(tmp_path / "log")).count() == 30


def test_missing_table_is_empty_other_faults_are_raised(spark):
    assert tables.query_table(spark, "daily_metrics_x", "SELECT 1", schema=schemas.DAILY_METRICS).collect() == []
    spark.range(3).createOrReplaceTempView("numbers")
    assert rows(tables.query_table(spark, "numbers", "SELECT id FROM numbers WHERE id >= :low", {"low": 2})) == [(2,)]
    with pytest.raises(Exception):
        tables.query_table(spark, "numbers", "SELECT no_such_column FROM numbers").collect()


def test_tables_are_created_once_and_kept(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS shop")
    assert set(tables.ensure_tables(spark, "shop")) == set(schemas.TABLES)
    spark.sql("INSERT INTO shop.traffic_stats VALUES "
              "(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-01 00:01:00', 1, 2, 3.0)")
    assert tables.ensure_tables(spark, "shop") == []
    assert spark.table("shop.traffic_stats").count() == 1
    for name, schema in schemas.TABLES.items():
        assert {f.name: f.dataType for f in spark.table(f"shop.{name}").schema} == {
            f.name: f.dataType for f in schema}


def test_connector_options():
    assert kafka_source_options("b:9092", "clicks", startingOffsets="earliest") == {
        "kafka.bootstrap.servers": "b:9092", "subscribe": "clicks", "startingOffsets": "earliest"}
    assert kafka_source_options("b:9092", "t")["startingOffsets"] == "latest"
    assert kafka_sink_options("b:9092", "t")["kafka.acks"] == "all"
    split = tables.jdbc_split_options("user_id", 0, 100, 8)
    assert split == {"partitionColumn": "user_id", "lowerBound": "0", "upperBound": "100",
                     "numPartitions": "8"}
    assert tables.jdbc_options("jdbc:x", "raw_events", "u", "p")["dbtable"] == "raw_events"


def test_a_session_without_shared_folder():
    """Local sessions use their warehouse; a cluster must name a folder."""
    def session(master):
        conf = {"spark.sql.warehouse.dir": "file:/store/warehouse"}
        return SimpleNamespace(sparkContext=SimpleNamespace(master=master),
                               conf=SimpleNamespace(get=lambda key, other=None: conf.get(key, other)))
    assert shared_root(session("local[2]")) == "file:/store/warehouse/_work"
    with pytest.raises(RuntimeError):
        shared_root(session("spark://master:7077"))


def test_settings_of_the_caller_win(spark):
    other = spark.newSession()
    other.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    other.conf.set("spark.sql.session.timeZone", "Asia/Seoul")
    apply_settings(other)
    assert other.conf.get("spark.sql.autoBroadcastJoinThreshold") == "-1"
    assert other.conf.get("spark.sql.session.timeZone") == "UTC"
    assert other.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == "true"


def test_shared_folder_comes_from_the_session(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_bad_invoice_lines_are_told_from_good_ones(spark, tmp_path):
    path = tmp_path / "lines.csv"
    path.write_text("InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
                    "1,A,x,6.0,12/1/2010 8:26,2.55,17850.0,UK\n2,A,x,six,12/1/2010 8:26,2.55,17850,UK\n"
                    "3,A,x,6,12/1/2010 8:26,2.55,abc,UK\n4,A,x\n5,A,x,6.5,12/1/2010 8:26,,,UK\n6,A,,,,,,\n")
    assert [r[:7:3] for r in rows(files.read_invoice_lines(spark, str(path)))] == [("1", 6, 17850.0), ("6", None, None)]
    got = {r.invoice_no: (r.reason, r.raw) for r in files.rejected_invoice_lines(spark, str(path)).collect()}
    assert got == {"2": ("quantity malformed", None), "3": ("customer_id malformed", None),
                   "4": ("line malformed", "4,A,x"), "5": ("quantity malformed", None)}


def test_lossless_csv(spark, tmp_path):
    texts = [None, "", " ", "a\nb", "a\\nb", "\\", "\\\\n", 'say "hi"', "\r\n", " padded ", "\\N", ",", "#",
             "a\uffffb", "\\\uffff\\n", "\\s", "\\e", "\\\\e", "\u2028"]
    data = spark.createDataFrame([(str(i), t, 1.0, 1, 1) for i, t in enumerate(texts)], schemas.PRODUCTS)
    write_csv(data, str(tmp_path / "p"), lossless=True)
    assert rows(files.read_products(spark, str(tmp_path / "p"), lossless=True)) == rows(data)


def test_bad_dimension_rows_are_rejected(spark, tmp_path):
    (tmp_path / "p.csv").write_text("product_id,description,price,total_purchase_count,stock\n"
                                    "A,x,1.5,3,4.0\nB,x,cheap,3,4\nC,x,,3,\n,x,1,3,4\nD,x\n")
    assert rows(files.read_products(spark, str(tmp_path / "p.csv"))) == [("A", "x", 1.5, 3, 4), ("C", "x", None, 3, None)]
    bad = files.rejected_rows(spark, str(tmp_path / "p.csv"), schemas.PRODUCTS).collect()
    assert {(r.product_id, r.reason, r.raw) for r in bad} == {
        ("B", "price malformed", None), (None, "product_id missing", None), ("D", "line malformed", "D,x")}
    (tmp_path / "u.csv").write_text("user_id,country,first_purchase_at,last_purchase_at\n"
                                    "1.0,UK,2024-01-01 10:00:00,\n2,UK,yesterday,\nx,UK,,\n")
    assert rows(files.read_users(spark, str(tmp_path / "u.csv"))) == [(1, "UK", at("2024-01-01 10:00"), None)]
    assert {r.reason for r in files.rejected_rows(spark, str(tmp_path / "u.csv"), schemas.USERS).collect()} == {
        "first_purchase_at malformed", "user_id malformed"}


def test_quoted_line_breaks(spark, tmp_path):
    (tmp_path / "lines.csv").write_text(
        "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
        '1,A,"red\nmug",6,12/1/2010 8:26,2.55,17850,UK\n')
    assert [r.description for r in files.read_invoice_lines(spark, str(tmp_path / "lines.csv"), line_breaks=True).collect()] == ["red\nmug"]
    assert files.rejected_invoice_lines(spark, str(tmp_path / "lines.csv"), line_breaks=True).count() == 0
    assert files.rejected_invoice_lines(spark, str(tmp_path / "lines.csv")).count() == 2
