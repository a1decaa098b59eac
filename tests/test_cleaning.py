from __future__ import annotations

from pyspark.sql import Observation

from cartwheel.operators import cleaning
from cartwheel.schemas import INVOICE_LINES
from conftest import at, rows


def line(code="85123A", text="MUG", quantity=1, when="12/1/2010 8:26", price=10.0, customer=17850.0,
         country="United Kingdom", invoice="536365"):
    return (invoice, code, text, quantity, when, price, customer, country)


def frame(spark, *lines):
    return spark.createDataFrame(list(lines), INVOICE_LINES)


def test_dates_padded_or_not_and_bad(spark):
    df = frame(spark, line(when="12/1/2010 8:26"), line(when="02/03/2011 18:05"), line(when="x"),
               line(when=None))
    assert [r[4] for r in rows(cleaning.parse_dates(df))] == [at("2010-12-01 08:26"),
                                                              at("2011-02-03 18:05")]


def test_non_product_codes(spark):
    df = frame(spark, *[line(code=c) for c in ("post", " M ", "bank charges", "dot\t", "85123a", None)])
    kept = {r.stock_code for r in cleaning.drop_non_products(df).collect()}
    assert kept == {"85123a", None}


def test_price_rules_round_half_to_even(spark):
    prices = (0.0, -1.0, 0.25, 10.0, 30.0, 50.0)
    df = frame(spark, *[line(price=p) for p in prices])
    out = cleaning.price_to_krw(cleaning.positive_price(df))
    assert sorted(r.unit_price for r in out.collect()) == [20000, 58000, 98000]


def test_descriptions(spark):
    df = frame(spark, line(text=None), line(text="  padded \t\n"))
    assert [r.description for r in cleaning.require_description(df).collect()] == ["padded"]


def test_split_leaves_out_guests_and_zero(spark):
    df = frame(spark, line(quantity=3), line(quantity=0), line(quantity=-2), line(customer=None))
    purchases, refunds = cleaning.split_transactions(cleaning.clean_invoice_lines(df))
    assert rows(purchases) == [("536365", 17850, "85123A", 3, 20000, at("2010-12-01 08:26"))]
    assert [r.quantity for r in refunds.collect()] == [-2]


def test_stage_counts_match_the_steps(spark):
    df = frame(spark, line(), line(when="x"), line(code="POST"), line(price=0.0), line(text=None),
               line(price=0.25))
    counts = {r.stage: r.line_count for r in cleaning.stage_row_counts(df).collect()}
    assert counts == {"read": 6, "dated": 5, "product_code": 4, "priced": 3, "described": 2,
                      "priced_in_krw": 1}
    seen = Observation("cleaning")
    cleaning.clean_invoice_lines(df, seen).collect()
    assert seen.get["cleaned_lines"] == 1
