from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest

from cartwheel.operators import allocation
from cartwheel.operators.allocation import decide_by_arrival
from cartwheel.plans.checkout import checkout
from cartwheel.schemas import CART_ITEMS, PRODUCTS
from conftest import at, rows

LINES = "user_id long, product_id string, quantity int, added_at timestamp"


def one_after_the_other(lines, stock):
    left, verdicts, orders = dict(stock), {}, {}
    for owner, product, quantity, added in lines:
        orders.setdefault(owner, []).append((added, product, quantity))
    first = lambda o: (min((a is not None, a or datetime.min) for a, _, _ in orders[o]) if all(a is None for a, _, _ in orders[o])
                       else (True, min(a for a, _, _ in orders[o] if a is not None)), o)
    for owner in sorted(orders, key=first):
        fits = all(left.get(p) is not None and q <= left[p] for _, p, q in orders[owner])
        verdicts[owner] = fits
        if fits:
            for _, p, q in orders[owner]:
                left[p] -= q
    return verdicts


def catalog(spark, stock):
    return spark.createDataFrame([(p, "x", 1.0, 0, n) for p, n in stock.items()], PRODUCTS)


@pytest.mark.parametrize("seed, segment", [(1, 1_000_000), (2, 50), (3, 7)])
def test_rounds_decide_as_one_queue_would(spark, monkeypatch, seed, segment):
    monkeypatch.setattr(allocation, "SEGMENT_ROWS", segment)
    rng = random.Random(seed)
    stock = {f"p{i}": rng.choice([0, 5, 40, 200]) for i in range(12)} | {"hot": 300, "none": None}
    lines = []
    for owner in range(400):
        chosen = rng.sample(list(stock) + ["unknown"], rng.randint(1, 4)) + (["hot"] if rng.random() < 0.6 else [])
        when = None if owner % 97 == 0 else datetime(2024, 1, 1) + timedelta(minutes=rng.randint(0, 200))
        lines += [(owner, p, rng.randint(1, 9), when) for p in sorted(set(chosen))]
    got = decide_by_arrival(spark.createDataFrame(lines, LINES).repartition(5), catalog(spark, stock))
    found = {r.user_id: r.admitted for r in got.collect()}
    assert found == one_after_the_other(lines, stock)
    assert got.count() == 400 and got.agg({"round": "max"}).first()[0] < 40
    assert 20 < sum(found.values()) < 380


def test_a_chain_of_orders_and_no_orders(spark):
    """Each order waits for the one before it, on another product."""
    lines = [(i, f"p{j}", 1, at("2024-01-01")) for i in range(8) for j in (i, i + 1)]
    got = decide_by_arrival(spark.createDataFrame(lines, LINES), catalog(spark, {f"p{j}": 1 for j in range(9)}))
    assert {r.user_id: r.admitted for r in got.collect()} == {i: i % 2 == 0 for i in range(8)}
    assert decide_by_arrival(spark.createDataFrame([], LINES), catalog(spark, {"A": 1})).collect() == []


def test_checkout_by_arrival_sells_what_the_queue_admits(spark):
    products = catalog(spark, {"A": 3, "B": 5})
    cart = spark.createDataFrame([(1, 10, "A", 2, at("2024-01-01 10:00")), (2, 11, "A", 2, at("2024-01-01 09:00")),
                                  (3, 12, "A", 1, at("2024-01-01 11:00")), (4, 13, "B", 5, at("2024-01-01 08:00")),
                                  (5, 12, "B", 1, at("2024-01-01 11:00"))], CART_ITEMS)
    with checkout(cart, products, "2024-01-02", by_arrival=True) as done:
        assert rows(done.products.select("product_id", "stock")) == [("A", 1), ("B", 0)]
        assert sorted(r.user_id for r in done.cart.collect()) == [10, 12, 12] == sorted(r.user_id for r in done.contested.collect())
        assert done.events.count() == 7
    with checkout(cart, products, "2024-01-02") as done:
        assert done.events.count() == 0 and done.contested.count() == 5
