"""Orders that no single task holds, against plain Python."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartwheel.operators.ordering import exact_quantiles, previous_value, running_total
from cartwheel.operators.rows import number_copies, repeat_rows
from cartwheel.sources.files import sample_lines
from conftest import rows


@pytest.mark.parametrize("segments", [1, 3, 16])
def test_running_total_with_a_hot_key(spark, segments):
    rnd = random.Random(1)
    data = [("hot" if rnd.random() < 0.5 else f"k{rnd.randrange(5)}", i, rnd.randrange(9))
            for i in range(2000)]
    df = spark.createDataFrame(data, "k string, at int, v int").repartition(5)
    want, sums, totals = [], {}, {}
    for k, _, v in data:
        totals[k] = totals.get(k, 0) + v
    for k, i, v in data:
        sums[k] = sums.get(k, 0) + v
        want.append((k, i, v, sums[k], totals[k]))
    out = running_total(df, ["at"], "v", "upto", keys=["k"], total="all", segments=segments)
    assert sorted(tuple(r) for r in out.select("k", "at", "v", "upto", "all").collect()) == sorted(want)


def test_running_total_without_keys(spark):
    df = spark.range(1000).withColumn("v", F.lit(2)).repartition(7)
    out = running_total(df, ["id"], "v", "upto", segments=6)
    assert all(r.upto == 2 * (r.id + 1) for r in out.collect()) and out.count() == 1000


def test_a_hot_key_is_spread_over_segments(spark):
    from cartwheel.operators.ordering import ordered_segments
    df = spark.range(1000).withColumn("k", F.lit("hot"))
    sizes = [r["count"] for r in ordered_segments(df, ["k", "id"], 8).groupBy("segment").count().collect()]
    assert len(sizes) >= 7 and max(sizes) < 300


def test_previous_value(spark):
    df = spark.createDataFrame([(v * v,) for v in range(200)], "v long").repartition(5)
    got = {r.v: r.before for r in previous_value(df, "v", "before", segments=9).collect()}
    assert got == {v * v: (v - 1) ** 2 if v else None for v in range(200)}


@pytest.mark.parametrize("n", [1, 2, 7, 1000])
def test_exact_quantiles(spark, n):
    rnd = random.Random(n)
    data = [(k, float(rnd.randrange(50))) for k in ("a", "b") for _ in range(n)]
    df = spark.createDataFrame(data + [("a", None)], "k string, v double")
    qs = {"p0": 0.0, "p50": 0.5, "p90": 0.9, "p95": 0.95, "p100": 1.0}
    got = {r.k: r for r in exact_quantiles(df, "v", qs, ["k"]).collect()}
    for k in ("a", "b"):
        values = [v for key, v in data if key == k]
        for name, q in qs.items():
            assert got[k][name] == pytest.approx(np.quantile(values, q))


def test_repeat_rows_past_the_chunk_size(spark):
    df = spark.createDataFrame([("a", 3), ("b", 0), ("c", None), ("d", 2500)], "k string, n int")
    for spread in (False, True):
        out = [(r.k, r.i) for r in repeat_rows(df, "n", "i", spread).collect()]
        assert sorted(out) == sorted([("a", i) for i in (1, 2, 3)] + [("d", i) for i in range(1, 2501)])


def test_copies_are_numbered_whatever_their_number(spark):
    df = spark.createDataFrame([("a", None)] * 2300 + [("b", 1)] * 2 + [("c", 1)], "k string, v int")
    out = number_copies(df.repartition(5))
    assert sorted((r.k, r.copy) for r in out.collect()) == sorted(
        [("a", i) for i in range(1, 2301)] + [("b", 1), ("b", 2), ("c", 1)])


def test_exact_sample(spark):
    df = spark.range(1003)
    for fraction in (0.0, 0.1, 0.5, 0.999):
        taken = [r.id for r in sample_lines(df, fraction, exact=True).collect()]
        assert len(taken) == round(fraction * 1003) == len(set(taken))
    assert sample_lines(df, 1.0).count() == 1003
    assert rows(sample_lines(df, 0.3)) == rows(sample_lines(df, 0.3))
