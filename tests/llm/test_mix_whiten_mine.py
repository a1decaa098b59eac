"""Mixing, whitening and hard negatives against plain versions."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartwheel.llm import hard_negatives, mixing, vectors, whitening
from tests.llm.helpers import DOCS, corpus, words


def plain_targets(sizes: dict) -> dict:
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    held: set = set()
    while True:
        free = [s for s in names if s not in held]
        left = sum(sizes.values()) - sum(3 * sizes[s] for s in held)
        target = {s: 3.0 * sizes[s] for s in held} | {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        above = {s for s in free if target[s] > 3 * sizes[s]}
        if not above:
            return target
        held |= above


def mixed(docs):
    return [tuple(r) for r in mixing.mix_digest(docs).select("doc_id", "size", "source_size", "target", "taken").collect()]


def test_mix_meets_targets_whatever_the_order(spark):
    rng = random.Random(3)
    rows = [(i, words(rng, rng.choice([1, 5, 30, 60])), None, rng.choice(["a", "b", "ab", "Z", "ä", None, "x"]), 0)
            for i in range(3000)]
    rows += [(5000 + i, words(rng, 4000), None, "b", 0) for i in range(3)] + [rows[7]] * 40
    rows += [(6000, None, None, "b", 0), (6001, " ", None, "only blank", 0), (None, "one two", None, None, 0)]
    docs = spark.createDataFrame(rows, DOCS)
    got = mixed(docs.repartition(7))
    assert sorted(got, key=str) == sorted(mixed(docs.orderBy("text").coalesce(2)), key=str)    # no matter where rows lie
    assert len(got) == len(rows)
    source = {r[0]: r[3] for r in rows}
    sizes: dict = {s: 0 for s in set(source.values())}
    for r in rows:
        sizes[r[3]] += len((r[1] or "").split())
    want = plain_targets(sizes)
    taken = {s: 0 for s in sizes}
    for doc_id, size, source_size, target, took in got:
        s = source[doc_id]
        assert source_size == sizes[s] and target == pytest.approx(want[s], rel=1e-12)
        assert took in (0, size, 2 * size, 3 * size)
        taken[s] += took
    for s in sizes:
        n = sum(source[r[0]] == s for r in rows)
        assert abs(taken[s] - want[s]) <= 2 * sizes[s] / n, s         # one short document at most
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))


def test_mix_in_chunks_and_levels(spark):
    """Small chunks give several levels; the sums hold all the same, and repeats are dealt apart."""
    rng = random.Random(5)
    rows = [(i, rng.choice([1, 2, 40, 700]), f"s{i % 2}") for i in range(4000)] + [(9, 40, "s1")] * 500
    docs = spark.createDataFrame(rows, "doc_id long, n long, source string")
    old = mixing.CHUNK
    try:
        mixing.CHUNK = 50
        got = mixing.mix_documents(docs, "n").collect()
    finally:
        mixing.CHUNK = old
    assert len(got) == len(rows)
    for s in ("s0", "s1"):
        of = [r for r in got if r.source == s]
        assert abs(sum(r.n * r.n_copies for r in of) - of[0].target) <= 2 * of[0].source_size / len(of)
    repeats = [r.n_copies for r in got if r.doc_id == 9 and r.n == 40]
    assert len(set(repeats)) == 2       # some up, some down


def test_pairs_keep_the_sum_and_the_expectation():
    rng = np.random.default_rng(1)
    size, p = rng.integers(1, 100, 31).astype(float), rng.random(31)
    total = np.zeros(31)
    for turn in range(4000):
        out = mixing.settle_pairs(size, p, rng.integers(-2 ** 62, 2 ** 62, 31))
        assert ((out > 0) & (out < 1)).sum() <= 1 and (out * size).sum() == pytest.approx((p * size).sum())
        total += out
    assert np.abs(total / 4000 - p).max() < 0.04


def test_mix_of_nothing_and_clashing_names(spark):
    assert mixing.mix_digest(spark.createDataFrame([], DOCS)).count() == 0
    docs = spark.createDataFrame([(1, 4, "s", "mine", "x"), (2, None, "s", "mine", "y")],
                                 "doc_id long, n long, source string, target string, _row string")
    got = mixing.mix_documents(docs, "n").collect()
    assert {(r.target_in, r._row_in) for r in got} == {("mine", "x"), ("mine", "y")}
    assert sorted((r.doc_id, r.n_copies, r.source_size, r.target) for r in got) == [(1, 1, 4, 4.0), (2, 0, 4, 4.0)]
    assert mixing.mix_digest(spark.createDataFrame([(1, None, None, None, None)], DOCS)).first().taken == 0


VECTORS = "vec_id long, embedding array<float>, label int"
BAD = [(None, None), (None, []), (None, [0.5, None, 0.5]), (None, [math.nan, 1.0, 1.0]), (None, [math.inf, 1.0, 1.0])]


def some_vectors(n=400, dims=16, seed=2):
    rng = np.random.default_rng(seed)
    base = (rng.standard_normal((n, dims)) * np.linspace(0.1, 1, dims)) + 0.3
    return [(i, [float(np.float32(c)) for c in v], int(rng.integers(0, 4))) for i, v in enumerate(base)]


def plain_whitening(rows, k=4):
    x = {r: np.floor(256 * np.array(v, dtype=float)) for r, v in rows}
    fit = np.array(sorted({tuple(v) for v in x.values()}))
    n, mean = len(fit), fit.mean(0)
    e, v = np.linalg.eigh((fit - mean).T @ (fit - mean) / n)
    e, v = e[::-1][:k], v[:, ::-1][:, :k]
    far = {r: sum((int(a) * n - int(s)) ** 2 for a, s in zip(o, fit.sum(0))) for r, o in x.items()}
    return n, far, {r: (o - mean) @ v / np.sqrt(e) for r, o in x.items()}, e / ((fit - mean) ** 2).sum() * n


@pytest.mark.parametrize("width", [1, 8])
def test_whitening_against_eigenvectors(spark, width):
    rows = some_vectors() + [(1000 + i, [-0.0] + [0.0] * 15, 1) for i in range(50)]
    rows += [(i, v, 0) for i, v in BAD] + [(3, some_vectors()[5][1], 1)]
    got = whitening.whiten(spark.createDataFrame(rows, VECTORS).repartition(5), width=width).collect()
    good = [(j, r[1]) for j, r in enumerate(rows) if r[1] and len(r[1]) == 16]
    n, far, white, explained = plain_whitening(good)
    assert len(got) == 4 * len(good) and {r.n for r in got} == {n}
    assert max(r.identity_error for r in got) < 1e-9
    ids = [rows[j][0] for j, _ in good]
    for c in range(4):
        mine = sorted((r.vec_id, r.deviation, r.whitened) for r in got if r.component == c + 1)
        sign = np.sign(mine[0][2]) * np.sign(white[good[0][0]][c])
        want = sorted((i, far[j], sign * white[j][c]) for i, (j, _) in zip(ids, good))
        assert [m[:2] for m in mine] == [w[:2] for w in want]
        assert np.allclose([m[2] for m in mine], [w[2] for w in want], atol=1e-9)
        assert all(r.explained == pytest.approx(explained[c], rel=1e-9) for r in got if r.component == c + 1)


def test_whitening_of_ties_single_vectors_and_large_ones(spark):
    schema = "vec_id long, embedding array<double>"
    axes = [(i * 2 + s, [float((2 * s - 1) * (i == j)) for j in range(6)]) for i in range(6) for s in (0, 1)]
    got = whitening.whiten(spark.createDataFrame(axes, schema)).collect()       # six equal deviations
    assert len(got) == 12 * 4 and max(r.identity_error for r in got) < 1e-9
    assert all(r.explained == pytest.approx(1 / 6) for r in got)
    got = whitening.whiten(spark.createDataFrame(axes, schema), width=1).collect()
    assert len(got) == 12 * 4 and max(r.identity_error for r in got) < 1e-9
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).count() == 0
    mixed = [(1, [0.0]), (2, [1.0]), (3, [1.0, 1.0]), (4, [2.0, 2.0]), (None, [3.0, 3.0])]
    got = sorted((r.vec_id or 9, r.component, r.n) for r in whitening.whiten(spark.createDataFrame(mixed, schema)).collect())
    assert got == [(1, 1, 2), (2, 1, 2), (3, 1, 3), (4, 1, 3), (9, 1, 3)]       # one line: one component
    huge = [(i, [1e300 * i, float(i % 3)]) for i in range(5)]
    got = whitening.whiten(spark.createDataFrame(huge, schema)).collect()
    assert {r.deviation for r in got} == {None} and max(r.identity_error for r in got) < 1e-9


def plain_negatives(rows, positives=5, negatives=10):
    """Rows as (id, whole vector, label); by sorting all of them."""
    out = []
    order = lambda t: (-t[0], t[1] is None, t[1] or 0, t[2])
    for i, (a, x, label) in enumerate(rows):
        if a is None or a % 100:
            continue
        scored = [(sum(p * q for p, q in zip(x, y)), b, j) for j, (b, y, _) in enumerate(rows) if j != i and len(x) == len(y)]
        same = sorted((s for s in scored if rows[s[2]][2] == label), key=order)[:positives]
        other = sorted((s for s in scored if rows[s[2]][2] != label), key=order)
        for score, p, _ in same:
            found = [s for s in other if 30 * score <= 100 * s[0] <= 90 * score][:negatives]
            out += [(a, p, rank + 1, s[1], score, s[0]) for rank, s in enumerate(found)]
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [64, 4096])
def test_hard_negatives_against_all_rows(spark, block):
    rows = some_vectors(900, 12) + [(2000 + i, some_vectors(900, 12)[100][1], i % 3) for i in range(60)]     # copies, hot
    rows += [(200, rows[5][1], 1), (None, rows[100][1], 2), (5000, [1.0] * 3, 1), (5001, [1.0] * 3, 1), (5002, [0.5] * 3, 2)]
    rows += [(i, v, 1) for i, v in BAD] + [(100, rows[1][1], None)]
    df = spark.createDataFrame(rows, VECTORS)
    old = hard_negatives.BLOCK
    try:
        hard_negatives.BLOCK = block
        got = sorted((tuple(r) for r in hard_negatives.negatives_digest(df.repartition(5, "vec_id")).collect()), key=str)
    finally:
        hard_negatives.BLOCK = old
    label = lambda i, c: (c + 1) % 10 if i is not None and i % 7 == 0 else c
    good = [(i, [math.floor(256 * c) for c in v], label(i, c)) for i, v, c in rows
            if c is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    assert got == plain_negatives(good) and len(got) > 200


def test_hard_negatives_of_large_numbers_in_rounds_and_of_nothing(spark):
    rng = np.random.default_rng(4)
    rows = [(i * 50, [float(c) * 1e12 for c in rng.random(5)], int(i % 2)) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    old = hard_negatives.ROUND_BYTES
    try:
        hard_negatives.ROUND_BYTES = 400
        got = hard_negatives.hard_negatives(df, F.col("vec_id") % 100 == 0, F.col("label")).collect()
    finally:
        hard_negatives.ROUND_BYTES = old
    exact = plain_negatives([(i, [math.floor(256 * c) for c in v], c) for i, v, c in rows])
    clip = lambda v: min(v, hard_negatives.LONG)
    assert len(exact) > 100 and {r.positive_score for r in got} == {hard_negatives.LONG}
    assert sorted((tuple(r) for r in got), key=str) == sorted(((*e[:4], clip(e[4]), clip(e[5])) for e in exact), key=str)
    assert hard_negatives.negatives_digest(spark.createDataFrame([], VECTORS)).count() == 0
    assert hard_negatives.negatives_digest(spark.createDataFrame([(1, [1.0], 1), (100, [1.0], None)], VECTORS)).count() == 0


def test_whole_vectors_drop_what_is_no_vector(spark):
    rows = [(1, [0.1, -0.1, -0.0]), (2, [1e306]), (3, [1e300])] + [(9, v) for _, v in BAD]
    got = vectors.whole_vectors(spark.createDataFrame(rows, "k long, v array<double>"), "v").collect()
    assert [(r.k, r.x) for r in got] == [(1, [25.0, -26.0, 0.0]), (3, [256e300])]
    assert all(math.copysign(1, c) == 1 for c in got[0].x[2:])
