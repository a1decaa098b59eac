"""Near copies: of documents, of lines, of vectors; nearest neighbours; components."""

from __future__ import annotations

import random

import numpy as np
import pytest

import corpus_pipeline
from cartwheel.llm import components, jaccard, line_dedup, near_vectors, neighbours
from tests.llm.helpers import DOCS, Groups, corpus, distance, shingles, words


@pytest.mark.parametrize("size, percent", [(3, 90), (5, 80)])
def test_jaccard_classes_against_all_pairs(spark, size, percent):
    rows = corpus()
    got = sorted(tuple(r) for r in jaccard.jaccard_classes(spark.createDataFrame(rows, DOCS).repartition(7), size, percent)
                 .fillna(-1).select("doc_id", "n_shingles", "component_id", "n_links").collect())
    sets, groups, degree = [shingles(r[1], size) for r in rows], Groups(len(rows)), [0] * len(rows)
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                groups.join(i, j)
                degree[i] += 1
                degree[j] += 1
    smallest: dict[int, int] = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            root = groups.find(i)
            smallest[root] = min(smallest.get(root, r[0]), r[0])
    want = sorted((-1 if r[0] is None else r[0], len(s), smallest.get(groups.find(i), -1) if s else (-1 if r[0] is None else r[0]), d)
                  for i, (r, s, d) in enumerate(zip(rows, sets, degree)))
    assert got == want


def test_jaccard_at_the_limit_and_with_common_shingles(spark):
    """Exactly 9 of 10 shingles link; a passage in every text does not, and blocks lose no pair."""
    common = " ".join(f"c{i}" for i in range(12))
    texts = [f"{common} " + " ".join(f"w{i}x{j}" for j in range(60)) for i in range(50)]
    nine = " ".join(f"a{i}" for i in range(21))       # 19 shingles
    rows = [(i, t) for i, t in enumerate(texts)] + [(100, nine), (101, nine + " a21 a22"), (102, nine + " a21 a22 a23")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    old = jaccard.BLOCK
    try:
        jaccard.BLOCK = 3
        got = {r.doc_id: r.component_id for r in jaccard.jaccard_classes(docs).collect()}
    finally:
        jaccard.BLOCK = old
    assert got == {**{i: i for i in range(50)}, 100: 100, 101: 100, 102: 100}   # 19/21, 21/22


def test_jaccard_empty_table_and_first_of_each(spark):
    empty = spark.createDataFrame([], DOCS)
    assert jaccard.jaccard_classes(empty).count() == 0
    assert jaccard.keep_first(empty).columns == ["doc_id", "text", "lang", "source", "n_chars"]
    rows = [(5, "a b c d e f", "x"), (3, "A b c d e f", "y"), (3, "A b c d e f", "y"), (9, None, "z"), (8, "q", "w"), (None, "q", "v")]
    got = jaccard.keep_first(spark.createDataFrame(rows, "doc_id long, text string, sig string"))
    assert sorted((r.doc_id, r.sig) for r in got.collect()) == [(3, "y"), (8, "w"), (9, "z")]


def test_levels_weigh_longer_prefixes_against_candidates():
    assert jaccard.choose_level(np.array([2] * 10), 0, 10, 90) == 1          # cheap to verify
    assert jaccard.choose_level(np.array([2] * 40), 0, 100, 90) > 1          # dear to verify
    assert jaccard.choose_level(np.array([2] * 11 + [5000] * 9), 0, 100, 90) == 1   # dear to look through


def test_line_classes_against_all_pairs(spark):
    rng = random.Random(4)
    base = [words(rng, rng.randint(4, 25)) for _ in range(40)] + ["x" * n for n in (19, 20, 21, 59, 60, 61, 62, 63, 6000)]
    lines = list(base)
    for line in base:
        for edits in (1, 2, 3):
            new = list(line)
            for _ in range(edits):
                at, kind = rng.randrange(len(new)), rng.randrange(3)
                if kind == 0:
                    new[at] = "Z"
                elif kind == 1:
                    new.insert(at, "ß")
                elif len(new) > 1:
                    del new[at]
            lines.append("".join(new))
    rng.shuffle(lines)
    rows = [(i, "\n".join(lines[i * 3:i * 3 + 3] + ["short", ""])) for i in range(-(-len(lines) // 3))]
    rows += [(500, None), (501, ""), (None, base[0]), (502, lines[1] + "\n" + lines[1]), (503, lines[2]), (503, lines[2])]
    got = sorted((r.doc_id is None, r.doc_id, r.text is None, r.text or "", r.n_lines) for r in line_dedup.dedup_lines(
        spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect())
    unique = sorted({line for _, t in rows for line in (t or "").split("\n") if len(line) >= line_dedup.LEAST})
    at, groups = {x: i for i, x in enumerate(unique)}, Groups(len(unique))
    for a in unique:
        for b in unique:
            allowed = int(line_dedup.allowed(np.array(min(len(a), len(b)))))
            if a < b and abs(len(a) - len(b)) <= allowed and (len(a) > 1000 or distance(a, b) <= allowed):
                groups.join(at[a], at[b])
    first: dict[int, tuple] = {}
    ordered = sorted({(i is None, i or 0, t) for i, t in rows if t is not None})
    for none, i, t in ordered:
        for j, line in enumerate(t.split("\n")):
            if line in at:
                first.setdefault(groups.find(at[line]), (none, i, t, j))
    want = []
    for i, t in rows:
        kept = None if t is None else "\n".join(
            line for j, line in enumerate(t.split("\n"))
            if line not in at or first[groups.find(at[line])] == (i is None, i or 0, t, j))
        want.append((i is None, i, t is None, kept or "", 0 if t is None else t.count("\n") + 1))
    assert got == sorted(want)


def test_hot_segments_meet_in_blocks(spark):
    """Lines that share a segment with many others are found whatever the blocks."""
    rng = random.Random(8)
    rows = [(i, "the very same beginning of a line " + words(rng, 5)) for i in range(200)]
    rows += [(300 + i, t + "!") for i, t in rows[:40]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    old = line_dedup.BLOCK, line_dedup.SPLIT, line_dedup.SAMPLE, line_dedup.PIECE
    try:
        line_dedup.BLOCK, line_dedup.SPLIT, line_dedup.SAMPLE, line_dedup.PIECE = 32, 20, 1, 100
        removed = {r.doc_id for r in line_dedup.dedup_lines(docs).filter("n_removed > 0").collect()}
    finally:
        line_dedup.BLOCK, line_dedup.SPLIT, line_dedup.SAMPLE, line_dedup.PIECE = old
    assert removed == set(range(300, 340))


def test_a_crowded_key_is_met_in_pieces(monkeypatch):
    """Twenty thousand lines under one segment: no more than a piece of their pairs at a time."""
    import tracemalloc

    import pyarrow as pa
    n = 20_000
    order = np.arange(n, dtype=np.uint16)
    tall = (np.arange(n) // 40 % 250).astype(np.uint8)
    group = pa.table({"load": [7], "filed": [1000], "keys": [line_dedup._planes(np.full(n, 5, np.uint64), "<u4")[:3 * n]],
                      "lines": [line_dedup._planes(order, "<u2")], "tall": [tall.tobytes()],
                      "near": [line_dedup._planes(np.zeros(n, np.uint16), "<u2")]})
    tracemalloc.start()
    pairs = line_dedup._meet(group)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    wide = tall.astype(int)
    want = sum(int((np.abs(wide[i] - wide) <= 8).sum()) - 1 - int((np.abs(wide[i] - wide[:i]) <= 8).sum()) for i in range(1000))
    assert pairs.num_rows == want and peak < 400 << 20


def test_pair_counts_never_tell_near_lines_apart():
    rng = random.Random(3)
    for _ in range(200):
        a = words(rng, rng.randint(4, 90))[:rng.randint(20, 600)].ljust(20, "x")
        b = list(a)
        for _ in range(rng.randint(0, len(a) // 20)):
            at = rng.randrange(len(b))
            b[at:at + rng.randint(0, 1)] = rng.choice(["", "Z", "é"])
        b = "".join(b)
        one, two = line_dedup.pair_counts([a, b]).astype(int)
        assert np.abs(one - two).sum() <= 4 * distance(a, b)


def test_edit_distances():
    rng = random.Random(2)
    pairs = []
    for _ in range(400):
        a = "".join(rng.choice("abc") for _ in range(rng.randint(1, 12)))
        pairs.append((a, "".join(rng.choice("abc") if rng.random() < 0.2 else c for c in a if rng.random() > 0.1)))
    assert [min(3, distance(a, b)) for a, b in pairs] == list(line_dedup.edit_distances(pairs, 2))


def test_copies_of_a_line_are_not_linked_each_with_each(spark):
    """Eighty lines, each a word away from the others, are one class by about as many links."""
    line = words(random.Random(9), 30)
    docs = spark.createDataFrame([(f"{line[:60]}{i:02d}{line[62:]}",) for i in range(80)], "text string").repartition(3)
    links = line_dedup.line_links(docs).collect()
    classes = components.components(spark.createDataFrame(links, "a binary, b binary")).collect()
    assert len(classes) == 80 and len({r.root for r in classes}) == 1
    assert len(links) < 160


def test_long_lines_may_differ_by_more(spark):
    """Five edits in a hundred characters, in one word or dealt over the line, whatever its length."""
    rng = random.Random(12)
    rows, gone = [], set()
    for i, size in enumerate((41, 59, 60, 79, 99, 100, 138, 160, 333, 542, 799, 1300, 4000)):
        line = words(rng, 1000)[:size - 1] + "."
        most = int(line_dedup.allowed(np.array(size)))
        assert most == size // 20
        at = size // 3
        dealt = list(line)
        for j in range(most):
            dealt[j * 20 + 7] = "Z"
        grown = list(line)
        for j in range(most):
            grown.insert(j * 21, "Z")
        near = [line[:at] + "Q" * most + line[at + most:], "".join(dealt), "".join(grown), "Y" * most + line]
        far = list(line)
        for j in range(most + 1):
            far[j * 19 + 1] = chr(0x410 + j % 30)
        rows += [(100 * i, line), *((100 * i + 1 + j, x) for j, x in enumerate(near)), (100 * i + 50, "".join(far))]
        gone |= {100 * i + 1 + j for j in range(len(near))}
        assert distance(line, near[0]) <= most and (size > 400 or distance(line, rows[-1][1]) == most + 1)
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert {r.doc_id for r in got.filter("n_removed > 0").collect()} == gone


@pytest.mark.parametrize("most", [3, 9, 40])
def test_edit_distances_of_wide_bands(most):
    rng = random.Random(most)
    pairs = []
    for _ in range(150):
        a = "".join(rng.choice("abcd") for _ in range(rng.randint(0, 90)))
        share = rng.random() * 0.5
        pairs.append((a, "".join(rng.choice("abcd") if rng.random() < share else c for c in a if rng.random() > share / 2)))
    assert [min(most + 1, distance(a, b)) for a, b in pairs] == list(line_dedup.edit_distances(pairs, most))


def test_short_lines_go_if_equal_and_copies_with_blank_lines_go_whole(spark):
    rng = random.Random(5)
    long = words(rng, 12)
    rows = [(1, f"{long}\n\n}}\nshort\n"), (2, f"{long}\n\n}}\nshort\n"), (3, "shore\n \u3000\n}\n}"), (4, "\n"), (5, None), (6, "short")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS).repartition(3)
    got = {r.doc_id: (r.text, r.n_removed) for r in line_dedup.dedup_lines(docs).collect()}
    assert got == {1: (rows[0][1], 0), 2: ("\n", 3), 3: ("shore\n \u3000", 2), 4: ("\n", 0), 5: (None, 0), 6: ("", 1)}
    assert {r.doc_id for r in corpus_pipeline.dedup_lines(spark, docs, "").collect()} == {1, 3, 4, 5}


def test_empty_lines_table(spark):
    assert line_dedup.dedup_lines(spark.createDataFrame([], "doc_id long, text string, n_lines int")).columns == [
        "doc_id", "text", "n_lines_in", "n_lines", "n_removed"]


def test_stages_keep_columns_whose_names_clash(spark):
    """Columns that stages use themselves come out as they went in."""
    names = ["lang_pred", "score", "n_lines", "n_removed", "_k1", "_gone", "_key"]
    rows = [(i, f"a line of some words, number {i} of them\nand one more line {i * 7}", "en" if i % 2 else "de", "s", 1, *[f"{n}{i}" for n in names])
            for i in range(12)]
    docs = spark.createDataFrame(rows, DOCS + "".join(f", {n} string" for n in names))
    for _, stage in corpus_pipeline.STAGES[:3]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns
        kept = out.collect()
        assert kept and all(r[n] == f"{n}{r.doc_id}" for r in kept for n in names)
        assert stage(spark, docs.limit(0), "").count() == 0


def vectors(seed: int = 3) -> list[tuple]:
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((150, 16))
    near = [x[i] + rng.standard_normal(16) * s for i in range(40) for s in (0.01, 0.1, 0.25, 0.3)]
    tight = [x[0] * 3 + rng.standard_normal(16) * 1e-4 for _ in range(60)]
    rows = [(i, [float(v) for v in row]) for i, row in enumerate([*x, *near, *tight])]
    rows += [(900 + i, rows[5][1]) for i in range(4)] + [(rows[6][0], rows[6][1])]
    return rows + [(950, None), (951, []), (952, [0.0] * 16), (953, [1.0, None] + [0.0] * 14), (954, [float("nan")] * 16),
                   (955, [float("inf")] + [0.0] * 15), (956, [1.0, 2.0]), (None, rows[7][1])]


def test_near_vectors_against_all_pairs(spark):
    rows = vectors()
    got = sorted((-1 if r.vec_id is None else r.vec_id, r.n_links, r.component_id) for r in near_vectors.near_vectors(
        spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)).collect())
    good = [i for i, (_, v) in enumerate(rows) if v and len(v) == 16 and None not in v and np.isfinite(v).all() and any(v)]
    x = np.array([rows[i][1] for i in good], np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    linked = x @ x.T >= near_vectors.THRESHOLD
    groups = Groups(len(rows))
    for i, j in zip(*np.nonzero(linked)):
        groups.join(good[i], good[j])
    smallest: dict[int, int] = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            smallest[groups.find(i)] = min(smallest.get(groups.find(i), key), key)
    links = dict(zip(good, linked.sum(1) - 1))
    want = sorted((-1 if key is None else key, int(links.get(i, 0)), smallest.get(groups.find(i), key)) for i, (key, _) in enumerate(rows))
    assert got == want


def test_collision_counts_are_calibrated():
    rng = np.random.default_rng(1)
    a = rng.standard_normal((2000, 16))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal((2000, 16))
    b -= (a * b).sum(1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    t = near_vectors.THRESHOLD
    other = t * a + np.sqrt(1 - t * t) * b
    reach = near_vectors.WINDOW * np.sqrt(2 - 2 * t)
    hits = (np.abs((a - other) @ near_vectors.directions(16)) <= reach).sum(1)
    # the few directions are shared by all pairs, so the share varies a little more than by chance
    assert (hits >= near_vectors.least_collisions(t)).mean() > 0.98


def test_nearest_recall_and_small_tables(spark):
    rng = np.random.default_rng(6)
    x = rng.standard_normal((1500, 12)) * rng.uniform(0.5, 2, (1500, 1))
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(x)] + [(5000, None), (5020, [0.0] * 12)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    old = neighbours.BLOCK
    try:
        neighbours.BLOCK = 300        # several blocks, so that the graph is searched
        found: dict[int, list] = {}
        for r in neighbours.nearest(frame, frame.vec_id % 20 == 0).collect():
            found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    finally:
        neighbours.BLOCK = old
    assert set(found) == set(range(0, 1500, 20))
    hits = 0
    for q, best in found.items():
        best.sort()
        scores = x @ x[q]
        assert [b[0] for b in best] == list(range(1, 21)) and q not in [b[1] for b in best]
        assert np.allclose([b[2] for b in best], [scores[b[1]] for b in best])
        scores[q] = -np.inf
        hits += len({b[1] for b in best} & set(np.argsort(-scores)[:20]))
    assert hits >= 0.9 * 20 * len(found)
    few = spark.createDataFrame([(0, [1.0, 0.0]), (20, [1.0, 0.0]), (7, [0.5, 0.0]), (3, [0.5, 0.0])], "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in neighbours.nearest(few, few.vec_id % 20 == 0).collect())
    assert got == [(0, 1, 20, 1.0), (0, 2, 3, 0.5), (0, 3, 7, 0.5), (20, 1, 0, 1.0), (20, 2, 3, 0.5), (20, 3, 7, 0.5)]
    assert neighbours.nearest(few.filter("false"), few.vec_id == 0).count() == 0


def test_nearest_among_copies(spark):
    """Copies do not hide other neighbours, and the copies with the smallest ids come first."""
    rng = np.random.default_rng(7)
    x = rng.standard_normal((500, 12))
    x[400:] = x[0] * 1.5                                              # a group of 100
    x[1] = x[0] * 1.4 + rng.standard_normal(12) * 0.01                # near it
    x[2] = x[0] * 1.6                                                 # better than the copies
    x[200:210] = x[300]                                               # a small group
    ids = np.arange(500)
    ids[400:] = rng.permutation(np.arange(400, 500))
    rows = [(int(i), [float(v) for v in row]) for i, row in zip(ids, x)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(6)
    asks = [1, 2, 300, 405, 499]
    old = neighbours.BLOCK
    try:
        neighbours.BLOCK = 150
        got = neighbours.nearest(frame, frame.vec_id.isin(asks)).collect()
    finally:
        neighbours.BLOCK = old
    for q in asks:
        at = int(np.flatnonzero(ids == q)[0])
        scores = np.round(x @ x[at], 9)
        want = [int(ids[i]) for i in np.lexsort((ids, -scores)) if i != at][:20]
        found = [r.vec_id for r in sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])]
        if q == 300:
            assert len(set(found) & set(want)) >= 18 and found[:10] == want[:10]
        else:
            assert found == want


def test_one_long_vector_does_not_spoil_the_graph(spark):
    rng = np.random.default_rng(9)
    x = rng.standard_normal((600, 12))
    x[599] = x[599] * 1e20
    frame = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "vec_id long, embedding array<double>")
    old = neighbours.BLOCK
    try:
        neighbours.BLOCK = 150
        got = neighbours.nearest(frame, frame.vec_id % 20 == 0).collect()
    finally:
        neighbours.BLOCK = old
    hits = 0
    for q in range(0, 600, 20):
        scores = x[:599] @ x[q]
        scores[q] = -np.inf
        hits += len({r.vec_id for r in got if r.query_id == q} & set(np.argsort(-scores)[:19]))
    assert hits >= 0.9 * 19 * 30


def test_nearest_of_a_small_table_comes_through_rounds(spark, monkeypatch):
    """With production blocks: the first lists know only short runs, the rounds find the rest. Vectors of another width are
    searched among themselves."""
    rng = np.random.default_rng(12)
    x = rng.standard_normal((500, 12))
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(x)]
    rows += [(1000, [1.0, 0.0]), (1001, [2.0, 1.0]), (1002, [-1.0, 0.0]), (1003, [3.0])]
    monkeypatch.setattr(neighbours, "RUN", 40)
    rounds, one_round = [], neighbours._round
    monkeypatch.setattr(neighbours, "_round", lambda *given: rounds.append(1) or one_round(*given))
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = neighbours.nearest(frame, frame.vec_id % 20 == 0).collect()
    assert len(rounds) >= 3
    assert [(r["rank"], r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == 1000] == [
        (1, 1001, 2.0), (2, 1002, -1.0)]
    hits = 0
    for q in range(0, 500, 20):
        scores = x @ x[q]
        scores[q] = -np.inf
        hits += len({r.vec_id for r in got if r.query_id == q} & set(np.argsort(-scores)[:20]))
    assert hits >= 0.95 * 20 * 25


def test_balls_follow_the_threshold_and_widths_stay_apart(spark):
    """Members of a ball are linked unchecked, so a ball is never wider than half the threshold."""
    rng = np.random.default_rng(4)
    centre = rng.standard_normal(16)
    centre /= np.linalg.norm(centre)
    rows = []
    for i in range(60):
        side = rng.standard_normal(16)
        side -= (side @ centre) * centre
        rows.append((i, [float(v) for v in centre + side / np.linalg.norm(side) * 0.02]))
    rows += [(100, [1.0, 2.0]), (101, [2.0, 4.0]), (102, [5.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    x = np.array([v for _, v in rows[:60]])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for threshold in (0.9999, 0.9996, 0.95):
        got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_vectors.near_vectors(frame, threshold=threshold).collect()}
        assert [got[i][0] for i in range(60)] == ((x @ x.T >= threshold).sum(1) - 1).tolist()
        assert (got[100], got[101], got[102]) == ((1, 100, True), (1, 100, False), (0, 102, True))


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (200, 200), (None, 3)] + [(300, i) for i in range(301, 340)]
    got = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    groups: dict[int, set] = {}
    for r in got:
        groups.setdefault(r.root, set()).add(r.node)
    assert sorted(map(min, groups.values())) == [0, 100, 200, 300] and len(got) == 41 + 3 + 1 + 40
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_far_copies_in_a_crowd_are_no_rows(spark, monkeypatch):
    """Sixty changed copies of a line, a third of them too far from most others: classes as of all pairs, and
    no table of pairs that grows with the square of the group."""
    rng = random.Random(21)
    line = words(rng, 40)[:120]
    copies = {line}
    while len(copies) < 60:
        new = list(line)
        for at in rng.sample(range(8, 112), rng.choice((1, 2, 3, 5, 6))):
            new[at] = rng.choice("QXYZ")
        copies.add("".join(new))
    copies = sorted(copies)
    made, old = [], line_dedup._linked
    monkeypatch.setattr(line_dedup, "_linked", lambda every, pairs: (made.append(pairs.count()), old(every, pairs))[1])
    docs = spark.createDataFrame([(t,) for t in copies], "text string").repartition(3)
    links = line_dedup.line_links(docs).collect()
    groups = Groups(len(copies))
    for i, a in enumerate(copies):
        for j in range(i):
            if distance(a, copies[j]) <= int(line_dedup.allowed(np.array(min(len(a), len(copies[j]))))):
                groups.join(i, j)
    want = {}
    for i, t in enumerate(copies):
        want.setdefault(groups.find(i), set()).add(line_dedup.line_id(t))
    found = {}
    for r in components.components(spark.createDataFrame(links, "a binary, b binary")).collect():
        found.setdefault(r.root, set()).add(bytes(r.node))
    assert sorted(map(sorted, found.values())) == sorted(sorted(map(bytes, c)) for c in want.values() if len(c) > 1)
    assert sum(made) < 4 * len(copies)
