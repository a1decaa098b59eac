"""Near copies among embeddings by counting collisions of projections.

Vectors of unit length are projected on many random directions. A pair at the threshold falls
within a window of ``WINDOW`` standard deviations of its distance on each direction with a known
probability, so the number of collisions it reaches with probability ``RECALL`` is known too:
pairs that collide less often are dropped, the others are verified in double precision.

So that not all pairs need counting, vectors first meet in cells of compound projections, several
times over; their number and size follow from the number of vectors and the recall. Vectors that
are all but equal are counted as one ball: its members are linked among themselves for certain.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cartwheel.llm.common import map_batches, map_groups, settled
from cartwheel.llm.components import components

THRESHOLD = 0.95
PROJECTIONS = 48
WINDOW = 1.5
RECALL = 0.999
CELL = 1.5            # width of a cell on one projection
BALL = 0.9995         # cosine to the centre within which vectors count as one ball, or nearer
BLOCK = 2048          # vectors that meet in one task
SEED = 99


def directions(dimensions: int, seed: int = SEED) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((dimensions, PROJECTIONS))


def least_collisions(threshold: float, recall: float = RECALL) -> int:
    """Collisions that a pair at the threshold reaches with probability ``recall``."""
    p = math.erf(WINDOW / math.sqrt(2))
    below, count = 0.0, 0
    while count < PROJECTIONS:
        below += math.comb(PROJECTIONS, count) * p ** count * (1 - p) ** (PROJECTIONS - count)
        if below > 1 - recall:
            return count
        count += 1
    return count


def _same_cell(distance: float) -> float:
    """Probability that two vectors at this distance share a cell on one projection."""
    x = CELL / distance
    inside = math.erf(x / math.sqrt(2))
    return inside - math.sqrt(2 / math.pi) / x * (1 - math.exp(-x * x / 2))


def cell_plan(vectors: int, threshold: float, recall: float = RECALL) -> tuple[int, int]:
    """(projections in a cell, repetitions): unrelated vectors meet about fifty at a time, pairs
    at the threshold at least once with probability ``recall``."""
    apart = _same_cell(math.sqrt(2))
    depth = max(1, round(math.log(max(vectors, 50) / 50) / -math.log(apart)))
    near = _same_cell(math.sqrt(2 - 2 * threshold)) ** depth
    return depth, math.ceil(math.log(1 - recall) / math.log(1 - min(near, 0.9999)))


def ball_angle(threshold: float) -> float:
    """How far from its centre a member of a ball may be: any two members link for certain."""
    return min(math.acos(BALL), math.acos(threshold) / 2 - 1e-7)


def _matrix(column: pa.Array) -> np.ndarray:
    rows = column.to_pylist()
    return np.array(rows, dtype=float).reshape(len(rows), -1)


def usable(vector: str):
    """Not null, not empty, all components finite, not zero."""
    parts = F.col(vector).cast("array<double>")
    bad = F.exists(parts, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(parts, lambda x: x != 0), F.lit(False))


def _unit(rows: np.ndarray) -> np.ndarray:
    scaled = rows / np.abs(rows).max(1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))


def _cells(frame: DataFrame, dims: int, depth: int, tables: int, width: float, seed: int) -> DataFrame:
    """One row per vector and repetition: (turn, cell, node, vector)."""
    schema = "turn int, cell long, node long, vector array<double>"

    def cells(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        axes = directions(dims)
        rng = np.random.default_rng(seed)
        chosen = [rng.choice(PROJECTIONS, min(depth, PROJECTIONS), replace=False) for _ in range(tables)]
        shifts = rng.random((tables, min(depth, PROJECTIONS))) * width
        odd = (rng.integers(1, 2 ** 62, min(depth, PROJECTIONS)) * 2 + 1).astype(np.int64)
        for batch in rows:
            if not batch.num_rows:
                continue
            places = _unit(_matrix(batch.column("vector"))) @ axes
            for turn in range(tables):
                grid = np.floor((places[:, chosen[turn]] + shifts[turn]) / width).astype(np.int64)
                key = np.zeros(len(grid), np.int64)
                with np.errstate(over="ignore"):
                    for j in range(grid.shape[1]):
                        key = (key ^ grid[:, j]) * odd[j]
                        key ^= key >> 31
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(key), turn, np.int32)), pa.array(key), batch.column("node"),
                     batch.column("vector")], ["turn", "cell", "node", "vector"])

    return map_batches(frame, cells, schema)


def _collide(dims: int, threshold: float):
    """Verified links among the vectors of one block pair of a cell."""
    names = ["a", "b", "cosine"]
    empty = pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()),
                      "cosine": pa.array([], pa.float64())})
    reach = WINDOW * math.sqrt(2 - 2 * threshold)
    least = least_collisions(threshold)

    def collide(group: pa.Table) -> pa.Table:
        block = group.column("block").to_numpy()
        first, last = group.column("one")[0].as_py(), group.column("two")[0].as_py()
        order = np.argsort(group.column("node").to_numpy(), kind="stable")
        node = group.column("node").to_numpy()[order]
        block = block[order]
        unit = _unit(_matrix(group.column("vector").combine_chunks()))[order]
        places = (unit @ directions(dims)).astype(np.float32)
        left, right = np.flatnonzero(block == first), np.flatnonzero(block == last)
        found = []
        for start in range(0, len(left), 128):
            some = left[start:start + 128]
            count = np.zeros((len(some), len(right)), np.int8)
            for j in range(PROJECTIONS):   # the window around each query on each projection
                count += np.abs(places[some, j][:, None] - places[right, j][None, :]) <= reach
            i, k = np.nonzero(count >= least)
            i, k = some[i], right[k]
            if first == last:
                i, k = i[i < k], k[i < k]
            cosine = np.einsum("ij,ij->i", unit[i], unit[k])
            near = cosine >= threshold
            found.append((np.minimum(node[i], node[k])[near], np.maximum(node[i], node[k])[near], cosine[near]))
        if not found:
            return empty
        return pa.table([pa.array(np.concatenate(c)) for c in zip(*found)], names)

    return collide


def _links(frame: DataFrame, dims: int, threshold: float) -> DataFrame:
    """Pairs of nodes (a < b) with their cosine, each once."""
    depth, tables = cell_plan(frame.count(), threshold)
    spread = settled(_cells(frame, dims, depth, tables, CELL, SEED), "cells")
    sizes = spread.groupBy("turn", "cell").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    # a crowded cell becomes blocks, and each two of them meet in a task of their own
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    dealt = (spread.join(sizes, ["turn", "cell"])
             .withColumn("blocks", blocks)
             .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("turn", "cell", F.least("block", "other").alias("one"),
                     F.greatest("block", "other").alias("two"), "block", "node", "vector"))
    pairs = map_groups(dealt, ["turn", "cell", "one", "two"], _collide(dims, threshold),
                       "a long, b long, cosine double")
    return pairs.groupBy("a", "b").agg(F.max("cosine").alias("cosine"))


def near_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding",
                 threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``vectors``: its key, ``n_links`` (other rows linked directly),
    ``component_id`` (smallest key reachable) and ``kept`` (whether that is its own).

    Vectors that are null, empty, zero, or hold null or non-finite components link with nothing;
    vectors of another number of components link among themselves. Equal vectors are linked; rows
    that repeat a key are rows of their own. A null key stays null, is never the smallest of a
    component, and its row is kept only where it links with nothing. An empty table gives an empty
    result.
    """
    rows = settled(vectors.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("vector"))
                   .withColumn("row", F.monotonically_increasing_id())
                   .withColumn("ok", usable("vector"))
                   .withColumn("width", F.when(F.col("ok"), F.size("vector"))), "vectors")
    # a vector without another of its width is alone
    widths = [r["width"] for r in rows.filter("ok").groupBy("width").count().filter("count > 1").orderBy("width").collect()]
    found = (rows.filter(~F.coalesce(F.col("width").isin(widths), F.lit(False)))
             .select("key", F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component_id")))
    for width in widths:
        found = found.unionByName(_linked(rows.filter(F.col("width") == width), width, threshold))
    return found.select(
        F.col("key").alias(key), F.col("n_links").cast("long").alias("n_links"), "component_id",
        F.coalesce(F.col("key") == F.col("component_id"), F.col("n_links") == 0).alias("kept"))


def _linked(good: DataFrame, dims: int, threshold: float) -> DataFrame:
    """(key, n_links, component_id) of usable rows of ``dims`` components: (row, key, vector)."""
    # balls: in each fine cell the first row is the centre; who is close enough to it belongs to it
    fine = settled(_cells(good.select(F.col("row").alias("node"), "vector"), dims, 10, 1, 0.5, SEED + 1), "fine")
    centres = settled(fine.groupBy("cell").agg(F.min_by(F.struct("node", "vector"), "node").alias("c")), "centres")
    balls = settled(_near_centre(fine.join(centres, "cell").select("node", "vector", F.col("c.node").alias("centre"),
                                                                   F.col("c.vector").alias("centre_vector")), ball_angle(threshold)), "balls")
    # what is joined to all members of a ball or component is settled first: a large one can then be split
    heads = settled(balls.groupBy("ball").agg(F.count(F.lit(1)).alias("members"), F.max("angle").alias("radius")), "heads")
    ends = (balls.filter("node = ball").select("node", "vector"))
    most = balls.agg(F.max("angle")).first()[0] or 0.0
    limit = math.acos(threshold)
    # balls whose centres are a little too far apart may still have members that are near enough
    reach = math.cos(min(limit + 2 * most + 1e-9, math.pi))
    links = settled(_links(ends, dims, reach if most > 0 else threshold), "links")
    sized = (links.join(heads.select(F.col("ball").alias("a"), F.col("members").alias("a_n"), F.col("radius").alias("a_r")), "a")
             .join(heads.select(F.col("ball").alias("b"), F.col("members").alias("b_n"), F.col("radius").alias("b_r")), "b")
             .withColumn("angle", F.acos(F.least(F.col("cosine"), F.lit(1.0))))
             .withColumn("apart", F.col("a_r") + F.col("b_r")))
    alone = (F.col("a_n") == 1) & (F.col("b_n") == 1)
    # far enough from the limit to hold for all members whatever the last digits say
    slack = 1e-7
    sure = sized.filter(F.when(alone, F.col("cosine") >= threshold)
                        .otherwise(F.col("angle") + F.col("apart") < limit - slack))
    open_pairs = sized.filter(~alone & (F.col("angle") + F.col("apart") >= limit - slack)
                              & (F.col("angle") - F.col("apart") <= limit + slack)).select("a", "b")
    member = balls.select("ball", "node", "vector")
    single = settled(_verified(
        open_pairs.join(member.select(F.col("ball").alias("a"), F.col("node").alias("x"), F.col("vector").alias("x_vector")), "a")
        .join(member.select(F.col("ball").alias("b"), F.col("node").alias("y"), F.col("vector").alias("y_vector")), "b"),
        threshold), "single-links")

    sure = settled(sure.select("a", "b", "a_n", "b_n"), "ball-links")
    of_ball = settled(sure.select(F.col("a").alias("ball"), F.col("b_n").alias("n"))
               .unionByName(sure.select(F.col("b").alias("ball"), F.col("a_n").alias("n")))
               .groupBy("ball").agg(F.sum("n").alias("ball_links")), "links-of-balls")
    of_node = (single.select(F.col("x").alias("node")).unionByName(single.select(F.col("y").alias("node")))
               .groupBy("node").agg(F.count(F.lit(1)).alias("node_links")))
    ball_of = balls.select("node", "ball")
    edges = (sure.select("a", "b").unionByName(
        single.join(ball_of.select(F.col("node").alias("x"), F.col("ball").alias("a")), "x")
        .join(ball_of.select(F.col("node").alias("y"), F.col("ball").alias("b")), "y").select("a", "b").distinct()))
    roots = components(edges)
    placed = (good.select("row", "key").join(ball_of.withColumnRenamed("node", "row"), "row")
              .join(heads.select("ball", "members"), "ball")
              .join(of_ball, "ball", "left")
              .join(of_node.withColumnRenamed("node", "row"), "row", "left")
              .join(roots.withColumnRenamed("node", "ball"), "ball", "left")
              .select("row", "key", F.coalesce("root", "ball").alias("root"),
                      (F.col("members") - 1 + F.coalesce("ball_links", F.lit(0))
                       + F.coalesce("node_links", F.lit(0))).alias("n_links")))
    placed = settled(placed, "placed")
    smallest = settled(placed.groupBy("root").agg(F.min("key").alias("component_id")), "smallest")
    return placed.join(smallest, "root").select("key", "n_links", "component_id")


def _near_centre(frame: DataFrame, widest: float) -> DataFrame:
    """``ball`` and ``angle`` of every node: the centre of its cell, or itself."""
    schema = "node long, ball long, angle double, vector array<double>"

    def place(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            if not batch.num_rows:
                continue
            own, centre = (_unit(_matrix(batch.column(c))) for c in ("vector", "centre_vector"))
            node, head = (batch.column(c).to_numpy() for c in ("node", "centre"))
            # the arc cosine is blunt near 1: the chord gives the small angles
            angle = 2 * np.arcsin(np.clip(np.linalg.norm(own - centre, axis=1) / 2, 0, 1))
            inside = (angle <= widest) | (node == head)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array(np.where(inside, head, node)),
                 pa.array(np.where(inside & (node != head), angle, 0.0)), batch.column("vector")],
                ["node", "ball", "angle", "vector"])

    return map_batches(frame, place, schema)


def _verified(pairs: DataFrame, threshold: float) -> DataFrame:
    schema = "x long, y long"

    def verify(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            if not batch.num_rows:
                continue
            one, other = (_unit(_matrix(batch.column(c))) for c in ("x_vector", "y_vector"))
            near = np.einsum("ij,ij->i", one, other) >= threshold
            yield pa.RecordBatch.from_arrays([pa.array(batch.column(c).to_numpy()[near]) for c in "xy"], ["x", "y"])

    return map_batches(pairs, verify, schema)
