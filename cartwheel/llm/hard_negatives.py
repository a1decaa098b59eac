"""Hard negatives by a BOND vertical scan.

Anchors are compared with all rows in blocks. A block lies in columns, one for each dimension, and
each anchor reads them in the order of its own components, largest magnitude first. After some
dimensions a candidate's score is known up to what the remaining ones may add, which the smallest
and largest value of each column bound. Candidates whose bounds leave every window leave the
bitmap; the few that stay get their exact scores when the columns are read to the end.

A first scan finds each anchor's positives, the nearest rows of its label; a second one the rows
of other labels within a window below each positive. A task keeps the best of each anchor over all
its blocks, so later blocks are cut earlier, and Spark merges what the tasks kept. Anchors are
handed out in rounds of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from cartwheel.llm.common import map_batches, partitions_for, settled
from cartwheel.llm.vectors import matrix, whole_vectors
from cartwheel.session import scratch_folder

POSITIVES = 5
NEGATIVES = 10
LOWEST, HIGHEST = 30, 90    # per cent of the positive's score
BLOCK = 4096                # rows that are scanned at once
STEP = 8                    # dimensions read between two looks at the bitmap
ROUND_BYTES = 32 << 20      # of anchors handed to every task at once
LONG = (1 << 63) - 1
MOST_DIGITS = 10 ** 37      # scores are told apart up to here

_FOUND = "anchor long, part int, score decimal(38,0), id long, row long"
_OUT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


class Block:
    """Rows of one length as columns, ordered by label."""

    def __init__(self, x: np.ndarray, row: np.ndarray, ids: np.ndarray, known: np.ndarray, label: np.ndarray) -> None:
        order = np.argsort(label, kind="stable")
        self.columns = np.ascontiguousarray(x[order].T)
        self.row, self.ids, self.known, self.label = row[order], ids[order], known[order], label[order]
        self.low, self.high = self.columns.min(1), self.columns.max(1)
        self.most = float(np.abs(self.columns).max())

    def of_label(self, label: int) -> tuple[int, int]:
        return np.searchsorted(self.label, label, "left"), np.searchsorted(self.label, label, "right")


def _exact(anchor: np.ndarray, block: Block) -> bool:
    """Whether doubles hold every partial score as the whole number it is."""
    return float(np.abs(anchor).max()) * block.most * len(anchor) < 2.0 ** 53


def scan(anchor: np.ndarray, block: Block, at: np.ndarray, narrow) -> tuple[np.ndarray, np.ndarray]:
    """(places, scores) of the candidates ``at`` that ``narrow(lowest, highest)`` never left out."""
    columns, low, high = block.columns, block.low, block.high
    if not _exact(anchor, block):    # whole numbers of any size
        whole = np.frompyfunc(int, 1, 1)
        anchor, columns, low, high = (whole(v) for v in (anchor, columns, low, high))
    order = np.argsort(-np.abs(anchor), kind="stable")
    ends = np.stack([anchor * low, anchor * high])[:, order]
    # what the dimensions from each place on may add at least and at most
    least, most = (np.concatenate([np.cumsum(e[::-1])[::-1], [0]]) for e in (ends.min(0), ends.max(0)))
    whole_block = len(at) == columns.shape[1]
    score = 0
    for start in range(0, len(order), STEP):
        dims = order[start:start + STEP]
        part = columns[dims] if whole_block else columns[np.ix_(dims, at)]
        score = score + anchor[dims] @ part
        done = start + len(dims)
        stay = narrow(score + least[done], score + most[done])
        if not stay.all():
            at, score, whole_block = at[stay], score[stay], False
            if not len(at):
                break
    return at, score


def _kth_largest(values: np.ndarray, k: int):
    """None if there are fewer than ``k``."""
    if len(values) < k:
        return None
    return np.sort(values)[-k] if values.dtype == object else np.partition(values, len(values) - k)[len(values) - k]


class Best:
    """The first ``k`` found so far: higher scores first, then smaller ids (null last), then rows."""

    def __init__(self, k: int) -> None:
        self.k, self.rows = k, []

    @property
    def bar(self):
        return -self.rows[-1][0] if len(self.rows) == self.k else None

    def add(self, block: Block, at: np.ndarray, score: np.ndarray) -> None:
        if self.bar is not None:
            good = score >= self.bar
            at, score = at[good], score[good]
        if len(at) > self.k:
            good = score >= _kth_largest(score, self.k)
            at, score = at[good], score[good]
        if len(at) > self.k:        # ties at the end
            tied = score == score.min()
            last = at[tied]
            last = last[np.lexsort((block.row[last], block.ids[last], ~block.known[last]))][:self.k - int((~tied).sum())]
            at, score = np.concatenate([at[~tied], last]), np.concatenate([score[~tied], score[tied][:len(last)]])
        new = [(-int(s), not block.known[a], int(block.ids[a]), int(block.row[a])) for a, s in zip(at, score)]
        self.rows = sorted(self.rows + new)[:self.k]


def _positives(anchor, block: Block, best: Best) -> None:
    start, end = block.of_label(anchor["label"])
    at = np.arange(start, end)
    at = at[block.row[at] != anchor["row"]]
    if not len(at):
        return

    def narrow(lowest, highest):
        bars = [b for b in (_kth_largest(lowest, best.k), best.bar) if b is not None]
        return (highest >= max(bars)).astype(bool) if bars else np.ones(len(highest), bool)

    best.add(block, *scan(anchor["x"], block, at, narrow))


def _negatives(anchor, block: Block, windows: list) -> None:
    """``windows``: (lowest score, highest score, Best) for each positive."""
    start, end = block.of_label(anchor["label"])
    at = np.concatenate([np.arange(start), np.arange(end, len(block.row))])
    if not len(at):
        return

    def narrow(lowest, highest):
        stay = np.zeros(len(highest), bool)
        for low, high, best in windows:
            inside = (lowest >= low) & (highest <= high)      # in this window whatever comes
            bar = low
            for b in (_kth_largest(lowest[inside], best.k), best.bar):
                bar = b if b is not None and b > bar else bar
            stay |= ((highest >= bar) & (lowest <= high)).astype(bool)
        return stay

    at, score = scan(anchor["x"], block, at, narrow)
    for low, high, best in windows:
        if len(at):
            good = ((score >= low) & (score <= high)).astype(bool)
            best.add(block, at[good], score[good])


def _blocks(rows: Iterator[pa.RecordBatch]) -> Iterator[dict[int, Block]]:
    """About ``BLOCK`` rows at a time, by their number of components."""
    held, size = [], 0
    for batch in rows:
        for start in range(0, batch.num_rows, BLOCK):
            part = batch.slice(start, BLOCK)
            held.append(part)
            size += part.num_rows
            if size >= BLOCK:
                yield _block(held)
                held, size = [], 0
    if size:
        yield _block(held)


def _block(parts: list[pa.RecordBatch]) -> dict[int, Block]:
    table = pa.Table.from_batches(parts)
    width = table.column("width").to_numpy()
    out = {}
    for w in np.unique(width):
        some = table.filter(pa.array(width == w))
        ids = some.column("id")
        out[int(w)] = Block(matrix(some.column("x")), some.column("row").to_numpy(), ids.fill_null(0).to_numpy(),
                            ids.is_valid().to_numpy(), some.column("label").to_numpy())
    return out


def _found(pieces: Iterator[tuple[int, int, Best]]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in _FOUND.split(", ")]
    rows = [(a, part, Decimal(max(-MOST_DIGITS, min(MOST_DIGITS, -s))), None if unknown else i, row)
            for a, part, best in pieces for s, unknown, i, row in best.rows]
    for start in range(0, len(rows), 8192):
        columns = zip(*rows[start:start + 8192])
        kinds = (pa.int64(), pa.int32(), pa.decimal128(38, 0), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def _as_long(score) -> int:
    return max(-LONG - 1, min(LONG, int(score)))


def _merged(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` of each anchor and part, with ``rank``; parts of tasks hold ``k`` rows each."""
    order = Window.partitionBy("anchor", "part").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _windows(anchor: dict) -> list:
    """(part, lowest score, highest score) of each positive; none where nothing can be in it."""
    out = []
    for part, (score, _, _) in enumerate(anchor["positives"]):
        low, high = -(-LOWEST * score // 100), HIGHEST * score // 100
        if low <= high:
            out.append((part, low, high))
    return out


def hard_negatives(vectors: DataFrame, is_anchor: Column, label: Column, key: str = "vec_id",
                   vector: str = "embedding", positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    Scores are inner products of components times 256, rounded down, in whole numbers. A positive is
    one of the first ``positives`` other rows of the anchor's label; its negatives are the first
    ``negatives`` rows of other labels whose score is 30 to 90 per cent of its own. Rows with a
    null label, or a vector that is null or empty, or holds a null or a component not finite (times
    256), take no part. Only vectors of one length are compared. A row is not compared with
    itself, but with rows that repeat it, and an anchor that is there twice is two anchors. Ties
    go to the smaller key; a null key is the largest. Scores are compared exactly up to 37 digits; one beyond a
    long is given as the nearest long. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    given = vectors.select(F.col(key).cast("long").alias("id"), label.cast("long").alias("label"),
                           F.coalesce(is_anchor, F.lit(False)).alias("asks"), F.col(vector).alias("vector"))
    rows = settled(whole_vectors(given.filter("label is not null"), "vector").withColumns(
        {"width": F.size("x"), "row": F.monotonically_increasing_id()}), "negative-rows")
    asked = rows.filter("asks").agg(F.count(F.lit(1)).alias("n"), F.max("width").alias("width")).first()
    if not asked["n"]:
        return spark.createDataFrame([], _OUT)
    # half of what a round may hold, as hashes deal anchors out not quite evenly
    rounds = partitions_for(asked["n"] * asked["width"] * 8, ROUND_BYTES / 2)
    folder = scratch_folder(spark, "llm-hard-negatives")
    round_of = F.pmod(F.xxhash64("row"), F.lit(rounds))
    for turn in range(rounds):
        some = rows.filter(F.col("asks") & (round_of == turn)).select("row", "id", "label", "x").collect()
        _one_round(rows, some, positives, negatives).write.mode("append").parquet(folder)
    return spark.read.schema(_OUT).parquet(folder)


def _one_round(rows: DataFrame, asked: list, k: int, n: int) -> DataFrame:
    anchors = {r["row"]: {"row": r["row"], "id": r["id"], "label": r["label"], "x": np.array(r["x"]), "positives": []}
               for r in asked}
    shared = rows.sparkSession.sparkContext.broadcast(anchors)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        best = {a: Best(k) for a in own}
        for blocks in _blocks(batches):
            for a, anchor in own.items():
                if len(anchor["x"]) in blocks:
                    _positives(anchor, blocks[len(anchor["x"])], best[a])
        yield from _found((a, 0, b) for a, b in best.items())

    scanned = rows.select("row", "id", "label", "width", "x")
    near = _merged(map_batches(scanned, nearest, _FOUND), k)
    for r in near.orderBy("anchor", "rank").collect():      # k for each anchor of the round
        anchors[r["anchor"]]["positives"].append((int(r["score"]), r["id"], r["row"]))
    known = rows.sparkSession.sparkContext.broadcast(anchors)

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = {a: (anchor, [(p, low, high, Best(n)) for p, low, high in _windows(anchor)])
               for a, anchor in known.value.items()}
        for blocks in _blocks(batches):
            for anchor, windows in own.values():
                if windows and len(anchor["x"]) in blocks:
                    _negatives(anchor, blocks[len(anchor["x"])], [w[1:] for w in windows])
        yield from _found((a, p, b) for a, (_, windows) in own.items() for p, _, _, b in windows)

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = known.value
        for batch in batches:
            pairs = list(zip(batch.column("anchor").to_pylist(), batch.column("part").to_pylist()))
            places = [own[a]["positives"][p] for a, p in pairs]
            yield pa.RecordBatch.from_arrays(
                [pa.array([own[a]["id"] for a, _ in pairs], pa.int64()), pa.array([p[1] for p in places], pa.int64()),
                 batch.column("rank"), batch.column("id"), pa.array([_as_long(p[0]) for p in places], pa.int64()),
                 pa.array([_as_long(s) for s in batch.column("score").to_pylist()], pa.int64())],
                ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])

    best = _merged(map_batches(scanned, within, _FOUND), n)
    return map_batches(best.select("anchor", "part", "rank", "id", "score"), named, _OUT)


def negatives_digest(vectors: DataFrame) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors, F.col("vec_id") % 100 == 0, moved)
