"""Vectors as whole numbers, and sums of small matrices over all of them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from cartwheel.llm.common import map_batches

SCALE = 256


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of an Arrow list column whose lists are equally long and hold no null."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)


def lists(values: np.ndarray, lengths: np.ndarray, kind=pa.float64()) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def whole_vectors(frame: DataFrame, vector: str) -> DataFrame:
    """The other columns of ``frame`` and ``x``: floor(256 * component) as exact doubles. Rows go
    whose vector is null or empty, or holds a null, or a component that is not finite once scaled."""
    others = [c for c in frame.columns if c != vector]
    schema = StructType([*(f for f in frame.schema.fields if f.name != vector),
                         StructField("x", ArrayType(DoubleType()))])

    def whole(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            given = batch.column(vector)
            lengths = pc.fill_null(pc.list_value_length(given), 0).to_numpy(zero_copy_only=False)
            values = given.flatten().to_numpy(zero_copy_only=False).astype(float)   # null reads as NaN
            with np.errstate(over="ignore", invalid="ignore"):
                values = np.floor(values * SCALE) + 0.0                            # no -0.0
            owner = np.repeat(np.arange(len(lengths)), lengths)
            good = lengths > 0
            good[owner[~np.isfinite(values)]] = False
            kept = batch.select(others).filter(pa.array(good))
            yield pa.RecordBatch.from_arrays([*kept.columns, lists(values[good[owner]], lengths[good])], [*others, "x"])

    ordered = frame.select(*others, F.col(vector).cast("array<double>").alias(vector))
    return map_batches(ordered, whole, schema)


def summed(frame: DataFrame, fn: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """Sum of ``fn`` (``size`` numbers, bounded by the dimensions) over blocks of the rows of ``x``.
    Tasks add up their blocks, and Spark adds up the tasks."""
    def add(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in rows:
            if batch.num_rows:
                total += fn(matrix(batch.column("x")))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], ["at", "part"])

    parts = map_batches(frame.select("x"), add, "at int, part double")
    out = np.zeros(size)
    for row in parts.groupBy("at").agg(F.sum("part").alias("part")).collect():
        out[row["at"]] = row["part"]
    return out
