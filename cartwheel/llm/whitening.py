"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

With X the centred rows, blocks of orthonormal columns V and U grow in turn: XV is a distributed
product, and so is X'U. What each new block has in common with all earlier ones is taken out (full
reorthogonalisation), so X V = U B with a small block-bidiagonal B; its singular values and right
vectors give the deviations and components. A column of U is as long as the table has rows. It is
never stored: it is X times a vector Z as long as there are dimensions, and each task makes its
part of it anew, so a lost executor costs no more than its tasks.

Blocks of eight columns read the table an eighth as often as single ones, and find equal
deviations, of which a single starting vector would see only one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cartwheel.llm.common import map_batches, settled
from cartwheel.llm.vectors import matrix, summed, whole_vectors

COMPONENTS = 4
BLOCK = 8
CONVERGED = 1e-15       # of the largest singular value
SMALLEST = 1e-10        # of the largest: a deviation below it cannot be told from none
SEED = 12
LONG = (1 << 63) - 1


@dataclass(frozen=True)
class Whitening:
    """Fitted to ``n`` different vectors with sums ``sums`` (null: beyond 38 digits). ``axes`` are
    the components as columns, in units of ``unit``, as ``deviations`` are."""
    n: int
    sums: list
    mean: np.ndarray
    unit: float
    axes: np.ndarray
    deviations: np.ndarray
    explained: np.ndarray


def _orthonormal(block: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """(Q, R) with block = Q R, without the directions below ``least``."""
    q, s, w = np.linalg.svd(block, full_matrices=False)
    keep = s > least
    return q[:, keep], s[keep, None] * w[keep]


def _split_gram(gram: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """(R, R^-1) for a tall W known by W'W only: W R^-1 is orthonormal. Directions of W below
    ``least`` are left out."""
    values, vectors = np.linalg.eigh((gram + gram.T) / 2)
    keep = values > least * least
    root = np.sqrt(values[keep])
    return root[:, None] * vectors[:, keep].T, vectors[:, keep] / root


def bidiagonalise(product: Callable, dims: int, wanted: int, width: int = BLOCK, seed: int = SEED):
    """(singular values, right singular vectors as columns), largest first, ``wanted`` of them or
    as many as there are. ``product(T, Z)`` gives (XT)'(XT), X'(XT) and (XZ)'(XT), the distributed
    products."""
    rng = np.random.default_rng(seed)
    v, _ = np.linalg.qr(rng.standard_normal((dims, min(width, dims))))
    big_v, z, g = np.zeros((dims, 0)), np.zeros((dims, 0)), np.zeros((dims, 0))
    b = np.zeros((0, 0))
    largest, fresh, restarted = 0.0, True, False
    while True:
        # X v, less what it has in common with the columns of U so far; U'(Xv) is g'v
        common = g.T @ v
        gram, back, _ = product(v - z @ common, z)
        largest = max(largest, float(np.sqrt(max(np.trace(gram), 0.0))))
        least = 1e-13 * largest
        r1, inverse = _split_gram(gram, least)
        new_z = (v - z @ common) @ inverse
        fresh_u = new_z.shape[1] > 0
        if fresh_u:
            # once more, on columns that are all but orthonormal now
            gram, back, again = product(new_z, z)
            r2, inverse = _split_gram(gram - again.T @ again, 1e-8)
            new_g = (back - g @ again) @ inverse
            new_z = (new_z - z @ again) @ inverse
            common, diagonal = common + again @ r1, r2 @ r1
        else:
            new_g, diagonal = np.zeros((dims, 0)), np.zeros((0, v.shape[1]))
        b = np.block([[b, common], [np.zeros((new_z.shape[1], b.shape[1])), diagonal]])
        big_v, z, g = np.hstack([big_v, v]), np.hstack([z, new_z]), np.hstack([g, new_g])
        # X'u, less what it has in common with the columns of V so far
        p = new_g
        for _ in range(2):
            p = p - big_v @ (big_v.T @ p)
        v, r = _orthonormal(p, least)
        left, values, right = np.linalg.svd(b, full_matrices=False)
        # what X'u lacks to being a multiple of v, for each of the wanted ones
        rest = r @ left[left.shape[0] - new_g.shape[1]:, :wanted]
        done = (len(values) >= wanted and v.shape[1] > 0 and not restarted
                and np.all(np.linalg.norm(rest, axis=0) <= CONVERGED * values[0]))
        if big_v.shape[1] >= dims or done or (not fresh_u and not fresh):
            return values[:wanted], (big_v @ right.T)[:, :wanted]
        fresh = v.shape[1] > 0
        if not fresh:   # nothing leads out of here: look elsewhere, and see it through
            restarted = True
            q = rng.standard_normal((dims, min(width, dims - big_v.shape[1])))
            for _ in range(2):
                q = q - big_v @ (big_v.T @ q)
                q, _ = np.linalg.qr(q)
            v = q


def _exact_sums(fit: DataFrame, dims: int) -> tuple[list, float]:
    """Sum of each dimension over all rows as whole numbers (None: beyond 38 digits), and the
    largest magnitude."""
    def add(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, most = [0] * dims, 0.0
        for batch in rows:
            if not batch.num_rows:
                continue
            x = matrix(batch.column("x"))
            top = float(np.abs(x).max())
            most = max(most, top)
            if top * len(x) < 2 ** 62:
                part = x.astype(np.int64).sum(0).tolist()
            else:
                part = [sum(map(int, x[:, j].tolist())) for j in range(dims)]
            total = [a + b for a, b in zip(total, part)]
        known = [Decimal(t) if abs(t) < 10 ** 37 else None for t in total]
        yield pa.RecordBatch.from_arrays([pa.array(range(dims), pa.int32()), pa.array(known, pa.decimal128(38, 0)),
                                          pa.array([most] * dims)], ["at", "part", "most"])

    parts = map_batches(fit.select("x"), add, "at int, part decimal(38,0), most double")
    whole = F.when(F.count_if(F.col("part").isNull()) == 0, F.try_sum("part"))
    found = parts.groupBy("at").agg(whole.alias("total"), F.max("most").alias("most")).collect()
    sums = {r["at"]: None if r["total"] is None else int(r["total"]) for r in found}
    return [sums[i] for i in range(dims)], max(r["most"] for r in found)


def fit_whitening(fit: DataFrame, dims: int, n: int, components: int = COMPONENTS, width: int = BLOCK) -> Whitening:
    """Components of the ``n`` rows of ``fit`` (``x``, all of ``dims`` components). Directions
    without spread are no components, so there may be fewer."""
    sums, most = _exact_sums(fit, dims)
    unit = 2.0 ** np.ceil(np.log2(most)) if most else 1.0
    if any(s is None for s in sums):
        mean = summed(fit, lambda x: (x / unit / n).sum(0), dims) * unit
    else:
        mean = np.array([s / n for s in sums])

    def centred(x: np.ndarray) -> np.ndarray:
        return x / unit - mean / unit

    def product(t: np.ndarray, z: np.ndarray):
        b, k = t.shape[1], z.shape[1]

        def block(x: np.ndarray) -> np.ndarray:
            x = centred(x)
            w = x @ t
            return np.concatenate([(w.T @ w).ravel(), (x.T @ w).ravel(), ((x @ z).T @ w).ravel()])

        out = summed(fit, block, b * (b + dims + k))
        return (out[:b * b].reshape(b, b), out[b * b:b * (b + dims)].reshape(dims, b),
                out[b * (b + dims):].reshape(k, b))

    spread = float(summed(fit, lambda x: np.array([(centred(x) ** 2).sum()]), 1)[0])
    if spread <= 0:
        return Whitening(n, sums, mean, unit, np.zeros((dims, 0)), np.zeros(0), np.zeros(0))
    values, axes = bidiagonalise(product, dims, min(components, dims), width)
    keep = values > SMALLEST * values[0]
    values, axes = values[keep], axes[:, keep]
    signs = np.sign(axes[np.abs(axes).argmax(0), np.arange(axes.shape[1])])
    return Whitening(n, sums, mean, unit, axes * signs, values / np.sqrt(n), values ** 2 / spread)


def _whitened(x: np.ndarray, w: Whitening) -> np.ndarray:
    if all(s is not None for s in w.sums) and np.abs(x).max(initial=0.0) * w.n < 2 ** 62:
        away = (x.astype(np.int64) * w.n - np.array(w.sums, dtype=np.int64)) / w.n
    else:
        away = x - w.mean
    return (away / w.unit) @ w.axes / w.deviations


def _far(x: np.ndarray, w: Whitening) -> list:
    """Sum of (n x - S)^2 of each row; None where it does not fit into a long."""
    if any(s is None for s in w.sums):
        return [None] * len(x)
    top = int(np.abs(x).max(initial=0.0)) * w.n + max(map(abs, w.sums))
    if top * top * x.shape[1] <= LONG:
        away = x.astype(np.int64) * w.n - np.array(w.sums, dtype=np.int64)
        return (away * away).sum(1).tolist()
    far = [sum((int(v) * w.n - s) ** 2 for v, s in zip(row, w.sums)) for row in x.tolist()]
    return [f if f <= LONG else None for f in far]


def identity_error(fit: DataFrame, w: Whitening) -> float:
    """Largest entry by which the covariance of the whitened rows of ``fit`` misses the identity."""
    k = len(w.deviations)
    mean = summed(fit, lambda x: _whitened(x, w).sum(0), k) / w.n

    def block(x: np.ndarray) -> np.ndarray:
        y = _whitened(x, w) - mean
        return (y.T @ y).ravel()

    return float(np.abs(summed(fit, block, k * k).reshape(k, k) / w.n - np.eye(k)).max())


_OUT = ("component int, n long, deviation long, whitened double, explained double, identity_error double")


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS,
           width: int = BLOCK) -> DataFrame:
    """For each row and component, numbered from 1 by falling deviation: ``key``, component, n,
    deviation (sum of (n x - S)^2), whitened, explained, identity_error.

    Each different vector counts once in the fit. Rows whose vector is null or empty, or holds a
    null or a component not finite (times 256), give nothing. Vectors of another length are a fit
    of their own. Directions without spread are no components, so a single vector gives no row, and so does
    an empty table. Repeated rows and keys, and null keys, each give their rows. A deviation that
    does not fit into a long is null. Of several equal deviations any basis may come out.
    """
    spark = vectors.sparkSession
    rows = settled(whole_vectors(vectors.select(F.col(key).alias("key"), F.col(vector).alias("vector")), "vector")
                   .withColumn("width", F.size("x")), "whole-vectors")
    distinct = settled(rows.select("width", "x").distinct(), "fit-vectors")
    schema = f"key {rows.schema['key'].dataType.simpleString()}, {_OUT}"
    result = spark.createDataFrame([], schema)
    # one number per length of vectors
    for found in distinct.groupBy("width").agg(F.count(F.lit(1)).alias("n")).orderBy("width").collect():
        fit = distinct.filter(F.col("width") == found["width"])
        w = fit_whitening(fit, found["width"], found["n"], components, width)
        if len(w.deviations):
            own = rows.filter(F.col("width") == found["width"]).select("key", "x")
            result = result.unionByName(_apply(own, w, identity_error(fit, w), schema))
    return result.withColumnRenamed("key", key)


def _apply(rows: DataFrame, w: Whitening, error: float, schema: str) -> DataFrame:
    k = len(w.deviations)
    names = ["key", *(c.split()[0] for c in _OUT.split(", "))]

    def apply(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given:
            if not batch.num_rows:
                continue
            x = matrix(batch.column("x"))
            m = len(x)
            far = _far(x, w)
            yield pa.RecordBatch.from_arrays([
                batch.column("key").take(pa.array(np.repeat(np.arange(m), k))),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, w.n)),
                pa.array([f for f in far for _ in range(k)], pa.int64()), pa.array(_whitened(x, w).ravel()),
                pa.array(np.tile(w.explained, m)), pa.array(np.full(m * k, error))], names)

    return map_batches(rows, apply, schema)
