"""Whitening of embeddings on their principal components, by Chebyshev-filtered subspace iteration.

Vectors become whole numbers, so that means and deviations are exact. The covariance matrix V is
never built: a pass over the vectors gives V Q for a block of columns Q, each task summing its own
centred X'(X Q). A polynomial of V, by the Chebyshev recurrence, damps the part of the spectrum below the
block; QR and Rayleigh-Ritz then give the block's best vectors, until the residual of each wanted
one is certified. The driver holds a few matrices of dimension x block, whatever the number of vectors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stoplines.llm.common import arrow_map
from stoplines.storage import materialize

SCALE = 1024
OFFSET = 100_000
COMPONENTS = 8
BLOCK = 3  # columns of the block per wanted component
DEGREE = 10
MOST_ROUNDS = 60
RESIDUAL = 1e-13  # of an eigenvector, relative to the greatest eigenvalue
ROUNDING = 1e-12  # eigenvalues below this share of the greatest are taken for rounding
TOP = 1 << 52  # whole numbers up to here are exact in double precision
REDUCERS = 8


@dataclass
class Whitening:
    """Exact sums of the fitted vectors, and their greatest eigenpairs; vectors are columns of unit length."""

    n: int
    sums: np.ndarray  # int64, per dimension
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    residual: float  # greatest |V q - e q| of the pairs, as a share of the greatest eigenvalue
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n, rounded once."""
        return (self.n * x - self.sums) / self.n

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors / np.sqrt(self.values)

    def deviation(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n x - S)^2, exact."""
        apart = self.n * x - self.sums
        if apart.size and int(np.abs(apart).max()) ** 2 * apart.shape[1] < 1 << 63:
            return (apart * apart).sum(1).tolist()
        return [sum(value * value for value in row) for row in apart.tolist()]


def matrix(column: pa.ListArray) -> np.ndarray:
    """Lists of one length as the rows of a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def whole(batch: pa.RecordBatch) -> pa.RecordBatch:
    """vec_id, x: the usable vectors as whole numbers."""
    vectors = batch.column("embedding")
    size = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False)
    flat = vectors.flatten()
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)  # null becomes NaN
    row = np.repeat(np.arange(len(size)), size)
    good = (size > 0) & (np.bincount(row[~np.isfinite(values)], minlength=len(size)) == 0)
    x = np.floor(values[good[row]] * SCALE) + OFFSET
    if x.size and np.abs(x).max() >= TOP:
        raise ValueError(f"an entry's whole number is beyond {TOP}")
    kept = pa.array(np.flatnonzero(good))
    offsets = np.concatenate([[0], np.cumsum(size[good])])
    return pa.RecordBatch.from_arrays(
        [batch.column("vec_id").take(kept), pa.array(size[good].astype(np.int32)),
         pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(x.astype(np.int64)))],
        names=["vec_id", "size", "x"],
    )


def _summed(rows: DataFrame, one: Callable[[np.ndarray], np.ndarray], shape: tuple[int, ...]) -> np.ndarray:
    """The sum over all vectors of a matrix of `shape`: per task, then over a few tasks, then on the driver."""

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = one(matrix(batch.column("x")))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["part"])

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for part in batch.column("part").to_pylist():
                part = np.frombuffer(part).reshape(shape)
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["part"])

    parts = rows.select("x").mapInArrow(per_task, "part binary").repartition(REDUCERS).mapInArrow(together, "part binary")
    found = [np.frombuffer(row["part"]).reshape(shape) for row in parts.collect()]
    return np.sum(found, axis=0) if found else np.zeros(shape)


def exact_sums(rows: DataFrame, size: int) -> tuple[int, np.ndarray]:
    """Number of vectors, and the sum of each dimension, in whole numbers."""

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                # At most 2^52 each, and fewer than 2^11 of them between two steps.
                x = matrix(batch.column("x"))
                for at in range(0, len(x), 1024):
                    sums = x[at : at + 1024].sum(0)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.arange(size)), pa.array(sums), pa.array(np.full(size, len(x[at : at + 1024])))],
                        names=["dimension", "s", "n"],
                    )

    parts = rows.select("x").mapInArrow(per_task, "dimension long, s long, n long")
    total = parts.groupBy("dimension").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n")).orderBy("dimension").collect()
    sums = [int(row["s"]) for row in total]
    if any(abs(s) >= 1 << 62 for s in sums):
        raise ValueError("a dimension's sum is beyond a long")
    return total[0]["n"], np.array(sums, np.int64)


def eigenpairs(
    product: Callable[[np.ndarray], np.ndarray], size: int, count: int, block: int = BLOCK, degree: int = DEGREE,
    most_rounds: int = MOST_ROUNDS, residual: float = RESIDUAL, seed: int = 1,
) -> tuple[np.ndarray, np.ndarray, float]:
    """The greatest eigenvalues of a matrix without negative ones, given its product with a block of columns.

    Returns values in falling order, unit vectors, and the greatest residual reached, relative to the greatest value.
    """
    count = min(count, size)
    width = min(size, max(block * count, count + 4))
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, width)))
    best = np.inf
    for _ in range(most_rounds):
        vq = product(q)
        # Rayleigh-Ritz: the best eigenvectors within the block.
        inner = q.T @ vq
        values, turn = np.linalg.eigh((inner + inner.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, vq = q @ turn, vq @ turn
        top = max(values[0], 0.0)
        if top == 0.0:
            return values[:count] * 0, q[:, :count], 0.0
        error = float((np.linalg.norm(vq - q * values, axis=0)[:count] / top).max())
        # Certified, or no longer better: rounding allows no more.
        if error <= residual or (error < 1e-10 and error > best / 2):
            return values[:count], q[:, :count], error
        best = min(best, error)
        # The scaled recurrence: at most 1 on [0, bound], fast growing above, never beyond 1 at the greatest value.
        bound = max(values[-1], top * 1e-9)
        half = bound / 2
        sigma = first = half / (top - half) if top > half else 1.0
        before, now = q, (vq - half * q) * (sigma / half)
        for _ in range(degree - 1):
            turned = 1 / (2 / first - sigma)
            after = (product(now) - half * now) * (2 * turned / half) - sigma * turned * before
            before, now, sigma = now, after, turned
        # Twice, since the columns are far from perpendicular after a high power.
        q, _ = np.linalg.qr(np.linalg.qr(now)[0])
    raise ArithmeticError(f"residual {best} after {most_rounds} rounds")


def prepare(vectors: DataFrame) -> DataFrame:
    """vec_id, x: vectors that are not null, not empty and without null or non-finite entries, as whole numbers, stored.

    Of vectors of several lengths only those of the most common one stay, of equally common ones of the longer.
    """
    rows = vectors.select(F.col("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    id_type = rows.schema["vec_id"].dataType.simpleString()
    rows = materialize(arrow_map(rows, whole, f"vec_id {id_type}, size int, x array<long>", None), "whole-vectors")
    sizes = rows.groupBy("size").count().orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    return rows.where(F.col("size") == (sizes[0]["size"] if sizes else 0)).select("vec_id", "x")


def fit(rows: DataFrame, count: int = COMPONENTS, **iteration) -> Whitening | None:
    """Sums and eigenpairs of the vectors of `prepare`; None if there are none.

    Directions in which the vectors don't differ have no component.
    """
    first = rows.select("x").first()
    if first is None:
        return None
    size = len(first["x"])
    n, sums = exact_sums(rows, size)
    empty = Whitening(n, sums, 0.0, np.zeros(0), np.zeros((size, 0)), 0.0)
    trace = float(_summed(rows, lambda x: (empty.centred(x) ** 2).sum(keepdims=True), (1, 1))[0, 0]) / n
    if trace == 0.0:
        return empty

    def product(q: np.ndarray) -> np.ndarray:
        def one(x: np.ndarray) -> np.ndarray:
            centred = empty.centred(x)
            return centred.T @ (centred @ q)

        return _summed(rows, one, q.shape) / n

    values, vectors, residual = eigenpairs(product, size, count, **iteration)
    kept = values > ROUNDING * values[0]
    values, vectors = values[kept], vectors[:, kept]
    # Either sign is right; the greatest entry is made positive.
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(0), np.arange(len(values))])
    model = Whitening(n, sums, trace, values, vectors, residual)
    k = len(values)

    def moments(x: np.ndarray) -> np.ndarray:
        y = np.column_stack([model.project(x), np.ones(len(x))])
        return y.T @ y

    sums_of = _summed(rows, moments, (k + 1, k + 1)) / n
    mean = sums_of[:k, k]
    model.identity_error = float(np.abs(sums_of[:k, :k] - np.outer(mean, mean) - np.eye(k)).max())
    return model


def transform(rows: DataFrame, model: Whitening) -> DataFrame:
    """vec_id, deviation, whitened: one row per vector; whitened is an array with one entry per component."""
    fitted = rows.sparkSession.sparkContext.broadcast(model)  # dimension x components

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        model, x = fitted.value, matrix(batch.column("x"))
        y = model.project(x)
        offsets = np.arange(len(x) + 1) * y.shape[1]
        return pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), pa.array([str(d) for d in model.deviation(x)]),
             pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(y.ravel()))],
            names=["vec_id", "deviation", "whitened"],
        )

    id_type = rows.schema["vec_id"].dataType.simpleString()
    found = arrow_map(rows, run, f"vec_id {id_type}, deviation string, whitened array<double>", None)
    return found.withColumn("deviation", F.col("deviation").cast("decimal(38,0)"))


def whiten(vectors: DataFrame, count: int = COMPONENTS, **iteration) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row per usable vector and component.

    Vectors that are null, empty, or hold null or non-finite entries are left out, as are those of another length than the
    most common. Rows may repeat: each is a vector. Without vectors, or if all are equal, there are no rows.
    deviation is a decimal.
    """
    rows = prepare(vectors)
    model = fit(rows, count, **iteration)
    schema = rows.schema["vec_id"].dataType.simpleString()
    if model is None or not len(model.values):
        return rows.sparkSession.createDataFrame([], (
            f"vec_id {schema}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
        ))
    share = F.element_at(F.array(*[F.lit(float(value / model.trace)) for value in model.values]), F.col("component"))
    return transform(rows, model).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
    ).withColumns({"explained": share, "identity_error": F.lit(model.identity_error)})
