"""Whitening of vectors: exact integer scatter, cyclic Jacobi, projection.

Components become whole numbers, so that counts, sums and scatter are exact however Spark adds
them up. The scatter is taken about the rounded mean (small numbers, no cancellation) and moved
to the mean itself by a product of parts below one half. The driver turns the covariance, whose
size is that of a vector squared, by symmetric Jacobi rotations, pair after pair, until every
off-diagonal entry vanishes beside its two diagonal ones; that keeps small eigenvalues accurate.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .vectors import finite, matrix, most_common_size

SCALE, SHIFT = 64, 1_000_000
#: Whole numbers beyond this are not exact as doubles.
EXACT = 2**53


def whole(x: np.ndarray, scale: int = SCALE, shift: int = SHIFT) -> np.ndarray:
    """floor(scale * x) + shift as 64-bit integers; an error where a double can't hold it exactly."""
    x = np.floor(x * scale) + shift
    if x.size and not np.abs(x).max() < EXACT:
        raise OverflowError("a component is too large for exact sums")
    return x.astype(np.int64)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b of integers, exactly: in doubles where no sum can pass 2^53, else in 64-bit integers."""
    most = lambda x: float(np.abs(x).max()) if x.size else 0.0
    bound = most(a) * most(b) * a.shape[1]
    if bound < EXACT:
        return (a.astype(float) @ b.astype(float)).astype(np.int64)
    if bound >= 2**63:
        raise OverflowError("components are too far apart for exact products")
    return a @ b


def jacobi(v: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as columns) of a symmetric matrix.

    A sweep turns every pair of axes once. It is done when in a whole sweep no off-diagonal entry
    stood out from rounding beside its diagonal ones.
    """
    a, d = np.array(v, float), len(v)
    axes, small = np.eye(d), np.finfo(float).eps
    for _ in range(sweeps):
        turned = False
        for p in range(d - 1):
            for q in range(p + 1, d):
                off = a[p, q]
                if abs(off) <= small * np.sqrt(abs(a[p, p] * a[q, q])) or abs(off) < np.finfo(float).tiny:
                    continue
                turned = True
                half = (a[q, q] - a[p, p]) / (2.0 * off)
                t = (1.0 if half >= 0 else -1.0) / (abs(half) + np.hypot(1.0, half))
                c = 1.0 / np.hypot(1.0, t)
                s = t * c
                turn = np.array([[c, s], [-s, c]])
                app, aqq = a[p, p] - t * off, a[q, q] + t * off
                a[:, [p, q]] = a[:, [p, q]] @ turn
                a[[p, q], :] = a[:, [p, q]].T
                a[p, p], a[q, q], a[p, q], a[q, p] = app, aqq, 0.0, 0.0
                axes[:, [p, q]] = axes[:, [p, q]] @ turn
        if not turned:
            break
    else:
        raise RuntimeError(f"rotations did not settle in {sweeps} sweeps")
    order = np.argsort(-np.diag(a), kind="stable")
    e, axes = np.diag(a)[order], axes[:, order]
    signs = np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(d)])
    return e, axes * signs


def summed(rows: DataFrame, of: Callable[[np.ndarray], np.ndarray], kind: str = "long") -> np.ndarray:
    """The sum over all rows of of(matrix of doubles), an array of one length; each task sends one row a number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = of(matrix(batch.column(0)))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["at", "part"])

    sums = rows.select("vec").mapInArrow(run, f"at long, part {kind}").groupBy("at").agg(F.sum("part").alias("part"))
    return sums.orderBy("at").toPandas()["part"].to_numpy()


class Whitening:
    """What a fit gives: count, sums, rounded mean, components as columns, eigenvalues, trace."""

    def __init__(self, n: int, sums: np.ndarray, middle: np.ndarray, axes: np.ndarray, values: np.ndarray, trace: float):
        self.n, self.sums, self.middle, self.axes, self.values, self.trace = n, sums, middle, axes, values, trace
        # n * middle - sums is at most n / 2: exact, and so is its quotient to double precision
        self.rest = (n * middle - sums) / n

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened rows of whole-number rows."""
        return ((x - self.middle) + self.rest) @ self.axes / np.sqrt(self.values)

    def deviation(self, x: np.ndarray) -> np.ndarray:
        """Sum over dimensions of (n x - sums)^2, exactly."""
        far = self.n * (x - self.middle) + (self.n * self.middle - self.sums)
        worst = float(np.abs(far.astype(float)).max(initial=0.0))
        if worst * worst * far.shape[1] >= 2**63 - 2**53:
            raise OverflowError("deviations pass 64 bits")
        return (far * far).sum(axis=1)


def fit(rows: DataFrame, n: int, size: int, components: int) -> Whitening:
    """Sums and scatter of all rows (vec of `size` doubles), and the leading components of their covariance."""
    sums = summed(rows, lambda x: whole(x).sum(axis=0))
    middle = (2 * sums + n) // (2 * n)

    def scatter(x: np.ndarray) -> np.ndarray:
        z = whole(x) - middle
        return product(z.T, z).reshape(-1)

    z = summed(rows, scatter).reshape(size, size)
    rest = (sums - n * middle) / n
    v = z / n - np.outer(rest, rest)
    values, axes = jacobi((v + v.T) / 2)
    trace = float(np.trace(v))
    # beyond rounding of the trace there is nothing to scale up
    keep = int((values[:components] > size * np.finfo(float).eps * trace).sum())
    return Whitening(n, sums, middle, axes[:, :keep], values[:keep], trace)


def whiten(vectors: DataFrame, components: int = 32, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id_col, component from 1, n, deviation, whitened, explained, identity_error) of every usable row and component.

    Components of vectors become floor(64 c) + 1000000. Rows whose vector is null or holds null or
    non-finite entries are left out. All vectors must have one length: those of another length than
    most rows have (the longer on ties) are left out, so are empty ones. Zero vectors take part; rows that repeat an id
    count and come back as often; ids may be null. Of directions without spread there is no component, so that
    equal rows give none; an empty table gives no rows. Other columns are dropped.
    An entry of 2^47 or more, or deviations beyond 64 bits, raise an error: exact sums would not hold them.

    The table is read five times and never shuffled; sums and scatter reach the driver as one number a pair of dimensions.
    """
    spark = vectors.sparkSession
    rows = finite(vectors, id_col, vec_col)
    size, n = most_common_size(rows)
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, component int, n long, deviation long, whitened double, explained double"
    if n == 0:
        return spark.createDataFrame([], f"`{id_col}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    rows = rows.where(F.size("vec") == size)
    model = fit(rows, n, size, components)
    sent = spark.sparkContext.broadcast(model)
    k = len(model.values)

    def second(x: np.ndarray) -> np.ndarray:
        w = sent.value.project(whole(x))
        return np.concatenate([w.sum(axis=0), (w.T @ w).reshape(-1)])

    error = 0.0
    if k:
        moments = summed(rows, second, "double")
        mean = moments[:k] / n
        error = float(np.abs(moments[k:].reshape(k, k) / n - np.outer(mean, mean) - np.eye(k)).max())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        k = len(m.values)
        for batch in batches:
            if batch.num_rows and k:
                x = whole(matrix(batch.column(1)))
                each = np.repeat(np.arange(len(x)), k)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                        pa.array(np.full(len(x) * k, m.n)), pa.array(m.deviation(x)[each]), pa.array(m.project(x).reshape(-1)),
                        pa.array(np.tile(m.values / m.trace, len(x))),
                    ],
                    ["id", "component", "n", "deviation", "whitened", "explained"],
                )

    return rows.mapInArrow(project, schema).withColumnRenamed("id", id_col).withColumn("identity_error", F.lit(error))
