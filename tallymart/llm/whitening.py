"""Embedding whitening: covariance over distinct vectors, its leading eigenvectors, and the projection of every row.

Sums and centred products are added up in Spark; one symmetric matrix, as wide as a vector, reaches the driver. There it
is reduced to tridiagonal form by Householder reflections, its leading eigenvalues are found by bisection on the Sturm
count of smaller ones, and their vectors by inverse iteration, those of near eigenvalues kept at right angles. Mean,
components and eigenvalues go back to the tasks, which project the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm.shared import leave_encoder, ship_package, stored

SCALE = 256
COMPONENTS = 4
#: Eigenvalues below this share of the largest count as zero: nothing varies along their vectors.
LEAST_SHARE = 1e-11
#: Eigenvalues nearer than this share of the matrix's norm form a cluster.
CLUSTER_SHARE = 1e-3
MOST = 2.0**62


# ---------------------------------------------------------------- the symmetric eigenproblem


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and the unit vectors of the Householder reflections that give them."""
    a = np.array(matrix, dtype=np.float64)
    n, vectors = len(a), []
    for k in range(n - 2):
        x = a[k + 1 :, k].copy()
        norm = np.linalg.norm(x)
        if norm > 0:
            x[0] += norm if x[0] >= 0 else -norm
            x /= np.linalg.norm(x)
            rest = a[k + 1 :, k + 1 :]
            p = rest @ x
            q = p - (x @ p) * x
            rest -= 2 * (np.outer(x, q) + np.outer(q, x))
            a[k + 1, k] = norm if a[k + 1, k] < 0 else -norm
        vectors.append(x)
    return np.diag(a).copy(), np.diag(a, -1).copy(), vectors


def reflected(vectors: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """An eigenvector of the tridiagonal form as one of the matrix."""
    y = y.copy()
    for k in range(len(vectors) - 1, -1, -1):
        y[k + 1 :] -= 2 * vectors[k] * (vectors[k] @ y[k + 1 :])
    return y


def sturm_count(diagonal: np.ndarray, off: np.ndarray, x: np.ndarray) -> np.ndarray:
    """For each number, how many eigenvalues of the tridiagonal matrix lie below it."""
    tiny = np.finfo(float).tiny * max(1.0, float(np.max(np.square(off), initial=0.0))) + 1e-300
    pivot = diagonal[0] - x
    count = (pivot < 0).astype(np.int64)
    for k in range(1, len(diagonal)):
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        pivot = diagonal[k] - x - off[k - 1] ** 2 / pivot
        count += pivot < 0
    return count


def leading_eigenvalues(diagonal: np.ndarray, off: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` largest eigenvalues, falling, each by bisection down to neighbouring numbers."""
    n = len(diagonal)
    reach = np.concatenate([[0.0], np.abs(off)]) + np.concatenate([np.abs(off), [0.0]])
    slack = 1e-12 * max(1e-300, float(np.max(np.abs(diagonal) + reach)))
    low = np.full(count, float(np.min(diagonal - reach)) - slack)
    high = np.full(count, float(np.max(diagonal + reach)) + slack)
    below = n - np.arange(count)  # the k-th largest has n - k - 1 smaller ones, so at it the count reaches n - k
    for _ in range(200):
        middle = low + (high - low) / 2
        if not np.any((middle > low) & (middle < high)):
            break
        above = sturm_count(diagonal, off, middle) >= below
        high, low = np.where(above, middle, high), np.where(above, low, middle)
    return low + (high - low) / 2


def solve_tridiagonal(diagonal: np.ndarray, off: np.ndarray, shift: float, right: np.ndarray) -> np.ndarray:
    """(T - shift) y = right by elimination with row exchanges; vanishing pivots are replaced by tiny ones."""
    n = len(diagonal)
    size = max(float(np.max(np.abs(diagonal))), float(np.max(np.abs(off), initial=0.0)), 1e-300)
    tiny = np.finfo(float).eps * size
    main, upper, second = diagonal - shift, np.append(off, 0.0), np.zeros(n)
    y = right.copy()
    for k in range(n - 1):
        below = off[k]
        if abs(below) > abs(main[k]):
            factor = main[k] / below
            main[k], upper[k], main[k + 1], second[k], upper[k + 1] = (
                below, main[k + 1], upper[k] - factor * main[k + 1], upper[k + 1], -factor * upper[k + 1]
            )
            y[k], y[k + 1] = y[k + 1], y[k] - factor * y[k + 1]
        else:
            main[k] = main[k] if main[k] else tiny
            factor = below / main[k]
            main[k + 1] -= factor * upper[k]
            y[k + 1] -= factor * y[k]
    for k in range(n - 1, -1, -1):
        known = (upper[k] * y[k + 1] if k + 1 < n else 0.0) + (second[k] * y[k + 2] if k + 2 < n else 0.0)
        pivot = main[k] if abs(main[k]) > tiny else (tiny if main[k] >= 0 else -tiny)
        y[k] = (y[k] - known) / pivot
    return y


def leading_vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (rows) of the tridiagonal matrix, by inverse iteration.

    After every step a vector is made orthogonal to the earlier ones of its cluster; values that agree to the last digits
    are set a little apart, so that each has a system of its own.
    """
    n, out, cluster = len(diagonal), [], []
    size = max(float(np.max(np.abs(diagonal))), float(np.max(np.abs(off), initial=0.0)), 1e-300)
    start = np.random.default_rng(12)
    shift = np.inf
    for k, value in enumerate(values):
        if k and values[k - 1] - value > CLUSTER_SHARE * size:
            cluster = []
        shift = min(float(value), shift - 4 * np.finfo(float).eps * size)
        y = start.standard_normal(n)
        for _ in range(6):
            for _ in range(2):
                for other in cluster:
                    y -= (other @ y) * other
            y /= np.linalg.norm(y)
            y = solve_tridiagonal(diagonal, off, shift, y)
            y /= np.max(np.abs(y))
        for _ in range(2):
            for other in cluster:
                y -= (other @ y) * other
            y /= np.linalg.norm(y)
        cluster.append(y)
        out.append(y)
    return np.array(out).reshape(len(values), n)


def leading_components(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues that are not zero, at most ``count``, and their unit vectors as rows."""
    count = min(count, len(matrix))
    scale = float(np.max(np.abs(matrix), initial=0.0))
    if not count or scale == 0:
        return np.zeros(0), np.zeros((0, len(matrix)))
    diagonal, off, reflections = tridiagonal(matrix / scale)
    values = leading_eigenvalues(diagonal, off, count)
    values = values[values > LEAST_SHARE * max(values[0], 0.0)]
    vectors = leading_vectors(diagonal, off, values)
    return values * scale, np.array([reflected(reflections, y) for y in vectors]).reshape(len(values), len(matrix))


# ---------------------------------------------------------------- vectors as whole numbers


def packed(x: np.ndarray) -> bytes:
    """A vector of 64-bit numbers in the narrowest of 16, 32 and 64 bits that holds it; equal bytes are equal vectors."""
    most = max(int(x.max(initial=0)), ~int(x.min(initial=0)))
    return b"%d" % len(x) + (b":2" if most < 1 << 15 else b":4" if most < 1 << 31 else b":8") + x.astype(
        "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8"
    ).tobytes()


def unpacked(blobs: list[bytes], width: int) -> np.ndarray:
    """Vectors of one width, as rows."""
    out = np.empty((len(blobs), width), dtype=np.int64)
    head = len(b"%d" % width) + 2
    for k, blob in enumerate(blobs):
        out[k] = np.frombuffer(blob, dtype=f"<i{chr(blob[head - 1])}", offset=head)
    return out


def whole_vectors(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, width and x: each entry c as floor(scale * c), packed.

    Rows whose vector is null or empty, or holds null or non-finite entries or one that leaves 64 bits, are left out.
    """
    ship_package(embeddings.sparkSession)

    def scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leave_encoder()
        for batch in batches:
            lists = batch.column("embedding")
            ids, widths, blobs = [], [], []
            for own, entries in zip(batch.column("vec_id").to_pylist(), lists, strict=True):
                if not entries.is_valid or not len(entries.values) or entries.values.null_count:
                    continue
                with np.errstate(over="ignore", invalid="ignore"):
                    x = np.floor(scale * entries.values.to_numpy(zero_copy_only=False).astype(np.float64))
                if np.isfinite(x).all() and np.abs(x).max() < MOST:
                    ids.append(own)
                    widths.append(len(x))
                    blobs.append(packed(x.astype(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(widths, pa.int32()), pa.array(blobs, pa.binary())],
                names=["vec_id", "width", "x"],
            )

    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>"))
    return rows.mapInArrow(scaled, "vec_id long, width int, x binary")


def _added(vectors: DataFrame, width: int, part) -> np.ndarray:
    """The sum over all vectors of an array that ``part`` gives for a batch of them; one array a task is shuffled.

    The entries of a task's array are added up by place in Spark, so the driver gets one array.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                blobs = batch.column("x").slice(at, 4096).to_pylist()
                found = part(unpacked(blobs, width)).reshape(-1)
                total = found if total is None else total + found
        if total is not None:
            kind = pa.int64() if total.dtype == np.int64 else pa.float64()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total, kind)], names=["at", "v"])

    probe = part(np.zeros((0, width), dtype=np.int64)).reshape(-1)
    schema = "at long, v long" if probe.dtype == np.int64 else "at long, v double"
    rows = vectors.mapInArrow(add, schema).groupBy("at").agg(F.sum("v").alias("v")).toArrow()
    total = np.zeros(len(probe), dtype=probe.dtype)
    total[rows.column("at").to_numpy()] = rows.column("v").to_numpy()
    return total


@dataclass(frozen=True)
class Whitening:
    """What whitens: n distinct vectors of a width, their exact sums, components (rows), eigenvalues, and the trace."""

    n: int
    width: int
    sums: tuple[int, ...]
    components: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float = 0.0

    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def project(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean()) @ self.components.T) / np.sqrt(self.values)


def fit_whitening(vectors: DataFrame, count: int = COMPONENTS) -> Whitening | None:
    """Fit on each distinct vector once; None where there is none.

    ``vectors`` are ``whole_vectors`` of one width. Copies are combined within tasks before they are shuffled. Sums are
    exact. Directions in which nothing varies are no components.
    """
    fit = stored(vectors.groupBy("width", "x").agg(F.count("*").alias("copies")), "distinct-vectors")
    first = fit.agg(F.count("*").alias("n"), F.min("width").alias("least"), F.max("width").alias("most")).first()
    if not first.n:
        return None
    if first.least != first.most:
        raise ValueError(f"vectors of {first.least} to {first.most} entries have no common covariance")
    n, width = first.n, first.most

    # Halves of 32 bits, so that no sum leaves 64 bits.
    halves = _added(fit, width, lambda x: np.concatenate([(x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)]))
    sums = tuple((int(high) << 32) + int(low) for high, low in halves.reshape(2, width).T)
    mean = np.array([s / n for s in sums])
    upper = np.triu_indices(width)

    def products(x: np.ndarray) -> np.ndarray:
        centred = x - mean
        return (centred.T @ centred)[upper]

    covariance = np.zeros((width, width))
    covariance[upper] = _added(fit, width, products) / n
    covariance = covariance + np.triu(covariance, 1).T
    values, components = leading_components(covariance, count)
    model = Whitening(n, width, sums, components, values, float(np.trace(covariance)))
    if not len(values):
        return model
    centre = _added(fit, width, lambda x: model.project(x).sum(axis=0)) / n

    def whitened_products(x: np.ndarray) -> np.ndarray:
        centred = model.project(x) - centre
        return centred.T @ centred

    own = _added(fit, width, whitened_products).reshape(len(values), len(values)) / n
    error = float(np.max(np.abs(own - np.eye(len(values)))))
    return Whitening(n, width, sums, components, values, model.trace, error)


def deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int | None]:
    """For each row the sum over dimensions of (n*x - S)^2, exact; null where it leaves 64 bits."""
    about = n * x.astype(np.float64) - np.array([float(s) for s in sums])
    if np.square(about).sum(axis=1).max(initial=0.0) < MOST and np.abs(x).max(initial=0) * float(n) < MOST:
        return np.square(n * x - np.array(sums, dtype=np.int64)).sum(axis=1).tolist()
    out: list[int | None] = []
    for row in x.tolist():
        total = sum((n * v - s) ** 2 for v, s in zip(row, sums, strict=True))
        out.append(total if total < 1 << 63 else None)
    return out


def whiten(vectors: DataFrame, model: Whitening) -> DataFrame:
    """vec_id, deviation and whitened (one number a component) of every ``whole_vectors`` row."""

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = unpacked(batch.column("x").to_pylist(), model.width)
            found = model.project(x)
            ends = np.arange(len(x) + 1, dtype=np.int32) * found.shape[1]
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(found.reshape(-1)))
            far = pa.array(deviations(x, model.n, model.sums), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), far, lists], names=["vec_id", "deviation", "whitened"]
            )

    return vectors.mapInArrow(project, "vec_id long, deviation long, whitened array<double>")


def one_width(vectors: DataFrame) -> DataFrame:
    """The vectors of the width that most rows have, the greater one among equals: others have no common space."""
    counts = vectors.groupBy("width").agg(F.count("*").alias("n"))
    best = counts.agg(F.max(F.struct("n", "width")).alias("best")).first().best  # one row a width is compared
    return vectors if best is None else vectors.where(F.col("width") == best.width)


def whitened_rows(embeddings: DataFrame, count: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """One row a vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Rows without a usable vector are dropped (``whole_vectors``), and those of another width than most. Repeated rows
    are whitened alike and count once in the fit; null ids stay; other columns are left behind. Where all vectors are
    equal, or there is none, nothing varies and no row comes back.
    """
    vectors = one_width(stored(whole_vectors(embeddings, scale), "whole-vectors"))
    model = fit_whitening(vectors, count)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None or not len(model.values):
        return embeddings.sparkSession.createDataFrame([], schema)
    rows = whiten(vectors, model).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    shares = F.array(*(F.lit(float(v / model.trace)) for v in model.values))
    return rows.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )
