"""Whitening of vectors on the principal components of their covariance.

Statistics are exact: components become whole numbers, sums of these and of
their products around the rounded mean are added up as whole numbers, so that
neither the order of rows nor the number of tasks changes a digit. The
covariance, whose size depends on the length of a vector alone, is then split
by spectral divide and conquer: the polar factor of the covariance less a
shift, found by dynamically weighted Halley iterations on QR factors, gives the
projector on the eigenvectors above the shift; an orthonormal basis of its
range and one of the complement split the matrix in two, and each half is
split again until single vectors are left. Mean and components are broadcast,
and each row is centred and projected where it lies.

Edge cases: rows whose vector is null or empty, or holds null, NaN, infinite
or such large entries that they are no longs, take no part. Of vectors of different
lengths those of the most frequent length take part (of two, the longer). A row with a null
or repeated id is a row like any other. A component without variance cannot be
scaled: its ``whitened`` is null and it has no share in ``identity_error``.
``deviation`` is null where it is beyond a long. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import written

COMPONENTS = 8
#: Whole numbers up to here are exact in a double.
_EXACT = 1 << 53
_ROWS = 4096
_EPS = np.finfo(np.float64).eps


# Polar decomposition and spectral splitting of a small symmetric matrix


def polar(a: np.ndarray) -> np.ndarray:
    """The unitary polar factor of a symmetric matrix: Halley iterations weighted by a bound of the least singular value."""
    x, low, eye = a / np.linalg.norm(a), _EPS, np.eye(len(a))
    for _ in range(12):
        d = np.cbrt(4 * (1 - low * low) / low**4)
        wa = np.sqrt(1 + d) + 0.5 * np.sqrt(max(8 - 4 * d + 8 * (2 - low * low) / (low * low * np.sqrt(1 + d)), 0.0))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, eye]))
        following = (wb / wc) * x + (wa - wb / wc) / np.sqrt(wc) * (q[: len(a)] @ q[len(a) :].T)
        following = (following + following.T) / 2
        moved = np.linalg.norm(following - x)
        x, low = following, min(low * (wa + wb * low * low) / (1 + wc * low * low), 1.0)
        if abs(low - 1) < 10 * _EPS and moved < np.cbrt(_EPS):
            break
    return x


def _shifts(a: np.ndarray) -> Iterator[float]:
    """Shifts to split at: the middle of the diagonal, then the mean of the eigenvalues and values close to it."""
    yield float(np.median(np.diag(a)))
    mean = float(np.trace(a)) / len(a)
    spread = np.sqrt(max(np.sum((a - mean * np.eye(len(a))) ** 2) / len(a), 0.0)) / np.sqrt(len(a))
    yield mean
    for part in (0.3, -0.3, 0.17, -0.17, 0.41, -0.41, 0.07, -0.07):
        yield mean + part * spread


def _split(a: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the eigenspaces above and below a shift; None if no shift tells eigenvalues apart."""
    size = len(a)
    draws = np.random.default_rng(size).standard_normal((size, size))
    best = None
    for shift in _shifts(a):
        moved = a - shift * np.eye(size)
        if not np.any(moved):
            continue
        projector = (polar(moved) + np.eye(size)) / 2
        above = int(round(float(np.trace(projector))))
        if not 0 < above < size:
            continue
        basis = projector @ draws[:, :above]
        for _ in range(2):
            basis = projector @ np.linalg.qr(basis)[0]
        whole = np.linalg.qr(basis, mode="complete")[0]
        over, under = whole[:, :above], whole[:, above:]
        left = np.linalg.norm(under.T @ a @ over)
        if best is None or left < best[0]:
            best = left, over, under
        if left <= 10 * size * _EPS * np.linalg.norm(a):
            break
    return None if best is None else best[1:]


def components(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and the unit eigenvectors of a symmetric matrix as columns."""
    found: list[np.ndarray] = []
    open_: list[tuple[np.ndarray, np.ndarray]] = [(a, np.eye(len(a)))]
    least = len(a) * _EPS * np.linalg.norm(a)
    while open_:
        block, basis = open_.pop()
        alike = np.linalg.norm(block - np.trace(block) / len(block) * np.eye(len(block))) <= least / 4
        halves = None if len(block) == 1 or alike else _split(block)
        if halves is None:
            found.append(basis)
            continue
        for half in halves:
            inner = half.T @ block @ half
            open_.append(((inner + inner.T) / 2, basis @ half))
    vectors = np.linalg.qr(np.hstack(found))[0]
    values = np.einsum("ij,ij->j", vectors, a @ vectors)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


# Exact statistics


def whole(vector: Column, factor: int = 1024, shift: int = 100_000) -> Column:
    """floor(factor * x) + shift of each component as long; null for vectors that take no part."""
    limit = float(1 << 62)
    fits = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * factor) < limit))
    return F.when((F.size(vector) > 0) & fits, F.transform(vector, lambda x: F.floor(x.cast("double") * factor) + shift))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column("x")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        for low in range(0, batch.num_rows, _ROWS):
            yield _matrix(batch.slice(low, _ROWS))


def _added(total, x: np.ndarray):
    """Sums over rows as Python's whole numbers."""
    most = int(np.abs(x).max(initial=0))
    sums = x.sum(axis=0) if most * len(x) < 1 << 62 else x.astype(object).sum(axis=0)
    return total + sums.astype(object)


def _products(y: np.ndarray) -> np.ndarray:
    """y'y as whole numbers: a matrix product of doubles where all its sums are exact, else one of Python's numbers."""
    most = int(np.abs(y).max(initial=0))
    if most * most * len(y) < _EXACT:
        y = y.astype(np.float64)
        return (y.T @ y).astype(np.int64).astype(object)
    return y.astype(object).T @ y.astype(object)


def _sums(rows: DataFrame, dim: int) -> list[int]:
    """The sum of each component over all rows."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(dim, dtype=object)
        for x in _parts(batches):
            total = _added(total, x)
        yield pa.record_batch([pa.array(range(dim), pa.int32()), pa.array([str(v) for v in total])], names=["i", "v"])

    parts = rows.mapInArrow(task, "i int, v string").groupBy("i").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))
    found = {r["i"]: int(r["v"]) for r in parts.collect()}  # one number a component
    return [found[i] for i in range(dim)]


def _covariance(rows: DataFrame, n: int, sums: list[int], middle: np.ndarray) -> np.ndarray:
    """The covariance with divisor ``n``; products are of differences from ``middle``, the rounded mean, and the rest of the mean is taken off exactly."""
    dim = len(sums)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim), dtype=object)
        for x in _parts(batches):
            total = total + _products(x - middle)
        for i in range(dim):
            yield pa.record_batch([pa.array([i] * dim, pa.int32()), pa.array(range(dim), pa.int32()), pa.array([str(v) for v in total[i]])], names=["i", "j", "v"])

    parts = rows.mapInArrow(task, "i int, j int, v string").groupBy("i", "j").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))
    rest = [s - n * int(m) for s, m in zip(sums, middle, strict=True)]
    out = np.empty((dim, dim))
    for r in parts.collect():  # the square of a vector's length
        out[r["i"], r["j"]] = float(Fraction(n * int(r["v"]) - rest[r["i"]] * rest[r["j"]], n * n))
    return out


class Whitening:
    """Mean and components of a table of vectors: ``n``, ``sums``, ``values`` (falling), ``vectors`` (columns), ``trace``."""

    def __init__(self, n: int, sums: list[int], covariance: np.ndarray, most: int):
        self.n, self.sums = n, sums
        self.middle = np.array([(2 * s + n) // (2 * n) for s in sums], dtype=np.int64)
        self.rest = np.array([float(Fraction(s - n * int(m), n)) for s, m in zip(sums, self.middle, strict=True)])
        self.trace = float(np.trace(covariance))
        values, vectors = components(covariance)
        self.values, self.vectors = values[:most], vectors[:, :most]
        self.known = self.values > len(sums) * _EPS * max(float(values[0]), 0.0)
        self.scale = np.where(self.known, 1 / np.sqrt(np.where(self.known, self.values, 1.0)), np.nan)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """Centred, projected and scaled rows; NaN on a component without variance."""
        return ((x - self.middle) - self.rest) @ self.vectors * self.scale

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over the components of (n * x - S) ** 2, exact; None beyond a long."""
        rest = np.array([s - self.n * int(m) for s, m in zip(self.sums, self.middle, strict=True)], dtype=object)
        y = x - self.middle
        most = self.n * (int(np.abs(y).max(initial=0)) + 1)
        d = y * self.n - rest.astype(np.int64) if most * most * len(self.sums) < 1 << 62 else y.astype(object) * self.n - rest
        return [int(v) if int(v) < 1 << 63 else None for v in (d * d).sum(axis=1)]


def fit(rows: DataFrame, most: int = COMPONENTS) -> tuple[DataFrame, Whitening | None]:
    """The rows (id, x) that take part, and what they are whitened by; None without rows. ``rows`` has id and x, of :func:`whole`."""
    rows = rows.where("x is not null")
    lengths = rows.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    if lengths is None:
        return rows, None
    rows = rows.where(F.size("x") == lengths["dim"])
    n, sums = lengths["count"], _sums(rows, lengths["dim"])
    middle = np.array([(2 * s + n) // (2 * n) for s in sums], dtype=np.int64)
    return rows, Whitening(n, sums, _covariance(rows, n, sums, middle), most)


def identity_error(rows: DataFrame, by: Whitening) -> float:
    """The largest absolute entry of the whitened rows' covariance less the identity; 0 without a component that varies.

    Whitened rows are centred already; what rounding leaves of their mean is taken off again.
    """
    k = len(by.values)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = np.zeros(k), np.zeros((k, k))
        for x in _parts(batches):
            w = np.nan_to_num(by(x))
            first, second = first + w.sum(axis=0), second + w.T @ w
        yield pa.record_batch([pa.array([first.tolist()]), pa.array([second.ravel().tolist()])], names=["first", "second"])

    parts = rows.mapInArrow(task, "first array<double>, second array<double>")
    sums = parts.select(F.posexplode(F.concat("first", "second")).alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v"))
    total = np.array([r["v"] for r in sorted(sums.collect(), key=lambda r: r["i"])]) / by.n
    found = total[k:].reshape(k, k) - np.outer(total[:k], total[:k])
    off = np.abs(found - np.eye(k))[np.ix_(by.known, by.known)]
    return float(off.max(initial=0.0))


_OUT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(rows: DataFrame, by: Whitening | None, error: float) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error): a row for each row and component, components from 1."""
    kind = rows.schema["id"].dataType.simpleString()
    if by is None:
        return rows.sparkSession.createDataFrame([], f"id {kind}, {_OUT}")
    k, share = len(by.values), (np.maximum(by.values, 0) / by.trace if by.trace > 0 else np.zeros(len(by.values)))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for low in range(0, whole_batch.num_rows, _ROWS):
                batch = whole_batch.slice(low, _ROWS)
                x, m = _matrix(batch), batch.num_rows
                each = pa.array(np.repeat(np.arange(m), k))
                w = by(x).ravel()
                yield pa.record_batch(
                    [
                        batch.column("id").take(each), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()), pa.array(np.full(m * k, by.n)), pa.array(by.deviations(x), pa.int64()).take(each),
                        pa.array(w, mask=np.isnan(w)), pa.array(np.tile(share, m)), pa.array(np.full(m * k, error)),
                    ],
                    names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.mapInArrow(task, f"id {kind}, {_OUT}")


def whitened(vectors: DataFrame, *, key: str, vector: str, most: int = COMPONENTS) -> DataFrame:
    """:func:`whiten` of the rows of ``vectors`` that take part, with their own statistics."""
    rows = written(vectors.select(F.col(key).alias("id"), whole(F.col(vector)).alias("x")).where("x is not null"), "whole")
    rows, by = fit(rows, most)
    return whiten(rows, by, 0.0 if by is None else identity_error(rows, by))
