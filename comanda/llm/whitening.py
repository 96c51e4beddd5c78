"""Whitening of embeddings by leading components, which contour integrals find (FEAST)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comanda.llm.common import stored

COMPONENTS = 8
# An entry c counts as floor(SCALE * c) + SHIFT, a whole number.
SCALE, SHIFT = 1024, 100_000
# Entries from here on have no exact whole number; vectors with one count as non-finite.
_LIMIT = float(1 << 42)
# Whole numbers are multiplied in parts of so many bits, a block of rows at a
# time, so that sums in doubles stay exact.
_PART, _BLOCK = 20, 1 << 12
# Points of the quadrature on half a circle, and eigenvalues of a slice.
_POINTS, _SLICE = 16, 4
# Rounds of the integral at most, and the residual, in shares of the norm, that must be reached.
_ROUNDS, _RESIDUAL = 200, 1e-12
# Eigenvalues below this share of the largest count as no variance.
_NO_VARIANCE = 1e-11


@dataclass(frozen=True)
class Whitener:
    """Exact sums of the fitted whole numbers, and components by falling eigenvalue."""

    n: int
    sums: list[int]
    trace: float
    values: np.ndarray
    vectors: np.ndarray

    @property
    def centre(self) -> np.ndarray:
        """The whole number nearest to each mean."""
        return np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], np.int64)


def usable(embeddings: DataFrame) -> DataFrame:
    """vec_id and embedding, as doubles, of vectors without null and non-finite entries.

    Vectors of another length than most (of equally many: the longest) go too.
    """
    rows = embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    odd = F.exists("embedding", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) >= _LIMIT))
    rows = rows.where(F.col("embedding").isNotNull() & ~odd)
    lengths = rows.groupBy(F.size("embedding").alias("dims")).count()
    most = lengths.orderBy(F.desc("count"), F.desc("dims")).limit(1).collect()  # bounded: one row
    return rows.where(F.size("embedding") == (most[0].dims if most else 0))


def _whole_numbers(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column("embedding")
    entries = column.flatten().to_numpy(zero_copy_only=False)
    rows = len(column)
    return np.floor(entries * SCALE).astype(np.int64).reshape(rows, len(entries) // max(rows, 1)) + SHIFT


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        for at in range(0, batch.num_rows, _BLOCK):
            yield _whole_numbers(batch.slice(at, _BLOCK))


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per dimension its rows and sum in this task; sums are exact, as decimal text."""
    n, sums = 0, 0
    for block in _blocks(batches):
        n += len(block)
        sums = sums + block.sum(0).astype(object)
    if n:
        columns = [range(len(sums)), [n] * len(sums), [str(s) for s in sums]]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _SUM_TYPES)], ["i", "n", "total"])


_SUM_TYPES = (pa.int32(), pa.int64(), pa.string())


def exact_products(rows: np.ndarray) -> np.ndarray:
    """Sums over rows of all products of two columns of whole numbers, as Python integers."""
    sign, rest, parts = np.sign(rows), np.abs(rows), []
    while rest.any():
        parts.append((sign * (rest & ((1 << _PART) - 1))).astype(np.float64))
        rest = rest >> _PART
    total = np.zeros((rows.shape[1], rows.shape[1]), object)
    for a, left in enumerate(parts):
        for b, right in enumerate(parts):
            total += (left.T @ right).astype(np.int64).astype(object) << _PART * (a + b)
    return total


def _products(centre: np.ndarray):
    """Per pair of dimensions the sum of products of deviations from ``centre`` in this task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for block in _blocks(batches):
            found = exact_products(block - centre)
            total = found if total is None else total + found
        if total is not None:
            i, j = np.triu_indices(len(total))
            columns = [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([str(t) for t in total[i, j]])]
            yield pa.RecordBatch.from_arrays(columns, ["i", "j", "total"])

    return run


def _nearest(numerator: int, denominator: int) -> float:
    """Correctly rounded quotient of integers of any length."""
    return numerator / denominator


def covariance(rows: DataFrame) -> tuple[int, list[int], np.ndarray] | None:
    """Rows, exact sums and the covariance (divisor n) of usable vectors; None without rows.

    Two passes, of which each task sends one row a dimension, then one a pair of
    dimensions. Products are of deviations from the whole number next to the
    mean, exact, and moved to the mean itself in integers; each entry is rounded
    once.
    """
    exact = F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    sums = rows.mapInArrow(_totals, "i int, n long, total string").groupBy("i").agg(F.sum("n").alias("n"), exact)
    found = {r.i: (r.n, int(r.total)) for r in sums.collect()}  # bounded: a row per dimension
    if not found:
        return None
    n, totals = found[0][0], [found[i][1] for i in range(len(found))]
    centre = Whitener(n, totals, 0.0, np.empty(0), np.empty(0)).centre
    moved = [s - n * int(c) for s, c in zip(totals, centre)]
    products = rows.mapInArrow(_products(centre), "i int, j int, total string").groupBy("i", "j").agg(exact)
    matrix = np.zeros((len(totals), len(totals)))
    for r in products.collect():  # bounded: a row per two dimensions
        matrix[r.i, r.j] = matrix[r.j, r.i] = _nearest(n * int(r.total) - moved[r.i] * moved[r.j], n * n)
    return n, totals, matrix


def _tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a tridiagonal matrix with the same eigenvalues, by reflections."""
    a = matrix.copy()
    for k in range(len(a) - 2):
        v = a[k + 1 :, k].copy()
        v[0] += np.copysign(np.linalg.norm(v), v[0])
        length = np.linalg.norm(v)
        if length == 0:
            continue
        v /= length
        a[k + 1 :, k:] -= 2 * np.outer(v, v @ a[k + 1 :, k:])
        a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy()


class Inertia:
    """Counts eigenvalues above a shift from the signs of the pivots of the shifted matrix."""

    def __init__(self, matrix: np.ndarray):
        self.diagonal, beside = _tridiagonal(matrix)
        self.squares = np.concatenate([[0.0], beside * beside])
        edge = np.abs(np.concatenate([[0.0], beside, [0.0]]))
        spread = edge[:-1] + edge[1:]
        self.low = float(np.min(self.diagonal - spread))
        self.high = float(np.max(self.diagonal + spread))
        self.norm = max(abs(self.low), abs(self.high))

    def above(self, shift: float) -> int:
        tiny = np.finfo(float).tiny / np.finfo(float).eps
        count, pivot = 0, 1.0
        for diagonal, square in zip(self.diagonal.tolist(), self.squares.tolist()):
            pivot = diagonal - shift - (square / pivot if square else 0.0)
            if abs(pivot) < tiny:
                pivot = -tiny
            count += pivot > 0
        return count

    def value(self, k: int) -> float:
        """The k-th largest eigenvalue (from 1), by halving."""
        low, high = self.low - self.norm * 1e-12, self.high + self.norm * 1e-12
        while True:
            middle = low + (high - low) / 2
            if not low < middle < high or high - low <= 4e-16 * self.norm:
                return middle
            low, high = (middle, high) if self.above(middle) >= k else (low, middle)


def _slices(inertia: Inertia, count: int) -> list[tuple[float, float]]:
    """Intervals, from the top, that together hold the ``count`` largest eigenvalues and none beside.

    They are cut at the widest gaps, and end in gaps, near to what they hold.
    Eigenvalues too near to each other for a cut stay in one interval, also
    those beyond ``count``.
    """
    dims, least = len(inertia.diagonal), 1e-12 * inertia.norm
    values = [inertia.value(k) for k in range(1, min(count + 1, dims) + 1)]
    while len(values) < dims and values[-2] - values[-1] <= least:
        values.append(inertia.value(len(values) + 1))
    tied = len(values) > count and values[-2] - values[-1] <= least
    inside = len(values) if len(values) == count or tied else len(values) - 1

    def cut(first: int, last: int) -> list[int]:
        gaps = [values[i - 1] - values[i] for i in range(first + 1, last)]
        if last - first <= _SLICE or max(gaps) <= least:
            return []
        at = first + 1 + int(np.argmax(gaps))
        return [*cut(first, at), at, *cut(at, last)]

    bounds = []
    for first, last in pairwise([0, *cut(0, inside), inside]):
        top, bottom = values[first], values[last - 1]
        room = max(top - bottom, 0.1 * abs(top))
        over = (values[first - 1] - top) / 2 if first else room
        under = (bottom - values[last]) / 2 if last < len(values) else room
        bounds.append((bottom - min(room, under), top + min(room, over)))
    return bounds


def _feast(matrix: np.ndarray, low: float, high: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenpairs between ``low`` and ``high``.

    A circle around the interval; the integral of the resolvent along it
    projects onto the eigenvectors inside. Its quadrature takes a complex
    shifted solve a point, on the upper half only, as the matrix is real. The
    projected block is made orthonormal, and Rayleigh-Ritz takes the pairs from
    it, until their residuals are at rounding or shrink no more.
    """
    dims = len(matrix)
    centre, radius = (low + high) / 2, (high - low) / 2
    turns = np.exp(1j * np.pi * (np.arange(_POINTS) + 0.5) / _POINTS)
    shifted = (centre + radius * turns)[:, None, None] * np.eye(dims) - matrix
    norm = np.abs(matrix).sum(0).max()
    block = np.random.default_rng(11).standard_normal((dims, min(dims, 2 * count + 4)))
    best = (np.inf, None, None)
    for _ in range(_ROUNDS):
        solved = np.linalg.solve(shifted, np.broadcast_to(block.astype(complex), (_POINTS, *block.shape)))
        projected = np.tensordot(radius * turns / _POINTS, solved, 1).real
        basis, _ = np.linalg.qr(projected)
        ritz, turn = np.linalg.eigh(basis.T @ matrix @ basis)
        block = basis @ turn
        inside = np.flatnonzero((ritz > low) & (ritz < high))
        if len(inside) != count:
            continue
        values, vectors = ritz[inside], block[:, inside]
        error = np.abs(matrix @ vectors - vectors * values).max() / norm
        if error >= best[0] / 2 and best[0] < _RESIDUAL:
            break
        if error < best[0]:
            best = (error, values, vectors)
    if best[0] >= _RESIDUAL:
        raise ArithmeticError(f"{count} eigenvalues lie between {low} and {high}, residual {best[0]}")
    return best[1], best[2]


def leading_components(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a covariance, falling, and unit eigenvectors as columns.

    At most ``count``, of those that are above rounding. How many lie in each
    interval is counted by inertia, and that many pairs must come out of it.
    """
    scale = np.abs(matrix).max(initial=0.0)
    if scale == 0:
        return np.empty(0), np.empty((len(matrix), 0))
    inertia = Inertia(matrix / scale)
    positive = inertia.above(_NO_VARIANCE * inertia.high)
    slices = _slices(inertia, min(count, positive))
    found = [_feast(matrix / scale, a, b, inertia.above(a) - inertia.above(b)) for a, b in slices]
    if sum(len(v) for v, _ in found) != inertia.above(slices[-1][0]):
        raise ArithmeticError("an eigenvalue lies between the intervals")
    values = np.concatenate([v for v, _ in found])
    vectors = np.concatenate([v for _, v in found], axis=1)
    order = np.argsort(-values, kind="stable")[: min(count, positive)]
    vectors = vectors[:, order]
    return values[order] * scale, vectors / np.linalg.norm(vectors, axis=0)


def fit(rows: DataFrame, count: int = COMPONENTS) -> Whitener | None:
    """Fit on usable vectors; None without rows.

    What comes to the driver has the size of the covariance, whatever the rows.
    """
    found = covariance(rows)
    if found is None:
        return None
    n, sums, matrix = found
    values, vectors = leading_components(matrix, count)
    return Whitener(n, sums, float(np.trace(matrix)), values, vectors)


def _whiten_rows(model: Whitener):
    centre = model.centre
    moved = [s - model.n * int(c) for s, c in zip(model.sums, centre)]
    rest = np.array([_nearest(m, model.n) for m in moved])
    turn = model.vectors / np.sqrt(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _BLOCK):
                part = batch.slice(at, _BLOCK)
                apart = _whole_numbers(part) - centre
                exact = ((apart.astype(object) * model.n - np.array(moved, object)) ** 2).sum(1)
                whitened = (apart - rest) @ turn
                columns = {
                    "vec_id": part.column("vec_id"),
                    "deviation": pa.array([int(d) if d < 1 << 63 else None for d in exact], pa.int64()),
                    "distance": pa.array([_nearest(int(d), model.n**2) for d in exact], pa.float64()),
                    "whitened": pa.array(list(whitened), pa.list_(pa.float64())),
                }
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return run


def identity_error(vectors: DataFrame, count: int) -> float:
    """The largest entry of the covariance of whitened columns minus the identity."""
    entries = [
        F.abs(F.covar_pop(F.col("whitened")[i], F.col("whitened")[j]) - float(i == j))
        for i in range(count)
        for j in range(i, count)
    ]
    return vectors.agg(F.greatest(*entries, F.lit(0.0), F.lit(0.0))).first()[0]


def whiten(embeddings: DataFrame, count: int = COMPONENTS) -> DataFrame:
    """Whitened vectors, a row for each vector and component.

    vec_id; component, from 1 by falling eigenvalue; n, the fitted vectors;
    deviation, the sum over dimensions of (n * x - sum)^2, exact, null where a
    long has no room for it; whitened; explained, the eigenvalue's share of the
    trace; identity_error; and distance, the deviation over n^2. x is
    floor(1024 * entry) + 100000, and all usable vectors are fitted.

    Vectors that are null or hold null or non-finite entries (or entries of 2^42
    and more, or another length than most) have no rows. Equal eigenvalues have
    any orthonormal vectors of their space. Components without variance can't
    be whitened and have no rows: one vector, or equal ones alone, give no rows,
    as does an empty table. Null or repeated vec_ids: rows for each vector.
    """
    spark = embeddings.sparkSession
    rows = usable(embeddings)
    model = fit(rows, count)
    id_type = dict(rows.dtypes)["vec_id"]
    if model is None or not len(model.values):
        schema = f"vec_id {id_type}, component int, n long, deviation long, whitened double, explained double"
        return spark.createDataFrame([], f"{schema}, identity_error double, distance double")
    schema = f"vec_id {id_type}, deviation long, distance double, whitened array<double>"
    vectors = stored(rows.mapInArrow(_whiten_rows(model), schema), "whitened")
    error = identity_error(vectors, len(model.values))
    shares = F.array(*[F.lit(float(v / model.trace)) for v in model.values])
    return vectors.select("*", F.posexplode("whitened").alias("at", "one")).select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        F.col("one").alias("whitened"),
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
        "distance",
    )
