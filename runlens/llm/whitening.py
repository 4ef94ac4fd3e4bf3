"""Whitening of vectors: covariance, leading components, projection.

Vectors are put on an integer grid, so that means and deviations are exact.
The fit list is each distinct grid vector once. Two passes over it, in Arrow
batches: exact sums by dimension, then the covariance, every entry centred
before it is multiplied. A task hands on one matrix of dim x dim, and the
matrices are summed by row in a shuffle; the driver gets only the sums, whose
size is set by the dimension.

The driver turns the covariance into a tridiagonal matrix by Householder
reflections, finds the leading eigenvalues by bisection on Sturm counts and
their vectors by inverse iteration, reorthogonalised within clusters of close
eigenvalues. The components are broadcast (dim x components doubles), all rows
are projected on them batch by batch, and a third pass over the fit list
measures how far the whitened covariance is from the identity.

Defined results: rows whose vector is null, empty, or holds null or non-finite
entries are dropped, and so are vectors with an entry above ``LARGEST`` in
absolute value, which the grid's integers can't hold, and those of another
length than most (ties: the longer). Zero vectors stay. Repeated rows count
once in the fit and each get their rows; a null id stays null. A component
whose eigenvalue is below ``RANK`` times the largest is numerically zero, can't
be scaled to unit variance and is left out: equal vectors alone give no rows.
``deviation`` is null where its exact value needs more than 64 bits.
"""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

#: The grid: x = floor(GRID * c) + OFFSET.
GRID, OFFSET = 64, 1_000_000
LARGEST = 2.0**40
RANK = 1e-10
EPS = np.finfo(np.float64).eps
#: Eigenvalues closer than this part of the matrix's norm form a cluster.
CLUSTER = 1e-3


# ------------------------------------------------------------------ eigenvectors of a symmetric matrix
def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(diagonal, off-diagonal, reflections) of a symmetric matrix: Householder reflections, the i-th of which acts on
    the coordinates from i + 1 on."""
    a = a.copy()
    d = len(a)
    off, mirrors = np.zeros(max(d - 1, 0)), []
    for i in range(d - 2):
        v = a[i + 1:, i].copy()
        length = np.linalg.norm(v)
        if np.linalg.norm(v[1:]) == 0:  # nothing to clear
            off[i] = v[0]
            mirrors.append(np.zeros_like(v))
            continue
        off[i] = -np.copysign(length, v[0])
        v[0] -= off[i]
        v /= np.linalg.norm(v)
        rest = a[i + 1:, i + 1:]
        p = rest @ v
        w = p - (v @ p) * v
        rest -= 2 * (np.outer(v, w) + np.outer(w, v))
        mirrors.append(v)
    if d > 1:
        off[d - 2] = a[d - 1, d - 2]
    return np.diag(a).copy(), off, mirrors


def sturm_counts(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues of the tridiagonal matrix are below each of ``at``."""
    tiny = max(EPS * EPS, np.finfo(np.float64).tiny / EPS) * max(1.0, float(np.max(off * off, initial=0.0)))
    q = diagonal[0] - at
    count = (q < 0).astype(np.int64)
    for i in range(1, len(diagonal)):
        q = np.where(np.abs(q) < tiny, -tiny, q)
        q = diagonal[i] - at - off[i - 1] ** 2 / q
        count += q < 0
    return count


def leading_eigenvalues(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, each to the last bits of the matrix's norm."""
    d = len(diagonal)
    reach = np.abs(np.concatenate([[0.0], off])) + np.abs(np.concatenate([off, [0.0]]))
    low = np.full(k, (diagonal - reach).min())
    high = np.full(k, (diagonal + reach).max())
    slack = EPS * max(np.abs(low[0]), np.abs(high[0]), np.finfo(np.float64).tiny)
    low, high = low - 2 * slack, high + 2 * slack
    wanted = d - np.arange(k)  # the i-th largest lies where the count below passes d - i
    while True:
        middle = (low + high) / 2
        if ((high - low <= slack) | (middle <= low) | (middle >= high)).all():
            return middle
        below = sturm_counts(diagonal, off, middle) >= wanted
        high, low = np.where(below, middle, high), np.where(below, low, middle)


def _solve(diagonal: np.ndarray, off: np.ndarray, shift: float, b: np.ndarray, least: float) -> np.ndarray:
    """(T - shift) x = b by elimination with row exchanges; pivots are at least ``least``."""
    d = len(diagonal)
    main, one, two, x = diagonal - shift, np.append(off, 0.0), np.zeros(d), b.copy()
    for i in range(d - 1):
        under = off[i]
        if abs(under) > abs(main[i]):
            main[i], under = under, main[i]
            one[i], main[i + 1] = main[i + 1], one[i]
            if i + 1 < d - 1:
                two[i], one[i + 1] = one[i + 1], 0.0
            x[i], x[i + 1] = x[i + 1], x[i]
        if abs(main[i]) < least:
            main[i] = np.copysign(least, main[i])
        factor = under / main[i]
        main[i + 1] -= factor * one[i]
        one[i + 1] -= factor * two[i]
        x[i + 1] -= factor * x[i]
    if abs(main[-1]) < least:
        main[-1] = np.copysign(least, main[-1])
    for i in range(d - 1, -1, -1):
        x[i] = (x[i] - (one[i] * x[i + 1] if i + 1 < d else 0.0) - (two[i] * x[i + 2] if i + 2 < d else 0.0)) / main[i]
        if abs(x[i]) > 1e150:  # only the direction counts
            scale = 1 / abs(x[i])
            x *= scale
    return x


def eigenvectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray, rounds: int = 4) -> np.ndarray:
    """Unit eigenvectors (columns) of the tridiagonal matrix for its falling eigenvalues ``values``."""
    norm = max(float(np.abs(diagonal).max()), float(np.abs(off).max(initial=0.0)), np.finfo(np.float64).tiny)
    rng = np.random.default_rng(11)
    found = np.zeros((len(diagonal), len(values)))
    start, before = 0, np.inf
    for j, value in enumerate(values):
        if j and values[j - 1] - value > CLUSTER * norm:
            start = j
        shift = min(value, before - 10 * EPS * norm) if j > start else value  # equal values need unequal shifts
        before = shift
        x = rng.uniform(-1, 1, len(diagonal))
        for _ in range(rounds):
            x = _solve(diagonal, off, shift, x, EPS * norm)
            x /= np.abs(x).max()
            for _ in range(2):
                x -= found[:, start:j] @ (found[:, start:j].T @ x)
            x /= np.linalg.norm(x)
        found[:, j] = x
    return found


def leading_components(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as columns) of the ``k`` leading components."""
    if not matrix.any():
        return np.zeros(k), np.eye(len(matrix))[:, :k]
    diagonal, off, mirrors = tridiagonal(matrix)
    values = leading_eigenvalues(diagonal, off, k)
    vectors = eigenvectors(diagonal, off, values)
    for i in reversed(range(len(mirrors))):
        part = vectors[i + 1:]
        part -= 2 * np.outer(mirrors[i], mirrors[i] @ part)
    return values, vectors


# ------------------------------------------------------------------ passes over the vectors
def grid(column) -> np.ndarray:
    """An Arrow list column of grid vectors as an integer matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _sums(batches):
    n, sums = 0, None
    for batch in batches:
        if batch.num_rows:
            x = grid(batch.column(0))
            # integers of up to 47 bits: blocks of 2^15 rows can't overflow; the total is an unbounded integer
            parts = [x[i:i + (1 << 15)].sum(axis=0) for i in range(0, len(x), 1 << 15)]
            sums = [sum(map(int, c), s) for s, *c in zip(sums or [0] * x.shape[1], *parts, strict=True)]
            n += len(x)
    if n:
        places = list(range(-1, len(sums)))
        yield pa.RecordBatch.from_arrays([pa.array(places, pa.int32()), pa.array(list(map(str, [n, *sums])))], ["place", "sum"])


@dataclass(frozen=True)
class Mean:
    """The exact mean of the fit list: sums / n, as whole parts and the fractions left."""

    n: int
    sums: list[int]

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n: the whole part is subtracted in integers, so nothing is lost to the size of x."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([float(Fraction(s % self.n, self.n)) for s in self.sums])
        return (x - whole).astype(np.float64) - rest

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over the dimensions of (n * x - S)^2, exact; None where it needs more than 64 bits."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        left = [s % self.n for s in self.sums]
        off = x - whole
        rough = ((np.abs(off).astype(np.float64) + 1) * float(self.n)) ** 2
        small = rough.sum(axis=1) < 2.0**62
        exact = off[small] * np.int64(self.n) - np.array(left, np.int64) if small.any() else np.zeros((0, x.shape[1]), np.int64)
        out = np.empty(len(x), object)
        out[small] = (exact * exact).sum(axis=1).tolist()
        for i in np.flatnonzero(~small):
            total = sum((self.n * int(o) - r) ** 2 for o, r in zip(off[i].tolist(), left, strict=True))
            out[i] = total if total < 1 << 63 else None
        return out.tolist()


def _products(mean: Mean, by=None):
    """Row by row the matrix of products of the centred vectors of a task, projected on the broadcast ``by`` if given."""

    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                y = mean.centred(grid(batch.column(0)))
                y = y if by is None else y @ by.value
                total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            yield _rows(range(len(total)), total)

    return run


def _rows(places, values) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(places), pa.int32()), pa.array([v.tolist() for v in values],
                                                                                   pa.list_(pa.float64()))], ["place", "values"])


def _summed(batches):
    """Sums of the arrays by place, of which a task has few, one batch at a time."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for place, values in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            values = values.values.to_numpy()
            sums[place] = sums[place] + values if place in sums else values
    if sums:
        yield _rows(sums, sums.values())


def _matrix(fit: DataFrame, pass_over) -> np.ndarray:
    shape = "place int, values array<double>"
    parts = fit.select("x").mapInArrow(pass_over, shape).repartition("place").mapInArrow(_summed, shape)
    return np.array([r["values"] for r in sorted(parts.collect(), key=lambda r: r["place"])])  # dim x dim


@dataclass(frozen=True)
class Whitening:
    mean: Mean
    #: Columns that project a centred vector on the components, scaled to unit variance.
    scaled: np.ndarray
    explained: np.ndarray
    identity_error: float | None


def on_grid(vectors: DataFrame, grid_step: int = GRID, offset: int = OFFSET) -> DataFrame:
    """(vec_id, x) of the rows that take part, all of one length, stored."""
    v = F.col("embedding")
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) > F.lit(LARGEST)))
    rows = vectors.where(v.isNotNull() & (F.size(v) > 0)).where(~bad).select("vec_id", F.transform(
        v, lambda c: F.floor(c.cast("double") * grid_step) + F.lit(offset).cast("long")).alias("x"))
    rows = stored(rows, "whitening-rows")
    length = rows.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    return rows if length is None else rows.where(F.size("x") == length["dim"])


def fit_whitening(rows: DataFrame, components: int = 16) -> Whitening | None:
    """Mean, components and scale of the distinct vectors of ``rows`` (column x); None for an empty table."""
    fit = stored(rows.select("x").distinct(), "whitening-fit")
    total = F.sum(F.col("sum").cast("decimal(38,0)")).alias("sum")
    sums = fit.mapInArrow(_sums, "place int, sum string").groupBy("place").agg(total).collect()  # dim + 1 rows
    if not sums:
        return None
    n, *sums = [int(r["sum"]) for r in sorted(sums, key=lambda r: r["place"])]
    mean = Mean(n, sums)
    covariance = _matrix(fit, _products(mean)) / n
    covariance = (covariance + covariance.T) / 2
    values, vectors = leading_components(covariance, min(components, len(covariance)))
    kept = values > RANK * max(values[0], 0.0)
    values, vectors = values[kept], vectors[:, kept]
    scaled = vectors / np.sqrt(values)
    if not len(values):
        return Whitening(mean, scaled, values, None)
    whitened = _matrix(fit, _products(mean, fit.sparkSession.sparkContext.broadcast(scaled))) / n
    return Whitening(mean, scaled, values / np.trace(covariance), float(np.abs(whitened - np.eye(len(values))).max()))


WHITENED = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
            "identity_error double")


def project(rows: DataFrame, model: Whitening | None) -> DataFrame:
    """A row of columns WHITENED for each row of ``rows`` (vec_id, x) and component."""
    spark = rows.sparkSession
    if model is None or not len(model.explained):
        return spark.createDataFrame([], WHITENED)
    mean, shares, error = model.mean, model.explained, model.identity_error
    scaled = spark.sparkContext.broadcast(model.scaled)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = grid(batch.column(1))
            y = mean.centred(x) @ scaled.value
            k = y.shape[1]
            each = pa.array(np.repeat(np.arange(len(x)), k))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(x) * k, mean.n)), pa.array(mean.deviations(x), pa.int64()).take(each),
                pa.array(y.ravel()), pa.array(np.tile(shares, len(x))), pa.array(np.full(len(x) * k, error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), "x").mapInArrow(run, WHITENED)


def whiten(vectors: DataFrame, components: int = 16) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) for every row of ``vectors`` (vec_id,
    embedding) that takes part and every component."""
    rows = on_grid(vectors)
    return project(rows, fit_whitening(rows, components))
