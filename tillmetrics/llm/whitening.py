"""Whitening of embeddings by an incremental eigendecomposition.

Entries become whole numbers, x = floor(1024 c) + 100000, so that the number of vectors and
their sums are exact. Every partition keeps the spectrum (eigenvalues and eigenvectors) of the
scatter of the vectors it has met. A new vector, at distance v from the mean so far, changes the
scatter by n / (n + 1) times v v': one centred rank-one update. Its eigenvalues are the roots of

    1 / rho + sum z_j^2 / (d_j - t) = 0,

one between each two old ones. Directions that z does not touch, and all but one of those with
the same eigenvalue, are deflated: they stay as they are. Eigenvectors come from the z that
has exactly the computed roots, which keeps them orthogonal however close the roots lie. Copies
of a vector in one Arrow batch are one update with their number as weight.

Two spectra are combined by rank-one updates as well: one for each eigenpair of the second and
one for the distance of the means. Partitions are combined in groups of ``FAN_IN`` until one is
left; a spectrum has the square of the dimension as its size, whatever the number of rows.

The eigenvectors found are an orthonormal basis. A last distributed Rayleigh-Ritz step sums the
covariance in that basis over all vectors, centred by the exact mean, and solves it; what rounding
the many updates have gathered goes with it. Only spectra and such sums reach the driver.

Defined results: vectors that are null, empty, of another length than most vectors have (of two lengths
equally common, the longer counts), or hold null or non-finite entries are dropped. vec_id null or repeated:
rows of their own. Components whose eigenvalue is zero, up to rounding, have a null ``whitened``; if all
are so (one vector, or only copies), ``identity_error`` is null, and ``explained`` where the trace is zero.
``deviation`` is null where it exceeds a long. Empty table: no rows. Fewer dimensions than
components: as many components as dimensions. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import query, table

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Spectra or sums that one task combines.
FAN_IN = 8
EPS = float(np.finfo(np.float64).eps)
MOST_STEPS = 60

WHITENED = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
SPECTRA = "part long, n long, sums binary, mean binary, values binary, vectors binary"
SUMS = "part long, total binary"


class Spectrum:
    """Number, exact sums, mean and eigenpairs of the scatter of vectors."""

    def __init__(self, dimension: int):
        self.n = 0
        self.sums = np.zeros(dimension, np.int64)
        self.mean = np.zeros(dimension)
        self.values = np.zeros(dimension)
        self.vectors = np.eye(dimension)

    def add(self, x: np.ndarray, copies: int = 1) -> None:
        away = x - self.mean
        self._centred(away, copies)
        self.n += copies
        self.sums += x * copies

    def combine(self, other: Spectrum) -> None:
        for value, vector in zip(other.values, other.vectors.T):
            if value > 0:
                self.values, self.vectors = updated(self.values, self.vectors, value, vector)
        if other.n:
            self._centred(other.mean - self.mean, other.n)
        self.n += other.n
        self.sums += other.sums

    def _centred(self, away: np.ndarray, copies: int) -> None:
        share = copies / (self.n + copies)
        if self.n:
            self.values, self.vectors = updated(self.values, self.vectors, self.n * share, away)
        self.mean = self.mean + share * away


def updated(values: np.ndarray, vectors: np.ndarray, rho: float, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenpairs of ``vectors diag(values) vectors' + rho v v'``, rho above 0, values ascending."""
    z = vectors.T @ v
    size = float(z @ z)
    if size <= 0.0:
        return values, vectors
    rho, z = rho * size, z / np.sqrt(size)
    near = 8 * EPS * max(abs(values[-1]), abs(values[0]), rho)
    vectors = vectors.copy()
    # Of directions with one eigenvalue, a reflection leaves a single one that z touches.
    start = 0 if (np.diff(values) <= near).any() else len(values)
    while start < len(values):
        stop = int(np.searchsorted(values, values[start] + near, "right"))
        if stop - start > 1 and np.count_nonzero(rho * np.abs(z[start:stop]) > near) > 1:
            mirror = z[start:stop].copy()
            length = np.copysign(np.linalg.norm(mirror), mirror[-1])
            mirror[-1] += length
            mirror /= np.linalg.norm(mirror)
            block = vectors[:, start:stop]
            block -= np.outer(block @ mirror, 2 * mirror)
            z[start:stop] = 0.0
            z[stop - 1] = -length
        start = stop
    live = np.flatnonzero(rho * np.abs(z) > near)
    if not len(live):
        return values, vectors
    # Entries of one block may lie closer than rounding tells apart; one of them stays as it is.
    live = live[np.concatenate([np.diff(values[live]) > 0, [True]])]
    roots, turn = _rank_one(values[live], z[live], rho)
    values = values.copy()
    values[live] = roots
    vectors[:, live] = vectors[:, live] @ turn
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


def _rank_one(d: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenpairs of ``diag(d) + rho z z'``: d strictly ascending, no z is zero.

    Each root is sought as a distance from the nearer of its two poles, so that differences to the
    poles keep their digits. Steps solve the quadratic of a function with the same value and slopes
    and poles at both ends; where a step leaves the bracket, the bracket is halved.
    """
    k, square = len(d), z * z
    upper = np.append(d[1:], d[-1] + 2 * rho * square.sum())
    half = (upper - d) / 2
    gaps = d[:, None] - d[None, :]
    inverse = 1.0 / rho
    at_half = inverse + (square[:, None] / (gaps - half)).sum(axis=0)
    low = at_half >= 0  # the root lies in the lower half
    low[-1] = True
    origin = np.where(low, d, upper)
    poles = d[:, None] - origin[None, :]
    lo, hi = np.where(low, 0.0, d - origin), np.where(low, upper - origin, 0.0)
    lo, hi = np.where(low, lo, -half), np.where(low & (np.arange(k) < k - 1), half, hi)
    first, second = d - origin, upper - origin
    below = np.tri(k, dtype=bool).T  # poles up to the root's own
    move = (lo + hi) / 2
    for _ in range(MOST_STEPS):
        away = poles - move
        parts = square[:, None] / away
        slopes = parts / away
        psi, slope_psi = np.where(below, parts, 0.0).sum(axis=0), np.where(below, slopes, 0.0).sum(axis=0)
        phi, slope_phi = parts.sum(axis=0) - psi, slopes.sum(axis=0) - slope_psi
        f = inverse + psi + phi
        lo, hi = np.where(f < 0, move, lo), np.where(f < 0, hi, move)
        done = np.abs(f) <= 4 * EPS * k * (inverse + np.abs(psi) + np.abs(phi))
        done |= hi - lo <= 2 * EPS * np.maximum(np.abs(lo), np.abs(hi))
        if done.all():
            break
        one, two = first - move, second - move
        c = f - one * slope_psi - two * slope_phi
        a = (one + two) * f - one * two * (slope_psi + slope_phi)
        b = one * two * f
        with np.errstate(all="ignore"):
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0.0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
        there = move + step
        inside = (there > lo) & (there < hi)
        move = np.where(done, move, np.where(inside, there, (lo + hi) / 2))
    away = poles - move  # d_j - t_i
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = -away.T / gaps  # (t_i - d_j) / (d_i - d_j), at [i, j]
    np.fill_diagonal(ratio, -np.diag(away) / rho)
    exact = np.copysign(np.sqrt(np.abs(ratio.prod(axis=0))), z)
    turn = exact[:, None] / away
    return origin + move, turn / np.linalg.norm(turn, axis=0)


# --- tasks ------------------------------------------------------------------------------


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimension)
    return np.floor(values * SCALE).astype(np.int64) + SHIFT


def _spectra(dimension: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Spectrum(dimension)
        for batch in batches:
            rows, copies = np.unique(_matrix(batch.column("vector"), dimension), axis=0, return_counts=True)
            for x, many in zip(rows, copies.tolist()):
                found.add(x, many)
        yield pa.RecordBatch.from_pandas(_row(TaskContext.get().partitionId(), found), preserve_index=False)

    return run


def _row(part: int, s: Spectrum) -> pd.DataFrame:
    packed = (np.ascontiguousarray(a).tobytes() for a in (s.sums, s.mean, s.values, s.vectors))
    return pd.DataFrame([(part, s.n, *packed)], columns=[c.split()[0] for c in SPECTRA.split(", ")])


def _spectrum(row) -> Spectrum:
    s = Spectrum(len(row.mean) // 8)
    s.n, s.sums = int(row.n), np.frombuffer(row.sums, np.int64).copy()
    s.mean, s.values = np.frombuffer(row.mean).copy(), np.frombuffer(row.values).copy()
    s.vectors = np.frombuffer(row.vectors).reshape(len(s.mean), -1).copy()
    return s


def _combine_spectra(rows: pd.DataFrame) -> pd.DataFrame:
    total = None
    for row in rows.sort_values("part").itertuples(index=False, name="Row"):
        if total is None:
            total = _spectrum(_Fields(row, rows.columns))
        else:
            total.combine(_spectrum(_Fields(row, rows.columns)))
    return _row(int(rows.part.min()) // FAN_IN, total)


class _Fields:
    """A row's values by column name."""

    def __init__(self, row, columns):
        self.__dict__.update(zip(columns, row))


def _combine_sums(rows: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(r) for r in rows.sort_values("part").total)
    return pd.DataFrame({"part": [int(rows.part.min()) // FAN_IN], "total": [total.tobytes()]})


def _folded(parts: DataFrame, partitions: int, combine, schema: str):
    """The one row left after combining neighbours, ``FAN_IN`` at a time; None without rows."""
    while True:
        parts = parts.groupBy(F.floor(F.col("part") / FAN_IN).alias("group")).applyInPandas(combine, schema)
        partitions = -(-partitions // FAN_IN)
        if partitions <= 1:
            return parts.first()


def _products(dimension: int, mean: np.ndarray, basis: np.ndarray):
    """Sums of the outer products, and of the vectors, in the given basis."""
    wide = basis.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((wide + 1, wide))
        for batch in batches:
            y = (_matrix(batch.column("vector"), dimension) - mean) @ basis
            total[:wide] += y.T @ y
            total[wide] += y.sum(axis=0)
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_pydict({"part": [part], "total": [total.tobytes()]})

    return run


def _project(dimension: int, n: int, sums: np.ndarray, basis: np.ndarray, explained: list, identity_error: float | None):
    mean, many = sums / n, len(explained)
    real = basis.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("vector"), dimension)
            rows = len(x)
            if not rows:
                continue
            white = np.full((rows, many), np.nan)
            white[:, :real] = (x - mean) @ basis
            repeated = np.repeat(np.arange(rows), many)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(repeated)),
                    pa.array(np.tile(np.arange(1, many + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * many, n, np.int64)),
                    pa.array(_deviations(x, n, sums), pa.int64()).take(pa.array(repeated)),
                    pa.array(white.ravel(), from_pandas=True),
                    pa.array(explained * rows, pa.float64()),
                    pa.array([identity_error] * (rows * many), pa.float64()),
                ],
                names=[c.split()[0] for c in WHITENED.split(", ")],
            )

    return run


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    largest = int(np.abs(x).max()) * n + int(np.abs(sums).max())
    if largest * largest * x.shape[1] < 1 << 63:
        away = x * n - sums
        return (away * away).sum(axis=1).tolist()
    exact = [sum((n * a - s) ** 2 for a, s in zip(row, sums.tolist())) for row in x.tolist()]
    return [e if e < 1 << 63 else None for e in exact]


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Per vector and component: the whitened value, with the figures of the fit."""
    spark = embeddings.sparkSession
    finite = F.forall("embedding", lambda c: c.isNotNull() & (F.abs(c) < F.lit(float("inf"))))
    rows = embeddings.where(finite & (F.size("embedding") > 0)).select("vec_id", F.col("embedding").alias("vector"))
    common = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if common is None:
        return spark.createDataFrame([], WHITENED)
    d = common["d"]
    rows = rows.where(F.size("vector") == d)
    partitions = rows.rdd.getNumPartitions()
    parts = rows.select("vector").mapInArrow(_spectra(d), SPECTRA)
    fit = _spectrum(_folded(parts, partitions, _combine_spectra, SPECTRA))
    n, mean = fit.n, fit.sums / fit.n

    def products(basis):
        sums = rows.select("vector").mapInArrow(_products(d, mean, basis), SUMS)
        wide = basis.shape[1]
        total = np.frombuffer(_folded(sums, partitions, _combine_sums, SUMS)["total"]).reshape(wide + 1, wide)
        return total[:wide] / n - np.outer(total[wide] / n, total[wide] / n)

    basis = np.linalg.qr(fit.vectors[:, ::-1])[0]
    covariance = products(basis)
    values, turn = np.linalg.eigh((covariance + covariance.T) / 2)
    values, vectors = np.maximum(values[::-1], 0.0), basis @ turn[:, ::-1]
    vectors *= np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(d)])
    trace = float(values.sum())
    top = min(components, d)
    real = int(np.count_nonzero(values[:top] > d * EPS * values[0]))
    white = vectors[:, :real] / np.sqrt(values[:real])
    error = float(np.abs(products(white) - np.eye(real)).max()) if real else None
    explained = [float(e) / trace if trace > 0 else None for e in values[:top]]
    return rows.mapInArrow(_project(d, n, fit.sums, white, explained, error), WHITENED)


@query("op13_whitening")
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
