"""Whitening of embeddings by shifted CholeskyQR.

Entries are put on an integer grid, so the mean is known exactly: its whole part is taken
from the integers before anything becomes a double. The centred rows A are orthogonalised
in passes over the table. A pass sends a block of rows through the triangular solves of all
passes before it, and adds up the Gram matrix G of what comes out; the Cholesky factor of G
is the next R. The first G is shifted, so that it has a factor however ill-conditioned A
is; later ones are shifted only where they have none. When G is the identity, the composed
R has the singular values and right singular vectors of A, and a small SVD gives the
components of the covariance and their variances without ever squaring A's condition.

Directions without variance (a constant entry, fewer rows than entries) never become
orthogonal. They shrink with each shifted pass, so they are seen in the composed R; then
the passes are run once more over the range that is left.

Only matrices of the size of a vector squared reach the driver and the tasks (32 KB for 64
entries), whatever the number of rows. Each task adds up its own rows first, and Spark adds
those sums by entry.

Defined results: rows whose vector is NULL, or holds NULL, NaN or an infinite entry, are
dropped, and so are vectors that have not the most frequent length (of equally frequent
ones the longest), as no covariance holds them. Grid values that do not fit into 53 bits
are cut to them. NULL ids and repeated rows are rows like any other. A component without
variance has NULL as its whitened value and 0 as its share; it has no part in the error.
A deviation beyond a long is NULL. A table without vectors gives an empty result. Equal
variances may take any axes of their common space. Other columns are left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column

GRID = 64
OFFSET = 1_000_000
COMPONENTS = 32
PASSES = 8
ORTHOGONAL = 1e-13  # how far a Gram matrix may be from the identity, per row of it
NO_VARIANCE = 1e-13  # a singular value below this share of the largest one is 0
_ROWS = 4096
_MOST = 1 << 53
_EPS = np.finfo(float).eps

Rows = tuple[np.ndarray, np.ndarray]


@dataclass(frozen=True)
class Centre:
    """n rows whose entries sum to `total`; the mean is whole + part, exactly total / n."""

    n: int
    total: tuple[int, ...]

    @property
    def whole(self) -> np.ndarray:
        return np.array([s // self.n for s in self.total], np.int64)

    @property
    def rest(self) -> list[int]:
        return [s - (s // self.n) * self.n for s in self.total]

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(float) - np.array([r / self.n for r in self.rest])

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over entries of (n * x - total)^2, exactly."""
        near, rest = x - self.whole, self.rest
        largest = self.n * (int(np.abs(near).max(initial=0)) + 1)
        if largest * largest * max(len(rest), 1) < 1 << 63:
            return ((self.n * near - np.array(rest, np.int64)) ** 2).sum(axis=1).tolist()
        exact = [sum((self.n * int(v) - r) ** 2 for v, r in zip(row, rest)) for row in near]
        return [e if e < 1 << 63 else None for e in exact]


@dataclass(frozen=True)
class Whitening:
    """Fitted components, in columns, with their variances; `scales` are 0 without variance."""

    centre: Centre
    axes: np.ndarray
    variances: np.ndarray
    trace: float
    passes: int

    @property
    def usable(self) -> np.ndarray:
        return self.variances > 0

    def whitened(self, x: np.ndarray) -> np.ndarray:
        scale = np.where(self.usable, np.sqrt(np.where(self.usable, self.variances, 1.0)), np.inf)
        return (self.centre.centred(x) @ self.axes) / scale


def solved(rows: np.ndarray, r: np.ndarray) -> np.ndarray:
    """The Y with Y r = rows, r upper triangular, by substitution in blocks of columns."""
    y = np.array(rows, float)
    size, width = len(r), 32
    for low in range(0, size, width):
        high = min(low + width, size)
        y[:, low:high] -= y[:, :low] @ r[:low, low:high]
        for j in range(low, high):
            y[:, j] -= y[:, low:j] @ r[low:j, j]
            y[:, j] /= r[j, j]
    return y


def gridded(embeddings: DataFrame, vector_column: str, id_column: str, grid: int, offset: int) -> DataFrame:
    """vec_id, x: the usable rows; x holds doubles that are whole numbers."""
    c = F.transform(column(vector_column), lambda e: e.cast("double"))
    finite = F.forall("c", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf")))
    limited = F.transform("c", lambda e: F.greatest(F.least(F.floor(e * grid).cast("double") + offset, F.lit(float(_MOST))), F.lit(-float(_MOST))))
    rows = embeddings.select(column(id_column).alias("vec_id"), c.alias("c"))
    return rows.where(F.col("c").isNotNull() & finite).select("vec_id", limited.alias("x"))


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Ids and integer entries of the rows, some thousand at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            part = batch.slice(at, _ROWS)
            values = part.column(1).flatten().to_numpy(zero_copy_only=False)
            yield part.column(0), values.astype(np.int64).reshape(part.num_rows, size)


def _most_frequent_length(rows: DataFrame) -> int | None:
    first = rows.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    return first["size"] if first else None


def centre(rows: DataFrame, size: int) -> Centre:
    """Number of rows and exact sums of the entries: one row per task and entry is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(size, object)
        for _, x in _blocks(batches, size):
            n += len(x)
            whole = np.abs(x).max(initial=0) * len(x) >= 1 << 62
            total = total + (x.astype(object).sum(axis=0) if whole else x.sum(axis=0).astype(object))
        if n:
            entries = [("%d" % t) for t in total]
            yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array(entries), pa.array([n] * size, pa.int64())], ["at", "total", "n"])

    sums = rows.mapInArrow(run, "at int, total string, n long").groupBy("at")
    found = sums.agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")).orderBy("at").collect()
    return Centre(found[0]["n"] if found else 0, tuple(int(r["total"]) for r in found))


def gram(rows: DataFrame, size: int, made: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """Sum over rows of y^T y, where y = made(x) has `width` entries; each task sends one matrix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g, n = np.zeros((width, width)), 0
        for _, x in _blocks(batches, size):
            y = made(x)
            g += y.T @ y
            n += len(x)
        if n:
            i, j = np.triu_indices(width)
            yield pa.RecordBatch.from_arrays([pa.array((i * width + j).astype(np.int64)), pa.array(g[i, j])], ["at", "g"])

    found = rows.mapInArrow(run, "at long, g double").groupBy("at").agg(F.sum("g").alias("g")).collect()
    out = np.zeros((width, width))
    for at, g in found:
        out[at // width, at % width] = out[at % width, at // width] = g
    return out


def _factor(g: np.ndarray, n: int, shift: bool) -> tuple[np.ndarray, bool]:
    """Upper triangular R with R^T R = g, shifted where asked or where g has no factor."""
    if not shift:
        try:
            r = np.linalg.cholesky(g).T
            if np.diag(r).min() > 1e-3 * np.sqrt(np.diag(g).max()):
                return r, False
        except np.linalg.LinAlgError:
            pass
    size = len(g)
    more = 11 * (n * size + size * (size + 1)) * _EPS * max(np.linalg.norm(g, 2), np.finfo(float).tiny)
    while True:
        try:
            return np.linalg.cholesky(g + more * np.eye(size)).T, True
        except np.linalg.LinAlgError:
            more *= 10


def _orthogonalised(rows: DataFrame, size: int, c: Centre, basis: np.ndarray | None) -> tuple[np.ndarray, bool, int]:
    """R of the centred rows (times `basis`), whether a shift was needed to the end, and the passes."""
    factors: list[np.ndarray] = []
    width = size if basis is None else basis.shape[1]
    composed, shifted = np.eye(width), False
    for number in range(PASSES):

        def made(x: np.ndarray) -> np.ndarray:
            y = c.centred(x) if basis is None else c.centred(x) @ basis
            for r in factors:
                y = solved(y, r)
            return y

        g = gram(rows, size, made, width)
        if number and np.abs(g - np.eye(width)).max() <= ORTHOGONAL * width:
            return composed, False, number + 1
        r, shifted = _factor(g, c.n, shift=number == 0 and basis is None)
        if not np.isfinite(r).all() or not np.diag(r).all():
            break
        factors.append(r)
        composed = r @ composed
        if shifted and number >= 3:  # some direction has no variance: it would stay so for ever
            break
    return composed, shifted, len(factors)


def fit(rows: DataFrame, size: int, components: int = COMPONENTS) -> Whitening | None:
    """Components of all rows; a pass over the table for each step of the method."""
    c = centre(rows, size)
    if not c.n or not size:
        return None
    r, shifted, passes = _orthogonalised(rows, size, c, None)
    _, values, axes = np.linalg.svd(r)
    kept = values > NO_VARIANCE * np.sqrt(c.n) * max(values[0], 0) if shifted else values > 0
    if np.abs(r).max(initial=0) <= 1e-9 * np.sqrt(c.n) and shifted:
        kept = np.zeros(size, bool)  # grid steps are 1: below this, all rows are equal
    if shifted and kept.any():
        basis = axes[kept].T / values[kept]
        inner, _, more = _orthogonalised(rows, size, c, basis)
        passes += more
        _, found, turned = np.linalg.svd(inner @ np.diag(values[kept]) @ axes[kept], full_matrices=False)
        # the axes without variance fill up the space
        values, axes = np.concatenate([found, np.zeros(size - len(found))]), np.concatenate([turned, axes[~kept]])
    values = np.where(np.arange(size) < kept.sum(), values, 0.0)
    variances = values**2 / c.n
    return Whitening(c, axes[:components].T, variances[:components], float(variances.sum()), passes)


def identity_error(rows: DataFrame, size: int, fitted: Whitening) -> float:
    """Largest absolute entry of the covariance of the whitened rows minus the identity."""
    usable = fitted.usable
    if not usable.any():
        return 0.0

    def made(x: np.ndarray) -> np.ndarray:
        return np.concatenate([fitted.whitened(x)[:, usable], np.ones((len(x), 1))], axis=1)

    width = int(usable.sum())
    g = gram(rows, size, made, width + 1) / fitted.centre.n
    mean = g[:width, width]  # rows are centred already: a mean of rounding errors only
    return float(np.abs(g[:width, :width] - np.outer(mean, mean) - np.eye(width)).max())


SCHEMA = "vec_id {}, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitened(
    embeddings: DataFrame,
    vector_column: str = "embedding",
    id_column: str = "vec_id",
    components: int = COMPONENTS,
    grid: int = GRID,
    offset: int = OFFSET,
) -> DataFrame:
    """One row per usable vector and component."""
    spark = embeddings.sparkSession
    rows = gridded(embeddings, vector_column, id_column, grid, offset)
    schema = SCHEMA.format(rows.schema["vec_id"].dataType.simpleString())
    size = _most_frequent_length(rows)
    if not size:
        return spark.createDataFrame([], schema)
    rows = rows.where(F.size("x") == size)
    fitted = fit(rows, size, components)
    error = identity_error(rows, size, fitted)
    shares = fitted.variances / fitted.trace if fitted.trace else np.zeros(len(fitted.variances))
    width = len(shares)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in _blocks(batches, size):
            n = len(x)
            each = np.repeat(np.arange(n), width)
            values = fitted.whitened(x).ravel()
            deviations = pa.array(fitted.centre.deviations(x), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), n)),
                    pa.array(np.full(n * width, fitted.centre.n, np.int64)),
                    deviations.take(pa.array(each)),
                    pa.array(values, mask=np.tile(~fitted.usable, n)),
                    pa.array(np.tile(shares, n)),
                    pa.array(np.full(n * width, error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(run, schema)
