"""Whitening by eigenvectors from contour integration (FEAST).

1. Vectors are taken in whole steps (``floor(scale * x)``); equal ones count once
   in the fit.  Tasks sum the fit list's vectors exactly (whole numbers), then the
   products of the centred vectors: dims x dims numbers a task, added up by Spark.
2. The leading eigenvectors of that covariance come from FEAST.  Inertia counts
   (signs of the pivots of a symmetric factorisation) find an interval that holds
   the wanted eigenvalues.  Quadrature over a circle around it, one solve with a
   complex shifted covariance per node, projects a block of vectors onto the
   interval's eigenvectors; Rayleigh-Ritz takes the components from the projection.
   It is repeated until the residuals are at rounding, and the count of Ritz values
   in the interval must equal the inertia count, so that none is missed.
3. All rows are projected by the components; another pass over the fit list
   measures how far the whitened covariance is from the identity.

To the driver go sums of dims and dims x dims numbers, whatever the rows.

Defined cases: a row whose vector is NULL, empty or has a component that is NULL
or not finite is dropped; a NULL vec_id is kept; repeated rows are whitened each
and count once in the fit; vectors of different lengths are whitened by length,
each length by its own fit; components without variance (eigenvalues at rounding)
are left out, so one distinct vector gives no rows; equal eigenvalues leave the
choice of their eigenvectors open; ``deviation`` is exact, NULL beyond a long;
steps beyond +-2^52 are held there; extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecraft.llm.common import materialise

SCALE = 256
COMPONENTS = 4
NODES = 16                 # of the quadrature over half the circle
ROUNDS = 60                # of projection, at most
SPAN = 64.0                # the largest eigenvalue of an interval against its lower end, at most
_STEPS = 2.0 ** 52         # a whole number up to here is a double
_LONG = (1 << 63) - 1
_WHITENED = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


# ---- eigenvectors -----------------------------------------------------------------
def inertia(matrix: np.ndarray) -> tuple[int, int]:
    """How many eigenvalues of a symmetric matrix are above and below zero.

    Symmetric elimination; a pivot is one row or, where that would be small beside
    its column, two, with one eigenvalue of each sign."""
    a, above, below, small = matrix.astype(np.float64).copy(), 0, 0, (1 + np.sqrt(17)) / 8
    while len(a):
        column = np.abs(a[1:, 0])
        r = 1 + int(column.argmax()) if len(column) else 0
        most = column[r - 1] if len(column) else 0.0
        if most == 0 and a[0, 0] == 0:
            a = a[1:, 1:]
            continue
        pivot = [0]
        if abs(a[0, 0]) < small * most:
            other = np.abs(np.delete(a[:, r], r)).max()
            if abs(a[0, 0]) * other < small * most * most:
                pivot = [r] if abs(a[r, r]) >= small * other else [0, r]
        if len(pivot) == 2:
            above, below = above + 1, below + 1
        else:
            above, below = above + (a[pivot[0], pivot[0]] > 0), below + (a[pivot[0], pivot[0]] < 0)
        rest = np.delete(np.arange(len(a)), pivot)
        strip = a[np.ix_(rest, pivot)]
        a = a[np.ix_(rest, rest)] - strip @ np.linalg.solve(a[np.ix_(pivot, pivot)], strip.T)
    return int(above), int(below)


def count_above(matrix: np.ndarray, value: float) -> int:
    return inertia(matrix - value * np.eye(len(matrix)))[0]


def _edge(matrix: np.ndarray, inside: float, outside: float, count: int) -> float:
    """About where, on the way from ``inside`` to ``outside``, the count above changes."""
    for _ in range(40):
        middle = (inside + outside) / 2
        inside, outside = (middle, outside) if count_above(matrix, middle) == count else (inside, middle)
    return inside


def interval(matrix: np.ndarray, high: float, above: int, wanted: int, most: int, least: float) -> tuple[float, float, int]:
    """(low, high, count): the next interval below ``high``, which has ``above`` eigenvalues above it.

    It holds ``wanted`` to about ``most`` eigenvalues, or fewer where the next are
    smaller by orders, or more where a cluster holds more.  Its lower end is amid a
    gap and its upper end close to its largest eigenvalue, so that the quadrature
    tells what is inside from what is not."""
    top = _edge(matrix, high, least, above)
    low = max(least, top / SPAN)
    count, lid = count_above(matrix, low), top
    while count - above > most and lid - low > 1e-9 * top:
        middle = (low + lid) / 2
        n = count_above(matrix, middle)
        if n - above >= wanted:
            low, count = middle, n
        else:
            lid = middle
    low = (_edge(matrix, low, least, count) + _edge(matrix, low, high, count)) / 2
    return low, min(top + max((top - low) / 4, 1e-12 * top), (top + high) / 2), count - above


def project(matrix: np.ndarray, block: np.ndarray, low: float, high: float, nodes: int) -> np.ndarray:
    """The block projected onto the eigenvectors of the interval: Gauss-Legendre quadrature over the upper half circle."""
    at, weights = np.polynomial.legendre.leggauss(nodes)
    centre, radius, out = (low + high) / 2, (high - low) / 2, np.zeros_like(block)
    for x, w in zip(at, weights, strict=True):
        turn = radius * np.exp(0.5j * np.pi * (1 - x))
        out += (w / 2) * np.real(turn * np.linalg.solve((centre + turn) * np.eye(len(matrix)) - matrix, block.astype(complex)))
    return out


def eigenvectors_within(matrix: np.ndarray, low: float, high: float, count: int, nodes: int) -> np.ndarray:
    """The eigenvectors of the ``count`` eigenvalues between, as columns by falling eigenvalue."""
    dims, before = len(matrix), np.inf
    block = np.random.default_rng(1).standard_normal((dims, min(dims, 2 * count + 8)))
    for _ in range(ROUNDS):
        basis, _ = np.linalg.qr(project(matrix, block, low, high, nodes))
        reduced = basis.T @ matrix @ basis
        values, turned = np.linalg.eigh((reduced + reduced.T) / 2)      # Rayleigh-Ritz
        block = basis @ turned
        inside = np.flatnonzero((values > low) & (values < high))[::-1]
        residual = np.abs(matrix @ block[:, inside] - block[:, inside] * values[inside]).max(initial=0)
        # at rounding, residuals no longer fall
        if len(inside) == count and residual < 1e-12 and residual > 0.9 * before:
            break
        before = residual
    if len(inside) != count:
        raise ArithmeticError(f"{len(inside)} eigenvalues found in an interval with {count}")
    return block[:, inside]


def leading_eigenpairs(matrix: np.ndarray, wanted: int, nodes: int = NODES) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues by falling size, unit eigenvectors as columns): the ``wanted`` largest above rounding of a covariance."""
    dims, scale = len(matrix), float(np.trace(matrix)) or 1.0
    matrix, least = matrix / scale, dims * 1e-15
    wanted = min(wanted, count_above(matrix, least))
    low = float(np.abs(matrix).sum(axis=1).max()) * 1.01      # no eigenvalue is above the largest row sum
    found = np.zeros((dims, 0))
    while found.shape[1] < wanted:
        left = wanted - found.shape[1]
        low, high, count = interval(matrix, low, found.shape[1], left, left + 4, least)
        found = np.hstack([found, eigenvectors_within(matrix, low, high, count, nodes)])
    if count_above(matrix, low) != found.shape[1]:
        raise ArithmeticError("an eigenvalue was missed")
    # the intervals' vectors together, turned to the eigenvectors of what they span
    basis, _ = np.linalg.qr(found)
    reduced = basis.T @ matrix @ basis
    values, turned = np.linalg.eigh((reduced + reduced.T) / 2)
    vectors = (basis @ turned)[:, ::-1][:, :wanted]
    return values[::-1][:wanted] * scale, vectors / np.sqrt((vectors * vectors).sum(axis=0))


# ---- fit --------------------------------------------------------------------------
@dataclass(frozen=True)
class Whitening:
    """A fit: whole-number sums of n distinct vectors, leading eigenpairs of their covariance, its trace."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - sums / n; the whole number n * x - sums is exact before it is divided."""
        return _apart(x, self.n, self.sums).astype(np.float64) / self.n

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors / np.sqrt(self.values)


def _apart(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - sums, as longs where they hold it, else as whole numbers of any size."""
    most = int(np.abs(x).max(initial=0)) * n + max(map(abs, sums), default=0)
    if most < _LONG:
        return x * n - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def _squares(apart: np.ndarray) -> list[int | None]:
    most = int(np.abs(apart).max(initial=0))
    if apart.dtype == object or apart.shape[1] * most * most > _LONG:
        found = [sum(int(v) ** 2 for v in row) for row in apart]
        return [s if s <= _LONG else None for s in found]
    return (apart * apart).sum(axis=1).tolist()


def steps(vectors: DataFrame, scale: float = SCALE) -> DataFrame:
    """(vec_id, dims, x): the rows that are not dropped, in whole steps."""
    v = F.col("embedding").cast("array<double>")
    whole = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    x = F.transform(v, lambda c: F.floor(F.greatest(F.least(c * scale, F.lit(_STEPS)), F.lit(-_STEPS))))
    return vectors.where((F.size(v) > 0) & whole).select(F.col("vec_id").cast("long").alias("vec_id"), F.size(v).alias("dims"), x.alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).astype(np.int64).reshape(len(column), -1)


def _summed(rows: DataFrame, sums, dims: int, width: int) -> np.ndarray:
    """What ``sums`` gives for each batch (dims x width doubles), added up."""
    def run(batches):
        total = np.zeros((dims, width))
        for batch in batches:
            total += sums(_matrix(batch.column("x")))
        yield pa.RecordBatch.from_arrays([pa.array(range(dims), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))], ["i", "row"])

    found = (rows.select("x").mapInArrow(run, "i int, row array<double>").select("i", F.posexplode("row").alias("j", "s"))
             .groupBy("i", "j").agg(F.sum("s").alias("s")).toPandas())
    out = np.zeros((dims, width))
    out[found["i"], found["j"]] = found["s"]
    return out


def _totals(rows: DataFrame, dims: int) -> tuple[int, list[int]]:
    """The number of rows and the exact sums of their components."""
    def run(batches):
        n, total = 0, [0] * dims
        for batch in batches:
            x = _matrix(batch.column("x"))
            whole = x if int(np.abs(x).max(initial=0)) * len(x) < _LONG else x.astype(object)
            n, total = n + len(x), [a + int(b) for a, b in zip(total, whole.sum(axis=0), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(range(dims), pa.int32()), pa.array([n] * dims), pa.array(list(map(str, total)))], ["i", "n", "s"])

    found = (rows.select("x").mapInArrow(run, "i int, n long, s string").groupBy("i")
             .agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).orderBy("i").collect())
    return found[0]["n"], [int(r["s"]) for r in found]


def fit(rows: DataFrame, dims: int, components: int = COMPONENTS) -> Whitening:
    """The whitening of rows (x) of one length; every distinct x counts once."""
    distinct = materialise(rows.where(F.col("dims") == dims).select("x").distinct(), "whitening-fit")
    n, sums = _totals(distinct, dims)
    bare = Whitening(n, sums, np.zeros(0), np.zeros((dims, 0)), 0.0, 0.0)

    def products(x):
        u = bare.centred(x)
        return u.T @ u

    covariance = _summed(distinct, products, dims, dims) / n
    covariance = (covariance + covariance.T) / 2
    values, vectors = leading_eigenpairs(covariance, components)
    fitted = Whitening(n, sums, values, vectors, float(np.trace(covariance)), 0.0)
    k, error = len(values), 0.0
    if k:
        def whitened_products(x):
            w = fitted.whiten(x)
            return np.hstack([w.T @ w, w.sum(axis=0)[:, None]])

        found = _summed(distinct, whitened_products, k, k + 1) / n
        error = float(np.abs(found[:, :k] - np.outer(found[:, k], found[:, k]) - np.eye(k)).max())
    return Whitening(n, sums, values, vectors, fitted.trace, error)


def whiten(vectors: DataFrame, components: int = COMPONENTS, scale: float = SCALE) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of rows (vec_id, embedding)."""
    spark = vectors.sparkSession
    rows = steps(vectors, scale)
    found = None
    for (dims,) in sorted(rows.select("dims").distinct().collect()):       # lengths of vectors, one as a rule
        model = fit(rows, dims, components)
        part = _whitened(rows.where(F.col("dims") == dims), model)
        found = part if found is None else found.unionByName(part)
    return spark.createDataFrame([], _WHITENED) if found is None else found


def _whitened(rows: DataFrame, model: Whitening) -> DataFrame:
    k = len(model.values)

    def run(batches):
        for batch in batches:
            x = _matrix(batch.column("x"))
            each = np.repeat(np.arange(len(x)), k)
            deviation = pa.array(_squares(_apart(x, model.n, model.sums)), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                 pa.array(np.full(len(each), model.n)), deviation.take(pa.array(each)), pa.array(model.whiten(x).ravel()),
                 pa.array(np.tile(model.values / (model.trace or 1.0), len(x))), pa.array(np.full(len(each), model.identity_error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select("vec_id", "x").mapInArrow(run, _WHITENED)
