"""Whitening of embeddings on their leading principal components.

The fit list is every distinct vector once. Tasks add up sums, then centred products, and
only one row of a partial matrix at a time leaves a task; the driver sees one matrix of
dimensions by dimensions. Its leading eigenpairs are found there: Householder reflections
make it tridiagonal, Sturm counts and bisection place the wanted eigenvalues, inverse
iteration gives their vectors, and vectors of close eigenvalues are made orthogonal. The
projection is broadcast.
"""

from __future__ import annotations

import dataclasses

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.tables import Scratch

# Vectors multiplied at once.
ROWS = 4096
EPS = np.finfo(np.float64).eps


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(diagonal, off-diagonal, reflections) of a symmetric matrix; reflection k acts on places k+1 and up."""
    a, n, mirrors = matrix.astype(np.float64).copy(), len(matrix), []
    for k in range(n - 2):
        x = a[k + 1:, k]
        mirror, size = x.copy(), np.linalg.norm(x)
        if np.linalg.norm(x[1:]) > 0:
            mirror[0] += np.copysign(size, x[0])
            mirror /= np.linalg.norm(mirror)
            rest = a[k + 1:, k + 1:]
            p = rest @ mirror
            q = 2 * (p - (mirror @ p) * mirror)
            rest -= np.outer(mirror, q) + np.outer(q, mirror)
            a[k + 1, k] = a[k, k + 1] = -np.copysign(size, x[0])
            a[k + 2:, k] = a[k, k + 2:] = 0
        else:
            mirror = np.zeros_like(x)
        mirrors.append(mirror)
    return np.diag(a).copy(), np.diag(a, 1).copy(), mirrors


def below(diagonal: np.ndarray, squares: np.ndarray, at: np.ndarray, tiny: float) -> np.ndarray:
    """Sturm counts: how many eigenvalues lie below each value of ``at``."""
    pivot = diagonal[0] - at
    count = (pivot < 0).astype(np.int64)
    for d, s in zip(diagonal[1:], squares):
        pivot = d - at - s / np.where(np.abs(pivot) < tiny, -tiny, pivot)
        count += pivot < 0
    return count


def leading_values(diagonal: np.ndarray, off: np.ndarray, most: int) -> np.ndarray:
    """The largest ``most`` eigenvalues, falling, bisected to the last bit."""
    n = diagonal.size
    around = np.abs(np.concatenate([[0], off])) + np.abs(np.concatenate([off, [0]]))
    reach = max(np.abs(diagonal).max() + around.max(), np.finfo(np.float64).tiny)
    tiny = max(np.finfo(np.float64).tiny, (EPS * reach) ** 2 * EPS)
    rank = n - np.arange(min(most, n))  # the eigenvalue with so many at or below it
    low, high = np.full(rank.size, -reach * (1 + 4 * EPS)), np.full(rank.size, reach * (1 + 4 * EPS))
    for _ in range(200):
        mid = (low + high) / 2
        if ((mid == low) | (mid == high)).all():
            break
        under = below(diagonal, off * off, mid, tiny) >= rank
        high, low = np.where(under, mid, high), np.where(under, low, mid)
    return (low + high) / 2


def _solver(diagonal: np.ndarray, off: np.ndarray, shift: float, floor: float):
    """Gaussian elimination with row exchange of the shifted tridiagonal matrix, as a function of the right side."""
    n = diagonal.size
    d, u, w, steps = diagonal - shift, np.append(off, 0.0), np.zeros(n), []
    for k in range(n - 1):
        low, nd, nu = off[k], d[k + 1], u[k + 1]
        swap = abs(low) > abs(d[k])
        if swap:
            top = (low, nd, nu)
            nd, nu, low = u[k], w[k], d[k]
            d[k], u[k], w[k] = top
        d[k] = d[k] if abs(d[k]) > floor else floor
        factor = low / d[k]
        d[k + 1], u[k + 1] = nd - factor * u[k], nu - factor * w[k]
        steps.append((swap, factor))
    d[n - 1] = d[n - 1] if abs(d[n - 1]) > floor else floor

    def solve(right: np.ndarray) -> np.ndarray:
        b = right.copy()
        for k, (swap, factor) in enumerate(steps):
            if swap:
                b[k], b[k + 1] = b[k + 1], b[k]
            b[k + 1] -= factor * b[k]
        for k in range(n - 1, -1, -1):
            b[k] = (b[k] - (u[k] * b[k + 1] if k + 1 < n else 0.0) - (w[k] * b[k + 2] if k + 2 < n else 0.0)) / d[k]
        return b

    return solve


def leading_vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (columns) of the tridiagonal matrix by inverse iteration.

    Values nearer than a thousandth of the norm form a cluster, whose vectors are kept
    orthogonal in every step; equal values are told apart by their start.
    """
    n, scale = diagonal.size, max(np.abs(diagonal).max(), np.abs(off).max() if off.size else 0.0, np.finfo(np.float64).tiny)
    random, out, cluster = np.random.default_rng(13), np.zeros((n, values.size)), 0
    for k, value in enumerate(values):
        if k and values[k - 1] - value > 1e-3 * scale:
            cluster = k
        # equal values would give one matrix twice
        solve = _solver(diagonal, off, value - (k - cluster) * 2 * EPS * scale, EPS * scale)
        x, peers = random.standard_normal(n), out[:, cluster:k]
        for _ in range(5):
            for _ in range(2):
                x -= peers @ (peers.T @ x)
            x = solve(x / np.linalg.norm(x))
        for _ in range(2):
            x -= peers @ (peers.T @ x)
        out[:, k] = x / np.linalg.norm(x)
    return out


def leading_pairs(matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as columns) of a symmetric matrix."""
    scale = np.abs(matrix).max() if matrix.size else 0.0
    if not scale:
        k = min(most, len(matrix))
        return np.zeros(k), np.eye(len(matrix))[:, :k]
    diagonal, off, mirrors = tridiagonal(matrix / scale)
    values = leading_values(diagonal, off, most)
    vectors = leading_vectors(diagonal, off, values)
    for k in range(len(mirrors) - 1, -1, -1):
        part = vectors[k + 1:]
        part -= 2 * np.outer(mirrors[k], mirrors[k] @ part)
    for _ in range(2):  # orthonormal to the last bits across clusters too
        vectors, corner = np.linalg.qr(vectors)
        vectors *= np.where(np.diag(corner) < 0, -1, 1)
    return values * scale, vectors


@dataclasses.dataclass(frozen=True)
class Whitening:
    """What a projection needs: rows in the fit list, sums, trace, eigenvalues and vectors."""

    n: int
    sums: tuple[int, ...]
    trace: float
    values: np.ndarray
    vectors: np.ndarray


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column of longs as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _centred(x: np.ndarray, sums: np.ndarray, n: int) -> np.ndarray:
    """x - sums / n with no rounding before the difference: whole and broken parts apart."""
    return (x - sums // n) - (sums % n) / n


def _task_rows(width: int, of_batch):
    """Adds ``of_batch(matrix)`` (a square matrix) up over a task and yields its upper rows."""
    schema = pa.schema([("i", pa.int32()), ("row", pa.list_(pa.float64()))])

    def run(batches):
        total = None
        for batch in batches:
            x = _matrix(batch.column(0), width)
            for k in range(0, len(x), ROWS):
                part = of_batch(x[k:k + ROWS])
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array([r[i:] for i, r in enumerate(total)], pa.list_(pa.float64()))], schema=schema)

    return run, "i int, row array<double>"


def _gather(rows: DataFrame, width: int) -> np.ndarray:
    """The matrix summed over tasks: cells are added up in the shuffle, one matrix reaches the driver."""
    cells = rows.select("i", F.posexplode("row").alias("j", "part")).groupBy("i", "j").agg(F.sum("part").alias("cell")).toArrow()
    out = np.zeros((width, width))
    i, j = cells["i"].to_numpy(), cells["j"].to_numpy()
    out[i, i + j] = cells["cell"].to_numpy()
    return np.triu(out) + np.triu(out, 1).T


def fit(vectors: DataFrame, width: int, components: int) -> tuple[Whitening, float]:
    """Whitening of the fit list (one column of long lists, distinct), and its identity error."""
    spark = vectors.sparkSession

    def add_up(batches):
        for batch in batches:
            x = _matrix(batch.column(0), width)
            for k in range(0, len(x), ROWS):  # so many entries of 2**50 stay within a long
                part = x[k:k + ROWS]
                yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array(part.sum(0)), pa.array(np.full(width, len(part)))], names=["i", "part", "rows"])

    sums = vectors.mapInArrow(add_up, "i int, part long, rows long").groupBy("i").agg(
        F.sum(F.col("part").cast("decimal(38,0)")).alias("total"), F.sum("rows").alias("n")).collect()
    n, total = sums[0].n, [0] * width
    for r in sums:
        total[r.i] = int(r.total)
    held = np.array(total, dtype=object)
    if max(abs(t) for t in total) < 1 << 62:
        held = held.astype(np.int64)
    shared = spark.sparkContext.broadcast((held, n))

    def products(x):
        s, rows = shared.value
        y = _centred(x, s, rows).astype(np.float64)
        return y.T @ y

    run, schema = _task_rows(width, products)
    covariance = _gather(vectors.mapInArrow(run, schema), width) / n
    values, axes = leading_pairs(covariance, components)
    trace = float(np.trace(covariance))
    real = values > max(trace, 0.0) * width * EPS * 4  # beyond rounding; a lesser spread has no direction
    found = Whitening(n, tuple(total), trace, values[real], axes[:, real])
    k = found.values.size
    if not k:
        return found, 0.0
    base = found.vectors / np.sqrt(found.values)
    projected = spark.sparkContext.broadcast(base)

    # the mean of whitened vectors is zero but for rounding: it is carried along as one more column
    def spread(x):
        s, rows = shared.value
        w = _centred(x, s, rows).astype(np.float64) @ projected.value
        w = np.column_stack([w, np.ones(len(w))])
        return w.T @ w

    run, schema = _task_rows(width, spread)
    moments = _gather(vectors.mapInArrow(run, schema), k + 1)
    mean = moments[:k, k] / n
    return found, float(np.abs(moments[:k, :k] / n - np.outer(mean, mean) - np.eye(k)).max())


def _projection(kept: list[str], fitted: Whitening, error: float, width: int):
    k = fitted.values.size
    base, explained = fitted.vectors / np.sqrt(np.where(fitted.values > 0, fitted.values, 1)), fitted.values / (fitted.trace or 1)
    n, sums = fitted.n, np.array(fitted.sums, dtype=object)
    small = max(map(abs, fitted.sums)) < 1 << 62
    sums = sums.astype(np.int64) if small else sums

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                x = _matrix(part.column("x"), width)
                y = _centred(x, sums, n).astype(np.float64)
                white = y @ base
                rough = float(n) * n * (y * y).sum(1)
                if small and n * (np.abs(x).max(initial=0) + 1) < 1 << 62 and rough.max(initial=0) < 4e18:
                    exact = n * x - sums
                    deviation = pa.array((exact * exact).sum(1))
                else:  # whole numbers of any size; beyond a long there is no value
                    whole = ((n * x.astype(object) - np.array(fitted.sums, dtype=object)) ** 2).sum(1)
                    deviation = pa.array([v if v < 1 << 63 else None for v in whole], pa.int64())
                each = pa.array(np.repeat(np.arange(part.num_rows), k))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c).take(each) for c in kept), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), part.num_rows)),
                     pa.array(np.full(len(each), n)), deviation.take(each), pa.array(white.ravel()),
                     pa.array(np.tile(explained, part.num_rows)), pa.array(np.full(len(each), error))],
                    names=[*kept, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return run


def whiten(frame: DataFrame, ident: str = "vec_id", vector: str = "embedding", components: int = 16,
           scale: int = 64, offset: int = 1_000_000) -> DataFrame:
    """(ident, component, n, deviation, whitened, explained, identity_error): a row for each
    usable vector and component.

    Vectors that are NULL, hold NULL or a non-finite entry are dropped; so are vectors of
    another length than the longest usable one, which no covariance can hold. Entries become
    ``floor(scale * c) + offset``; beyond 2**50 either way the first part stops there. Repeated vectors count once
    in the fit and each has its rows in the result; ids may be NULL or repeated. A
    component exists only where the variance is beyond rounding, so equal vectors alone, or
    an empty table, give no rows. ``deviation`` is NULL where it does not fit a long.
    Equal eigenvalues share a space in which any orthonormal directions may come back.
    Other columns are not read.
    """
    scratch = Scratch(frame.sparkSession)
    entries = F.col(f"`{vector}`").cast("array<double>")
    finite = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    limit = float(1 << 50)
    whole = F.transform(entries, lambda c: F.floor(F.greatest(F.least(c * scale, F.lit(limit)), F.lit(-limit))).cast("long") + offset)
    usable = frame.where(entries.isNotNull() & finite).select(F.col(f"`{ident}`").alias("ident"), whole.alias("x"))
    usable = scratch.keep(usable, "vectors")
    kind = usable.schema["ident"].dataType.simpleString()
    out = f"ident {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    width = usable.agg(F.max(F.size("x"))).first()[0] or 0
    if not width:
        empty = usable.where("false").select("ident", *[F.lit(None).cast(t).alias(c) for c, t in (x.split() for x in out.split(", ")[1:])])
        return empty.withColumnRenamed("ident", ident)
    usable = usable.where(F.size("x") == width)
    distinct = scratch.keep(usable.select("x").distinct(), "distinct-vectors")
    fitted, error = fit(distinct, width, components)
    scratch.drop(distinct)
    return usable.mapInArrow(_projection(["ident"], fitted, error, width), out).withColumnRenamed("ident", ident)
