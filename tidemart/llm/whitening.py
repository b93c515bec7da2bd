"""Whitening of vectors by spectral divide-and-conquer with QDWH polar decompositions.

Entries become integers ``floor(1024 c) + 100000``; sums and deviations are exact. Three passes
over the vectors each leave sums per task, which Spark adds up: counts and sums per
dimension, the covariance of the centred vectors, the covariance of the whitened ones.
Only such sums, never vectors, reach the driver; their size is that of the dimension.

There the covariance is divided: the polar factor of the shifted matrix V - sI, found by
the QR-based dynamically weighted Halley iteration, has eigenvalues 1 and -1 above and
below the shift, so (I + U) / 2 projects on one invariant subspace. Bases of it and of its
complement split V into two smaller matrices, which are divided in turn until each is a
component; subspaces below those asked for are left whole. The components are broadcast
and each vector is projected where it lies.

Defined cases: vectors that are null or hold null, NaN or infinite entries are dropped, as
are those with an entry beyond ``LARGEST`` (their integers would not be exact) and those of another
length than most (of equally frequent lengths the longest stays). Repeated vectors and ids
count as often as they occur; a null id stays null. A component whose eigenvalue is zero to
double precision cannot be whitened: ``whitened`` is null, ``explained`` zero, and the identity error is
taken over the others (null if there is none). A deviation beyond a long is null. An empty table, or one without a
fit vector, gives no rows. Other columns of the input do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, SHIFT = 1024, 100_000  # fixed values: how an entry becomes an integer
COMPONENTS = 8
#: Largest magnitude of an entry; its integer has at most 40 bits.
LARGEST = float(1 << 30)
#: Rows after which a task passes its integer sums on, so that they stay within 64 bits.
SUM_ROWS = 1 << 22
#: Tasks whose matrices one step adds up.
FAN_IN = 256
_EPS = float(np.finfo(float).eps)


# -- divide and conquer -----------------------------------------------------------------

def polar_factor(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix, by QDWH."""
    m = len(a)
    x = a / np.linalg.norm(a)
    try:
        low = min(1.0, max(1 / np.linalg.norm(np.linalg.inv(x)), _EPS))
    except np.linalg.LinAlgError:
        low = _EPS
    eye = np.eye(m)
    for _ in range(30):
        d = (4 * (1 - low**2) / low**4) ** (1 / 3)
        root = np.sqrt(1 + d)
        h = root + 0.5 * np.sqrt(max(8 - 4 * d + 8 * (2 - low**2) / (low**2 * root), 0))
        b = (h - 1) ** 2 / 4
        c = h + b - 1
        if c > 100:
            q, _ = np.linalg.qr(np.vstack([np.sqrt(c) * x, eye]))
            new = b / c * x + (h - b / c) / np.sqrt(c) * (q[:m] @ q[m:].T)
        else:
            new = b / c * x + (h - b / c) * np.linalg.solve(eye + c * (x.T @ x), x.T).T
        new = (new + new.T) / 2
        low = min(1.0, low * (h + b * low**2) / (1 + c * low**2))
        change = np.linalg.norm(new - x)
        x = new
        if abs(1 - low) < 10 * _EPS and change < (10 * _EPS) ** (1 / 3) * np.sqrt(m):
            break
    return x


def _split(a: np.ndarray, shift: float, scale: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the invariant subspaces above and below a shift, if it parts them cleanly."""
    m = len(a)
    shifted = a - shift * np.eye(m)
    if not np.linalg.norm(shifted) > 0:
        return None
    sign = polar_factor(shifted)
    if np.linalg.norm(sign @ sign - np.eye(m)) > 1e-10 * m:
        return None  # an eigenvalue lies at the shift
    above = round((np.trace(sign) + m) / 2)
    if not 0 < above < m:
        return None
    projector = (sign + np.eye(m)) / 2
    basis = np.random.default_rng(m).standard_normal((m, above))
    for _ in range(2):
        basis, _ = np.linalg.qr(projector @ basis)
    whole, _ = np.linalg.qr(basis, mode="complete")
    upper, lower = whole[:, :above], whole[:, above:]
    if np.linalg.norm(lower.T @ a @ upper) > 100 * m * _EPS * scale:
        return None
    return upper, lower


def eigenpairs(v: np.ndarray, wanted: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues in falling order and unit eigenvectors of a symmetric matrix, at least the ``wanted`` first."""
    size = len(v)
    scale = float(np.linalg.norm(v)) or 1.0
    values: list[float] = []
    vectors: list[np.ndarray] = []

    # Subspaces in falling order: all of one lie above all of the next.
    waiting = [np.eye(size)]
    while waiting and (wanted is None or len(values) < wanted):
        basis = waiting.pop(0)
        a = basis.T @ v @ basis
        a = (a + a.T) / 2
        m = len(a)
        mean = float(np.trace(a)) / m
        spread = float(np.sqrt(max(np.linalg.norm(a - mean * np.eye(m)) ** 2 / m, 0)))
        parts = None
        if m > 1 and spread > m * _EPS * scale:
            for step in (0.0, 0.3, -0.3, 0.15, -0.15, 0.6, -0.6, 0.05, -0.05):
                parts = _split(a, mean + step * spread, scale)
                if parts is not None:
                    break
        if parts is not None:
            waiting[:0] = [basis @ parts[0], basis @ parts[1]]
            continue
        # One component, or several whose eigenvalues are equal to double precision.
        order = np.argsort(-np.diag(a), kind="stable")
        for k in order.tolist():
            values.append(float(a[k, k]))
            vectors.append(basis[:, k])
    return np.array(values), np.array(vectors).T.reshape(size, -1)


# -- passes over the vectors ------------------------------------------------------------

def integers(column: pa.Array, dim: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places of the vectors to fit, their lengths, their integers in a row); of one length if given."""
    length = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.cast(column.flatten(), pa.float64()).to_numpy(zero_copy_only=False)  # a null is NaN
    sizes = np.maximum(length, 0)
    row = np.repeat(np.arange(len(length)), sizes)
    bad = ~(np.abs(flat) <= LARGEST)
    fit = (length > 0) & (np.bincount(row[bad], minlength=len(length)) == 0)
    if dim is not None:
        fit &= length == dim
    kept = flat[fit[row]]
    return np.flatnonzero(fit), length[fit], np.floor(SCALE * kept).astype(np.int64) + SHIFT


class Moments(NamedTuple):
    n: int
    sums: list[int]
    largest: int

    @property
    def dim(self) -> int:
        return len(self.sums)

    def centred(self, x: np.ndarray) -> tuple[np.ndarray, list[int | None]]:
        """(x - S / n as doubles, sum of (n x - S)^2 per row), without a step that could overflow."""
        if self.n * self.largest < 1 << 62:
            scaled = x * self.n - np.array(self.sums, np.int64)
            if np.square(scaled.astype(float)).sum(axis=1).max(initial=0) < 2.0**62:
                return scaled / self.n, np.square(scaled).sum(axis=1).tolist()
            scaled = scaled.astype(object)
        else:
            scaled = x.astype(object) * self.n - np.array(self.sums, object)
        exact = (scaled**2).sum(axis=1)
        return (scaled / self.n).astype(float), [int(e) if e < 1 << 63 else None for e in exact]


def moments(vectors: DataFrame, column: str) -> Moments | None:
    """Number and exact sums of the vectors to fit; None without any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}  # length: rows, sums, largest
        rows = 0
        for batch in batches:
            _, length, flat = integers(batch.column(0))
            begin = np.cumsum(length) - length
            for dim in np.unique(length).tolist():
                first = begin[length == dim]
                x = flat[first[:, None] + np.arange(dim)]
                entry = held.setdefault(dim, [0, np.zeros(dim, np.int64), 0])
                entry[0] += len(x)
                entry[1] = entry[1] + x.sum(axis=0)
                entry[2] = max(entry[2], int(np.abs(x).max()))
            rows += len(length)
            if rows >= SUM_ROWS:
                yield _moment_rows(held)
                held, rows = {}, 0
        yield _moment_rows(held)

    parts = vectors.select(column).mapInArrow(run, "dim int, n long, largest long, sums array<long>")
    per_dim = parts.groupBy("dim").agg(F.sum("n").alias("n"), F.max("largest").alias("largest"))
    chosen = per_dim.orderBy(F.desc("n"), F.desc("dim")).limit(1).first()
    if chosen is None:
        return None
    entries = parts.filter(F.col("dim") == chosen["dim"]).select(F.posexplode("sums").alias("at", "x"))
    sums = entries.groupBy("at").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("s")).collect()  # a row per dimension
    return Moments(chosen["n"], [int(r["s"]) for r in sorted(sums, key=lambda r: r["at"])], chosen["largest"])


def _moment_rows(held: dict[int, list]) -> pa.RecordBatch:
    rows = [(dim, n, largest, sums.tolist()) for dim, (n, sums, largest) in held.items()]
    columns = list(zip(*rows, strict=True)) or [[]] * 4
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["dim", "n", "largest", "sums"])


def second_moments(vectors: DataFrame, column: str, of: Moments, project: np.ndarray | None = None) -> np.ndarray:
    """Sum over the vectors of y y', with y the centred vector, projected if so asked, and a 1 behind it.

    The last row and column thus hold the sums of y and the number of vectors.
    """
    width = (of.dim if project is None else project.shape[1]) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            place, _, flat = integers(batch.column(0), of.dim)
            y, _ = of.centred(flat.reshape(len(place), of.dim))
            y = np.hstack([y if project is None else y @ project, np.ones((len(place), 1))])
            total += y.T @ y
        slot = TaskContext.get().partitionId() // FAN_IN
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(width, slot), pa.int32()), pa.array(np.arange(width), pa.int32()),
             pa.array(list(total), pa.list_(pa.float64()))], names=["slot", "at", "total"])

    def added(group: pa.Table) -> pa.Table:
        rows = np.array(group["total"].to_pylist())
        return pa.table({
            "slot": pa.array([0], pa.int32()), "at": group["at"].slice(0, 1).combine_chunks(),
            "total": pa.array([rows.sum(axis=0)], pa.list_(pa.float64()))})

    schema = "slot int, at int, total array<double>"
    parts = vectors.select(column).mapInArrow(run, schema)
    once = parts.groupBy("slot", "at").applyInArrow(added, schema)
    rows = once.groupBy("at").applyInArrow(added, schema).collect()  # a row per dimension
    out = np.zeros((width, width))
    for row in rows:
        out[row["at"]] = row["total"]
    return out


def covariance(total: np.ndarray) -> np.ndarray:
    """Covariance, with divisor n, from sums as ``second_moments`` gives them."""
    n = total[-1, -1]
    mean = total[:-1, -1] / n
    out = total[:-1, :-1] / n - np.outer(mean, mean)
    return (out + out.T) / 2


def whiten(
    vectors: DataFrame, column: str = "embedding", key: str = "vec_id", components: int = COMPONENTS
) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error) per vector and component."""
    schema = f"`{key}` long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    found = moments(vectors, column)
    if found is None:
        return vectors.sparkSession.createDataFrame([], schema)
    v = covariance(second_moments(vectors, column, found))
    values, axes = eigenpairs(v, components)
    count = min(components, found.dim)
    values, axes = values[:count], axes[:, :count]
    trace = float(np.trace(v))
    good = values > found.dim * _EPS * max(trace, 0)
    project = axes[:, good] / np.sqrt(values[good])
    error = None
    if good.any():
        identity = covariance(second_moments(vectors, column, found, project))
        error = float(np.abs(identity - np.eye(len(identity))).max())
    explained = np.where(good, values / trace if trace > 0 else 0.0, 0.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place, _, flat = integers(batch.column(1), found.dim)
            y, deviation = found.centred(flat.reshape(len(place), found.dim))
            whitened = np.full((len(place), count), np.nan)
            whitened[:, good] = y @ project
            size = len(place) * count
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(np.repeat(place, count))),
                pa.array(np.tile(np.arange(1, count + 1), len(place)), pa.int32()),
                pa.array(np.full(size, found.n), pa.int64()),
                pa.array(deviation, pa.int64()).take(pa.array(np.repeat(np.arange(len(place)), count))),
                pa.array(whitened.ravel(), pa.float64(), from_pandas=True),
                pa.array(np.tile(explained, len(place)), pa.float64()),
                pa.array([error] * size, pa.float64()),
            ], names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return vectors.select(F.col(key).cast("long").alias(key), column).mapInArrow(run, schema)
