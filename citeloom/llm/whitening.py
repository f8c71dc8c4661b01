"""Whitening of embeddings by their leading principal components.

Entries become integers ``x = floor(SCALE * c) + SHIFT``. Each task centres its own vectors before it
multiplies them, and the centred sums of tasks are joined by the means' differences, so nothing of
the size of the squared offset is ever subtracted. What reaches the driver is one covariance
matrix, whose size follows the vectors' length alone. There it is brought to tridiagonal form by
Householder reflections; leading eigenvalues are bisected by counts of sign changes (Sturm),
eigenvectors come from inverse iteration, orthogonal inside a cluster of near eigenvalues. The
components and the mean are sent to all tasks, which project the vectors.

Cases: a vector that is null, empty, or holds a null or not finite entry is left out, and so is one whose
length is not the most frequent (the larger of equally frequent ones); rows that repeat an id count
as often as they stand; an entry beyond ``LARGEST`` counts as that; a component without variance
has ``whitened`` null and is no part of ``identity_error``; without any variance ``explained`` is null
too; ``deviation`` is null where it does not fit a long; columns beside ``vec_id`` and ``embedding``
are ignored; no vectors give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from citeloom.session import stage

COMPONENTS = 8
SCALE = 1024
SHIFT = 100_000
#: Entries beyond this size, in x, are taken for it; doubles hold all smaller integers.
LARGEST = float(1 << 52)
#: Vectors multiplied at once.
BLOCK = 4096
#: Tasks that join the sums of the others; so many matrices reach the driver.
GROUPS = 8
EPSILON = float(np.finfo(np.float64).eps)


# --- symmetric eigenvalues --------------------------------------------------------------


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, next diagonal and Householder vectors of a symmetric matrix.

    The k-th vector reflects the entries behind place k: H = I - 2 v v'.
    """
    a = np.array(matrix, np.float64)
    n = len(a)
    reflections = []
    for k in range(n - 2):
        x = a[k + 1 :, k].copy()
        size = np.linalg.norm(x)
        v = x.copy()
        v[0] += math.copysign(size, x[0])
        length = np.linalg.norm(v)
        if length > 0:
            v /= length
            rest = a[k + 1 :, k + 1 :]
            p = rest @ v
            w = p - (v @ p) * v
            rest -= 2.0 * (np.outer(v, w) + np.outer(w, v))
            a[k + 1, k] = a[k, k + 1] = -math.copysign(size, x[0])
        reflections.append(v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), reflections


def from_tridiagonal(vector: np.ndarray, reflections: list[np.ndarray]) -> np.ndarray:
    """An eigenvector of the tridiagonal form as one of the matrix."""
    out = vector.copy()
    for k in range(len(reflections) - 1, -1, -1):
        v = reflections[k]
        out[k + 1 :] -= 2.0 * (v @ out[k + 1 :]) * v
    return out


def count_below(diagonal: np.ndarray, beside: np.ndarray, value: float) -> int:
    """Number of eigenvalues below ``value``: negative pivots of the shifted matrix."""
    size = max(float(np.abs(diagonal).max(initial=0.0)), float(np.abs(beside).max(initial=0.0)))
    tiny = max(EPSILON * EPSILON * size, 1e-290)
    below, pivot = 0, 1.0
    squares = [0.0, *(beside * beside).tolist()]
    for d, square in zip(diagonal.tolist(), squares):
        pivot = d - value - square / pivot
        if abs(pivot) < tiny:
            pivot = -tiny
        below += pivot < 0
    return below


def leading_eigenvalues(diagonal: np.ndarray, beside: np.ndarray, count: int) -> list[float]:
    """The largest eigenvalues of a tridiagonal matrix, falling, each bisected to the last bit."""
    n = len(diagonal)
    reach = np.zeros(n)
    reach[:-1] += np.abs(beside)
    reach[1:] += np.abs(beside)
    bottom, top = float((diagonal - reach).min()), float((diagonal + reach).max())
    margin = EPSILON * n * max(abs(bottom), abs(top)) + 1e-300
    found = []
    for k in range(min(count, n)):
        # The (k + 1)-th largest has n - k - 1 eigenvalues below it.
        low, high = bottom - margin, (found[-1] if found else top) + margin
        while True:
            middle = 0.5 * (low + high)
            if middle <= low or middle >= high:
                break
            if count_below(diagonal, beside, middle) <= n - k - 1:
                low = middle
            else:
                high = middle
        found.append(0.5 * (low + high))
    return found


def _solve_shifted(diagonal: np.ndarray, beside: np.ndarray, value: float, right: np.ndarray) -> np.ndarray:
    """(T - value) x = right by elimination with row exchanges; zero pivots become tiny ones."""
    n = len(diagonal)
    size = max(float(np.abs(diagonal).max()), float(np.abs(beside).max(initial=0.0)), 1e-300)
    tiny = EPSILON * size
    d, u, x = (diagonal - value).tolist(), [*beside.tolist(), 0.0], right.tolist()
    second = [0.0] * n
    for k in range(n - 1):
        low, next_d, next_u = float(beside[k]), d[k + 1], u[k + 1]
        if abs(low) > abs(d[k]):
            factor = d[k] / low
            d[k], d[k + 1] = low, u[k] - factor * next_d
            u[k], u[k + 1], second[k] = next_d, -factor * next_u, next_u
            x[k], x[k + 1] = x[k + 1], x[k] - factor * x[k + 1]
        else:
            if d[k] == 0.0:
                d[k] = tiny
            factor = low / d[k]
            d[k + 1] = next_d - factor * u[k]
            x[k + 1] -= factor * x[k]
    for k in range(n - 1, -1, -1):
        if abs(d[k]) < tiny:
            d[k] = math.copysign(tiny, d[k])
        above = (u[k] * x[k + 1] if k + 1 < n else 0.0) + (second[k] * x[k + 2] if k + 2 < n else 0.0)
        x[k] = (x[k] - above) / d[k]
    return np.array(x)


def _orthogonal(vector: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for other in others:
            vector = vector - (other @ vector) * other
    return vector


def leading_components(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, components as rows) of a symmetric matrix, by falling eigenvalue."""
    n = len(matrix)
    if n == 1 or not np.any(matrix):
        return np.diag(matrix)[:count].astype(float), np.eye(n)[:count]
    diagonal, beside, reflections = tridiagonal(matrix)
    values = leading_eigenvalues(diagonal, beside, count)
    size = max(abs(v) for v in values) or 1.0
    random = np.random.default_rng(1)
    vectors: list[np.ndarray] = []
    cluster: list[np.ndarray] = []
    for k, value in enumerate(values):
        if k and values[k - 1] - value > 1e-3 * size:
            cluster = []
        # Equal eigenvalues are told apart by a little, so that the solutions differ.
        shifted = value - len(cluster) * 4 * EPSILON * size
        vector = _orthogonal(random.standard_normal(n), cluster)
        vector /= np.linalg.norm(vector)
        for _ in range(5):
            vector = _orthogonal(_solve_shifted(diagonal, beside, shifted, vector), cluster)
            vector /= np.linalg.norm(vector)
        cluster.append(vector)
        vectors.append(from_tridiagonal(vector, reflections))
    return np.array(values), np.array(vectors)


# --- vectors in tasks ---------------------------------------------------------------------


def _entries(batch: pa.RecordBatch, length: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places, sizes and beginnings of the vectors that count, and all entries."""
    column = batch.column("embedding")
    offsets = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False).astype(np.float64)  # null entries become NaN
    known = ~column.is_null().to_numpy(zero_copy_only=False)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    sizes = offsets[1:] - offsets[:-1]
    kept = known & (sizes > 0) & (bad[offsets[1:]] == bad[offsets[:-1]])
    if length is not None:
        kept &= sizes == length
    at = np.flatnonzero(kept)
    return at, sizes[at], offsets[at], flat


def _integers(vectors: np.ndarray) -> np.ndarray:
    """x of every entry, as exact doubles."""
    return np.clip(np.floor(vectors * SCALE), -LARGEST, LARGEST) + SHIFT


def _blocks(batch: pa.RecordBatch, length: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places in the batch, integer vectors) of at most ``BLOCK`` vectors of this length."""
    at, _, begins, flat = _entries(batch, length)
    for k in range(0, len(at), BLOCK):
        yield at[k : k + BLOCK], _integers(flat[begins[k : k + BLOCK, None] + np.arange(length)])


class Sums:
    """Number, mean and centred products of the vectors of a task, block by block."""

    def __init__(self, length: int) -> None:
        self.n, self.mean, self.products = 0, np.zeros(length), np.zeros((length, length))

    def add(self, n: int, mean: np.ndarray, products: np.ndarray) -> None:
        if n:
            apart = mean - self.mean
            both = self.n + n
            self.products += products + np.outer(apart, apart) * (self.n * n / both)
            self.mean = self.mean + apart * (n / both)
            self.n = both

    def add_block(self, vectors: np.ndarray) -> None:
        mean = vectors.mean(0)
        centred = vectors - mean
        self.add(len(vectors), mean, centred.T @ centred)


@dataclass(frozen=True)
class Whitening:
    """What the tasks need to project a vector."""

    n: int
    sums: list[int]
    mean: np.ndarray
    eigenvalues: np.ndarray
    components: np.ndarray
    trace: float

    @property
    def used(self) -> np.ndarray:
        """Which components have variance."""
        least = len(self.mean) * EPSILON * max(self.trace, 0.0)
        return self.eigenvalues > least

    def project(self, x: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.used, ((x - self.mean) @ self.components.T) / np.sqrt(np.abs(self.eigenvalues)), 0.0)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over the dimensions of (n * x - S)^2, exact; None beyond a long."""
    whole = x.astype(np.int64)
    most = (1 << 63) - 1
    if n * int(np.abs(whole).max(initial=0)) + max(map(abs, sums)) > most:
        exact = [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in whole.tolist()]
        return [e if e <= most else None for e in exact]
    apart = np.abs(whole * n - np.array(sums, np.int64))
    reach = int(apart.max(initial=0))
    if reach * reach * len(sums) <= most:
        return (apart * apart).sum(1).tolist()
    if reach < 1 << 48 and len(sums) < 1 << 15:
        # Halves of 24 bits, whose products add up in 64 bits.
        high, low = apart >> 24, apart & ((1 << 24) - 1)
        parts = zip((high * high).sum(1).tolist(), (high * low).sum(1).tolist(), (low * low).sum(1).tolist())
        exact = [(a << 48) + (b << 25) + c for a, b, c in parts]
    else:
        exact = [sum(v * v for v in row) for row in apart.tolist()]
    return [e if e <= most else None for e in exact]


def _merged(rows: Iterable, length: int) -> Sums:
    out = Sums(length)
    for n, mean, products in rows:
        out.add(n, np.array(mean, np.float64), np.frombuffer(products, np.float64).reshape(length, length))
    return out


def _merge_in_groups(parts: DataFrame, length: int) -> Sums:
    """The sums of all tasks: first in groups of tasks, by tasks of their own, then the few groups here."""

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = _merged((r for b in batches for r in zip(b.column("n").to_pylist(), b.column("mean").to_pylist(), b.column("products").to_pylist())), length)
        yield pa.RecordBatch.from_arrays(
            [pa.array([whole.n], pa.int64()), pa.array([whole.mean.tolist()], pa.list_(pa.float64())), pa.array([whole.products.tobytes()], pa.binary())],
            names=["n", "mean", "products"],
        )

    few = parts.select("n", "mean", "products").repartition(GROUPS, "task").mapInArrow(merge, "n bigint, mean array<double>, products binary")
    return _merged(((r.n, r.mean, bytes(r.products)) for r in few.collect()), length)


def _sums_of(vectors: DataFrame, length: int, made: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """Per task (task, n, mean, products) of what ``made`` returns for a block of vectors."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Sums | None = None
        for batch in batches:
            for _, x in _blocks(batch, length):
                block = made(x)
                own = own or Sums(block.shape[1])
                own.add_block(block)
        if own is not None:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([TaskContext.get().partitionId()], pa.int64()),
                    pa.array([own.n], pa.int64()),
                    pa.array([own.mean.tolist()], pa.list_(pa.float64())),
                    pa.array([own.products.tobytes()], pa.binary()),
                ],
                names=["task", "n", "mean", "products"],
            )

    return vectors.mapInArrow(run, "task bigint, n bigint, mean array<double>, products binary")


def _integer_sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per length of vectors their number (dim -1) and the exact sum of every dimension, as text."""
    totals: dict[int, list[int]] = {}
    for batch in batches:
        _, sizes, _, _ = _entries(batch)
        for length in np.unique(sizes).tolist():
            total = totals.setdefault(length, [0] * (length + 1))
            for _, x in _blocks(batch, length):
                # Halves of 26 bits: their sums over a block stay exact in 64 bits.
                whole = x.astype(np.int64)
                high, low = (whole >> 26).sum(0).tolist(), (whole & ((1 << 26) - 1)).sum(0).tolist()
                for k, (h, rest) in enumerate(zip(high, low)):
                    total[k] += (h << 26) + rest
                total[length] += len(x)
    rows = [(length, dim if dim < length else -1, str(t)) for length, total in totals.items() for dim, t in enumerate(total)]
    columns = list(zip(*rows)) or [(), (), ()]
    yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.string())], names=["length", "dim", "total"])


def fit(embeddings: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Mean and leading components of all vectors; None where there are none."""
    vectors = embeddings.select("embedding")
    parts = vectors.mapInArrow(_integer_sums, "length int, dim int, total string")
    totals = stage(parts.groupBy("length", "dim").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")), "embedding-sums")
    most = totals.filter("dim = -1").orderBy(F.col("total").desc(), F.col("length").desc()).first()
    if most is None:
        return None
    length, n = most.length, int(most.total)
    sums = [int(r.total) for r in totals.filter((F.col("length") == length) & (F.col("dim") >= 0)).orderBy("dim").collect()]
    mean = np.array([s / n for s in sums])
    # All vectors are centred by the whole mean; what rounding leaves of it goes out with a task's own mean.
    whole = _merge_in_groups(_sums_of(vectors, length, lambda x: x - mean), length)
    covariance = whole.products / n
    values, found = leading_components(covariance, components)
    return Whitening(n, sums, mean, values, found, float(np.trace(covariance)))


def identity_error(embeddings: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity."""
    used, length = model.used, len(model.mean)
    if not used.any():
        return 0.0
    parts = _sums_of(embeddings.select("embedding"), length, lambda x: model.project(x)[:, used])
    whole = _merge_in_groups(parts, int(used.sum()))
    return float(np.abs(whole.products / whole.n - np.eye(int(used.sum()))).max())


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error), a row per vector and component."""
    schema = f"vec_id {embeddings.schema['vec_id'].dataType.simpleString()}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    model = fit(embeddings, components)
    if model is None:
        return embeddings.sparkSession.createDataFrame([], schema)
    error, used, length = identity_error(embeddings, model), model.used, len(model.mean)
    count = len(model.eigenvalues)
    explained = [float(v / model.trace) if model.trace > 0 else None for v in np.where(used, model.eigenvalues, 0.0)]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, at, x in ((batch, *block) for batch in batches for block in _blocks(batch, length)):
            rows = len(at)
            deviations = pa.array(_deviations(x, model.n, model.sums), pa.int64())
            each = pa.array(np.repeat(np.arange(rows), count))
            unused = np.tile(~used, rows)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(at)).take(each),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * count, model.n, np.int64)),
                    deviations.take(each),
                    pa.array(model.project(x).ravel(), mask=unused),
                    pa.array(explained * rows, pa.float64()),
                    pa.array(np.full(rows * count, error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return embeddings.select("vec_id", "embedding").mapInArrow(run, schema)
