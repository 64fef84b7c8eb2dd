"""Whitening of vectors by an eigendecomposition that is kept up to date row by row.

A *spectrum* is (n, mean, eigenvalues, eigenvectors) of the scatter of n vectors. A
partition starts with an empty one. Each batch of its vectors is centred and brought to
triangular form (QR), which has the same scatter in at most d rows; each of these rows and the shift of the mean is a
centred rank-one update: a secular equation is solved for the new eigenvalues, poles with
no weight or too close together are deflated, and the weights are recomputed from the roots
so that eigenvectors stay orthogonal. Spectra of partitions combine by successive rank-one
updates, one per eigenpair of the smaller and one for the means, in a tree of tasks of
bounded size. Rounding that has gathered is taken out by a distributed Rayleigh-Ritz step: all
centred vectors are projected on the basis, the scatter of the projections is summed over
all tasks, and its eigenvectors turn the basis.

Vectors are lists of numbers; entry c counts as floor(``scale`` * c) + ``shift``, a whole
number, so sums, means and deviations are exact. A task holds a few d x d matrices.

Defined cases: rows whose vector is NULL or holds a NULL or a number that is not finite are left
out, and so are vectors of another length than most have (equal counts: the longer length);
repeated rows and ids count and come out as often as they stand there; NULL ids stay;
components without variance have a NULL ``whitened`` and are left out of ``identity_error``;
a deviation beyond 64 bits is NULL; entries beyond 2^40 after scaling count as 2^40; an empty table gives an empty table; other
columns are never read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rosterline.llm.shipping import Shipped
from rosterline.workspace import fresh_dir

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
FAN_IN = 8
BATCH_ROWS = 4096
_LIMIT = float(1 << 40)
_EPS = np.finfo(float).eps


def secular_roots(poles: np.ndarray, weights: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """The roots of 1 + rho * sum(w_j^2 / (p_j - x)), one right of each pole.

    ``poles`` ascend strictly, no weight is zero, the weights' squares add up to 1. Gives the
    matrix (pole j) - (root i), computed from the pole nearest the root, and the roots.
    """
    size = len(poles)
    gaps = np.append(np.diff(poles), rho)
    squares = rho * weights ** 2
    ahead = np.append(poles[1:], poles[-1] + rho)
    middle = poles + gaps / 2
    at_middle = 1 + (squares / (poles[None, :] - middle[:, None])).sum(axis=1)
    nearer_next = (at_middle < 0) & (np.arange(size) < size - 1)
    origin = np.where(nearer_next, ahead, poles)
    offsets = poles[None, :] - origin[:, None]
    low = np.where(nearer_next, -gaps / 2, 0.0)
    high = np.where(nearer_next, 0.0, np.where(np.arange(size) < size - 1, gaps / 2, gaps))
    for _ in range(120):
        tau = (low + high) / 2
        with np.errstate(divide="ignore", invalid="ignore"):
            value = 1 + (squares / (offsets - tau[:, None])).sum(axis=1)
        right = value < 0
        stuck = (tau == low) | (tau == high)
        low, high = np.where(right & ~stuck, tau, low), np.where(right | stuck, high, tau)
        if stuck.all():
            break
    tau = (low + high) / 2
    # A root never lies on a pole: it moves by the smallest step there is.
    on_pole = offsets == tau[:, None]
    if on_pole.any():
        tau = np.where(on_pole.any(axis=1), np.nextafter(tau, np.where(nearer_next, low, high)), tau)
    return offsets - tau[:, None], origin + tau


def rank_one_update(values: np.ndarray, vectors: np.ndarray, rho: float, direction: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenpairs (values ascending) of ``vectors diag(values) vectors' + rho * direction direction'``."""
    z = vectors.T @ direction
    length = math.sqrt(z @ z)
    if not rho * length * length > 0:
        return values, vectors
    z, rho = z / length, rho * length * length
    tolerance = 8 * _EPS * max(abs(values[0]), abs(values[-1]), rho)
    values, vectors = values.copy(), vectors.copy()
    kept: list[int] = []
    for i in np.flatnonzero(rho * np.abs(z) > tolerance).tolist():
        if kept:
            j = kept[-1]
            size = math.hypot(z[i], z[j])
            c, s = z[i] / size, z[j] / size
            gap = values[i] - values[j]
            if abs(gap * c * s) <= tolerance:
                # Two poles as good as equal: a rotation gives all their weight to the second.
                z[i], z[j] = size, 0.0
                left, right = vectors[:, j].copy(), vectors[:, i].copy()
                vectors[:, j], vectors[:, i] = c * left - s * right, s * left + c * right
                values[j], values[i] = values[j] * c * c + values[i] * s * s, values[j] * s * s + values[i] * c * c
                kept.pop()
        kept.append(i)
    poles, weights = values[kept], z[kept]
    if len(kept) > 1 and not (np.diff(poles) > 0).all():  # a rotation may have put poles out of order by rounding
        order = np.argsort(poles, kind="stable")
        kept = [kept[i] for i in order]
        poles, weights = poles[order], weights[order]
        keep_apart = np.append(True, np.diff(poles) > 0)
        kept, poles, weights = [k for k, ok in zip(kept, keep_apart) if ok], poles[keep_apart], weights[keep_apart]
    if not kept:
        return values, vectors
    weights = weights / math.sqrt(weights @ weights)
    distance, roots = secular_roots(poles, weights, rho)  # distance[i, j] = pole j - root i
    # The weights for which the computed roots are exact (Gu and Eisenstat).
    size = len(poles)
    apart = poles[:, None] - poles[None, :]
    upto = np.arange(size)[None, :] <= np.arange(size - 1)[:, None]
    ratios = -distance[:-1] / np.where(upto, apart[1:], apart[:-1])
    exact = np.sqrt(np.abs(-distance[-1] * ratios.prod(axis=0))) * np.sign(weights)
    turned = exact[None, :] / distance
    turned /= np.sqrt((turned * turned).sum(axis=1))[:, None]
    vectors[:, kept] = vectors[:, kept] @ turned.T
    values[kept] = roots
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


@dataclass
class Spectrum:
    """Scatter of ``n`` vectors about their ``mean``, as eigenpairs with ascending values."""

    n: int
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def empty(cls, size: int) -> "Spectrum":
        return cls(0, np.zeros(size), np.zeros(size), np.eye(size))

    def _move(self, n: int, mean: np.ndarray) -> None:
        """Takes in ``n`` vectors that all lie at ``mean``."""
        both = self.n + n
        if self.n:
            self.values, self.vectors = rank_one_update(self.values, self.vectors, self.n * n / both, mean - self.mean)
        self.mean = self.mean + (mean - self.mean) * (n / both)
        self.n = both

    def add(self, rows: np.ndarray) -> None:
        """Takes in the rows of a matrix."""
        if not len(rows):
            return
        mean = rows.mean(axis=0)
        centred = rows - mean
        if len(rows) > rows.shape[1]:
            centred = np.linalg.qr(centred, mode="r")
        for row in centred:
            self.values, self.vectors = rank_one_update(self.values, self.vectors, 1.0, row)
        self._move(len(rows), mean)

    def merge(self, other: "Spectrum") -> None:
        if not other.n:
            return
        for value, vector in zip(other.values, other.vectors.T):
            self.values, self.vectors = rank_one_update(self.values, self.vectors, max(value, 0.0), vector)
        self._move(other.n, other.mean)

    def packed(self) -> bytes:
        return np.concatenate([[float(self.n)], self.mean, self.values, self.vectors.ravel()]).tobytes()

    @classmethod
    def unpacked(cls, data: bytes, size: int) -> "Spectrum":
        a = np.frombuffer(data)
        return cls(int(a[0]), a[1:1 + size].copy(), a[1 + size:1 + 2 * size].copy(), a[1 + 2 * size:].reshape(size, size).copy())


def whole_numbers(column: pa.Array, scale: float, shift: int) -> np.ndarray:
    """A list column without NULLs, all of one length, as a matrix of whole numbers."""
    size = len(column[0]) if len(column) else 0
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    return np.clip(np.floor(flat * scale), -_LIMIT, _LIMIT).astype(np.int64).reshape(len(column), size) + shift


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """(id, vector) of the rows that take part, and the vectors' length."""
    entries = F.col("vector")
    fine = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector")).where(entries.isNotNull() & fine)
    sizes = rows.where(F.size("vector") > 0).groupBy(F.size("vector").alias("size")).count()
    most = sizes.orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    size = most[0]["size"] if most else 0
    return rows.where(F.size("vector") == size).where(F.size("vector") > 0), size


def _totals(rows: DataFrame, size: int, scale: float, shift: int) -> tuple[int, list[int]]:
    """The number of vectors and their exact sums per dimension."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * size
        for batch in batches:
            if batch.num_rows:
                x = whole_numbers(batch.column(0), scale, 0)
                n += len(x)
                sums = [a + int(b) for a, b in zip(sums, x.sum(axis=0))]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(-1, size), pa.int32()), pa.array([str(v) for v in [n, *sums]])], names=["dimension", "part"]
        )

    parts = rows.select("vector").mapInArrow(add_up, "dimension INT, part STRING")
    total = {r["dimension"]: int(r["total"]) for r in parts.groupBy("dimension").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total")).collect()}
    n = total.get(-1, 0)
    return n, [total.get(i, 0) + n * shift for i in range(size)]


def _packed_spectra(rows: DataFrame, size: int, scale: float, shift: int, fan_in: int) -> bytes | None:
    """The spectrum of all vectors: per partition, then combined ``fan_in`` at a time."""

    def per_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        spectrum = Spectrum.empty(size)
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                x = whole_numbers(batch.column(0).slice(at, BATCH_ROWS), scale, 0)
                spectrum.add(x.astype(float))
        if spectrum.n:
            number = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([spectrum.packed()])], names=["number", "spectrum"])

    def combine(table: pa.Table) -> pa.Table:
        both = sorted(zip(table["number"].to_pylist(), table["spectrum"].to_pylist()))
        spectra = sorted((Spectrum.unpacked(data, size) for _, data in both), key=lambda s: -s.n)
        for other in spectra[1:]:
            spectra[0].merge(other)
        return pa.table({"number": [both[0][0] // fan_in], "spectrum": [spectra[0].packed()]})

    spark, schema = rows.sparkSession, "number BIGINT, spectrum BINARY"

    def kept(frame: DataFrame) -> DataFrame:
        path = fresh_dir(spark, "spectra")
        frame.write.parquet(path)
        return spark.read.schema(schema).parquet(path)

    spectra = kept(rows.select("vector").mapInArrow(per_partition, schema))
    top = spectra.agg(F.max("number")).first()[0]
    while top is not None and top > 0:
        spectra = kept(spectra.groupBy(F.floor(F.col("number") / fan_in)).applyInArrow(combine, schema))
        top //= fan_in
    last = spectra.collect()  # one row: numbers below fan_in have become 0
    return last[0]["spectrum"] if last else None


def _summed(rows: DataFrame, model: "Whitening", size: int, products) -> np.ndarray:
    """The sum over all rows of a (size x size) matrix that ``products`` makes of the model and a batch of vectors."""
    shipped = Shipped(rows.sparkSession, model)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, known = np.zeros((size, size)), shipped.load()
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                total += products(known, batch.column(0).slice(at, BATCH_ROWS))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(size), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))], names=["row", "sums"]
        )

    parts = rows.select("vector").mapInArrow(partial, "row INT, sums ARRAY<DOUBLE>")
    cells = parts.select("row", F.posexplode("sums").alias("column", "part"))
    result = np.zeros((size, size))
    for r in cells.groupBy("row", "column").agg(F.sum("part").alias("total")).collect():
        result[r["row"], r["column"]] = r["total"]
    return result


@dataclass
class Whitening:
    """What is needed to whiten a vector: exact totals and the leading eigenpairs of the covariance."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    scale: float
    shift: int

    @property
    def base(self) -> np.ndarray:
        """A whole number near the mean of each dimension."""
        return np.array([s // self.n for s in self.sums], np.int64)

    def centred(self, column: pa.Array) -> np.ndarray:
        """Whole numbers less their mean; the large common part goes before anything is rounded."""
        rest = np.array([(s % self.n) / self.n for s in self.sums])
        return (whole_numbers(column, self.scale, self.shift) - self.base) - rest

    def whitened(self, column: pa.Array) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.present, (self.centred(column) @ self.vectors) / np.sqrt(self.values), np.nan)

    @property
    def present(self) -> np.ndarray:
        """Components with variance."""
        return self.values > len(self.sums) * 16 * _EPS * max(self.trace, 0.0)

    def deviations(self, column: pa.Array) -> list[int | None]:
        """sum((n * x - sums)^2) per vector, exact; NULL beyond 64 bits."""
        x = whole_numbers(column, self.scale, self.shift) - self.base
        rest = np.array([s % self.n for s in self.sums], np.int64)
        bound = (int(np.abs(x).max(initial=0)) + 1) * self.n
        if bound * bound * max(1, len(self.sums)) < 1 << 62:
            off = x * self.n - rest
            return (off * off).sum(axis=1).tolist()
        exact = [sum((v * self.n - r) ** 2 for v, r in zip(row, rest.tolist())) for row in x.tolist()]
        return [value if value < 1 << 63 else None for value in exact]


def fit(rows: DataFrame, size: int, components: int = COMPONENTS, scale: float = SCALE, shift: int = SHIFT, fan_in: int = FAN_IN) -> Whitening | None:
    """The whitening of all vectors (column ``vector``, each of length ``size``)."""
    if not size:
        return None
    n, sums = _totals(rows, size, scale, shift)
    data = _packed_spectra(rows, size, scale, shift, fan_in)
    if data is None:
        return None
    basis = Spectrum.unpacked(data, size).vectors

    def projected(rough: Whitening, column: pa.Array) -> np.ndarray:
        y = rough.centred(column) @ rough.vectors
        return y.T @ y

    # The basis is orthonormal up to rounding only: the generalised Ritz problem takes that into account.
    ritz = _summed(rows, Whitening(n, sums, np.ones(size), basis, 0.0, scale, shift), size, projected) / n
    lower = np.linalg.cholesky(basis.T @ basis)
    inverse = np.linalg.inv(lower)
    values, turns = np.linalg.eigh(inverse @ ritz @ inverse.T)
    vectors = basis @ inverse.T @ turns
    trace = float(values.sum())
    order = np.argsort(-values, kind="stable")[:components]
    lead = vectors[:, order]
    return Whitening(n, sums, np.maximum(values[order], 0.0), lead / np.sqrt((lead * lead).sum(axis=0)), trace, scale, shift)


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """The largest entry of (covariance of all whitened vectors - identity), over components with variance."""
    size = len(model.values)

    def products(known: Whitening, column: pa.Array) -> np.ndarray:
        # A last column of ones brings the sums along with the products.
        w = np.column_stack([np.where(known.present, known.whitened(column), 0.0), np.ones(len(column))])
        return w.T @ w

    sums = _summed(rows, model, size + 1, products) / model.n
    mean = sums[:size, size]
    off = sums[:size, :size] - np.outer(mean, mean) - np.eye(size)
    inside = off[np.ix_(model.present, model.present)]
    return float(np.abs(inside).max(initial=0.0))


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS,
           scale: float = SCALE, shift: int = SHIFT) -> DataFrame:
    """One row per usable vector and component (from 1, by falling eigenvalue).

    ``whitened`` is the centred vector's projection over the root of the eigenvalue,
    ``explained`` the eigenvalue's share of the trace, ``deviation`` the exact sum over all
    dimensions of (n * x - sum of x)^2.
    """
    spark = vectors.sparkSession
    kind = vectors.schema[id_col].dataType.simpleString()
    schema = (f"`{id_col}` {kind}, component INT, n BIGINT, deviation BIGINT, whitened DOUBLE, explained DOUBLE, identity_error DOUBLE")
    rows, size = usable(vectors, id_col, vector_col)
    model = fit(rows, size, components, scale, shift)
    if model is None:
        return spark.createDataFrame([], schema)
    error = identity_error(rows, model)
    shipped = Shipped(spark, model)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shipped.load()
        k = len(known.values)
        share = known.values / known.trace if known.trace > 0 else np.zeros(k)
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(at, BATCH_ROWS)
                m = batch.num_rows
                repeat = pa.array(np.repeat(np.arange(m), k))
                w = known.whitened(batch.column(1)).ravel()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(repeat), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * k, known.n, np.int64)), pa.array(known.deviations(batch.column(1)), pa.int64()).take(repeat),
                        pa.array(w, mask=np.isnan(w)), pa.array(np.tile(share, m)), pa.array(np.full(m * k, error)),
                    ],
                    names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.mapInArrow(apply, schema)
