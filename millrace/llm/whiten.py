"""Embedding whitening: pivoted Cholesky of the centred scatter, then one-sided Jacobi on the factor.

Vectors become integers. Their distinct values are the fit list; sums and scatter are added up as
integers in the tasks (centred at the rounded mean before multiplying, the rest of the mean taken
off exactly), so the result does not depend on how rows are spread. Only dimension x dimension
numbers reach the driver. There the scatter is factored with the largest remaining diagonal entry
as pivot, and one-sided Jacobi rotates the columns of the triangular factor until they are
orthogonal: their squared norms are the eigenvalues, the columns scaled to length 1 the components.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import session

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16
SLICE = 4096  # vectors that are worked on together
LIMIT = 2.0**50  # quantised components are smaller; others take no part
_EXACT = 2**53
_EPS = np.finfo(float).eps


def _packed(scale: int):
    """Vectors as bytes: floor(scale * c) in the fewest of 1, 2, 4 or 8 bytes each, the width in front."""

    def pack(batches):
        for batch in batches:
            lists = batch.column(1)
            dims, keys = [], []
            for start in range(0, len(lists), SLICE):
                part = lists.slice(start, SLICE)
                lengths = np.nan_to_num(part.value_lengths().to_numpy(zero_copy_only=False).astype(float)).astype(np.int64)
                flat = part.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # NULL becomes NaN
                ends = np.cumsum(lengths)
                with np.errstate(over="ignore", invalid="ignore"):
                    z = np.floor(flat * scale)
                known = part.is_valid().to_numpy(zero_copy_only=False)
                for n, end, whole in zip(lengths.tolist(), ends.tolist(), known.tolist()):
                    row = z[end - n : end]
                    most = np.abs(row).max(initial=0.0) if whole else np.inf
                    if not most < LIMIT:  # NaN as well
                        dims.append(None)
                        keys.append(None)
                        continue
                    width = 1 if most < 128 else 2 if most < 32768 else 4 if most < 2**31 else 8
                    dims.append(n)
                    keys.append(bytes([width]) + row.astype(f"<i{width}").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(dims, pa.int32()), pa.array(keys, pa.binary())], names=["id", "dim", "key"])

    return pack


def _matrix(keys: list[bytes], dim: int) -> np.ndarray:
    out = np.empty((len(keys), dim), np.int64)
    for i, key in enumerate(keys):
        out[i] = np.frombuffer(key, f"<i{key[0]}", offset=1)
    return out


def _slices(batches, column: int, dim: int):
    """(rows of a batch, their matrix), some rows at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE):
            part = batch.slice(start, SLICE)
            if part.num_rows:
                yield part, _matrix(part.column(column).to_pylist(), dim)


def _product(y: np.ndarray) -> np.ndarray:
    """y'y of integers, exact."""
    most = int(np.abs(y).max(initial=0))
    if most * most * len(y) < _EXACT:
        held = y.astype(np.float64)
        return (held.T @ held).astype(np.int64).astype(object)
    return y.astype(object).T @ y.astype(object)


_EXACT_SUMS = "cell int, total decimal(38,0)"
_FLOAT_SUMS = "cell int, total double"


def _sums(dim: int):
    """One row for each cell and task: 0 the number of rows, then the sums by dimension."""

    def add(batches):
        total = np.zeros(dim + 1, object)
        for part, z in _slices(batches, 0, dim):
            total[0] += part.num_rows
            total[1:] += z.astype(object).sum(axis=0)
        yield _cells(total, pa.decimal128(38, 0))

    return add


def _scatter(dim: int, centre: np.ndarray):
    """One row for each cell on or above the diagonal and task: sums of products about `centre`."""
    upper = np.triu_indices(dim)

    def add(batches):
        total = np.zeros((dim, dim), object)
        for _, z in _slices(batches, 0, dim):
            total += _product(z - centre)
        yield _cells(total[upper], pa.decimal128(38, 0))

    return add


def _cells(values, kind) -> pa.RecordBatch:
    from decimal import Decimal

    numbers = [Decimal(int(v)) for v in values] if kind != pa.float64() else [float(v) for v in values]
    return pa.RecordBatch.from_arrays([pa.array(range(len(numbers)), pa.int32()), pa.array(numbers, kind)], names=["cell", "total"])


def _added(rows: DataFrame, task, schema: str, size: int) -> list:
    """Totals of all tasks by cell; `size` rows reach the driver."""
    found = dict(map(tuple, rows.mapInArrow(task, schema).groupBy("cell").agg(F.sum("total")).collect()))
    return [found.get(i, 0) for i in range(size)]


def pivoted_cholesky(matrix: np.ndarray) -> np.ndarray:
    """Columns L with L L' = `matrix` (positive semidefinite), the largest remaining pivot first.

    The rows keep their order, so L is triangular up to the order of the pivots. It ends when
    what is left of each diagonal entry is rounding, measured against the entry itself, so that
    a direction of little spread is kept.
    """
    size = len(matrix)
    rest = np.diag(matrix).astype(float).copy()
    least = size * _EPS * rest
    factor = np.zeros((size, 0))
    free = np.ones(size, bool)
    while (free & (rest > least)).any():
        pivot = int(np.argmax(np.where(free & (rest > least), rest, -np.inf)))
        column = matrix[:, pivot] - factor @ factor[pivot]
        column[~free] = 0.0
        column /= np.sqrt(column[pivot])
        factor = np.column_stack([factor, column])
        rest -= column * column
        free[pivot] = False
    return factor


def _rounds(size: int):
    """Pairs of columns in rounds: every two meet once, no column twice in a round."""
    ring = list(range(size + size % 2))
    half = len(ring) // 2
    for _ in range(len(ring) - 1):
        pairs = [(a, b) for a, b in zip(ring[:half], reversed(ring[half:])) if max(a, b) < size]
        yield np.array([min(p) for p in pairs], int), np.array([max(p) for p in pairs], int)
        ring = [ring[0], ring[-1], *ring[1:-1]]


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, components as columns) of factor factor', by falling eigenvalue."""
    turned = factor.astype(float).copy()
    for _ in range(sweeps):
        quiet = True
        for p, q in _rounds(turned.shape[1]):
            a, b = turned[:, p], turned[:, q]
            alpha, beta, gamma = (a * a).sum(axis=0), (b * b).sum(axis=0), (a * b).sum(axis=0)
            open_ = np.abs(gamma) > _EPS * np.sqrt(alpha * beta)
            if not open_.any():
                continue
            quiet = False
            zeta = (beta - alpha)[open_] / (2 * gamma[open_])
            t = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.sqrt(1 + zeta * zeta))
            c = 1 / np.sqrt(1 + t * t)
            s = c * t
            a, b = a[:, open_], b[:, open_]
            turned[:, p[open_]], turned[:, q[open_]] = c * a - s * b, s * a + c * b
        if quiet:
            break
    norms = np.sqrt((turned * turned).sum(axis=0))
    first = np.argsort(-norms, kind="stable")
    vectors = turned[:, first] / norms[first]
    largest = np.abs(vectors).argmax(axis=0)
    return norms[first] ** 2, vectors * np.sign(vectors[largest, np.arange(len(first))])


@dataclass
class Whitening:
    """What `fit` learned; as large as the dimension squared, whatever the number of vectors."""

    n: int  # distinct vectors
    dim: int
    sums: list[int]  # of floor(scale * c) over them
    scale: int
    values: np.ndarray  # eigenvalues kept
    vectors: np.ndarray  # a column for each
    explained: np.ndarray  # share of the trace
    identity_error: float | None = None

    @property
    def centre(self) -> np.ndarray:
        """The rounded mean."""
        return np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], np.int64)

    def whiten(self, z: np.ndarray) -> np.ndarray:
        centre = self.centre
        left = np.array([(s - int(c) * self.n) / self.n for s, c in zip(self.sums, centre)])
        return ((z - centre).astype(float) - left) @ (self.vectors / np.sqrt(self.values))

    def deviation(self, z: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n*x - S)^2 for each row; None beyond 64 bits."""
        centre = self.centre
        y = z - centre
        left = [s - int(c) * self.n for s, c in zip(self.sums, centre)]
        most = (int(np.abs(y).max(initial=0)) + 1) * self.n
        kind = np.int64 if most * most * max(self.dim, 1) < 2**63 else object
        d = y.astype(kind) * self.n - np.array(left, kind)
        return [v if v < 2**63 else None for v in map(int, (d * d).sum(axis=1))]


def quantise(rows: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", scale: int = SCALE) -> DataFrame:
    """(id, dim, key): the vectors that take part, as bytes that are equal exactly for equal quantised vectors."""
    held = rows.select(F.col(f"`{vec_id}`").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    schema = T.StructType([held.schema["id"], T.StructField("dim", T.IntegerType()), T.StructField("key", T.BinaryType())])
    return held.mapInArrow(_packed(scale), schema).where("key is not null")


def fit(quantised: DataFrame, components: int = COMPONENTS, scale: int = SCALE) -> Whitening | None:
    """The whitening of the distinct vectors of `quantise`; None where there is no vector or no spread.

    Vectors of another length than the most frequent one (of two, the longer) are left out.
    """
    common = quantised.groupBy("dim").agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), F.desc("dim")).first()
    if common is None or not common.dim:
        return None
    dim = common.dim
    with session.workspace(quantised.sparkSession) as settle:
        distinct = settle(quantised.where(F.col("dim") == dim).select("key").distinct(), "fit-list")
        n, *sums = map(int, _added(distinct, _sums(dim), _EXACT_SUMS, dim + 1))
        model = Whitening(n, dim, sums, scale, np.zeros(0), np.zeros((dim, 0)), np.zeros(0))
        centre = model.centre
        cells = _added(distinct, _scatter(dim, centre), _EXACT_SUMS, dim * (dim + 1) // 2)
        left = [s - int(c) * n for s, c in zip(sums, centre)]
        covariance = np.zeros((dim, dim))
        for i, j, total in zip(*np.triu_indices(dim), cells):
            # exact integers until this one division
            covariance[i, j] = covariance[j, i] = (n * int(total) - left[i] * left[j]) / (n * n)
        values, vectors = one_sided_jacobi(pivoted_cholesky(covariance))
        if not len(values):
            return None
        kept = min(components, len(values))
        model.values, model.vectors = values[:kept], vectors[:, :kept]
        model.explained = model.values / np.trace(covariance)
        model.identity_error = _identity_error(distinct, model)
    return model


def _identity_error(distinct: DataFrame, model: Whitening) -> float:
    """Largest entry of the whitened fit list's covariance minus the identity, in size."""
    size = len(model.values)

    def add(batches):
        total = np.zeros(size + size * size)
        for _, z in _slices(batches, 0, model.dim):
            w = model.whiten(z)
            total[:size] += w.sum(axis=0)
            total[size:] += (w.T @ w).ravel()
        yield _cells(total, pa.float64())

    total = np.array(_added(distinct, add, _FLOAT_SUMS, size + size * size), float) / model.n
    mean = total[:size]
    return float(np.abs(total[size:].reshape(size, size) - np.outer(mean, mean) - np.eye(size)).max())


def apply(quantised: DataFrame, model: Whitening) -> DataFrame:
    """(id, deviation, whitened): every vector of the model's length, projected and scaled; whitened is an array."""
    schema = T.StructType([
        quantised.schema["id"], T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType()))
    ])

    def project(batches):
        for part, z in _slices(batches, 1, model.dim):
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(model.deviation(z), pa.int64()), pa.array(list(model.whiten(z)), pa.list_(pa.float64()))],
                names=["id", "deviation", "whitened"],
            )

    return quantised.where(F.col("dim") == model.dim).select("id", "key").mapInArrow(project, schema)


def whiten(
    rows: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", components: int = COMPONENTS, scale: int = SCALE
) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row for each vector and component.

    Vectors that are NULL or hold NULL, NaN or infinite components take no part, nor do those with a
    quantised component of 2^50 or more in size or with another length than the most frequent one
    (of two equally frequent, the longer). Equal vectors count once in the fit and all come back,
    so repeated rows and shared or NULL ids come back as they are. Components without spread are
    left out; one distinct vector, empty vectors and an empty table give an empty result. A
    deviation beyond 64 bits is NULL. Other columns are not read. Vectors of any length work;
    the driver holds the length squared.
    """
    spark = rows.sparkSession
    held = session.settle(quantise(rows, vector, vec_id, scale), "quantised")
    model = fit(held, components, scale)
    kind = held.schema["id"].dataType
    if model is None:
        empty = T.StructType([T.StructField(vec_id, kind)])
        found = spark.createDataFrame([], empty)
        return found.select(
            F.col(f"`{vec_id}`"), F.lit(0).alias("component"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("deviation"),
            F.lit(0.0).alias("whitened"), F.lit(0.0).alias("explained"), F.lit(0.0).alias("identity_error"),
        )
    shares = F.array(*[F.lit(float(x)) for x in model.explained])
    found = apply(held, model).select("id", "deviation", F.posexplode("whitened").alias("place", "value"))
    return found.select(
        F.col("id").alias(vec_id),
        (F.col("place") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        F.col("value").alias("whitened"),
        F.get(shares, F.col("place")).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )
