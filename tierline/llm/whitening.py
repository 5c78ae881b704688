"""Whitening of embeddings: pivoted Cholesky, then one-sided Jacobi on the triangular factor.

Vectors become whole numbers, whose count and sums are exact. A second pass sums
the products of the centred vectors (the scatter), partly in each task and then
per row of the matrix. Only that matrix, of the vectors' dimension squared, comes
to the driver. Pivoted Cholesky factors it as ``L L'``; plane rotations of the
columns of ``L`` make them orthogonal. The squared norm of a rotated column is an
eigenvalue of the scatter and the normalised column its eigenvector, so the
scatter is never squared and small eigenvalues keep their digits. A last pass
projects every vector and measures how far the covariance of the result is from
the identity.

Defined results: vectors that are null, or hold null or non-finite entries, take
no part; of the others those of the most frequent length do (of equally frequent
ones the shortest), longer or shorter ones are left out; vectors without entries
and an empty table give no rows. Entries beyond 2**53 / scale either way count as
that bound. Rows that repeat, or share an id, count each; rows without an id
count and are returned with a null one. Components without variance are left
out, so vectors that are all equal give no rows. Eigenvalues that tie come in the
order of the rotated columns. ``deviation`` is exact, and null where it needs
more than 64 bits. Other columns are not looked at, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tierline.llm.common import stored

SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
_LARGEST = float(1 << 53)
#: Rotations stop when all columns are this close to orthogonal, as a cosine.
ORTHOGONAL, SWEEPS = 1e-15, 60
#: Vectors multiplied at a time.
_STRIP = 1 << 14


def whole_vectors(embeddings: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding",
                  scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """(vec_id, x): the usable vectors in whole numbers, floor(scale * c) + shift."""
    entry = F.col(vector_column).cast("array<double>")
    usable = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    bounded = lambda c: F.greatest(F.least(c * scale, F.lit(_LARGEST)), F.lit(-_LARGEST))
    return (embeddings.select(F.col(id_column).cast("long").alias("vec_id"), entry.alias("v"))
            .filter("v IS NOT NULL AND size(v) > 0").filter(usable)
            .select("vec_id", F.transform("v", lambda c: F.floor(bounded(c)).cast("long") + shift).alias("x")))


def _by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions and matrix of the vectors of each length."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        chosen = column if len(rows) == len(column) else column.take(pa.array(rows))
        yield rows, chosen.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), int(length))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Count and exact sums of each length, the sums in halves of 32 bits that cannot overflow."""
    found: dict[int, list] = {}
    for batch in batches:
        for rows, x in _by_length(batch.column("x")):
            n, total = found.setdefault(x.shape[1], [0, [0] * x.shape[1]])
            high, low = (x >> 32).sum(axis=0).tolist(), (x & 0xFFFFFFFF).sum(axis=0).tolist()
            found[x.shape[1]] = [n + len(rows), [t + (h << 32) + s for t, h, s in zip(total, high, low)]]
    rows = [(length, i, n, s) for length, (n, total) in found.items() for i, s in enumerate(total)]
    columns = list(zip(*rows)) if rows else [()] * 4
    yield pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int64()),
         pa.array([str(s) for s in columns[3]], pa.string())], ["length", "i", "n", "s"])


@dataclass(frozen=True)
class Centre:
    """Count of the fit list, exact sums, and the mean as a whole number and a rest."""

    n: int
    sums: tuple[int, ...]

    @property
    def whole(self) -> np.ndarray:
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def rest(self) -> tuple[int, ...]:
        """n times what the mean has beyond ``whole``; from 0 to n - 1."""
        return tuple(s % self.n for s in self.sums)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x minus the mean: whole numbers are subtracted before anything is rounded."""
        return (x - self.whole) - np.array([r / self.n for r in self.rest])

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The sum over dimensions of (n * x - sum) ** 2 of each vector, exact, None beyond 64 bits."""
        moved = x - self.whole
        largest = float(np.abs(moved).max(initial=0)) * self.n + self.n
        if largest * largest * x.shape[1] < 2 ** 62:
            return (((moved * self.n - np.array(self.rest, np.int64)) ** 2).sum(axis=1)).tolist()
        exact = [sum((m * self.n - r) ** 2 for m, r in zip(row, self.rest)) for row in moved.tolist()]
        return [d if d < 1 << 63 else None for d in exact]


def centre(vectors: DataFrame) -> Centre | None:
    """Count and sums of the vectors of the most frequent length; None without vectors."""
    sums = (vectors.select("x").mapInArrow(_sums, "length int, i int, n long, s string")
            .groupBy("length", "i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")))
    length = F.struct("n", (-F.col("length")).alias("length"))
    chosen = sums.filter("i = 0").agg(F.max(length).alias("best")).first()["best"]
    if chosen is None:
        return None
    rows = sums.filter(F.col("length") == -chosen["length"]).orderBy("i").collect()  # one row per dimension
    return Centre(chosen["n"], tuple(int(r["s"]) for r in rows))


def _scatters(mid: Centre):
    def scatters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(mid.sums),) * 2)
        for batch in batches:
            for _, x in _by_length(batch.column("x")):
                for at in range(0, len(x) if x.shape[1] == len(mid.sums) else 0, _STRIP):
                    y = mid.centred(x[at:at + _STRIP])
                    total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)),
                                          pa.array(list(total), pa.list_(pa.float64()))], ["i", "row"])
    return scatters


def _summed(group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of one row of the matrix over all tasks, each task's part in turn."""
    total, number = 0, None
    for batch in group:
        number = batch.column("i")[:1]
        total = total + batch.column("row").flatten().to_numpy().reshape(batch.num_rows, -1).sum(axis=0)
    yield pa.RecordBatch.from_arrays([number, pa.array([total], pa.list_(pa.float64()))], ["i", "row"])


def scatter(vectors: DataFrame, mid: Centre) -> np.ndarray:
    """The sum of the products of the centred vectors, a matrix of the dimension squared."""
    schema = "i int, row array<double>"
    rows = vectors.select("x").mapInArrow(_scatters(mid), schema).groupBy("i").applyInArrow(_summed, schema)
    return np.array([r["row"] for r in rows.orderBy("i").collect()])


def pivoted_cholesky(matrix: np.ndarray) -> np.ndarray:
    """``L``, of as many columns as the matrix has rank, with ``L @ L.T`` the matrix.

    The largest diagonal entry left is the next pivot, so with its rows in pivot
    order ``L`` is lower triangular and its diagonal falls.
    """
    left, size = np.array(matrix, np.float64), len(matrix)
    diagonal, columns = left.diagonal().copy(), []
    smallest = max(diagonal.max(initial=0.0), 0.0) * size * np.finfo(float).eps
    factor, open_ = np.zeros((size, size)), np.ones(size, bool)
    for k in range(size):
        pivot = int(np.argmax(np.where(open_, diagonal, -np.inf)))
        if diagonal[pivot] <= smallest:
            break
        column = left[:, pivot] - factor[:, :k] @ factor[pivot, :k]
        column = np.where(open_, column, 0.0) / np.sqrt(diagonal[pivot])
        column[pivot] = np.sqrt(diagonal[pivot])
        factor[:, k] = column
        open_[pivot] = False
        diagonal -= column ** 2
        columns.append(k)
    return factor[:, :len(columns)]


def one_sided_jacobi(factor: np.ndarray) -> np.ndarray:
    """The factor with its columns rotated in pairs until all are orthogonal, longest first."""
    columns = np.array(factor.T, np.float64)  # one row per column
    for _ in range(SWEEPS):
        settled = True
        for p in range(len(columns) - 1):
            for q in range(p + 1, len(columns)):
                a, b = columns[p], columns[q]
                aa, bb, ab = a @ a, b @ b, a @ b
                if abs(ab) <= ORTHOGONAL * np.sqrt(aa * bb):
                    continue
                settled = False
                turn = (bb - aa) / (2 * ab)
                t = (1.0 if turn >= 0 else -1.0) / (abs(turn) + np.hypot(1.0, turn))
                c = 1 / np.hypot(1.0, t)
                columns[p], columns[q] = c * (a - t * b), c * (t * a + b)
        if settled:
            break
    order = np.argsort(-(columns ** 2).sum(axis=1), kind="stable")
    return columns[order].T


def principal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a scatter, falling, and its unit eigenvectors as columns; those above zero only."""
    rotated = one_sided_jacobi(pivoted_cholesky(matrix))
    norms = np.sqrt((rotated ** 2).sum(axis=0))
    return norms ** 2, rotated / norms


def _projected(mid: Centre, directions: np.ndarray):
    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in _by_length(batch.column("x")):
                if x.shape[1] != len(mid.sums):
                    continue
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").take(pa.array(rows)), pa.array(mid.deviations(x), pa.int64()),
                     pa.array(list(mid.centred(x) @ directions), pa.list_(pa.float64()))],
                    ["vec_id", "deviation", "whitened"])
    return project


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Count, mean and centred products of the task's rows, merged batch by batch."""
    n, mean, products = 0, 0.0, 0.0
    for batch in batches:
        if batch.num_rows:
            w = batch.column("whitened").flatten().to_numpy().reshape(batch.num_rows, -1)
            n, mean, products = merged((n, mean, products),
                                       (len(w), w.mean(axis=0), (w - w.mean(axis=0)).T @ (w - w.mean(axis=0))))
    if n:
        yield pa.RecordBatch.from_arrays([pa.array([1]), pa.array([n]), pa.array([mean], pa.list_(pa.float64())),
                                          pa.array([products.ravel()], pa.list_(pa.float64()))],
                                         ["one", "n", "mean", "products"])


def merged(a: tuple, b: tuple) -> tuple:
    """Count, mean and centred products of two sets of rows together."""
    n, apart = a[0] + b[0], b[1] - a[1]
    return n, a[1] + apart * (b[0] / n), a[2] + b[2] + np.outer(apart, apart) * (a[0] * b[0] / n)


def _merge_group(group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    state = (0, 0.0, 0.0)
    for batch in group:
        for row in batch.to_pylist():
            k = len(row["mean"])
            state = merged(state, (row["n"], np.array(row["mean"]), np.array(row["products"]).reshape(k, k)))
    yield pa.RecordBatch.from_arrays([pa.array([state[0]]), pa.array([state[2].ravel()], pa.list_(pa.float64()))],
                                     ["n", "products"])


def identity_error(whitened: DataFrame) -> float:
    """The largest absolute entry of the rows' covariance minus the identity."""
    parts = whitened.select("whitened").mapInArrow(_moments, "one long, n long, mean array<double>, products array<double>")
    row = parts.groupBy("one").applyInArrow(_merge_group, "n long, products array<double>").first()  # a row per task
    covariance = np.array(row["products"]) / row["n"]
    return float(np.abs(covariance - np.eye(int(round(len(covariance) ** 0.5))).ravel()).max())


_SCHEMA = ("vec_id long, component int, n long, deviation long, whitened double, explained double,"
           " identity_error double")


def whiten(embeddings: DataFrame, components: int = COMPONENTS, **options) -> DataFrame:
    """One row per usable vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    spark, vectors = embeddings.sparkSession, whole_vectors(embeddings, **options)
    mid = centre(vectors)
    if mid is None:
        return spark.createDataFrame([], _SCHEMA)
    matrix = scatter(vectors, mid)
    values, directions = principal(matrix)
    values, directions = values[:components], directions[:, :components]
    if not len(values):
        return spark.createDataFrame([], _SCHEMA)
    rows = stored(vectors.mapInArrow(_projected(mid, directions / np.sqrt(values / mid.n)),
                                     "vec_id long, deviation long, whitened array<double>"), "whitened")
    error, shares = identity_error(rows), values / np.trace(matrix)
    return (rows.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
            .select("vec_id", (F.col("place") + 1).cast("int").alias("component"), F.lit(mid.n).cast("long").alias("n"),
                    "deviation", "whitened",
                    F.array(*(F.lit(float(s)) for s in shares))[F.col("place")].alias("explained"),
                    F.lit(error).alias("identity_error")))
