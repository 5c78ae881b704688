"""Exact top-k inner products by dual-tree cover-tree search.

Queries and data are one table and are indexed together. ``CELLS`` centres,
drawn as the rows with the smallest hash of their id, only decide which rows lie
together: every row goes to its nearest centre, and a cell's rows are dealt to
parts of about ``PART``, so a vector that a third of the rows share fills many
parts, not one. Each query first meets its own part, which gives a lower bound
for its k-th score. Cells whose covering radius leaves no room above that bound
are skipped; in the parts of the others a cover tree over the queries runs
against a cover tree over the data, and a pair of nodes is dropped when no
vector of the one can reach, with any query of the other, the worst k-th score
of that group. The bounds are exact up to rounding, for which they are widened.

Defined results: vectors that are null, or hold null or non-finite components,
and rows without an id take no part; shorter vectors count as filled up with
zeros; ties go to the smaller id; rows that share an id are candidates each, and
as a query an id has one vector, its least; an empty table gives no rows. Scores
must fit 64 bits. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tierline.llm.common import groups_for, stored

CELLS, PART, QUERIES = 64, 512, 8192
#: A node of at most this many vectors is a leaf.
LEAF = 32
_FLOOR = -(1 << 63)


def quantised(embeddings: DataFrame, id_column: str, vector_column: str, scale: int, query: str) -> DataFrame:
    """vec_id, v (whole numbers) and whether the row is a query, of the rows that take part."""
    usable = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (embeddings.select(F.col(id_column).cast("long").alias("vec_id"),
                              F.col(vector_column).cast("array<double>").alias("v"))
            .filter("vec_id IS NOT NULL AND v IS NOT NULL").filter(usable)
            .select("vec_id", F.transform("v", lambda x: F.floor(x * scale).cast("long")).alias("v"),
                    F.expr(query).alias("is_query")))


def _matrix(column) -> np.ndarray:
    """Rows of equally long lists as a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products of integer rows; in floating point where that is exact."""
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if top < 2 ** 52:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


class CoverTree:
    """Nodes of nested balls over the rows of a matrix.

    The children of a node have centres further apart than half its radius and
    cover its rows; each holds a contiguous range of ``order``. A node whose rows
    do not gather at that distance stays a leaf.
    """

    def __init__(self, points: np.ndarray):
        self.points = points.astype(np.float64)
        self.order = np.arange(len(points))
        self.nodes: list[tuple[int, int, np.ndarray, float, list[int]]] = []
        self._build(0, len(points))

    def _build(self, start: int, end: int) -> int:
        rows = self.points[self.order[start:end]]
        centre = rows[0]
        distances = np.sqrt(((rows - centre) ** 2).sum(axis=1))
        radius, number = float(distances.max()), len(self.nodes)
        children: list[int] = []
        self.nodes.append((start, end, centre, radius, children))
        if end - start > LEAF and radius > 0:
            parts = self._cover(rows, distances, radius / 2)
            if parts:
                self.order[start:end] = self.order[start:end][np.concatenate(parts)]
                for part in parts:
                    children.append(self._build(start, start + len(part)))
                    start += len(part)
        return number

    def _cover(self, rows, distances, reach) -> list[np.ndarray] | None:
        left, parts = np.arange(len(rows)), []
        while len(left):
            near = distances <= reach
            parts.append(left[near])
            left = left[~near]
            if len(parts) > max(2, len(rows) // 3):
                return None
            if len(left):
                distances = np.sqrt(((rows[left] - rows[left[0]]) ** 2).sum(axis=1))
        return parts if len(parts) > 1 else None


def _norm(v: np.ndarray) -> float:
    return float(np.sqrt(v @ v))


class Search:
    """Best scores of every query (rows of ``queries``) among the rows of ``data``."""

    def __init__(self, queries, query_ids, bounds, data, data_ids, k):
        self.queries, self.query_ids = queries, query_ids
        self.data, self.data_ids, self.k = data, data_ids, k
        self.kth = bounds.astype(np.float64)  # lower bounds of the k-th scores
        self.bounds = bounds
        self.best: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, np.int64),) * 2 for _ in query_ids]

    def run(self):
        self.q, self.d = CoverTree(self.queries), CoverTree(self.data)
        self._visit(0, 0)
        return self.best

    def _bound(self, a, b) -> float:
        (_, _, x, rx, _), (_, _, y, ry, _) = a, b
        top = float(x @ y) + rx * _norm(y) + ry * _norm(x) + rx * ry
        return top + 1e-9 * abs(top) + 1.0

    def _visit(self, i: int, j: int) -> None:
        a, b = self.q.nodes[i], self.d.nodes[j]
        group = self.q.order[a[0]:a[1]]
        if self._bound(a, b) < self.kth[group].min():
            return
        if not a[4] and not b[4]:
            self._leaves(group, self.d.order[b[0]:b[1]])
        elif b[4] and (not a[4] or b[3] > 2 * a[3]):  # tight query groups first: their worst score is higher
            for _, child in sorted(((-self._bound(a, self.d.nodes[c]), c) for c in b[4])):
                self._visit(i, child)
        else:
            for child in a[4]:
                self._visit(child, j)

    def _leaves(self, group, rows) -> None:
        scores, ids = products(self.queries[group], self.data[rows]), self.data_ids[rows]
        for q, row in zip(group, scores):
            open_ = (row >= max(self.kth[q], self.bounds[q])) & (ids != self.query_ids[q])
            if open_.any():
                found = np.concatenate([self.best[q][0], row[open_]])
                names = np.concatenate([self.best[q][1], ids[open_]])
                first = np.lexsort((names, -found))[:self.k]
                self.best[q] = (found[first], names[first])
                if len(first) == self.k:
                    self.kth[q] = max(self.kth[q], float(found[first[-1]]))


def _assign(centres: np.ndarray, width: int):
    norms = (centres ** 2).sum(axis=1)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            filled = [np.pad(np.asarray(v, np.int64), (0, width - len(v))) for v in batch.column("v").to_pylist()]
            points = np.array(filled, np.float64).reshape(batch.num_rows, width)
            cell = np.argmin(norms[None, :] - 2 * points @ centres.T, axis=1)
            away = np.sqrt(((points - centres[cell]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(filled, pa.list_(pa.int64())), batch.column("is_query"),
                 pa.array(cell.astype(np.int32)), pa.array(away)], ["vec_id", "v", "is_query", "cell", "away"])
    return assign


_FOUND = "query_id long, cell int, part int, v array<long>, bound long, ids array<long>, scores array<long>"


def _own(k: int):
    """The queries of a part against the part itself; their bound is the k-th score there."""
    def search(part: pa.Table) -> pa.Table:
        ids, data = part.column("vec_id").to_numpy(), _matrix(part.column("v"))
        asked = np.flatnonzero(part.column("is_query").to_numpy(zero_copy_only=False))
        if not len(asked):
            return pa.table([pa.array([], f.type) for f in _FOUND_TYPE], schema=_FOUND_TYPE)
        best = Search(data[asked], ids[asked], np.full(len(asked), _FLOOR), data, ids, k).run()
        cell, number = part.column("cell")[0].as_py(), part.column("part")[0].as_py()
        return pa.table([
            pa.array(ids[asked]), pa.array([cell] * len(asked), pa.int32()), pa.array([number] * len(asked), pa.int32()),
            pa.array(list(data[asked]), pa.list_(pa.int64())),
            pa.array([int(s[-1]) if len(s) == k else _FLOOR for s, _ in best], pa.int64()),
            pa.array([n for _, n in best], pa.list_(pa.int64())),
            pa.array([s for s, _ in best], pa.list_(pa.int64()))], schema=_FOUND_TYPE)
    return search


_FOUND_TYPE = pa.schema([("query_id", pa.int64()), ("cell", pa.int32()), ("part", pa.int32()),
                         ("v", pa.list_(pa.int64())), ("bound", pa.int64()), ("ids", pa.list_(pa.int64())),
                         ("scores", pa.list_(pa.int64()))])
_HITS_TYPE = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def _open_cells(centres: np.ndarray, radii: np.ndarray):
    """Adds to every query the cells that may hold a score of at least its bound."""
    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            q = _matrix(batch.column("v")).astype(np.float64)
            top = q @ centres.T + np.sqrt((q ** 2).sum(axis=1))[:, None] * radii[None, :]
            top = np.where(radii[None, :] < 0, -np.inf, top + 1e-9 * np.abs(top) + 1.0)
            cells = [np.flatnonzero(row).astype(np.int32)
                     for row in top >= batch.column("bound").to_numpy()[:, None].astype(np.float64)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.list_(pa.int32()))],
                                             [*batch.schema.names, "cells"])
    return choose


def _others(k: int):
    def search(queries: pa.Table, part: pa.Table) -> pa.Table:
        hits = [[], [], []]
        if queries.num_rows and part.num_rows:
            ids = queries.column("query_id").to_numpy()
            best = Search(_matrix(queries.column("v")), ids, queries.column("bound").to_numpy(),
                          _matrix(part.column("v")), part.column("vec_id").to_numpy(), k).run()
            for q, (scores, names) in zip(ids.tolist(), best):
                hits[0] += [q] * len(names)
                hits[1] += names.tolist()
                hits[2] += scores.tolist()
        return pa.table([pa.array(h, pa.int64()) for h in hits], schema=_HITS_TYPE)
    return search


def top_k(embeddings: DataFrame, k: int = 10, scale: int = 1024, query: str = "vec_id % 100 = 0",
          id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id and score of each query's ``k`` best rows but itself.

    Queries are the rows for which the SQL expression ``query`` holds.
    """
    spark = embeddings.sparkSession
    rows = quantised(embeddings, id_column, vector_column, scale, query)
    # A bounded sample of ids and vectors; every row is indexed.
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "v").select("v").limit(CELLS).collect()
    width = rows.agg(F.max(F.size("v"))).first()[0] or 1
    if not sample:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    centres = np.unique(np.array([np.pad(np.array(r[0], np.float64), (0, width - len(r[0]))) for r in sample]), axis=0)
    placed = stored(rows.mapInArrow(_assign(centres, width),
                                    "vec_id long, v array<long>, is_query boolean, cell int, away double"), "cells")
    # One row per cell, at most ``CELLS``.
    cells = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("away").alias("radius"),
                                       F.count_if("is_query").alias("queries")).collect()
    radii = np.full(len(centres), -1.0)
    for c in cells:
        radii[c["cell"]] = c["radius"]
    sizes = spark.createDataFrame([(c["cell"], groups_for(c["n"], PART)) for c in cells], "cell int, parts int")
    batches = groups_for(sum(c["queries"] for c in cells), QUERIES)
    parts = placed.join(F.broadcast(sizes), "cell").select(
        "vec_id", "v", "is_query", "cell", F.pmod(F.xxhash64("vec_id", "away"), "parts").cast("int").alias("part"))

    own = stored(parts.groupBy("cell", "part").applyInArrow(_own(k), _FOUND), "own-parts")
    # One row per query: a row that repeats was asked as often as it stands there.
    asked = own.groupBy("query_id").agg(F.min(F.struct("v", "cell", "part", "bound", "ids", "scores")).alias("q")).select(
        "query_id", "q.*")
    targets = (asked.select("query_id", "v", "cell", "part", "bound").mapInArrow(_open_cells(centres, radii), "query_id long, v array<long>, cell int, part int, "
                                "bound long, cells array<int>")
               .select("query_id", "v", "bound", F.col("cell").alias("own_cell"), F.col("part").alias("own_part"),
                       F.explode("cells").alias("cell"))
               .join(F.broadcast(sizes), "cell")
               .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
               .filter("NOT (cell = own_cell AND part = own_part)")
               .select("query_id", "v", "bound", "cell", "part",
                       F.pmod(F.xxhash64("query_id"), F.lit(batches)).cast("int").alias("batch")))
    data = parts.withColumn("batch", F.explode(F.sequence(F.lit(0), F.lit(batches - 1)))).select(
        "vec_id", "v", "cell", "part", "batch")
    key = ["cell", "part", "batch"]
    hits = targets.groupBy(*key).cogroup(data.groupBy(*key)).applyInArrow(
        _others(k), "query_id long, vec_id long, score long")
    met = (asked.select("query_id", F.explode(F.arrays_zip("ids", "scores")).alias("hit"))
           .select("query_id", F.col("hit.ids").alias("vec_id"), F.col("hit.scores").alias("score")))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (hits.unionByName(met).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
