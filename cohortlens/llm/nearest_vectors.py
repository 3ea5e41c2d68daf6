"""Nearest neighbours by a block matrix join with int8 product tiles.

Rows are dealt to stripes by the hash of their id, queries to stripes of their own, and each (row
stripe, query stripe) pair is one cell that Spark cogroups: a stated query set against all rows, in
blocks. In a cell, vectors are int8 codes times a scale, with the norm of what the codes leave out as
their error. Products of code tiles are whole numbers (computed exactly in floating point), so a
pair's distance is known up to both errors and the rounding of a few operations. Pairs whose lower
bound is above the query's tenth upper bound, or its tenth distance so far, go; the rest are recomputed
in doubles on the original vectors. A cell returns each query's best rows in order, and streams of such
lists are merged by heaps. The result is exact: no index, no lost neighbour.

A cell's sides are bounded by ``cell_values`` components whatever the table's size. Of the rows of a
cell that hold one same vector only the k + 1 smallest ids are compared (no other can be among the
first k), so a vector that a third of all rows hold costs no more than any other.

Defined cases: vectors that are null, empty, all zero or hold a null, NaN or infinite component take
no part, neither do rows without an id. Only vectors of one length are compared. Repeated rows are one
row; of several vectors under one id the smallest counts (as arrays are ordered). Ties go to the
smaller id. A query with fewer than k candidates has them all, with none no row. Distances beyond the
range of doubles are infinite. Other columns are not read, whatever their names. Empty tables give
empty results.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CELL_VALUES = 4_000_000  # components in a stripe of rows, and in one of queries
ROW_TILE, QUERY_TILE, PAIRS = 4096, 256, 200_000


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, vector), one row an id, of the rows that take part."""
    v = F.col(vector_col)
    rows = vectors.select(F.col(id_col).alias("id"), v.alias("vector")).where(
        F.col("id").isNotNull() & F.col("vector").isNotNull()
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("vector", lambda x: x != 0))
    many = rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id")  # ids alone are shuffled
    if many.isEmpty():
        return rows
    return rows.join(many, "id", "left_anti").unionByName(rows.join(many, "id", "left_semi").groupBy("id").agg(F.min("vector").alias("vector")))


class Codes:
    """int8 codes of the rows of a matrix, their scale, squared norm and the norm of the rest."""

    def __init__(self, matrix: np.ndarray):
        scale = np.abs(matrix).max(axis=1, initial=0) / 127
        scale = np.where(scale > 0, scale, 1.0)
        self.codes = np.rint(matrix / scale[:, None]).astype(np.int8)
        whole = self.codes.astype(np.float64)
        self.scale = scale
        self.square = (scale * scale) * (whole * whole).sum(axis=1)
        self.rest = np.sqrt(((matrix - scale[:, None] * whole) ** 2).sum(axis=1)) * (1 + 1e-12)

    def tile(self, a: int, b: int) -> np.ndarray:
        """Codes as floating-point numbers in which their products are exact."""
        return self.codes[a:b].astype(np.float32 if 127 * 127 * self.codes.shape[1] < 1 << 24 else np.float64)


def bounds(rows: Codes, r: slice, queries: Codes, q: slice) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the distances of a tile, queries by rows."""
    product = (queries.tile(q.start, q.stop) @ rows.tile(r.start, r.stop).T).astype(np.float64)
    total = queries.square[q, None] + rows.square[None, r]
    square = total - 2 * (queries.scale[q, None] * rows.scale[None, r]) * product
    slack, rest = 1e-14 * total, queries.rest[q, None] + rows.rest[None, r]
    lower = np.sqrt(np.maximum(square - slack, 0)) - rest
    upper = np.sqrt(np.maximum(square, 0) + slack) + rest
    return lower * (1 - np.sign(lower) * 1e-12), upper * (1 + 1e-12)


def distances(columns: np.ndarray, rows: np.ndarray, query_columns: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Euclidean distances in doubles of pairs of column positions, summed from the first component on."""
    out = np.empty(len(rows))
    for a in range(0, len(rows), PAIRS):
        r, q = rows[a:a + PAIRS], queries[a:a + PAIRS]
        total = np.zeros(len(r))
        for x, y in zip(columns, query_columns):
            total += (x[r] - y[q]) ** 2
        out[a:a + PAIRS] = np.sqrt(total)
    return out


def best_of_cell(ids: np.ndarray, matrix: np.ndarray, query_ids: np.ndarray, query_matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query position, id, distance) of the k nearest rows of each query, nearest first."""
    matrix, query_matrix = matrix + 0.0, query_matrix + 0.0  # no negative zeros
    row = np.ascontiguousarray(matrix).view(np.dtype((np.void, 8 * matrix.shape[1]))).ravel()
    _, same = np.unique(row, return_inverse=True)
    order = np.lexsort((ids, same))
    lead = np.flatnonzero(np.concatenate(([True], np.diff(same[order]) != 0)))
    place = np.arange(len(order)) - np.repeat(lead, np.diff(np.append(lead, len(order))))
    order = order[place <= k]
    ids, matrix = ids[order], matrix[order]
    columns, query_columns = np.ascontiguousarray(matrix.T), np.ascontiguousarray(query_matrix.T)
    rows, queries = Codes(matrix), Codes(query_matrix)
    out = []
    for a in range(0, len(query_ids), QUERY_TILE):
        q = slice(a, min(a + QUERY_TILE, len(query_ids)))
        size = q.stop - q.start
        best = np.full(size, np.inf)
        held = np.array([], dtype=np.int64), np.array([], dtype=ids.dtype), np.array([])
        for b in range(0, len(ids), ROW_TILE):
            r = slice(b, min(b + ROW_TILE, len(ids)))
            lower, upper = bounds(rows, r, queries, q)
            own = ids[None, r] == query_ids[q, None]
            upper[own] = np.inf
            limit = best
            if upper.shape[1] > k:
                limit = np.fmin(best, np.partition(upper, k - 1, axis=1)[:, k - 1])
            one, other = np.nonzero(~(lower > limit[:, None]) & ~own)  # a bound that is no number excludes nothing
            score = distances(columns, other + b, query_columns, one + a)
            one, key, score = (np.concatenate(pair) for pair in zip(held, (one, ids[other + b], score)))
            order = np.lexsort((key, score, one))
            one, key, score = one[order], key[order], score[order]
            start = np.searchsorted(one, np.arange(size))
            first = np.arange(len(one)) - start[one] < k
            held = one, key, score = one[first], key[first], score[first]
            full = np.bincount(one, minlength=size) == k
            best[full] = score[np.searchsorted(one, np.arange(size), "right")[full] - 1]
        out.append((held[0] + a, held[1], held[2]))
    return tuple(np.concatenate(column) for column in zip(*out))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
            cell_values: int = CELL_VALUES) -> DataFrame:
    """(query_id, rank, id, score): the k rows of ``vectors`` other than its own (by id) nearest to each
    row of ``queries``, by Euclidean distance."""
    spark = vectors.sparkSession
    kind = dict(vectors.dtypes)[id_col]
    vectors, queries = usable(vectors, id_col, vector_col), usable(queries, id_col, vector_col)
    n, wide = vectors.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("vector")), F.lit(1))).first()
    a_stripe = max(1, cell_values // wide)
    row_stripes = max(-(-n // a_stripe), int(spark.conf.get("spark.sql.shuffle.partitions")))
    query_stripes = max(1, -(-queries.count() // a_stripe))

    def dealt(df: DataFrame, own: str, stripes: int, other: str, copies: int) -> DataFrame:
        return df.select(F.size("vector").alias("wide"), F.pmod(F.xxhash64("id"), F.lit(stripes)).alias(own),
                         F.explode(F.expr(f"sequence(0L, {copies - 1}L)")).alias(other), "id", "vector")

    cell = ["wide", "row_stripe", "query_stripe"]
    by_row = dealt(vectors, "row_stripe", row_stripes, "query_stripe", query_stripes).groupBy(*cell)
    by_query = dealt(queries, "query_stripe", query_stripes, "row_stripe", row_stripes).groupBy(*cell)

    def search(rows: pa.Table, asked: pa.Table) -> pa.Table:
        schema = pa.schema([("query_id", asked["id"].type), ("ids", pa.list_(asked["id"].type)), ("scores", pa.list_(pa.float64()))])
        if not len(rows) or not len(asked):
            return schema.empty_table()
        ids, query_ids = rows["id"].to_numpy(), asked["id"].to_numpy()
        with np.errstate(over="ignore", invalid="ignore"):
            at, found, score = best_of_cell(ids, _matrix(rows["vector"]), query_ids, _matrix(asked["vector"]), k)
        offsets = np.searchsorted(at, np.arange(len(query_ids) + 1))
        lists = [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(c, t)) for c, t in ((found, asked["id"].type), (score, pa.float64()))]
        return pa.Table.from_arrays([pa.array(query_ids, asked["id"].type), *lists], schema=schema)

    lists = by_row.cogroup(by_query).applyInArrow(search, f"query_id {kind}, ids array<{kind}>, scores array<double>")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, best = None, []

        def result(schema: pa.Schema) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([asked] * len(best), schema.field("query_id").type), pa.array(range(1, len(best) + 1), pa.int32()),
                                               pa.array([i for _, i in best], schema.field("query_id").type), pa.array([s for s, _ in best], pa.float64())],
                                              names=["query_id", "rank", id_col, "score"])

        for batch in batches:
            for query, ids, scores in zip(*(batch[c].to_pylist() for c in ("query_id", "ids", "scores"))):
                if query != asked:
                    if best:
                        yield result(batch.schema)
                    asked, best = query, []
                best = [x for x, _ in zip(heapq.merge(best, zip(scores, ids)), range(k))]
            schema = batch.schema
        if best:
            yield result(schema)

    return lists.repartition("query_id").sortWithinPartitions("query_id").mapInArrow(merge, f"query_id {kind}, rank int, `{id_col}` {kind}, score double")


ORACLE_SQL = """
WITH usable AS (
  SELECT vec_id, min(CAST(embedding AS DOUBLE[])) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([x FOR x IN embedding IF x <> 0]) > 0
  GROUP BY vec_id
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_sum([(q.v[i] - c.v[i]) * (q.v[i] - c.v[i]) FOR i IN range(1, len(q.v) + 1)])) AS score
  FROM usable q JOIN usable c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 100 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank, vec_id, score
FROM pairs QUALIFY rank <= 10
"""
