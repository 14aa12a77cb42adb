"""Exact top-k search by inner product over vector-approximation files.

Vectors are whole numbers, held as doubles. The file keeps for each vector, in
blocks of rows, the cell of each component on a grid of 2**bits cells between
the component's least and greatest value, in one byte; the exact vectors lie
beside them in columns that a scan of the cells does not read. The middles of
the cells give a score up to a slack that depends on the query alone, so each
row has a lower and an upper bound, in one order. Each block of queries meets
each block of cells once, and sends on the rows whose upper bound reaches the
k-th best lower bound there; those of all blocks are cut once more at the k-th
best lower bound of all. Exact vectors are then read in the order of the
bounds: first the k best of each query, whose k-th exact score tells which of
the others can still reach it, then these.

Of rows with one and the same vector, those of the k + 1 smallest ids are kept
in the file, at most k of an id: no more can be among the k best of a query.

Edge cases: vectors that are null, or hold null, NaN or infinite components,
and rows with a null id take no part. Vectors of different length are not
compared. A query's own id is no candidate for it. Rows that repeat an id are
candidates like any other; query rows that repeat one share a ranking of k.
Scores are exact whatever the size of the components; one beyond 64 bits is
the nearest long. Ties go to the smaller id. With fewer candidates than k all
are returned; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import written

BITS = 8
Grids = dict[int, tuple[np.ndarray, np.ndarray]]
#: Queries and rows scored together inside a task.
_QUERIES, _ROWS = 256, 8192


def scaled(vector: Column, factor: int = 64) -> Column:
    """floor(factor * x) of each component, a whole number in double; null for vectors that take no part."""
    wrong = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = lambda y: F.when(F.abs(y) < float(1 << 52), F.floor(y).cast("double")).otherwise(y)
    return F.when(~wrong, F.transform(vector, lambda x: whole(x.cast("double") * factor)))


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(column, pa.ChunkedArray):
        column = column.chunk(0)
    return column.flatten().to_numpy().reshape(len(column), -1)


def vectors_of(rows: DataFrame, *, key: str, vector: str) -> DataFrame:
    """(row, id, v, dim) of the vectors that take part, a written table; ``row`` tells rows apart."""
    some = rows.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"), F.size(vector).alias("dim")).where("id is not null and v is not null")
    return written(some.select(F.monotonically_increasing_id().alias("row"), "*"), "vectors")


def few_copies(vectors: DataFrame, k: int) -> DataFrame:
    """Of the rows with one vector, those that a query can have among its ``k`` best."""
    of_id = Window.partitionBy("v", "id").orderBy("row")
    of_vector = Window.partitionBy("v").orderBy("id")
    some = vectors.withColumn("nth", F.row_number().over(of_id)).where(F.col("nth") <= k)
    return some.withColumn("nth", F.dense_rank().over(of_vector)).where(F.col("nth") <= k + 1).drop("nth")


def grid(low: np.ndarray, high: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Least value and cell width of each component."""
    return low, np.maximum(np.ceil((high - low + 1) / (1 << bits)), 1.0)


def approximations(vectors: DataFrame, *, k: int, block_rows: int = 32_768, bits: int = BITS) -> tuple[DataFrame, Grids]:
    """The file (row, id, dim, block, cells, v) for searches of up to ``k``, and for each length of vectors the grid."""
    rows = written(few_copies(vectors, k), "rows")
    ranges = rows.select("dim", F.posexplode("v").alias("i", "x")).groupBy("dim", "i").agg(F.min("x").alias("low"), F.max("x").alias("high")).orderBy("dim", "i").collect()
    grids: Grids = {}
    for dim in {r["dim"] for r in ranges}:
        of = [r for r in ranges if r["dim"] == dim]
        grids[dim] = grid(np.array([r["low"] for r in of]), np.array([r["high"] for r in of]), bits)
    sizes = {r["dim"]: r["count"] for r in rows.groupBy("dim").count().collect()}
    tasks = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = {d: max(math.ceil(n / block_rows), min(tasks, math.ceil(n / 2048))) for d, n in sizes.items()}
    block = F.pmod(F.xxhash64("row"), F.create_map(*[F.lit(x) for p in blocks.items() for x in p])[F.col("dim")]).cast("int") if blocks else F.lit(0)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, lists = batch.column("dim").to_numpy(), batch.column("v")
            out: list[bytes] = [b""] * len(dims)
            for dim in np.unique(dims[dims > 0]).tolist():
                at = np.flatnonzero(dims == dim)
                low, width = grids[dim]
                found = np.clip((_matrix(lists.take(pa.array(at))) - low) // width, 0, (1 << bits) - 1).astype(np.uint8)
                for i, x in zip(at.tolist(), found, strict=True):
                    out[i] = x.tobytes()
            yield pa.record_batch([*batch.columns, pa.array(out, pa.binary())], names=["row", "id", "v", "dim", "block", "cells"])

    return written(rows.select("row", "id", "v", "dim", block.alias("block")).mapInArrow(cells, "row long, id long, v array<double>, dim int, block int, cells binary"), "cells"), grids


def survivors(queries: np.ndarray, query_ids: np.ndarray, ids: np.ndarray, cells: np.ndarray, grid: tuple[np.ndarray, np.ndarray], k: int) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """Per query the rows whose upper bound reaches the k-th best lower bound and their middle scores; the queries' slacks."""
    low, width = grid
    reach = np.maximum(np.abs(low), np.abs(low + width * 256))
    slack = np.abs(queries) @ ((width - 1) / 2) + np.abs(queries) @ reach * 1e-12
    rows, scores = [np.empty(0, np.int64)] * len(queries), [np.empty(0)] * len(queries)
    for first in range(0, len(ids), _ROWS):
        middle = low + (cells[first : first + _ROWS] + 0.5) * width - 0.5
        for start in range(0, len(queries), _QUERIES):
            about = np.clip(queries[start : start + _QUERIES] @ middle.T, -(2.0**63), 2.0**63)
            for i, line in enumerate(about, start):
                others = np.flatnonzero(ids[first : first + _ROWS] != query_ids[i])
                found, score = np.append(rows[i], others + first), np.append(scores[i], line[others])
                if len(score) > k:
                    keep = score >= np.partition(score, len(score) - k)[len(score) - k] - 2 * slack[i]
                    found, score = found[keep], score[keep]
                rows[i], scores[i] = found, score
    return rows, scores, slack


def inner(a: np.ndarray, b: np.ndarray) -> list[int]:
    """Exact inner products of the rows of ``a`` and ``b``, whole numbers in double; beyond 64 bits the nearest long."""
    if not a.size or np.abs(a).max() * np.abs(b).max() * a.shape[1] < 1 << 53:
        return np.einsum("ij,ij->i", a, b).astype(np.int64).tolist()
    exact = (sum(int(x) * int(y) for x, y in zip(p, q, strict=True)) for p, q in zip(a, b, strict=True))
    return [min(max(x, -(1 << 63)), (1 << 63) - 1) for x in exact]


def _exact(pairs: DataFrame, queries: DataFrame, file: DataFrame) -> DataFrame:
    """``pairs`` (query_row, query_id, row, id) with their exact scores: the vectors of these rows are read."""
    both = pairs.join(file.select("row", F.col("v").alias("b")), "row").join(queries.select(F.col("row").alias("query_row"), F.col("v").alias("a"), "dim"), "query_row")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, scores = batch.column("dim").to_numpy(), np.zeros(batch.num_rows, np.int64)
            for dim in np.unique(dims[dims > 0]).tolist():
                at = np.flatnonzero(dims == dim)
                scores[at] = inner(*(_matrix(batch.column(c).take(pa.array(at))) for c in ("a", "b")))
            yield pa.record_batch([*(batch.column(c) for c in ("query_row", "query_id", "row", "id")), pa.array(scores)], names=["query_row", "query_id", "row", "id", "score"])

    return both.select("query_row", "query_id", "row", "id", "dim", "a", "b").mapInArrow(task, "query_row long, query_id long, row long, id long, score long")


def search(queries: DataFrame, file: DataFrame, grids: Grids, *, k: int, query_rows: int = 8192) -> DataFrame:
    """query_id, rank, id, score. ``queries`` comes from :func:`vectors_of`; ``file`` and ``grids`` from :func:`approximations` for at least ``k``."""
    layout = {r["dim"]: r["blocks"] for r in file.groupBy("dim").agg((F.max("block") + 1).alias("blocks")).collect()}
    parts = {r["dim"]: math.ceil(r["count"] / query_rows) for r in queries.groupBy("dim").count().collect()}
    dims = sorted(layout.keys() & parts.keys())
    if not dims:
        return file.sparkSession.createDataFrame([], "query_id long, rank int, id long, score long")
    of = lambda x: F.create_map(*[F.lit(v) for d in dims for v in (d, x[d])])[F.col("dim")]
    every = lambda x: F.explode(F.sequence(F.lit(0), of(x) - 1))
    known = F.col("dim").isin(dims)
    left = queries.where(known).select("row", "id", "v", "dim", F.pmod(F.xxhash64("row", F.lit("query")), of(parts)).cast("int").alias("part")).select("*", every(layout).alias("block"))
    right = file.where(known).select("row", "id", "cells", "dim", "block").select("*", every(parts).alias("part"))

    def meet(key, q: pa.Table, c: pa.Table) -> pa.Table:
        found, score, slack = [], [], np.empty(0)
        if q.num_rows and c.num_rows:
            dim = key[0].as_py()
            cells = np.frombuffer(b"".join(c["cells"].to_pylist()), np.uint8).reshape(c.num_rows, dim)
            asked = _matrix(q["v"]) if dim else np.zeros((q.num_rows, 0))
            found, score, slack = survivors(asked, q["id"].to_numpy(), c["id"].to_numpy(), cells, grids.get(dim, (np.empty(0),) * 2), k)
        owner = np.repeat(np.arange(len(found)), [len(x) for x in found])
        rows = np.concatenate([np.empty(0, np.int64), *found])
        take = lambda t, c, at: t[c].to_numpy()[at] if len(at) else np.empty(0, np.int64)
        columns = [take(q, "row", owner), take(q, "id", owner), take(c, "row", rows), take(c, "id", rows), np.concatenate([np.empty(0), *score]), slack[owner]]
        return pa.table(columns, names=["query_row", "query_id", "row", "id", "about", "slack"])

    on = ["dim", "part", "block"]
    met = left.groupBy(*on).cogroup(right.groupBy(*on)).applyInArrow(meet, "query_row long, query_id long, row long, id long, about double, slack double")
    local = written(met, "bounds")
    first = Window.partitionBy("query_row").orderBy(F.desc("about"), "id", "row")
    top = local.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= k)
    names = ["query_row", "query_id", "row", "id"]
    sure = written(_exact(top.select(names), queries, file), "sure")
    # with fewer than k others nothing is left out
    known_best = sure.groupBy("query_row").agg(F.min("score").alias("kth"), F.count("*").alias("n"))
    open_ = local.join(known_best, "query_row").where((F.col("about") + F.col("slack") >= F.col("kth")) | (F.col("n") < k))
    rest = _exact(open_.join(sure.select("query_row", "row"), ["query_row", "row"], "left_anti").select(names), queries, file)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return sure.unionByName(rest).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")
