"""Approximate cosine search over a kept index: coarse cells, product-quantised rests, exact scores at the end.

Unit vectors are dealt to the nearest of the coarse centres, and what is left of
each is coded in PARTS bytes, one for each stretch of its components. A query
looks into its PROBES nearest cells, where a vector's score is about that of its
centre plus PARTS numbers from a table of the query; of the best by that, AGAIN
for each hit wanted, the vectors themselves are read and scored as
:func:`search.nearest` scores them. Centres and codes are learnt from a bounded
sample (``sample`` rows, by a hash of the id); every row is indexed.

The exact search is the default elsewhere; this one is for stores that are too
large for it. Vectors of another length than most are few, and are searched
exactly. Null vectors are no hits, as there.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scores as S
from ..scratch import written
from .best import Best
from .search import TOP, _blocks, named, nearest, ranked

SAMPLE, MOST_CELLS, PARTS, CODES = 50_000, 4096, 16, 256
#: Share of the cells that a query looks into (vectors without clusters need so many), and vectors that are read for each hit wanted.
PROBED, AGAIN = 0.75, 10
_ROWS = 2048


def _unit(v: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(v, axis=1, keepdims=True)
    return np.divide(v, length, out=np.zeros_like(v), where=length > 0)


def _near(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The nearest centre of each row."""
    return np.argmax(x @ centres.T - (centres * centres).sum(axis=1) / 2, axis=1)


def centres_of(x: np.ndarray, k: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """k-means from ``k`` rows at random; a centre that loses all its rows stays."""
    found = x[np.random.default_rng(seed).permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        at = _near(x, found)
        n = np.bincount(at, minlength=len(found))
        sums = np.zeros_like(found)
        np.add.at(sums, at, x)
        found[n > 0] = sums[n > 0] / n[n > 0, None]
    return found


class Coder:
    """Centres and code books; ``edges`` cuts a vector's components into stretches."""

    def __init__(self, centres: np.ndarray, books: list[np.ndarray]):
        self.centres, self.books = centres, books
        self.edges = np.cumsum([0, *(b.shape[1] for b in books)])

    @classmethod
    def fit(cls, x: np.ndarray, cells: int, parts: int = PARTS) -> Coder:
        centres = centres_of(x, cells)
        rest = x - centres[_near(x, centres)]
        edges = np.linspace(0, x.shape[1], min(parts, x.shape[1]) + 1).astype(int)
        return cls(centres, [centres_of(rest[:, a:b], CODES) for a, b in zip(edges, edges[1:], strict=False)])

    def codes(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cell, code) of unit rows."""
        cell = _near(x, self.centres)
        rest = x - self.centres[cell]
        return cell, np.stack([_near(rest[:, a:b], book) for a, b, book in zip(self.edges, self.edges[1:], self.books, strict=False)], axis=1).astype(np.uint8)

    def tables(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores of queries with each centre, and with each code of each stretch."""
        inner = np.zeros((len(q), len(self.books), CODES))
        for i, (a, b, book) in enumerate(zip(self.edges, self.edges[1:], self.books, strict=False)):
            inner[:, i, : len(book)] = q[:, a:b] @ book.T
        return q @ self.centres.T, inner

    def rows(self) -> list[tuple[str, int, bytes]]:
        return [("centre", i, c.tobytes()) for i, c in enumerate(self.centres)] + [(f"book{i:04d}", j, c.tobytes()) for i, b in enumerate(self.books) for j, c in enumerate(b)]

    @classmethod
    def of(cls, rows: list) -> Coder:
        tables: dict[str, list] = {}
        for r in sorted(rows):
            tables.setdefault(r[0], []).append(np.frombuffer(r[2], np.float64))
        return cls(np.stack(tables.pop("centre")), [np.stack(tables[k]) for k in sorted(tables)])


class CellIndex:
    """The index under ``path``; :meth:`write` makes it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.rows, self.others = spark.read.parquet(f"{path}/rows"), spark.read.parquet(f"{path}/others")
        held = spark.read.parquet(f"{path}/coder").collect()  # centres and code books
        self.coder = Coder.of([tuple(r) for r in held]) if held else None

    @classmethod
    def write(cls, store: DataFrame, path: str, *, cells: int | None = None, sample: int = SAMPLE, parts: int = PARTS) -> CellIndex:
        """Index ``store`` (id, embedding, norm) under ``path``."""
        spark = store.sparkSession
        rows = written(store.select("id", F.col("embedding").cast("array<double>").alias("embedding"), "norm").where("embedding is not null"), "vectors")
        sizes = rows.groupBy(F.size("embedding").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
        dim, n = (sizes["dim"], sizes["count"]) if sizes else (0, 0)
        most = F.size("embedding") == dim
        rows.where(~most).write.mode("overwrite").parquet(f"{path}/others")
        chance = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / float(1 << 30)
        some = rows.where(most & (F.size("embedding") > 0)).where(chance < sample / max(n, 1)).select("embedding").toArrow()  # about ``sample`` rows
        x = _unit(_matrix(some.column("embedding").combine_chunks())) if some.num_rows else np.zeros((0, dim))
        coder = Coder.fit(x, min(cells or max(int(n**0.5), 1), MOST_CELLS, len(x)), parts) if len(x) else None
        spark.createDataFrame(coder.rows() if coder else [], "kind string, nth int, value binary").coalesce(1).write.mode("overwrite").parquet(f"{path}/coder")
        kind = rows.schema.add("cell", "integer").add("code", "binary")
        held = (rows.where(most) if coder else rows.limit(0)).mapInArrow(_coded(coder), kind) if coder else rows.limit(0).select("*", F.lit(0).alias("cell"), F.lit(b"").alias("code"))
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        held.repartitionByRange(tasks, "cell", "id").sortWithinPartitions("cell", "id").withColumn("row", F.monotonically_increasing_id()).write.mode("overwrite").parquet(f"{path}/rows")
        return cls(spark, path)

    def search(self, queries: DataFrame, k: int = TOP, *, probed: float = PROBED, again: int = AGAIN) -> DataFrame:
        """(qid, rank, id, score) of ``queries`` (qid, vector): best first, ties by id."""
        found = [nearest(queries, self.others, k).drop("rank")]
        for block in _blocks(queries) if self.coder is not None and k > 0 else []:
            asked = block.select("qid", F.col("vector").cast("array<double>").alias("v")).where(F.size("vector") == int(self.coder.edges[-1])).collect()  # a block of the stated set
            if asked:
                found.append(self._searched(block, asked, k, probed, again))
        return ranked(reduce(DataFrame.unionByName, found), [F.desc("score"), F.col("id")], k).select("qid", "rank", "id", "score")

    def _searched(self, block: DataFrame, asked: list, k: int, probed: float, again: int) -> DataFrame:
        q = np.array([r["v"] for r in asked], np.float64)
        centre, inner = self.coder.tables(_unit(q))
        probes = max(1, round(probed * len(self.coder.centres)))
        looks = np.zeros(centre.shape, bool)
        np.put_along_axis(looks, np.argsort(-centre, axis=1, kind="stable")[:, :probes], True, axis=1)
        cells = np.flatnonzero(looks.any(axis=0)).tolist()

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best = Best(len(q), k * again)
            for whole in batches:
                for low in range(0, whole.num_rows, _ROWS):
                    batch = whole.slice(low, _ROWS)
                    cell, row = batch.column("cell").to_numpy(), batch.column("row").to_numpy()
                    code = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(len(cell), -1)
                    for j in np.flatnonzero(looks[:, np.unique(cell)].any(axis=1)).tolist():
                        at = np.flatnonzero(looks[j, cell])
                        about = centre[j, cell[at]] + inner[j][np.arange(code.shape[1]), code[at]].sum(axis=1)
                        near = best.candidates(j, about)
                        best.add(j, about[near].tolist(), row[at[near]].tolist())
            yield from best.batches(pa.int64())

        codes = self.rows.where(F.col("cell").isin(cells)).select("cell", "row", "code")
        some = named(self.spark, codes.mapInArrow(task, "q int, id long, score double"), [r["qid"] for r in asked], block.select("qid").schema)
        few = written(ranked(some, [F.desc("score"), F.col("id")], k * again).select("qid", F.col("id").alias("row")), "candidates")
        read = self.rows.where(F.col("cell").isin(cells)).select("row", "id", "embedding", "norm").join(few, "row")
        vectors = block.select("qid", F.col("vector").cast("array<double>").alias("vector"), S.norm(F.col("vector")).alias("length"))
        return read.join(F.broadcast(vectors), "qid").select("qid", "id", S.cosine(F.col("vector"), F.col("embedding"), F.col("length"), F.col("norm")).alias("score"))  # a block of queries


def _matrix(column) -> np.ndarray:
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _coded(coder: Coder):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(low, _ROWS)
                cell, code = coder.codes(_unit(_matrix(batch.column("embedding"))))
                yield pa.record_batch([*batch.columns, pa.array(cell, pa.int32()), pa.array([c.tobytes() for c in code], pa.binary())], names=[*batch.schema.names, "cell", "code"])

    return task


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """(qid, recall): the share of each query's exact hits that were found."""
    both = exact.select("qid", "id").join(found.select("qid", "id", F.lit(1).alias("hit")), ["qid", "id"], "left")
    return both.groupBy("qid").agg(F.avg(F.coalesce("hit", F.lit(0))).alias("recall"))
