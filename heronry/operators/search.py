"""Retrieval, for all queries of a table at once; a single query is a table of one row.

Queries are a stated set: they are taken in blocks of ``MOST_QUERIES``, which
reach every task. Each task keeps the k best of every query while it reads its
rows, so what is shuffled for a query is at most k rows a task.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from functools import reduce
from typing import Protocol

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from ..functions import scores as S
from ..functions import text as T
from ..scratch import written
from .best import Best
from .needles import matched
from .order import numbered

#: Takes queries (qid, query); gives (qid, rank, file, matches, snippet).
Searcher = Callable[[DataFrame], DataFrame]

MOST_QUERIES = 1024
#: Hits a query of which a block's are broadcast.
MOST_BROADCAST = 100
TOP = 10
#: Rows scored together in a task.
ROWS = 1024


_HIT = StructType([StructField("q", IntegerType()), StructField("score", DoubleType())])


def _counts(term) -> list[StructField]:
    return [StructField("dl", LongType()), StructField("terms", ArrayType(term)), StructField("tfs", ArrayType(IntegerType()))]


def _hits(kind: StructType) -> StructType:
    return StructType([_HIT["q"], *kind.fields, _HIT["score"]])


def _blocks(queries: DataFrame) -> list[DataFrame]:
    """The queries in blocks small enough to broadcast."""
    n = queries.count()
    if n <= MOST_QUERIES:
        return [queries]
    parts = -(-n // (MOST_QUERIES // 2))
    block = F.pmod(F.xxhash64("qid"), F.lit(parts))
    return [queries.where(block == i) for i in range(parts)]


def asked_terms(queries: DataFrame) -> list[list]:
    """Blocks of (qid, ts), queries with their terms."""
    return [block.select("qid", T.words(F.coalesce("query", F.lit(""))).alias("ts")).collect() for block in _blocks(queries)]


def named(spark: SparkSession, found: DataFrame, qids: list, kind: StructType) -> DataFrame:
    """Hits of numbered queries with the queries' own ids."""
    names = spark.createDataFrame(list(enumerate(qids)), StructType([StructField("q", IntegerType()), *kind.fields]))
    return found.join(F.broadcast(names), "q").drop("q")  # a block's queries


def ranked(hits: DataFrame, order: list[Column], k: int, name: str = "rank") -> DataFrame:
    """The first ``k`` hits of each query; ``name`` counts from 1."""
    w = Window.partitionBy("qid").orderBy(*order)
    return hits.withColumn(name, F.row_number().over(w)).where(F.col(name) <= k)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _in_order(products: np.ndarray) -> np.ndarray:
    """Sums of the rows, added from left to right."""
    return np.cumsum(products, axis=1)[:, -1] if products.shape[1] else np.zeros(len(products))


def nearest(queries: DataFrame, store: DataFrame, k: int = TOP) -> DataFrame:
    """(qid, rank, id, score): exact cosine, best first, ties by id.

    A matrix product of the block's queries and a batch of vectors finds the
    rows that may be among the best; their scores are then added up in order,
    so that they do not depend on how rows are dealt.
    """
    found = []
    kind = store.select("id")
    arrow = pa.int64() if kind.schema["id"].dataType.typeName() == "long" else pa.string()
    for block in _blocks(queries):
        asked = [r for r in block.select("qid", F.col("vector").cast("array<double>").alias("v")).collect() if r["v"] is not None]
        by_size: dict[int, list[int]] = {}
        for i, r in enumerate(asked):
            by_size.setdefault(len(r["v"]), []).append(i)
        groups = {n: (np.array(at), np.array([asked[i]["v"] for i in at], np.float64).reshape(len(at), n)) for n, at in by_size.items()}

        def task(batches: Iterator[pa.RecordBatch], groups=groups, n=len(asked)) -> Iterator[pa.RecordBatch]:
            best = Best(n, k)
            lengths = {size: np.sqrt(_in_order(vs * vs)) for size, (_, vs) in groups.items()}
            for batch in batches:
                sizes = pc.list_value_length(batch.column("embedding")).to_numpy(zero_copy_only=False)
                for size, (at, vs) in groups.items():
                    part = batch.take(pa.array(np.flatnonzero(sizes == size)))
                    if not part.num_rows:
                        continue
                    rows, norms, ids = _matrix(part.column("embedding")), part.column("norm").to_numpy(zero_copy_only=False), part.column("id")
                    for low in range(0, len(rows), ROWS):
                        some, weight = rows[low : low + ROWS], norms[low : low + ROWS]
                        whole = lengths[size][:, None] * weight
                        about = np.divide(vs @ some.T, whole, out=np.zeros(whole.shape), where=whole != 0)
                        for j, q in enumerate(at.tolist()):
                            near = best.candidates(q, about[j], 1e-9)
                            if len(near):
                                dot = _in_order(vs[j] * some[near])
                                exact = np.divide(dot, whole[j, near], out=np.zeros(len(near)), where=whole[j, near] != 0)
                                best.add(q, exact.tolist(), ids.take(pa.array(near + low)).to_pylist())
            yield from best.batches(arrow)

        hits = store.select("id", "embedding", "norm").where("embedding is not null").mapInArrow(task, _hits(kind.schema))
        found.append(named(store.sparkSession, hits, [r["qid"] for r in asked], block.select("qid").schema))
    return ranked(reduce(DataFrame.unionByName, found), [F.desc("score"), F.col("id")], k).select("qid", "rank", "id", "score")


def cosine(queries: DataFrame, store: DataFrame, k: int = TOP, tier: str | None = None) -> DataFrame:
    """(qid, rank, store columns, score): exact cosine, best first, ties by id.

    ``queries`` has qid and vector; ``store`` is :func:`store.load`'s. The tier
    is filtered before ranking. A query of another length than the vectors has no hits.
    """
    shown = [c for c in store.columns if c not in ("embedding", "norm")]
    if k <= 0:
        return store.limit(0).select(F.lit(0).alias("qid"), F.lit(0).alias("rank"), *shown, F.lit(0.0).alias("score"))
    rows = store if tier is None else store.where(F.col("tier") == tier)
    hits = nearest(queries, rows, k)
    # only ids and scores are ranked; the hits then fetch their chunks
    return rows.select(shown).join(F.broadcast(hits) if k <= MOST_BROADCAST and queries.count() <= MOST_QUERIES else hits, "id").select("qid", "rank", *shown, "score")


class Bm25:
    """Okapi BM25 over chunks (id, text).

    Equal ids hold equal texts: an id is found once, but each of its rows
    counts in the number of rows, the document frequencies and the mean length.
    ``words`` has a row for each row of ``chunks``: id, dl (its words), terms and tfs (its distinct words and their
    counts). Every search reads all of it; an index that is kept is a :class:`postings.InvertedIndex`.
    """

    def __init__(self, chunks: DataFrame | None = None, *, words: DataFrame | None = None):
        self.chunks, self.words = chunks, counted(chunks) if words is None else words

    @property
    def stats(self) -> DataFrame:
        """One row: n, avgdl."""
        return self.words.agg(F.count("*").alias("n"), F.coalesce(F.sum("dl") / F.greatest(F.count("*"), F.lit(1)), F.lit(0.0)).alias("avgdl"))

    def postings(self) -> DataFrame:
        """(id, term, tf, dl, copies): the inverted list; copies are the rows with this id."""
        each = self.words.select("id", "dl", F.explode(F.arrays_zip(F.col("terms").alias("term"), F.col("tfs").alias("tf"))).alias("p"))
        return each.groupBy("id", F.col("p.term").alias("term"), F.col("p.tf").cast("long").alias("tf"), "dl").agg(F.count("*").alias("copies")).select("id", "term", "tf", "dl", "copies")

    def frequencies(self) -> DataFrame:
        """(term, df): in how many rows each term is."""
        return self.words.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))

    def search(self, queries: DataFrame, k: int = TOP) -> DataFrame:
        """(qid, rank, id, score): best first, ties by id; ``queries`` has qid and query. Only rows with a term of the query count.

        Each row keeps the terms that some query has, once, in a written table; statistics are taken and rows are scored from there.
        """
        spark = self.words.sparkSession
        kind = self.words.select("id").schema
        blocks = asked_terms(queries)
        terms = sorted({t for block in blocks for r in block for t in r["ts"]})
        value_set = pa.array(terms, pa.string())

        if self.chunks is None:
            held = self.words.select("id", "dl", "terms", "tfs").mapInArrow(_kept(value_set), StructType([*kind.fields, *_counts(IntegerType())]))
        else:
            held = worded(self.chunks).mapInArrow(_asked(value_set), StructType([*kind.fields, *_counts(IntegerType())]))
        held = written(held, "words")
        n, total = held.agg(F.count("*"), F.coalesce(F.sum("dl"), F.lit(0))).first()
        df = np.zeros(len(terms))
        for r in held.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # at most the queries' own terms
            df[r["t"]] = r["count"]
        average = max(total / max(n, 1), 1e-9)
        weight = np.log((n - df + 0.5) / (df + 0.5) + 1)
        place = {t: i for i, t in enumerate(terms)}
        found = [named(spark, held.mapInArrow(_score(block, place, weight, average, max(k, 0), kind), _hits(kind)), [r["qid"] for r in block], queries.select("qid").schema) for block in blocks]
        once = reduce(DataFrame.unionByName, found).groupBy("qid", "id").agg(F.max("score").alias("score"))
        return ranked(once, [F.desc("score"), F.col("id")], max(k, 0)).select("qid", "rank", "id", "score")


def worded(chunks: DataFrame) -> DataFrame:
    """(id, ts): the words of each row, in their order."""
    return chunks.select("id", T.words(F.coalesce("text", F.lit(""))).alias("ts"))


def pieces(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    """Batches of ``rows`` at most, so that what a task makes of one stays small however large the batches come."""
    for batch in batches:
        for low in range(0, batch.num_rows, rows):
            yield batch.slice(low, rows)


def _tallied(row: np.ndarray, code: np.ndarray, rows: int, codes: int) -> tuple[pa.Array, np.ndarray, pa.Array]:
    """Where each row's distinct codes begin and end, these codes, and how often each is there."""
    pair, count = np.unique(row * max(codes, 1) + code, return_counts=True)
    ends = np.searchsorted(pair // max(codes, 1), np.arange(rows + 1)).astype(np.int32)
    return pa.array(ends), pair % max(codes, 1), pa.array(count.astype(np.int32))


def _row(batch: pa.RecordBatch, dl: pa.Array, ends: pa.Array, terms: pa.Array, tfs: pa.Array) -> pa.RecordBatch:
    return pa.record_batch([batch.column("id"), dl, pa.ListArray.from_arrays(ends, terms), pa.ListArray.from_arrays(ends, tfs)], names=["id", "dl", "terms", "tfs"])


def counted(chunks: DataFrame) -> DataFrame:
    """(id, dl, terms, tfs): each row's number of words, its distinct words and their counts."""
    kind = chunks.select("id").schema

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            lists = batch.column("ts")
            coded = lists.flatten().dictionary_encode()
            ends, code, tfs = _tallied(pc.list_parent_indices(lists).to_numpy(), coded.indices.to_numpy(), len(lists), len(coded.dictionary))
            yield _row(batch, pc.list_value_length(lists).cast(pa.int64()), ends, coded.dictionary.take(pa.array(code)), tfs)

    return worded(chunks).mapInArrow(task, StructType([*kind.fields, *_counts(StringType())]))


def _asked(value_set: pa.Array):
    """A task that counts, of each row's words, those of ``value_set`` alone, by their place in it."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            lists = batch.column("ts")
            place = pc.index_in(lists.flatten(), value_set=value_set)
            there = pc.is_valid(place)
            ends, code, tfs = _tallied(pc.list_parent_indices(lists).filter(there).to_numpy(), place.filter(there).to_numpy(), len(lists), len(value_set))
            yield _row(batch, pc.list_value_length(lists).cast(pa.int64()), ends, pa.array(code.astype(np.int32)), tfs)

    return task


def _kept(value_set: pa.Array):
    """The same of rows whose words are counted already."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            lists = batch.column("terms")
            place = pc.index_in(lists.flatten(), value_set=value_set)
            there = pc.is_valid(place)
            row = pc.list_parent_indices(lists).filter(there).to_numpy()
            ends = pa.array(np.searchsorted(row, np.arange(len(lists) + 1)).astype(np.int32))
            yield _row(batch, batch.column("dl"), ends, place.filter(there), batch.column("tfs").flatten().filter(there))

    return task


class Uses:
    """Which queries use which terms, how often; terms by their place, uses sorted by term."""

    def __init__(self, block: list, place: dict[str, int]):
        uses = sorted((place[t], q, c) for q, r in enumerate(block) for t, c in Counter(r["ts"]).items())
        self.n, self.term, self.query, self.times = len(block), *(np.array(x, np.int64) for x in (zip(*uses, strict=True) if uses else ([], [], [])))
        self.first = np.searchsorted(self.term, np.arange(len(place) + 1))

    def of(self, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each of ``t``, terms, how many uses it has, and all of these one after another."""
        many = self.first[t + 1] - self.first[t]
        return many, np.repeat(self.first[t] - (np.cumsum(many) - many), many) + np.arange(many.sum())

    def table(self, row: np.ndarray, t: np.ndarray, part: np.ndarray, rows: int) -> np.ndarray:
        """(queries, rows): sums of the parts that terms ``t`` have in their rows; -inf where a query has no term.

        Parts are added as whole numbers of 2**-40, so that a score does not depend on the order of its parts.
        """
        many, use = self.of(t)
        cell = np.repeat(row, many) * self.n + self.query[use]
        score = np.bincount(cell, np.rint(np.repeat(part, many) * self.times[use] * float(1 << 40)), rows * self.n) / float(1 << 40)
        there = np.bincount(cell, minlength=rows * self.n) > 0
        return np.where(there, score, -np.inf).reshape(-1, self.n).T

    def bounds(self, weight: np.ndarray, t: np.ndarray, peak: np.ndarray) -> np.ndarray:
        """For each query the sum of its terms' greatest parts; -inf for a query without any of the terms ``t``."""
        order = np.lexsort((-peak, t))
        t, peak = t[order], peak[order]
        first = np.r_[True, t[1:] != t[:-1]] if len(t) else np.zeros(0, bool)
        t, peak = t[first], peak[first]
        many, use = self.of(t)
        found = np.bincount(self.query[use], np.repeat(weight[t] * peak, many) * self.times[use], self.n)
        return np.where(np.bincount(self.query[use], minlength=self.n) > 0, found * (1 + 1e-9) + 1e-9, -np.inf)


def _score(block: list, place: dict[str, int], weight: np.ndarray, average: float, k: int, kind: StructType):
    """A task that gives the ``k`` best rows of each query of a block."""
    uses = Uses(block, place)
    arrow = pa.int64() if kind["id"].dataType.typeName() == "long" else pa.string()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(uses.n, k)
        for batch in pieces(batches):
            if uses.n and k:
                row = pc.list_parent_indices(batch.column("terms")).to_numpy()
                t, tf = batch.column("terms").flatten().to_numpy(), batch.column("tfs").flatten().to_numpy().astype(np.float64)
                dl = batch.column("dl").to_numpy()[row]
                table = uses.table(row, t, weight[t] * (tf * (S.K1 + 1) / (tf + S.K1 * (1 - S.B + S.B * dl / average))), batch.num_rows)
                for q in np.flatnonzero((table > -np.inf).any(axis=1) & (table.max(axis=1) >= best.least)).tolist():
                    rows = best.candidates(q, table[q])
                    rows = rows[table[q, rows] > -np.inf]
                    best.add(q, table[q, rows].tolist(), batch.column("id").take(pa.array(rows)).to_pylist())
        yield from best.batches(arrow)

    return task


class Ranked(Protocol):
    """What finds (qid, rank, id, score) for (qid, query): :class:`Bm25` or an inverted index."""

    def search(self, queries: DataFrame, k: int = TOP) -> DataFrame: ...


def hybrid(queries: DataFrame, store: DataFrame, bm25: Ranked, k: int = TOP, tier: str | None = None) -> DataFrame:
    """(qid, rank, store columns, score): reciprocal-rank fusion of cosine and BM25 by source, shown by its best chunk.

    ``queries`` has qid, query and vector. Each side brings max(k, 10) * 2
    chunks. The tier is filtered before the cosine ranks, but after the BM25
    ranks, which keep their gaps. Ids alone are ranked and fused; the k hits left fetch their chunks.
    """
    pool = max(k, 10) * 2
    few = pool <= MOST_BROADCAST and queries.count() <= MOST_QUERIES
    small = F.broadcast if few else lambda df: df
    rows = store if tier is None else store.where(F.col("tier") == tier)
    dense = nearest(queries, rows, pool).select("qid", "id", F.col("rank").alias("dense"), F.lit(None).cast("int").alias("words"))
    words = bm25.search(queries, pool).select("qid", "id", F.lit(None).cast("int").alias("dense"), F.col("rank").alias("words"))
    hits = rows.select("id", "source").join(small(dense.unionByName(words)), "id")
    side = lambda name: [F.min(name).alias(f"{name}_rank"), F.min_by("id", name).alias(f"{name}_id")]
    both = hits.groupBy("qid", "source").agg(*side("dense"), *side("words"))
    share = lambda name: F.coalesce(S.rrf(F.col(f"{name}_rank") - 1), F.lit(0.0))
    fused = both.select("qid", F.col("source").alias("__source"), (share("dense") + share("words")).alias("score"), F.coalesce("dense_id", "words_id").alias("id"))
    top = ranked(fused, [F.desc("score"), F.col("__source")], max(k, 0)).drop("__source")
    shown = [c for c in store.columns if c not in ("embedding", "norm")]
    return store.select(shown).join(small(top), "id").select("qid", "rank", *shown, "score")


def fulltext(queries: DataFrame, files: DataFrame, snippet: int = 240, k: int | None = None) -> DataFrame:
    """(qid, rank, file, matches, snippet): files by their number of matches, ties by name; every match counts.

    ``queries`` has qid and query; ``files`` has file and text. A blank query has no hits. All hits are ranked, by
    range and not in a task a query; with ``k`` the first ones alone, and each task passes on no more.
    """
    asked = queries.select("qid", F.lower(T.trim(F.col("query"))).alias("low")).where("low <> ''").collect()  # a stated set
    needles = sorted({r["low"] for r in asked if "\n" not in r["low"]})  # a query that spans lines has no match
    place = {n: i for i, n in enumerate(needles)}
    names = queries.sparkSession.createDataFrame([(r["qid"], place[r["low"]]) for r in asked if r["low"] in place], StructType([queries.schema["qid"], StructField("needle", IntegerType())]))
    hits = matched(files, needles, snippet).join(F.broadcast(names), "needle").drop("needle")  # the queries that were collected
    order = [F.desc("matches"), F.col("file")]
    return (numbered(hits, "qid", order) if k is None else ranked(hits, order, k)).select("qid", "rank", "file", "matches", "snippet")
