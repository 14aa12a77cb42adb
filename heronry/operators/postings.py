"""A kept inverted index: posting lists dealt by term, in blocks that tell the greatest score in them.

Distinct ids are numbered in their order, so ties by row are ties by id. SPAN
numbers make a span; a block holds what one term has in a span: offsets of rows,
term frequencies, row lengths, and its ``peak``, the greatest saturated
frequency. Blocks are dealt by range of (shard of the term, term, span), so a
frequent term spreads over many files, and a reader of some terms opens their
shards alone and skips row groups without them.

A search goes through the blocks of its terms twice. First without their lists:
document frequencies; for each term its k-th greatest peak, which k rows reach,
and so for each query a score that its k-th hit has at least; and for each span
the sum of its peaks, which no row of it exceeds. A span that no query needs is
skipped. Then the lists of the other spans meet by span, where a query that has
found better rows meanwhile skips spans again, and what is left is scored as
:class:`search.Bm25` scores it, to the same digits.

Rows with a null id are left out. Equal ids hold equal texts: an id is one row, but counts
as often as it is there in frequencies and lengths.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import scores as S
from ..scratch import written
from .best import Best
from .search import TOP, Uses, asked_terms, counted, named, pieces, ranked

SPAN_BITS = 10
#: Words of a table for each shard of its terms, and shards at most.
SHARD_WORDS, MOST_SHARDS = 1 << 26, 1024
#: Terms and rows of which filters are pushed to the files; spans that are broadcast.
_PUSHED, _SPANS = 256, 1 << 20
#: Greater bounds than scores, whatever is lost in rounding.
_SLACK = 1e-9


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by id with a number; of equal ids one, with the number of copies."""
    number, held = TaskContext.get().partitionId() << 33, None
    for batch in pieces(batches):
        whole = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        ids = whole.column("id")
        new = np.r_[True, pa.compute.not_equal(ids.slice(1), ids.slice(0, len(ids) - 1)).to_numpy(zero_copy_only=False)] if len(ids) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        if not len(first):
            continue
        copies = np.add.reduceat(whole.column("copies").to_numpy(), first)
        done = whole.take(pa.array(first))
        at = done.schema.get_field_index("copies")
        done = done.set_column(at, done.schema.field(at), pa.array(copies))  # the field as it came, so that the next batch fits it
        held = done.slice(len(first) - 1)
        out = done.slice(0, len(first) - 1)
        yield _with_rows(out, number)
        number += out.num_rows
    if held is not None:
        yield _with_rows(held, number)


def _with_rows(batch: pa.RecordBatch, number: int) -> pa.RecordBatch:
    names = ("id", "copies", "dl", "terms", "tfs")
    return pa.record_batch([pa.array(np.arange(number, number + batch.num_rows)), *(batch.column(c) for c in names)], names=["row", *names])


def _blocks(bits: int, average: float):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _cut(batches, bits):
            lists = batch.column("terms")
            coded = lists.flatten().dictionary_encode()
            if not len(coded):
                continue
            at, code = pa.compute.list_parent_indices(lists).to_numpy(), coded.indices.to_numpy()
            row, dl, copies = (batch.column(c).to_numpy()[at] for c in ("row", "dl", "copies"))
            tf = batch.column("tfs").flatten().to_numpy()
            order = np.lexsort((row, code, row >> bits))
            row, code, dl, tf, copies = (x[order] for x in (row, code, dl, tf, copies))
            span = row >> bits
            first = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (span[1:] != span[:-1])])
            ends = pa.array(np.r_[first, len(row)].astype(np.int32))
            lists_of = lambda x, kind: pa.ListArray.from_arrays(ends, pa.array(x.astype(kind)))  # noqa: B023, E731
            yield pa.record_batch(
                [
                    coded.dictionary.take(pa.array(code[first])), pa.array(span[first]), pa.array(np.add.reduceat(copies, first)), pa.array(np.maximum.reduceat(saturated(tf, dl, average), first)),
                    lists_of(row & ((1 << bits) - 1), np.int32), lists_of(tf, np.int32), lists_of(dl, np.int64),
                ],
                names=["term", "span", "copies", "peak", "at", "tfs", "dls"],
            )

    return task


def _cut(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Batches cut where a span ends: blocks stay as they are, and a task works on no more than a span."""
    for batch in batches:
        span = batch.column("row").to_numpy() >> bits
        edges = [*np.flatnonzero(np.r_[True, span[1:] != span[:-1]]).tolist(), len(span)] if len(span) else []
        for low, high in zip(edges, edges[1:], strict=False):
            yield batch.slice(low, high - low)


def saturated(tf: np.ndarray, dl: np.ndarray, average: float) -> np.ndarray:
    return tf * (S.K1 + 1) / (tf + S.K1 * (1 - S.B + S.B * dl / average))


class InvertedIndex:
    """The index under ``path``: :meth:`write` makes it, ``InvertedIndex(spark, path)`` reads it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.rows = spark, spark.read.parquet(f"{path}/rows")
        about = spark.read.parquet(f"{path}/about").first()
        self.n, self.total, self.bits, self.shards = about["n"], about["total"], about["bits"], about["shards"]
        self.lists = spark.read.schema("term string, span long, copies long, peak double, at array<int>, tfs array<int>, dls array<long>, shard int").parquet(f"{path}/lists")

    @classmethod
    def write(cls, chunks: DataFrame, path: str, *, bits: int = SPAN_BITS, shards: int | None = None) -> InvertedIndex:
        """Index ``chunks`` (id, text) under ``path``; its description is written last."""
        spark = chunks.sparkSession
        words = written(counted(chunks.where("id is not null")), "words")
        n, total = words.agg(F.count("*"), F.coalesce(F.sum("dl"), F.lit(0))).first()
        shards = shards or min(max(total // SHARD_WORDS, 1), MOST_SHARDS)
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        held = words.select("id", F.lit(1).cast("long").alias("copies"), "dl", "terms", "tfs")
        kind = StructType().add("row", "long", False)
        for f in held.schema.fields:
            kind.add(f)
        dealt = held.repartitionByRange(parts, "id").sortWithinPartitions("id")
        dealt.mapInArrow(_numbered, kind).write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/rows")
        rows = spark.read.schema(kind).parquet(f"{path}/rows")
        made = rows.mapInArrow(_blocks(bits, _average(n, total)), "term string, span long, copies long, peak double, at array<int>, tfs array<int>, dls array<long>")
        made = written(made.withColumn("shard", (F.crc32(F.col("term").cast("binary")) % shards).cast("int")), "blocks")
        order = ["shard", "term", "span"]
        made.repartitionByRange(parts, *order).sortWithinPartitions(*order).write.mode("overwrite").option("compression", "zstd").partitionBy("shard").parquet(f"{path}/lists")
        spark.createDataFrame([(n, total, bits, shards)], "n long, total long, bits int, shards int").coalesce(1).write.mode("overwrite").parquet(f"{path}/about")
        return cls(spark, path)

    @property
    def stats(self) -> DataFrame:
        """One row: n, avgdl."""
        return self.spark.createDataFrame([(self.n, self.total / max(self.n, 1))], "n long, avgdl double")

    def postings(self) -> DataFrame:
        """(id, term, tf, dl, copies)."""
        each = F.explode(F.arrays_zip(F.col("terms").alias("term"), F.col("tfs").alias("tf"))).alias("p")
        return self.rows.select("id", "dl", "copies", each).select("id", F.col("p.term").alias("term"), F.col("p.tf").cast("long").alias("tf"), "dl", "copies")

    def frequencies(self) -> DataFrame:
        """(term, df), from the blocks without their lists."""
        return self.lists.groupBy("term").agg(F.sum("copies").alias("df"))

    def of(self, terms: list[str]) -> DataFrame:
        """The blocks of ``terms``, with their place among these as ``code``: other shards are not opened."""
        found = self.lists.where(F.col("shard").isin(sorted({zlib.crc32(t.encode()) % self.shards for t in terms})))
        if len(terms) <= _PUSHED:
            found = found.where(F.col("term").isin(terms))
        codes = self.spark.createDataFrame(list(enumerate(terms)), "code int, term string")
        return found.join(F.broadcast(codes), "term")  # the queries' own terms

    def search(self, queries: DataFrame, k: int = TOP) -> DataFrame:
        """(qid, rank, id, score), as :meth:`search.Bm25.search`."""
        blocks = asked_terms(queries)
        kind = queries.select("qid").schema
        none = queries.select("qid", F.lit(0).alias("rank"), F.lit(None).cast(self.rows.schema["id"].dataType).alias("id"), F.lit(0.0).alias("score")).limit(0)
        found = [named(self.spark, hits, [r["qid"] for r in block], kind) for block in blocks if (hits := self._searched(block, k)) is not None]
        if not found:
            return none
        top = written(ranked(reduce(DataFrame.unionByName, found), [F.desc("score"), F.col("id")], k).withColumnRenamed("id", "row"), "top")
        rows = self.rows.select("row", "id")
        wanted = [r["row"] for r in top.select("row").distinct().limit(_PUSHED + 1).collect()]
        if len(wanted) <= _PUSHED:
            rows = rows.where(reduce(lambda a, b: a | b, [F.col("row") == r for r in wanted], F.lit(False)))
        return rows.join(F.broadcast(top) if sum(map(len, blocks)) * k <= _SPANS else top, "row").select("qid", "rank", "id", "score")

    def _searched(self, block: list, k: int) -> DataFrame | None:
        """(q, id, score) of the best rows of each task, ``id`` being a row's number."""
        plan = self.bounds(block, k)
        if plan is None:
            return None
        blocks, uses, weight, least = plan
        alive = self.alive(blocks, uses, weight, least)
        lists = blocks.select("span", "code", "peak", "at", "tfs", "dls")
        few = alive.count()
        kept = lists.join(F.broadcast(alive) if few <= _SPANS else alive, "span", "left_semi")
        return kept.repartition("span").sortWithinPartitions("span").mapInArrow(self._score(uses, weight, least, k), "q int, id long, score double")

    def bounds(self, block: list, k: int) -> tuple[DataFrame, Uses, np.ndarray, np.ndarray] | None:
        """The blocks of the queries' terms, the uses of terms, their weights, and for each query a score that its ``k``-th hit has at least."""
        terms = sorted({t for r in block for t in r["ts"]})
        if not terms or k <= 0:
            return None
        blocks = self.of(terms)
        df, high = np.zeros(len(terms)), np.full(len(terms), -np.inf)
        for r in blocks.groupBy("code").agg(F.sum("copies").alias("df")).collect():  # at most the queries' own terms
            df[r["code"]] = r["df"]
        best = Window.partitionBy("code").orderBy(F.desc("peak"))
        for r in blocks.select("code", "peak", F.row_number().over(best).alias("nth")).where(F.col("nth") <= k).where(F.col("nth") == k).collect():
            high[r["code"]] = r["peak"]
        weight = np.log((self.n - df + 0.5) / (df + 0.5) + 1)
        uses = Uses(block, {t: i for i, t in enumerate(terms)})
        least = np.full(uses.n, -np.inf)
        np.maximum.at(least, uses.query, (weight * high)[uses.term] * uses.times)
        return blocks, uses, weight, least * (1 - _SLACK) - _SLACK

    def alive(self, blocks: DataFrame, uses: Uses, weight: np.ndarray, least: np.ndarray) -> DataFrame:
        """Spans in which some query may have a hit: the peaks there add up to what its ``k``-th hit has, or more."""

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in _spans(batches):
                if (uses.bounds(weight, part.column("code").to_numpy(), part.column("peak").to_numpy()) >= least).any():
                    yield pa.record_batch([part.column("span").slice(0, 1)], names=["span"])

        return written(blocks.select("span", "code", "peak").repartition("span").sortWithinPartitions("span").mapInArrow(task, "span long"), "alive")

    def _score(self, uses: Uses, weight: np.ndarray, least: np.ndarray, k: int):
        average, bits = _average(self.n, self.total), self.bits

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best = Best(uses.n, k)
            for part in _spans(batches):
                code = part.column("code").to_numpy()
                there = uses.bounds(weight, code, part.column("peak").to_numpy()) >= np.maximum(least, best.least * (1 - _SLACK) - _SLACK)
                if not there.any():
                    continue
                lists = part.column("at")
                t = code[pa.compute.list_parent_indices(lists).to_numpy()]
                tf, dl, at = (part.column(c).flatten().to_numpy().astype(kind) for c, kind in (("tfs", np.float64), ("dls", np.int64), ("at", np.int64)))
                table = uses.table(at, t, weight[t] * saturated(tf, dl, average), 1 << bits)
                begin = part.column("span")[0].as_py() << bits
                for q in np.flatnonzero(there & (table.max(axis=1) > -np.inf) & (table.max(axis=1) >= best.least)).tolist():
                    rows = best.candidates(q, table[q])
                    rows = rows[table[q, rows] > -np.inf]
                    best.add(q, table[q, rows].tolist(), (rows + begin).tolist())
            yield from best.batches(pa.int64())

        return task

    def read_of(self, queries: DataFrame, k: int = TOP) -> dict[str, int]:
        """How many postings the index has, how many are of the queries' terms, and how many of these stand in spans that are scored."""
        of, scored = 0, 0
        for block in asked_terms(queries):
            plan = self.bounds(block, k)
            if plan is not None:
                blocks, uses, weight, least = plan
                held = blocks.select("span", F.size("at").alias("n"))
                of += held.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
                scored += held.join(self.alive(blocks, uses, weight, least), "span", "left_semi").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        return {"all": self.lists.agg(F.coalesce(F.sum(F.size("at")), F.lit(0))).first()[0], "of_terms": of, "scored": scored}


def _average(n: int, total: int) -> float:
    return max(total / max(n, 1), 1e-9)


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by span, those of one span together."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        span = batch.column("span").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(span)) + 1).tolist(), len(span)]
        for low, high in zip(cuts, cuts[1:], strict=False):
            if held and held[-1].column("span")[-1].as_py() != span[low]:
                yield _one(held)
                held = []
            held.append(batch.slice(low, high - low))
    if held:
        yield _one(held)


def _one(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
