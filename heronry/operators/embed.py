"""Vectors for chunks: only what is new is embedded."""

from __future__ import annotations

import json
import time
import urllib.request
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import Accumulator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import DimensionMismatch, EmbedError
from ..sources.fetching import file_system

Embedder = Callable[[list[str]], list[list[float]]]
MODEL = "nomic-embed-text"
SERVER = "http://localhost:11434"
BATCH = 16
SECONDS = 60
#: Tries of a batch, and seconds before the second one, which double.
TRIES, PAUSE = 4, 0.5
#: Batches of which a task makes one file of a ledger.
FILE_BATCHES = 64


def http_embedder(server: str = SERVER, model: str = MODEL) -> Embedder:
    """Asks a model server: POST {server}/api/embed with {model, input}."""

    def call(inputs: list[str]) -> list[list[float]]:
        body = json.dumps({"model": model, "input": inputs}).encode()
        request = urllib.request.Request(f"{server}/api/embed", body, {"Content-Type": "application/json"})
        try:
            with urllib.request.urlopen(request, timeout=SECONDS) as r:
                found = json.load(r)
        except (OSError, ValueError) as e:
            raise EmbedError(f"no embeddings from {server}: {e}") from e
        if not isinstance(found.get("embeddings"), list):
            raise EmbedError("the answer has no embeddings")
        return found["embeddings"]

    return call


def checked(call: Embedder, inputs: list[str]) -> list[list[float]]:
    """The vectors of ``inputs``, as many as these, all numbers."""
    found = call(inputs)
    if len(found) != len(inputs):
        raise DimensionMismatch(len(inputs), len(found))
    if not all(isinstance(x, (int, float)) for v in found for x in v):
        raise EmbedError("an embedding holds a value that is no number")
    return [[float(x) for x in v] for v in found]


def tried(call: Embedder, inputs: list[str], tries: int = TRIES, pause: float = PAUSE) -> list[list[float]]:
    """:func:`checked`, again after a pause if the call fails; an answer of the wrong shape is not asked for again."""
    for nth in range(tries):
        try:
            return checked(call, inputs)
        except DimensionMismatch:
            raise
        except EmbedError:
            if nth + 1 == tries:
                raise
            time.sleep(pause * 2**nth)
    raise EmbedError("no try was made")


def query_vector(call: Embedder, query: str) -> list[float]:
    found = checked(call, [query])
    if not found:
        raise EmbedError("the embedder returned no vectors")
    return found[0]


def plan(chunks: DataFrame, existing: DataFrame) -> DataFrame:
    """(id, action) for every id on either side: ``reuse``, ``pending`` or ``stale``."""
    ids = chunks.select("id").distinct().withColumn("c", F.lit(True))
    old = existing.select("id").distinct().withColumn("e", F.lit(True))
    action = F.when(F.col("c") & F.col("e"), "reuse").when(F.col("c"), "pending").otherwise("stale")
    return ids.join(old, "id", "full").select("id", action.alias("action"))


class Ledger:
    """Vectors that are done, in a folder that all executors share: what a failed or stopped run made is there for the next one.

    A task writes a file for each FILE_BATCHES batches, and at its end, under a
    name of its own; a file is there whole or not at all. The same id may be in
    two files, of a task that was tried again: either vector will do. ``model``
    names the folder, so vectors of two models do not mix.
    """

    KIND = "id string, embedding array<float>"

    def __init__(self, spark: SparkSession, folder: str, model: str = MODEL):
        self.spark = spark
        name = "".join(c if c.isalnum() or c in "-." else f"_{ord(c):x}_" for c in model)
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
        self.fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self.fs.mkdirs(at)
        self.at, self.uri = at, self.fs.makeQualified(at).toString()

    def done(self) -> DataFrame:
        """(id, embedding) of what is there, each id once."""
        return self.spark.read.schema(self.KIND).parquet(self.uri).dropDuplicates(["id"])

    def clear(self) -> None:
        self.fs.delete(self.at, True)

    def keeping(self, call: Embedder, batch: int, done: Accumulator | None):
        """A task that embeds its rows, writes them here, and gives their ids."""
        uri = self.uri

        def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            store, path = file_system(uri)
            ids: list[str] = []
            vectors: list[list[float]] = []

            def put() -> pa.RecordBatch:
                name = uuid.uuid4().hex
                rows = pa.table({"id": pa.array(ids, pa.string()), "embedding": pa.array(vectors, pa.list_(pa.float32()))})
                with store.open_output_stream(f"{path}/.{name}") as out:
                    pq.write_table(rows, out, compression="zstd")
                store.move(f"{path}/.{name}", f"{path}/{name}.parquet")
                return pa.record_batch([rows.column("id").combine_chunks()], names=["id"])

            try:
                for part in parts:
                    for at in range(0, part.num_rows, batch):
                        some = part.slice(at, batch)
                        vectors += tried(call, some.column("text").to_pylist())
                        ids += some.column("id").to_pylist()
                        if done is not None:
                            done.add(some.num_rows)
                        if len(ids) >= FILE_BATCHES * batch:
                            yield put()
                            ids, vectors = [], []
            except BaseException:
                if ids:
                    put()  # what was made before the failure
                raise
            if ids:
                yield put()

        return work


def at_most(rows: DataFrame, limit: int) -> DataFrame:
    """Rows in so many tasks, each of which makes one call at a time; as they are at 0."""
    return rows.repartition(limit) if limit else rows


def embed(chunks: DataFrame, call: Embedder, existing: DataFrame | None = None, *, batch: int = BATCH, done: Accumulator | None = None, ledger: Ledger | None = None, limit: int = 0) -> DataFrame:
    """(id, embedding) for every chunk id: vectors of ``existing`` are kept, stale ones go, the others are made in batches.

    ``existing`` must be of the same model; leave it out otherwise. Python sees
    pending rows alone. ``done`` counts the rows embedded so far. A call that
    fails is tried again; ``limit`` is the number of calls at once,
    in all tasks. With a ``ledger``, batches are kept as they are made: a run that
    failed leaves its vectors, and the next one embeds only what is not there.
    """
    texts = chunks.select("id", "text").dropDuplicates(["id"])
    pending = texts if existing is None else texts.join(existing.select("id"), "id", "left_anti")
    size = max(batch, 1)
    if ledger is not None:
        missing = pending.join(ledger.done().select("id"), "id", "left_anti")
        at_most(missing, limit).mapInArrow(ledger.keeping(call, size, done), "id string").write.format("noop").mode("overwrite").save()
        made = ledger.done().join(pending.select("id"), "id", "left_semi")
    else:

        def work(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for part in parts:
                for at in range(0, len(part), size):
                    some = part.iloc[at : at + size]
                    yield pd.DataFrame({"id": some["id"], "embedding": tried(call, some["text"].tolist())})
                    if done is not None:
                        done.add(len(some))

        made = at_most(pending, limit).mapInPandas(work, "id string, embedding array<float>")
    if existing is None:
        return made
    return existing.select("id", F.col("embedding").cast("array<float>").alias("embedding")).join(texts.select("id"), "id", "left_semi").unionByName(made)


def dimension(embeddings: DataFrame) -> int:
    """The one length that all vectors have; 0 without vectors."""
    found = embeddings.agg(F.min(F.size("embedding")).alias("low"), F.max(F.size("embedding")).alias("high")).first()
    if found["low"] is not None and found["low"] != found["high"]:
        raise DimensionMismatch(found["low"], found["high"])
    return found["low"] or 0


def report(chunks: DataFrame, embeddings: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """One row: chunks, vectors, reused, dim."""
    reused = chunks.select("id").distinct().join(existing.select("id"), "id", "left_semi").count() if existing is not None else 0
    sizes = embeddings.agg(F.count("*").alias("vectors"), F.coalesce(F.max(F.size("embedding")), F.lit(0)).alias("dim"))
    return chunks.agg(F.count("*").alias("chunks")).crossJoin(sizes).select("chunks", "vectors", F.lit(reused).cast("long").alias("reused"), "dim")
