"""An index that follows a stream of documents: new ones, changed ones, ones that are sent again and ones that go.

Each micro-batch adds a part to three tables: its documents with their versions,
their chunks, and the chunks' words. An empty file then names the part and its
place in the stream; only parts that are so named count, and each batch counts
once, however often it is tried. Of a document the part with its greatest
version holds, of one version the last part. So nothing that is there is ever
rewritten while it is read, and what a reader sees is what building from the
documents as they are now would give. :meth:`StreamIndex.compact` replaces
parts by one with what holds of them, and a file of the same kind says so.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..operators import chunk
from ..operators.search import Bm25, counted

#: A document without content is one that goes.
SCHEMA = "ord long, name string, license string, tier string, format string, content string, version long"
_TABLES = {
    "documents": "ord long, version long, live boolean",
    "chunks": "source_ord long, chunk_ord int, id string, source string, license string, tier string, heading string, tokens int, text string",
    "words": "source_ord long, id string, dl long, terms array<string>, tfs array<int>",
}


class StreamIndex:
    """The index in ``folder``; the stream's own checkpoint is kept there too."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self.named = self.path(f"{self.folder}/parts")
        self.fs = self.named.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self.fs.mkdirs(self.named)

    # Parts

    def _parts(self) -> list[tuple[int, bool, str]]:
        """(place in the stream, whether it replaces all up to there, name) of the parts that count."""
        names = [s.getPath().getName() for s in self.fs.listStatus(self.named) if not s.getPath().getName().startswith(".")]
        found = sorted((int(n.split("-")[1]), n.startswith("all"), n.split("-")[2]) for n in names)
        whole = max((p for p in found if p[1]), default=None)
        return found if whole is None else [whole, *(p for p in found if p[0] > whole[0] and not p[1])]

    def _name(self, at: int, name: str, whole: bool) -> None:
        self.fs.create(self.path(self.named, f"{'all' if whole else 'one'}-{at:018d}-{name}"), True).close()

    def _put(self, table: str, rows: DataFrame, name: str) -> DataFrame:
        """Write a table's rows of a part, and read them back."""
        path = f"{self.folder}/{table}/part={name}"
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(_TABLES[table]).parquet(path)

    def _table(self, table: str) -> DataFrame:
        """The rows of all parts that count, with ``place``, the part's place in the stream."""
        parts = self._parts()
        kind = f"{_TABLES[table]}, part string"
        if not parts:
            return self.spark.createDataFrame([], f"{kind}, place long")
        places = self.spark.createDataFrame([(n, at) for at, _, n in parts], "part string, place long")
        rows = self.spark.read.schema(kind).option("basePath", f"{self.folder}/{table}").parquet(*[f"{self.folder}/{table}/part={n}" for _, _, n in parts])
        return rows.join(F.broadcast(places), "part")  # a row a part

    # Writing

    def upsert(self, docs: DataFrame, batch: int) -> None:
        """Take in a batch of documents (see SCHEMA); one that was taken in before is passed over."""
        if any(at == batch and not whole or at >= batch and whole for at, whole, _ in self._parts()):
            return
        # of a document that a batch has twice the greatest version counts; of one version, one whose text has the greatest hash
        order = F.struct("version", F.col("content").isNotNull().alias("live"), F.xxhash64("content").alias("hash"))
        last = docs.where("ord is not null").groupBy("ord").agg(F.max_by(F.struct(*[c for c in docs.columns if c != "ord"]), order).alias("d")).select("ord", "d.*")
        name = uuid.uuid4().hex
        # texts are shuffled and chunked once: documents need versions alone, and words are counted in the chunks as written
        versions = docs.where("ord is not null").groupBy("ord").agg(F.max(order).alias("d"))
        self._put("documents", versions.select("ord", "d.version", F.col("d.live")), name)
        made = self._put("chunks", chunk.chunks(last.where("content is not null")), name)
        self._put("words", counted(made.select(F.struct("source_ord", "id").alias("id"), "text")).select("id.source_ord", "id.id", "dl", "terms", "tfs"), name)
        self._name(batch, name, False)

    def follow(self, docs: DataFrame) -> StreamingQuery:
        """Take in what a stream of documents has and ends; called again, it goes on from there."""
        return docs.writeStream.foreachBatch(lambda rows, batch: self.upsert(rows, batch)).option("checkpointLocation", f"{self.folder}/checkpoint").trigger(availableNow=True).start()

    def compact(self) -> None:
        """Bring all parts to one. Readers of the parts before may go on; these go with :meth:`clean`."""
        parts = self._parts()
        if len(parts) > 1:
            holding = self._holding()
            documents = self._table("documents").join(holding, ["ord", "place"], "left_semi").select("ord", "version", "live").distinct()
            name = uuid.uuid4().hex
            for table, rows in {"documents": documents, "chunks": self.chunks(), "words": self._current("words").drop("part", "place")}.items():
                self._put(table, rows, name)
            self._name(parts[-1][0], name, True)

    def clean(self) -> None:
        """Delete what no part that counts names. No reader may be at work on older parts, and no batch."""
        held = {n for _, _, n in self._parts()}
        for s in self.fs.listStatus(self.named):
            if s.getPath().getName().split("-")[-1] not in held:
                self.fs.delete(s.getPath(), False)
        for table in _TABLES:
            at = self.path(f"{self.folder}/{table}")
            for s in self.fs.listStatus(at) if self.fs.exists(at) else []:
                if s.getPath().getName().removeprefix("part=") not in held:
                    self.fs.delete(s.getPath(), True)

    # Reading

    def _holding(self) -> DataFrame:
        """(ord, place): the part that holds of each document that is there or has gone."""
        last = F.max_by("place", F.struct("version", "place")).alias("place")
        return self._table("documents").groupBy("ord").agg(last)

    def _current(self, table: str) -> DataFrame:
        holding = self._holding().withColumnRenamed("ord", "source_ord")
        return self._table(table).join(holding, ["source_ord", "place"], "left_semi")

    def chunks(self) -> DataFrame:
        """What :func:`chunk.chunks` gives of the documents as they are."""
        return self._current("chunks").select(*[c.split(" ")[0] for c in _TABLES["chunks"].split(", ")])

    def bm25(self) -> Bm25:
        """Search over the current chunks by the words that are kept."""
        return Bm25(words=self._current("words").select("id", "dl", "terms", "tfs"))

    def count(self) -> int:
        """How many documents there are."""
        rows = self._table("documents")
        return rows.join(self._holding(), ["ord", "place"], "left_semi").where("live").select("ord").distinct().count()
