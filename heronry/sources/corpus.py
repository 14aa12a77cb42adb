"""Corpus files: listing, assembling source trees, and ingestion under pinned hashes.

What an ingestion brings is published as a whole: its files and its manifest
are complete in a staging folder before an empty file, ``.commit-<name>``, says
so. From then on they count. They are moved to their places; who finds that
file later, because the driver was lost meanwhile, moves what is left.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import HashMismatch, IngestError, SearchError
from . import fetching
from . import manifest as m
from .fetching import Fetcher, Wanted

_STAGED, _COMMIT = ".staged-", ".commit-"
#: Seconds after which a staging folder that nobody has committed is taken for left behind.
ABANDONED = 86_400


class Folder:
    """A corpus folder in the file system that Spark finds for it."""

    def __init__(self, spark: SparkSession, folder: str):
        self.path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        at = self.path(folder)
        self.fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self.at = self.fs.makeQualified(at)

    def exists(self) -> bool:
        return self.fs.exists(self.at)

    def names(self, of: str = "") -> list[str]:
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.path(self.at, of) if of else self.at))

    def uri(self, name: str) -> str:
        return self.path(self.at, name).toString()

    def move(self, name: str, to: str) -> None:
        """Put a file in its place, whatever is there."""
        target = self.path(self.at, to)
        self.fs.delete(target, False)
        if not self.fs.rename(self.path(self.at, name), target):
            raise IngestError(f"cannot publish {to}")

    def commit(self, turn: str) -> None:
        self.fs.create(self.path(self.at, _COMMIT + turn), False).close()

    def settle(self) -> None:
        """Move the files of committed ingestions to their places; done again or by several at once it does no harm."""
        for mark in [n for n in self.names() if n.startswith(_COMMIT)]:
            staged = _STAGED + mark[len(_COMMIT) :]
            if self.fs.exists(self.path(self.at, staged)):
                for name in self.names(staged):
                    if not name.startswith("."):
                        self.move(f"{staged}/{name}", name)
            self.drop(staged)
            self.drop(mark)

    def drop(self, name: str) -> None:
        self.fs.delete(self.path(self.at, name), True)

    def clean(self) -> None:
        """Remove staging folders that were left behind."""
        for s in self.fs.listStatus(self.at):
            if s.getPath().getName().startswith(_STAGED) and s.getModificationTime() / 1000 < time.time() - ABANDONED:
                self.drop(s.getPath().getName())


def settle(spark: SparkSession, folder: str) -> None:
    """See :meth:`Folder.settle`; whoever reads a corpus folder begins with it."""
    at = Folder(spark, folder)
    if at.exists():
        at.settle()


def files(spark: SparkSession, folder: str, most: int | None = None) -> DataFrame:
    """(file, content) of the folder's own .html and .txt files, without .txt files of over ``most`` bytes, which are not opened. A folder that is not there fails."""
    if not Folder(spark, folder).exists():
        raise SearchError(f"no folder {folder}")
    settle(spark, folder)
    of = lambda kinds: spark.read.format("binaryFile").option("pathGlobFilter", kinds).load(folder)
    found = of("*.{html,txt}") if most is None else of("*.html").unionByName(of("*.txt").where(F.col("length") <= most))
    return found.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")


def lengths(spark: SparkSession, folder: str) -> DataFrame:
    """(file, uri, length) of the files of :func:`files`, without reading them."""
    settle(spark, folder)
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.{html,txt}").load(folder)
    return found.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.col("path").alias("uri"), "length")


def lossy_text(content: Column) -> Column:
    return F.make_valid_utf8(content.cast("string"))


def strict_text(content: Column) -> Column:
    """Fails on bytes that are not UTF-8."""
    return F.validate_utf8(content.cast("string"))


def tree_files(spark: SparkSession, folder: str) -> DataFrame:
    """(name, path, text): all .java and .tla files below ``folder``, a row each; ``path``, the components, is their order."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder).toUri().getPath().rstrip("/")
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.{java,tla}").load(folder)
    name = F.substring_index("path", root + "/", -1)
    return found.select(name.alias("name"), F.split(name, "/").alias("path"), lossy_text(F.col("content")).alias("text"))


def tree(spark: SparkSession, folder: str) -> DataFrame:
    """One row: the files of a tree as text, each after a marker line, in their order.

    The whole tree meets in this row; one that is too large for that is chunked
    from its files, by :func:`plans.index.chunk_tree`.
    """
    part = F.concat(F.lit("===== FILE: "), F.col("name"), F.lit(" =====\n"), F.col("text"), F.lit("\n"))
    parts = F.array_sort(F.collect_list(F.struct("path", part.alias("part"))))
    return tree_files(spark, folder).agg(F.array_join(F.transform(parts, lambda p: p["part"]), "").alias("text"))


def http_fetcher(url: str) -> bytes:
    """The body of a page; other statuses than success are errors."""
    return b"".join(fetching.http_pieces(url))


def local_fetcher(spark: SparkSession) -> Fetcher:
    """Fetches ``file://`` addresses alone: a file's bytes, or a folder as a :func:`tree`."""
    return lambda url: b"".join(fetching.local_pieces(url))


def verify(sources: DataFrame, found: DataFrame) -> DataFrame:
    """(ord, name, expected, actual, action): ``skipped`` where the file there has the pinned hash, else ``fetched``.

    ``found`` has (file, content); only hashes are joined.
    """
    hashes = found.select("file", F.sha2("content", 256).alias("actual"))
    named = sources.withColumn("file", m.file_name(F.col("name"), F.col("format")))
    action = F.when(F.col("hash").isNotNull() & (F.col("hash") == F.col("actual")), "skipped").otherwise("fetched")
    return named.join(hashes, "file", "left").select("ord", "name", F.col("hash").alias("expected"), "actual", action.alias("action"))


def fetched_count(report: DataFrame) -> int:
    return report.where("action = 'fetched'").count()


def ingest(spark: SparkSession, sources: DataFrame, folder: str, fetch: Fetcher | None = None) -> DataFrame:
    """Bring the corpus folder to its manifest: (ord, name, action).

    Sources whose file has its pinned hash are skipped. The others are fetched
    by the executors, one a task, to a folder of their own; ``fetch`` runs there.
    All are verified before anything is published with the resolved manifest
    beside it, so a mismatch leaves the corpus as it was, and whatever stops the
    driver leaves the old corpus or the new one.
    """
    at = Folder(spark, folder)
    at.fs.mkdirs(at.at)
    at.settle()
    at.clean()
    some = any(s.isFile() for s in at.fs.listStatus(at.at))
    report = verify(sources, files(spark, folder) if some else spark.createDataFrame([], "file string, content binary")).orderBy("ord").collect()
    rows = {r["name"]: r for r in sources.withColumn("file", m.file_name(F.col("name"), F.col("format"))).collect()}
    turn = uuid.uuid4().hex
    staged = _STAGED + turn
    at.fs.mkdirs(at.path(at.at, staged))
    try:
        wanted = [Wanted(r["name"], rows[r["name"]]["url"], rows[r["name"]]["file"]) for r in report if r["action"] == "fetched"]
        hashes = fetching.fetched(spark, wanted, at.uri(staged), fetch)
        for w in wanted:
            if rows[w.name]["hash"] is not None and hashes[w.name] != rows[w.name]["hash"]:
                raise HashMismatch(w.name, rows[w.name]["hash"], hashes[w.name])
        pinned = spark.createDataFrame(list(hashes.items()), "name string, found string")
        resolved = m.to_json(sources.join(pinned, "name", "left").withColumn("hash", F.coalesce("found", "hash"))).encode()
        fetching.keep("manifest", at.uri(staged), "manifest.json", lambda _: resolved)
    except BaseException:
        at.drop(staged)
        raise
    at.commit(turn)
    at.settle()
    return spark.createDataFrame([(r["ord"], r["name"], r["action"]) for r in report], "ord int, name string, action string")
