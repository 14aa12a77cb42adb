"""Sources fetched by the executors: a data source with a partition for each of them.

A task fetches one source and writes it under a staging folder as it comes, so
neither the driver nor a row ever holds it; what it gives is a row about it.
Files are written through Arrow's file systems, so the folder's store must be
one that these reach from the executors.
"""

from __future__ import annotations

import hashlib
import time
import urllib.request
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..errors import FetchError

#: The bytes of an address, whole or in pieces.
Fetcher = Callable[[str], "bytes | Iterator[bytes]"]
FETCH_SECONDS, PIECE = 60, 1 << 20
#: Tries of an address, and seconds before the second one, which double.
TRIES, PAUSE = 3, 0.5
# What of a source tree is its text, and the line before each file.
TREE = (".java", ".tla")
MARKER = "===== FILE: {} =====\n"


@dataclass(frozen=True)
class Wanted:
    """A source to fetch: its address and the file that it becomes."""

    name: str
    url: str
    file: str


@dataclass
class One(InputPartition):
    """The partition of one source."""

    nth: int


def file_system(uri: str):
    """Arrow's file system for an address as Hadoop writes it, and the path there."""
    from pyarrow import fs

    scheme, colon, rest = uri.partition(":")
    return fs.FileSystem.from_uri(f"{scheme}://{rest}" if colon and rest.startswith("/") and not rest.startswith("//") else uri)


def http_pieces(url: str) -> Iterator[bytes]:
    """The body of a page; other statuses than success are errors."""
    try:
        with urllib.request.urlopen(url, timeout=FETCH_SECONDS) as r:
            while piece := r.read(PIECE):
                yield piece
    except OSError as e:
        raise FetchError(f"cannot fetch {url}: {e}") from e


def local_pieces(url: str) -> Iterator[bytes]:
    """A ``file://`` address alone: a file's bytes, or of a folder all .java and .tla files below it as
    text, each after a marker line, in the order of path components, one at a time."""
    from pyarrow import fs

    if not url.startswith("file://"):
        raise FetchError(f"not a file:// address: {url}")
    store, path = file_system(url)
    about = store.get_file_info(path)
    if about.type == fs.FileType.NotFound:
        raise FetchError(f"cannot read {url}")
    if about.type == fs.FileType.File:
        yield from _pieces(store, path)
        return
    root = path.rstrip("/") + "/"
    found = [f.path for f in store.get_file_info(fs.FileSelector(path, recursive=True)) if f.type == fs.FileType.File and f.path.endswith(TREE)]
    for p in sorted(found, key=lambda p: p[len(root) :].split("/")):
        yield MARKER.format(p[len(root) :]).encode()
        yield b"".join(_pieces(store, p)).decode("utf-8", "replace").encode()
        yield b"\n"


def _pieces(store, path: str) -> Iterator[bytes]:
    with store.open_input_stream(path) as f:
        while piece := f.read(PIECE):
            yield piece


def pieces_of(url: str, fetch: Fetcher | None = None) -> Iterator[bytes]:
    found = fetch(url) if fetch is not None else local_pieces(url) if url.startswith("file://") else http_pieces(url)
    return iter([found]) if isinstance(found, (bytes, bytearray)) else found


def keep(url: str, folder: str, file: str, fetch: Fetcher | None = None) -> str:
    """Write what an address gives to a file of ``folder``; its hash. A file appears whole or not at all."""
    store, path = file_system(folder)
    part, digest = f"{path}/.{uuid.uuid4().hex}", hashlib.sha256()
    with store.open_output_stream(part) as out:
        for piece in pieces_of(url, fetch):
            digest.update(piece)
            out.write(piece)
    store.move(part, f"{path}/{file}")
    return digest.hexdigest()


def tried(wanted: Wanted, folder: str, fetch: Fetcher | None = None, tries: int = TRIES, pause: float = PAUSE) -> tuple[str, str | None, str | None]:
    """(name, hash, error) of one source; an address that cannot be reached is tried again."""
    for nth in range(tries):
        try:
            return wanted.name, keep(wanted.url, folder, wanted.file, fetch), None
        except FetchError as e:
            error = str(e)
            if nth + 1 < tries:
                time.sleep(pause * 2**nth)
    return wanted.name, None, error


def fetched(spark: SparkSession, wanted: list[Wanted], folder: str, fetch: Fetcher | None = None) -> dict[str, str]:
    """Fetch all of ``wanted``, a manifest's sources, to ``folder``, a task each: the hash by name. If any fails, so does the whole."""
    name = f"heronry_{uuid.uuid4().hex}"

    class Sources(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return "name string, hash string, error string"

        def reader(self, schema) -> DataSourceReader:
            return Reader()

    class Reader(DataSourceReader):
        def partitions(self) -> list[One]:
            return [One(i) for i in range(len(wanted))]

        def read(self, partition: One) -> Iterator[tuple]:
            yield tried(wanted[partition.nth], folder, fetch)

    if not wanted:
        return {}
    spark.dataSource.register(Sources)
    rows = spark.read.format(name).load().collect()  # a row a source
    for r in rows:
        if r["error"] is not None:
            raise FetchError(r["error"])
    return {r["name"]: r["hash"] for r in rows}
