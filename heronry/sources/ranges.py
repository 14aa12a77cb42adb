"""Sections of text files too large for a row: a data source whose partitions are ranges of bytes.

A section belongs to the range in which its marker line begins; its task reads
on past the range's end to the next marker. What stands before the first marker
of a range belongs to a section of a range before.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions import text as T
from .fetching import file_system

#: Bytes of a range, and bytes read at once.
RANGE, PIECE = 1 << 26, 1 << 22
_MARKER = re.compile(rb"(?m)^===== FILE: ([^\n]*) =====\r?\n")


@dataclass
class Range(InputPartition):
    """Bytes of a document's file."""

    doc: int
    uri: str
    begin: int
    end: int


class Window:
    """A file's bytes from a line's start on, read as they are asked for; a line end follows the last line."""

    def __init__(self, file, begin: int):
        self.file = file
        self.at = begin - 1 if begin else 0
        file.seek(self.at)
        self.held, self.done = b"", False
        if begin:
            self._skip_line()

    def _skip_line(self) -> None:
        while (end := self.held.find(b"\n")) < 0 and not self.done:
            self.more()
        self.drop(end + 1 if end >= 0 else len(self.held))

    def more(self) -> None:
        piece = self.file.read(PIECE)
        if piece:
            self.held += piece
        else:
            self.done = True
            if self.held and not self.held.endswith(b"\n"):
                self.held += b"\n"

    def drop(self, n: int) -> bytes:
        out, self.held = self.held[:n], self.held[n:]
        self.at += n
        return out

    def marker(self) -> re.Match | None:
        """The next marker line, from where this stands; at its end ``held`` is all that is left."""
        looked = 0
        while True:
            found = _MARKER.search(self.held, looked)
            if found:
                return found
            if self.done:
                return None
            looked = self.held.rfind(b"\n") + 1  # a marker that is cut off begins with the last line
            self.more()


def sections_of(file, begin: int, end: int) -> Iterator[tuple[int, str, str]]:
    """(at, heading, text) of the sections that begin in a range; ``at`` is the place of their marker in the file, -1 before the first."""
    window = Window(file, begin)
    at, heading = (-1, b"") if begin == 0 else (None, b"")
    while True:
        if at is None and window.at >= end:
            return
        found = window.marker()
        body = window.drop(found.start() if found else len(window.held))
        if at is not None:
            yield at, heading.decode(), body.replace(b"\r\n", b"\n").decode()
        if not found or window.at >= end:
            return
        at, heading = window.at, found[1]
        window.drop(found.end() - found.start())


def sections(spark: SparkSession, files: list[tuple[int, str, int]], size: int = RANGE) -> DataFrame:
    """(doc, at, heading, text) of text files (doc, address, length), as :func:`chunk.text_sections` has them of a whole text. Bytes that are not UTF-8 fail."""
    name = f"heronry_{uuid.uuid4().hex}"
    parts = [Range(doc, uri, begin, min(begin + size, length)) for doc, uri, length in files for begin in range(0, length, size)]

    class Sections(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return "doc long, at long, heading string, text string"

        def reader(self, schema) -> DataSourceReader:
            return Reader()

    class Reader(DataSourceReader):
        def partitions(self) -> list[Range]:
            return parts

        def read(self, partition: Range) -> Iterator[tuple]:
            store, path = file_system(partition.uri)
            with store.open_input_file(path) as file:
                for at, heading, text in sections_of(file, partition.begin, partition.end):
                    yield partition.doc, at, heading, text

    if not parts:
        return spark.createDataFrame([], "doc long, at long, heading string, text string")
    spark.dataSource.register(Sections)
    found = spark.read.format(name).load().withColumn("heading", T.trim(F.col("heading")))
    return found.where(~T.blank(F.col("text")) | (F.col("heading") != ""))
