"""Many needles in one pass of each text: an automaton with failure links over all of them."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of needles that one automaton is made of.
MOST_CHARS = 1 << 22
# The code points with the Unicode property White_Space.
SPACES = "".join(map(chr, [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


class Needles:
    """Needles by their place, none of them empty or with a line end, in lower case."""

    def __init__(self, needles: list[str], first: int = 0):
        self.automaton = ahocorasick.Automaton()
        for i, n in enumerate(needles):
            self.automaton.add_word(n, (first + i, len(n)))
        if needles:
            self.automaton.make_automaton()

    def found(self, low: str) -> dict[int, tuple[int, int]]:
        """For each needle in a text in lower case where it stands first and how often, counted from the left without overlap."""
        out: dict[int, tuple[int, int]] = {}
        after: dict[int, int] = {}
        for end, (i, size) in self.automaton.iter(low) if len(self.automaton) else ():
            begin = end - size + 1
            if begin >= after.get(i, 0):
                at, n = out.get(i, (begin, 0))
                out[i] = at, n + 1
                after[i] = end + 1
        return out


class Lines:
    """A text's lines, told by where something stands in the text in lower case."""

    def __init__(self, text: str, low: str):
        self.ends = [m.start() for m in re.finditer("\n", low)]
        self.lines = text.split("\n")

    def cut(self, at: int, most: int) -> str:
        """The line that ``at`` lies in, trimmed, with an ellipsis where it is longer than ``most``."""
        line = self.lines[bisect_left(self.ends, at)].strip(SPACES)
        return line if len(line) <= most else line[:most] + "…"


def matched(files: DataFrame, needles: list[str], snippet: int) -> DataFrame:
    """(file, needle, matches, snippet): a row for each needle, by its place in the list, that a text of ``files`` (file, text) holds."""
    kind = files.select("file").schema.add("needle", "integer").add("matches", "long").add("snippet", "string")
    rows = files.where("text is not null").select("file", "text", F.lower("text").alias("low"))
    return reduce(DataFrame.unionByName, [rows.mapInArrow(_task(part, first, snippet), kind) for first, part in _parts(needles)])


def _parts(needles: list[str]) -> list[tuple[int, list[str]]]:
    parts: list[tuple[int, list[str]]] = [(0, [])]
    chars = 0
    for i, n in enumerate(needles):
        if chars + len(n) > MOST_CHARS and parts[-1][1]:
            parts.append((i, []))
            chars = 0
        parts[-1][1].append(n)
        chars += len(n)
    return parts


def _task(part: list[str], first: int, snippet: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        needles = Needles(part, first)
        for batch in batches:
            row, hits = [], []
            for k, low in enumerate(batch.column("low").to_pylist()):
                found = needles.found(low)
                if found:
                    lines = Lines(batch.column("text")[k].as_py(), low)
                    row += [k] * len(found)
                    hits += [(i, n, lines.cut(at, snippet)) for i, (at, n) in found.items()]
            columns = [pa.array([h[j] for h in hits], t) for j, t in enumerate((pa.int32(), pa.int64(), pa.string()))]
            yield pa.record_batch([batch.column("file").take(pa.array(row, pa.int64())), *columns], names=["file", "needle", "matches", "snippet"])

    return task
