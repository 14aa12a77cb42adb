"""Chunks of documents too large for a row: their sections are rows, and :func:`chunk.merge` runs over them in parts, side by side.

What the fold decides depends on lengths alone, and what it holds is always the
end of the sections' texts, joined by spaces, since it was last empty. So its
state between two sections is a length, of at most MOST characters, and the
heading where that began. A part of a document's sections is then a function
from the length at its beginning to the length and heading at its end; it is
rising or flat in few runs, and mostly constant. The functions of a document's
parts, a row each, are composed in order, which gives every part its beginning,
and with the ends of the texts before it what is held there. Then the parts are
folded, each by itself, and put out their chunks. No task needs more of a
document than a part, and nothing of it comes to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, groupby, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..scratch import step, written
from .chunk import TARGET_TOKENS, WINDOW, text_sections
from .order import numbered
from .search import pieces

#: Sections of a part.
PART = 4096
#: Sections, or chunks, that a task has as Python strings at a time.
FEW = 256
#: Characters that the fold holds at most: an overlap, a space and a section that is not long.
MOST = T.OVERLAP_CHARS + 1 + TARGET_TOKENS * T.CHARS_PER_TOKEN

Section = tuple[str, str]


def _tokens(n):
    return -(-n // T.CHARS_PER_TOKEN)


class Part:
    """What sections do to each length that may be held before them: the length after them, and the heading of that, None if it is the one from before."""

    def __init__(self):
        self.lengths = np.arange(MOST + 1)
        self.headings = np.full(MOST + 1, None, dtype=object)
        self.tail = ""

    def add(self, heading: str, text: str) -> None:
        n, held = len(text), self.lengths
        self.tail = f"{self.tail} {text[-MOST:]}"[-MOST:]
        if _tokens(n) > TARGET_TOKENS:
            self.lengths, self.headings = np.zeros(1, np.int64), np.full(1, "", dtype=object)
            return
        over = _tokens(held) + _tokens(n) > TARGET_TOKENS
        self.lengths = np.where(held == 0, n, np.where(over, np.minimum(held, T.OVERLAP_CHARS) + 1 + n, held + 1 + n))
        self.headings[(held == 0) | over] = heading
        if len(held) > 1 and (self.lengths == self.lengths[0]).all() and (self.headings == self.headings[0]).all():
            self.lengths, self.headings = self.lengths[:1], self.headings[:1]

    def runs(self) -> list[tuple[int, int, int, str | None]]:
        """(where it begins, its length there, its slope, its heading) of each run of the function."""
        out, begin, slope = [], 0, None
        for i in range(1, len(self.lengths) + 1):
            step = int(self.lengths[i] - self.lengths[i - 1]) if i < len(self.lengths) else None
            if step in (0, 1) and slope in (None, step) and self.headings[i] == self.headings[i - 1]:
                slope = step
            else:
                out.append((begin, int(self.lengths[begin]), slope or 0, self.headings[begin]))
                begin, slope = i, None
        return out


def _after(held: int, runs: list[tuple[int, int, int, str | None]]) -> tuple[int, str | None]:
    begin, length, slope, heading = max((r for r in runs if r[0] <= held), key=lambda r: r[0])
    return length + slope * (held - begin), heading


class Fold:
    """The fold itself, from what is held."""

    def __init__(self, held: str = "", heading: str = ""):
        self.held, self.heading = held, heading

    def __call__(self, sections: Iterator[Section]) -> Iterator[Section]:
        for h, t in sections:
            if _tokens(len(t)) > TARGET_TOKENS:
                yield from self.rest()
                yield from ((h, t[i : i + WINDOW]) for i in range(0, len(t), WINDOW))
                self.held, self.heading = "", ""
            elif not self.held:
                self.held, self.heading = t, h
            elif _tokens(len(self.held)) + _tokens(len(t)) > TARGET_TOKENS:
                yield from self.rest()
                self.held, self.heading = f"{self.held[-T.OVERLAP_CHARS :]} {t}", h
            else:
                self.held = f"{self.held} {t}"

    def rest(self) -> Iterator[Section]:
        if self.held:
            yield self.heading, self.held


_ROW = "doc long, part long, place int, heading string, text string, last boolean"


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], Iterator[tuple]]]:
    """Rows sorted by document, part and place: (place, heading, text, last) of each part, read as they come."""
    names = ("doc", "part", "place", "heading", "text", "last")
    rows = (r for b in pieces(batches, FEW) for r in zip(*(b.column(c).to_pylist() for c in names), strict=True))
    for key, some in groupby(rows, key=lambda r: r[:2]):
        yield key, (r[2:] for r in some)


def _functions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (doc, part), rows in _groups(batches):
        made = Part()
        for _, h, t, _ in rows:
            made.add(h, t)
        runs = list(zip(*made.runs(), strict=True))
        kinds = (pa.int64(), pa.int64(), *[pa.list_(pa.int32())] * 3, pa.list_(pa.string()), pa.string())
        yield pa.record_batch([pa.array([v], k) for v, k in zip((doc, part, *map(list, runs), made.tail), kinds, strict=True)], names=["doc", "part", "at", "lengths", "slopes", "headings", "tail"])


def _beginnings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row with place 0 for each part, of what is held at its beginning; functions come sorted by document and part."""
    rows = (r for b in pieces(batches, FEW) for r in b.to_pylist())
    for doc, some in groupby(rows, key=lambda r: r["doc"]):
        held, heading, tail = 0, "", ""
        for r, following in _with_next(some):
            values = (doc, r["part"], 0, heading, tail[len(tail) - held :], following is None)
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.bool_())
            yield pa.record_batch([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=["doc", "part", "place", "heading", "text", "last"])
            held, found = _after(held, list(zip(r["at"], r["lengths"], r["slopes"], r["headings"], strict=True)))
            heading = heading if found is None else found
            tail = f"{tail} {r['tail'].removeprefix(' ')}"[-MOST:]


def _with_next(rows: Iterator) -> Iterator[tuple]:
    before = None
    for r in rows:
        if before is not None:
            yield before, r
        before = r
    if before is not None:
        yield before, None


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (doc, part), rows in _groups(batches):
        _, heading, held, last = next(rows)
        fold = Fold(held, heading)
        found, nth = chain(fold((h, t) for _, h, t, _ in rows), _at_end(fold) if last else ()), 0
        while made := list(islice(found, FEW)):
            n = len(made)
            columns = [pa.array([doc] * n, pa.int64()), pa.array([part] * n, pa.int64()), pa.array(range(nth, nth + n), pa.int64()), *(pa.array([m[i] for m in made], pa.string()) for i in (0, 1))]
            yield pa.record_batch(columns, names=["doc", "part", "nth", "heading", "text"])
            nth += n


def _at_end(fold: Fold) -> Iterator[Section]:
    """What the fold holds when this is read, after all sections."""
    yield from fold.rest()


def merged(sections: DataFrame, part: int = PART) -> DataFrame:
    """(doc, part, nth, heading, text): chunks in the order of part and nth, as :func:`chunk.merge` makes them of a
    document's array of sections. ``sections`` has doc, at (their order), heading and text."""
    filled = sections.where(~T.blank(F.col("text"))).select("doc", "at", "heading", "text")
    with step(sections.sparkSession):  # what numbering has written is read no more
        placed = written(numbered(filled, "doc", [F.col("at")], "place").select("doc", F.floor((F.col("place") - 1) / part).alias("part"), "place", "heading", "text", F.lit(False).alias("last")), "sections")
    in_parts = lambda rows: rows.repartition("doc", "part").sortWithinPartitions("doc", "part", "place")
    functions = in_parts(placed).mapInArrow(_functions, "doc long, part long, at array<int>, lengths array<int>, slopes array<int>, headings array<string>, tail string")
    # a row a part: the functions of one document are composed in one task
    begun = written(functions.repartition("doc").sortWithinPartitions("doc", "part").mapInArrow(_beginnings, _ROW), "beginnings")
    return in_parts(placed.unionByName(begun)).mapInArrow(_folded, "doc long, part long, nth long, heading string, text string")


def chunks(docs: DataFrame, sections: DataFrame, part: int = PART) -> DataFrame:
    """:func:`chunk.chunks` of documents whose sections are rows; ``docs`` has ord, name, license and tier, and a section's doc is an ord."""
    made = merged(sections, part).withColumn("text", T.trim(F.col("text"))).withColumn("id", T.sha256(F.col("text")))
    once = made.groupBy("doc", "id").agg(F.min_by(F.struct("part", "nth", "heading", "text"), F.struct("part", "nth")).alias("c"))  # of one text the first stays
    found = numbered(once.select("doc", "id", "c.*"), "doc", [F.col("part"), F.col("nth")], "place")
    named = docs.select(F.col("ord").alias("doc"), F.col("name").alias("source"), "license", "tier")
    return found.join(named, "doc").select(F.col("doc").alias("source_ord"), (F.col("place") - 1).alias("chunk_ord"), "id", "source", "license", "tier", "heading", T.tokens_of(F.col("text")).alias("tokens"), "text")


def file_sections(files: DataFrame) -> DataFrame:
    """(doc, at, heading, text): the sections of source trees whose files are rows (doc, name, path, text), ``path`` being their order; each file follows a marker line, as :func:`corpus.tree` has it."""
    text = F.coalesce(F.col("text"), F.lit(""))
    whole = F.concat(F.lit("===== FILE: "), F.col("name"), F.lit(" =====\n"), text, F.lit("\n"))
    return files.select("doc", "path", F.posexplode_outer(text_sections(whole)).alias("pos", "s")).where("s is not null").select("doc", F.struct("path", "pos").alias("at"), "s.heading", "s.text")
