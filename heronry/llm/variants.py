"""Spelling variants: words one edit apart, found by dense tiles of prefix and suffix lengths.

Two words are near if one inserted, deleted or replaced code point makes one
of the other: then, and only then, the lengths of their common prefix and
common suffix add up to the longer length less one, or more. Words stand as
rows of padded matrices of code points, from the left and from the right, and
a tile of rows is compared with another in two array comparisons.

Which tiles meet: for each length L that the shorter word of a pair can have,
a word gives keys. A part of the word is free, at first all of it; it is
halved, and a near pair agrees on its first half (counted from the left) or on
its second (from the right), so each half becomes a key that fixes it and
leaves the other free, until at most FREE code points, or a sixteenth of a
longer word, are. Near pairs share a key; those that share several count at
the one which the length of their common prefix leads to. Rows are sorted by
length and key, and a tile meets those after it as long as the same key goes on.

No pairs leave a task, only each word's number of near words and its best one.
What one key gathers is bounded by the words that differ within FREE code points at one
place, whatever the number of words.

Edge cases: null and empty texts hold no words; repeated rows count each time;
a null id counts as an empty one. Words may have any length and any code
points. Of best words with one frequency the smallest in code-point order is
taken. An empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import discard, written

#: Free code points at which halving ends, and halvings at most.
FREE, HALVINGS = 2, 4
_TILE, _CELLS, _ROWS = 64, 1 << 21, 1 << 14
#: Distinct words that a task counts before it passes its counts on.
_KEPT = 1 << 19
#: Runs of A-Z, a-z and U+00C0 to U+00FF in UTF-8, A-Z in lower case already.
_RUN = re.compile(rb"(?:[a-z]++|(?:\xc3[\x80-\xbf])++)++")
ONE_IN = 97
#: Code points that a word has at least.
LENGTH = 5


def _runs(doc_id: int | None, text: str) -> Counter[bytes]:
    """The runs of a text; in those whose hash ``ONE_IN`` divides, one code point goes."""
    found = Counter(_RUN.findall(text.encode().lower()))
    base = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    cut = {w: found.pop(w) for w in [w for w in found if zlib.crc32(w, base) % ONE_IN == 0]}
    for word, n in cut.items():
        whole = word.decode()
        at = zlib.crc32(word, base) % len(whole)
        found[(whole[:at] + whole[at + 1 :]).encode()] += n
    return found


def words(docs: DataFrame, *, key: str = "doc_id", text: str = "text", least_length: int = LENGTH, least: int = 3) -> DataFrame:
    """(word, n): runs of at least ``least_length`` code points that occur ``least`` times or more in all texts."""

    def rows(counts: Counter[bytes]) -> pa.RecordBatch:
        some = [(w, n) for w, n in ((b.decode(), n) for b, n in counts.items()) if len(w) >= least_length]
        return pa.record_batch([pa.array([w for w, _ in some], pa.string()), pa.array([n for _, n in some], pa.int64())], names=["word", "n"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()
        for batch in batches:
            for i, t in zip(batch.column("key"), batch.column("text"), strict=True):
                for w, n in _runs(i.as_py(), t.as_py() or "").items():
                    total[w] += n
                if len(total) >= _KEPT:
                    yield rows(total)
                    total.clear()
        yield rows(total)

    each = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(task, "word string, n long")
    return each.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def halved(length: int) -> list[tuple[int, int, int]]:
    """(path, start, free) of each key for pairs whose shorter word has ``length``: all but ``free`` code points from ``start`` are fixed.

    A path's binary digits, after a leading 1, tell which half was fixed: 1 the first.
    """
    parts = [(1, 0, length)]
    stop = max(FREE, length >> HALVINGS)
    while parts[0][2] > stop or parts[-1][2] > stop:
        parts = [p for path, at, free in parts for p in (_halves(path, at, free) if free > stop else [(path, at, free)])]
    return parts


def _halves(path: int, at: int, free: int) -> list[tuple[int, int, int]]:
    half = free // 2
    return [(2 * path + 1, at + half, free - half), (2 * path, at, free - half)]


def _path(length: np.ndarray, prefix: np.ndarray) -> np.ndarray:
    """The path of the one key at which a near pair counts."""
    path, at, free = np.ones_like(length), np.zeros_like(length), length.copy()
    stop = np.maximum(FREE, length >> HALVINGS)
    while (more := free > stop).any():
        half = free // 2
        first = prefix >= at + half
        path = np.where(more, 2 * path + first, path)
        at = np.where(more & first, at + half, at)
        free = np.where(more, free - half, free)
    return path


def _keys(word: str, shapes: dict[int, list[tuple[int, int, int]]], least: int = 1) -> Iterator[tuple[int, int, int]]:
    """(key, length, path) of a word, as the shorter one of a pair or of its length, and as the longer one; no word is shorter than ``least``."""
    n = len(word)
    for length in (n, n - 1) if n > least else (n,):
        if length not in shapes:
            shapes[length] = halved(length)
        for path, at, free in shapes[length]:
            fixed = f"{length}:{path}:{word[:at]}\n{word[n - (length - at - free) :]}"
            yield xxhash.xxh3_64_intdigest(fixed.encode("utf-8", "surrogatepass")) - (1 << 63), length, path


def _points(texts: list[str], width: int, pad: int, right: bool) -> np.ndarray:
    """Code points of each text as a row, from the left or from the right, padded."""
    out = np.full((len(texts), width), pad, np.int32)
    for i, t in enumerate(texts):
        row = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.int32)
        out[i, : len(row)] = row[::-1] if right else row
    return out


def _agree(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each pair of rows how many columns agree before the first that does not; there is one, as pads differ."""
    return np.argmin(a[:, None, :] == b[None, :, :], axis=2)


class _Rows:
    """Rows of whole keys, sorted by key, compared in tiles."""

    def __init__(self, key: np.ndarray, length: np.ndarray, path: np.ndarray, n: np.ndarray, word: list[str]):
        again = np.r_[False, key[1:] == key[:-1]]
        kept = np.flatnonzero(again | np.r_[again[1:], False])  # a key of one row has no pair
        self.key, self.length, self.path, self.n = key[kept], length[kept], path[kept], n[kept]
        self.word = [word[i] for i in kept.tolist()]
        self.size = np.array([len(w) for w in self.word], np.int64)

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Near pairs of row numbers, each pair once."""
        wide = self.length > _TILE
        for some, width in ((np.flatnonzero(~wide), _TILE + 2), *((g, int(self.size[g].max()) + 1) for g in _groups(self.key, np.flatnonzero(wide)))):
            yield from self._tiles(some, width)

    def _tiles(self, some: np.ndarray, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        tile = int(min(_TILE, max(1, (_CELLS // width) ** 0.5)))
        tiles = [some[i : i + tile] for i in range(0, len(some), tile)]
        for i, a in enumerate(tiles):
            left, right = self._matrices(a, width, -1)
            if (self.size[a] > self.length[a]).all():
                continue  # in a key shorter words stand first, and of a pair one is
            for j in range(i, len(tiles)):
                b = tiles[j]
                if i < j and self.key[b[0]] != self.key[a[-1]]:
                    break
                x, y = self._matrices(b, width, -2)
                used = max(int(self.size[a].max()), int(self.size[b].max())) + 1
                prefix, suffix = _agree(left[:, :used], x[:, :used]), _agree(right[:, :used], y[:, :used])
                longer = np.maximum(self.size[a][:, None], self.size[b])
                shorter = np.minimum(self.size[a][:, None], self.size[b])
                near = (prefix + suffix >= longer - 1) & (self.key[a][:, None] == self.key[b]) & (shorter == self.length[a][:, None]) & (prefix < longer)
                if i == j:
                    near &= np.arange(len(a))[:, None] < np.arange(len(b))
                p, q = np.nonzero(near)
                its = _path(self.length[a[p]], prefix[p, q]) == self.path[a[p]]
                if its.any():
                    yield a[p[its]], b[q[its]]

    def _matrices(self, at: np.ndarray, width: int, pad: int) -> tuple[np.ndarray, np.ndarray]:
        texts = [self.word[i] for i in at.tolist()]
        return _points(texts, width, pad, False), _points(texts, width, pad, True)

    def best(self) -> pa.RecordBatch:
        """(word, near, best_n, best): for each row of a near pair."""
        found = list(self.pairs())
        if not found:
            return _best([], [], [], [])
        one, other = (np.concatenate([x[i] for x in found]) for i in (0, 1))
        row, mate = np.concatenate([one, other]), np.concatenate([other, one])
        text = np.array(self.word, dtype=object)
        by_word = np.argsort(text, kind="stable")
        place = np.empty(len(text), np.int64)
        place[by_word] = np.arange(len(text))
        order = np.lexsort((place[mate], -self.n[mate], row))
        row, mate = row[order], mate[order]
        first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        return _best(text[row[first]].tolist(), np.diff(np.r_[first, len(row)]), self.n[mate[first]], text[mate[first]].tolist())


def _best(word: list[str], near: Iterable[int], n: Iterable[int], best: list[str]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(word, pa.string()), pa.array(near, pa.int64()), pa.array(n, pa.int64()), pa.array(best, pa.string())], names=["word", "near", "best_n", "best"])


def _groups(key: np.ndarray, some: np.ndarray) -> list[np.ndarray]:
    return np.split(some, np.flatnonzero(np.diff(key[some])) + 1) if len(some) else []


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of rows whose keys stand together, taken in parts that end where a key does."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column("key").to_numpy()
        ends = np.flatnonzero(np.diff(key)) + 1
        if held and (len(ends) or key[0] != held[-1].column("key")[-1].as_py()) and sum(b.num_rows for b in held) >= _ROWS:
            cut = 0 if key[0] != held[-1].column("key")[-1].as_py() else int(ends[0])
            yield _rows([*held, batch.slice(0, cut)]).best()
            held, batch = [], batch.slice(cut)
        held.append(batch)
    if held:
        yield _rows(held).best()


def _rows(parts: list[pa.RecordBatch]) -> _Rows:
    t = pa.Table.from_batches(parts)
    number = lambda c: t.column(c).to_numpy().astype(np.int64)
    return _Rows(number("key"), number("length"), number("path"), number("n"), t.column("word").to_pylist())


def _keyed(least: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shapes: dict[int, list[tuple[int, int, int]]] = {}
        for batch in batches:
            each = [[*_keys(w, shapes, least)] for w in batch.column("word").to_pylist()]
            row = pa.array(np.repeat(np.arange(len(each)), [len(x) for x in each]))
            key, length, path = (pa.array([k[i] for x in each for k in x], kind) for i, kind in ((0, pa.int64()), (1, pa.int32()), (2, pa.int32())))
            yield pa.record_batch([key, length, path, batch.column("n").take(row), batch.column("word").take(row)], names=["key", "length", "path", "n", "word"])

    return task


def near(counted: DataFrame, least_length: int = 1) -> DataFrame:
    """(word, n_near, best_n, best) of the words that have near words; ``counted`` has word and n, each word once, none shorter than ``least_length``."""
    keys = counted.mapInArrow(_keyed(least_length), "key long, length int, path int, n long, word string")
    found = keys.repartition("key").sortWithinPartitions("length", "key", F.char_length("word")).mapInArrow(_compared, "word string, near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))).alias("b")
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), best).select("word", "n_near", (-F.col("b.n")).alias("best_n"), F.col("b.word").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form) without rings: each round a word takes over what its goal knows, so ways halve."""
    known = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        goal = known.select(F.col("word").alias("root"), F.col("root").alias("further"))
        following = written(known.join(goal, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        discard(known)
        known = following.select("word", "root")
        if following.where("moved").isEmpty():
            return known


def grouped(counted: DataFrame, times: int = 2, least_length: int = 1) -> DataFrame:
    """(word, n, n_near, form, form_n, root): a word's form is its most frequent near word if that is ``times`` as frequent."""
    counted = written(counted, "words")
    known = written(near(counted, least_length), "near")
    found = counted.join(known, "word", "left").withColumn("formed", F.col("best_n") >= F.col("n") * times)
    found = found.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(F.col("formed"), F.col("best")).alias("form"), F.when(F.col("formed"), F.col("best_n")).alias("form_n"))
    found = written(found, "forms")
    ends = roots(found.where("form is not null").select("word", "form"))
    return found.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))


