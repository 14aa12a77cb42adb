"""Quality classifier by co-training on two views of a document.

One view is the text's content: the frequencies of bytes, of pairs of character
classes and of words, and how words repeat, over the whole text. The other is
the page's metadata alone: language, source, both together, and length. A
logistic regression learns each view from labelled rows. In every round each
view then labels rows of the other: of all unlabelled rows of the table, those
on which it is confident, so many of each class as the labels' proportion asks
for, chosen by a hash. How sure is confident is measured on labelled rows kept
from training; a view that is never that sure of a class hands over none of it.
At the end each view is calibrated on the kept rows, and the calibrated odds
are combined as independent evidence, which is what co-training assumes.

Edge cases: a null text counts as empty; null metadata is a value of its own,
and so is a missing column of lengths. Rows keep their place: none is dropped
or merged by scoring. Ids labelled more than once take the mean label, rounded
up; null labels are ignored; of rows that repeat a labelled id one is learnt
from, that with the least hash of its text. With no labels, or labels of one
class, all rows score the share of good labels (0.5 with none). Columns besides
the named ones are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .rows import slices
from .scratch import written

CLASSES = 8
HASHED = 64
WORDS = 256
SIZES = 24
#: Documents that score less are rejected.
KEEP = 0.5
#: Share of right labels that makes a view confident, among at least so many kept rows.
SURE, SUPPORT = 0.98, 20
#: Rows that are standardised at a time: what is made of training rows stays small beside them.
PIECE = 512
#: Class of each byte: letters, capitals, digits, space, line end, sentence marks, other marks, bytes over 127.
_CLASS = np.array([1 if 65 <= b <= 90 else 0 if 97 <= b <= 122 else 2 if 48 <= b <= 57 else 3 if b in (9, 32) else 4 if b in (10, 13) else 5 if b in b".,;:'?" else 7 if b > 127 else 6 for b in range(256)], np.uint8)


def _letters(text: bytes) -> np.ndarray:
    raw = np.frombuffer(text, np.uint8)
    kinds = _CLASS[raw]
    pairs = np.bincount(kinds[:-1] * np.uint8(CLASSES) + kinds[1:], minlength=CLASSES * CLASSES) if len(raw) > 1 else np.zeros(CLASSES * CLASSES)
    return np.sqrt(np.concatenate([np.bincount(raw, minlength=256), pairs]) / (max(len(raw), 1) + 40))


def content(texts: pa.Array) -> np.ndarray:
    """A row for each text; words are split, numbered and counted for all texts together."""
    n = len(texts)
    words = pc.utf8_split_whitespace(pc.utf8_trim_whitespace(texts))
    coded = words.flatten().dictionary_encode()
    place, doc = coded.indices.to_numpy(), pc.list_parent_indices(words).to_numpy()
    bucket = np.array([zlib.crc32(w.encode()) % WORDS for w in coded.dictionary.to_pylist()], np.int64)
    m = np.maximum(np.bincount(doc, minlength=n), 1)
    hashed = np.bincount(doc * WORDS + bucket[place], minlength=n * WORDS).reshape(n, WORDS) if len(doc) else np.zeros((n, WORDS))
    again = np.flatnonzero((place[1:] == place[:-1]) & (doc[1:] == doc[:-1]))
    different = np.bincount(np.unique(doc * max(len(bucket), 1) + place) // max(len(bucket), 1), minlength=n)
    size = np.maximum(pc.binary_length(texts).to_numpy(zero_copy_only=False), 1)
    shape = np.stack([np.sqrt(np.bincount(doc[again], minlength=n) / m), different / m, 1 / (1 + m), np.log1p(size / m)], axis=1)
    letters = np.stack([_letters(t) for t in texts.cast(pa.binary()).to_pylist()])
    return np.hstack([letters, np.sqrt(hashed / (m[:, None] + 8)), shape]).astype(np.float32)


def metadata(lang: str | None, source: str | None, size: int | None) -> np.ndarray:
    out = np.zeros(2 * HASHED + SIZES + 1, np.float32)
    for name, value in (("lang", lang), ("source", source)):
        out[zlib.crc32(f"{name}={value}".encode()) % HASHED] += 1
    out[HASHED + zlib.crc32(f"{lang} {source}".encode()) % HASHED] = 1
    out[2 * HASHED + (SIZES - 1 if size is None else min(max(size, 0).bit_length(), SIZES - 2))] = 1
    out[-1] = np.log1p(max(size or 0, 0))
    return out


def features(texts: pa.Array, langs: Sequence, sources: Sequence, sizes: Sequence) -> list[np.ndarray]:
    """The two views, a row for each document."""
    return [content(texts), np.stack([metadata(*m) for m in zip(langs, sources, sizes, strict=True)])]


@dataclass
class Logistic:
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray  # the last is the constant

    def odds(self, x: np.ndarray) -> np.ndarray:
        out = np.empty(len(x))
        for at in range(0, len(x), PIECE):
            out[at : at + PIECE] = standard(x[at : at + PIECE], self.mean, self.scale) @ self.weight[:-1] + self.weight[-1]
        return out


def standard(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.clip((x - mean) / scale, -8, 8)


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 3.0, rounds: int = 12) -> Logistic:
    """Newton's method with a ridge penalty on standardised features, summed over pieces of the rows."""
    mean = x.mean(axis=0)
    scale = np.maximum(np.concatenate([x[:, k : k + 64].std(axis=0) for k in range(0, x.shape[1], 64)]), 1e-3)
    w = np.zeros(x.shape[1] + 1)
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        h, slope = np.diag(penalty), -penalty * w
        for at in range(0, len(x), PIECE):
            part = x[at : at + PIECE]
            z = np.hstack([standard(part, mean, scale), np.ones((len(part), 1))]).astype(np.float64)
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            h += (z * (p * (1 - p))[:, None]).T @ z
            slope += z.T @ (y[at : at + PIECE] - p)
        step = np.linalg.solve(h, slope)
        w += step
        if np.abs(step).max() < 1e-4:
            break
    return Logistic(mean, scale, w)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class QualityModel:
    views: list[Logistic] | None
    calibrations: list[Logistic] | None
    prior: float

    def scores(self, found: list[np.ndarray]) -> np.ndarray:
        """Probabilities that documents are good, from their two views."""
        if self.views is None:
            return np.full(len(found[0]), self.prior)
        base = np.log(self.prior / (1 - self.prior))
        calibrated = [c.odds(v.odds(x)[:, None]) for v, c, x in zip(self.views, self.calibrations, found, strict=True)]
        return _sigmoid(sum(calibrated) - (len(calibrated) - 1) * base)

    def score(self, text: str, lang: str | None, source: str | None, size: int | None = None) -> float:
        return float(self.scores(features(pa.array([text]), [lang], [source], [size]))[0])


def confident(odds: np.ndarray, y: np.ndarray, sure: float = SURE, support: int = SUPPORT) -> tuple[float, float]:
    """(least odds of a confident good label, greatest of a confident bad one), measured on labelled rows; infinite where there is none."""
    out = []
    for value, sign in ((1, 1), (0, -1)):
        order = np.argsort(-sign * odds, kind="stable")
        right = np.cumsum(y[order] == value) / np.arange(1, len(y) + 1)
        last = np.flatnonzero((right >= sure) & (np.arange(1, len(y) + 1) >= support))
        out.append(float(odds[order[last[-1]]]) if len(last) else sign * np.inf)
    return out[0], out[1]


@dataclass
class Rows:
    """Training rows of one view."""

    x: np.ndarray
    y: np.ndarray

    def more(self, x: np.ndarray, y: np.ndarray) -> Rows:
        return Rows(np.concatenate([self.x, x]), np.concatenate([self.y, y]))


def taught(other: Rows, found: list[np.ndarray], view: int, labels: np.ndarray) -> Rows:
    """The other view's rows with those that ``view`` has labelled."""
    return other.more(found[1 - view], labels)


def finish(models: list[Logistic], kept: list[np.ndarray], y: np.ndarray, prior: float) -> QualityModel:
    """Each view calibrated on the kept rows."""
    return QualityModel(models, [fit(m.odds(x)[:, None], y, ridge=1.0) for m, x in zip(models, kept, strict=True)], prior)


def learn(
    docs: DataFrame,
    labels: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    size: str = "n_chars",
    label: str = "quality",
    labelled_rows: int = 6000,
    pseudo_rows: int = 1500,
    rounds: int = 2,
) -> QualityModel:
    """Fit on a bounded sample of labelled rows: about ``labelled_rows`` that are labelled, chosen by a hash of the id, and
    ``pseudo_rows`` for each view and round of those that the other view has labelled, out of all rows without a label."""
    graded = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("__id")).agg((F.avg(label) >= 0.5).cast("int").alias("y"))
    chance = F.pmod(F.xxhash64("__id"), F.lit(1 << 30)) / float(1 << 30)
    some = graded.where(chance < labelled_rows / max(graded.count(), 1))
    rows = _inputs(docs, [F.col(key).alias("__id")], text, lang, source, size)
    names = ["text", "lang", "source", "size"]
    one = rows.join(F.broadcast(some), "__id").groupBy("__id").agg(F.any_value("y").alias("y"), F.min_by(F.struct(*names), F.xxhash64(*names)).alias("row"))
    held = F.crc32(F.col("__id").cast("string").cast("binary")) % 4 == 0
    # at most about ``labelled_rows`` rows reach the driver, as features
    found, extra = _collected(one.select("__id", "y", held.alias("held"), "row.*"), ["__id", "y", "held"])
    y, held_out = (np.array(extra[c], t) for c, t in (("y", np.int64), ("held", bool)))
    prior = float(y.mean()) if len(y) else 0.5
    if len(set(y[held_out])) < 2 or len(set(y[~held_out])) < 2:
        return QualityModel(None, None, prior)
    kept = [x[held_out] for x in found]
    own = [Rows(x[~held_out], y[~held_out]) for x in found]
    del found
    models = [fit(r.x, r.y) for r in own]
    pool = rows.join(F.broadcast(some.select("__id")), "__id", "left_anti").select(F.xxhash64("__id", *names).alias("h"), *names)
    for _ in range(rounds):
        limits = [confident(m.odds(x), y[held_out]) for m, x in zip(models, kept, strict=True)]
        chosen = _confident_rows(pool, models, limits, [round(pseudo_rows * (1 - prior)), round(pseudo_rows * prior)], names)
        found, extra = _collected(chosen, ["h", "view", "y"])
        view, given = np.array(extra["view"], np.int64), np.array(extra["y"], np.int64)
        for k in (0, 1):
            at = view == k
            own[1 - k] = taught(own[1 - k], [x[at] for x in found], k, given[at])
        del found
        models = [fit(r.x, r.y) for r in own]
    return finish(models, kept, y[held_out], prior)


def _inputs(docs: DataFrame, keep: list[Column], text: str, lang: str, source: str, size: str) -> DataFrame:
    length = F.col(size).cast("long") if size in docs.columns else F.lit(None).cast("long")
    return docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("text"), F.col(lang).cast("string").alias("lang"), F.col(source).cast("string").alias("source"), length.alias("size"))


def _views(part: pa.RecordBatch) -> list[np.ndarray]:
    return features(part.column("text"), *(part.column(c).to_pylist() for c in ("lang", "source", "size")))


def _collected(rows: DataFrame, extra: list[str]) -> tuple[list[np.ndarray], dict[str, list]]:
    """The two views of ``rows``, few rows, and their other columns, in a fixed order.

    The driver sorts the few rows: a sort by Spark makes the features twice, first for a sample of the keys.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", 1 << 20):
            found = _views(part)
            yield pa.record_batch([*(part.column(c) for c in extra), *(pa.array([r.tobytes() for r in x], pa.binary()) for x in found)], names=[*extra, "a", "b"])

    schema = rows.select(*extra, F.lit(b"").alias("a"), F.lit(b"").alias("b")).schema
    table = rows.mapInArrow(task, schema).toArrow()
    order = pc.sort_indices(table.select(extra), sort_keys=[(c, "ascending") for c in extra])
    place = np.empty(len(order), np.int64)
    place[order.to_numpy()] = np.arange(len(order))
    found = [np.empty((len(order), x.shape[1]), np.float32) for x in features(pa.array([""]), [None], [None], [None])]
    for c, x in zip(("a", "b"), found, strict=True):
        for at, row in zip(place.tolist(), table[c], strict=True):
            x[at] = np.frombuffer(row.as_buffer(), np.float32)
        table = table.drop_columns([c])
    return found, table.take(order).to_pydict()


def _confident_rows(pool: DataFrame, models: list[Logistic], limits: list[tuple[float, float]], wanted: list[int], names: list[str]) -> DataFrame:
    """(h, view, y, columns of ``names``): rows of all of ``pool`` that a view labels, those with the least hashes.

    A first pass over the texts gives hashes and labels alone; a second one reads the few rows that were chosen.
    """
    shared = pool.sparkSession.sparkContext.broadcast((models, limits))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            models, limits = shared.value
            h = part.column("h").to_numpy()
            out: list[tuple[np.ndarray, int, int]] = []
            for k, (model, x, (good, bad)) in enumerate(zip(models, _views(part), limits, strict=True)):
                odds = model.odds(x)
                out += [(np.unique(h[(odds >= good) & (odds > bad)]), k, 1), (np.unique(h[(odds <= bad) & (odds < good)]), k, 0)]
            column = lambda i: pa.array(np.repeat([o[i] for o in out], [len(o[0]) for o in out]), pa.int32())  # noqa: B023, E731
            yield pa.record_batch([pa.array(np.concatenate([o[0] for o in out])), column(1), column(2)], names=["h", "view", "y"])

    said = written(pool.mapInArrow(task, "h long, view int, y int"), "said")
    # hashes are even, so those under this share hold the least ones wanted, and few others
    shares = [(r["view"], r["y"], (wanted[r["y"]] + 10 * wanted[r["y"]] ** 0.5 + 50) / r["count"]) for r in said.groupBy("view", "y").count().collect()]  # four rows at most
    low = reduce(lambda rest, s: F.when((F.col("view") == s[0]) & (F.col("y") == s[1]), s[2]).otherwise(rest), shares, F.lit(0.0))
    first = Window.partitionBy("view", "y").orderBy("h")
    most = F.when(F.col("y") == 1, wanted[1]).otherwise(wanted[0])
    few = said.where(F.col("h") / float(1 << 64) + 0.5 <= low)
    chosen = written(few.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= most).drop("nth").distinct(), "chosen")
    texts = pool.join(F.broadcast(chosen.select("h")), "h", "left_semi").groupBy("h").agg(*[F.first(c).alias(c) for c in names])  # at most 4 * max(wanted) hashes
    return texts.join(F.broadcast(chosen), "h")


def score(docs: DataFrame, model: QualityModel, *, text: str = "text", lang: str = "lang", source: str = "source", size: str = "n_chars", keep: list[Column] | None = None) -> DataFrame:
    """``keep`` and ``score``, the probability that a document is good, for each row."""
    names = docs.select(*(keep or [])).columns
    kept = _inputs(docs, [c.alias(f"__keep{i}") for i, c in enumerate(keep or [])], text, lang, source, size)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            yield pa.record_batch([*part.columns[:-4], pa.array(shared.value.scores(_views(part)), pa.float64())], names=[*names, "score"])

    return kept.mapInArrow(task, docs.select(*(keep or []), F.lit(0.0).alias("score")).schema)
