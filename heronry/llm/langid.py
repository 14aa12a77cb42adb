"""Language identification by words first, then shorter and shorter character n-grams.

A known word scores by its log frequency in each language. An unseen word is
scored by its n-grams of the longest length of which at least one is known,
the mean over the known ones. A text scores the mean over its words; the
language with the smallest mean negative log frequency wins, ties going to the
language with more training rows, then to the smaller name.

Edge cases: null text, empty text and text without a letter give ``und`` and
score 0. With no training rows every text gives ``und``. Rows are never
dropped or merged: repeated rows and null ids each keep their row. Columns
besides the named ones are ignored, whatever they are called.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .rows import slices
from .scratch import written

UNDETERMINED = "und"
LONGEST = 5
PENALTY = 7.0
_RUN = re.compile(r"[^\W\d_]+")


def words(text: str) -> list[str]:
    """Lower-cased runs of letters."""
    found = _RUN.findall(text.lower())
    if text.isascii() or all(map(str.isalpha, found)):
        return found
    return [x for run in found for x in "".join(c if c.isalpha() else " " for c in run).split()]


def grams(word: str, n: int) -> Iterable[str]:
    """A list; one by one for a very long word."""
    padded = f" {word} "
    if len(padded) > 10_000:
        return (padded[i : i + n] for i in range(len(padded) - n + 1))
    return [padded[i : i + n] for i in range(len(padded) - n + 1)]


@dataclass
class Costs:
    """Rows of costs, a column per language, of which only those under PENALTY are held: row i has first[i]..first[i + 1]."""

    first: np.ndarray
    language: np.ndarray
    under: np.ndarray  # cost less PENALTY

    @classmethod
    def of(cls, rows: np.ndarray, languages: np.ndarray, costs: np.ndarray, n: int) -> Costs:
        """``n`` rows, from entries in the order of their rows."""
        return cls(np.searchsorted(rows, np.arange(n + 1)), languages, (np.minimum(costs, PENALTY) - PENALTY).astype(np.float32))


@dataclass
class LanguageModel:
    """tables[0] has words, tables[n] n-grams: text -> row of costs[n]."""

    languages: list[str]
    tables: list[dict[str, int]]
    costs: list[Costs]

    def word_costs(self, words: list[str]) -> np.ndarray:
        """A row for each word: its own costs, or the mean over its known grams of the longest length with any."""
        width = len(self.languages)
        under = np.zeros(len(words) * width)
        rows, sizes, places = ([[] for _ in range(LONGEST + 1)] for _ in range(3))
        for i, word in enumerate(words):
            if (row := self.tables[0].get(word)) is not None:
                rows[0].append(row)
                sizes[0].append(1)
                places[0].append(i)
                continue
            for n in range(LONGEST, 0, -1):
                get = self.tables[n].get
                found = [r for g in grams(word, n) if (r := get(g)) is not None]
                if found:
                    rows[n] += found
                    sizes[n].append(len(found))
                    places[n].append(i)
                    break
        for held, row, size, place in zip(self.costs, rows, sizes, places, strict=True):
            if place:
                row, size = np.array(row), np.array(size)
                many = held.first[row + 1] - held.first[row]
                entry = np.repeat(held.first[row] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
                cell = np.repeat(np.repeat(np.array(place), size) * width, many) + held.language[entry]
                under += np.bincount(cell, held.under[entry] / np.repeat(np.repeat(size, size), many), len(under))
        return (under + PENALTY).reshape(len(words), width)

    def word_cost(self, word: str) -> np.ndarray:
        return self.word_costs([word])[0]


class Scorer:
    """Scores texts, keeping the costs of recent words."""

    def __init__(self, model: LanguageModel, keep: int = 150_000):
        width = max(len(model.languages), 1)
        self.model, self.keep = model, max(min(keep, (1 << 24) // width), 1000)  # 64 MB at most, whatever the number of languages
        self.known: dict[str, int] = {}
        self.costs = np.empty((self.keep, len(model.languages)), np.float32)

    def __call__(self, text: str | None) -> tuple[str, float]:
        found = words(text) if text else []
        if not found or not self.model.languages:
            return UNDETERMINED, 0.0
        total = np.zeros(len(self.model.languages))
        step = min(50_000, self.keep)
        for start in range(0, len(found), step):
            total += self._sum(found[start : start + step])
        mean = total / len(found)
        best = int(mean.argmin())
        weight = np.exp((mean[best] - mean) * np.log(10) * np.sqrt(len(found)))
        return self.model.languages[best], float(1 / weight.sum())

    def _sum(self, found: list[str]) -> np.ndarray:
        known = self.known
        rows = [known.get(w, -1) for w in found]
        if -1 in rows:
            fresh = {w for w, r in zip(found, rows, strict=True) if r < 0}
            if len(known) + len(fresh) > self.keep:
                known.clear()
                fresh = set(found)
            first = len(known)
            new = sorted(fresh)
            self.costs[first : first + len(new)] = self.model.word_costs(new)
            known.update(zip(new, range(first, first + len(new)), strict=True))
            rows = [known[w] for w in found]
        return self.costs[rows].sum(axis=0, dtype=np.float64)


def _counted(held: Counter[tuple[str, str]]) -> pa.RecordBatch:
    keys = list(held)
    return pa.record_batch([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array(list(held.values()), pa.int64())], names=["lang", "gram", "c"])


def learn(
    docs: DataFrame,
    *,
    text: str = "text",
    lang: str = "lang",
    key: str = "doc_id",
    rows_per_language: int = 4000,
    features_per_table: int = 15_000,
    entries_per_table: int = 1_000_000,
) -> LanguageModel:
    """Fit on a bounded sample of the rows of ``docs`` with a language.

    The bounds are parameters: about ``rows_per_language`` rows of each
    language, chosen by a hash of ``key``; of the words and of the n-grams of
    each length, the ``features_per_table`` most frequent of each language,
    fewer where the languages together would have over ``entries_per_table``.
    Every language is learnt. Only the model, at most six tables of that many
    entries, reaches the driver.
    """
    rows = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.xxhash64(F.col(key)).alias("h")).where("text is not null and lang is not null")
    counts = written(rows.groupBy("lang").agg(F.count("*").alias("rows")), "languages")
    sizes = counts.orderBy(F.desc("rows"), "lang").collect()  # a row a language
    if not sizes:
        nothing = Costs.of(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0), 0)
        return LanguageModel([], [{}] * (LONGEST + 1), [nothing] * (LONGEST + 1))
    languages = [r["lang"] for r in sizes]
    chance = F.pmod("h", F.lit(1 << 30)) / float(1 << 30)
    sample = rows.join(F.broadcast(counts), "lang").where(chance < rows_per_language / F.col("rows")).select("text", "lang")

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[tuple[str, str]] = Counter()
        for part in slices(batches, "text", 1 << 20):
            for name, value in zip(part.column("lang").to_pylist(), part.column("text").to_pylist(), strict=True):
                for w, c in Counter(words(value)).items():
                    held[name, w] += c
            if len(held) > 200_000:
                yield _counted(held)
                held.clear()
        yield _counted(held)

    def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[tuple[str, str]] = Counter()
        for batch in batches:
            for name, w, c in zip(*(batch.column(k).to_pylist() for k in ("lang", "gram", "c")), strict=True):
                for n in range(1, LONGEST + 1):
                    for g in grams(w, n):
                        held[name, g] += c
            if len(held) > 200_000:
                yield _counted(held)
                held.clear()
        yield _counted(held)

    schema = "lang string, gram string, c long"
    counted_words = written(sample.mapInArrow(count_words, schema).groupBy("lang", "gram").agg(F.sum("c").alias("c")), "words")
    counted_grams = counted_words.mapInArrow(count_grams, schema).groupBy("lang", "gram").agg(F.sum("c").alias("c"))
    counted = written(counted_words.withColumn("n", F.lit(0)).unionByName(counted_grams.withColumn("n", F.length("gram"))), "grams")
    totals = {(r["lang"], r["n"]): r["t"] for r in counted.groupBy("lang", "n").agg(F.sum("c").alias("t")).collect()}
    most = Window.partitionBy("lang", "n").orderBy(F.desc("c"), "gram")
    limit = min(features_per_table, max(entries_per_table // len(languages), 1))
    kept = counted.withColumn("r", F.row_number().over(most)).where(F.col("r") <= limit).select("lang", "n", "gram", "c").toPandas()
    place = {name: i for i, name in enumerate(languages)}
    tables, costs = [], []
    for n in range(LONGEST + 1):
        part = kept[kept.n == n].sort_values(["gram", "lang"])
        table = {g: i for i, g in enumerate(sorted(set(part.gram)))}
        total = np.array([totals[name, n] for name in part.lang], np.float64)
        costs.append(Costs.of(part.gram.map(table).to_numpy(np.int64), part.lang.map(place).to_numpy(np.int64), -np.log10(part.c.to_numpy(np.float64) / total), len(table)))
        tables.append(table)
    return LanguageModel(languages, tables, costs)


def identify(docs: DataFrame, model: LanguageModel, *, text: str = "text", keep: list[Column] | None = None) -> DataFrame:
    """Add ``lang_pred`` and ``score`` to the columns ``keep``; one row for each row of ``docs``."""
    kept = docs.select(*(keep or []), F.col(text).alias("__text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = kept.columns[:-1]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for part in slices(batches, "__text"):
            found = [scorer(x) for x in part.column("__text").to_pylist()]
            yield pa.record_batch([*part.columns[:-1], pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], names=[*names, "lang_pred", "score"])

    schema = kept.select(*names, F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema
    return kept.mapInArrow(score, schema)


def held_out(key: Column) -> Column:
    """Whether a row is kept from training: crc32 of the id as text leaves 1 modulo 3; false for a null id."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))
