"""BPE encoding by an automaton built from the merges, and decoding by its labels.

Construction. The first automaton has one state and a loop for each base
symbol. Each merge (a, b) -> c, in order, applies one gadget: where a leads
to a state q that b can leave, a is redirected to a copy of q without b, and c
is added beside a, leading where b led. After all merges the automaton accepts
exactly the token sequences that the merges produce. As every token leads to
one state wherever it is read, a state is kept as its parent, the arc it lost
and when; an arc of a later token exists where its left part had one when the
token was made. Arcs looked up once go to a transition table.

Encoding. Each prefix of a word has exactly one accepted sequence, so a word
is read left to right: from the state of each prefix, the tokens that spell
the next symbols extend it if the automaton has the arc. Words are pre-split
as the tokenizer file says. Decoding emits the labels of the arcs, joined by a
space, as a file without a decoder asks for.

Edge cases: a null text counts as empty and has no tokens; every row is kept,
repeated rows and null ids included; names of other columns do not matter.
A very long run without a split is one word: memory and time grow with it in
proportion. Ids without a label decode to nothing.
"""

from __future__ import annotations

import json
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rows import slices

START = 0


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in set(shown) else chr(next(hidden)) for b in range(256)]


class MergeAutomaton:
    """Deterministic automaton over token ids. ``merges`` are (left, right, made) ids in order."""

    def __init__(self, base: dict[int, int], merges: list[tuple[int, int, int]]):
        self.parent, self.target = [-1], {t: START for t in base.values()}
        self.left: dict[int, int] = {}
        self.birth: dict[int, int] = dict.fromkeys(base.values(), -1)
        self.lost: list[tuple[int, int]] = [(-1, -1)]
        parts: dict[int, tuple[int, int]] = {}
        spelled: dict[int, tuple[int, ...]] = {t: (s,) for s, t in base.items()}
        for when, (a, b, made) in enumerate(merges):
            if made in self.birth or a not in self.birth or b not in self.birth:
                raise ValueError(f"merge {when} is not of two earlier tokens into a new one")
            q, onward = self.target[a], self.target[b]
            self.parent.append(q)
            self.lost.append((b, when))
            self.target[made] = onward
            self.target[a] = len(self.parent) - 1
            self.left[made], self.birth[made], parts[made] = a, when, (a, b)
            spelled[made] = spelled[a] + spelled[b]
        self._order()
        self.trie: dict = {}
        for token, symbols in spelled.items():
            node = self.trie
            for s in symbols:
                node = node.setdefault(s, {})
            node[-1] = token
        self.table: dict[tuple[int, int], int] = {}

    def _order(self) -> None:
        """Number the tree of states so that the states below one are a range; list for each token the ranges that lost it."""
        children: list[list[int]] = [[] for _ in self.parent]
        for state, p in enumerate(self.parent[1:], 1):
            children[p].append(state)
        first, last, stack, clock = [0] * len(self.parent), [0] * len(self.parent), [(START, False)], 0
        while stack:
            state, done = stack.pop()
            if done:
                last[state] = clock
                continue
            first[state] = clock
            clock += 1
            stack.append((state, True))
            stack += [(c, False) for c in children[state]]
        self.number = first
        ranges: dict[int, list[tuple[int, int, int]]] = {}
        for state, (token, when) in enumerate(self.lost):
            if state:
                ranges.setdefault(token, []).append((first[state], last[state], when))
        self.ranges = {t: sorted(r) for t, r in ranges.items()}

    def _lost_at(self, state: int, token: int) -> int | None:
        """When the arc of ``token`` was taken from ``state`` or from what it is a copy of."""
        ranges = self.ranges.get(token)
        if not ranges:
            return None
        at = self.number[state]
        i = bisect_right(ranges, (at, 1 << 60, 0)) - 1
        return ranges[i][2] if i >= 0 and ranges[i][1] > at else None

    def step(self, state: int, token: int) -> int:
        """The next state, or -1 if the automaton has no such arc."""
        found = self.table.get((state, token))
        if found is None:
            found, part, limit = self.target[token], token, 1 << 60
            while part is not None:
                when = self._lost_at(state, part)
                if when is not None and when <= limit:  # equal where a token is twice its left part
                    found = -1
                    break
                limit, part = self.birth[part], self.left.get(part)
            if len(self.table) < 2_000_000:
                self.table[state, token] = found
        return found

    def encode(self, symbols: list[int]) -> list[int]:
        """The one accepted token sequence that spells ``symbols``.

        A prefix has one accepted sequence, so each place is reached once at
        most, in one state; from each, longer tokens are tried first.
        """
        n = len(symbols)
        back: list[tuple[int, int] | None] = [None] * (n + 1)
        trie, known, open_ = self.trie, self.table, [(0, START)]
        while open_:
            i, state = open_.pop()
            if i == n:
                break
            node, j = trie, i
            while j < n and (node := node.get(symbols[j])) is not None:
                j += 1
                token = node.get(-1)
                if token is not None and back[j] is None:
                    to = known.get((state, token))
                    if to is None:
                        to = self.step(state, token)
                    if to >= 0:
                        back[j] = i, token
                        open_.append((j, to))
        out, at = [], n
        while at:
            at, token = back[at]
            out.append(token)
        return out[::-1]


# Characters that the quick way splits and lower-cases just as the library does.
_ORDINARY = re.compile("[^\t\n\r -~¡-¬®-įı-ɏ‐-‧‰-⁞€]")


class WordCodec:
    """A tokenizer file of byte-level BPE with word ends, as a compiled automaton."""

    def __init__(self, path: str, keep: int = 150_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, end = spec["model"], spec["model"]["end_of_word_suffix"]
        vocab, letters = model["vocab"], byte_letters()
        base = {b: vocab[c] for b, c in enumerate(letters)} | {256 + b: vocab[c + end] for b, c in enumerate(letters)}
        merges = [(vocab[a], vocab[b], vocab[a + b]) for a, b in (m if isinstance(m, list) else m.split(" ") for m in model["merges"])]
        self.automaton = MergeAutomaton(base, merges)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.labels = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        self.special_split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=lambda x: (-len(x), x)))) + ")") if self.special else None
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")["pattern"]["Regex"]
        self.words = regex.compile(split)
        self.byte = {c: b for b, c in enumerate(letters)}
        self.path, self.keep, self.known, self.before = path, keep, {}, {}

    @property
    def library(self):
        return _library(self.path)

    def _split(self, text: str) -> list[str | bytes]:
        if not _ORDINARY.search(text):
            return self.words.findall(unicodedata.normalize("NFC", text).lower())
        t = self.library
        pieces = t.pre_tokenizer.pre_tokenize_str(t.normalizer.normalize_str(text))
        return [bytes(self.byte[c] for c in w) for w, _ in pieces]

    def _word(self, word: str | bytes) -> list[int]:
        ids = self.before.get(word)
        if ids is None:
            raw = word.encode() if isinstance(word, str) else word
            ids = self.automaton.encode([*raw[:-1], 256 + raw[-1]])
        if len(word) <= 64:
            if len(self.known) >= self.keep:  # words not seen since the last time are forgotten
                self.known, self.before = {}, self.known
            self.known[word] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        parts = self.special_split.split(text) if self.special_split and "<" in text else [text]
        for k, part in enumerate(parts):
            if k % 2:
                out.append(self.special[part])
            elif part:
                for w in self._split(part):
                    out += self.known.get(w) or self._word(w)
        return out


@lru_cache(2)
def _library(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(2)
def codec(path: str) -> WordCodec:
    """One per Python worker: workers are used again for later tasks."""
    return WordCodec(path)


def encode(docs: DataFrame, path: str, *, text: str = "text", keep: list[Column] | None = None) -> DataFrame:
    """``keep`` and ``ids`` (array<int>) for each row. ``path`` names the tokenizer file on every executor."""
    kept = docs.select(*(keep or []), F.col(text).alias("__text"))
    names = kept.columns[:-1]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for part in slices(batches, "__text"):
            rows = [c.encode(x) if x else [] for x in part.column("__text").to_pylist()]
            ends = np.cumsum([0, *map(len, rows)], dtype=np.int32)
            flat = np.fromiter((i for r in rows for i in r), np.int32, int(ends[-1]))
            yield pa.record_batch([*part.columns[:-1], pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], names=[*names, "ids"])

    return kept.mapInArrow(task, kept.select(*names, F.expr("cast(null as array<int>)").alias("ids")).schema)


def decode(rows: DataFrame, path: str, *, ids: str = "ids") -> DataFrame:
    """Add ``decoded``: the labels of ``ids`` with a space between; other columns stay, one of that name is replaced."""
    rows = rows.drop("decoded")
    names = rows.columns

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        labels = pa.array([c.labels.get(i, "") for i in range(max(c.labels) + 1)], pa.string())
        for batch in batches:
            column = batch.column(ids)
            texts = pc.binary_join(pa.ListArray.from_arrays(column.offsets, labels.take(column.values)), " ") if batch.num_rows else pa.array([], pa.string())
            yield pa.record_batch([*batch.columns, texts], names=[*names, "decoded"])

    return rows.mapInArrow(task, rows.withColumn("decoded", F.lit("")).schema)
