"""Packing token sequences into windows with the least slack.

Each text is tokenised once. Its ids are cut at multiples of the capacity, so
that every piece but the last fills a sequence; the checksum of a piece is
taken in the same pass, and only the pieces' lengths take part in planning.
The plan works on counts of lengths: again and again the longest length left
opens a window, a bitset subset-sum over the lengths left finds the total that
comes closest to the capacity, and backtracking gives how many of each length
make it up; the pattern is used as often as the counts allow. There are fewer
lengths than the capacity, so the plan's size does not depend on the corpus.
What the last windows lack is at most one capacity for each pattern; a window
whose total is not full is closed at the best sum there is.

Pieces find their sequence by their rank among the pieces of their length.
Ranks are counted within (length, salt) groups of about 1000 rows and offset by
the groups before, so no length gathers in one task.

Edge cases: a null text counts as empty: one piece with the end id alone.
Repeated rows and null ids are packed like any other; an empty table gives an
empty result; names of other columns do not matter.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .bpe_automaton import byte_letters
from .rows import slices
from .scratch import written

CAPACITY = 2048


@lru_cache(2)
def byte_encoding(path: str):
    """The byte-level BPE of a tokenizer file, run by tiktoken, which gives the same ids several times faster."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    of = {c: b for b, c in enumerate(byte_letters())}
    ranks = {bytes(of[c] for c in token): i for token, i in spec["model"]["vocab"].items() if all(c in of for c in token)}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    split = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    return tiktoken.Encoding(path, pat_str=split, mergeable_ranks={k: v for k, v in ranks.items() if v not in set(special.values())}, special_tokens=special)


@lru_cache(2)
def _library(path: str):
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


def token_ids(text: str, path: str) -> np.ndarray:
    """Ids of a text; one whose runs are too long for the pattern's stack is encoded by the tokenizers library, with equal ids."""
    try:
        return byte_encoding(path).encode_to_numpy(text, allowed_special="all")
    except ValueError:
        return np.array(_library(path).encode(text, add_special_tokens=False).ids, np.uint32)


def pieces(docs: DataFrame, path: str, *, text: str = "text", keep: list[Column], end_id: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """Cut each text's ids: ``keep``, start, length, ids_crc32, doc_tokens; every id is in exactly one piece."""
    kept = docs.select(*keep, F.col(text).alias("__text"))
    names = kept.columns[:-1]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "__text"):
            row, start, length, crc, total = [], [], [], [], []
            for r, value in enumerate(part.column("__text").to_pylist()):
                ids = np.append(token_ids(value, path) if value else np.empty(0, np.uint32), end_id).astype("<u4")
                for at in range(0, len(ids), capacity):
                    cut = ids[at : at + capacity]
                    row.append(r)
                    start.append(at)
                    length.append(len(cut))
                    crc.append(zlib.crc32(cut.tobytes()))
                    total.append(len(ids))
            yield pa.record_batch([*(c.take(pa.array(row, pa.int64())) for c in part.columns[:-1]), *(pa.array(x, pa.int64()) for x in (start, length, crc, total))], names=[*names, "start", "length", "ids_crc32", "doc_tokens"])

    zero = F.lit(0).cast("long")
    return kept.mapInArrow(task, kept.select(*names, *(zero.alias(c) for c in ("start", "length", "ids_crc32", "doc_tokens"))).schema)


def fill(counts: dict[int, int], room: int) -> list[tuple[int, int]]:
    """Lengths and how many of each, with the largest total of at most ``room``."""
    mask, reach, steps = (1 << (room + 1)) - 1, 1, []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        for _ in range(min(counts[length], room // length)):
            wider = (reach | reach << length) & mask
            if wider == reach:
                break
            steps.append((length, reach))
            reach = wider
        if reach >> room & 1:
            break
    total, used = reach.bit_length() - 1, {}
    for length, before in reversed(steps):
        if not before >> total & 1:
            used[length] = used.get(length, 0) + 1
            total -= length
    return sorted(used.items(), reverse=True)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[int]]]:
    """(times, lengths in a window) until all counts are used up."""
    left, out = {k: n for k, n in counts.items() if n}, []
    while left:
        seed = max(left)
        left[seed] -= 1
        rest = fill({k: n for k, n in left.items() if n}, capacity - seed)
        left[seed] += 1
        pattern = {seed: 1}
        for length, n in rest:
            pattern[length] = pattern.get(length, 0) + n
        times = min(left[k] // n for k, n in pattern.items())
        for k, n in pattern.items():
            left[k] -= times * n
            if not left[k]:
                del left[k]
        out.append((times, [k for k, n in sorted(pattern.items(), reverse=True) for _ in range(n)]))
    return out


def slots(patterns: list[tuple[int, list[int]]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length: first ranks of its slots, the first sequence of each slot, the slot's offset in the window."""
    found: dict[int, list[tuple[int, int, int]]] = {}
    ranks: dict[int, int] = {}
    sequence = 0
    for times, lengths in patterns:
        offset = 0
        for length in lengths:
            found.setdefault(length, []).append((ranks.get(length, 0), sequence, offset))
            ranks[length] = ranks.get(length, 0) + times
            offset += length
        sequence += times
    return {k: tuple(np.array(x, np.int64) for x in zip(*v, strict=True)) for k, v in found.items()}


def pack(cut: DataFrame, *, capacity: int = CAPACITY, group_rows: int = 1000) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a written table of :func:`pieces`; columns of these names are replaced."""
    cut = cut.drop("sequence_id", "offset")
    names = cut.columns
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # at most ``capacity`` rows
    if not counts:
        zero = F.lit(0).cast("long")
        return cut.select("*", zero.alias("sequence_id"), zero.alias("offset"))
    salts = F.lit([-(-counts.get(k + 1, 1) // group_rows) for k in range(capacity)])  # a frequent length is dealt over many groups
    salted = cut.withColumn("__salt", F.pmod(F.xxhash64(*names), F.element_at(salts, F.col("length").cast("int"))))
    groups = salted.groupBy("length", "__salt").agg(F.count("*").alias("n"))
    shared = cut.sparkSession.sparkContext.broadcast(slots(plan(counts, capacity)))
    before = groups.select("length", "__salt", (F.sum("n").over(Window.partitionBy("length").orderBy("__salt")) - F.col("n")).alias("__before"))
    within = salted.withColumn("__rank", F.row_number().over(Window.partitionBy("length", "__salt").orderBy(*names)) - 1)
    ranked = within.join(before, ["length", "__salt"]).select(*names, (F.col("__rank") + F.col("__before")).alias("__rank"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "__rank"))
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for value in np.unique(length):
                first, base, at = shared.value[int(value)]
                here = np.flatnonzero(length == value)
                slot = np.searchsorted(first, rank[here], "right") - 1
                sequence[here] = base[slot] + rank[here] - first[slot]
                offset[here] = at[slot]
            yield pa.record_batch([*batch.columns[:-1], pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    zero = F.lit(0).cast("long")
    return ranked.mapInArrow(task, cut.select("*", zero.alias("sequence_id"), zero.alias("offset")).schema)


def pack_texts(docs: DataFrame, path: str, *, text: str = "text", keep: list[Column], end_id: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """Tokenise, write the pieces once to the shared folder, and pack them."""
    return pack(written(pieces(docs, path, text=text, keep=keep, end_id=end_id, capacity=capacity), "pieces"), capacity=capacity)
