"""Mixing sources to target weights, in fixed-length blocks of words.

The words of each source form one stream, its documents in the order of their
ids; blocks of BLOCK words are cut from it (the last may be shorter), so a block
holds pieces of documents. The targets say how many blocks each source gives.

Output slots, one block each, are dealt out in shards. The source counts of a
shard are a multinomial draw, held to the targets: a group of shards has each
source's even share of its blocks, and its shards draw one after another from
what is left of them (a multinomial given its totals, that is, a multivariate
hypergeometric draw), from a seed of the group. So no group needs to know what
another drew. The slots of a source are numbered through all shards; a number
becomes a block by a keyed permutation of the source's blocks, a new one for each pass,
so that each pass takes no block twice. The last pass ends where the taken
words are closest to the target. Blocks are joined to slots by source and index,
which spreads the largest source as evenly as any other.

Stream positions come from documents dealt out by range, sums of each part and
prefix sums over the parts: no source is ordered in one task. The list of
sources with their sizes comes to the driver; documents do not.

Edge cases: a null source is a source of its own, the last; a null or empty
text has no words and is in no block. A null id comes first in its source;
rows that repeat an id each have their own place. An empty table gives an
empty mix. The same rows, parameters and seed give the same mix, however the
rows are dealt.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .scratch import written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2
BLOCK, SHARD, GROUP = 64, 1024, 64
SEED = 13


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


# What each source gives


@dataclass(frozen=True)
class Source:
    """A source of the mix: its number, name and size in words, the words it should give, its blocks and those taken of them."""

    number: int
    name: str | None
    size: int
    target: float
    blocks: int
    taken: int


def targets(sizes: list[int], weights: list[float], whole: float, most: float = MOST) -> list[float]:
    """``whole`` shared by weight; a share ends at ``most`` times its size, and what is left over is shared again."""
    found: list[float] = [0.0] * len(sizes)
    open_, left = [i for i in range(len(sizes))], whole
    while open_:
        weight = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] / weight > most * sizes[i]]
        for i in full or open_:
            found[i] = float(most * sizes[i]) if full else left * weights[i] / weight
        if not full:
            break
        left -= sum(found[i] for i in full)
        open_ = [i for i in open_ if i not in set(full)]
    return found


def _taken(size: int, target: float, block: int, number: int, seed: int) -> int:
    """Blocks whose words come closest to ``target``: whole passes, then the first of the next pass's order."""
    n = -(-size // block)
    if not n:
        return 0
    passes = int(target // size)
    left = target - passes * size
    last = int(permuted(np.array([n - 1]), np.array([n]), _key(seed, np.array([number]), np.array([passes])), back=True)[0])
    words = lambda k: k * block - (n * block - size) * (last < k)
    about = int(left // block)
    return passes * n + min((k for k in range(about - 1, about + 4) if 0 <= k <= n), key=lambda k: (abs(words(k) - left), k))


def plan(docs: DataFrame, *, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: int = MOST, block: int = BLOCK, seed: int = SEED) -> list[Source]:
    """The sources of ``docs`` (source, size) by code point, null last; ``weights`` go round."""
    rows = docs.groupBy("source").agg(F.sum("size").alias("size")).collect()  # a row a source
    rows = sorted(rows, key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [r["size"] for r in rows]
    goals = targets(sizes, [weights[i % len(weights)] for i in range(len(rows))], share * sum(sizes), most)
    return [Source(i, r["source"], r["size"], t, -(-r["size"] // block), _taken(r["size"], t, block, i, seed)) for i, (r, t) in enumerate(zip(rows, goals, strict=True))]


# Permutations of indexes


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _key(seed: int, source: np.ndarray, passed: np.ndarray) -> np.ndarray:
    k = _mixed(source.astype(np.uint64) + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15 & ((1 << 32) - 1)))
    return _mixed(k ^ _mixed(passed.astype(np.uint64) + np.uint64(1)))


def permuted(i: np.ndarray, n: np.ndarray, key: np.ndarray, *, back: bool = False, rounds: int = 6) -> np.ndarray:
    """A keyed permutation of 0..n-1, elementwise; ``back`` undoes it.

    Halves of an index in base ceil(sqrt(n)) are added to hashes of each
    other in turn; what falls outside goes round again.
    """
    i, n = i.astype(np.int64), n.astype(np.int64)
    base = np.ceil(np.sqrt(n.astype(np.float64))).astype(np.int64)
    base = np.maximum(base + (base * base < n), 1)
    open_ = np.ones(len(i), bool)
    while open_.any():
        high, low, b, k = i[open_] // base[open_], i[open_] % base[open_], base[open_], key[open_]
        for r in reversed(range(rounds)) if back else range(rounds):
            by = lambda x, r=r: (_mixed(k + _mixed(x.astype(np.uint64) * np.uint64(rounds) + np.uint64(r))) % b.astype(np.uint64)).astype(np.int64)  # noqa: B023, E731
            if back:
                high, low = low, (high - by(low)) % b
            else:
                high, low = (low + by(high)) % b, high
        i[open_] = high * b + low
        open_ &= i >= n
    return i


# Slots and blocks


def slots(spark: SparkSession, sources: list[Source], *, shard: int = SHARD, group: int = GROUP, seed: int = SEED) -> DataFrame:
    """(shard, slot, src, block): which block of which source stands in each slot of each shard; shards have about ``shard`` slots."""
    kind = "shard long, slot long, src int, block long"
    total = sum(s.taken for s in sources)
    groups = max(-(-total // (shard * group)), 1)
    taken, blocks = (np.array([getattr(s, f) for s in sources], np.int64) for f in ("taken", "blocks"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for g in batch.column("id").to_pylist():
                begin = np.array([int(t) * g // groups for t in taken], np.int64)
                left = np.array([int(t) * (g + 1) // groups for t in taken], np.int64) - begin
                draws = np.random.default_rng([seed, g])
                most = int(left.sum())
                shards = min(max(-(-most // shard), 1), group)
                for s in range(shards):
                    size = most * (s + 1) // shards - most * s // shards
                    counts = draws.multivariate_hypergeometric(left, size)
                    src = draws.permutation(np.repeat(np.arange(len(left)), counts))
                    order = np.argsort(src, kind="stable")
                    nth = np.empty(size, np.int64)
                    nth[order] = np.arange(size) - np.repeat(np.cumsum(counts) - counts, counts)
                    number = begin[src] + nth
                    n = blocks[src]
                    block = permuted(number % np.maximum(n, 1), n, _key(seed, src, number // np.maximum(n, 1)))
                    begin, left = begin + counts, left - counts
                    yield pa.record_batch([pa.array(np.full(size, g * group + s)), pa.array(np.arange(size)), pa.array(src.astype(np.int32)), pa.array(block)], names=["shard", "slot", "src", "block"])

    if not total:
        return spark.createDataFrame([], kind)
    tasks = min(groups, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return spark.range(0, groups, 1, tasks).mapInArrow(task, kind)


def placed(docs: DataFrame, sources: list[Source]) -> DataFrame:
    """The rows of ``docs`` (key, source, size, tie and what else there is) with src and ``begin``, where their words start in their source's stream."""
    spark = docs.sparkSession
    numbers = spark.createDataFrame([(s.number, s.name) for s in sources], "src int, name string")
    rows = docs.join(F.broadcast(numbers), F.col("source").eqNullSafe(F.col("name"))).drop("name")  # the list of sources
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["src", "key", "tie", "size"]
    dealt = written(rows.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "dealt")
    sums = dealt.groupBy("src", "part").agg(F.sum("size").alias("sum"))
    before = F.sum("sum").over(Window.partitionBy("src").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sums.select("src", "part", F.coalesce(before, F.lit(0)).alias("offset"))  # at most parts + sources rows
    own = F.sum("size").over(Window.partitionBy("part", "src").orderBy("key", "tie", "size").rowsBetween(Window.unboundedPreceding, -1))
    return dealt.join(F.broadcast(offsets), ["src", "part"]).withColumn("begin", F.col("offset") + F.coalesce(own, F.lit(0))).drop("offset", "part")


def pieces(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """A row for each block that a document's words lie in: block, ``start`` (words of the document before), ``length``, ``at`` (words of the block before)."""
    end = F.col("begin") + F.col("size")
    each = rows.where("size > 0").withColumn("block", F.explode(F.sequence(F.floor(F.col("begin") / block), F.floor((end - 1) / block))))
    low, high = F.greatest(F.col("begin"), F.col("block") * block), F.least(end, (F.col("block") + 1) * block)
    return each.withColumns({"start": low - F.col("begin"), "length": high - low, "at": low - F.col("block") * block})


def sized(docs: DataFrame, *, key: str = "doc_id", text: str = "text", source: str = "source", words: bool = False) -> DataFrame:
    """(key, source, size, tie), a written table, with the ``words`` themselves if they are to be mixed."""
    body = [F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(WORD), F.lit(0)).alias("ws")] if words else []
    return written(docs.select(F.col(key).alias("key"), F.col(source).alias("source"), size_of(F.col(text)).alias("size"), F.xxhash64(text).alias("tie"), *body), "sized")


def mix(rows: DataFrame, sources: list[Source], *, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """(shard, slot, at, key, src, begin, start, length): the mix, a row for each piece of a document in a slot; ``rows`` are of :func:`placed`.

    A slot's text is its pieces in the order of ``at``; each has its ``words`` if the rows have theirs.
    """
    cut = [F.array_join(F.slice("ws", F.col("start").cast("int") + 1, F.col("length").cast("int")), " ").alias("words")] if "ws" in rows.columns else []
    parts = pieces(rows, block).select("src", "block", "key", "begin", "start", "length", "at", *cut)
    # Spark takes what a range of groups is mapped to for as small as the range
    found = slots(rows.sparkSession, sources, seed=seed).hint("merge").join(parts, ["src", "block"])
    return found.select("shard", "slot", "at", "key", "src", "begin", "start", "length", *(["words"] if cut else []))


def taken(rows: DataFrame, mixed: DataFrame) -> DataFrame:
    """(key, src, size, taken): each row of :func:`placed` with its words in the mix, repeats counted."""
    # a place in a source's stream belongs to one row that has words
    each = rows.where("size > 0").select("src", "begin", "key", "size", F.lit(0).cast("long").alias("length"))
    held = each.unionByName(mixed.select("src", "begin", "key", F.lit(None).cast("long").alias("size"), "length"))
    some = held.groupBy("src", "begin").agg(F.max("key").alias("key"), F.max("size").alias("size"), F.sum("length").alias("taken"))
    return some.select("key", "src", "size", "taken").unionByName(rows.where("size = 0").select("key", "src", "size", F.lit(0).cast("long").alias("taken")))
