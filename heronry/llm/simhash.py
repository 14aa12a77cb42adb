"""SimHash fingerprints, near pairs by blocks, and classes of near copies.

A bit of a fingerprint is 1 if it is set in over half the hashes of the word
shingles, repeats included. Links are sought among distinct fingerprints only,
so copies of a text cost one node. Fingerprints are split into blocks: by the
pigeonhole principle, two that differ in at most ``blocks - match`` bits agree
in ``match`` whole blocks, so a join on each choice of ``match`` blocks meets
every such pair, and the Hamming distance is then verified.

A block key that more than ``bucket`` fingerprints share is not paired off.
Its fingerprints write, for each single flip of the bits outside the agreed
blocks, the flipped fingerprint: two at a distance of at most 2 have one such
neighbour in common, and at most 1 + (bits outside) share one. That is exact,
and linear in the bucket's size.

For similarities whose distances no pigeonhole reaches, :func:`near_copies`
takes longer fingerprints, of the distinct shingles: those that agree in one of
as many blocks as a stated recall asks for meet, and their Hamming distance is
verified. What the first few blocks join counts as one node in the others, so
that the links of a large class do not come again from every block. Sets of few
shingles, whose fingerprints are coarse, also meet by bands of minima. Candidates' sets of shingles are then held against each other;
a link says that their exact Jaccard similarity suffices.

Edge cases: null and empty texts, and texts of white space alone, have the
fingerprint zero and link like any other; a text with fewer words than a
shingle is one shingle. Repeated rows and null ids keep their rows; a class id
is the smallest id that is not null. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .rows import slices
from .scratch import written
from .skew import beside, joined

SEED = 42
#: Minima in a band, and shingles of a set that has bands at most.
BAND, FEW = 6, 40
#: Bits of a block of a long fingerprint, and its lanes that tell a Hamming distance.
BLOCK, TOLD = 16, 2
#: Blocks whose classes are known before the others are read.
FIRST = 4


def shingle_hashes(text: str, words: int) -> np.ndarray:
    """XXH64 of each shingle of ``words`` words; ASCII letters in lower case; words end at ASCII white space."""
    found = text.encode().lower().split()
    if len(found) > words:
        joined = map(b" ".join, zip(*(found[i:] for i in range(words)), strict=False))
    else:
        joined = [b" ".join(found)] if found else []
    digest = xxhash.xxh64_intdigest
    return np.array([digest(s, SEED) for s in joined], np.uint64)


def _spread(h: np.ndarray, k: int) -> np.ndarray:
    """The k-th hash derived from h; the 0-th is h itself."""
    if not k:
        return h
    x = h + np.uint64((k * 0x9E3779B97F4A7C15) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprint(hashes: np.ndarray, lanes: int = 1) -> np.ndarray:
    """``lanes`` unsigned 64-bit parts."""
    counts = np.zeros((lanes, 64), np.int64)
    for at in range(0, len(hashes), 8192):
        part = hashes[at : at + 8192]
        for k in range(lanes):
            raw = np.ascontiguousarray(_spread(part, k)).view(np.uint8).reshape(-1, 8)
            counts[k] += np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes), axis=1, bitorder="little")
    return bits.view("<u8").reshape(lanes)


def fingerprints(docs: DataFrame, *, text: str = "text", keep: list[Column], words: int = 3, lanes: int = 1) -> DataFrame:
    """``keep`` and ``fp`` (array<long>, ``lanes`` parts) for each row."""
    kept = docs.select(*keep, F.col(text).alias("__text"))
    names = kept.columns[:-1]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "__text"):
            found = [fingerprint(shingle_hashes(x or "", words), lanes) for x in part.column("__text").to_pylist()]
            flat = np.concatenate(found).view(np.int64)
            ends = np.arange(len(found) + 1, dtype=np.int32) * lanes
            yield pa.record_batch([*part.columns[:-1], pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], names=[*names, "fp"])

    return kept.mapInArrow(task, kept.select(*names, F.expr("cast(null as array<long>)").alias("fp")).schema)


def exact_links(prints: DataFrame, *, fp: str = "fp", distance: int = 2, match: int = 2, bucket: int = 64) -> DataFrame:
    """(a, b) links that connect all distinct 64-bit fingerprints at up to ``distance`` (at most 2) bits."""
    if not 0 <= distance <= 2:
        raise ValueError("the neighbours of crowded blocks reach a distance of 2")
    blocks = match + distance
    width = 64 // blocks
    masks = [((1 << (64 - width * (blocks - 1) if i == blocks - 1 else width)) - 1) << (width * i) for i in range(blocks)]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    chosen = [sum(masks[i] for i in c) for c in combinations(range(blocks), match)]
    nodes = prints.select(F.col(fp).alias("f")).distinct()
    keyed = nodes.select("f", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col("f").bitwiseAND(F.lit(signed(m))).alias("key")) for k, m in enumerate(chosen)])).alias("x")).select("f", "x.k", "x.key")
    keyed = written(keyed, "blocks")
    size = keyed.groupBy("k", "key").agg(F.count("*").alias("n")).where("n > 1")
    sized = keyed.join(size, ["k", "key"])
    few = sized.where(F.col("n") <= bucket)
    x, y = few.select("k", "key", F.col("f").alias("a")), few.select("k", "key", F.col("f").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    pairs = x.join(y, ["k", "key"]).where((F.col("a") < F.col("b")) & near).select("a", "b")
    flips = F.array(*[F.array(F.lit(0).cast("long"), *[F.lit(signed(1 << i)) for i in range(64) if not m >> i & 1]) for m in chosen])
    many = sized.where(F.col("n") > bucket).select("f", "k", F.explode(flips[F.col("k")]).alias("flip"))
    shared = many.groupBy("k", F.col("f").bitwiseXOR(F.col("flip")).alias("v")).agg(F.collect_list("f").alias("fs"))
    hubs = shared.where(F.size("fs") > 1).select(F.array_min("fs").alias("a"), F.explode("fs").alias("b")).where("a <> b")
    return pairs.unionByName(hubs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)).distinct()


def classes(prints: DataFrame, links: DataFrame, *, key: str, fp: str = "fp") -> DataFrame:
    """The columns of ``prints``, a written table, and ``component_id``: the smallest ``key`` of all rows whose fingerprints are linked."""
    first = prints.groupBy(F.col(fp).alias("node")).agg(F.min(key).alias("least"))
    rooted = written(first.join(components(links), "node", "left").select("node", "least", F.coalesce("root", "node").alias("root")), "rooted")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = joined(rooted, least, "root").select(F.col("node").alias(fp), "component_id")
    return joined(prints, named, fp).select(*prints.columns, "component_id")


def band_count(similarity: float, recall: float, rows: int = BAND) -> int:
    """How many bands of ``rows`` minima a pair at exactly ``similarity`` needs to share one with a chance of ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))


def band_keys(hashes: np.ndarray, bands: int) -> list[int]:
    """A key for each band: two sets share one with a chance of their Jaccard similarity to the power of BAND."""
    if not len(hashes):
        return []
    r = np.random.default_rng(SEED)
    factor, shift = r.integers(0, 1 << 64, (2, bands * BAND, 1), np.uint64)
    least = np.full(bands * BAND, (1 << 64) - 1, np.uint64)
    for at in range(0, len(hashes), 1024):
        least = np.minimum(least, ((hashes[at : at + 1024] + shift) * (factor | np.uint64(1))).min(axis=1))
    return [xxhash.xxh64_intdigest(x.tobytes(), k) for k, x in enumerate(least.reshape(bands, BAND))]


def shingle_sets(docs: DataFrame, *, text: str, keep: list[Column], words: int, bands: int = 0) -> DataFrame:
    """``keep`` and, of each row's distinct shingles, ``node`` (a hash of them all) and ``keys`` of bands; without bands, ``hashes``, ascending."""
    kept = docs.select(*keep, F.col(text).alias("__text"))
    names = kept.columns[:-1]
    last = "keys" if bands else "hashes"

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "__text", 1 << 20):
            found = [np.unique(shingle_hashes(x or "", words)) for x in part.column("__text").to_pylist()]
            node = np.array([xxhash.xxh64_intdigest(h.tobytes(), SEED) for h in found], np.uint64).view(np.int64)
            lists = [np.array(band_keys(h, bands), np.uint64) for h in found] if bands else found
            ends = np.cumsum([0, *map(len, lists)], dtype=np.int32)
            flat = np.concatenate(lists).view(np.int64)
            yield pa.record_batch([*part.columns[:-1], pa.array(node), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], names=[*names, "node", last])

    return kept.mapInArrow(task, kept.select(*names, F.lit(0).cast("long").alias("node"), F.expr("cast(null as array<long>)").alias(last)).schema)


def agreement(similarity: float) -> float:
    """Share of bits in which fingerprints of two sets of that Jaccard similarity agree: by the angle between them."""
    return 1 - math.acos(min(2 * similarity / (1 + similarity), 1)) / math.pi


def block_count(similarity: float, recall: float) -> int:
    """How many blocks two fingerprints at ``similarity`` need to agree in one with a chance of ``recall``; whole lanes are filled."""
    need = math.ceil(math.log(1 - recall) / math.log(1 - agreement(similarity) ** BLOCK))
    return -(-need // (64 // BLOCK)) * (64 // BLOCK)


def told_distance(similarity: float) -> int:
    """The Hamming distance over TOLD lanes that all but 1 in 5000 pairs at ``similarity`` keep."""
    n, q = 64 * TOLD, 1 - agreement(similarity)
    beyond, d = 1.0, -1
    while beyond > 2e-4:
        d += 1
        beyond -= math.comb(n, d) * q**d * (1 - q) ** (n - d)
    return d


def long_fingerprint(hashes: np.ndarray, lanes: int) -> np.ndarray:
    """As :func:`fingerprint`, for many lanes at once."""
    counts = np.zeros(lanes * 64, np.int64)
    k = (np.arange(lanes, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[:, None].T
    for at in range(0, len(hashes), 255):  # as many as a byte counts
        part = hashes[at : at + 255, None]
        x = part + k
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
        x[:, :1] = part
        counts += np.add.reduce(np.unpackbits(x.view(np.uint8), axis=1, bitorder="little"), axis=0, dtype=np.uint8)
    return np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")


def sketches(docs: DataFrame, *, text: str, keep: list[Column], words: int, blocks: int, bands: int) -> DataFrame:
    """``keep`` and, of each row's distinct shingles, ``node`` (a hash of them all), ``fp`` (TOLD lanes of their fingerprint), ``blocks`` (the
    number and bits of each, in one; none of an empty set) and, of sets of FEW or less, ``keys`` of bands."""
    kept = docs.select(*keep, F.col(text).alias("__text"))
    names = kept.columns[:-1]
    lanes = blocks * BLOCK // 64
    number = np.arange(blocks, dtype=np.int32) << BLOCK

    def lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, parts)], dtype=np.int32)), pa.array(np.concatenate(parts), kind))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "__text", 1 << 20):
            found = [np.unique(shingle_hashes(x or "", words)) for x in part.column("__text").to_pylist()]
            node = np.array([xxhash.xxh64_intdigest(h.tobytes(), SEED) for h in found], np.uint64).view(np.int64)
            prints = [long_fingerprint(h, lanes) for h in found]
            told = lists([p[:TOLD].view(np.int64) for p in prints], pa.int64())
            cut = lists([p.view("<u2").astype(np.int32) + number if len(h) else number[:0] for p, h in zip(prints, found, strict=True)], pa.int32())
            keys = lists([np.array(band_keys(h, bands) if len(h) <= FEW else [], np.uint64).view(np.int64) for h in found], pa.int64())
            yield pa.record_batch([*part.columns[:-1], pa.array(node), told, cut, keys], names=[*names, "node", "fp", "blocks", "keys"])

    none = lambda kind: F.expr(f"cast(null as array<{kind}>)")
    return kept.mapInArrow(task, kept.select(*names, F.lit(0).cast("long").alias("node"), none("long").alias("fp"), none("int").alias("blocks"), none("long").alias("keys")).schema)


def close_links(fp: np.ndarray, group: np.ndarray, node: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (places) that connect, within each run of one group, all nodes that a chain of close fingerprints joins; a node may have several."""
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    edge = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else np.zeros(0, np.int64)
    size = np.diff(np.append(edge, len(group)))
    rows = np.flatnonzero(np.repeat(size <= 32, size))
    g, f, own = group[rows], fp[rows], node[rows]
    for lag in range(1, min(32, len(g))):  # small groups: each row with the rows after it
        near = np.flatnonzero(g[lag:] == g[:-lag])
        if not len(near):
            break
        near = near[own[near] != own[near + lag]]
        near = near[np.bitwise_count(f[near] ^ f[near + lag]).sum(axis=1, dtype=np.int64) <= distance]
        a.append(rows[near])
        b.append(rows[near + lag])
    for start, count in zip(edge[size > 32].tolist(), size[size > 32].tolist(), strict=True):
        queue, rest = [], np.arange(start, start + count)
        while len(rest):  # large ones: from row to row, each held against those not yet reached
            if not queue:
                same = node[rest] == node[rest[0]]
                queue, rest = rest[same].tolist(), rest[~same]
                continue
            here = queue.pop()
            close = rest[np.bitwise_count(fp[rest] ^ fp[here]).sum(axis=1, dtype=np.int64) <= distance]
            if len(close):
                met, at = np.unique(node[close], return_index=True)
                a.append(np.full(len(met), here))
                b.append(close[at])
                reached = np.isin(node[rest], met)
                queue += rest[reached].tolist()
                rest = rest[~reached]
    return np.concatenate(a), np.concatenate(b)


def forest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Places of links that connect all that these links do, fewer than their ends: in rounds, each tree takes its first link to another."""
    ends = np.unique(np.concatenate([a, b]), return_inverse=True)[1]
    u, v = ends[: len(a)], ends[len(a) :]
    tree = np.arange(len(ends))
    left, taken = np.arange(len(a)), [np.zeros(0, np.int64)]
    while len(left := left[tree[u[left]] != tree[v[left]]]):
        least = np.full(len(tree), len(a))
        np.minimum.at(least, tree[u[left]], left)
        np.minimum.at(least, tree[v[left]], left)
        own = np.flatnonzero(least < len(a))
        link = least[own]
        taken.append(np.unique(link))
        to = np.arange(len(tree))
        to[own] = tree[u[link]] + tree[v[link]] - own
        both = own[(to[to[own]] == own) & (own < to[own])]  # two trees with the same link
        to[both] = both
        while (to != to[to]).any():
            to = to[to]
        tree = to[tree]
    return np.concatenate(taken)


def block_links(nodes: DataFrame, distance: int, most: int = 1 << 16) -> DataFrame:
    """(a, b) links that connect all nodes that chains of pairs join which agree in a block and differ in ``distance`` bits of ``fp`` at most.

    ``nodes`` has node, fp and blocks; rows of one node need no link. Rows meet by block once, sorted; of what is read at a time a forest of links is put out, not its pairs.
    A group's links start at its smallest node, so that those of the blocks that a group shares are the same links.
    A task reads about ``most`` rows at a time, and a block of more in whole: a row of it is 28 bytes.
    """
    keyed = nodes.select("node", *[F.col("fp")[i].alias(f"fp{i}") for i in range(TOLD)], F.explode("blocks").alias("block"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def links(node: np.ndarray, block: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
            a, b = close_links(fp, block, node, distance)
            pairs = np.unique(np.stack([node[a], node[b]], axis=1), axis=0)
            pairs = pairs[forest(pairs[:, 0], pairs[:, 1])]
            return pa.record_batch([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            fp = np.stack([batch.column(f"fp{i}").to_numpy().view(np.uint64) for i in range(TOLD)], axis=1)
            held.append((batch.column("node").to_numpy(), batch.column("block").to_numpy(), fp))
            if sum(len(h[0]) for h in held) < most or held[0][1][0] == held[-1][1][-1]:
                continue
            node, block, fp = (np.concatenate(x) for x in zip(*held, strict=True))
            cut = int(np.searchsorted(block, block[-1]))  # the last block may go on
            yield links(node[:cut], block[:cut], fp[:cut])
            held = [(node[cut:], block[cut:], fp[cut:])]
        if held:
            yield links(*(np.concatenate(x) for x in zip(*held, strict=True)))

    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return keyed.repartition(parts, "block").sortWithinPartitions("block", "node").mapInArrow(task, "a long, b long")


def class_links(nodes: DataFrame, distance: int, first: int = FIRST) -> DataFrame:
    """(a, b) links that connect the same nodes as those of :func:`block_links`.

    A class of many near copies would have other links in each block. So classes by the ``first`` blocks are made before;
    in the others their nodes go by the name of the class, and links are those between two classes only.
    """
    begun = written(components(block_links(nodes.withColumn("blocks", F.slice("blocks", 1, first)), distance)), "begun")
    others = F.slice("blocks", F.lit(first + 1), F.greatest(F.size("blocks") - first, F.lit(0)))
    rest = nodes.join(begun, "node", "left").select(F.coalesce("root", "node").alias("node"), "fp", others.alias("blocks"))
    return block_links(rest, distance).unionByName(begun.select(F.col("node").alias("a"), F.col("root").alias("b")).where("a <> b"))


def meetings(keyed: DataFrame, on: list[str], salts: int = 64) -> DataFrame:
    """(a, b) links that connect all nodes with a common key (the columns ``on``), by stars in two levels, so that no key's rows gather."""
    keyed = keyed.select("node", *on, F.pmod(F.xxhash64("node"), F.lit(salts)).alias("salt"))
    near = keyed.withColumn("least", F.min("node").over(Window.partitionBy(*on, "salt")))
    tops = near.where("node = least").withColumn("top", F.min("node").over(Window.partitionBy(*on)))
    return near.select(F.col("node").alias("a"), F.col("least").alias("b")).unionByName(tops.select(F.col("node").alias("a"), F.col("top").alias("b"))).where("a <> b").distinct()


def set_links(node: np.ndarray, flat: np.ndarray, size: np.ndarray, known: np.ndarray, similarity: float) -> tuple[list[int], list[int]]:
    """Links that connect all sets that a chain of pairs at ``similarity`` or more joins, those ``known`` to be joined counting as one.

    From set to set, each held against those not yet reached. ``flat`` holds the sets' members one after another.
    """
    a, b = [], []
    ids = np.unique(flat, return_inverse=True)[1]
    end = np.cumsum(size)
    mark = np.zeros(len(flat) + 1, np.uint8)

    def members(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = size[rows]
        edge = np.cumsum(n) - n
        return ids[np.arange(n.sum()) + np.repeat(end[rows] - n - edge, n)], edge

    queue, rest = np.flatnonzero(known).tolist(), np.flatnonzero(~known)
    part, edge = members(rest)
    while len(rest):
        if not queue:
            queue, rest = [rest[0]], rest[1:]
            part, edge = members(rest)
            continue
        here = queue.pop()
        own = ids[end[here] - size[here] : end[here]]
        mark[own] = 1
        both = np.add.reduceat(mark[part], edge, dtype=np.int64)
        mark[own] = 0
        close = both / (size[rest] + size[here] - both) >= similarity
        if close.any():
            reached, rest = rest[close], rest[~close]
            a += [int(node[here])] * len(reached)
            b += node[reached].tolist()
            queue += reached.tolist()
            part, edge = members(rest)
    return a, b


def narrowed(sets: DataFrame, similarity: float) -> DataFrame:
    """(node, root) of finer roots: within a root, nodes that may be at ``similarity`` stay together, none such is parted.

    A root's hashes have an order, those first that few of its sets have. The smallest common hash in that order of two
    sets of n hashes or more at ``similarity`` s is among the first n - ceil(s n) + 1 of each: nodes that share one of
    those are joined. What pages of one template have in common comes last, so it joins none. Which hashes are frequent
    is told by at most 32 sets a root; this only decides how fine the roots get. Nodes that meet no other are left out.
    """
    n = F.size("hashes")
    slot = F.pmod(F.xxhash64("node"), F.lit(32))
    picks = written(sets.where(n <= 1 << 16).groupBy("root", slot.alias("slot")).agg(F.min("node").alias("node")).select("root", "node"), "picks")
    often = beside(sets, picks, ["root", "node"]).select("root", F.explode("hashes").alias("h")).groupBy("root", "h").count().where("count > 1")
    often = often.groupBy("root").agg(F.transform(F.array_sort(F.collect_list(F.struct("count", "h"))), lambda x: x["h"]).alias("often"))
    often = written(sets.select("root").distinct().join(often, "root", "left").select("root", F.coalesce("often", F.expr("cast(array() as array<long>)")).alias("often")), "often")
    order = F.concat(F.array_except("hashes", "often"), F.array_intersect("often", "hashes"))
    first = F.slice(order, F.lit(1), (n - F.ceil(n * similarity - 1e-9) + 1).cast("int"))
    return components(meetings(beside(sets, often, "root", F.size("often")).select("root", "node", F.explode(first).alias("h")), ["root", "h"]))


def alike(sets: DataFrame, similarity: float, most: int = 1 << 20) -> DataFrame:
    """(a, b) links that connect, in each ``root``, all nodes that a chain of pairs of exact Jaccard ``similarity`` or more joins.

    ``sets`` (a written table) has node, root and hashes. A root of over an eighth of ``most`` hashes is not held against itself at
    once: its sets are held against a few of its own first. Those near the best of these need no further test against
    each other. Where the others still have as many hashes, the root is parted into finer ones (:func:`narrowed`).
    Then, in parts of about ``most`` hashes, each part of the others meets each part of the root, as tasks of their own.
    What is known of crowded roots is broadcast only while it is small.
    """
    n = F.size("hashes")
    over = lambda rows: rows.groupBy("root").agg(F.sum(n).alias("n")).where(F.col("n") > most >> 3).select("root")
    crowds = written(over(sets), "crowds")
    none = F.lit(0)
    few = sets.join(crowds, "root", "left_anti").select("root", none.alias("i"), none.alias("j"), "node", "hashes", F.lit(False).alias("known"))
    many = beside(sets, crowds, "root")
    # up to eight sets of a crowded root, as pivots
    pivots = many.groupBy("root", F.pmod(F.xxhash64("node"), F.lit(8)).alias("slot")).agg(F.min_by(F.struct("node", "hashes"), "node").alias("p"))
    pivots = written(pivots, "pivots")
    both = F.size(F.array_intersect("hashes", "p.hashes"))
    near = beside(many, pivots, "root", F.size("p.hashes")).where(both / (n + F.size("p.hashes") - both) >= similarity).select("root", "node", F.col("p.node").alias("pivot"))
    near = written(near, "near")
    best = written(near.groupBy("root", "pivot").count().groupBy("root").agg(F.max_by("pivot", F.struct("count", "pivot")).alias("pivot")), "best")
    known = beside(near, best, ["root", "pivot"]).select("node", F.lit(True).alias("known"))
    told = written(many.join(known, "node", "left").select("root", "node", "hashes", F.coalesce("known", F.lit(False)).alias("known")), "told")
    wide = written(over(told.where(~F.col("known"))), "wide")
    if not wide.isEmpty():
        parted = beside(told, wide, "root")
        finer = beside(parted.drop("root"), written(narrowed(parted, similarity), "finer"), "node")
        told = told.join(wide, "root", "left_anti").unionByName(finer)
    part = lambda c: F.coalesce(F.ceil(F.sum(c) / most), F.lit(0)).cast("int")
    size = written(told.groupBy("root").agg(part(n).alias("parts"), part(F.when(~F.col("known"), n)).alias("others")).where("others > 0"), "size")
    told = beside(told, size, "root")
    dealt = lambda c: F.pmod(F.xxhash64("node", F.lit(c)), F.col(c)).cast("int")
    each = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    columns = ["root", "i", "j", "node", "hashes", "known"]
    left = told.where("not known and parts > 1").withColumn("i", dealt("others")).withColumn("j", each("parts")).select(*columns)
    right = told.withColumn("j", dealt("parts")).withColumn("i", each("others")).select(*columns)

    def meet(rows: pa.Table) -> pa.Table:
        node, first = np.unique(rows["node"].to_numpy(), return_index=True)  # a set may come from either side
        rows = rows.take(pa.array(first))
        hashes = rows["hashes"].combine_chunks()
        hashes = hashes.chunk(0) if isinstance(hashes, pa.ChunkedArray) else hashes
        a, b = set_links(node, hashes.flatten().to_numpy(), hashes.value_lengths().to_numpy().astype(np.int64), rows["known"].to_numpy().astype(bool), similarity)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    # dealt by all three: a shuffle by the root alone, which a join may have made, would do for the groups, but not deal them out
    dealt_out = few.unionByName(left).unionByName(right).repartition("root", "i", "j")
    met = dealt_out.groupBy("root", "i", "j").applyInArrow(meet, "a long, b long")
    return met.unionByName(near.select(F.col("node").alias("a"), F.col("pivot").alias("b")).where("a <> b"))


def near_copies(docs: DataFrame, *, key: str = "doc_id", text: str = "text", words: int = 5, similarity: float = 0.8, recall: float = 0.999) -> DataFrame:
    """(``key``, digest, component_id) for each row: the class of texts joined by chains of near copies.

    ``digest`` is xxhash64 of the text. Nodes are hashes of sets of shingles; 64
    bits tell as many sets apart as Spark's row ids do. Candidates are fingerprints
    that agree in a block and are close, of one shape at every size: a pair at
    exactly ``similarity`` agrees in one with a chance of ``recall``, and is close
    but for one in 5000. Sets of few shingles meet by bands too, with that chance.
    A link is kept only where the exact Jaccard similarity of the sets is ``similarity`` or more.
    """
    digest = F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("digest")
    shape = {"blocks": block_count(similarity, recall), "bands": band_count(similarity, recall)}
    prints = written(sketches(docs, text=text, keep=[F.col(key).alias("id"), digest], words=words, **shape), "prints")
    once = lambda c: F.any_value(c).alias(c)
    nodes = prints.groupBy("node").agg(once("fp"), once("blocks"))
    banded = prints.where(F.size("keys") > 0).groupBy("node").agg(once("keys")).select("node", F.posexplode("keys").alias("band", "key"))
    rough = components(class_links(nodes, told_distance(similarity)).unionByName(meetings(banded, ["band", "key"])))
    wanted = prints.groupBy("node").agg(F.min("digest").alias("digest")).join(rough, "node").select("digest", "root")
    texts = docs.select(digest, F.col(text).alias("text")).groupBy("digest").agg(F.any_value("text").alias("text"))
    sets = written(shingle_sets(texts.join(wanted, "digest"), text="text", keep=[F.col("root")], words=words), "sets")
    return classes(prints.select("id", "digest", "node"), alike(sets, similarity), key="id", fp="node").select(F.col("id").alias(key), "digest", "component_id")


def keep_first(docs: DataFrame, found: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of each class of :func:`near_copies` the row with the smallest id, once.

    Rows with a null id stay only where their class has no other id; ties go to the smaller text hash, and equal rows stay once.
    """
    order = F.struct(F.col(key).isNull().alias("none"), F.coalesce(key, F.lit(0)).alias("id"), F.col("digest").alias("digest"))
    first = found.groupBy("component_id", F.when(F.col("component_id").isNull(), F.col("digest")).alias("own")).agg(F.min(order).alias("first")).select("first.none", "first.id", "first.digest").distinct()
    keyed = docs.select(F.struct("*").alias("row"), F.col(key).isNull().alias("none"), F.coalesce(key, F.lit(0)).alias("id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("digest"))
    on = ["none", "id", "digest"]
    once = Window.partitionBy(*on).orderBy(F.lit(0))
    return keyed.join(first, on, "left_semi").withColumn("n", F.row_number().over(once)).where("n = 1").select("row.*")
