"""Removal of byte strings that an earlier document has, by suffix order.

A byte of a document goes if it lies in a string of ``depth`` bytes that also
starts in a document with a smaller id. To decide that, every suffix of the
collection is put in the order of its first bytes: equal strings then stand
together, and common prefixes of at least ``depth`` bound them.

The order is built by :mod:`bwt`, one symbol of each text a round, over many
small collections that Spark deals out: each window of ``depth`` bytes belongs
to its minimiser, the 20-byte gram in it with the least hash, so equal windows
meet in the same collection wherever they stand. Windows in a row with one
minimiser travel as one text (at most 64 windows each), so all texts are
short, and rounds are few, however long a document is. A symbol is WIDTH bytes:
each text enters once for each place where its first symbol can start, so that
every suffix is inserted, in a tenth of the rounds.

Stages, all on one dealing of the documents to batches by id, which Spark
shuffles once and reuses: (1) each batch lists its minimisers; those of one
document only are told apart by bucket and need no further work; (2) each batch
cuts the texts of the shared ones; a text that it has often travels once, with
all its places; (3) each bucket orders the texts of all batches, equal ones
side by side, tells for each window the smallest id that has it, and thus which
places lose it; (4) each batch takes the ranges out. No text is compared with
another but by that order. However many documents hold a passage, a bucket gets
it at most once from each batch. A minimiser that very many batches have, in
whatever surroundings, is known from stage 1; all batches then send its windows
each by its own hash, so no bucket gathers them.

Edge cases: a null text counts as empty; a document under ``depth`` bytes
keeps all its bytes. A null id is neither smaller nor larger than another:
such rows are kept whole. Rows that repeat an id do not remove each other's
bytes; each keeps its row. Matches never cross documents. Names of other
columns do not matter.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bwt import transform, walk

GRAM = 20
RUN = 64
#: Bytes in a symbol: a round inserts one symbol for each text, at each of its WIDTH alignments.
WIDTH = 10
#: Symbols in a collection whose suffixes are ordered together, about: its files stay in a core's cache, and its symbols within 16 bits.
COLLECTION = 60_000
_PART = 1 << 20
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93)
_LOW = np.uint64((1 << 40) - 1)


def _eight(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as a number."""
    n = len(data) - 7
    out = np.empty(n, np.uint64)
    for k in range(min(8, n)):
        out[k::8] = data[k : k + 8 * ((n - k + 7) // 8)].view("<u8")
    return out


def _grams(data: np.ndarray) -> np.ndarray:
    """A hash of each GRAM bytes in a row."""
    eight = _eight(data)
    n = len(data) - GRAM + 1
    h = eight[:n] * _M1
    h ^= h >> np.uint64(31)
    h += eight[8 : 8 + n]
    h *= _M2
    h ^= h >> np.uint64(32)
    h += eight[GRAM - 8 : GRAM - 8 + n]
    h *= _M3
    h ^= h >> np.uint64(29)
    h *= _M1
    return h ^ (h >> np.uint64(32))


def _least(h: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        h = np.minimum(h[:-size], h[size:])
        size *= 2
    return np.minimum(h[: -(width - size)], h[width - size :]) if width > size else h


class Runs:
    """Windows in a row with one minimiser: document, first byte in it, windows, minimiser."""

    def __init__(self, texts: list[bytes], depth: int):
        doc, start, count, key = [], [], [], []
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end]) <= _PART):
                size += len(texts[end])
                end += 1
            part = self._part(texts[at:end], depth)
            if part is not None:
                doc.append(part[0] + at)
                start.append(part[1])
                count.append(part[2])
                key.append(part[3])
            at = end
        join = lambda x, t: np.concatenate(x) if x else np.empty(0, t)
        self.doc, self.start, self.count, self.key = join(doc, np.int64), join(start, np.int64), join(count, np.int64), join(key, np.uint64)

    @staticmethod
    def _part(texts: list[bytes], depth: int):
        sizes = np.array([len(t) for t in texts], np.int64)
        windows = np.maximum(sizes - depth + 1, 0)
        total = int(windows.sum())
        if not total:
            return None
        least = _least(_grams(np.frombuffer(b"".join(texts), np.uint8)), depth - GRAM + 1)
        first = np.cumsum(sizes) - sizes
        doc = np.repeat(np.arange(len(texts)), windows)
        offset = np.arange(total) - np.repeat(np.cumsum(windows) - windows, windows)
        key = least[first[doc] + offset]
        new = np.ones(total, bool)
        new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
        begin = np.flatnonzero(new)
        length = np.diff(np.append(begin, total))
        pieces = -(-length // RUN)
        if (pieces > 1).any():  # cut long runs
            which = np.repeat(np.arange(len(begin)), pieces)
            nth = np.arange(len(which)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            length = np.minimum(length[which] - nth * RUN, RUN)
            begin = begin[which] + nth * RUN
        return doc[begin], offset[begin], length, key[begin]


def _bytes(arrays: list[np.ndarray]) -> bytes:
    raw = [np.ascontiguousarray(a) for a in arrays]
    return struct.pack(f"<{len(raw)}q", *(a.nbytes for a in raw)) + b"".join(a.tobytes() for a in raw)


def _arrays(raw: bytes, *kinds: str) -> list[np.ndarray]:
    at, out = 8 * len(kinds), []
    for size, kind in zip(struct.unpack_from(f"<{len(kinds)}q", raw), kinds, strict=True):
        out.append(np.frombuffer(raw, kind, size // np.dtype(kind).itemsize, at))
        at += size
    return out


def _short(keys: np.ndarray) -> np.ndarray:
    """40-bit keys as 5 bytes each."""
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).reshape(-1)


def _long(raw: np.ndarray) -> np.ndarray:
    wide = np.zeros((len(raw) // 5, 8), np.uint8)
    wide[:, :5] = raw.reshape(-1, 5)
    return wide.view("<u8").reshape(-1)


def _documents(rows: pa.Table) -> tuple[list, list[int], list[bytes], np.ndarray]:
    """The rows in a fixed order: for each row the number of its text; ids and texts, each pair once; rows' places."""
    ids, ties, texts = (rows[c].to_pylist() for c in ("__id", "__tie", "__bytes"))
    order = sorted(range(len(ids)), key=lambda i: (ids[i], ties[i]))
    number, out_ids, out_texts, last = [0] * len(ids), [], [], None
    for i in order:
        if (ids[i], ties[i]) != last:
            last = ids[i], ties[i]
            out_ids.append(ids[i])
            out_texts.append(texts[i])
        number[i] = len(out_ids) - 1
    return number, out_ids, out_texts, np.array(out_ids, np.int64)


def _buckets(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)


def _list_keys(depth: int, buckets: int):
    def task(rows: pa.Table) -> pa.Table:
        _, _, texts, ids = _documents(rows)
        runs = Runs(texts, depth)
        batch = rows["__batch"][0].as_py()
        order = np.lexsort((runs.doc, runs.key))
        key, owner = runs.key[order], ids[runs.doc[order]] if len(order) else np.empty(0, np.int64)
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.empty(0, np.int64)
        several = np.minimum.reduceat(owner, first) < np.maximum.reduceat(owner, first) if len(first) else np.empty(0, bool)
        once = key[first]
        bucket = _buckets(once, buckets)
        out_bucket, out_raw = [], []
        arranged = np.lexsort((~several, bucket))
        cuts = np.flatnonzero(np.append(True, np.diff(bucket[arranged]) != 0)) if len(once) else np.empty(0, np.int64)
        for a, b in zip(cuts, [*cuts[1:], len(once)], strict=False):
            part = arranged[a:b]
            out_bucket.append(int(bucket[part[0]]))
            out_raw.append(_bytes([np.array([several[part].sum()], np.int64), _short(once[part] & _LOW)]))
        return pa.table({"bucket": pa.array(out_bucket, pa.int32()), "batch": pa.array([batch] * len(out_raw), pa.int32()), "raw": pa.array(out_raw, pa.binary())})

    return task


def _share_keys(spread: int):
    def task(lists: pa.Table) -> pa.Table:
        """Of each batch's keys, those that another document has; first those that more than ``spread`` batches have."""
        bucket = lists["bucket"][0].as_py()
        batches, keys, sure = lists["batch"].to_numpy(), [], []
        for raw in lists["raw"]:
            n, short = _arrays(raw.as_py(), "<i8", "u1")
            k = _long(short)
            keys.append(k)
            sure.append(np.arange(len(k)) < n[0])
        source = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
        flat, certain = np.concatenate(keys), np.concatenate(sure)
        order = np.argsort(flat, kind="stable")
        edge = np.flatnonzero(np.append(True, flat[order][1:] != flat[order][:-1]))
        holders = np.empty(len(flat), np.int64)
        holders[order] = np.repeat(np.diff(np.append(edge, len(flat))), np.diff(np.append(edge, len(flat))))
        shared, hot = certain | (holders > 1), holders > spread
        out_batch, out_raw = [], []
        for i, batch in enumerate(batches):
            low, high = np.searchsorted(source, [i, i + 1])
            mine, wide = flat[low:high][shared[low:high]], hot[low:high][shared[low:high]]
            if len(mine):
                out_batch.append(int(batch))
                out_raw.append(_bytes([_short(mine[wide]), _short(mine[~wide])]))
        n = len(out_raw)
        return pa.table({"batch": pa.array(out_batch, pa.int32()), "bucket": pa.array([bucket] * n, pa.int32()), "raw": pa.array(out_raw, pa.binary())})

    return task


def _cut_texts(depth: int, buckets: int):
    def task(rows: pa.Table, shared: pa.Table) -> pa.Table:
        out_bucket: list[int] = []
        out_raw: list[bytes] = []
        batch = (rows if rows.num_rows else shared)["__batch" if rows.num_rows else "batch"][0].as_py()
        if rows.num_rows and shared.num_rows:
            _, _, texts, ids = _documents(rows)
            runs = Runs(texts, depth)
            named = [(np.uint64(b) << np.uint64(40), *_arrays(raw.as_py(), "u1", "u1")) for b, raw in zip(shared["bucket"].to_pylist(), shared["raw"], strict=True)]
            hot, rest = (np.concatenate([b | _long(x[i]) for b, *x in named]) for i in (0, 1))
            bucket = _buckets(runs.key, buckets)
            full = (bucket.astype(np.uint64) << np.uint64(40)) | (runs.key & _LOW)
            wide = np.isin(full, hot)
            chosen = np.flatnonzero(wide | np.isin(full, rest))
            places: dict[bytes, list[tuple[int, int]]] = {}  # a text that a batch has often is sent, and ordered, once
            home: dict[bytes, int] = {}

            def take(piece: bytes, d: int, s: int, b: int) -> None:
                if piece in places:
                    places[piece].append((d, s))
                else:
                    places[piece], home[piece] = [(d, s)], b

            for d, s, n, b, w in zip(*(x[chosen].tolist() for x in (runs.doc, runs.start, runs.count, bucket, wide)), strict=True):
                if w:  # a minimiser that very many batches have: its windows go each by its own hash
                    for k in range(s, s + n):
                        piece = texts[d][k : k + depth]
                        take(piece, d, k, xxhash.xxh64_intdigest(piece) % buckets)
                else:
                    take(texts[d][s : s + n + depth - 1], d, s, b)
            by_bucket: dict[int, list[bytes]] = {}
            for piece in places:
                by_bucket.setdefault(home[piece], []).append(piece)
            for b, mine in by_bucket.items():
                spots = np.array([(d, s) for piece in mine for d, s in places[piece]], "<i4")
                counts = np.array([len(places[piece]) for piece in mine], "<i4")
                out_bucket.append(b)
                out_raw.append(_bytes([np.frombuffer(zstandard.compress(b"".join(mine)), np.uint8), np.array([len(p) for p in mine], "u1"), counts, ids[spots[:, 0]].astype("<i8"), spots[:, 0], spots[:, 1]]))
        return pa.table({"bucket": pa.array(out_bucket, pa.int32()), "batch": pa.array([batch] * len(out_raw), pa.int32()), "raw": pa.array(out_raw, pa.binary())})

    return task


def _numbered(values: np.ndarray, bits: int) -> tuple[int, np.ndarray]:
    """How many values there are, of ``bits`` bits, and each one's number among them, in order."""
    room = max(len(values) - 1, 1).bit_length()
    if bits + room > 64:
        found, number = np.unique(values, return_inverse=True)
        return len(found), number
    packed = (values.astype(np.uint64) << np.uint64(room)) | np.arange(len(values), dtype=np.uint64)  # sorted with its place
    packed.sort()
    place = (packed & np.uint64((1 << room) - 1)).astype(np.int64)
    packed >>= np.uint64(room)
    number = np.empty(len(values), np.int64)
    number[place] = np.cumsum(np.append(False, packed[1:] != packed[:-1])) if len(values) else 0
    return int(number[place[-1]]) + 1 if len(values) else 0, number


def _symbols(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of WIDTH bytes: of each text, WIDTH rows of them, one for each place where the first symbol can start.

    Gives the symbols, as numbers from 1 on; and for each row its length, its text and its first byte. Every byte starts
    one symbol, so each suffix of ``depth`` bytes or more stands in one row. Rows too short for ``depth`` are left out.
    """
    lengths = np.array([len(t) for t in texts], np.int64)
    first = np.cumsum(lengths) - lengths
    half = _eight(np.frombuffer(b"".join(texts) + bytes(WIDTH), np.uint8)) & np.uint64((1 << 40) - 1)
    halves, number = _numbered(half, 40)
    skip = np.arange(WIDTH)
    text = np.repeat(np.arange(len(texts)), WIDTH)
    start = np.tile(skip, len(texts))
    rows = lengths[text] - start >= depth
    text, start = text[rows], start[rows]
    size = (lengths[text] - start) // WIDTH
    place = np.repeat(first[text] + start, size) + WIDTH * (np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size))
    found, code = _numbered(number[place] * halves + number[place + WIDTH // 2], (halves * halves).bit_length())
    return (code + 1).astype(np.uint16 if found < (1 << 16) - 1 else np.uint32), size, text, start


def smallest_holder(texts: list[bytes], owners: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of each text, one after another, the smallest owner of a text that has it, by the order of all suffixes; and each text's first window.

    ``depth`` is a multiple of WIDTH, and no text is shorter.
    """
    symbols, sizes, text, start = _symbols(texts, depth)
    deep = depth // WIDTH
    bwt, lcp = transform(symbols, sizes, deep)
    owner = np.full(len(bwt), np.iinfo(np.int64).max)
    spots = []
    for j, (which, at) in enumerate(walk(bwt, sizes), 1):
        if j >= deep:
            owner[at] = owners[text[which]]
            spots.append((which, at))
    group = np.flatnonzero(lcp < deep)
    smallest = np.repeat(np.minimum.reduceat(owner, group), np.diff(np.append(group, len(bwt))))
    windows = np.array([len(t) - depth + 1 for t in texts], np.int64)
    first = np.cumsum(windows) - windows
    flat = np.empty(int(windows.sum()), np.int64)
    for j, (which, at) in enumerate(spots, deep):
        flat[first[text[which]] + start[which] + WIDTH * (sizes[which] - j)] = smallest[at]
    return flat, first


def _holders(texts: list[bytes], owners: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """:func:`smallest_holder` of a bucket, by collections of texts with the same minimisers."""
    lengths = np.array([len(t) for t in texts], np.int64)
    first = np.cumsum(lengths) - lengths
    grams = np.empty(int(lengths.sum()), np.uint64)
    part = _grams(np.frombuffer(b"".join(texts), np.uint8))
    grams[: len(part)] = part
    window = np.stack([first, first + depth - GRAM + 1], axis=1).reshape(-1)
    key = np.minimum.reduceat(np.append(grams, np.uint64(0)), window)[::2]
    order = np.argsort(key, kind="stable")
    ends = np.append(np.flatnonzero(key[order][1:] != key[order][:-1]) + 1, len(order))
    symbols = np.cumsum(lengths[order])
    windows = lengths - depth + 1
    at = np.cumsum(windows) - windows
    least = np.empty(int(windows.sum()), np.int64)
    done = 0
    while done < len(order):
        reach = np.searchsorted(symbols, (symbols[done - 1] if done else 0) + COLLECTION)
        end = int(ends[min(np.searchsorted(ends, max(reach, done + 1)), len(ends) - 1)])  # whole groups
        mine = order[done:end]
        found, _ = smallest_holder([texts[i] for i in mine], owners[mine], depth)
        n = windows[mine]
        least[np.repeat(at[mine] - (np.cumsum(n) - n), n) + np.arange(len(found))] = found
        done = end
    return least, at


def _order_texts(depth: int):
    def task(rows: pa.Table) -> pa.Table:
        texts: list[bytes] = []
        owners, entries = [], []
        for batch, raw in zip(rows["batch"].to_pylist(), rows["raw"], strict=True):
            data, sizes, counts, ids, doc, start = _arrays(raw.as_py(), "u1", "u1", "<i4", "<i8", "<i4", "<i4")
            whole, at, base = zstandard.decompress(data.tobytes()), 0, len(texts)
            for n in sizes.tolist():
                texts.append(whole[at : at + n])
                at += n
            owners.append(np.minimum.reduceat(ids, np.cumsum(counts) - counts))
            entries.append((batch, np.repeat(np.arange(base, len(texts)), counts), ids, doc, start))
        least, first = _holders(texts, np.concatenate(owners), depth)
        windows = np.array([len(t) - depth + 1 for t in texts], np.int64)
        out_batch: list[int] = []
        out_raw: list[bytes] = []
        for batch, number, ids, doc, start in entries:
            n = windows[number]
            entry = np.repeat(np.arange(len(number)), n)
            offset = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            gone = least[first[number][entry] + offset] < ids[entry]
            edge = np.diff(np.concatenate([[0], gone.view(np.int8), [0]]))
            inner = np.flatnonzero(np.append(False, entry[1:] != entry[:-1]) & np.append(False, gone[1:] & gone[:-1]))
            begins, ends = np.sort(np.concatenate([np.flatnonzero(edge == 1), inner])), np.sort(np.concatenate([np.flatnonzero(edge == -1), inner]))
            if len(begins):
                e = entry[begins]
                low = start[e] + offset[begins]
                out_batch.append(batch)
                out_raw.append(_bytes([doc[e].astype("<i4"), low.astype("<i4"), (low + (ends - begins) + depth - 1).astype("<i4")]))
        return pa.table({"batch": pa.array(out_batch, pa.int32()), "raw": pa.array(out_raw, pa.binary())})

    return task


def _take_out(depth: int, kind: pa.DataType):
    def task(rows: pa.Table, ranges: pa.Table) -> pa.Table:
        empty = pa.schema([("keep", kind), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])
        if not rows.num_rows:
            return empty.empty_table()
        number, _, texts, _ = _documents(rows)
        found: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        if ranges.num_rows:
            parts = [_arrays(raw.as_py(), "<i4", "<i4", "<i4") for raw in ranges["raw"]]
            doc, low, high = (np.concatenate([p[i] for p in parts]).astype(np.int64) for i in range(3))
            order = np.lexsort((low, doc))
            doc, low, high = doc[order], low[order], high[order]
            cuts = np.flatnonzero(np.append(True, np.diff(doc) != 0))
            for a, b in zip(cuts, np.append(cuts[1:], len(doc)), strict=True):
                reach = np.maximum.accumulate(high[a:b])
                new = np.append(True, low[a:b][1:] > reach[:-1])
                begins = np.flatnonzero(new)
                found[int(doc[a])] = low[a:b][begins], reach[np.append(begins[1:], b - a) - 1]
        results = []
        for k, text in enumerate(texts):
            lows, highs = found.get(k, ((), ()))
            kept, at = [], 0
            for a, b in zip(lows, highs, strict=True):
                kept.append(text[at:a])
                at = int(b)
            left = b"".join([*kept, text[at:]]) if at else text
            results.append((len(text), len(text) - len(left), len(lows), left))
        columns = [pa.array([results[i][f] for i in number], pa.binary() if f == 3 else pa.int64()) for f in range(4)]
        return pa.table([rows["keep"].cast(kind), *columns], schema=empty)

    return task


def remove_repeats(docs: DataFrame, *, key: str = "doc_id", text: str = "text", depth: int = 50, batch_bytes: int = 4 << 20, most_partitions: int = 100_000, spread: int = 512) -> DataFrame:
    """The columns of ``docs`` but ``text``, and n_bytes, n_removed, n_spans and kept (binary: the bytes that remain); columns of these names are replaced.

    Batches hold about ``batch_bytes`` whatever the size of the table; a task
    takes several, one by one, where there are over ``most_partitions``.
    ``depth`` is a multiple of WIDTH. The windows of a minimiser that over ``spread`` batches
    have are dealt to all buckets.
    """
    added = ("n_bytes", "n_removed", "n_spans", "kept")
    keep = F.struct(*[c for c in docs.columns if c not in (text, *added)]).alias("keep")
    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(keep, F.coalesce(F.col(key), F.lit(0)).cast("long").alias("__id"), raw.alias("__bytes"), F.col(key).isNull().alias("__null"))
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    if depth % WIDTH or depth < GRAM:
        raise ValueError(f"depth must be a multiple of {WIDTH}, {GRAM} at least")
    n = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // batch_bytes))
    tasks = min(n, most_partitions)
    identified = rows.where("not __null").drop("__null").withColumn("__tie", F.xxhash64("__bytes"))
    dealt = identified.withColumn("__batch", F.pmod(F.xxhash64("__id", "__tie"), F.lit(n)).cast("int")).repartition(tasks, "__batch")
    lists = dealt.groupBy("__batch").applyInArrow(_list_keys(depth, n), "bucket int, batch int, raw binary")
    shared = lists.repartition(tasks, "bucket").groupBy("bucket").applyInArrow(_share_keys(spread), "batch int, bucket int, raw binary")
    cut = dealt.groupBy("__batch").cogroup(shared.groupBy("batch")).applyInArrow(_cut_texts(depth, n), "bucket int, batch int, raw binary")
    ranges = cut.repartition(tasks, "bucket").groupBy("bucket").applyInArrow(_order_texts(depth), "batch int, raw binary")
    zero = F.lit(0).cast("long")
    whole = rows.where("__null").select("keep", F.octet_length("__bytes").cast("long").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"), F.col("__bytes").alias("kept"))
    done = dealt.groupBy("__batch").cogroup(ranges.groupBy("batch")).applyInArrow(_take_out(depth, _arrow(dealt, "keep")), whole.schema)
    return done.unionByName(whole).select("keep.*", *added)


def _arrow(df: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[column].dataType)


def readable(kept: Column) -> Column:
    """What remains as text: bytes of characters cut at a range's edge are left out."""
    return F.replace(F.make_valid_utf8(kept.cast("string")), F.lit("\ufffd"), F.lit(""))
