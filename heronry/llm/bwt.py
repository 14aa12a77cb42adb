"""Column-wise construction of the Burrows-Wheeler transform of many short texts, with common prefixes.

All texts grow from their ends together: each round inserts, for every text
that has one left, the suffix longer by one symbol. Where it goes follows from
the transform so far: the symbol before a suffix, and how often that symbol
comes before. The transform and the array of common prefixes are read and
rewritten from front to back in each round, as two sequential files; nothing
is kept for single suffixes, and no suffix is ever compared. Symbols are any
positive numbers; 16 bits sort in two passes.
"""

from __future__ import annotations

import numpy as np


def _least(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The least value in each range low..high inclusive; low <= high."""
    if not len(low):
        return np.empty(0, np.uint8)
    length = (high - low + 1).astype(np.int64)
    level = np.frexp(length.astype(np.float64))[1] - 1
    n = len(values)
    table = np.empty((int(level.max()) + 1, n), np.uint8)  # row k: least of the 2**k values from each place on
    table[0] = values
    for k in range(1, len(table)):
        span = 1 << (k - 1)
        np.minimum(table[k - 1, : n - span], table[k - 1, span:], out=table[k, : n - span])
    flat, row = table.reshape(-1), level * n
    return np.minimum(flat[row + low], flat[row + high - (1 << level) + 1])


def transform(texts: np.ndarray, lengths: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(transform, common prefixes) of the collection.

    ``texts`` holds the symbols, of 1 on, of all texts, one after another. A 0 in
    the transform ends a text; ends of texts come first, in order, and differ
    from each other. Common prefixes are with the suffix before, and count up to ``depth``.
    """
    m = len(lengths)
    ends = np.cumsum(lengths)
    by_length = np.argsort(-lengths, kind="stable").astype(np.int64)
    sorted_lengths = -lengths[by_length]
    last = ends[by_length]
    bwt = np.where(lengths > 0, texts[np.maximum(ends - 1, 0)], 0).astype(texts.dtype) if len(texts) else np.zeros(m, texts.dtype)
    lcp = np.zeros(m, np.uint8)
    at = by_length.astype(np.int64)  # where the newest suffix of each text stands, longest texts first
    for j in range(1, int(lengths.max(initial=0)) + 1):
        active = int(np.searchsorted(sorted_lengths, -j, "right"))
        here = at[:active]
        order = np.argsort(bwt, kind="stable")
        rank = np.empty(len(bwt), np.int32)
        rank[order] = np.arange(len(bwt), dtype=np.int32)
        ended = len(bwt) - int(np.count_nonzero(bwt))
        found = rank[here]
        c = bwt[here]
        place = found.astype(np.int64) + (m - ended)
        before = order[np.maximum(found - 1, 0)]
        beyond = order[np.minimum(found + 1, len(bwt) - 1)]
        has = np.flatnonzero((found > ended) & (bwt[before] == c))
        more = np.flatnonzero((found + 1 < len(bwt)) & (bwt[beyond] == c))
        least = _least(lcp, np.concatenate([before[has], here[more]]) + 1, np.concatenate([here[has], beyond[more]]))
        least = np.minimum(least + np.uint8(1), depth)
        up = np.zeros(active, np.uint8)
        up[has] = least[: len(has)]
        down = least[len(has) :]
        kept = np.ones(len(bwt) + active, bool)
        kept[place] = False
        wider = np.empty(len(kept), bwt.dtype)
        wider[kept] = bwt
        before_symbol = last[:active] - j - 1
        wider[place] = np.where(lengths[by_length[:active]] > j, texts[np.maximum(before_symbol, 0)], 0)
        common = np.empty(len(kept), np.uint8)
        common[kept] = lcp
        common[place[more] + 1] = down
        common[place] = up
        bwt, lcp = wider, common
        at[:active] = place
    return bwt, lcp


def walk(bwt: np.ndarray, lengths: np.ndarray):
    """For suffix lengths 1, 2, ...: (texts, where their suffix of that length stands)."""
    order = np.argsort(bwt, kind="stable")
    step = np.empty(len(bwt), np.int64)
    step[order] = np.arange(len(bwt))
    m = len(lengths)
    step += m - (len(bwt) - int(np.count_nonzero(bwt)))
    texts = np.argsort(-lengths, kind="stable")
    sizes = -lengths[texts]
    at = texts.astype(np.int64)
    for j in range(1, int(lengths.max(initial=0)) + 1):
        active = int(np.searchsorted(sizes, -j, "right"))
        at = step[at[:active]]
        yield texts[:active], at
