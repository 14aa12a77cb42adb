"""The best hits of many queries, kept while a task reads its rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


class Best:
    """For each of ``n`` queries the ``k`` best (score, id) seen so far, each id once; ties go to the smaller id."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.held: list[list[tuple[float, object]]] = [[] for _ in range(n)]
        self.least = np.full(n, -np.inf)

    def candidates(self, q: int, scores: np.ndarray, slack: float = 0.0) -> np.ndarray:
        """Rows that may be among the best of query ``q``, if scores are right to within ``slack``."""
        rows = np.flatnonzero(scores >= self.least[q] - slack)
        if len(rows) > 4 * self.k:  # ids may repeat, so equal scores are never cut apart
            some = scores[rows]
            distinct = np.unique(some)
            rows = rows[some >= distinct[max(len(distinct) - self.k, 0)] - slack] if len(distinct) > self.k else rows
        return rows

    def add(self, q: int, scores: list[float], ids: list) -> None:
        rows = sorted({(-s, i) for s, i in zip(scores, ids, strict=True)} | set(self.held[q]))[: self.k]
        self.held[q] = rows
        if len(rows) == self.k:
            self.least[q] = -rows[-1][0]

    def batches(self, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
        """(q, id, score) of all that is held."""
        rows = [(q, i, -s) for q, held in enumerate(self.held) for s, i in held]
        yield pa.record_batch([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], kind), pa.array([r[2] for r in rows], pa.float64())], names=["q", "id", "score"])
