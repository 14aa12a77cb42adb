"""Helpers for Arrow batches inside tasks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` holds about ``limit`` bytes in each part.

    A single longer value stands alone; rows are never cut or dropped.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)).cumsum()
        start = 0
        while start < batch.num_rows:
            before = int(size[start - 1]) if start else 0
            end = max(start + 1, int(np.searchsorted(size, before + limit, "right")))
            yield batch.slice(start, end - start)
            start = end
