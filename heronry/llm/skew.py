"""Joins of many rows with one key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import written

#: A key of more rows than this, and than an even share of MOST keys, is joined where its rows are.
ROWS, MOST = 1000, 100_000
#: A table of more values than this is not broadcast.
VALUES = 1 << 22


def joined(rows: DataFrame, table: DataFrame, on: str) -> DataFrame:
    """The inner join of ``rows``, a written table, with ``table``, which has each key once.

    Rows of frequent keys stay where they are: there are fewer than MOST such
    keys, so what ``table`` has for these is broadcast. All others are shuffled.
    """
    limit = max(ROWS, rows.count() // MOST)
    hot = written(rows.where(F.col(on).isNotNull()).groupBy(on).count().where(F.col("count") > limit).select(on), "hot")
    if hot.isEmpty():
        return rows.join(table, on)
    few = F.broadcast(hot)
    return rows.join(F.broadcast(table.join(few, on, "left_semi")), on).unionByName(rows.join(few, on, "left_anti").join(table, on))


def beside(rows: DataFrame, table: DataFrame, on: str | list[str], values: Column | None = None) -> DataFrame:
    """The inner join of ``rows`` with ``table``, a written table, whose rows hold ``values`` values each (one, if not given).

    It is broadcast if its values are few; else both are shuffled, and Spark
    deals out the rows of frequent keys (``spark.sql.adaptive.skewJoin``).
    """
    size = table.agg(F.sum(F.lit(1) if values is None else values)).first()[0] or 0
    return rows.join(F.broadcast(table) if size <= VALUES else table.hint("merge"), on)
