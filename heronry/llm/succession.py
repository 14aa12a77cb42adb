"""Each row's successor in a total order, without sorting the table in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import written


def successors(keys: DataFrame, order: str, tie: str) -> DataFrame:
    """The columns of ``keys``, next_<order> and next_<tie>: the row after each in descending ``order``, ties by ``tie``; after the last, the first.

    Keys alone are dealt out by range and written, so that both reads below
    see the same parts. Within a part a window gives the successor; a part's
    last row takes the first row of the next part that has any. Only one row
    for each part meets in one task. No null may be among the keys.
    """
    by = [F.desc(order), F.col(tie)]
    n = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = written(keys.repartitionByRange(n, *by).withColumn("part", F.spark_partition_id()), "order")
    within = Window.partitionBy("part").orderBy(*by)
    here = F.struct(order, tie)
    first = parts.groupBy("part").agg(F.min_by(here, F.struct((-1 - F.col(order)).alias(order), tie)).alias("first"))
    over = Window.orderBy("part")
    every = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = first.select("part", F.coalesce(F.lead("first").over(over), F.first("first").over(every)).alias("after"))
    found = parts.withColumn("x", F.lead(here).over(within)).join(F.broadcast(after), "part").withColumn("x", F.coalesce("x", "after"))
    return found.select(*keys.columns, F.col(f"x.{order}").alias(f"next_{order}"), F.col(f"x.{tie}").alias(f"next_{tie}"))
