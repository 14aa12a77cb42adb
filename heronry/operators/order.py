"""Ranks without limit, of groups too large for one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import written


def numbered(rows: DataFrame, group: str, order: list[Column], name: str = "rank") -> DataFrame:
    """``rows`` with their place in ``order`` within their group, from 1, as int.

    Rows are dealt by range of group and order and written, so that both reads
    see the same parts. A part counts its own rows of each group; how many stand
    before it is a sum over the parts, at most one row for each part and group
    that meet. A group that one task could not hold is in many parts.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = written(rows.repartitionByRange(parts, F.col(group), *order).withColumn("__part", F.spark_partition_id()), "dealt")
    before = F.sum("__n").over(Window.partitionBy(group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    sums = dealt.groupBy(F.col(group), "__part").agg(F.count("*").alias("__n"))
    offsets = sums.select(F.col(group).alias("__group"), F.col("__part").alias("__at"), F.coalesce(before, F.lit(0)).alias("__before"))
    own = F.row_number().over(Window.partitionBy("__part", group).orderBy(*order))
    found = dealt.withColumn("__own", own).join(offsets, F.col(group).eqNullSafe(F.col("__group")) & (F.col("__part") == F.col("__at")))
    return found.withColumn(name, (F.col("__own") + F.col("__before")).cast("int")).drop("__part", "__own", "__group", "__at", "__before")
