"""Connected components of a graph of links, by alternating large and small stars.

Every round hooks the larger neighbours of each node to its smallest one, then
the smaller ones; the number of rounds grows with the logarithm of the longest
path. A node's minimum is an aggregate that Spark combines before the shuffle;
the links are joined back to it by that node, and a node with very many links
is split there by Spark's handling of skewed joins (``spark.sql.adaptive``).
Each round is written to the shared folder; the last one changes nothing.
Minima are taken of links as they are read and a join's two results are made in
one pass: each stage less spares the driver a task for every partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import discard, written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for each node that has a link; root is the smallest node reachable.

    Nodes may be of any ordered type. Null ends, self-links and repeated
    links say nothing and are ignored; no links give an empty result.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    edges = written(edges.distinct(), "links")
    n = edges.count()
    while n:
        ends = edges.select(F.col("v").alias("c"), "u").unionByName(edges.select(F.col("u").alias("c"), F.col("v").alias("u")))
        least = ends.groupBy("c").agg(F.min("u").alias("m")).select("c", F.least("c", "m").alias("m"))
        large = edges.join(least, edges["v"] == least["c"]).select("u", F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        # both the node and its smaller neighbours hook to the smallest one
        small = large.distinct().join(low, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).where("u <> v")
        after = written(small.distinct(), "links")
        before, n = n, after.count()
        same = n == before and after.join(edges, ["u", "v"], "left_anti").isEmpty()
        discard(edges)
        edges = after
        if same:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
