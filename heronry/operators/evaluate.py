"""Recall of retrieval strategies over a set of queries with known answers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.scores import recall_at
from . import search as R

#: Hits that are looked at.
HITS = 10
#: Takes queries (qid, query); gives (qid, rank, doc).
Strategy = Callable[[DataFrame], DataFrame]


def problems(queries: DataFrame) -> DataFrame:
    """(ord, kind, problem): repeated ids, empty needles, empty expected sets, in the order of the queries."""
    nth = F.row_number().over(Window.partitionBy("id").orderBy("ord"))
    rows = queries.withColumn("nth", nth)
    texts = F.array(
        F.struct(F.lit(0).alias("kind"), F.when(F.col("nth") > 1, F.concat(F.lit("duplicate query id: "), "id")).alias("problem")),
        F.struct(F.lit(1).alias("kind"), F.when(T.blank(F.col("query")), F.concat(F.lit("query "), "id", F.lit(" has an empty needle"))).alias("problem")),
        F.struct(F.lit(2).alias("kind"), F.when(F.size("expected") == 0, F.concat(F.lit("query "), "id", F.lit(" has an empty expected set"))).alias("problem")),
    )
    return rows.select("ord", F.inline(texts)).where("problem is not null").orderBy("ord", "kind")


def missing(queries: DataFrame, sources: DataFrame) -> DataFrame:
    """(id, doc): expected documents that no source is; none if there are no sources."""
    wanted = queries.select("id", F.explode("expected").alias("doc"))
    some = sources.select(F.lit(1).alias("one")).limit(1)
    return wanted.join(sources.select(F.col("name").alias("doc")), "doc", "left_anti").join(F.broadcast(some)).select("id", "doc")  # one row at most


def fulltext_docs(searcher: R.Searcher) -> Strategy:
    """File stems in their order; equal stems are not merged."""
    return lambda queries: searcher(queries).select("qid", "rank", T.stem(F.col("file")).alias("doc"))


def _first_ranks(hits: DataFrame) -> DataFrame:
    best = hits.groupBy("qid", F.col("source").alias("doc")).agg(F.min("rank").alias("r"))
    return best.select("qid", F.row_number().over(Window.partitionBy("qid").orderBy("r")).alias("rank"), "doc")


def cosine_docs(store: DataFrame, vectors: Callable[[DataFrame], DataFrame], k: int = 10) -> Strategy:
    """Sources of the first ``k`` chunks, each at its best place. ``vectors`` adds the queries' vectors."""
    return lambda queries: _first_ranks(R.cosine(vectors(queries), store, k))


def hybrid_docs(store: DataFrame, bm25: R.Ranked, vectors: Callable[[DataFrame], DataFrame], k: int = 10) -> Strategy:
    return lambda queries: R.hybrid(vectors(queries), store, bm25, k).select("qid", "rank", F.col("source").alias("doc"))


def run(queries: DataFrame, strategy: Strategy) -> DataFrame:
    """(ord, id, query, hits, recall_5, recall_10), all queries in one plan; hits are the first HITS."""
    asked = queries.select(F.col("ord").alias("qid"), "query")
    hits = strategy(asked).where(F.col("rank") <= HITS).groupBy("qid").agg(F.array_sort(F.collect_list(F.struct("rank", "doc"))).alias("hs"))
    found = queries.join(hits, queries["ord"] == hits["qid"], "left")
    docs = F.coalesce(F.transform("hs", lambda h: h["doc"]), F.expr("cast(array() as array<string>)"))
    rows = found.withColumn("hits", docs)
    return rows.select("ord", "id", "query", "hits", recall_at(F.col("hits"), F.col("expected"), 5).alias("recall_5"), recall_at(F.col("hits"), F.col("expected"), 10).alias("recall_10"))


def overall(scores: DataFrame, strategy: str, corpus_hash: str = "") -> DataFrame:
    """One row: strategy, corpus_hash, and the mean recalls, 0 without queries."""
    mean = lambda c: F.coalesce(F.avg(c), F.lit(0.0)).alias(f"overall_{c}")
    return scores.agg(mean("recall_5"), mean("recall_10")).select(F.lit(strategy).alias("strategy"), F.lit(corpus_hash).alias("corpus_hash"), "overall_recall_5", "overall_recall_10")


def delta(result: DataFrame, baseline: DataFrame) -> DataFrame:
    """One row: how far the recalls are from a baseline's, rounded to three places, and signed."""
    b = baseline.select(F.col("overall_recall_5").alias("b5"), F.col("overall_recall_10").alias("b10"))
    d = result.join(F.broadcast(b))  # one row each
    signed = lambda x, y: F.format_string("%+.3f", F.col(x) - F.col(y))
    return d.select("strategy", signed("overall_recall_5", "b5").alias("delta_5"), signed("overall_recall_10", "b10").alias("delta_10"))
