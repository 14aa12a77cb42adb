"""Command line: ingest, chunk, embed, query, eval, build-prompt."""

from __future__ import annotations

import argparse
import json
import os
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from . import __version__
from .errors import HeronryError, ManifestError
from .functions import text as T
from .operators import embed, evaluate, prompt, search
from .plans import index
from .sources import artifacts, corpus, manifest


def _vectors(call: embed.Embedder):
    """Adds vectors to a small table of queries, asked on the driver."""

    def add(queries):
        rows = [(r["qid"], r["query"], embed.query_vector(call, r["query"])) for r in queries.collect()]
        return queries.sparkSession.createDataFrame(rows, queries.select("qid", "query").withColumn("vector", F.expr("cast(null as array<double>)")).schema)

    return add


def _query(spark: SparkSession, a: argparse.Namespace) -> None:
    queries = spark.createDataFrame([(0, a.query)], "qid int, query string")
    if not (a.embed or a.hybrid):
        if a.tier:
            raise ManifestError("--tier only applies with --embed or --hybrid")
        hits = index.searcher(spark, a.where or "corpus")(queries).orderBy("rank").collect()
        if not hits:
            print(f"no hits for {a.query!r} in {a.where or 'corpus'}")
        for h in hits:
            print(f"{h['rank']}. {h['file']} ({h['matches']} match{'' if h['matches'] == 1 else 'es'})\n   {h['snippet']}")
        return
    asked = _vectors(embed.http_embedder(a.server))(queries)
    where = a.where or "index"
    if a.hybrid:
        store, words = index.load(spark, where)
        hits = search.hybrid(asked, store, words, search.TOP, a.tier)
    else:
        hits = search.cosine(asked, index.load_store(spark, where), search.TOP, a.tier)
    found = hits.withColumn("snippet", T.cut(F.col("text"), 140)).orderBy("rank").collect()
    if not found:
        print(f"no hits for {a.query!r}")
    for h in found:
        print(f"{h['rank']}. ({h['score']:.3f}) {h['source']} — {h['heading']}\n   {h['snippet']}\n   license: {h['license']} | tier: {h['tier']}")


def _eval(spark: SparkSession, a: argparse.Namespace) -> None:
    queries = artifacts.eval_set(spark, a.set)
    wrong = [r["problem"] for r in evaluate.problems(queries).collect()]
    if wrong:
        raise ManifestError("; ".join(wrong))
    at = f"{a.corpus}/manifest.json"
    for r in evaluate.missing(queries, manifest.read(spark, at).select("name")).collect():
        print(f"warning: query {r['id']} expects {r['doc']}, which is not in the corpus", file=sys.stderr)
    strategy = index.strategy(spark, a.strategy, folder=a.corpus, index=a.index, vectors=_vectors(embed.http_embedder(a.server)))
    scores = evaluate.run(queries, strategy)
    result = evaluate.overall(scores, a.strategy, manifest.digest_of(spark, at))
    for r in scores.orderBy("ord").collect():
        print(f"recall@5 {r['recall_5']:>5.3f}  recall@10 {r['recall_10']:>5.3f}  {r['id']:<24} {r['query']}")
    artifacts.write_json(result, f"{a.results}/{a.strategy}")
    artifacts.write_json(scores, f"{a.results}/{a.strategy}-queries")
    o = result.first()
    print(f"overall recall@5 {o['overall_recall_5']:>5.3f}  recall@10 {o['overall_recall_10']:>5.3f}  (strategy: {a.strategy})")
    for base in {"fulltext": [], "cosine": ["fulltext"], "hybrid": ["fulltext", "cosine"]}[a.strategy]:
        if os.path.isdir(f"{a.results}/{base}"):
            d = evaluate.delta(result, spark.read.json(f"{a.results}/{base}")).first()
            print(f"vs {base} baseline: recall@5 {d['delta_5']}  recall@10 {d['delta_10']}")


def _prompt(spark: SparkSession, a: argparse.Namespace) -> None:
    issue = json.loads(sys.stdin.read())
    issues = spark.createDataFrame([(issue["number"], issue["title"], issue["body"])], "number long, title string, body string")
    hits = None
    if not a.no_rag:
        try:
            queries = issues.select(F.col("number").alias("qid"), prompt.query_of(F.col("title"), F.col("body")).alias("query"))
            hits = search.cosine(_vectors(embed.http_embedder(a.server))(queries), index.load_store(spark, a.index), prompt.CONTEXT_CHUNKS)
            print(f"grounded with {hits.count()} chunk(s) from {a.index}", file=sys.stderr)
        except HeronryError as e:
            print(f"warning: retrieval failed ({e}); proceeding ungrounded", file=sys.stderr)
    print(prompt.build(issues, a.repo, hits).first()["prompt"], end="")


def _ingest(spark: SparkSession, a: argparse.Namespace) -> None:
    corpus.settle(spark, a.corpus)
    report = corpus.ingest(spark, manifest.read(spark, f"{a.corpus}/manifest.json"), a.corpus)
    for r in report.orderBy("ord").collect():
        print(f"{r['action']}  {r['name']}")
    print(f"{corpus.fetched_count(report)} fetched")


def _chunk(spark: SparkSession, a: argparse.Namespace) -> None:
    made = index.chunk_corpus(spark, a.corpus, lambda name, n: print(f"{n:>6} chunks  {name}"))
    artifacts.write_chunks(made, f"{a.index}/chunks")


def _embed(spark: SparkSession, a: argparse.Namespace) -> None:
    r = index.embed_index(spark, a.index, embed.http_embedder(a.server)).first()
    print(f"{r['vectors']} vectors ({r['reused']} reused), dim {r['dim']}")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="heronry")
    p.add_argument("--version", action="version", version=f"heronry {__version__}")
    p.add_argument("--server", default=embed.SERVER)
    sub = p.add_subparsers(dest="verb", required=True)

    def verb(name: str, run) -> argparse.ArgumentParser:
        s = sub.add_parser(name)
        s.set_defaults(run=run)
        return s

    s = verb("ingest", _ingest)
    s.add_argument("corpus", nargs="?", default="corpus")
    s = verb("chunk", _chunk)
    s.add_argument("corpus", nargs="?", default="corpus")
    s.add_argument("index", nargs="?", default="index")
    s = verb("embed", _embed)
    s.add_argument("index", nargs="?", default="index")
    s = verb("query", _query)
    s.add_argument("--embed", action="store_true")
    s.add_argument("--hybrid", action="store_true")
    s.add_argument("--tier", choices=manifest.TIERS)
    s.add_argument("query")
    s.add_argument("where", nargs="?")
    s = verb("eval", _eval)
    s.add_argument("--strategy", choices=("fulltext", "cosine", "hybrid"), default="fulltext")
    s.add_argument("corpus", nargs="?", default="corpus")
    s.add_argument("set", nargs="?", default="eval/evalset.json")
    s.add_argument("--index", default="index")
    s.add_argument("--results", default="eval/results")
    s = verb("build-prompt", _prompt)
    s.add_argument("repo", nargs="?", default="project")
    s.add_argument("--no-rag", action="store_true")
    s.add_argument("--index", default=os.environ.get("HERONRY_INDEX_DIR", "index"))
    return p


def main(args: list[str] | None = None) -> int:
    """0; 2 for what a user can mend in a call or manifest; 1 for what failed at run time."""
    a = parser().parse_args(args)
    spark = SparkSession.builder.appName("heronry").getOrCreate()
    try:
        a.run(spark, a)
    except ManifestError as e:
        print(f"heronry {a.verb}: {e}", file=sys.stderr)
        return 2
    except HeronryError as e:
        print(f"heronry {a.verb}: {e}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
