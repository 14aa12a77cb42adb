"""Building and loading an index: manifest, files, chunks, vectors."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import Accumulator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import EvalError, StoreError
from ..operators import chunk, embed, evaluate, scan, store
from ..operators.postings import InvertedIndex
from ..operators.search import Searcher, fulltext
from ..sources import artifacts, corpus, manifest, ranges

Progress = Callable[[str, int], None]
#: Bytes of a text file that may stand in a row.
LARGE = 1 << 28


def chunk_corpus(spark: SparkSession, folder: str, on_source: Progress | None = None) -> DataFrame:
    """Chunks of every source of the folder's manifest, in its order. A source without a file fails.

    Text files of over LARGE bytes, which trees may be, are read in ranges and never stand in a row; their chunks are the same.
    """
    corpus.settle(spark, folder)
    sources = manifest.read(spark, f"{folder}/manifest.json").withColumn("file", manifest.file_name(F.col("name"), F.col("format")))
    large = sources.where("format = 'text'").join(corpus.lengths(spark, folder).where(F.col("length") > LARGE), "file").select("ord", "name", "license", "tier", "file", "uri", "length")
    few = large.collect()  # of a manifest's sources
    whole = corpus.files(spark, folder, LARGE if few else None)
    joined = sources.where(~F.col("file").isin([r["file"] for r in few])).join(whole, "file", "left")
    content = F.when(F.col("content").isNull(), F.raise_error(F.concat(F.lit("no file "), "file"))).otherwise(corpus.strict_text(F.col("content")))
    made = chunk.chunks(joined.withColumn("content", content))
    if few:
        docs = spark.createDataFrame([(r["ord"], r["name"], r["license"], r["tier"]) for r in few], "ord long, name string, license string, tier string")
        made = made.unionByName(scan.chunks(docs, ranges.sections(spark, [(r["ord"], r["uri"], r["length"]) for r in few])))
    if on_source is not None:
        for r in made.groupBy("source_ord", "source").count().orderBy("source_ord").collect():  # a row a source
            on_source(r["source"], r["count"])
    return made


def chunk_tree(spark: SparkSession, folder: str, name: str, *, license: str, tier: str, ord: int = 0) -> DataFrame:
    """Chunks of a source tree of any size, as of its text in one row: its files stay rows."""
    docs = spark.createDataFrame([(ord, name, license, tier)], "ord long, name string, license string, tier string")
    return scan.chunks(docs, scan.file_sections(corpus.tree_files(spark, folder).withColumn("doc", F.lit(ord).cast("long"))))


def build(spark: SparkSession, folder: str, index: str, call: embed.Embedder, *, model: str = embed.MODEL, on_source: Progress | None = None) -> DataFrame:
    """Write chunks, their inverted index, embeddings and a description under ``index``; one row: chunks, vectors, reused, dim.

    Vectors of an index of the same model are used again. They are written to
    a new folder, which the description then names.
    """
    made = chunk_corpus(spark, folder, on_source)
    artifacts.write_chunks(made, f"{index}/chunks")
    InvertedIndex.write(artifacts.read_chunks(spark, f"{index}/chunks"), f"{index}/postings")
    return embed_index(spark, index, call, model=model)


def embed_index(spark: SparkSession, index: str, call: embed.Embedder, *, model: str = embed.MODEL, done: Accumulator | None = None, limit: int = 0) -> DataFrame:
    """Embed the chunks of an index that have no vector of this model yet; one row: chunks, vectors, reused, dim.

    ``done`` counts embedded chunks while tasks run. Batches are kept under
    ``index`` as they are made, until the description names their vectors, so a
    run that fails near its end costs the next one only what was left.
    """
    chunks = artifacts.read_chunks(spark, f"{index}/chunks")
    old = described(spark, index)
    existing = spark.read.parquet(f"{index}/{old['vectors']}") if old is not None and old["model"] == model else None
    turn = old["turn"] + 1 if old is not None else 0
    found = f"embeddings-{turn}"
    ledger = embed.Ledger(spark, f"{index}/ledger", model)
    embed.embed(chunks, call, existing, done=done, ledger=ledger, limit=limit).write.mode("overwrite").parquet(f"{index}/{found}")
    vectors = spark.read.parquet(f"{index}/{found}")
    dim = embed.dimension(vectors)
    result = embed.report(chunks, vectors, existing).first()
    spark.createDataFrame([(model, dim, found, turn)], "model string, dim int, vectors string, turn int").coalesce(1).write.mode("overwrite").parquet(f"{index}/meta")
    ledger.clear()
    return spark.createDataFrame([result], "chunks long, vectors long, reused long, dim int")


def described(spark: SparkSession, index: str):
    """The index's description, or None."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{index}/meta")
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.parquet(f"{index}/meta").first()


def load_store(spark: SparkSession, index: str) -> DataFrame:
    """The checked vector store of an index."""
    about = described(spark, index)
    if about is None:
        raise StoreError(f"no index in {index}")
    chunks, vectors = artifacts.read_chunks(spark, f"{index}/chunks"), spark.read.parquet(f"{index}/{about['vectors']}")
    store.validate(chunks, vectors, about["dim"])
    return store.load(chunks, vectors)


def load(spark: SparkSession, index: str) -> tuple[DataFrame, InvertedIndex]:
    """The store and the inverted index of the same chunks."""
    return load_store(spark, index), InvertedIndex(spark, f"{index}/postings")


def searcher(spark: SparkSession, folder: str, k: int | None = None) -> Searcher:
    """Full-text search over a corpus folder, of all hits or the first ``k``; bytes that are not UTF-8 are replaced."""
    files = corpus.files(spark, folder).select("file", corpus.lossy_text(F.col("content")).alias("text"))
    return lambda queries: fulltext(queries, files, k=k)


def strategy(spark: SparkSession, name: str, *, folder: str, index: str, vectors: Callable[[DataFrame], DataFrame]) -> evaluate.Strategy:
    """The named strategy over what is stored; an index that cannot be loaded fails here, not when it is asked."""
    if name == "fulltext":
        return evaluate.fulltext_docs(searcher(spark, folder, evaluate.HITS))
    try:
        if name == "hybrid":
            return evaluate.hybrid_docs(*load(spark, index), vectors)
        return evaluate.cosine_docs(load_store(spark, index), vectors)
    except StoreError as e:
        raise EvalError(f"cannot load {index}: {e}") from e
