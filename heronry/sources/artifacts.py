"""Chunks, embeddings, evaluation sets and results as files: Parquet at scale, JSON for exchange."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK = "struct<id:string,source:string,license:string,tier:string,heading:string,tokens:int,text:string>"


def write_chunks(chunks: DataFrame, path: str) -> None:
    chunks.write.mode("overwrite").parquet(path)


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def chunks_json(spark: SparkSession, path: str) -> DataFrame:
    """Chunks of an exchange file {version, chunks: [...]}, with their place in it."""
    raw = spark.read.schema(f"version int, chunks array<{CHUNK}>").option("multiLine", True).option("mode", "FAILFAST").json(path)
    return raw.select(F.posexplode("chunks").alias("chunk_ord", "c")).select("chunk_ord", "c.*")


def embeddings_json(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Embeddings (id, embedding) and their one-row description (model, dim) of {model, dim, vectors: {id: [...]}}; a value that is no number fails."""
    raw = spark.read.schema("model string, dim int, vectors map<string,array<float>>").option("multiLine", True).option("mode", "FAILFAST").json(path)
    return raw.select(F.explode("vectors").alias("id", "embedding")), raw.select("model", "dim")


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def eval_set(spark: SparkSession, path: str) -> DataFrame:
    """(ord, id, query, expected) of {version, queries: [...]}."""
    raw = spark.read.schema("version int, queries array<struct<id:string,query:string,expected:array<string>>>").option("multiLine", True).option("mode", "FAILFAST").json(path)
    return raw.select(F.posexplode("queries").alias("ord", "q")).select("ord", "q.*")
