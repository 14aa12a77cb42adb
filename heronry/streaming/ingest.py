"""Chunking documents as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from ..operators import chunk

SCHEMA = "ord long, name string, license string, tier string, format string, content string"


def arriving(spark: SparkSession, folder: str) -> DataFrame:
    """Chunks of documents written to ``folder`` as Parquet; chunking keeps no state between documents."""
    return chunk.chunks(spark.readStream.schema(SCHEMA).parquet(folder))


def keep(chunks: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append chunks to a table of files; each document is taken once, also over restarts."""
    return chunks.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
