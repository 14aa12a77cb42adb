"""The vector store: chunks and their vectors, checked against each other."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..errors import StoreError
from ..functions.scores import norm


def ghosts(chunks: DataFrame, vectors: DataFrame) -> DataFrame:
    """Ids with a vector but no chunk."""
    return vectors.select("id").join(chunks.select("id"), "id", "left_anti").distinct()


def orphans(chunks: DataFrame, vectors: DataFrame) -> DataFrame:
    """Ids with a chunk but no vector."""
    return chunks.select("id").join(vectors.select("id"), "id", "left_anti").distinct()


def misfits(vectors: DataFrame, dim: int) -> DataFrame:
    """(id, got) of vectors that are not of length ``dim``."""
    return vectors.where(F.size("embedding") != dim).select("id", F.size("embedding").alias("got"))


def validate(chunks: DataFrame, vectors: DataFrame, dim: int) -> None:
    for what, found in (("a vector without a chunk", ghosts(chunks, vectors)), ("a chunk without a vector", orphans(chunks, vectors)), (f"a vector not of length {dim}", misfits(vectors, dim))):
        first = found.orderBy("id").first()
        if first is not None:
            raise StoreError(f"inconsistent store: {what}: {first['id']}")


def last_chunks(chunks: DataFrame, order: tuple[str, ...] = ("source_ord", "chunk_ord")) -> DataFrame:
    """One row an id: the last in order. Each task lets one row of an id go on, with the columns that are read of it."""
    last = Window.partitionBy("id").orderBy(*[F.desc(c) for c in order])
    return chunks.withColumn("__nth", F.row_number().over(last)).where("__nth = 1").select("id", *[c for c in chunks.columns if c != "id"])


def load(chunks: DataFrame, vectors: DataFrame) -> DataFrame:
    """One row an id with its last chunk, vector and the vector's norm."""
    return last_chunks(chunks).join(vectors.select("id", "embedding"), "id").withColumn("norm", norm(F.col("embedding")))


def chunk(rows: DataFrame, id_: str) -> DataFrame:
    """The chunk with an id, or no row."""
    return rows.where(F.col("id") == id_)


def size(rows: DataFrame) -> int:
    """How many ids a store or list holds."""
    return rows.select("id").distinct().count()


def is_empty(rows: DataFrame) -> bool:
    return rows.isEmpty()
