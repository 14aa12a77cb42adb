"""From raw documents to packed training sequences, a written table between the stages.

Every stage works on all rows that the one before it kept:

1. ``quality``: a co-trained classifier scores each document; those under the threshold go.
2. ``near_duplicates``: of each class of near copies (word 5-shingles, similarity 0.8) the smallest id stays.
3. ``repeats``: byte strings of 50 that an earlier document has are cut out.
4. ``private``: personal data gives way to the name of its kind.
5. ``packing``: token sequences are packed into windows of 2048.

All but the last return the columns of ``documents``; ``n_chars`` follows the
text where a stage changes it. A null text counts as empty. Tables may be empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heronry.llm import packing, pii, quality, simhash, suffixdedup
from heronry.llm.queries import table, vocabulary
from heronry.llm.scratch import step, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def judge(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    model = quality.learn(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model, keep=[F.col(c) for c in COLUMNS]).where(F.col("score") >= quality.KEEP).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    docs = docs.select(*COLUMNS)
    return simhash.keep_first(docs, simhash.near_copies(docs))


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings of 50 bytes that an earlier one has; characters cut at an edge go whole."""
    done = suffixdedup.remove_repeats(docs.select(*COLUMNS))
    text = F.when(F.col("n_removed") == 0, F.col("kept").cast("string")).otherwise(suffixdedup.readable(F.col("kept")))
    return done.withColumn("text", text).withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data masked."""
    return pii.redact(docs.select(*COLUMNS)).withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their sequence and offset."""
    return packing.pack_texts(docs, vocabulary("byte_bpe_50k.json"), keep=[F.col("doc_id")])


STAGES: list[tuple[str, Stage]] = [("quality", judge), ("near_duplicates", near_duplicates), ("repeats", repeats), ("private", private), ("packing", pack)]

#: The stages learn, hash and order suffixes, which SQL does not express; each is tested against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again; what a stage wrote on its way goes when it is done."""
    docs = table(spark, sf_dir, "documents")
    with step(spark):
        for name, stage in STAGES[:-1]:
            with step(spark):
                docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
