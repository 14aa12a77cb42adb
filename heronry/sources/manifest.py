"""The manifest: which sources make up a corpus, and their pinned hashes."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import ManifestError

TIERS = ("pinned-source", "docs-wiki", "navigational")
FORMATS = ("html", "text")
SCHEMA = "version int, sources array<struct<name:string,license:string,url:string,hash:string,tier:string,format:string>>"


def tier(name: str) -> str:
    if name not in TIERS:
        raise ManifestError(f"unknown tier {name!r} (expected {'|'.join(TIERS)})")
    return name


def read(spark: SparkSession, path: str) -> DataFrame:
    """(ord, version, name, license, url, hash, tier, format), defaults filled in; order is the ingestion order."""
    try:
        raw = spark.read.schema(SCHEMA).option("multiLine", True).option("mode", "FAILFAST").json(path)
        rows = of(raw)
        wrong = rows.where(~F.col("tier").isin(*TIERS) | ~F.col("format").isin(*FORMATS) | F.col("name").isNull() | F.col("license").isNull() | F.col("url").isNull()).limit(1).collect()
    except Exception as e:
        raise ManifestError(f"cannot read {path}: {e}") from e
    if wrong:
        raise ManifestError(f"source {wrong[0]['name']}: a field is missing, or its tier or format is unknown")
    return rows


def of(raw: DataFrame) -> DataFrame:
    s = raw.select("version", F.posexplode("sources").alias("ord", "s"))
    return s.select("ord", "version", "s.name", "s.license", "s.url", "s.hash", F.coalesce("s.tier", F.lit(TIERS[0])).alias("tier"), F.coalesce("s.format", F.lit(FORMATS[0])).alias("format"))


def file_name(name: Column, format_: Column) -> Column:
    return F.concat(name, F.when(format_ == "text", ".txt").otherwise(".html"))


def to_json(sources: DataFrame) -> str:
    """The manifest as indented JSON. A manifest is a hand-written list, so it is small."""
    rows = sources.orderBy("ord").collect()
    fields = ("name", "license", "url", "hash", "tier", "format")
    return json.dumps({"version": rows[0]["version"] if rows else 1, "sources": [{f: r[f] for f in fields if r[f] is not None} for r in rows]}, indent=2, ensure_ascii=False)


def digest(text: str) -> str:
    """What names a corpus in results: the hash of its manifest's bytes."""
    return hashlib.sha256(text.encode()).hexdigest()


def digest_of(spark: SparkSession, path: str) -> str:
    """The hash of the manifest file at ``path``, empty if there is none."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        return ""
    return spark.read.format("binaryFile").load(path).select(F.sha2("content", 256).alias("h")).first()["h"]
