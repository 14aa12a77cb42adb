"""Written tables in the folder that the cluster shares."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Paths of the tables written so far in each :func:`step` that is open here. A thread starts outside all
#: steps; one that should write for a step of its caller is run in a copy of the caller's context.
_steps: ContextVar[tuple[list[str], ...]] = ContextVar("steps", default=())


def folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a folder of our own only where it is unset and Spark runs in one process."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="heronry-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def place(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, which a :func:`step` that is open deletes."""
    path = f"{folder(spark)}/heronry-{name}-{uuid.uuid4().hex}"
    for made in _steps.get():
        made.append(path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: the lineage ends here.

    A lost executor costs only the tasks it ran: files of finished tasks stay.
    """
    spark = df.sparkSession
    path = place(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def step(spark: SparkSession) -> Iterator[None]:
    """Deletes the tables that were written inside it, by this thread, but for the last one, which must need none of the others.

    After an error they stay. Steps may stand inside each other.
    """
    made: list[str] = []
    outside = _steps.set((*_steps.get(), made))
    try:
        yield
    finally:
        _steps.reset(outside)
    for path in made[:-1]:
        _delete(spark, path)


def discard(df: DataFrame) -> None:
    """Delete the files behind a table of :func:`written` that is read no more."""
    for file in df.inputFiles()[:1]:
        path = file.rpartition("/")[0]
        if path.rpartition("/")[2].startswith("heronry-"):
            _delete(df.sparkSession, path)


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
