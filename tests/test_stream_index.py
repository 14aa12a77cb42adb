"""An index that follows a stream, against building from the documents as they are."""

import pytest
from pyspark.sql import functions as F

from heronry.operators import chunk
from heronry.operators.search import Bm25, counted
from heronry.streaming import index as stream


def doc(i, text, version=0, format_="html"):
    return (i, f"d{i}", "MIT", "docs-wiki", format_, text, version)


def page(*words):
    return "".join(f"<h1>{w}</h1><p>{w} common " + "filler " * 40 + "</p>" for w in words)


BATCHES = [
    [doc(1, page("alpha", "beta")), doc(2, page("gamma")), doc(3, page("alpha", "alpha"))],
    [doc(2, page("delta"), 1), doc(4, page("beta"))],
    [doc(1, page("alpha", "beta")), doc(2, page("late"), 0), doc(5, page("one"), 1), doc(5, page("two"), 2)],
    [doc(3, None, 1), doc(6, page("gamma", "gamma", "zeta"))],
]
NOW = [doc(1, page("alpha", "beta")), doc(2, page("delta"), 1), doc(4, page("beta")), doc(5, page("two"), 2), doc(6, page("gamma", "gamma", "zeta"))]


def same(spark, index):
    docs = spark.createDataFrame(NOW, stream.SCHEMA)
    want = chunk.chunks(docs)
    assert sorted(map(tuple, index.chunks().collect())) == sorted(map(tuple, want.collect()))
    direct, kept = Bm25(want), index.bm25()
    assert kept.stats.first() == direct.stats.first()
    assert sorted(kept.postings().collect()) == sorted(direct.postings().collect())
    asked = spark.createDataFrame([(0, "alpha beta"), (1, "common zeta")], "qid int, query string")
    assert sorted(map(tuple, kept.search(asked).collect())) == sorted(map(tuple, direct.search(asked).collect()))
    assert index.count() == len(NOW)


def test_a_followed_stream_equals_a_batch_build(spark, tmp_path):
    for i, rows in enumerate(BATCHES):
        spark.createDataFrame(rows, stream.SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        index = stream.StreamIndex(spark, str(tmp_path / "index"))  # each time as after a restart
        index.follow(spark.readStream.schema(stream.SCHEMA).parquet(str(tmp_path / "in"))).awaitTermination()
        if i == 1:
            index.compact()
    same(spark, index)
    index.follow(spark.readStream.schema(stream.SCHEMA).parquet(str(tmp_path / "in"))).awaitTermination()
    same(spark, stream.StreamIndex(spark, str(tmp_path / "index")))
    index.compact()
    index.clean()
    assert len(list((tmp_path / "index" / "chunks").iterdir())) == 1
    same(spark, stream.StreamIndex(spark, str(tmp_path / "index")))


def test_a_batch_counts_once_and_only_when_it_is_whole(spark, tmp_path, monkeypatch):
    index = stream.StreamIndex(spark, str(tmp_path / "index"))
    assert index.chunks().count() == 0 and index.count() == 0
    frames = [spark.createDataFrame(rows, stream.SCHEMA) for rows in BATCHES]
    index.upsert(frames[0], 0)
    name = stream.StreamIndex._name
    monkeypatch.setattr(stream.StreamIndex, "_name", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        index.upsert(frames[1], 1)
    assert index.count() == 3  # tables of a batch without its name do not count
    monkeypatch.setattr(stream.StreamIndex, "_name", name)
    for again in range(2):
        for i, rows in enumerate(frames):
            index.upsert(rows, i)
        if again == 0:
            index.compact()
    same(spark, index)


def test_null_ids_and_empty_batches(spark, tmp_path):
    index = stream.StreamIndex(spark, str(tmp_path / "index"))
    index.upsert(spark.createDataFrame([doc(None, "x"), doc(1, ""), doc(2, " ")], stream.SCHEMA), 0)
    index.upsert(spark.createDataFrame([], stream.SCHEMA), 1)
    assert index.count() == 2 and index.chunks().count() == 0
    index.compact()
    assert index.count() == 2 and index.bm25().stats.select(F.col("n")).first()["n"] == 0


def test_words_are_counted_in_the_chunks_as_written(spark, tmp_path, monkeypatch):
    """A batch is chunked once: its words come from the written chunks, not from its documents again."""
    seen = []
    monkeypatch.setattr(stream, "counted", lambda rows: seen.append(rows.inputFiles()) or counted(rows))
    index = stream.StreamIndex(spark, str(tmp_path))
    index.upsert(spark.createDataFrame([(1, "a", "MIT", "t", "text", "some words here", 0), (2, "b", "MIT", "t", "text", None, 0)], stream.SCHEMA), 0)
    assert seen[0] and all("/chunks/part=" in f for f in seen[0])
    assert index.count() == 1 and [r["text"].strip() for r in index.chunks().collect()] == ["some words here"]
    assert index.bm25().words.first()["dl"] == 3
