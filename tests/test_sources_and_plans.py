import hashlib
import json

import pytest
from pyspark.sql import functions as F

from heronry import cli, scratch
from heronry.errors import EvalError, FetchError, HashMismatch, ManifestError, SearchError, StoreError
from heronry.operators import chunk, evaluate, store
from heronry.plans import index
from heronry.sources import artifacts, corpus, manifest
from heronry.streaming import ingest as stream

HTML = "<h1>Ownership</h1><p>borrow checker</p><h2>Traits</h2><p>generic code</p>"


def write_manifest(folder, *sources, version=1):
    folder.mkdir(exist_ok=True, parents=True)
    (folder / "manifest.json").write_text(json.dumps({"version": version, "sources": list(sources)}))
    return str(folder)


def source(name, **more):
    return {"name": name, "license": "MIT", "url": f"https://x/{name}"} | more


def measure(inputs):
    return [[float(len(x)), 1.0] for x in inputs]


def test_defaults_and_order(spark, tmp_path):
    at = write_manifest(tmp_path / "c", source("b"), source("a", format="text", tier="docs-wiki"))
    rows = manifest.read(spark, f"{at}/manifest.json").orderBy("ord").collect()
    assert [(r["name"], r["tier"], r["format"], r["hash"]) for r in rows] == [("b", "pinned-source", "html", None), ("a", "docs-wiki", "text", None)]


@pytest.mark.parametrize("bad", [source("a", tier="gold"), source("a", format="pdf"), {"name": "a"}])
def test_unknown_values_fail(spark, tmp_path, bad):
    with pytest.raises(ManifestError):
        manifest.read(spark, write_manifest(tmp_path / "c", bad) + "/manifest.json")
    with pytest.raises(ManifestError):
        manifest.tier("gold")


def test_broken_json_fails(spark, tmp_path):
    (tmp_path / "m.json").write_text("{")
    with pytest.raises(ManifestError):
        manifest.read(spark, str(tmp_path / "m.json"))


def test_ingest_fetches_once_repairs_and_pins(spark, tmp_path):
    at = write_manifest(tmp_path / "c", source("a"), source("b", format="text"))
    log = tmp_path / "asked"  # executors fetch, so what they are asked goes to a file

    def fetch(url):
        with log.open("a") as f:
            f.write(f"{url}\n")
        return f"content {url[-1]}".encode()

    report = corpus.ingest(spark, manifest.read(spark, f"{at}/manifest.json"), at, fetch)
    assert corpus.fetched_count(report) == 2
    assert (tmp_path / "c" / "a.html").read_bytes() == b"content a"
    pinned = manifest.read(spark, f"{at}/manifest.json")
    assert {r["name"]: r["hash"] for r in pinned.collect()}["b"] == hashlib.sha256(b"content b").hexdigest()
    assert corpus.fetched_count(corpus.ingest(spark, pinned, at, fetch)) == 0
    (tmp_path / "c" / "b.txt").write_text("damaged")
    again = corpus.ingest(spark, manifest.read(spark, f"{at}/manifest.json"), at, fetch)
    assert [r["action"] for r in again.orderBy("ord").collect()] == ["skipped", "fetched"]
    assert sorted(log.read_text().split()) == ["https://x/a", "https://x/b", "https://x/b"]


def test_a_mismatch_publishes_nothing(spark, tmp_path):
    at = write_manifest(tmp_path / "c", source("a"), source("b", hash="0" * 64))
    with pytest.raises(HashMismatch):
        corpus.ingest(spark, manifest.read(spark, f"{at}/manifest.json"), at, lambda url: b"x")
    assert [f.name for f in (tmp_path / "c").iterdir()] == ["manifest.json"]


def test_local_sources_are_files_or_trees(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "A.java").write_text("A")
    (tmp_path / "one.txt").write_bytes(b"\xffone")
    at = write_manifest(tmp_path / "c", source("tree", url=f"file://{tmp_path}/t", format="text"), source("one", url=f"file://{tmp_path}/one.txt", format="text"))
    assert corpus.fetched_count(corpus.ingest(spark, manifest.read(spark, f"{at}/manifest.json"), at)) == 2
    assert (tmp_path / "c" / "tree.txt").read_text() == "===== FILE: A.java =====\nA\n"
    assert (tmp_path / "c" / "one.txt").read_bytes() == b"\xffone"
    assert sorted(f.name for f in (tmp_path / "c").iterdir()) == ["manifest.json", "one.txt", "tree.txt"]
    for url in ("https://example.invalid/x", f"file://{tmp_path}/none"):
        with pytest.raises(FetchError):
            corpus.local_fetcher(spark)(url)


def test_a_corpus_that_is_not_there_fails(spark, tmp_path):
    with pytest.raises(SearchError):
        index.searcher(spark, str(tmp_path / "none"))
    assert cli.main(["query", "borrow", str(tmp_path / "none")]) == 1


def test_searchers_are_interchangeable(spark, tmp_path):
    """A strategy asks whatever searcher it is given."""
    (tmp_path / "a.txt").write_bytes(b"One needle\xff\nno more")
    (tmp_path / "b.html").write_text("needle needle")
    (tmp_path / "c.md").write_text("needle")
    asked = spark.createDataFrame([(0, "needle")], "qid int, query string")
    found = index.searcher(spark, str(tmp_path))
    assert [(r["file"], r["matches"]) for r in found(asked).orderBy("rank").collect()] == [("b.html", 2), ("a.txt", 1)]
    upside = lambda queries: found(queries).withColumn("rank", 3 - F.col("rank"))
    assert [r["doc"] for r in evaluate.fulltext_docs(upside)(asked).orderBy("rank").collect()] == ["a", "b"]


def test_strategies_report_what_cannot_be_loaded(spark, tmp_path):
    for name in ("cosine", "hybrid"):
        with pytest.raises(EvalError):
            index.strategy(spark, name, folder="none", index=str(tmp_path / "none"), vectors=lambda queries: queries)


def test_a_manifest_names_its_corpus(spark, tmp_path):
    at = write_manifest(tmp_path / "c", source("a")) + "/manifest.json"
    assert manifest.digest_of(spark, at) == hashlib.sha256((tmp_path / "c" / "manifest.json").read_bytes()).hexdigest()
    assert manifest.digest_of(spark, str(tmp_path / "none.json")) == ""


def test_trees_come_in_the_order_of_path_components(spark, tmp_path):
    for name, text in {"b/B.java": "B", "a/A.java": "A", "a.java": "top", "notes.txt": "no", "c/M.tla": "M"}.items():
        f = tmp_path / "t" / name
        f.parent.mkdir(exist_ok=True, parents=True)
        f.write_text(text)
    got = corpus.tree(spark, str(tmp_path / "t")).first()["text"]
    assert got == "".join(f"===== FILE: {n} =====\n{t}\n" for n, t in (("a/A.java", "A"), ("a.java", "top"), ("b/B.java", "B"), ("c/M.tla", "M")))


def build(spark, tmp_path, call=measure, model="m"):
    at = write_manifest(tmp_path / "c", source("book"), source("model", format="text", tier="docs-wiki"))
    (tmp_path / "c" / "book.html").write_text(HTML)
    (tmp_path / "c" / "model.txt").write_text("VARIABLE x\nNext == x' = x + 1\n")
    return index.build(spark, at, str(tmp_path / "index"), call, model=model).first().asDict()


def test_an_index_is_built_reused_and_loaded(spark, tmp_path):
    assert build(spark, tmp_path) == {"chunks": 2, "vectors": 2, "reused": 0, "dim": 2}
    first = sorted(map(tuple, spark.read.parquet(str(tmp_path / "index" / "chunks")).collect()))

    def never(inputs):
        raise AssertionError("all vectors are there")

    assert build(spark, tmp_path, never)["reused"] == 2
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "index" / "chunks")).collect())) == first
    assert build(spark, tmp_path, measure, "other")["reused"] == 0
    rows, words = index.load(spark, str(tmp_path / "index"))
    assert rows.count() == 2
    assert words.stats.first()["n"] == 2
    assert store.size(rows) == 2 and not store.is_empty(rows)
    assert store.chunk(rows, rows.first()["id"]).count() == 1 and store.is_empty(store.chunk(rows, "none"))


def test_embedding_counts_what_is_done(spark, tmp_path):
    build(spark, tmp_path)
    done = spark.sparkContext.accumulator(0)
    report = index.embed_index(spark, str(tmp_path / "index"), measure, model="third", done=done).first()
    assert done.value == 2 and report["reused"] == 0


def test_loading_without_an_index_fails(spark, tmp_path):
    with pytest.raises(StoreError):
        index.load_store(spark, str(tmp_path / "none"))


def test_exchange_files(spark, tmp_path):
    row = {"id": "x", "source": "s", "license": "MIT", "tier": "docs-wiki", "heading": "h", "tokens": 1, "text": "t"}
    (tmp_path / "chunks.json").write_text(json.dumps({"version": 1, "chunks": [row]}))
    (tmp_path / "vectors.json").write_text(json.dumps({"model": "m", "dim": 2, "vectors": {"x": [1, 2.5]}}))
    assert artifacts.chunks_json(spark, str(tmp_path / "chunks.json")).first()["text"] == "t"
    vectors, about = artifacts.embeddings_json(spark, str(tmp_path / "vectors.json"))
    assert list(vectors.first()["embedding"]) == [1.0, 2.5]
    assert about.first()["dim"] == 2


def test_streamed_chunks_equal_batch_chunks(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"d{i}", "MIT", "docs-wiki", "html", HTML * (i + 1)) for i in range(5)], stream.SCHEMA)
    docs.write.parquet(str(tmp_path / "in"))
    for _ in range(2):
        stream.keep(stream.arriving(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, chunk.chunks(docs).collect()))


def test_command_line(spark, tmp_path, capsys):
    build(spark, tmp_path)
    at, where = str(tmp_path / "c"), str(tmp_path / "index")
    assert cli.main(["query", "borrow", at]) == 0
    assert "1. book.html (1 match)" in capsys.readouterr().out
    assert cli.main(["query", "--tier", "docs-wiki", "borrow", at]) == 2
    assert cli.main(["chunk", at, where]) == 0
    assert "     1 chunks  book" in capsys.readouterr().out
    sets = tmp_path / "set.json"
    sets.write_text(json.dumps({"version": 1, "queries": [{"id": "q", "query": "borrow", "expected": ["book"]}]}))
    assert cli.main(["eval", at, str(sets), "--results", str(tmp_path / "results")]) == 0
    assert "overall recall@5 1.000  recall@10 1.000  (strategy: fulltext)" in capsys.readouterr().out
    assert cli.main(["--server", "http://127.0.0.1:1", "query", "--embed", "borrow", where]) == 1


def test_a_step_leaves_its_last_table_alone(spark):
    before = scratch.written(spark.range(3), "before")
    with scratch.step(spark):
        middle = scratch.written(before, "middle")
        with scratch.step(spark):
            inner = scratch.written(middle, "inner")
        last = scratch.written(inner, "last")
    assert before.count() == last.count() == 3
    for gone in (middle, inner):
        with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist"):
            gone.collect()
    with pytest.raises(ZeroDivisionError), scratch.step(spark):
        kept, _ = scratch.written(last, "kept"), scratch.written(last, "other")
        1 / 0
    assert kept.count() == 3 and not scratch._steps.get()


class Lost(Exception):
    """What stops a driver in a test."""


def unpinned(spark, at):
    """The sources as the manifest has them now, whatever it will say."""
    rows = manifest.read(spark, f"{at}/manifest.json")
    return spark.createDataFrame(rows.collect(), rows.schema)


def held(at):
    return {f.name: f.read_bytes() for f in at.iterdir() if f.is_file() and not f.name.startswith(".")}


@pytest.mark.parametrize("moved", range(4))
def test_a_driver_lost_while_it_publishes_leaves_the_new_corpus(spark, tmp_path, monkeypatch, moved):
    at = write_manifest(tmp_path / "c", source("a"), source("b", format="text"))
    sources = unpinned(spark, at)
    corpus.ingest(spark, sources, at, lambda url: b"old " + url[-1].encode())
    for f in ("a.html", "b.txt"):
        (tmp_path / "c" / f).write_bytes(b"changed")
    move, left = corpus.Folder.move, [moved]

    def stopping(self, name, to):
        if not left[0]:
            raise Lost
        left[0] -= 1
        move(self, name, to)

    monkeypatch.setattr(corpus.Folder, "move", stopping)
    if moved < 3:
        with pytest.raises(Lost):
            corpus.ingest(spark, sources, at, lambda url: b"new " + url[-1].encode())
    else:
        corpus.ingest(spark, sources, at, lambda url: b"new " + url[-1].encode())
    monkeypatch.setattr(corpus.Folder, "move", move)
    assert {r["file"]: bytes(r["content"]) for r in corpus.files(spark, at).collect()} == {"a.html": b"new a", "b.txt": b"new b"}
    pinned = {r["name"]: r["hash"] for r in manifest.read(spark, f"{at}/manifest.json").collect()}
    assert pinned == {n: hashlib.sha256(f"new {n}".encode()).hexdigest() for n in "ab"}
    assert sorted(f.name for f in (tmp_path / "c").iterdir()) == ["a.html", "b.txt", "manifest.json"]


@pytest.mark.parametrize("where", ["fetch", "commit"])
def test_a_driver_lost_before_the_commit_leaves_the_old_corpus(spark, tmp_path, monkeypatch, where):
    at = write_manifest(tmp_path / "c", source("a"), source("b", format="text"))
    sources = unpinned(spark, at)
    corpus.ingest(spark, sources, at, lambda url: b"old " + url[-1].encode())
    (tmp_path / "c" / "a.html").write_bytes(b"changed")
    before = held(tmp_path / "c")

    def lost(*args):
        raise Lost

    monkeypatch.setattr(*((corpus.fetching, "fetched") if where == "fetch" else (corpus.Folder, "commit")), lost)
    with pytest.raises(Lost):
        corpus.ingest(spark, sources, at, lambda url: b"new")
    monkeypatch.undo()
    assert held(tmp_path / "c") == before
    assert corpus.files(spark, at).count() == 2
    monkeypatch.setattr(corpus, "ABANDONED", -1)
    assert corpus.fetched_count(corpus.ingest(spark, sources, at, lambda url: b"new")) == 2
    assert sorted(f.name for f in (tmp_path / "c").iterdir()) == ["a.html", "b.txt", "manifest.json"]


def test_each_source_is_fetched_by_a_task_and_tried_again(spark, tmp_path):
    log = tmp_path / "tries"
    log.mkdir()

    def fetch(url):
        import os
        import uuid

        from heronry.errors import FetchError

        (log / f"{url[-1]}-{os.getpid()}-{uuid.uuid4().hex}").touch()
        if url.endswith("b") and len(list(log.glob("b-*"))) < 2:
            raise FetchError("busy")
        if url.endswith("c"):
            raise FetchError("gone for good")
        return iter([b"in ", b"pieces"])

    at = write_manifest(tmp_path / "c", source("a"), source("b"))
    corpus.ingest(spark, manifest.read(spark, f"{at}/manifest.json"), at, fetch)
    assert held(tmp_path / "c").keys() == {"a.html", "b.html", "manifest.json"} and held(tmp_path / "c")["b.html"] == b"in pieces"
    assert len(list(log.glob("b-*"))) == 2
    import os

    assert all(int(f.name.split("-")[1]) != os.getpid() for f in log.iterdir())
    with pytest.raises(FetchError, match="gone for good"):
        corpus.ingest(spark, manifest.read(spark, write_manifest(tmp_path / "d", source("c")) + "/manifest.json"), str(tmp_path / "d"), fetch)
    assert [f.name for f in (tmp_path / "d").iterdir()] == ["manifest.json"] and len(list(log.glob("c-*"))) == 3


def test_a_tree_is_fetched_file_by_file(spark, tmp_path):
    """No more than one of its files is held, and the result is that of the one-row form."""
    for i in range(30):
        f = tmp_path / "t" / f"d{i % 4}" / f"F{i}.java"
        f.parent.mkdir(exist_ok=True, parents=True)
        f.write_bytes(f"class F{i} é".encode() + [b"", b"\xff", b"\xff\xff", b"\xe2\x82", b"\xf0\x9f\x98x", b"\xc0\x80", b"\xed\xa0\x80", b"\xf4\x90\x80\x80"][i % 8])
    (tmp_path / "t" / "skip.txt").write_text("no")
    found = list(corpus.fetching.local_pieces(f"file://{tmp_path}/t"))
    assert b"".join(found).decode() == corpus.tree(spark, str(tmp_path / "t")).first()["text"] and max(map(len, found)) < 100
