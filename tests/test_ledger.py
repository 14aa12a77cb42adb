"""Embedding that goes on where it failed."""

import pytest

from heronry.errors import DimensionMismatch, EmbedError
from heronry.operators import embed
from heronry.plans import index
from heronry.sources import artifacts


@pytest.fixture
def chunks(spark):
    return spark.createDataFrame([(f"id{i:04d}", f"text {i}") for i in range(400)], "id string, text string").repartition(4)


def logged(at, fails_after=None, first=0):
    """An embedder that notes what it is asked; from ``fails_after`` calls of a process on it fails."""

    def call(inputs):
        import os
        import uuid

        from heronry.errors import EmbedError

        seen = sum(1 for _ in at.iterdir())
        if fails_after is not None and seen >= fails_after:
            raise EmbedError("server is down")
        (at / f"{os.getpid()}-{uuid.uuid4().hex}").write_text("\n".join(inputs))
        return [[float(len(x)), 1.0] for x in inputs]

    return call


def asked(at):
    return [line for f in at.iterdir() for line in f.read_text().split("\n")]


def test_a_run_that_failed_leaves_its_vectors(spark, chunks, tmp_path, monkeypatch):
    monkeypatch.setattr(embed, "PAUSE", 0.01)
    one, two = tmp_path / "one", tmp_path / "two"
    one.mkdir(), two.mkdir()
    ledger = embed.Ledger(spark, str(tmp_path / "ledger"), "a/model:1")
    with pytest.raises(Exception, match="server is down"):
        embed.embed(chunks, logged(one, fails_after=36), batch=10, ledger=ledger).count()
    kept = ledger.done().count()
    assert kept == len(set(asked(one))) >= 350
    found = embed.embed(chunks, logged(two), batch=10, ledger=ledger)
    assert {r["id"]: list(r["embedding"]) for r in found.collect()} == {r["id"]: [float(len(r["text"])), 1.0] for r in chunks.collect()}
    assert len(asked(two)) == 400 - kept and not set(asked(one)) & set(asked(two))
    other = tmp_path / "three"
    other.mkdir()
    embed.embed(chunks, logged(other), batch=10, ledger=embed.Ledger(spark, str(tmp_path / "ledger"), "another")).count()
    assert len(asked(other)) == 400  # vectors of another model are not taken


def test_existing_vectors_and_stale_ones(spark, chunks, tmp_path):
    at = tmp_path / "calls"
    at.mkdir()
    old = spark.createDataFrame([("id0001", [9.0, 9.0]), ("gone", [1.0, 1.0])], "id string, embedding array<float>")
    ledger = embed.Ledger(spark, str(tmp_path / "ledger"))
    found = {r["id"]: list(r["embedding"]) for r in embed.embed(chunks.limit(3).unionByName(chunks.where("id = 'id0001'")), logged(at), old, ledger=ledger).collect()}
    assert found["id0001"] == [9.0, 9.0] and "gone" not in found and "text 1" not in asked(at)


def test_a_failing_call_is_tried_again_and_a_wrong_answer_is_not():
    calls = []

    def busy(inputs):
        calls.append(1)
        if len(calls) < 3:
            raise EmbedError("busy")
        return [[1.0]] * len(inputs)

    assert embed.tried(busy, ["x"], pause=0.0) == [[1.0]]
    with pytest.raises(EmbedError):
        embed.tried(lambda xs: (_ for _ in ()).throw(EmbedError("down")), ["x"], tries=2, pause=0.0)
    calls.clear()
    with pytest.raises(DimensionMismatch):
        embed.tried(lambda xs: calls.append(1) or [], ["x"], pause=0.0)
    assert len(calls) == 1


@pytest.mark.parametrize("kept", [False, True])
def test_so_many_calls_at_once(spark, chunks, tmp_path, kept):
    at = tmp_path / "calls"
    at.mkdir()
    found = embed.embed(chunks, logged(at), batch=10, limit=2, ledger=embed.Ledger(spark, str(tmp_path / "ledger")) if kept else None)
    assert found.count() == 400
    assert len({f.name.split("-")[0] for f in at.iterdir()}) <= 2  # as many tasks, each in a worker of its own


def test_an_index_goes_on_after_a_failure(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(embed, "PAUSE", 0.01)
    at = tmp_path / "calls"
    at.mkdir()
    rows = spark.createDataFrame([(f"id{i:03d}", f"text {i}") for i in range(100)], "id string, text string").repartition(2)
    artifacts.write_chunks(rows, str(tmp_path / "index" / "chunks"))
    with pytest.raises(Exception, match="server is down"):
        index.embed_index(spark, str(tmp_path / "index"), logged(at, fails_after=5))
    assert index.described(spark, str(tmp_path / "index")) is None
    before = len(asked(at))
    report = index.embed_index(spark, str(tmp_path / "index"), logged(at)).first()
    assert report["vectors"] == 100 and len(asked(at)) == 100 and before >= 60
    assert not (tmp_path / "index" / "ledger" / embed.MODEL).exists()
    assert index.embed_index(spark, str(tmp_path / "index"), logged(at)).first()["reused"] == 100
