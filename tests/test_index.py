"""The kept inverted index, needles and ranks, against plain versions."""

import random
import re
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from heronry.operators import needles, order, postings, search
from heronry.operators.postings import InvertedIndex


def texts(seed, n=400, words=60):
    r = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in "abcdefgh" for b in ("", "x", "yy", "zzz", "ing")]
    return [(f"id{i:05d}", " ".join(r.choices(vocabulary, [1 / (1 + j) for j in range(len(vocabulary))], k=r.randrange(words)))) for i in range(n)]


def asked(spark, *queries):
    return spark.createDataFrame(list(enumerate(queries)), "qid int, query string")


def plain(rows):
    return sorted((r["qid"], r["rank"], r["id"], r["score"]) for r in rows.collect())


QUERIES = ("a b c", "hing", "a a a hing gzzz", "nothere", "", "  ", "bx cx dx ex fx gx hx", "A, B; c-ing")


@pytest.mark.parametrize(("bits", "shards", "k"), [(2, 1, 10), (4, 7, 3), (10, 3, 1), (3, 2, 1000)])
def test_an_index_finds_what_the_words_give(spark, tmp_path, bits, shards, k):
    rows = texts(bits)
    chunks = spark.createDataFrame([*rows, rows[3], rows[3], rows[7], ("none", None), ("blank", ""), ("zz", "only"), ("zz", "only")], "id string, text string").repartition(5)
    index = InvertedIndex.write(chunks, str(tmp_path / "i"), bits=bits, shards=shards)
    direct = search.Bm25(chunks)
    q = asked(spark, *QUERIES)
    assert plain(index.search(q, k)) == plain(direct.search(q, k))
    again = InvertedIndex(spark, str(tmp_path / "i"))
    assert plain(again.search(q, k)) == plain(direct.search(q, k))
    assert sorted(again.postings().collect()) == sorted(direct.postings().collect())
    assert sorted(again.frequencies().collect()) == sorted(direct.frequencies().collect())
    assert again.stats.first() == direct.stats.first()


def test_an_index_takes_any_number_of_queries_and_none(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(search, "MOST_QUERIES", 4)
    chunks = spark.createDataFrame(texts(1), "id string, text string")
    index = InvertedIndex.write(chunks, str(tmp_path / "i"), bits=4)
    q = asked(spark, *(QUERIES * 3))
    assert plain(index.search(q, 5)) == plain(search.Bm25(chunks).search(q, 5))
    assert index.search(q.limit(0), 5).count() == 0 and index.search(q, 0).count() == 0
    assert InvertedIndex.write(chunks.limit(0), str(tmp_path / "e")).search(q, 5).count() == 0


def test_whole_numbers_may_be_ids(spark, tmp_path):
    chunks = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(texts(4))] + [(None, "a b")], "id long, text string")
    index = InvertedIndex.write(chunks, str(tmp_path / "i"), bits=4)
    assert plain(index.search(asked(spark, *QUERIES), 4)) == plain(search.Bm25(chunks.where("id is not null")).search(asked(spark, *QUERIES), 4))


def test_what_no_query_needs_is_not_read(spark, tmp_path):
    rows = [(f"i{i:05d}", "common filler words here " * 3 + ("rare rare rare" if i % 400 == 7 else "")) for i in range(4000)]
    index = InvertedIndex.write(spark.createDataFrame(rows, "id string, text string"), str(tmp_path / "i"), bits=5, shards=16)
    q = asked(spark, "rare common")
    assert [r["id"] for r in index.search(q, 10).orderBy("rank").collect()] == [f"i{400 * j + 7:05d}" for j in range(10)]
    read = index.read_of(q, 10)
    assert read["all"] == 16_010 and read["of_terms"] == 4010 and read["scored"] <= 10 * 33
    plan = index.of(["rare"]).select("span", "code", "peak")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*shard", plan) and "PushedFilters: [In(term, [rare])" in plan.replace("EqualTo(term,rare)", "In(term, [rare])").replace("IsNotNull(term), ", "")
    assert "tfs" not in re.search(r"ReadSchema: \S+", plan)[0]


def held(text, needle):
    low, n = text.lower(), needle.lower().strip()
    return low.count(n) if n and "\n" not in n else 0


def test_needles(spark):
    r = random.Random(3)
    files = [(f"f{i}", "".join(r.choice("abAB \n\r") for _ in range(r.randrange(200)))) for i in range(60)] + [("long", "x" * 300 + " aB\r\nab"), ("null", None), ("empty", "")]
    asks = ["a", "AB", "ba b", "aa", " aaa ", "b\na", "", "  ", "abab", "ab", "ΑΣ", "bb\r"]
    found = search.fulltext(asked(spark, *asks), spark.createDataFrame(files, "file string, text string").repartition(3)).collect()
    got = {(x["qid"], x["file"]): (x["matches"], x["snippet"]) for x in found}
    want = {}
    for q, ask in enumerate(asks):
        for f, t in files:
            n = held(t or "", ask)
            if n:
                line = next(x for x in re.split("\r?\n", t) if ask.lower().strip() in x.lower()).strip()
                want[q, f] = n, line if len(line) <= 240 else line[:240] + "…"
    assert got == want
    for q in range(len(asks)):
        rows = sorted(((-n, f) for (a, f), (n, _) in want.items() if a == q))
        assert [(-x["matches"], x["file"]) for x in sorted(found, key=lambda x: x["rank"]) if x["qid"] == q] == rows
    first = search.fulltext(asked(spark, *asks), spark.createDataFrame(files, "file string, text string"), k=3).collect()
    assert sorted(first) == sorted(x for x in found if x["rank"] <= 3)


def test_needles_in_several_automata(spark, monkeypatch):
    monkeypatch.setattr(needles, "MOST_CHARS", 12)
    files = spark.createDataFrame([("f", "one two three two")], "file string, text string")
    found = search.fulltext(asked(spark, "one", "two", "three", "four", "ne t", "a long needle indeed"), files).collect()
    assert {(x["qid"], x["matches"]) for x in found} == {(0, 1), (1, 2), (2, 1), (4, 1)}


def test_time_does_not_grow_with_the_needles():
    r = random.Random(1)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(8))
    text = " ".join(word() for _ in range(60_000))

    def took(n):
        automaton = needles.Needles([word() for _ in range(n)])
        began = time.process_time()
        automaton.found(text)
        return time.process_time() - began

    assert min(took(10_000) for _ in range(3)) < 6 * min(took(40) for _ in range(3)) + 0.05


def test_ranks_of_one_group_over_many_parts(spark):
    rows = spark.createDataFrame([(1 if i % 9 else None, (i * 7919) % 1000, f"f{i:05d}") for i in range(9000)] + [(2, 5, "x")], "qid int, matches int, file string")
    found = order.numbered(rows, "qid", [F.desc("matches"), F.col("file")])
    assert found.columns == ["qid", "matches", "file", "rank"]
    got = {(r["qid"], r["rank"]): r["file"] for r in found.collect()}
    for q, n in Counter(r["qid"] for r in rows.collect()).items():
        want = sorted((r for r in rows.where(F.col("qid").eqNullSafe(F.lit(q))).collect()), key=lambda r: (-r["matches"], r["file"]))
        assert [got[q, i + 1] for i in range(n)] == [r["file"] for r in want]
    assert order.numbered(rows.limit(0), "qid", [F.col("file")]).count() == 0


def test_a_needle_that_all_files_hold_is_ranked_in_many_tasks(spark):
    files = spark.createDataFrame([(f"f{i:05d}", "needle " * (i % 5 + 1)) for i in range(4000)], "file string, text string")
    found = search.fulltext(asked(spark, "needle"), files)
    parts = found.withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()
    assert sum(r["count"] for r in parts) == 4000 and max(r["count"] for r in parts) < 2500
    assert [r["file"] for r in found.orderBy("rank").limit(2).collect()] == ["f00004", "f00009"]


def test_blocks_are_made_a_span_at_a_time():
    """What a task makes of a batch does not grow with the batch, and blocks are those of whole spans."""
    n = 3000
    columns = [np.arange(500, 500 + n), np.ones(n, np.int64), np.full(n, 2)]
    batch = pa.record_batch([*map(pa.array, columns), pa.array([["a", f"w{i % 3}"] for i in range(n)]), pa.array([[1, 1]] * n, pa.list_(pa.int32()))], names=["row", "copies", "dl", "terms", "tfs"])
    found = list(postings._blocks(10, 2.0)(iter([batch])))
    assert all(len(set(b.column("span").to_pylist())) == 1 for b in found)
    blocks = {(r["term"], r["span"]): r["at"] for b in found for r in b.to_pylist()}
    assert sum(b.num_rows for b in found) == len(blocks) == 4 * 4
    assert sorted((s << 10) + x for (t, s), at in blocks.items() if t == "a" for x in at) == list(range(500, 500 + n))


def test_rows_of_many_batches_are_numbered(monkeypatch):
    """What is held of one batch meets the next one, also where Spark says that a column has no nulls; an id over an edge is one row."""
    monkeypatch.setattr(postings, "TaskContext", type("", (), {"get": staticmethod(lambda: type("", (), {"partitionId": lambda self: 0})())}))
    kind = pa.schema([("id", pa.string()), pa.field("copies", pa.int64(), nullable=False), ("dl", pa.int64()), ("terms", pa.list_(pa.string())), ("tfs", pa.list_(pa.int32()))])
    ids = sorted([*(f"{i:05d}" for i in range(4000)), "01023", "01024"])
    batch = pa.record_batch([pa.array(ids), pa.array([1] * len(ids)), pa.array([1] * len(ids)), pa.array([["a"]] * len(ids)), pa.array([[1]] * len(ids), pa.list_(pa.int32()))], schema=kind)
    rows = [r for b in postings._numbered(iter([batch, batch.slice(0, 0)])) for r in b.to_pylist()]
    assert [r["id"] for r in rows] == [f"{i:05d}" for i in range(4000)] and [r["row"] for r in rows] == list(range(4000))
    assert {r["id"] for r in rows if r["copies"] == 2} == {"01023", "01024"}
