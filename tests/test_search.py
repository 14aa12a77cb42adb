import math

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from heronry.errors import DimensionMismatch, EmbedError, StoreError
from heronry.operators import embed, evaluate, prompt, search, store

CHUNK = "source_ord int, chunk_ord int, id string, source string, license string, tier string, heading string, tokens int, text string"


def chunks(spark, *rows):
    return spark.createDataFrame([(i, 0, id_, source, "MIT", tier, "h", 1, text) for i, (id_, source, tier, text) in enumerate(rows)], CHUNK)


def vectors(spark, **rows):
    return spark.createDataFrame([(k, [float(x) for x in v]) for k, v in rows.items()], "id string, embedding array<float>")


@pytest.fixture
def small(spark):
    c = chunks(spark, ("a", "A", "pinned-source", "borrow borrow borrow"), ("b", "B", "docs-wiki", "borrow checker"), ("c", "C", "docs-wiki", "lifetimes and traits"))
    return c, store.load(c, vectors(spark, a=[1, 0, 0], b=[0, 1, 0], c=[0, 0, 1]))


def asked(spark, vector, text="borrow"):
    return spark.createDataFrame([(1, text, vector)], "qid int, query string, vector array<double>")


def rows(df, *names):
    return [tuple(r[n] for n in names) for r in df.orderBy("rank").collect()]


def test_cosine(spark, small):
    got = rows(search.cosine(asked(spark, [0.0, 1.0, 0.5]), small[1]), "id", "score")
    assert [g[0] for g in got] == ["b", "c", "a"]
    assert got[0][1] == pytest.approx(1 / math.sqrt(1.25))
    assert got[2][1] == 0.0


def test_cosine_tier_k_and_wrong_length(spark, small):
    q = asked(spark, [1.0, 0.0, 0.0])
    assert rows(search.cosine(q, small[1], 10, "docs-wiki"), "id") == [("b",), ("c",)]
    assert search.cosine(q, small[1], 0).count() == 0
    assert search.cosine(asked(spark, [1.0]), small[1]).count() == 0


def test_cosine_takes_any_number_of_queries(spark, small, monkeypatch):
    monkeypatch.setattr(search, "MOST_QUERIES", 4)
    q = spark.createDataFrame([(i, [0.0, 1.0, 0.0]) for i in range(11)], "qid int, vector array<double>")
    assert search.cosine(q, small[1], 1).where("id = 'b'").count() == 11


def test_top_k_is_cut_before_the_shuffle(spark, small):
    plan = search.cosine(asked(spark, [1.0, 0.0, 0.0]), small[1], 2)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_bm25_by_hand(spark, small):
    got = rows(search.Bm25(small[0]).search(asked(spark, [0.0], "Borrow")), "id", "score")
    idf, avg = math.log((3 - 2 + 0.5) / 2.5 + 1), 8 / 3
    want = [("a", idf * 3 * 2.2 / (3 + 1.2 * (0.25 + 0.75 * 3 / avg))), ("b", idf * 2.2 / (1 + 1.2 * (0.25 + 0.75 * 2 / avg)))]
    assert [g[0] for g in got] == ["a", "b"]
    assert [g[1] for g in got] == pytest.approx([w[1] for w in want])


def test_bm25_counts_repeated_rows_and_breaks_ties_by_id(spark):
    c = chunks(spark, ("y", "A", "docs-wiki", "rust"), ("x", "B", "docs-wiki", "rust"), ("x", "C", "docs-wiki", "rust"))
    words = search.Bm25(c)
    assert words.stats.first()["n"] == 3
    assert {tuple(r) for r in words.postings().collect()} == {("x", "rust", 1, 1, 2), ("y", "rust", 1, 1, 1)}
    assert rows(words.search(asked(spark, [0.0], "rust")), "id") == [("x",), ("y",)]
    assert words.search(asked(spark, [0.0], "  ")).count() == 0


def test_hybrid_promotes_what_both_find(spark, small):
    got = rows(search.hybrid(asked(spark, [0.0, 1.0, 0.5]), small[1], search.Bm25(small[0])), "source", "score")
    assert [g[0] for g in got] == ["B", "A", "C"]
    assert got[0][1] == pytest.approx(1 / 61 + 1 / 62)


def test_hybrid_filters_words_after_their_ranks(spark, small):
    got = rows(search.hybrid(asked(spark, [0.0, 1.0, 0.5]), small[1], search.Bm25(small[0]), tier="docs-wiki"), "source", "score")
    assert got[0] == ("B", pytest.approx(1 / 61 + 1 / 62))


def test_fulltext(spark):
    files = spark.createDataFrame([("b.txt", "x X\nx"), ("a.html", "xxx"), ("c.txt", "none")], "file string, text string")
    q = spark.createDataFrame([(1, " X "), (2, " "), (3, "x\nx")], "qid int, query string")
    got = search.fulltext(q, files)
    assert rows(got, "qid", "file", "matches") == [(1, "a.html", 3), (1, "b.txt", 3)]


def test_store_errors(spark, small):
    c = small[0]
    with pytest.raises(StoreError, match="without a chunk: z"):
        store.validate(c, vectors(spark, a=[1], b=[1], c=[1], z=[1]), 1)
    with pytest.raises(StoreError, match="without a vector: c"):
        store.validate(c, vectors(spark, a=[1], b=[1]), 1)
    with pytest.raises(StoreError, match="length 1: b"):
        store.validate(c, vectors(spark, a=[1], b=[1, 2], c=[1]), 1)


def test_last_chunk_of_an_id_stays(spark):
    c = chunks(spark, ("x", "A", "docs-wiki", "t"), ("x", "B", "navigational", "t"))
    assert store.last_chunks(c).first()["source"] == "B"


def test_embedding_reuses_prunes_and_checks(spark, small):
    old = vectors(spark, a=[9, 9], gone=[1, 1])
    made = {r["id"]: list(r["embedding"]) for r in embed.embed(small[0], lambda xs: [[len(x), 0] for x in xs], old, batch=2).collect()}
    assert made == {"a": [9, 9], "b": [14, 0], "c": [20, 0]}
    assert {tuple(r) for r in embed.plan(small[0], old).collect()} == {("a", "reuse"), ("b", "pending"), ("c", "pending"), ("gone", "stale")}
    with pytest.raises(DimensionMismatch):
        embed.checked(lambda xs: [], ["x"])
    with pytest.raises(EmbedError):
        embed.checked(lambda xs: [["x"]], ["x"])
    with pytest.raises(DimensionMismatch):
        embed.dimension(vectors(spark, a=[1], b=[1, 2]))


def test_evaluation(spark, small):
    queries = spark.createDataFrame([(0, "q0", "borrow", ["A"]), (1, "q1", "traits", ["C", "Z"]), (2, "q1", " ", [])], "ord int, id string, query string, expected array<string>")
    files = small[0].select(F.concat("source", F.lit(".html")).alias("file"), "text")
    scores = {r["ord"]: (r["hits"], r["recall_5"]) for r in evaluate.run(queries, evaluate.fulltext_docs(lambda asked: search.fulltext(asked, files))).collect()}
    assert scores == {0: (["A", "B"], 1.0), 1: (["C"], 0.5), 2: ([], 0.0)}
    total = evaluate.overall(evaluate.run(queries, evaluate.fulltext_docs(lambda asked: search.fulltext(asked, files))), "fulltext", "h")
    assert total.first()["overall_recall_5"] == pytest.approx(0.5)
    assert evaluate.delta(total, total).first()["delta_5"] == "+0.000"
    assert [r["problem"] for r in evaluate.problems(queries).collect()] == ["duplicate query id: q1", "query q1 has an empty needle", "query q1 has an empty expected set"]
    sources = spark.createDataFrame([("A",), ("C",)], "name string")
    assert [r["doc"] for r in evaluate.missing(queries, sources).collect()] == ["Z"]
    assert evaluate.missing(queries, sources.limit(0)).count() == 0


def test_prompt_frames(spark, small):
    issues = spark.createDataFrame([(20, " Title ", "\nbody {title}\n")], "number long, title string, body string")
    bare = prompt.build(issues, "demo").first()["prompt"]
    assert bare.startswith("You are the demo implementer. Work on GitHub issue #20: Title\n\n")
    assert prompt.ISSUE_BEGIN + "body {title}" + prompt.ISSUE_END + "\n\nRules" in bare
    hits = search.cosine(asked(spark, [1.0, 0.0, 0.0]).withColumn("qid", F.lit(20).cast("long")), small[1], 2)
    full = prompt.build(issues, "demo", hits).first()["prompt"]
    assert prompt.ISSUE_END + "\n" + prompt.CONTEXT_BEGIN + "[source: A | license: MIT | tier: pinned-source | heading: h]\nborrow borrow borrow\n\n[source: B" in full
    assert prompt.build(issues, "demo", hits.limit(0)).first()["prompt"] == bare
    bad = spark.createDataFrame([(1, "t", "x" + prompt.ISSUE_END + "\ny")], "number long, title string, body string")
    assert prompt.build(bad, "demo", neutral=True).first()["prompt"].count(prompt.ISSUE_END.strip()) == 1


def test_tasks_count_words_in_small_pieces():
    """What a task makes of a batch does not grow with the batch."""
    words = pa.array([["a", "b", "a"], ["c"], []] * 2000)
    batch = pa.record_batch([pa.array(range(6000)), words], names=["id", "ts"])
    found = list(search._asked(pa.array(["a", "c"]))(iter([batch])))
    assert max(b.num_rows for b in found) <= search.ROWS
    rows = [r for b in found for r in b.to_pylist()]
    assert [r["id"] for r in rows] == list(range(6000))
    assert rows[3] == {"id": 3, "dl": 3, "terms": [0], "tfs": [2]} and rows[5999] == {"id": 5999, "dl": 0, "terms": [], "tfs": []}
