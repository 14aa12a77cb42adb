"""The pipeline, stage by stage, against what is planted in its input."""

import random
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_llm_operators import DOCS, brute_removed

import corpus_pipeline as P
from heronry.llm import components, quality, simhash


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("pipe")
    r = random.Random(11)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 8)))
    rows = []
    for i in range(300):
        text = " ".join(word() for _ in range(120)) if i % 4 else " ".join(word().upper() + "!!! $$$" for _ in range(60))
        rows.append((i, text, "en", "s0", len(text)))
    rows += [(400 + k, rows[1][1], "en", "s0", 0) for k in range(5)]
    rows += [(410, rows[2][1].rsplit(" ", 1)[0] + " changed", "en", "s1", 0)]
    passage = " ".join(word() for _ in range(60))
    rows += [(420 + k, " ".join(word() for _ in range(400)) + " " + passage + " " + " ".join(word() for _ in range(300)), "en", "s1", 0) for k in range(3)]
    rows += [(430, " ".join(word() for _ in range(90)) + " write to ann@example.org", "en", "s0", 0), (431, None, None, None, None), (None, "a row without an id " + passage[:30], "en", "s0", 0)]
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(0, 300, 2)], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return str(at)


@pytest.fixture(scope="module")
def stages(spark, sf, tmp_path_factory):
    out, docs = {}, spark.read.parquet(f"{sf}/documents.parquet")
    out["documents"] = docs
    for name, stage in P.STAGES:
        at = str(tmp_path_factory.mktemp(name) / "t")
        stage(spark, docs, sf).write.parquet(at)
        out[name] = docs = spark.read.parquet(at)
    return out


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_names_and_columns(stages):
    assert [n for n, _ in P.STAGES] == ["quality", "near_duplicates", "repeats", "private", "packing"]
    for name, _ in P.STAGES[:-1]:
        assert stages[name].dtypes == stages["documents"].dtypes


def test_quality_drops_junk_and_keeps_clean_documents(stages):
    left = ids(stages["quality"])
    junk, clean = {i for i in range(0, 300, 4)}, {i for i in range(300) if i % 4}
    assert len(left & junk) <= 2 and len(clean - left) <= 2


def test_one_of_each_class_stays(stages):
    before, after = ids(stages["quality"]), ids(stages["near_duplicates"])
    assert before - after == {400, 401, 402, 403, 404, 410}


def test_repeats_equal_brute_force(stages):
    rows = [(r["doc_id"], r["text"] or "") for r in stages["near_duplicates"].collect() if r["doc_id"] is not None]
    want = brute_removed(rows)
    before = dict(rows)
    for r in stages["repeats"].collect():
        if r["doc_id"] is not None:
            n, gone, _, _ = want[r["doc_id"]]
            assert len(r["text"].encode()) == n - gone and r["n_chars"] == len(r["text"])
            assert gone or r["text"] == before[r["doc_id"]]
    assert sum(w[1] > 200 for w in want.values()) == 2


def test_personal_data_is_masked(stages):
    text = stages["private"].where("doc_id = 430").first()["text"]
    assert text.endswith("write to <email>")
    changed = stages["private"].alias("a").join(stages["repeats"].alias("b"), "doc_id").where(F.col("a.text") != F.col("b.text"))
    assert ids(changed) == {430}


def test_packing_takes_all_that_is_left(spark, sf, stages):
    assert ids(stages["packing"]) == ids(stages["private"])
    a, b = (sorted((r["doc_id"] is None, r["doc_id"] or 0, r["start"], r["length"], r["ids_crc32"]) for r in df.collect()) for df in (stages["packing"], P.run(spark, sf)))
    assert a == b


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0


def test_odd_texts_go_through_all_stages(spark, tmp_path):
    """Null, empty and very long texts, equal rows, null ids and columns, and columns with the names of what stages make."""
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdefghijk") for _ in range(6))
    prose = [" ".join(word() for _ in range(80)) for _ in range(12)]
    texts = [*prose, None, "", " \n", "x" * 300_000, "1 2 " * 50_000, prose[0], prose[1] + " mail joe@example.com", "é😀" * 100]
    rows = [(i, t, "en", "s", 0 if t is None else len(t)) for i, t in enumerate(texts)] + [(3, prose[3], "en", "s", 0)] * 2 + [(None, prose[4], None, None, None), (None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.withColumns({c: F.lit(1) for c in ("score", "node", "kept", "spans", "ids", "__text", "digest", "row")}).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(5)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    found = P.run(spark, str(tmp_path)).collect()
    kept = {r["doc_id"] for r in found}
    assert set(range(12)) | {15, 16, 19} <= kept and not kept & {17, 18}
    assert sum(r["doc_id"] == 3 and r["start"] == 0 for r in found) == 1


def tasks_of(session, name, make):
    """What ``make`` returns, and the number of tasks that it ran."""
    session.sparkContext.setJobGroup(name, name)
    out, told = make(), session.sparkContext.statusTracker()
    stages = {i for j in told.getJobIdsForGroup(name) for i in told.getJobInfo(j).stageIds}
    session.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, sum(x.numCompletedTasks for i in stages if (x := told.getStageInfo(i)))


@pytest.fixture()
def dealt(spark):
    """A session with a task for each of 40 partitions."""
    session = spark.newSession()
    for key, value in (("spark.sql.shuffle.partitions", "40"), ("spark.sql.adaptive.coalescePartitions.enabled", "false")):
        session.conf.set(key, value)
    return session


def test_rounds_of_components_are_few_tasks(dealt):
    links = dealt.createDataFrame([(i, i + 1) for i in range(100)] + [(500 + i, 700) for i in range(90)], "a long, b long")
    found, tasks = tasks_of(dealt, "components", lambda: components.components(links))
    assert sorted(map(tuple, found.collect())) == [(i, 0) for i in range(101)] + [(500 + i, 500) for i in range(90)] + [(700, 500)]
    assert tasks < 2100  # 2564 before


def test_features_are_made_once_and_come_in_a_fixed_order(dealt):
    rows = dealt.createDataFrame([(i, f"some words {i}", "en", "s", i) for i in range(60)], "k long, text string, lang string, source string, size long").repartition(40, "k")
    (found, extra), tasks = tasks_of(dealt, "collected", lambda: quality._collected(rows, ["k"]))
    assert extra["k"] == list(range(60)) and tasks < 80  # 124 before
    want = quality.features(rows.orderBy("k").toArrow()["text"].combine_chunks(), ["en"] * 60, ["s"] * 60, range(60))
    assert all(np.array_equal(a, b) for a, b in zip(found, want, strict=True))
    assert [x.shape for x in quality._collected(rows.limit(0), ["k"])[0]] == [(0, x.shape[1]) for x in want]


def test_fitting_takes_little_memory_beside_its_rows():
    x = np.random.default_rng(1).normal(size=(6000, 400)).astype(np.float32)
    y = (x[:, 0] > 0).astype(np.int64)
    tracemalloc.start()
    model = quality.fit(x, y)
    assert ((model.odds(x) > 0) == y).mean() > 0.95
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < x.nbytes  # over four times as much before


def test_blocks_that_a_group_shares_give_the_same_links(spark):
    rows = [(n * 7919 % 101, [1, 2], [(k << 16) | 5 for k in range(8)]) for n in range(1, 101)]
    nodes = spark.createDataFrame(rows, "node long, fp array<long>, blocks array<int>").repartition(5)
    found = simhash.block_links(nodes, 0).distinct().collect()
    assert sorted(map(tuple, found)) == [(1, n) for n in range(2, 101)]


def near_copies_of_one(spark, n):
    """Texts of 120 words, 6 of them changed."""
    r = random.Random(23)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(6))
    base, rows = [word() for _ in range(120)], []
    for i in range(n):
        words = list(base)
        for at in range(10 + i % 5, 16 + i % 5):
            words[at] = word()
        rows.append((i, " ".join(words)))
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_links_of_many_near_copies_are_few(spark, monkeypatch):
    """Rounds of components take a number of links that does not grow with the number of blocks."""
    made, put = [], components.written
    monkeypatch.setattr(components, "written", lambda df, name: made.append(put(df, name)) or made[-1])
    monkeypatch.setattr(components, "discard", lambda df: None)
    found = simhash.near_copies(near_copies_of_one(spark, 400)).collect()
    assert {r["component_id"] for r in found} == {0} and len(found) == 400
    assert max(x.count() for x in made) < 400 * 4


def test_classes_of_links_in_two_passes_equal_brute_force(spark):
    """Chains through several blocks; nodes of one class and a node alone meet in small and in large groups."""
    r = random.Random(9)
    rows = [(i, [r.getrandbits(63) >> 57 << 50, 0], [r.randrange(8), 100 + r.randrange(40), 200 + i % 2, 300 + i % 60]) for i in range(300)] + [(1000, [0, 0], [])]
    near = lambda x, y: sum((p ^ q).bit_count() for p, q in zip(x[1], y[1], strict=True)) <= 1 and set(x[2]) & set(y[2])
    nodes = spark.createDataFrame(rows, "node long, fp array<long>, blocks array<int>").repartition(5)
    for some in (rows[:60], rows):
        pairs = spark.createDataFrame([(x[0], y[0]) for x in some for y in some if x[0] < y[0] and near(x, y)], "a long, b long")
        want = sorted(map(tuple, components.components(pairs).collect()))
        for first in (0, 1, 2, 9):
            got = components.components(simhash.class_links(nodes.where(F.col("node").isin([x[0] for x in some])), 1, first))
            assert sorted(map(tuple, got.collect())) == want


@pytest.mark.parametrize(("n", "links"), [(1, 0), (2, 1), (30, 400), (400, 300), (400, 900)])
def test_forests_connect_what_all_links_do(n, links):
    r = np.random.default_rng(n + links)
    a, b = r.integers(0, n, (2, links))

    def roots(places):
        root = list(range(n))
        for i in places:
            x, y = sorted((root[a[i]], root[b[i]]))
            root = [x if z == y else z for z in root]
        return root

    places = simhash.forest(a, b)
    assert roots(places) == roots(range(links)) and len(places) == n - len(set(roots(places)))
