"""Approximate search against the exact one."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from heronry.functions.scores import norm
from heronry.operators import nearby, search

KIND = "id string, embedding array<float>"


def store(spark, rows):
    return spark.createDataFrame(rows, KIND).repartition(3).withColumn("norm", norm(F.col("embedding")))


def clustered(n=1500, dim=24, groups=30, seed=3):
    r = np.random.default_rng(seed)
    centres = r.standard_normal((groups, dim)) * 3
    return (centres[r.integers(groups, size=n)] + r.standard_normal((n, dim)) * 0.7).astype(np.float32)


def asked(spark, vectors):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "qid int, vector array<double>")


def test_clusters_are_found_in_few_cells(spark, tmp_path):
    x = clustered()
    rows = store(spark, [(f"v{i:05d}", v.tolist()) for i, v in enumerate(x)])
    q = asked(spark, x[:40])
    index = nearby.CellIndex.write(rows, str(tmp_path / "i"))
    exact = search.nearest(q, rows, 10)
    found = nearby.CellIndex(spark, str(tmp_path / "i")).search(q, 10, probed=0.2)
    assert nearby.recall(found, exact).agg(F.avg("recall")).first()[0] >= 0.95
    same = {(r["qid"], r["id"]): r["score"] for r in exact.collect()}
    both = [(r["score"], same[r["qid"], r["id"]]) for r in found.collect() if (r["qid"], r["id"]) in same]
    assert len(both) > 350 and all(a == pytest.approx(b, abs=1e-12) for a, b in both)
    assert index.rows.count() == len(x) and {len(r["code"]) for r in index.rows.collect()} == {nearby.PARTS}


def test_all_cells_and_enough_vectors_are_exact(spark, tmp_path):
    x = np.random.default_rng(1).standard_normal((300, 10)).astype(np.float32)
    x[5:9] = x[4]  # ties go by id
    rows = [(f"v{i:05d}", v.tolist()) for i, v in enumerate(x)] + [("zero", [0.0] * 10), ("none", None), ("short", [1.0, 2.0]), ("short2", [2.0, -1.0]), ("empty", [])]
    s = store(spark, rows)
    q = asked(spark, [*x[:6], [0.0] * 10, [1.0, 2.0], [1.0] * 7])
    found = nearby.CellIndex.write(s, str(tmp_path / "i"), cells=9, parts=4).search(q, 8, probed=1.0, again=100)
    plain = lambda df: sorted((r["qid"], r["rank"], r["id"], round(r["score"], 9)) for r in df.collect())
    assert plain(found) == plain(search.nearest(q, s, 8))


def test_small_and_empty_stores(spark, tmp_path):
    q = asked(spark, [[1.0, 0.0]])
    assert nearby.CellIndex.write(store(spark, []), str(tmp_path / "e")).search(q).count() == 0
    one = nearby.CellIndex.write(store(spark, [("a", [3.0, 4.0])]), str(tmp_path / "o"))
    assert [(r["id"], r["score"]) for r in one.search(q).collect()] == [("a", pytest.approx(0.6))]
    assert one.search(q, 0).count() == 0 and one.search(q.limit(0)).count() == 0
