"""Whitening, spelling variants and mixing against brute-force versions."""

import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from heronry.llm import mixing, queries, variants, whitening

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def saved(spark, at, docs=(), vectors=()):
    spark.createDataFrame(list(docs), DOCS).withColumns({c: F.lit("clash") for c in ("key", "src", "begin", "word", "size", "x", "n")}).repartition(5).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(list(vectors), "vec_id long, embedding array<float>").withColumns({c: F.lit("clash") for c in ("id", "x", "i", "n")}).repartition(3).write.parquet(f"{at}/embeddings.parquet")
    return str(at)


# Whitening


def drawn(seed, n=400, dim=12):
    r = np.random.default_rng(seed)
    return (r.standard_normal((n, dim)) @ r.standard_normal((dim, dim)) * 0.3 + r.standard_normal(dim)).astype(np.float32)


@pytest.mark.parametrize("name", ["random", "wide", "repeated", "equal", "zero", "ones", "close"])
def test_components_of_matrices(name):
    r = np.random.default_rng(1)
    turn = np.linalg.qr(r.standard_normal((40, 40)))[0]
    values = {"random": r.random(40), "wide": 10.0 ** -np.linspace(0, 12, 40), "repeated": np.repeat([3.0, 2, 1, 0], 10), "equal": np.ones(40), "zero": np.zeros(40), "ones": np.r_[40.0, np.zeros(39)], "close": 1 + 1e-10 * np.arange(40)}[name]
    a = turn @ np.diag(values) @ turn.T
    a = (a + a.T) / 2
    found, vectors = whitening.components(a)
    size = max(np.linalg.norm(a), 1e-300)
    assert np.abs(found - np.linalg.eigvalsh(a)[::-1]).max() < 1e-13 * size
    assert np.linalg.norm(a @ vectors - vectors * found) < 1e-12 * size
    assert np.linalg.norm(vectors.T @ vectors - np.eye(40)) < 1e-13


def test_the_polar_factor_is_orthogonal_and_leaves_a_positive_part():
    a = np.random.default_rng(2).standard_normal((30, 30))
    a = a + a.T
    u = whitening.polar(a)
    assert np.linalg.norm(u @ u - np.eye(30)) < 1e-13
    assert np.linalg.eigvalsh(u @ a).min() > 0


def test_whitening(spark, tmp_path):
    vectors = [(int(i), v.tolist()) for i, v in enumerate(drawn(3))]
    odd = [(900, None), (901, []), (902, [float("nan")] * 12), (903, [None] * 12), (904, [float("inf")] * 12), (905, [1.0] * 5), (906, [3e38] * 12), (None, vectors[0][1]), (3, vectors[3][1])]
    found = queries.QUERIES["op11_whitening"](spark, saved(spark, tmp_path, vectors=vectors + odd)).collect()
    taken = vectors + odd[-2:]
    n = len(taken)
    x = [[int(np.floor(np.float64(np.float32(c)) * 1024)) + 100_000 for c in v] for _, v in taken]
    sums = [sum(r[j] for r in x) for j in range(12)]
    centred = np.array([[float(Fraction(n * r[j] - sums[j], n)) for j in range(12)] for r in x])
    cov = centred.T @ centred / n
    e, q = np.linalg.eigh(cov)
    e, q = e[::-1], q[:, ::-1]
    deviation = Counter((i, sum((n * r[j] - sums[j]) ** 2 for j in range(12))) for (i, _), r in zip(taken, x, strict=True))
    assert Counter((r["vec_id"], r["deviation"]) for r in found if r["component"] == 1) == deviation
    assert Counter(r["component"] for r in found) == {k: n for k in range(1, 9)} and {r["n"] for r in found} == {n}
    rows = defaultdict(list)
    for r in found:
        rows[r["component"]].append((-1 if r["vec_id"] is None else r["vec_id"], r["whitened"]))
        assert r["explained"] == pytest.approx(e[r["component"] - 1] / e.sum(), rel=1e-9)
    ids = [-1 if i is None else i for i, _ in taken]
    for k in range(1, 9):
        want = np.array([w for _, w in sorted(zip(ids, centred @ q[:, k - 1] / np.sqrt(e[k - 1]), strict=True))])
        got = np.array([w for _, w in sorted(rows[k])])
        got = got if got @ want > 0 else -got
        assert np.abs(got - want).max() < 1e-9
    assert len({r["identity_error"] for r in found}) == 1 and found[0]["identity_error"] < 1e-10


def test_whitening_does_not_depend_on_how_rows_are_dealt(spark):
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(drawn(4))], "id long, v array<float>")
    one, many = (sorted(map(tuple, whitening.whitened(rows.repartition(k), key="id", vector="v").drop("identity_error").collect())) for k in (1, 13))
    assert one == many


def test_sums_beyond_a_double_are_exact():
    y = np.array([[1 << 40, 3], [-(1 << 40) + 1, 5], [7, 1 << 41]], np.int64)
    assert whitening._products(y).tolist() == [[sum(int(a) * int(b) for a, b in zip(y[:, i], y[:, j], strict=True)) for j in range(2)] for i in range(2)]


@pytest.mark.parametrize("vectors,rows", [([(1, [1.0, 2.0])], 2), ([(i, [1.0, float(i)]) for i in range(5)], 10), ([(i, [0.5] * 3) for i in range(4)], 12), ([(1, None), (2, [])], 0)])
def test_components_without_variance_have_no_value(spark, tmp_path, vectors, rows):
    found = queries.QUERIES["op11_whitening"](spark, saved(spark, tmp_path, vectors=vectors)).collect()
    assert len(found) == rows
    varied = {(r["vec_id"], r["component"]) for r in found if r["whitened"] is not None}
    assert varied == ({(i, 1) for i in range(5)} if rows == 10 else set())


def test_components_of_a_table_of_longer_vectors(spark):
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(drawn(5, 300, 200))], "id long, v array<float>")
    found = whitening.whitened(rows, key="id", vector="v", most=3).collect()
    assert len(found) == 900 and found[0]["identity_error"] < 1e-10


# Spelling variants


def prose(seed=5):
    r = random.Random(seed)
    stems = ["colour", "color", "organise", "organize", "grey", "größe", "Größe", "naïve", "naive", "façade", "x" * 70, "x" * 71, "x" * 69 + "y"]
    stems += ["".join(r.choice("abcdé") for _ in range(r.choice([4, 5, 6, 7, 9, 12, 18, 40]))) for _ in range(60)]
    for s in list(stems):
        i = r.randrange(len(s))
        stems += [s[:i] + s[i + 1 :], s[:i] + "q" + s[i:], s[:i] + "z" + s[i + 1 :]]
    rows = []
    for d in range(60):
        words = r.choices(stems, [1 / (1 + i % 9) ** 2 for i in range(len(stems))], k=400)
        rows.append((d, "".join(w.upper() if r.random() < 0.1 else w + r.choice(" .,1_\n-") for w in words), "en", "s", 0))
    return rows + [(60, None, None, None, None), (61, "", "en", "s", 0), (None, "Colour colour cOlOur × ÷ ", "en", "s", 0), rows[3], rows[3], (62, "long" * 50_000 + " " + "long" * 50_000 + " " + "long" * 50_000, "en", "s", 0), (63, "long" * 50_000 + "s " * 3, "en", "s", 0)]


def counted(rows):
    total = Counter()
    for i, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(counts):
    out = {}
    short = [w for w in counts if len(w) < 1000]
    for w, n in counts.items():
        near = [v for v in (short if len(w) < 1000 else counts) if one_edit(w, v)]
        best = min(near, key=lambda v: (-counts[v], v), default=None)
        form = best if best is not None and counts[best] >= 2 * n else None
        out[w] = (form, n, len(near), None if form is None else counts[form])
    return out


def test_variants(spark, tmp_path):
    rows = prose()
    found = {r["word"]: (r["form"], r["n"], r["n_near"], r["form_n"], r["root"]) for r in queries.QUERIES["op12_variants"](spark, saved(spark, tmp_path, rows)).collect()}
    want = plain(counted(rows))
    assert len(want) > 150 and sum(v[2] > 0 for v in want.values()) > 100
    assert {w: v[:4] for w, v in found.items()} == want
    for w, v in found.items():
        while want[w][0] is not None:
            w = want[w][0]
        assert v[4] == w


def test_words_of_all_code_points_and_one_crowded_key(spark, monkeypatch):
    r = random.Random(1)
    counts = {w: r.randint(3, 50) for w in {"shared" + "".join(r.choice("ab😀") for _ in range(r.choice([5, 6]))) for _ in range(600)}}
    monkeypatch.setattr(variants, "_ROWS", 8)
    found = variants.grouped(spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)).collect()
    assert {r["word"]: (r["form"], r["n"], r["n_near"], r["form_n"]) for r in found} == plain(counts)


@pytest.mark.parametrize("length", [5, 6, 8, 9, 17, 40, 64, 65, 100, 700])
def test_near_words_share_the_key_at_which_they_count(length):
    r = random.Random(length)
    word = "".join(r.choice("ab") for _ in range(length))
    shapes = {}
    for i in range(0, length + 1, max(1, length // 50)):
        for other in (word[:i] + "c" + word[i:], word[:i] + "c" + word[i + 1 :]):
            if other == word or not one_edit(word, other):
                continue
            prefix = next(k for k in range(len(word) + 1) if k == len(word) or word[k] != other[k])
            at = int(variants._path(np.array([length]), np.array([prefix]))[0])
            keys = [{k for k in variants._keys(w, shapes) if k[1] == length and k[2] == at} for w in (word, other)]
            assert len(keys[0]) == 1 and keys[0] == keys[1]
    assert len(list(variants._keys(word, shapes))) <= 64


def test_long_chains_of_forms(spark):
    words = ["a" * k for k in range(5, 22)]
    forms = spark.createDataFrame([(a, b) for a, b in zip(words, words[1:])], "word string, form string")
    assert {r["word"]: r["root"] for r in variants.roots(forms).collect()} == {w: words[-1] for w in words[:-1]}


# Mixing


def sources_of(rows):
    sizes = defaultdict(int)
    for _, text, _, source, _ in rows:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    return dict(sorted(sizes.items(), key=lambda x: (x[0] is None, x[0] or "")))


def corpus():
    r = random.Random(9)
    names = ["big"] * 12 + ["mid", "Zed", "é", "😀", "tiny", None, "a", "b"]
    rows = [(i, " ".join(r.choice(["of", "and", "wörd", "a b"]) for _ in range(int(r.expovariate(1 / 150)))), "en", r.choice(names), 0) for i in range(700)]
    return rows + [(700, None, "en", "big", 0), (701, "", "en", None, 0), (702, " \n\t", "en", "empty", 0), (None, "no id " * 40, "en", "big", 0), (None, "no id " * 40, "en", "big", 0), rows[5], rows[5], (703, "w " * 90_000, "en", "mid", 0), (704, "one", "en", "single", 0)]


def test_mixing(spark, tmp_path):
    rows = corpus()
    at = saved(spark, tmp_path, rows)
    found = queries.QUERIES["op13_mixing"](spark, at).collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert Counter((r["doc_id"], r["size"]) for r in found) == Counter((i, size(t)) for i, t, *_ in rows)
    sizes = sources_of(rows)
    weights, whole = [5, 2, 1], 1.5 * sum(sizes.values())
    want, left = {}, {s: weights[i % 3] for i, s in enumerate(sizes)}
    while True:
        share = {s: (whole - sum(want.values())) * w / sum(left.values()) for s, w in left.items()}
        above = [s for s in left if share[s] > 2 * sizes[s]]
        if not above:
            want |= share
            break
        for s in above:
            want[s] = 2 * sizes[s]
            del left[s]
    source = {(i, size(t), s) for i, t, _, s, _ in rows}
    taken = defaultdict(int)
    for r in found:
        names = [s for i, n, s in source if (i, n) == (r["doc_id"], r["size"])]
        assert len(names) == 1 and r["source_size"] == sizes[names[0]] and r["target"] == pytest.approx(want[names[0]])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[names[0]] += r["taken"]
    for s, goal in want.items():
        assert abs(taken[s] - goal) <= mixing.BLOCK / 2 + 1, s
    again = queries.QUERIES["op13_mixing"](spark, at).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))
    spark.conf.set("spark.sql.shuffle.partitions", 11)
    other = queries.QUERIES["op13_mixing"](spark, at).collect()
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert sorted(map(str, other)) == sorted(map(str, found))


def test_slots_hold_blocks_of_words(spark):
    rows = corpus()
    sized = mixing.sized(spark.createDataFrame(rows, DOCS).repartition(7), words=True)
    sources = mixing.plan(sized)
    found = mixing.mix(mixing.placed(sized, sources), sources).collect()
    slots = defaultdict(list)
    for r in found:
        slots[r["shard"], r["slot"], r["src"]].append((r["at"], r["length"], r["words"]))
    short = Counter()
    for key, parts in slots.items():
        parts.sort()
        assert parts[0][0] == 0 and all(a + n == b for (a, n, _), (b, _, _) in zip(parts, parts[1:]))
        words = " ".join(w for *_, w in parts).split(" ")
        assert len(words) == sum(n for _, n, _ in parts) <= mixing.BLOCK
        short[key[2]] += len(words) < mixing.BLOCK
    assert all(n <= 2 for n in short.values())
    assert len(slots) == sum(s.taken for s in sources) and len({k[:2] for k in slots}) == len(slots)
    want = Counter()
    for _, text, *_ in rows:
        want.update(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    held = Counter(w for parts in slots.values() for *_, p in parts for w in p.split(" "))
    assert set(held) <= set(want) and all(n <= 2 * want[w] for w, n in held.items())


def test_shards_follow_the_targets(spark):
    sources = [mixing.Source(i, str(i), n * 64, 0.0, n, t) for i, (n, t) in enumerate([(50_000, 100_000), (100_000, 60_000), (3, 5), (0, 0)])]
    found = mixing.slots(spark, sources, shard=1000, group=16)
    each = found.groupBy("src").agg(F.count("*").alias("n"), F.countDistinct("block").alias("d"), F.max("block").alias("m")).collect()
    assert {r["src"]: (r["n"], r["d"], r["m"]) for r in each} == {0: (100_000, 50_000, 49_999), 1: (60_000, 60_000, max(r["m"] for r in each if r["src"] == 1)), 2: (5, 3, 2)}
    counts = np.array([r["n"] for r in found.where("src = 0").groupBy("shard").agg(F.count("*").alias("n")).collect()])
    p = 100_000 / 160_005
    assert len(counts) >= 160 and 0.5 < counts.var() / (1000 * p * (1 - p)) < 1.5  # as a multinomial draw varies


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 1000, 65_537])
def test_permutations(n):
    i, key = np.arange(n), mixing._key(1, np.full(n, 4), np.zeros(n, np.int64))
    p = mixing.permuted(i, np.full(n, n), key)
    assert sorted(p.tolist()) == list(range(n))
    assert (mixing.permuted(p, np.full(n, n), key, back=True) == i).all()


def test_targets_end_at_the_limit():
    assert mixing.targets([100, 10, 1000], [5, 2, 1], 1665.0) == [200.0, 20.0, 1445.0]
    assert mixing.targets([], [], 0.0) == [] and mixing.targets([0, 0], [5, 2], 0.0) == [0.0, 0.0]


@pytest.mark.parametrize("name", ["op12_variants", "op13_mixing"])
def test_empty_texts(spark, tmp_path, name):
    found = queries.QUERIES[name](spark, saved(spark, tmp_path, [(1, None, None, None, None), (2, "", "en", "s", 0)]))
    assert found.count() == (2 if name == "op13_mixing" else 0)
