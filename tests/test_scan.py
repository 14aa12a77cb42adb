"""Chunks of documents whose sections are rows, against the fold over one row."""

import io
import json
import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from heronry.operators import chunk, scan
from heronry.plans import index
from heronry.sources import corpus, ranges


def sections(seed, n):
    """Headings and texts of all kinds of lengths: runs of short ones, some near the limits, some long."""
    r = random.Random(seed)
    out = []
    for i in range(n):
        size = r.choice([1, 3, 40, 180, 199, 200, 201, 700, 1500, 1990, 1996, 1999, 2000, 2001, 2003, 4100] if seed % 2 else [1, 2, 5, 30, 90, 240])
        out.append((r.choice(["", f"h{i}", "same"]), "".join(r.choice("ab é😀") for _ in range(size)) or "x"))
    return [(h, t if t.strip() else "x" + t[1:]) for h, t in out]


@pytest.mark.parametrize("seed", range(6))
def test_parts_compose_to_the_fold(seed):
    rows = sections(seed, 300)
    fold = scan.Fold()
    whole = list(fold(iter(rows))) + list(fold.rest())
    r = random.Random(seed)
    for _ in range(20):
        cuts = sorted({0, len(rows), *(r.randrange(len(rows)) for _ in range(r.choice([1, 3, 30, 120])))})
        held, heading, tail, made = 0, "", "", []
        for a, b in zip(cuts, cuts[1:]):
            part = scan.Part()
            for h, t in rows[a:b]:
                part.add(h, t)
            one = scan.Fold(tail[len(tail) - held :], heading)
            made += list(one(iter(rows[a:b])))
            held, found = scan._after(held, part.runs())
            heading = heading if found is None else found
            tail = f"{tail} {part.tail.removeprefix(' ')}"[-scan.MOST :]
            assert held == len(one.held) and (not held or heading == one.heading)
        assert made + list(one.rest()) == whole


@pytest.mark.parametrize("part", [1, 7, 50, 4096])
def test_rows_give_the_chunks_of_the_array(spark, part):
    docs = {d: sections(d, n) for d, n in ((0, 200), (1, 150), (2, 1), (5, 90))}
    docs[3] = []
    docs[1][20:20] = [("blank", " \n "), ("none", "")]
    as_array = spark.createDataFrame([(d, s) for d, s in docs.items()], f"doc long, s {chunk.SECTIONS}")
    want = as_array.select("doc", F.posexplode(chunk.finish(chunk.merge(F.col("s")))).alias("i", "c")).select("doc", "i", "c.id", "c.heading", "c.tokens", "c.text").collect()
    rows = as_array.select("doc", F.posexplode("s").alias("at", "s")).select("doc", "at", "s.heading", "s.text").repartition(5)
    about = spark.createDataFrame([(d, f"n{d}", "MIT", "docs-wiki") for d in docs], "ord long, name string, license string, tier string")
    found = scan.chunks(about, rows, part)
    assert sorted(map(tuple, found.select("source_ord", "chunk_ord", "id", "heading", "tokens", "text").collect())) == sorted(map(tuple, want))
    assert found.columns == chunk.chunks(spark.createDataFrame([], "ord long, name string, license string, tier string, format string, content string")).columns


def test_a_tree_of_files_gives_the_chunks_of_its_text(spark, tmp_path):
    r = random.Random(2)
    for i in range(40):
        f = tmp_path / "t" / f"d{i % 3}" / f"F{i}.java"
        f.parent.mkdir(exist_ok=True, parents=True)
        f.write_text(f"class F{i} {{\r\n" + "int x;\n" * r.choice([0, 3, 60, 900]) + ("===== FILE: inner =====\nbody\n" if i % 9 == 0 else "") + "same\n" * (i % 2))
    one = corpus.tree(spark, str(tmp_path / "t")).select(F.lit(4).alias("ord"), F.lit("tree").alias("name"), F.lit("MIT").alias("license"), F.lit("docs-wiki").alias("tier"), F.lit("text").alias("format"), F.col("text").alias("content"))
    found = index.chunk_tree(spark, str(tmp_path / "t"), "tree", license="MIT", tier="docs-wiki", ord=4)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, chunk.chunks(one).collect())) and found.count() > 15


def test_no_document_is_gathered_in_a_row(spark):
    rows = spark.range(10).select(F.lit(1).cast("long").alias("doc"), F.col("id").alias("at"), F.lit("h").alias("heading"), F.lit("text").alias("text"))
    plan = scan.merged(rows)._jdf.queryExecution().toString()
    assert "collect_list" not in plan


def marked(seed):
    r = random.Random(seed)
    parts = ["===== FILE: a/b.java =====\n", "===== FILE: é =====\r\n", "=====", "===== FILE:  ===== \n", "text 😀 line\n", "\n", "\r\n", "x ===== FILE: no =====\n", "===== FILE: x =====", "  \n", "int x;\n" * 30]
    return "".join(r.choice(parts) for _ in range(r.randrange(60)))


def whole_sections(text):
    """The sections of a text by one pattern over all of it."""
    lines = text.replace("\r\n", "\n")
    lines += "\n" if lines and not lines.endswith("\n") else ""
    cuts = [(0, 0, "")] + [(m.start(), m.end(), m[1]) for m in re.finditer(r"(?m)^===== FILE: ([^\n]*) =====\n", lines)]
    return [(h, lines[e : cuts[i + 1][0] if i + 1 < len(cuts) else len(lines)]) for i, (_, e, h) in enumerate(cuts)]


@pytest.mark.parametrize("seed", range(40))
def test_ranges_of_any_size_give_all_sections_once(seed, monkeypatch):
    monkeypatch.setattr(ranges, "PIECE", random.Random(seed).choice([1, 2, 7, 50, 4096]))
    text = marked(seed)
    raw = text.encode()
    for size in (1, 3, 17, 100, 10**6):
        found = [s for begin in range(0, len(raw), size) for s in ranges.sections_of(io.BytesIO(raw), begin, min(begin + size, len(raw)))]
        assert [s[0] for s in found] == sorted({s[0] for s in found})
        assert [s[1:] for s in found] == (whole_sections(text) if raw else [])


def test_large_files_of_a_corpus_give_the_same_chunks(spark, tmp_path, monkeypatch):
    texts = {f"s{i}": "".join(marked(100 + 7 * i + j) for j in range(12)) for i in range(3)}
    sources = [{"name": n, "license": "MIT", "url": "https://x/", "format": "text", "tier": "docs-wiki"} for n in texts] + [{"name": "page", "license": "MIT", "url": "https://x/"}]
    (tmp_path / "manifest.json").write_text(json.dumps({"version": 1, "sources": sources}))
    for n, t in texts.items():
        (tmp_path / f"{n}.txt").write_bytes(t.encode())
    (tmp_path / "page.html").write_text("<h1>A</h1>" + "word " * 900)
    want = sorted(map(tuple, index.chunk_corpus(spark, str(tmp_path)).collect()))
    monkeypatch.setattr(index, "LARGE", 100)
    small = ranges.sections
    monkeypatch.setattr(index.ranges, "sections", lambda spark, files: small(spark, files, 512))
    seen = {}
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", 6000)  # a file that does not fit a row would fail
    found = index.chunk_corpus(spark, str(tmp_path), lambda name, n: seen.update({name: n}))
    assert sorted(map(tuple, found.collect())) == want and set(seen) == {*texts, "page"}
    assert max(f.stat().st_size for f in tmp_path.iterdir()) > 6000
    spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    (tmp_path / "s1.txt").write_bytes(b"===== FILE: x =====\n" + b"a" * 200 + b"\xff\n")
    with pytest.raises(Exception, match="utf-8|UTF-8"):
        index.chunk_corpus(spark, str(tmp_path)).collect()


def test_a_part_is_put_out_in_small_pieces():
    """A task holds few chunks of a part as strings, however many the part has."""
    sections = [(f"h{i % 5}", "x" * (1500 + i % 3)) for i in range(1000)]
    rows = [(7, 3, 0, "", "", True), *((7, 3, i + 1, h, t, False) for i, (h, t) in enumerate(sections))]
    names = ["doc", "part", "place", "heading", "text", "last"]
    batch = pa.record_batch([pa.array(list(c)) for c in zip(*rows, strict=True)], names=names)
    found = list(scan._folded(iter([batch])))
    fold = scan.Fold()
    want = [*fold(iter(sections)), *fold.rest()]
    assert len(found) > 1 and max(b.num_rows for b in found) <= 256
    assert [(r["nth"], r["heading"], r["text"]) for b in found for r in b.to_pylist()] == [(i, *c) for i, c in enumerate(want)]
