import hashlib
import time

import pytest
from pyspark.sql import functions as F

from heronry.functions import scores as S
from heronry.functions import text as T
from heronry.operators import chunk


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], list(values))
    return row.select(column.alias("x")).first()["x"]


def chunked(spark, content, format_="html"):
    docs = spark.createDataFrame([(0, "doc", "MIT", "pinned-source", format_, content)], "ord int, name string, license string, tier string, format string, content string")
    return [r.asDict() for r in chunk.chunks(docs).orderBy("chunk_ord").collect()]


@pytest.mark.parametrize(("source", "want"), [("a <b>c</b> d", "a c d"), ("x &amp;lt; y", "x < y"), ("a < b", "a "), ("a > b", "a > b"), ("&quot;q&#39;&nbsp;", "\"q' ")])
def test_strip_tags(spark, source, want):
    assert one(spark, T.strip_tags(F.col("s")), s=source) == want


@pytest.mark.parametrize(("source", "want"), [("HTTPServer getValue a1B snake_case", ["httpserver", "get", "value", "a1b", "snake_case"]), ("ΑΣ été-x", ["ας", "été", "x"]), ("", []), ("--", [])])
def test_words(spark, source, want):
    assert one(spark, T.words(F.col("s")), s=source) == want


def test_white_space_is_unicode(spark):
    assert one(spark, T.trim(F.col("s")), s="　\n a  ") == "a"
    assert one(spark, T.collapse(F.col("s")), s=" a \n\tb ") == "a b"


def test_tokens_and_overlap_count_code_points(spark):
    assert one(spark, T.tokens_of(F.col("s")), s="a😀bcd") == 2
    assert one(spark, T.overlap(F.col("s")), s="😀" * 300) == "😀" * 200


def test_match_count_and_snippet(spark):
    text = "Alpha beta\nno\r\nBETA beta " + "x" * 300
    assert one(spark, T.match_count(F.col("t"), F.col("q")), t=text, q="beta") == 3
    assert one(spark, T.match_count(F.col("t"), F.col("q")), t=text, q="beta\nno") == 0
    assert one(spark, T.first_match(F.col("t"), F.col("q")), t=text, q="BETA") == "Alpha beta"
    assert one(spark, T.first_match(F.col("t"), F.col("q"), 10), t=text, q="beta x") == "BETA beta …"


def test_cosine_is_exact_and_guards_zero(spark):
    assert one(spark, S.cosine(F.array(F.lit(0.0), F.lit(1.0), F.lit(0.5)), F.array(F.lit(0.0), F.lit(1.0), F.lit(0.0))), s=1) == pytest.approx(1 / 1.25**0.5)
    assert one(spark, S.cosine(F.array(F.lit(0.0)), F.array(F.lit(1.0))), s=1) == 0.0


def test_recall(spark):
    hits, expected = F.array(*map(F.lit, "abc")), F.array(*map(F.lit, "aaz"))
    assert one(spark, S.recall_at(hits, expected, 5), s=1) == pytest.approx(2 / 3)
    assert one(spark, S.recall_at(hits, F.array().cast("array<string>"), 5), s=1) == 0.0


def test_html_sections(spark):
    found = one(spark, chunk.html_sections(F.col("s")), s="pre <p>x</p><h1>In<b>tro</b></h1><p>one\n two</p><h2 id=a>Deep</h2>three<h3>Empty</h3>")
    assert [(s["heading"], s["text"]) for s in found] == [("", "pre x"), ("Intro", "one two"), ("Deep", "three"), ("Empty", "")]


def test_text_sections_keep_bodies(spark):
    found = one(spark, chunk.text_sections(F.col("s")), s="intro\r\n===== FILE: a/A.java =====\n  x\n\n===== FILE:  =====\n===== FILE: =====\ny")
    assert [(s["heading"], s["text"]) for s in found] == [("", "intro\n"), ("a/A.java", "  x\n\n")] + [("", "===== FILE: =====\ny\n")]


def test_short_sections_merge_under_the_first_heading(spark):
    found = chunked(spark, "<h1>A</h1>one<h1>B</h1>two")
    assert [(c["heading"], c["text"], c["tokens"]) for c in found] == [("A", "one two", 2)]
    assert found[0]["id"] == hashlib.sha256(b"one two").hexdigest()


def test_full_chunks_overlap(spark):
    body = "".join(f"<h2>H{i}</h2>" + f"w{i} " * 300 for i in range(6))
    found = chunked(spark, body)
    assert len(found) > 1
    for a, b in zip(found, found[1:], strict=False):
        assert b["text"].startswith(a["text"][-200:].strip())
    assert all(c["tokens"] <= 551 for c in found)


def test_long_sections_are_cut_in_windows_without_overlap(spark):
    found = chunked(spark, "<h1>L</h1>" + "abcd" * 1250)
    assert [len(c["text"]) for c in found] == [2000, 2000, 1000] or [c["chunk_ord"] for c in found] == [0, 1]
    assert {c["heading"] for c in found} == {"L"}


def test_equal_chunks_of_a_document_stay_once(spark):
    text = "===== FILE: a =====\n" + "x" * 2400 + "\n===== FILE: b =====\n" + "x" * 2400 + "\n"
    found = chunked(spark, text, "text")
    assert len({c["id"] for c in found}) == len(found) == 2
    assert [c["chunk_ord"] for c in found] == [0, 1]


def test_headings_without_bodies_and_empty_documents_give_nothing(spark):
    assert chunked(spark, "<h1>Only</h1>") == []
    assert chunked(spark, "") == []
    assert chunked(spark, "  \n", "text") == []


def test_chunks_do_not_depend_on_partitions(spark):
    docs = spark.createDataFrame([(i, f"d{i}", "MIT", "docs-wiki", "html", f"<h1>{i}</h1>" + f"word{i} " * 400 * (i % 3)) for i in range(30)], "ord int, name string, license string, tier string, format string, content string")
    first, second = (sorted(map(tuple, chunk.chunks(docs.repartition(n)).collect())) for n in (1, 17))
    assert first == second


def test_many_sections_take_linear_time(spark):
    began = time.time()
    found = chunked(spark, "".join(f"<h2>H{i}</h2>" + f"w{i} " * 50 for i in range(10_000)))
    assert len(found) > 1000 and time.time() - began < 60


NONCHARACTERS = [chr(c) for c in [*range(0xFDD0, 0xFDF0), *(p << 16 | low for p in range(17) for low in (0xFFFE, 0xFFFF))]]


@pytest.mark.parametrize("format_", ["html", "text"])
def test_texts_keep_every_code_point(spark, format_):
    odd = "".join(f"a{c}" for c in [*map(chr, range(1, 9)), *NONCHARACTERS]) + "\x01\x02\x03\x04\x01\x01\x04"
    heading = {"html": "<h2>{}</h2>", "text": "===== FILE: {} =====\n"}[format_]
    end = "\n" if format_ == "text" else ""
    got = chunked(spark, f"one{odd}two{end}" + heading.format(f"x{odd}y") + "z" * 2000 + odd, format_)
    assert [c["text"] for c in got][0].startswith(f"one{odd}two") and "".join(c["text"] for c in got).endswith("z" * 2000 + odd)
    assert got[-1]["heading"] == f"x{odd}y"


def test_marks_in_a_text_make_no_heading(spark):
    assert [(c["heading"], c["text"]) for c in chunked(spark, "<p>one ﷐two﷑ three \x01\x03four\x01\x04 five</p>")] == [("", "one ﷐two﷑ three \x01\x03four\x01\x04 five")]
