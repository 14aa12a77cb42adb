"""Documents to chunks: sections by heading, merged up to a size, split above it.

All of it happens within a document's row, so no shuffle is needed; a
document's chunks are told apart by the hash of their text, the first staying.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

TARGET_TOKENS = 500
WINDOW = TARGET_TOKENS * T.CHARS_PER_TOKEN
#: Marks before and after a heading. They begin with a code point that a text may hold, so there it is written as KEPT while the marks stand.
MARK = "\x01"
KEPT, OPEN, CLOSE = MARK + "\x02", MARK + "\x03", MARK + "\x04"
_HEADING = r"(?s)<h[1-6][^>]*(?:>|\z)(.*?)(?:</h[^>]*(?:>|\z)|\z)"
_MARKER = r"(?<![^\n])===== FILE: ([^\n]*) =====\n"
SECTIONS = "array<struct<heading:string,text:string>>"


def _split(text: Column, pattern: str, heading, body) -> Column:
    """Sections of a text; each but the first begins with a match of ``pattern``, whose group is its heading."""
    marked = F.regexp_replace(F.replace(text, F.lit(MARK), F.lit(KEPT)), pattern, OPEN + "$1" + CLOSE)
    whole = lambda x: F.replace(x, F.lit(KEPT), F.lit(MARK))
    parts = F.transform(
        F.split(marked, OPEN, -1),
        lambda x, i: F.struct(
            F.when(i == 0, F.lit("")).otherwise(heading(whole(F.split_part(x, F.lit(CLOSE), F.lit(1))))).alias("heading"),
            body(whole(F.when(i == 0, x).otherwise(F.split_part(x, F.lit(CLOSE), F.lit(2))))).alias("text"),
        ),
    )
    return F.filter(parts, lambda s: ~T.blank(s["text"]) | (s["heading"] != ""))


def html_sections(html: Column) -> Column:
    """Sections at h1 to h6: heading without tags, text without tags and with white space collapsed."""
    return _split(html, _HEADING, lambda h: T.trim(T.strip_tags(h)), lambda b: T.collapse(T.strip_tags(b)))


def text_sections(text: Column) -> Column:
    """Sections at file marker lines; bodies are kept as they are, each line with its line end."""
    lines = F.replace(text, F.lit("\r\n"), F.lit("\n"))
    ended = F.when((lines != "") & ~lines.endswith("\n"), F.concat(lines, F.lit("\n"))).otherwise(lines)
    return _split(ended, _MARKER, T.trim, lambda b: b)


def _let(value: Column, then) -> Column:
    """``then`` of a value that is computed once, however often it is named."""
    return F.transform(F.array(value), then)[0]


def merge(sections: Column) -> Column:
    """Sections to chunks (heading, text): short ones join while they fit, with an overlap where they no longer do; long ones are cut in windows.

    The fold runs over blocks of about the root of the number of sections: what it has put out is copied as it grows.
    """
    piece = lambda h, t: F.struct(h.alias("heading"), t.alias("text"))
    empty = F.expr(f"cast(array() as {SECTIONS})")
    pending = lambda a: F.when(a["p"] != "", F.array(piece(a["ph"], a["p"]))).otherwise(empty)
    state = lambda out, p, ph: F.struct(out.alias("out"), p.alias("p"), ph.alias("ph"))

    def step(a: Column, s: Column) -> Column:
        t = s["text"]
        windows = F.transform(F.sequence(F.lit(0), F.floor((F.length(t) - 1) / WINDOW).cast("int")), lambda i: piece(s["heading"], F.substring(t, i * WINDOW + 1, F.lit(WINDOW))))
        long = state(F.concat(a["out"], pending(a), windows), F.lit(""), F.lit(""))
        full = state(F.concat(a["out"], pending(a)), F.concat(T.overlap(a["p"]), F.lit(" "), t), s["heading"])
        first = state(a["out"], t, s["heading"])
        joined = state(a["out"], F.concat(a["p"], F.lit(" "), t), a["ph"])
        over = T.tokens_of(a["p"]) + T.tokens_of(t) > TARGET_TOKENS
        return F.when(T.tokens_of(t) > TARGET_TOKENS, long).when(a["p"] == "", first).when(over, full).otherwise(joined)

    def blocks(v: Column) -> Column:
        width = F.greatest(F.ceil(F.sqrt(F.size(v))).cast("int"), F.lit(1))
        return F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.size(v) / width).cast("int"), F.lit(1)) - 1), lambda i: F.slice(v, i * width + 1, width))

    def outer(a: Column, block: Column) -> Column:
        return _let(F.aggregate(block, state(empty, a["p"], a["ph"]), step), lambda b: F.struct(F.array_append(a["outs"], b["out"]).alias("outs"), b["p"].alias("p"), b["ph"].alias("ph")))

    begin = F.struct(F.expr(f"cast(array() as array<{SECTIONS}>)").alias("outs"), F.lit("").alias("p"), F.lit("").alias("ph"))
    filled = F.filter(sections, lambda s: ~T.blank(s["text"]))
    return F.aggregate(_let(filled, blocks), begin, outer, lambda a: F.concat(F.flatten(a["outs"]), pending(a)))


def first_of_each(chunks: Column) -> Column:
    """Of chunks with one id the first, in order: sorted by id and place, each id's first place is told."""
    places = F.array_sort(F.transform(chunks, lambda c, i: F.struct(c["id"].alias("id"), i.alias("at"))))
    firsts = lambda ps: F.filter(ps, lambda p, i: (i == 0) | (ps[F.greatest(i - 1, F.lit(0))]["id"] != p["id"]))
    return F.transform(F.array_sort(F.transform(_let(places, firsts), lambda p: p["at"])), lambda at: chunks[at])


def finish(pieces: Column) -> Column:
    """Pieces to chunks (id, heading, tokens, text), the first of each text."""
    whole = lambda cs: F.zip_with(cs["pieces"], cs["made"], lambda c, t: F.struct(T.sha256(t).alias("id"), c["heading"].alias("heading"), T.tokens_of(t).alias("tokens"), t.alias("text")))
    return _let(_let(pieces, lambda p: _let(F.struct(p.alias("pieces"), F.transform(p, lambda c: T.trim(c["text"])).alias("made")), whole)), first_of_each)


def chunks(docs: DataFrame) -> DataFrame:
    """(source_ord, chunk_ord, id, source, license, tier, heading, tokens, text).

    ``docs`` has ord, name, license, tier, format (``html`` or ``text``) and content (string).
    """
    sections = F.when(F.col("format") == "text", text_sections(F.col("content"))).otherwise(html_sections(F.col("content")))
    found = docs.select(F.col("ord").alias("source_ord"), F.col("name").alias("source"), "license", "tier", F.posexplode_outer(finish(merge(sections))).alias("chunk_ord", "c"))
    return found.where("c is not null").select("source_ord", "chunk_ord", "c.id", "source", "license", "tier", "c.heading", "c.tokens", "c.text")
