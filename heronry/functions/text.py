"""Text functions as Column expressions. Characters are Unicode code points."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

CHARS_PER_TOKEN = 4
OVERLAP_CHARS = 200
SPACE = r"\p{IsWhite_Space}"
# The character references that are decoded, in this order.
ENTITIES = (("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "))


def trim(c: Column) -> Column:
    """Without white space, by Unicode, at either end."""
    return F.regexp_replace(c, rf"^{SPACE}+|{SPACE}+\z", "")


def collapse(c: Column) -> Column:
    """Each run of white space as one space; none at the ends."""
    return trim(F.regexp_replace(c, f"{SPACE}+", " "))


def blank(c: Column) -> Column:
    return F.length(trim(c)) == 0


def strip_tags(c: Column) -> Column:
    """Without tags (an unclosed one reaches the end), then with the character references decoded in turn."""
    return reduce(lambda x, e: F.replace(x, F.lit(e[0]), F.lit(e[1])), ENTITIES, F.regexp_replace(c, "<[^>]*>?", ""))


def tokens_of(c: Column) -> Column:
    """Estimated tokens: a token for each four characters, rounded up."""
    return F.ceil(F.length(c) / CHARS_PER_TOKEN).cast("int")


def overlap(c: Column) -> Column:
    return F.right(c, F.lit(OVERLAP_CHARS))


def sha256(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)


def words(c: Column) -> Column:
    """Search terms: runs of letters, digits and underscores, split where a capital follows a small letter, in lower case.

    Explode this, and other costly arrays, with ``explode_outer`` and drop the
    nulls: for a plain ``explode`` Spark adds a filter on the array's size,
    below the scan's exchange, which computes the array twice.
    """
    split = F.regexp_replace(c, "(?<=[a-z])(?=[A-Z])", " ")
    return F.transform(F.regexp_extract_all(split, F.lit(r"[\p{IsAlphabetic}\p{N}_]+"), F.lit(0)), F.lower)


def match_count(text: Column, query: Column) -> Column:
    """Non-overlapping occurrences of a trimmed query, whatever the case; one that spans lines has none."""
    low, q = F.lower(text), F.lower(query)
    n = ((F.length(low) - F.length(F.replace(low, q, F.lit("")))) / F.greatest(F.length(q), F.lit(1))).cast("long")
    return F.when((F.length(q) == 0) | q.contains("\n"), F.lit(0).cast("long")).otherwise(n)


def cut(text: Column, most: int) -> Column:
    """Trimmed, and with an ellipsis where it is longer than ``most``."""
    t = trim(text)
    return F.when(F.length(t) <= most, t).otherwise(F.concat(F.left(t, F.lit(most)), F.lit("…")))


def first_match(text: Column, query: Column, most: int = 240) -> Column:
    """The first line that holds the query, cut to ``most``; empty without one."""
    lines = F.split(text, "\r?\n")
    found = F.filter(lines, lambda x: F.contains(F.lower(x), F.lower(query)))
    return F.coalesce(cut(F.get(found, F.lit(0)), most), F.lit(""))


def stem(file: Column) -> Column:
    """A file name without what follows its last dot."""
    return F.regexp_replace(file, r"\.[^.]*\z", "")
