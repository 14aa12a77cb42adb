"""Document fingerprints: bottom-k sketches of shingle hashes, in DataFrame functions only.

The sketch of a set of shingles is its ``k`` smallest distinct hashes,
ascending. The sketch of a union follows from the sketches of its parts, so a
document may be sketched in pieces. From sketches: resemblance is the share of
the union's smallest k that both sets have; the number of distinct shingles
comes from the k-th smallest hash (exact below k); containment from both.

Edge cases: a null text counts as empty; a text without words has an empty
sketch; one with fewer words than a shingle is one shingle. Two empty sketches
resemble each other by 1, an empty and another by 0. Rows are never dropped or
merged. A sketch's size does not depend on its text; a document is worked on
within its row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

K = 64
WORDS = 5


def shingle_hashes(text: Column, words: int = WORDS) -> Column:
    """Hashes of all shingles of ``words`` lower-cased words, in order, repeats included."""
    split = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s+"), lambda w: w != "")
    return F.transform(F.array(split), lambda ws: _hashes(ws, words))[0]


def _hashes(ws: Column, words: int) -> Column:
    at = F.sequence(F.lit(0), F.size(ws) - words)
    rolled = F.transform(at, lambda i: F.xxhash64(*[F.get(ws, i + j) for j in range(words)]))
    whole = F.when(F.size(ws) > 0, F.array(F.xxhash64(F.array_join(ws, " ")))).otherwise(F.array().cast("array<long>"))
    return F.when(F.size(ws) >= words, rolled).otherwise(whole)


def bottom(hashes: Column, k: int = K) -> Column:
    """The k smallest distinct hashes, ascending."""
    return F.slice(F.array_sort(F.array_distinct(hashes)), 1, k)


def sketch(text: Column, k: int = K, words: int = WORDS) -> Column:
    return bottom(shingle_hashes(text, words), k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of the union of what a and b sketch."""
    return F.slice(F.array_sort(F.array_union(a, b)), 1, k)


def merged(rows: DataFrame, by: list[str], column: str = "sketch", k: int = K) -> DataFrame:
    """One sketch for each group: the hashes of the parts, distinct before the shuffle, the k smallest of each group after.

    Parts are merged on hashes rather than on lists, and ranks are cut within
    each task first, so a group with very many parts never gathers in one place.
    """
    from pyspark.sql import Window

    hashes = rows.select(*by, F.explode(column).alias("h")).distinct()
    least = Window.partitionBy(*by).orderBy("h")
    return hashes.withColumn("r", F.row_number().over(least)).where(F.col("r") <= k).groupBy(*by).agg(F.array_sort(F.collect_list("h")).alias(column))


def distinct_count(s: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles."""
    share = (F.element_at(s, -1).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(s) < k, F.size(s).cast("double")).otherwise((k - 1) / share)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity, 0 to 1."""
    union = merge(a, b, k)
    both = F.size(F.array_intersect(union, F.array_intersect(a, b)))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(both / F.greatest(F.size(union), F.lit(1)))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has, 0 to 1; 1 for an empty a."""
    common = resemblance(a, b, k) * distinct_count(merge(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), common / F.greatest(distinct_count(a, k), F.lit(1.0))))


def text_of(s: Column) -> Column:
    """A sketch as a string: 16 hex digits a hash, comma-joined."""
    return F.array_join(F.transform(s, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), ",")
