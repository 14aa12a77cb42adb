"""Secrets by known forms and by tests of randomness, in DataFrame functions only.

Known forms (assigned credentials, access keys, hexadecimal runs) are found by
pattern. Every other token of 20 characters or more is tried; one that mixes
both base64 alphabets (a key behind a path) by its long runs of either, whose
spans may overlap. Its encoding is inferred from its characters, its characters
become numbers, and three statistics are taken: chi-squared of the counts, the
number of runs above and below the middle, and lag-1 serial correlation. A
token that one of them rejects as uniform random symbols goes. The others still
have to be told from tokens of plain structure: words, whose letters repeat,
and sequences, which turn seldom, always, or follow themselves. For each of the
three statistics there is a chance that a token of such structure and of this
length would look as random as this one; the largest of the three is the
token's p, whichever structure it has. Chances fall with the length, and the
Benjamini-Hochberg procedure, run apart for each class of lengths over the
tokens of all rows, bounds the share of plain tokens among what is reported.

Edge cases: a null text counts as empty and has no spans; each row keeps its
own row, repeated rows and null ids included; a table without tokens reports
none. Only a histogram, of a fixed number of bins, is brought together.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import written

KINDS = ("assign", "access", "hex", "random")
# The patterns of the known forms.
_ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
_ACCESS = r"AKIA[A-Z0-9]+"
_HEX = r"[0-9a-f]{16,}"
# Stands for a character of a known form; and what stands for the same code point of a text, as long as it and in no pattern.
_MASK, _OTHER = "\ufdd0", "\ufdd1"
_TOKEN = rf"(?<![A-Za-z0-9+/_{_MASK}-])[A-Za-z0-9+/_-]{{20,}}+={{0,2}}+(?!{_MASK})"
# A token of both base64 alphabets fits none: its runs of either are tried.
_PARTS = (r"[A-Za-z0-9_-]{20,}={0,2}", r"[A-Za-z0-9+/]{20,}={0,2}")
_UPPER, _LOWER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
#: Encodings from the narrowest (decimal and lower-case hexadecimal tokens are known forms already): pattern, alphabet, chance that two symbols of a word-like token agree.
ENCODINGS = (
    (r"^[0-9A-F]+$", _DIGITS + "ABCDEF", 0.125),
    (r"^[a-z]+$", _LOWER, 0.07),
    (r"^[A-Z]+$", _UPPER, 0.07),
    (r"^[A-Z2-7]+=*$", _UPPER + "234567", 0.075),
    (r"^[a-z2-7]+=*$", _LOWER + "234567", 0.075),
    (r"^[0-9a-z]+$", _DIGITS + _LOWER, 0.07),
    (r"^[0-9A-Z]+$", _DIGITS + _UPPER, 0.07),
    (r"^[A-Za-z0-9]+$", _UPPER + _LOWER + _DIGITS, 0.06),
    (r"^[A-Za-z0-9_-]+=*$", _UPPER + _LOWER + _DIGITS + "-_", 0.06),
    (r"^[A-Za-z0-9+/]+=*$", _UPPER + _LOWER + _DIGITS + "+/", 0.06),
)
#: Least length of each class.
LENGTHS = (20, 28, 40, 64)
REJECT = 1e-3
#: Tokens of plain structure change sides with a chance of at most STAYS or at least TURNS, or correlate with themselves by SERIAL.
STAYS, TURNS, SERIAL = 0.1, 0.95, 0.9
FALSE_SHARE = 0.01
BINS_PER_DECADE = 20


def _found(text: Column, pattern: str, value: int = 0) -> tuple[Column, Column]:
    """The pieces of a text between the matches, and of each match its length and the group ``value``."""
    rx = F.lit(pattern)
    matches = F.zip_with(F.regexp_extract_all(text, rx, F.lit(0)), F.regexp_extract_all(text, rx, F.lit(value)), lambda w, v: F.struct(F.char_length(w).alias("size"), v.alias("value"), w.alias("whole")))
    return F.split(text, pattern, -1), matches


def _spans(text: Column, pattern: str, kind: str, kept: Callable[[Column], Column] | None = None, value: int = 0) -> Column:
    """Spans of the matches whose group ``value`` passes ``kept``; each is (start, end, kind, that group).

    Starts are running sums. An array that grows by one element at a time is copied each time, so the sums run over
    blocks of about the root of the number of matches.
    """
    none = F.expr("cast(array() as array<struct<start:int,end:int,kind:string,value:string>>)")
    gaps, matches = _found(text, pattern, value)
    steps = F.zip_with(gaps, matches, lambda g, m: F.struct(F.char_length(g).alias("gap"), F.coalesce(m["size"], F.lit(0)).alias("size"), m["value"].alias("value")))

    def add(acc: Column, s: Column) -> Column:
        begin = acc["at"] + s["gap"]
        end = begin + s["size"]
        span = F.struct(begin.alias("start"), end.alias("end"), F.lit(kind).alias("kind"), s["value"].alias("value"))
        return F.struct(end.alias("at"), F.when(s["value"].isNotNull(), F.array_append(acc["found"], span)).otherwise(acc["found"]).alias("found"))

    def blocks(v: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(v))).cast("int")
        return F.transform(F.sequence(F.lit(0), F.ceil(F.size(v) / width).cast("int") - 1), lambda i: F.slice(v, i * width + 1, width))

    def starts(bs: Column) -> Column:
        sums = F.transform(bs, lambda b: F.aggregate(b, F.lit(0), lambda a, s: a + s["gap"] + s["size"]))
        grow = lambda a, x: F.struct((a["at"] + x).alias("at"), F.array_append(a["all"], a["at"]).alias("all"))
        return F.aggregate(sums, F.expr("named_struct('at', 0, 'all', cast(array() as array<int>))"), grow)["all"]

    def spans(p: Column) -> Column:
        begin = lambda i: F.struct(p["starts"][i].alias("at"), none.alias("found"))
        return F.flatten(F.transform(p["blocks"], lambda b, i: F.aggregate(b, begin(i), add)["found"]))

    found = _let(steps, lambda v: _let(blocks(v), lambda bs: _let(F.struct(bs.alias("blocks"), starts(bs).alias("starts")), spans)))
    if kept is not None:
        found = F.filter(found, kept)
    return F.when(text.rlike(pattern), found).otherwise(none)


def _masked(text: Column, pattern: str, kept: Callable[[Column], Column] | None = None, value: int = 0) -> Column:
    """The text, as long as before, with the matches that pass ``kept`` overwritten."""
    gaps, matches = _found(text, pattern, value)
    over = lambda m: F.when(F.lit(True) if kept is None else kept(m), F.repeat(F.lit(_MASK), m["size"])).otherwise(m["whole"])
    joined = F.array_join(F.zip_with(gaps, matches, lambda g, m: F.concat(g, F.coalesce(over(m), F.lit("")))), "")
    return F.when(text.rlike(pattern), joined).otherwise(text)


#: The known forms: kind, pattern, what a match must pass, and the group that it is asked of.
_KNOWN = (
    ("assign", _ASSIGN, lambda s: F.char_length(s["value"]) >= 12, 2),
    ("access", _ACCESS, lambda s: F.char_length(s["value"]) >= 18, 0),
    ("hex", _HEX, None, 0),
)


def known_spans(text: Column) -> Column:
    """Spans of the known forms, by start, then kind as listed."""
    parts = [_spans(text, pattern, kind, kept, value) for kind, pattern, kept, value in _KNOWN]
    return _in_order(F.concat(*parts))


def _in_order(spans: Column) -> Column:
    place = lambda s: reduce(lambda rest, k: F.when(s["kind"] == k[1], k[0]).otherwise(rest), enumerate(KINDS), F.lit(len(KINDS)))
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), place(s).alias("place"), s.alias("span")))
    return F.transform(F.array_sort(keyed), lambda s: s["span"])


def _tail(z: Column) -> Column:
    """Upper tail of the normal distribution, by the logistic approximation; within 0.0002."""
    z = F.least(F.greatest(z, F.lit(-12.0)), F.lit(12.0))
    return 1 / (1 + F.exp(z * 1.5976 + z * z * z * 0.07056))


def battery(token: Column, alphabet: str, agree: float) -> Column:
    """(p_random, p_plain): the least p of the three tests against uniform symbols, times 3; and the largest, over the same
    three statistics, of the chances that a token of plain structure would look as random as this one."""
    m = len(alphabet)
    letters = F.filter(F.split(F.regexp_replace(token, "=+$", ""), ""), lambda c: c != "")
    codes = F.transform(letters, lambda c: F.instr(F.lit(alphabet), c).cast("double") - 1)
    add = lambda a, x: a + x

    def counted(v: Column) -> Column:
        n = F.size(v).cast("double")
        squares = F.transform(F.sequence(F.lit(0), F.lit(m - 1)), lambda i: F.pow(F.size(F.filter(v, lambda x: x == i.cast("double"))).cast("double"), F.lit(2.0)))
        return F.struct(
            v.alias("v"), n.alias("n"), (F.aggregate(squares, F.lit(0.0), add) * m / n - n).alias("chi"),
            F.aggregate(F.transform(v, lambda x: (x >= m / 2).cast("double")), F.lit(0.0), add).alias("ups"), (F.aggregate(v, F.lit(0.0), add) / n).alias("mean"),
        )

    def paired(s: Column) -> Column:
        v, mean = s["v"], s["mean"]
        before, after = F.slice(v, 1, F.size(v) - 1), F.slice(v, 2, F.size(v) - 1)
        return F.struct(
            s.alias("s"), F.aggregate(F.zip_with(before, after, lambda x, y: ((x >= m / 2) != (y >= m / 2)).cast("double")), F.lit(1.0), add).alias("runs"),
            F.aggregate(v, F.lit(0.0), lambda a, x: a + (x - mean) * (x - mean)).alias("var"),
            F.aggregate(F.zip_with(before, after, lambda x, y: (x - mean) * (y - mean)), F.lit(0.0), add).alias("lag"),
        )

    def tested(t: Column) -> Column:
        n, chi, ups = t["s"]["n"], t["s"]["chi"], t["s"]["ups"]
        spread = F.sqrt(2.0 * (m - 1) * (n - 1) / n)
        p_even = _tail((chi - (m - 1)) / spread)
        mean_runs = 2 * ups * (n - ups) / n + 1
        var_runs = F.greatest((mean_runs - 1) * (mean_runs - 2) / (n - 1), F.lit(1e-9))
        p_runs = F.when((ups == 0) | (ups == n), F.lit(0.0)).otherwise(2 * _tail(F.abs(t["runs"] - mean_runs) / F.sqrt(var_runs)))
        p_serial = F.when(t["var"] == 0, F.lit(0.0)).otherwise(2 * _tail(F.abs(t["lag"] / F.greatest(t["var"], F.lit(1e-9)) + 1 / n) * F.sqrt(n)))
        looks_even = _tail((m + m * (n - 1) * agree - n - chi) / (2 * spread))
        turns, some = t["runs"] - 1, n - 1
        away = lambda c, side: _tail(side * (turns - some * c) / F.sqrt(some * c * (1 - c)))
        looks_turning = F.greatest(away(STAYS, 1), away(TURNS, -1))
        looks_free = _tail((SERIAL - F.abs(t["lag"] / F.greatest(t["var"], F.lit(1e-9)))) * F.sqrt(n) / (1 - SERIAL**2) ** 0.5)
        return F.struct(F.least(F.lit(1.0), 3 * F.least(p_even, p_runs, p_serial)).alias("p_random"), F.greatest(looks_even, looks_turning, looks_free).alias("p_plain"))

    return _let(codes, lambda v: _let(counted(v), lambda s: _let(paired(s), tested)))


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once, however often it is named."""
    return F.transform(F.array(value), then)[0]


def tokens(text: Column) -> Column:
    """Tokens clear of the known forms that no test rejects as random: start, end, class of length, bin of their chance.

    The known forms are overwritten first; what a token loses to one leaves it beside the mark, where none is taken.
    """
    clear = F.replace(text, F.lit(_MASK), F.lit(_OTHER))  # no mark but those that are set here
    every = _spans(reduce(lambda t, k: _masked(t, *k[1:]), _KNOWN, clear), _TOKEN, "random")
    mixed = lambda s: s["value"].rlike("[+/]") & s["value"].rlike("[_-]")
    shifted = lambda s, p: F.struct((s["start"] + p["start"]).alias("start"), (s["start"] + p["end"]).alias("end"), p["kind"].alias("kind"), p["value"].alias("value"))
    # no run is one of both alphabets: then it would be the whole token
    parts = lambda s: F.transform(F.concat(*[_spans(s["value"], p, "random") for p in _PARTS]), lambda p: shifted(s, p))
    split = lambda all_: F.concat(F.filter(all_, lambda s: ~mixed(s)), F.flatten(F.transform(F.filter(all_, mixed), parts)))
    found = _let(every, split)
    tried = F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), _tried(s["value"]).alias("p")))
    passed = F.filter(tried, lambda s: s["p"]["p_random"] >= REJECT)
    size = lambda s: s["end"] - s["start"]
    group = lambda s: reduce(lambda rest, x: F.when(size(s) >= x[1], x[0]).otherwise(rest), enumerate(LENGTHS), F.lit(0))
    return F.transform(passed, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), group(s).alias("group"), F.floor(-F.log10(F.greatest(s["p"]["p_plain"], F.lit(1e-30))) * BINS_PER_DECADE).cast("int").alias("bin")))


def _tried(value: Column) -> Column:
    rest = F.struct(F.lit(0.0).alias("p_random"), F.lit(1.0).alias("p_plain"))
    for pattern, alphabet, agree in reversed(ENCODINGS):
        rest = F.when(value.rlike(pattern), battery(value, alphabet, agree)).otherwise(rest)
    return rest


def cutoffs(found: DataFrame, column: str = "tokens", share: float = FALSE_SHARE) -> dict[int, int]:
    """For each class of lengths, the least bin reported: Benjamini-Hochberg over all tokens of the table."""
    bins = found.select(F.explode(column).alias("t")).groupBy("t.group", "t.bin").agg(F.count("*").alias("n"))
    above = Window.partitionBy("group").orderBy(F.desc("bin"))
    every = Window.partitionBy("group")
    ranked = bins.select("group", "bin", F.sum("n").over(above).alias("rank"), F.sum("n").over(every).alias("all"))
    p = F.pow(F.lit(10.0), -F.col("bin") / BINS_PER_DECADE)
    return {r["group"]: r["least"] for r in ranked.where(p * F.col("all") <= F.col("rank") * share).groupBy("group").agg(F.min("bin").alias("least")).collect()}


def find(docs: DataFrame, *, text: str = "text", keep: list[Column]) -> DataFrame:
    """For each row: ``keep``, ``base`` (known forms) and ``spans`` (all), arrays of start, end and kind."""
    names = docs.select(*keep).columns
    whole = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("__text"))
    known = whole.select("*", known_spans(F.col("__text")).alias("__known"))
    plain = F.transform("__known", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    found = written(known.select(*names, plain.alias("base"), tokens(F.col("__text")).alias("tokens")), "tokens")
    least = cutoffs(found)
    floor = lambda t: reduce(lambda rest, g: F.when(t["group"] == g, t["bin"] >= least[g]).otherwise(rest), least, F.lit(False))
    added = F.transform(F.filter("tokens", floor), lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"), F.lit("random").alias("kind")))
    return found.select(*names, "base", _in_order(F.concat("base", added)).alias("spans"))


def span_text(column: str) -> Column:
    return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
