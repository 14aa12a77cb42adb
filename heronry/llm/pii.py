"""Personal data in disguised text, with spans in the source's code points.

A chain of transducers rewrites a text and keeps, for each rewritten piece,
where it came from: (1) homoglyphs and compatibility forms fold to ASCII and
invisible characters vanish; (2) spelled digits become digits; (3) written-out
``at`` and ``dot`` become ``@`` and ``.``. The plain detectors then run over
the result, and what they find maps back to source spans. Spans that the plain
detectors find in the source itself always stay; a disguised span is added
unless one of these of its kind contains it, so spans may overlap.

Edge cases: a null text counts as empty and gives no spans; every input row
gives one output row, repeated rows and null ids included; columns besides
the named ones are ignored. Whole texts are searched; all detectors take time
linear in the text.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rows import slices

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _back(run_end: re.Pattern[str], text: str, at: int, least: int) -> int:
    """Where the run that ``run_end`` finds before ``at`` starts; it is read backwards, a block at a time, down to ``least``."""
    while at > least:
        low = max(least, at - 256)
        run = run_end.search(text[low:at])
        if run is None:
            break
        at = low + run.start()
        if run.start():
            break
    return at


def _emails(text: str) -> list[Span]:
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = _back(_LOCAL_END, text, at, done)
        if start < at and (m := _DOMAIN.match(text, at)):
            out.append(("email", start, m.end()))
            done = m.end()
            at = text.find("@", done)
        else:
            done = at + 1
            at = text.find("@", done)
    return out


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def plain(text: str) -> list[Span]:
    """What the plain detectors find: by kind, then start; leftmost, non-overlapping within a kind."""
    out = _emails(text) if "@" in text else []
    out += [("ip", *m.span()) for m in _IP.finditer(text) if all(map(_byte, m.groups()))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := _DIGIT.sub("", m[0])) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_DIGIT.sub("", m[0])) <= 15]
    return out


# Letters of other scripts that look like ASCII letters, and characters that are not seen.
_LOOKALIKES = {
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "У": "Y", "Ѕ": "S", "І": "I", "Ј": "J",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "к": "k", "м": "m", "т": "t", "п": "n", "ь": "b",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "α": "a", "ο": "o", "ρ": "p", "ν": "v", "ι": "i", "κ": "k", "υ": "u", "τ": "t", "ε": "e", "η": "n", "ı": "i", "ɑ": "a", "ɡ": "g", "ⅼ": "l",
    "\u2010": "-", "\u2011": "-", "\u2012": "-", "\u2013": "-", "\u2212": "-", "\u2024": ".", "\u3002": ".", "\u2219": ".", "\u00b7": ".", "\u00a0": " ", "\u2009": " ", "\u202f": " ",
}
_UNSEEN = "\u00ad\u034f\u061c\u180e\u200b\u200c\u200d\u200e\u200f\u2060\ufeff"
# Digits as words, in the languages handled.
_SPELLED = {
    "zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9", "oh": "0",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
_WORD = "|".join(sorted(_SPELLED, key=lambda w: (-len(w), w)))
_FOLDABLE = re.compile("[" + re.escape("".join(_LOOKALIKES) + _UNSEEN) + "٠-٩۰-۹०-९⁰-ₜ①-⓿！-～\U0001d400-\U0001d7ff]")
_SPELLED_RUN = re.compile(rf"(?<!\w)(?:(?:\+|plus)[ -]?)?(?:(?:{_WORD}|[0-9]+)[ \t.,()-]{{1,3}}){{3,}}(?:{_WORD}|[0-9]+)(?!\w)", re.I)
_SPELLED_ONE = re.compile(rf"(?<!\w)(?:(plus)|({_WORD}))(?!\w)", re.I)
_OPEN, _CLOSE = r"[(\[{<]", r"[)\]}>]"
_MARKED = re.compile(rf"{_OPEN}\s*(?:(at|@|arroba|ät|chez)|dot|\.|punkt|punto|point)\s*{_CLOSE}", re.I)
_SPACES, _SPACES_END = re.compile(r"\s*"), re.compile(r"\s+\Z")
_NAME, _BARE = r"[A-Za-z0-9_%+-]", r"[A-Za-z0-9-]"
_DOTTED_IP = re.compile(r"(?<![\w.])[0-9]{1,3}(?: dot [0-9]{1,3}){3}(?![\w.])", re.I)
_NUMBER_DOT = re.compile(r" dot ", re.I)


class _Written:
    """Addresses around a written-out ``at``: found from there, outward, so that no character is looked at for another one's sake."""

    def __init__(self, at: str, letter: str, between: tuple[str, ...], right: str, stops: str, part: str):
        self.at = re.compile(rf"(?<={letter}){at}(?={letter})", re.I)
        self.run_end = re.compile(rf"{letter}+\Z")
        self.between = between
        self.right, self.part, self.stops = (re.compile(x, re.I) for x in (right, part, stops))

    def _names(self, text: str, end: int, least: int) -> list[tuple[int, int]]:
        """The names before ``end`` that ``between`` joins, the last first."""
        found = []
        while (start := _back(self.run_end, text, end, least)) < end:
            found.append((start, end))
            gap = next((g for g in self.between if text[max(least, start - len(g)) : start].lower() == g), None)
            if gap is None:
                break
            end = start - len(gap)
        return found

    def _start(self, text: str, end: int, least: int) -> int | None:
        """Where the name before ``end`` starts: not inside a word."""
        for low, high in reversed(self._names(text, end, least)):
            for i in range(low, high):
                if not i or not self.stops.match(text, i - 1):
                    return i
        return None

    def edits(self, text: str) -> list[tuple[int, int, str]]:
        out, done = [], 0
        for m in self.at.finditer(text):
            if m.start() > done and (right := self.right.match(text, m.end())) and (start := self._start(text, m.start(), done)) is not None:
                done = right.end()
                out += [(*x.span(), "@" if (x[1] or ".").lower() in ("at", "@") else ".") for x in self.part.finditer(text, start, done)]
        return out


_SPOKEN_PART = r" (at|dot|@|\.) |(?<=\w) \.|\. (?=\w)"
_WRITTEN = (
    _Written(" at ", _NAME, (" dot ", "."), rf"{_NAME}++(?: dot {_NAME}++)+(?![\w@])", r"[\w@.]", _SPOKEN_PART),
    _Written(" @ ", _NAME, (".",), rf"{_NAME}++(?: ?\. ?{_NAME}++)+(?![\w@])", r"[\w@.]", _SPOKEN_PART),
    _Written("_at_", r"[A-Za-z0-9.+-]", (), rf"{_BARE}++(?:_dot_{_BARE}++)+(?![^\W_])", r"[^\W_]", r"_(at|dot)_"),
)
_HINT = re.compile(rf"{_OPEN}\s*(?:at|@|dot|\.|arroba|ät|punkt|punto|point|chez)\s*{_CLOSE}|_at_|_dot_| dot | @ ", re.I)


class Rewritten:
    """A text and where each of its characters stands in the source."""

    def __init__(self, text: str):
        self.text = text
        self.starts, self.shift = [0], [(0, 0)]  # a piece's start here; its source start and length there (0: copied)

    def source(self, start: int, end: int) -> tuple[int, int]:
        """The source span that gave the characters start..end."""
        return self._at(start)[0], self._at(end - 1)[1]

    def _at(self, i: int) -> tuple[int, int]:
        k = bisect_right(self.starts, i) - 1
        origin, length = self.shift[k]
        if length:
            return origin, origin + length
        at = origin + i - self.starts[k]
        return at, at + 1

    def apply(self, edits: list[tuple[int, int, str]]) -> Rewritten:
        """Replace the given ascending, disjoint ranges."""
        out, pieces, here = Rewritten(""), [], 0
        starts, shift = [], []

        def copy(a: int, b: int) -> None:
            nonlocal here
            while a < b:
                k = bisect_right(self.starts, a) - 1
                stop = min(b, self.starts[k + 1] if k + 1 < len(self.starts) else b)
                origin, length = self.shift[k]
                starts.append(here)
                shift.append((origin, length) if length else (origin + a - self.starts[k], 0))
                pieces.append(self.text[a:stop])
                here += stop - a
                a = stop

        at = 0
        for a, b, new in edits:
            copy(at, a)
            if new:
                low, high = self.source(a, b)
                starts.append(here)
                shift.append((low, high - low))
                pieces.append(new)
                here += len(new)
            at = b
        copy(at, len(self.text))
        out.text, out.starts, out.shift = "".join(pieces), starts or [0], shift or [(0, 0)]
        return out


def _fold(c: str) -> str:
    if c in _UNSEEN:
        return ""
    if c in _LOOKALIKES:
        return _LOOKALIKES[c]
    flat = unicodedata.normalize("NFKC", c)
    return flat if flat.isascii() else str(unicodedata.digit(c)) if unicodedata.digit(c, None) is not None else c


def _homoglyphs(r: Rewritten) -> Rewritten:
    return r.apply([(m.start(), m.end(), new) for m in _FOLDABLE.finditer(r.text) if (new := _fold(m[0])) != m[0]])


def _digits(r: Rewritten) -> Rewritten:
    edits = []
    for run in _SPELLED_RUN.finditer(r.text):
        end = run.start()
        for m in _SPELLED_ONE.finditer(r.text, run.start(), run.end()):
            if m[1]:
                edits.append((m.start(), m.end() + (r.text[m.end() : m.end() + 1] in (" ", "-")), "+"))
            else:
                if edits and m.start() > end and end > run.start() and not r.text[end : m.start()].strip(" \t.,()-"):
                    edits.append((end, m.start(), " "))
                edits.append((m.start(), m.end(), _SPELLED[m[2].lower()]))
            end = edits[-1][1]
    return r.apply(edits)


def _at_dot(r: Rewritten) -> Rewritten:
    edits, last = [], 0
    for m in _MARKED.finditer(r.text):
        start = _back(_SPACES_END, r.text, m.start(), last)
        last = _SPACES.match(r.text, m.end()).end()
        edits.append((start, last, "@" if m[1] else "."))
    r = r.apply(edits)
    edits = [e for rule in _WRITTEN for e in rule.edits(r.text)]
    for run in _DOTTED_IP.finditer(r.text):
        edits += [(*m.span(), ".") for m in _NUMBER_DOT.finditer(r.text, *run.span())]
    disjoint, last = [], 0
    for a, b, new in sorted(edits):
        if a >= last:
            disjoint.append((a, b, new))
            last = b
    return r.apply(disjoint)


def detect(text: str) -> tuple[list[Span], list[Span]]:
    """(plain spans, all spans), each by kind and start."""
    base = plain(text)
    foldable = not text.isascii() and _FOLDABLE.search(text) is not None
    if not foldable and not _HINT.search(text) and not _SPELLED_RUN.search(text):
        return base, base
    r = Rewritten(text)
    if foldable:
        r = _homoglyphs(r)
    r = _at_dot(_digits(r))
    if r.text == text:
        return base, base
    found = list(base)
    starts = {k: [a for kind, a, _ in base if kind == k] for k in KINDS}
    ends = {k: [b for kind, _, b in base if kind == k] for k in KINDS}
    for kind, start, end in plain(r.text):
        a, b = r.source(start, end)
        before = bisect_right(starts[kind], a) - 1  # plain spans of a kind are disjoint
        if before < 0 or b > ends[kind][before]:
            found.append((kind, a, b))
    found.sort(key=lambda s: (KINDS.index(s[0]), *s[1:]))
    return base, found


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find(docs: DataFrame, *, text: str = "text", keep: list[Column] | None = None) -> DataFrame:
    """For each row: ``keep``, ``base`` and ``spans`` (arrays of kind, start, end; end exclusive)."""
    kept = docs.select(*(keep or []), F.col(text).alias("__text"))
    names = kept.columns[:-1]
    span = "array<struct<kind:string,start:long,end:long>>"
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "__text"):
            found = [detect(x) if x else ([], []) for x in part.column("__text").to_pylist()]
            as_rows = lambda i: pa.array([[dict(zip(("kind", "start", "end"), s, strict=True)) for s in f[i]] for f in found], kind)  # noqa: B023, E731
            yield pa.record_batch([*part.columns[:-1], as_rows(0), as_rows(1)], names=[*names, "base", "spans"])

    schema = kept.select(*names, F.expr(f"cast(null as {span})").alias("base"), F.expr(f"cast(null as {span})").alias("spans")).schema
    return kept.mapInArrow(task, schema)


def redact(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """Replace every span in column ``text`` by its kind in angle brackets; other columns stay as they are.

    Overlapping spans are replaced together, under the kind listed first. A null text stays null.
    """
    names = docs.columns
    place = names.index(text)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text):
            new = pa.array([masked(x) if x else x for x in part.column(place).to_pylist()], pa.string())
            yield pa.record_batch([new if i == place else c for i, c in enumerate(part.columns)], names=names)

    return docs.mapInArrow(task, docs.schema)


def masked(text: str) -> str:
    spans = sorted(detect(text)[1], key=lambda s: (s[1], KINDS.index(s[0])))
    if not spans:
        return text
    merged: list[list] = []
    for kind, a, b in spans:
        if merged and a < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], b)
            merged[-1][0] = min(merged[-1][0], kind, key=KINDS.index)
        else:
            merged.append([kind, a, b])
    out, at = [], 0
    for kind, a, b in merged:
        out += [text[at:a], f"<{kind}>"]
        at = b
    return "".join([*out, text[at:]])


def span_text(column: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined in their order."""
    return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
