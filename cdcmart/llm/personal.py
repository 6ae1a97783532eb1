"""Personal data, also in disguise: transducers that keep the way back to the source.

Identifiers are searched twice. In the text as it stands they give the base spans. Then four transducers rewrite the
text one after the other, each noting its edits (a stretch of its input and what stands for it in its output):

1. look-alikes and invisible characters become ASCII letters, digits and marks, or go;
2. letters that look like digits become digits within numbers;
3. spelled digits in a row become digits, "plus" before them and "dot" between numbers their marks;
4. "at" and "dot", bracketed or as words, become the marks of a mail address where the whole of one is there.

What is found in the result is mapped back through the edits, last transducer first. An identifier that contains at
least one edit, and does not lie in a base span of its kind, is added. Without any edit there is nothing to add.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Callable, Iterator
from functools import lru_cache, reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcmart.llm.common import free_name, in_slices, map_arrow, ship_package

# The kinds in their order, and their patterns. Runs are possessive so that long ones are read once.
KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_PARTS = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]+")

Span = tuple[int, int, int]  # start, end, kind


def _emails(text: str) -> Iterator[tuple[int, int]]:
    free, at = 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        if domain:
            start = at
            while start > free and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                yield start, domain.end()
                free = domain.end()
        at = text.find("@", max(at + 1, free))


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    for run in _PARTS.finditer(text):
        if run[0].count(".") < 3:
            continue
        parts, at, places = run[0].split("."), run.start(), []
        for part in parts:
            places.append((at, at + len(part)))
            at += len(part) + 1
        # From the left, four at a time; four that are no address are passed by.
        for k in range(0, len(parts) - 3, 4):
            if all(len(p := part.lstrip("0")) <= 3 and int(p or "0") <= 255 for part in parts[k : k + 4]):
                yield places[k][0], places[k + 3][1]


def luhn(digits: str) -> bool:
    """Whether the last digit checks those before it."""
    total = 0
    for k, digit in enumerate(reversed(digits)):
        twice = int(digit) * (1 + k % 2)
        total += twice - 9 * (twice > 9)
    return total % 10 == 0


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for run in _DIGITS.finditer(text):
        if run.end() - run.start() >= 12:
            digits = _NO_DIGIT.sub("", run[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                yield run.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for run in _PHONE.finditer(text):
        if 9 <= len(_NO_DIGIT.sub("", run[0])) <= 15:
            yield run.span()


_FINDERS = (_emails, _addresses, _cards, _phones)


def plain_spans(text: str) -> list[Span]:
    """Identifiers of a text as it stands, by start, then kind."""
    return sorted((a, b, kind) for kind, find in enumerate(_FINDERS) for a, b in find(text))


# -- transducers ----------------------------------------------------------------------------------

Edit = tuple[int, int, str]  # start and end in the input, what stands for it in the output


class Rewritten:
    """A text after some edits, and where its characters come from."""

    def __init__(self, source: str, edits: list[Edit]):
        pieces, at, size = [], 0, 0
        self._begins: list[int] = []  # of each edit in the output
        self._edits: list[tuple[int, int, int]] = []  # end in the output, start and end in the input
        for start, end, new in edits:
            pieces += (source[at:start], new)
            size += start - at
            self._begins.append(size)
            size += len(new)
            self._edits.append((size, start, end))
            at = end
        pieces.append(source[at:])
        self.text = "".join(pieces)

    def _source(self, at: int) -> tuple[int, int]:
        """What the character at ``at`` stands for."""
        k = bisect_right(self._begins, at) - 1
        if k < 0:
            return at, at + 1
        size, start, end = self._edits[k]
        return (start, end) if at < size else (end + at - size, end + at - size + 1)

    def back(self, start: int, end: int) -> tuple[int, int]:
        """The stretch of the input that an output stretch, not an empty one, stands for."""
        return self._source(start)[0], self._source(end - 1)[1]

    def touched(self, start: int, end: int) -> bool:
        """Whether an edit lies within the output stretch, a deletion at either end aside."""
        k = bisect_right(self._begins, start)
        return (k > 0 and self._edits[k - 1][0] > start) or (k < len(self._begins) and self._begins[k] < end)


# Letters of other scripts that look like Latin ones, and the Latin ones below them.
_ALIKE = "АВЕЅІЈКМНОРСТХУасеѕіјорхуһԁԛԝкмтвнӏΑΒΕΖΗΙΚΜΝΟΡΤΥΧονικρυαγոսօıɑɡ"
_LATIN = "ABESIJKMHOPCTXYacesijopxyhdqwkmtbhlABEZHIKMNOPTYXovikpuaynuoiag"
_MARKS = {"-": "‐‑‒–—―−﹘﹣", ".": "․。﹒｡", "@": "﹫", "+": "﹢", " ": "   　"}
_INVISIBLE = "­͏᠎​‌‍‎‏⁠⁡⁢⁣⁤﻿"


@lru_cache(1)
def look_alikes() -> dict[str, str]:
    """What each look-alike stands for: fixed letters and marks, and by rule full-width, letter-like, circled and
    mathematical characters and the digits of all scripts."""
    table = dict(zip(_ALIKE, _LATIN))
    table |= {c: mark for mark, alike in _MARKS.items() for c in alike}
    table |= {chr(c): " " for c in range(0x2000, 0x200B)}
    table |= {chr(c): chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)}
    table |= dict.fromkeys(_INVISIBLE, "") | {chr(c): "" for c in range(0xFE00, 0xFE10)}
    for c in map(chr, range(0x80, 0x20000)):
        digit = unicodedata.digit(c, None)
        if digit is not None:
            table[c] = str(digit)
        elif "\u2100" <= c <= "\u24ff" or "\U0001d400" <= c <= "\U0001d7ff":
            plain = unicodedata.normalize("NFKC", c)
            if len(plain) == 1 and plain.isascii() and plain.isalnum():
                table[c] = plain
    return table


@lru_cache(1)
def _alike_pattern() -> re.Pattern[str]:
    # All of the planes beyond the first: looked up one by one, as a set of them would be slow to test.
    first = "".join(c for c in look_alikes() if c < "\U00010000")
    return re.compile(f"[{re.escape(first)}\U00010000-\U0001ffff]")


def alike_edits(text: str) -> list[Edit]:
    """Look-alikes and invisible characters, one by one."""
    if text.isascii():
        return []
    table = look_alikes()
    return [(m.start(), m.end(), table[m[0]]) for m in _alike_pattern().finditer(text) if m[0] in table]


# Letters for digits within numbers.
_NUMERALS = str.maketrans("OolI", "0011")
_MIXED = re.compile(r"(?<![0-9A-Za-z])(?=[OolI]*[0-9])[0-9OolI]*[OolI][0-9OolI]*+(?![0-9A-Za-z])")
_LETTER = re.compile("[OolI]")


def numeral_edits(text: str) -> list[Edit]:
    """The letters O, o, l and I in runs of digits that no other letter touches."""
    return [
        (run.start() + m.start(), run.start() + m.end(), m[0].translate(_NUMERALS))
        for run in _MIXED.finditer(text)
        for m in _LETTER.finditer(run[0])
    ]


# The digits from 0 to 9 in four languages, and the words for marks between them.
_SPELLED = (
    "zero one two three four five six seven eight nine",
    "null eins zwei drei vier fünf sechs sieben acht neun",
    "zéro un deux trois quatre cinq six sept huit neuf",
    "cero uno dos tres cuatro cinco seis siete ocho nueve",
)
_VALUE = {word: str(k) for words in _SPELLED for k, word in enumerate(words.split())} | {"oh": "0", "zwo": "2"}
_TIMES = {"double": 2, "triple": 3}
_DOT_WORDS = ("dot", "point", "punkt", "punto")
_LEAST_SPELLED = 3

_any = lambda words: "|".join(sorted(words, key=len, reverse=True))
_GAP = r"[ \t,.()-]{1,4}"
_ITEM = rf"(?:(?:{_any(_TIMES)})[ ])?(?:{_any(_VALUE)})|[0-9]++"
_ROW = re.compile(
    rf"(?<![\w+])(?:plus[ ]|\+[ ]?)?\(?(?:{_ITEM})(?:(?:{_GAP}|[ ](?:{_any(_DOT_WORDS)})[ ])(?:{_ITEM}))++(?!\w)", re.IGNORECASE
)
_ROW_PART = re.compile(
    rf"(?P<plus>plus[ ]|\+[ ])|(?P<dot>[ ](?:{_any(_DOT_WORDS)})[ ])|(?P<gap>[ \t,.()-]+)"
    rf"|(?:(?P<times>{_any(_TIMES)})[ ])?(?P<word>{_any(_VALUE)})|(?P<digits>[0-9]+)",
    re.IGNORECASE,
)
_SPELLED_WORD = re.compile(rf"(?<!\w)(?:{_any(_VALUE)}|[0-9]+ (?:{_any(_DOT_WORDS)}) [0-9])(?!\w)", re.IGNORECASE)
# Two neighbours of a row that may be rewritten, in lower case: a quick look at texts that have none.
_HINT = re.compile(
    rf"(?:{_any(_VALUE)}|[0-9])(?: (?:{_any(_DOT_WORDS)}) |(?<![0-9])(?:{_GAP}))(?:(?:{_any(_TIMES)}) )?(?:{_any(_VALUE)}|[0-9])"
)
_BRACKET_DOT = re.compile(r"(?<=[0-9])[ ]?[\[({]\s?(?:\.|dot|point|punkt|punto)\s?[\])}][ ]?(?=[0-9])", re.IGNORECASE)


def spelled_edits(text: str) -> list[Edit]:
    """Digits in words, three or more in a row of numbers: the words become digits and the gaps beside them go. A dot in
    words or brackets between numbers becomes a dot."""
    edits: list[Edit] = []
    if any(mark in text for mark in "[({"):
        edits = [(m.start(), m.end(), ".") for m in _BRACKET_DOT.finditer(text)]
    if _HINT.search(text.lower()) is None:
        return edits
    at = 0
    while (first := _SPELLED_WORD.search(text, at)) is not None:
        # A row may begin with numbers or a plus in front of its first word.
        row = _row_from(text, first.start(), at)
        if row is None:
            at = first.end()
            continue
        edits += _row_edits(row)
        at = row.end()
    edits.sort()
    return edits


_BEFORE = re.compile(r"(?:plus |\+ ?)?\(?(?:[0-9]+[ \t,.()-]{1,4})*\Z", re.IGNORECASE)
_MOST_BEFORE = 64  # a longer run of numbers in front of the first word is no identifier


def _row_from(text: str, word: int, free: int) -> re.Match[str] | None:
    low = max(free, word - _MOST_BEFORE)
    before = _BEFORE.search(text, low, word)
    return _ROW.match(text, before.start()) or _ROW.match(text, word)


def _row_edits(row: re.Match[str]) -> list[Edit]:
    parts = list(_ROW_PART.finditer(row.string, *row.span()))
    spelled = sum(p.lastgroup in ("word", "times") for p in parts)
    dots = sum(p.lastgroup == "dot" for p in parts)
    if spelled < _LEAST_SPELLED and not dots:
        return []
    edits: list[Edit] = []
    for k, p in enumerate(parts):
        if p["plus"]:
            edits.append((p.start(), p.end(), "+"))
        elif p["dot"]:
            edits.append((p.start(), p.end(), "."))
        elif p["word"] and spelled >= _LEAST_SPELLED:
            times = _TIMES[p["times"].lower()] if p["times"] else 1
            edits.append((p.start(), p.end(), _VALUE[p["word"].lower()] * times))
        elif p["gap"] and spelled >= _LEAST_SPELLED and (parts[k - 1]["word"] or parts[k + 1]["word"]):
            # Of a gap beside a word only a dot has a meaning.
            edits.append((p.start(), p.end(), "." if "." in p["gap"] else ""))
    return edits


# Words for the marks of a mail address by language, and what follows "at" in plain prose.
_AT_DOT = {"at": ("dot", "punkt"), "ät": ("dot", "punkt"), "arroba": ("punto",), "arobase": ("point",)}
_PROSE = frozenset("a an each every one that the this".split())
_AT = re.compile(
    rf"[ ]?[\[({{<][ ]?(?P<mark>@|{_any(_AT_DOT)})[ ]?[\])}}>][ ]?|[ ](?P<word>{_any(_AT_DOT)})[ ]|(?P<plain>@)", re.IGNORECASE
)
_DOTS = {
    word: re.compile(rf"[ ]?[\[({{<][ ]?(?:\.|{_any(_DOT_WORDS)})[ ]?[\])}}>][ ]?|[ ](?:{_any(dots)})[ ]|\.", re.IGNORECASE)
    for word, dots in {**_AT_DOT, "@": _DOT_WORDS}.items()
}
_LABEL = re.compile(r"[A-Za-z0-9-]++")
_TOLD = re.compile(r"[A-Za-z].*[0-9._]|[0-9._].*[A-Za-z]")
_TOP_LABEL = re.compile(r"[A-Za-z]{2,24}(?![A-Za-z0-9])")
_DOT_BEFORE = re.compile(r"(?:[ ]?[\[({<][ ]?(?:\.|dot)[ ]?[\])}>][ ]?|[ ]dot[ ])\Z", re.IGNORECASE)


def address_edits(text: str) -> list[Edit]:
    """The marks of mail addresses: "at" in brackets, or as a word if a "dot" in brackets or as a word follows in the
    domain, or if the name before it is none of prose and the domain ends as one; "dot" in brackets or as a word also
    where the at is plain."""
    edits: list[Edit] = []
    free = 0
    for at in _AT.finditer(text):
        if at.start() < free:
            continue
        start = at.start()
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        label = _LABEL.match(text, at.end())
        if start == at.start() or label is None:
            continue
        # A bracketed sign goes with the dots of any language, a word with its own.
        dots = _DOTS[(at["word"] or "@").lower()]
        found: list[Edit] = []
        disguised, end = 0, label.end()
        while (dot := dots.match(text, end)) and (label_after := _LABEL.match(text, dot.end())):
            if dot[0] != ".":
                # A word after a dot in words has to look like the end of a domain, or a dot follows it.
                if not _TOP_LABEL.match(text, dot.end()) and not dots.match(text, label_after.end()):
                    break
                disguised += 1
                found.append((dot.start(), dot.end(), "."))
            end = label_after.end()
        if end == label.end():
            continue
        if at["word"] and label[0].lower() in _PROSE:
            continue
        if at["word"] and not disguised:
            # As in "jo.5 at example.com": a name with a digit or mark, and a last label of letters before no sign.
            last = text.rfind(".", label.end(), end) + 1
            if not _TOLD.search(text[start : at.start()]) or not _TOP_LABEL.match(text, last) or text[end : end + 1] in ("@", "_"):
                continue
        if at["plain"] and (not disguised or text[label.end()] == "."):
            # With a plain sign and dot the address stands as it is; words after it are not its own.
            continue
        if not at["plain"]:
            # Dots in disguise on the left belong to the name.
            while (dot := _DOT_BEFORE.search(text, max(free, start - 12), start)) is not None:
                before = dot.start()
                while before > free and text[before - 1] in _LOCAL:
                    before -= 1
                if before == dot.start():
                    break
                edits.append((dot.start(), dot.end(), "."))
                start = before
            edits.append((at.start(), at.end(), "@"))
        edits += found
        free = end
    edits.sort()
    return edits


TRANSDUCERS: tuple[Callable[[str], list[Edit]], ...] = (alike_edits, numeral_edits, spelled_edits, address_edits)


def disguised_spans(text: str) -> list[tuple[int, int, int, str]]:
    """Identifiers of which the text holds a disguise only: start and end in the source, kind, and the identifier."""
    stages: list[Rewritten] = []
    for edits_of in TRANSDUCERS:
        edits = edits_of(text)
        if edits:
            stages.append(Rewritten(text, edits))
            text = stages[-1].text
    if not stages:
        return []
    out = []
    for start, end, kind in plain_spans(text):
        a, b, touched = start, end, False
        for stage in reversed(stages):
            touched = touched or stage.touched(a, b)
            a, b = stage.back(a, b)
        if touched:
            out.append((a, b, kind, text[start:end]))
    return out


def personal_spans(text: str) -> list[tuple[int, int, int, str, bool]]:
    """All identifiers by start, then kind, then end: start, end, kind, identifier, and whether it is disguised."""
    base = plain_spans(text)
    found = [(a, b, kind, text[a:b], False) for a, b, kind in base]
    for a, b, kind, value in disguised_spans(text):
        if not any(k == kind and x <= a and b <= y for x, y, k in _near(base, a)):
            found.append((a, b, kind, value, True))
    return sorted(found, key=lambda s: (s[0], s[2], s[1]))


def _near(base: list[Span], at: int) -> Iterator[Span]:
    """Base spans that begin at or before ``at`` and may reach it: the last few of each kind, as those of one kind do
    not overlap."""
    seen = 0
    for k in range(bisect_right(base, (at, 1 << 62, 9)) - 1, -1, -1):
        bit = 1 << base[k][2]
        if not seen & bit:
            seen |= bit
            yield base[k]
        if seen == 15:
            return


_SPANS = T.ArrayType(
    T.StructType(
        [
            T.StructField("start", T.IntegerType(), False),
            T.StructField("end", T.IntegerType(), False),
            T.StructField("kind", T.IntegerType(), False),
            T.StructField("value", T.StringType(), False),
            T.StructField("disguised", T.BooleanType(), False),
        ]
    ),
    False,
)


def find_personal(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add ``spans`` to every row: array of (start, end, kind, value, disguised) by start, then kind as in ``KINDS``.

    ``start`` and ``end`` count the code points of the source, also for identifiers in disguise, whose ``value`` is
    what the disguise stands for. Null and empty texts have no spans, an empty table gives one. Every row is judged for
    itself, so repeated rows each get their result. ``keep`` names the columns that stay (all of them if not given); a
    column of the name ``spans`` among them gives way (see ``free_name``).
    """
    ship_package(docs.sparkSession)
    fields = [f for f in docs.schema.fields if keep is None or f.name in keep]
    name = free_name(docs.select(*[f"`{f.name}`" for f in fields]), "spans")
    source = docs.columns.index(text)
    kept = [docs.columns.index(f.name) for f in fields]
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.bool_())

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, source):
            found = [personal_spans(t or "") for t in batch.column(source).to_pylist()]
            flat = [span for spans in found for span in spans]
            columns = [pa.array([s[k] for s in flat], kind) for k, kind in enumerate(kinds)]
            ends = reduce(lambda done, spans: done + [done[-1] + len(spans)], found, [0])
            values = pa.StructArray.from_arrays(columns, _SPANS.elementType.names)
            listed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in kept), listed], [str(k) for k in range(len(kept) + 1)])

    return map_arrow(docs, step, T.StructType([*fields, T.StructField(name, _SPANS)]))


def masked(docs: DataFrame, text: str = "text", mask: str = "[{}]") -> DataFrame:
    """The rows of ``docs`` with every identifier, plain or disguised, replaced by its kind in ``mask``; spans that
    overlap are replaced as one, by the kind of the first. Null texts stay null."""
    ship_package(docs.sparkSession)
    source = docs.columns.index(text)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, source):
            out = [None if t is None else _replaced(t, mask) for t in batch.column(source).to_pylist()]
            columns = list(batch.columns)
            columns[source] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return map_arrow(docs, step, docs.schema)


def _replaced(text: str, mask: str) -> str:
    pieces, at = [], 0
    for start, end, kind, _, _ in personal_spans(text):
        if start >= at:
            pieces += (text[at:start], mask.format(KINDS[kind]))
        at = max(at, end)
    return "".join([*pieces, text[at:]])


def _listed(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, the number of base spans of each kind, their digest, all spans and n_added of every document.

    Null and empty texts have none. Rows with a null doc_id and repeated rows each get their result; other columns
    are not read.
    """
    found = find_personal(docs.select("doc_id", "text"), keep=["doc_id"])
    base = F.filter("spans", lambda s: ~s["disguised"])
    count = lambda kind: F.size(F.filter("spans", lambda s: ~s["disguised"] & (s["kind"] == kind))).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["disguised"])).cast("long").alias("n_added"),
    )
