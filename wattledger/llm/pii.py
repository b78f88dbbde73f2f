"""Personal data by offset-preserving deobfuscation.

A text is normalised by transducers that record where each character came from: look-alike letters and digits become
ASCII, spelled-out digits become digits, at and dot in disguise become @ and full stop. Identifiers are detected in the
text as it stands (the base spans) and in the normalised text; spans found only in the latter are mapped back.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

KINDS = ("email", "ip", "card", "phone")

# The patterns of the contract. Possessive forms change no match and stay linear.
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = ord(d) - 48
        if i % 2:
            v = v * 2 - 9 * (v > 4)
        total += v
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        # The leftmost match that reaches this @ starts at the first character of the run before it, after the
        # match before; the run cannot hold an @.
        start = at
        while start > end and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = DOMAIN.match(text, at) if start < at else None
        if m:
            out.append((start, m.end()))
            end = m.end()
        at = text.find("@", max(at + 1, end))
    return out


def detect(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of identifiers, leftmost and without overlap in each kind; kind as index into KINDS."""
    out = [(s, 0, e) for s, e in _emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                out.append((m.start(), 3, m.end()))
    out.sort()
    return out


# Look-alikes of ASCII letters, and digits and signs of other forms, one character for one.
_ALIKE = {}
for _alike, _plain in (
    ("АВЕЅЗІЈКМНОРСТУХаеіјорсухѕһԁԛԝ", "ABES3IJKMHOPCTYXaeijopcyxshdqw"),  # Cyrillic
    ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧονρ", "ABEZHIKMNOPTYXovp"),  # Greek
    ("＠．－＋（）﹒﹫․‐‑‒–−。", "@.-+().@.-----."),
):
    _ALIKE |= dict(zip(map(ord, _alike), _plain, strict=True))
for _first in (0xFF10, 0x0660, 0x06F0, 0x0966, *range(0x1D7CE, 0x1D7FF, 10)):  # full-width and other decimal digits
    _ALIKE |= {_first + i: chr(48 + i) for i in range(10)}
for _first, _to in ((0xFF21, 65), (0xFF41, 97)):
    _ALIKE |= {_first + i: chr(_to + i) for i in range(26)}
_ALIKE_PATTERN = re.compile("[" + "".join(map(re.escape, map(chr, sorted(_ALIKE)))) + "]")

_OPEN, _CLOSE = r"[\[({<]", r"[\])}>]"
_WRAPPED = re.compile(rf"\s?{_OPEN}\s?(?i:(at|@|arroba|chez)|(dot|punkt|punto|point|\.)|(plus|\+))\s?{_CLOSE}\s?")
#: An address whose @ and full stops may each be spelled; bracketed ones are signs by then.
_BARE_AT, _BARE_DOT = re.compile(r"(?i)\s(?:at|arroba)\s"), re.compile(r"(?i)\s(?:dot|punkt|punto)\s")
_MIXED_AT, _MIXED_DOT = rf"(?:@|{_BARE_AT.pattern[4:]})", rf"(?:\.|{_BARE_DOT.pattern[4:]})"
_SPELLED_MAIL = re.compile(rf"(?i)(?<![\w.%+-])[\w.%+-]++{_MIXED_AT}[\w-]++(?:{_MIXED_DOT}[\w-]++)++")
#: Finds the texts with such an address, lower case.
_MAIL_HINT = re.compile(rf"(?:{_BARE_AT.pattern[4:]}[\w-]++{_MIXED_DOT}|@[\w.-]++{_BARE_DOT.pattern[4:]})[\w-]")
#: End of a domain that is believed after a bare "at" without any disguised full stop.
_PLAIN_TOP = re.compile(r"\.(?:[a-z]{2,24}|[A-Z]{2,24})\Z")

# Digits by name, also in the other languages of the tables.
DIGIT_NAMES = {
    name: str(digit)
    for digit, names in enumerate(
        (
            "zero null cero zéro oh",
            "one eins uno un",
            "two zwei dos deux",
            "three drei tres trois",
            "four vier cuatro quatre",
            "five fünf cinco cinq",
            "six sechs seis",
            "seven sieben siete sept",
            "eight acht ocho huit",
            "nine neun nueve neuf",
        )
    )
    for name in names.split()
}
_NAME = "(?:" + "|".join(sorted(DIGIT_NAMES, key=len, reverse=True)) + ")"
_DIGIT = rf"(?:{_NAME}|[0-9])"
#: A run of at least four digit names and numbers, of which one is a name; shorter runs are words of ordinary text.
_SPELLED = re.compile(rf"(?i)(?<!\w){_DIGIT}++(?!\w)(?:[\x20,.-]{{1,2}}{_DIGIT}++(?!\w)){{3,}}")
#: Finds the texts with neighbours of such a run: lower case, and each name looks back for a letter itself, which scans
#: fast.
_SPELLED_HINT = re.compile(
    "(?:" + "|".join(rf"{n}(?<!\w{n})" for n in DIGIT_NAMES) + rf")[\x20,.-]{{1,2}}{_DIGIT}++(?!\w)"
    rf"|[0-9][\x20,.-]{{1,2}}{_NAME}"
)
_PLUS = re.compile(r"(?i)(?<!\w)plus[\x20-]?(?=[0-9])")
_ONE_NAME = re.compile(rf"(?i){_NAME}")


class Traced:
    """A text with the source offset of each of its characters; rewriting keeps both in step."""

    def __init__(self, text: str):
        self.text, self.at = text, None  # None: every character stands where it stood

    def rewrite(self, pattern: re.Pattern, to) -> None:
        matches = [(m.start(), m.end(), to(m)) for m in pattern.finditer(self.text)]
        matches = [m for m in matches if m[2] is not None]
        if not matches:
            return
        at = self.at or [(i, i + 1) for i in range(len(self.text))]
        parts, spans, last = [], [], 0
        for start, end, new in matches:
            parts += [self.text[last:start], new]
            spans += at[last:start]
            spans += [(at[start][0], at[end - 1][1])] * len(new)
            last = end
        self.text = "".join([*parts, self.text[last:]])
        self.at = spans + at[last:]

    def source(self, start: int, end: int) -> tuple[int, int]:
        return (self.at[start][0], self.at[end - 1][1]) if self.at else (start, end)


def _plain_mail(m: re.Match) -> str | None:
    """The address in signs; None where it stands in signs, or where "at" and a full stop are plain prose."""
    dotted = _BARE_DOT.sub(".", m[0])
    plain = _BARE_AT.sub("@", dotted, count=1)
    if plain == m[0] or (dotted == m[0] and not _PLAIN_TOP.search(plain)):
        return None
    return plain


def _digits(m: re.Match) -> str | None:
    named = _ONE_NAME.sub(lambda n: DIGIT_NAMES[n[0].lower()], m[0])
    return None if named == m[0] else re.sub(r"[\x20,]+", "", named)


def normalise(text: str) -> Traced:
    out = Traced(text)
    if not text.isascii() and _ALIKE_PATTERN.search(text):
        out.text = text.translate(_ALIKE)  # one for one, so offsets stay
    low = out.text.lower()  # only looked at for hints
    if any(c in low for c in "[({<"):
        out.rewrite(_WRAPPED, lambda m: "@" if m[1] else "." if m[2] else "+")
        low = out.text.lower()
    if _MAIL_HINT.search(low):
        out.rewrite(_SPELLED_MAIL, _plain_mail)
    if _SPELLED_HINT.search(low):
        out.rewrite(_SPELLED, _digits)
    if "plus" in low:
        out.rewrite(_PLUS, lambda m: "+")
    return out


def find(text: str | None) -> tuple[list, list]:
    """(base, all) spans as (start, kind, end).

    An added span overlaps no other added one, and a base span only if it holds the whole of it and more: a disguise
    may leave a fragment that the patterns take for an identifier.
    """
    text = text or ""
    base = detect(text)
    plain = normalise(text)
    if plain.text == text:
        return base, base
    blocks, last = ([], []), 0  # base spans joined where they overlap, in order
    for start, _, end in base:
        if blocks[1] and start < last:
            blocks[1][-1] = last = max(last, end)
        else:
            blocks[0].append(start)
            blocks[1].append(end)
            last = end
    extents = {(start, end) for start, _, end in base}
    starts, ends, added = [], [], []
    for start, kind, end in detect(plain.text):
        s, e = plain.source(start, end)
        # A rewritten disguise may take up white space around it.
        while s < e and text[s].isspace():
            s += 1
        while e > s and text[e - 1].isspace():
            e -= 1
        first, after = bisect_right(blocks[1], s), bisect_left(blocks[0], e)
        held = list(zip(blocks[0][first:after], blocks[1][first:after]))
        if (s, e) in extents or any(x < s or y > e for x, y in held):
            continue
        # One digit name beside a whole identifier is a word of the sentence.
        if len(held) == 1 and (text[s : held[0][0]] + text[held[0][1] : e]).strip(" ,.-").lower() in DIGIT_NAMES:
            continue
        i = bisect_right(ends, s)
        if i == len(starts) or e <= starts[i]:
            added.append((s, kind, e))
            starts.insert(i, s)
            ends.insert(i, e)
    return base, sorted(base + added)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


FOUND = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def personal_data(docs: DataFrame) -> DataFrame:
    """One row per document: base counts by kind, digest of the base spans, and all spans.

    Null and empty texts have no spans. Nothing is shuffled. Offsets are code points, ends exclusive.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [find(t) for t in batch.column(1).to_pylist()]
            kinds = [[sum(k == kind for _, k, _ in base) for base, _ in found] for kind in range(4)]
            digests = [hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in found]
            columns = [batch.column(0), *(pa.array(k, pa.int64()) for k in kinds)]
            columns += [pa.array(digests, pa.string()), pa.array([joined(s) for _, s in found], pa.string())]
            yield pa.record_batch(columns, names=[c.split()[0] for c in FOUND.split(", ")])

    return docs.selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(run, FOUND)


def redact(docs: DataFrame, column: str = "redacted") -> DataFrame:
    """Documents with every span of `text` replaced by its kind in angle brackets, in `column`."""
    from pyspark.sql import functions as F

    def run(texts):
        def one(text):
            if text is None:
                return None
            _, spans = find(text)
            out, last = [], 0
            for s, k, e in spans:
                if s >= last:
                    out += [text[last:s], f"<{KINDS[k]}>"]
                last = max(last, e)
            return "".join([*out, text[last:]])

        return texts.map(one)

    from pandas import Series

    run.__annotations__ = {"texts": Series, "return": Series}
    return docs.withColumn(column, F.pandas_udf(run, "string")("text"))
