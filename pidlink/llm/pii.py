"""Personal data: offset-preserving deobfuscation, then detection.

The base rules run on the source text. Then transducers rewrite disguises - look-alike and
full-width characters, invisible characters, digits spelled as words, "at" and "dot" written
out - and keep, for every character they emit, the source characters it stands for. The same
rules run on the rewritten text, and what they find is mapped back to the source. A span that
touches a base span of its kind adds nothing; base spans always stay.

Everything is a function of one text, so texts stay where they are; a task holds one chunk.

Defined results: a null or empty text has no spans; spans are in code points of the source,
end exclusive, ordered by start, then by kind in the order of KINDS.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pidlink.llm.common import pieces

KINDS = ("email", "ip", "card", "phone")
CHUNK_BYTES = 2 << 20

Span = tuple[str, int, int]

_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# No match can begin inside a run of digits, and no start is tried there: a long run is read once.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def _valid_card(found: str) -> bool:
    digits = found.replace(" ", "").replace("-", "")
    return 14 <= len(digits) <= 19 and luhn(digits)


def _valid_ip(found: str) -> bool:
    return all(len(p) <= 3 and int(p or "0") <= 255 for p in (g.lstrip("0") for g in found.split(".")))


def _valid_phone(found: str) -> bool:
    return 10 <= len(_DIGIT.findall(found)) <= 15


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the email rule. Only runs that end in an @ are tried, which finds the same
    leftmost matches without starting at every letter."""
    done, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in _LOCAL:
            begin -= 1
        m = _EMAIL.match(text, begin) if begin < at else None
        if m:
            yield m.span()
            done = m.end()
        else:
            done = at + 1
        at = text.find("@", max(at + 1, done))


_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def detect(text: str) -> list[Span]:
    """Spans of the base rules."""
    out: list[Span] = [("email", a, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        for kind, rule, valid in (("ip", _IP, _valid_ip), ("card", _CARD, _valid_card), ("phone", _PHONE, _valid_phone)):
            out += [(kind, *m.span()) for m in rule.finditer(text) if valid(m.group())]
    return in_order(out)


def in_order(spans: Iterable[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


class Aligned:
    """A rewritten text; character i stands for source characters start[i] .. end[i]-1."""

    def __init__(self, text: str, start: np.ndarray | None = None, end: np.ndarray | None = None):
        self.text = text
        self.start = np.arange(len(text)) if start is None else start
        self.end = np.arange(1, len(text) + 1) if end is None else end

    def rewrite(self, pattern: re.Pattern, emit: Callable[[re.Match], str]) -> Aligned:
        """Replace every match; all that a match emits stands for all of the match."""
        texts, starts, ends, done = [], [], [], 0
        for m in pattern.finditer(self.text):
            a, b = m.span()
            new = emit(m)
            texts += [self.text[done:a], new]
            starts += [self.start[done:a], np.full(len(new), self.start[a])]
            ends += [self.end[done:a], np.full(len(new), self.end[b - 1])]
            done = b
        if not texts:
            return self
        return Aligned("".join([*texts, self.text[done:]]), np.concatenate([*starts, self.start[done:]]),
                       np.concatenate([*ends, self.end[done:]]))

    def translated(self, table: dict[str, str]) -> Aligned:
        """Replace single characters by one character or by nothing; the others keep their places."""
        text = self.text.translate({ord(c): new for c, new in table.items()})
        gone = {c for c, new in table.items() if not new}
        if len(text) == len(self.text):
            return Aligned(text, self.start, self.end)
        codes = np.frombuffer(self.text.encode("utf-32-le", "surrogatepass"), np.uint32)
        stays = ~np.isin(codes, np.array([ord(c) for c in gone], np.uint32))
        return Aligned(text, self.start[stays], self.end[stays])

    def source(self, a: int, b: int) -> tuple[int, int]:
        return int(self.start[a]), int(self.end[b - 1])


#: Fixed value: letters of other scripts that look like ASCII letters.
LOOK_ALIKES = {
    "а": "a", "в": "b", "с": "c", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "о": "o", "р": "p",
    "ԛ": "q", "ѕ": "s", "т": "t", "у": "y", "ѵ": "v", "ԝ": "w", "х": "x", "ԁ": "d", "ɡ": "g", "ո": "n", "ʟ": "l",
    "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O", "Р": "P",
    "Ѕ": "S", "Т": "T", "У": "Y", "Х": "X", "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p",
    "τ": "t", "υ": "u", "χ": "x", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M",
    "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "ı": "i", "․": ".", "。": ".", "‐": "-", "‑": "-",
    "–": "-", "−": "-", "\u00a0": " ", "\u2009": " ", "\u202f": " ",
}
#: Fixed value: characters that show nothing.
INVISIBLE = "\u00ad\u200b\u200c\u200d\u2060\ufeff"
#: Fixed value: the digits as words.
DIGIT_WORDS = ("zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine")


@lru_cache(maxsize=1)
def glyphs() -> dict[str, str]:
    """Every character that is read as an ASCII one: full-width and mathematical forms and
    decimal digits of all scripts by Unicode's own tables, look-alikes, nothing if invisible."""
    found = dict.fromkeys(INVISIBLE, "") | LOOK_ALIKES
    for code in (*range(0x0660, 0x1E960), *range(0xFF01, 0xFF5F)):
        c = chr(code)
        if unicodedata.category(c) == "Nd":
            found.setdefault(c, str(unicodedata.digit(c)))
        elif 0x1D400 <= code < 0x1D800 or code >= 0xFF01:
            plain = unicodedata.normalize("NFKC", c)
            if len(plain) == 1 and plain.isascii():
                found.setdefault(c, plain)
    return found


#: What can hold such a character at all (a cheap test for the common alphabets).
_FOREIGN = re.compile("[\u00a0\u00ad\u0131\u0261\u029f\u0300-\U0010ffff]")


_DIGIT_WORD = "(?:" + "|".join(DIGIT_WORDS) + ")"
_SPELLED = re.compile(rf"\b{_DIGIT_WORD}(?:(?:[ \t,-]+|[ \t]+(?:dot|point)[ \t]+){_DIGIT_WORD})+\b", re.I)
_WORD = re.compile(r"[a-z]+", re.I)
_PLUS = re.compile(r"\bplus[ \t]+(?=[0-9])", re.I)
_DIGIT_DOT = re.compile(r"(?<=[0-9])(?:[ \t]+(?:dot|point)[ \t]+|[ \t]*[(\[{](?:dot|point)[)\]}][ \t]*)(?=[0-9])", re.I)
# the blanks before a sign are taken from the start of their run only, so a run is read once
_BRACKET_AT = re.compile(r"(?:(?<![ \t])[ \t]+)?[(\[{<][ \t]*(?:at|@)[ \t]*[)\]}>][ \t]*", re.I)
_BRACKET_DOT = re.compile(r"(?:(?<![ \t])[ \t]+)?[(\[{<][ \t]*(?:dot|\.)[ \t]*[)\]}>][ \t]*", re.I)
_SAID = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+(?:[ \t]+at[ \t]+|@)[A-Za-z0-9-]+(?:(?:[ \t]+dot[ \t]+|\.)[A-Za-z0-9-]+)*"
                   r"[ \t]+dot[ \t]+[A-Za-z0-9-]+(?:(?:[ \t]+dot[ \t]+|\.)[A-Za-z0-9-]+)*", re.I)
_SAID_SIGN = re.compile(r"(?<![ \t])[ \t]+(at|dot)[ \t]+", re.I)
# cheap tests of the lower-cased text: without a hit the rewriting below can match nothing
_MAY_SPELL = re.compile(rf"{_DIGIT_WORD}(?:[ \t,-]|[ \t]+(?:dot|point)[ \t]){{1,2}}[ \t,-]*{_DIGIT_WORD}")
_MAY_BRACKET = re.compile(r"[(\[{<][ \t]*(?:at|@|dot|point|\.)[ \t]*[)\]}>]")


def _digits(m: re.Match) -> str:
    words = [w.lower() for w in _WORD.findall(m.group())]
    return "".join(str(DIGIT_WORDS.index(w)) if w in DIGIT_WORDS else "." for w in words)


def deobfuscated(text: str) -> Aligned | None:
    """The text with its disguises undone, or None if it has none."""
    t = first = Aligned(text)
    if _FOREIGN.search(text) and (present := glyphs().keys() & set(text)):
        t = t.translated({c: glyphs()[c] for c in present})
    low = t.text.lower()
    if _MAY_SPELL.search(low):
        spelled = t.rewrite(_SPELLED, _digits)
        if spelled is not t:
            t = spelled.rewrite(_PLUS, lambda m: "+")
    if "dot" in low or "point" in low or _MAY_BRACKET.search(low):
        t = t.rewrite(_DIGIT_DOT, lambda m: ".")
        t = t.rewrite(_BRACKET_AT, lambda m: "@").rewrite(_BRACKET_DOT, lambda m: ".")
        # "name at host dot top": the signs inside such a phrase only
        said = [m.span() for m in _SAID.finditer(t.text)]
        if said:
            inside = np.zeros(len(t.text) + 1, bool)
            for a, b in said:
                inside[a:b] = True
            t = t.rewrite(_SAID_SIGN, lambda m: ("@" if m.group(1).lower() == "at" else ".") if inside[m.start()] and inside[m.end() - 1]
                          else m.group())
    return None if t is first else t


def find(text: str | None) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans."""
    if not text:
        return [], []
    base = detect(text)
    other = deobfuscated(text)
    if other is None:
        return base, base
    more: list[Span] = []
    found = detect(other.text)
    for kind in KINDS:
        # spans of one kind are disjoint and in order, on both sides
        mine = [(a, b) for k, a, b in base if k == kind]
        starts, reach = [a for a, _ in mine], 0
        for a, b in (other.source(a, b) for k, a, b in found if k == kind):
            i = bisect_left(starts, b)
            if a >= reach and not (i and mine[i - 1][1] > a):
                more.append((kind, a, b))
                reach = b
    return base, in_order([*base, *more])


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
SPANS = "array<struct<kind:string,start:int,end:int>>"


def find_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text", CHUNK_BYTES, 4096):
        found = [find(t) for t in batch.column("text").to_pylist()]
        lists = [pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in f[i]] for f in found], _SPANS) for i in (0, 1)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *lists], ["doc_id", "base", "spans"])


def personal_data(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, base and spans, arrays of (kind, start, end)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(find_batches, f"doc_id {kind}, base {SPANS}, spans {SPANS}")
