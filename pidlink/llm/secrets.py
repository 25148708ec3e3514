"""Secret scans: base rules, and zstandard novelty of strings in sensitive contexts.

*Base rules.* Assignments of long values to sensitive names, access key ids and long hexadecimal
runs, by their patterns.

*Novelty.* A candidate is a run of value characters that begins within REACH characters behind a
sensitive word, on its line. It is measured in marginal compressed bytes: the packed size of its
surroundings together with the candidate, less that of the surroundings alone, both by zstandard
primed with a dictionary trained on the identifiers that most documents use. Names, words and paths
repeat the dictionary or the text around them and cost little; keys and passwords cost about their
length. Candidates that cost at least NOVELTY bits a byte, single plain words aside, are reported
as spans of kind ``novel``. A span that touches a base span adds nothing; base spans always stay.

The identifiers are counted over all documents (a document counts an identifier once),
pre-aggregated in the tasks, and stored; the DICTIONARY_WORDS most frequent, of at most MAX_IDENTIFIER bytes
each, reach the driver, which trains a dictionary of at most DICTIONARY_BYTES that goes out with the
tasks. Texts stay where they are; a task holds one chunk of texts.

Defined results: a null or empty text has no spans; spans are in code points, end exclusive,
ordered by start, then by kind in the order of KINDS; repeated rows give repeated results; an empty
table gives no rows (and an empty dictionary); other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache, partial

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pidlink.llm.common import pieces, stored

KINDS = ("assign", "access", "hex", "novel")
BASE = KINDS[:3]
CHUNK_BYTES = 2 << 20
DICTIONARY_WORDS, DICTIONARY_BYTES = 4096, 32 << 10
#: The dictionary is trained on so many samples, into which the identifiers are dealt by rank.
SAMPLES = 128
MIN_IDENTIFIER, MAX_IDENTIFIER = 5, 32
COUNTED_TERMS = 200_000
#: Characters of the text on either side of a candidate that its cost is measured against.
AROUND = 256
#: How far behind a sensitive word a candidate may begin.
REACH = 48
MIN_CANDIDATE, MAX_PROBE = 10, 128
LEVEL = 19
#: Marginal compressed bits a character from which on a candidate is reported.
NOVELTY = 6.0

Span = tuple[str, int, int]


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key")))
_ASSIGN = re.compile(rf"(?:{_NAMES})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
#: Sensitive words that call for a look at what follows them, as whole words or parts of names.
SENSITIVE = ("password", "passwd", "passphrase", "passcode", "pwd", "secret", "token", "api_key", "apikey", "api-key", "access_key",
             "private_key", "client_key", "auth", "bearer", "credential", "signature", "signing_key")
_CONTEXT = re.compile("|".join(map(_either_case, SENSITIVE)))
#: Every name and sensitive word holds one of these; most texts hold none.
_STEMS = ("pass", "pwd", "secret", "token", "api", "key", "auth", "bearer", "credential", "signature")
_CANDIDATE = re.compile(rf"[A-Za-z0-9+/_.~!@#$%^&*-][A-Za-z0-9+/_.=~!@#$%^&*-]{{{MIN_CANDIDATE - 1},}}")
_IDENTIFIER = re.compile(rb"[A-Za-z_][A-Za-z0-9_]{%d,%d}" % (MIN_IDENTIFIER - 1, MAX_IDENTIFIER - 1))
_PLAIN = re.compile(r"[A-Za-z]?[a-z]*")


def _may_be_sensitive(text: str) -> bool:
    low = text.lower()
    return any(stem in low for stem in _STEMS)


def detect(text: str) -> list[Span]:
    """Spans of the base rules."""
    out: list[Span] = []
    if _may_be_sensitive(text):
        out += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 8]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return in_order(out)


def in_order(spans: Iterable[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def candidates(text: str) -> Iterator[tuple[int, int]]:
    """Runs of value characters that begin within REACH characters behind a sensitive word, on its
    line, each once."""
    done = 0
    for m in _CONTEXT.finditer(text):
        stop = text.find("\n", m.end(), m.end() + REACH)
        stop = min(m.end() + REACH, len(text)) if stop < 0 else stop
        at = max(done, m.end())
        # the rest of a name such as token_value is no value
        while at < stop and (text[at].isalnum() or text[at] in "_-"):
            at += 1
        while at < stop and (found := _CANDIDATE.search(text, at, stop + MIN_CANDIDATE - 1)):
            a, done = found.start(), _CANDIDATE.match(text, found.start()).end()
            yield a, done
            at = done


def uncovered(found: Iterable[tuple[int, int]], base: list[Span]) -> Iterator[tuple[int, int]]:
    """Those of ``found`` (by start, disjoint) that no span of ``base`` (by start) touches."""
    spans, reach, held = iter(base), 0, None
    for a, b in found:
        while True:
            held = held or next(spans, None)
            if held is None or held[1] >= b:
                break
            reach, held = max(reach, held[2]), None
        if reach <= a:
            yield a, b


class Novelty:
    """Marginal cost of a string in zstandard primed with a dictionary."""

    def __init__(self, dictionary: bytes):
        primer = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        if primer:
            primer.precompute_compress(level=LEVEL)
        self.packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=primer, write_checksum=False, write_content_size=False, write_dict_id=False)

    def bits(self, text: str, start: int, end: int) -> float:
        """Marginal bits a byte of ``text[start:end]`` against the text around it, in which no other
        copy of it is left. Of a longer string, the costliest stretch of MAX_PROBE characters counts."""
        return max(self._bits(text, a, min(end, a + MAX_PROBE)) for a in range(start, end, MAX_PROBE)
                   if a == start or end - a >= MIN_CANDIDATE)

    def _bits(self, text: str, start: int, end: int) -> float:
        value = text[start:end]
        before = text[max(0, start - AROUND):start].replace(value, "")
        after = text[end:end + AROUND].replace(value, "")
        around = (after + "\n" + before).encode()
        probe = value.encode()
        alone, together = len(self.packer.compress(around)), len(self.packer.compress(around + probe))
        return 8 * max(0, together - alone) / len(probe)


@lru_cache(maxsize=2)
def novelty(dictionary: bytes) -> Novelty:
    return Novelty(dictionary)


def find(text: str | None, dictionary: bytes = b"") -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans."""
    if not text:
        return [], []
    base = detect(text)
    more: list[Span] = []
    for a, b in uncovered(candidates(text) if _may_be_sensitive(text) else (), base):
        if not _PLAIN.fullmatch(text, a, b) and novelty(dictionary).bits(text, a, b) >= NOVELTY:
            more.append(("novel", a, b))
    return base, in_order([*base, *more])


def count_identifiers(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def taken() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "docs"])
        counts.clear()
        return batch

    for batch in pieces(batches, "text", CHUNK_BYTES, 4096):
        for text in batch.column("text").cast(pa.binary()).to_pylist():
            if text:
                counts.update(set(_IDENTIFIER.findall(text)))
            if len(counts) >= COUNTED_TERMS:
                yield taken()
    if counts:
        yield taken()


def trained(identifiers: list[bytes]) -> bytes:
    """A zstandard dictionary of identifiers, the most frequent first; too few of them to train on
    are taken as they are, the most frequent last, where zstandard reaches most cheaply."""
    samples = [b" ".join(identifiers[i::SAMPLES]) for i in range(SAMPLES)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL, k=64, d=6).as_bytes()
    except zstandard.ZstdError:
        return b" ".join(reversed(identifiers))


def identifier_dictionary(docs: DataFrame, words: int = DICTIONARY_WORDS) -> bytes:
    """A dictionary of the identifiers that most documents hold; ties go by the bytes.

    The counts are stored; the numbers of identifiers per power of two of their count tell from
    which power on there are enough, and only those are sorted and collected."""
    counted = docs.select("text").mapInArrow(count_identifiers, "word binary, docs long").groupBy("word").agg(F.sum("docs").alias("docs"))
    counted = stored(counted.filter("docs > 1"), "identifiers")
    level, least = F.floor(F.log2("docs")).cast("int"), 0
    held = 0
    for r in sorted(counted.groupBy(level.alias("level")).count().collect(), reverse=True):  # at most 63 rows
        least, held = r["level"], held + r["count"]
        if held >= words:
            break
    top = counted.filter(level >= least).orderBy(F.desc("docs"), "word").limit(words).collect()
    return trained([bytes(r["word"]) for r in top])


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
SPANS = "array<struct<kind:string,start:int,end:int>>"


def find_batches(batches: Iterable[pa.RecordBatch], dictionary: bytes) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text", CHUNK_BYTES, 4096):
        found = [find(t, dictionary) for t in batch.column("text").to_pylist()]
        lists = [pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in f[i]] for f in found], _SPANS) for i in (0, 1)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *lists], ["doc_id", "base", "spans"])


def secret_spans(docs: DataFrame, dictionary: bytes | None = None) -> DataFrame:
    """One row per document: doc_id, base and spans, arrays of (kind, start, end). Without a
    ``dictionary``, that of the documents' own identifiers is taken."""
    primer = identifier_dictionary(docs) if dictionary is None else dictionary
    kind = docs.schema["doc_id"].dataType.simpleString()
    scan = partial(find_batches, dictionary=primer)
    return docs.select("doc_id", "text").mapInArrow(scan, f"doc_id {kind}, base {SPANS}, spans {SPANS}")
