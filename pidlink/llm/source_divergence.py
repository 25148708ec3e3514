"""Source divergence audit: how far the term distributions of the sources of a language differ.

*Indexing.* One pass over the texts. A task counts terms per (lang, source) in memory until the
block holds BLOCK_POSTINGS postings (or its texts end), then spills the block as a run: postings
(term, source, occurrences, documents) sorted by term, cut into chunks of CHUNK postings, each
under its term's hash shard. The shuffle brings a shard's chunks together in the order of their
first terms; a heap merges them, holding at most one chunk of each run, and a term's postings
leave it summed, if the term stands in enough documents of the language.

*Probabilities.* ``p = 1 + floor(SCALE * (count + SMOOTH) / (N + SMOOTH * V))`` per group, in exact
integers (three decimal digits at a time, so that no product leaves a long).

*Pairs.* The distance of two sources is the sum of |p - q| over all V terms. Most terms are
missing from most sources, where p is the group's least value p0, so it is assembled from

    V * |p0 - q0|  +  A(p, q0)  +  A(q, p0)  +  C

A(p, x) corrects it for the terms the one source has (from the group's histogram of p values); C
corrects it once more for the terms both have, streamed term by term from the postings and summed
per pair inside the task before anything is shuffled.

Defined results: null text, lang and source count as ''; a document is a row, repeated rows count
repeatedly; a group without kept terms still stands in every pair; a language without kept terms
has distances 0 and no term rows; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import partial
from heapq import heappop, heappush
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pidlink.llm.common import pieces, stored

MIN_DOCS = 30
SMOOTH = 5
TOP_TERMS = 50
BLOCK_POSTINGS = 400_000
CHUNK = 256
CHUNK_BYTES = 2 << 20
#: A long text is counted in parts of about this size, cut between terms.
PART_BYTES = 1 << 20
PAIR_ENTRIES = 1 << 20

#: ASCII letters and all code points above ASCII, as UTF-8 bytes; bytes.lower() lowers A-Z alone.
_TERM = re.compile(rb"[a-z\x80-\xff]+")
_GAP = re.compile(rb"[^A-Za-z\x80-\xff]")

#: A chunk of a run: its terms joined by blanks (no term holds one), the names of its sources, and
#: per posting the number of the source (int32), occurrences and documents (int64), packed.
RUN = pa.schema([("shard", pa.int32()), ("lang", pa.string()), ("first", pa.binary()), ("terms", pa.binary()), ("names", pa.list_(pa.string())),
                 ("source", pa.binary()), ("count", pa.binary()), ("docs", pa.binary())])
RUN_DDL = "shard int, lang string, first binary, terms binary, names array<string>, source binary, count binary, docs binary"


def text_parts(text: bytes) -> Iterator[bytes]:
    start = 0
    while len(text) - start > PART_BYTES:
        gap = _GAP.search(text, start + PART_BYTES)
        if not gap:
            break
        yield text[start:gap.start()]
        start = gap.end()
    yield text[start:]


def _spilled(block: dict, shards: int) -> Iterator[pa.RecordBatch]:
    """The postings of a block as chunks of one term-sorted run, a language at a time."""
    by_lang: dict[str, list] = {}
    for (lang, source), counted in block.items():
        by_lang.setdefault(lang, []).append((source, *counted))
    for lang, groups in by_lang.items():
        group = np.repeat(np.arange(len(groups)), [len(count) for _, count, _ in groups])
        terms = [t for _, count, _ in groups for t in count]
        if not terms:
            continue
        shard = np.fromiter(map(crc32, terms), np.int64, len(terms)) % shards
        count = np.fromiter((n for _, c, _ in groups for n in c.values()), np.int64, len(terms))
        docs = np.fromiter((d[t] for _, c, d in groups for t in c), np.int64, len(terms))
        term = pa.array(terms, pa.binary())
        del terms
        order = pc.sort_indices(term).to_numpy()
        order = order[np.argsort(shard[order], kind="stable")]
        terms = term.take(pa.array(order)).to_pylist()
        shard, group, count, docs = shard[order], group[order], count[order], docs[order]
        # a chunk ends with its shard, or is full
        begins = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]])
        within = np.arange(len(order)) - np.repeat(begins, np.diff(np.r_[begins, len(order)]))
        ends = [*np.flatnonzero(within % CHUNK == 0).tolist(), len(order)]
        rows = []
        for a, b in zip(ends, ends[1:]):
            present, number = np.unique(group[a:b], return_inverse=True)
            rows.append((int(shard[a]), lang, terms[a], b" ".join(terms[a:b]), [groups[i][0] for i in present],
                         number.astype("<i4").tobytes(), count[a:b].astype("<i8").tobytes(), docs[a:b].astype("<i8").tobytes()))
            if len(rows) == 256 or b == len(order):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), RUN)], schema=RUN)
                rows = []


def block_runs(batches: Iterable[pa.RecordBatch], shards: int, postings: int) -> Iterator[pa.RecordBatch]:
    block: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    held = 0
    for batch in pieces(batches, "text", CHUNK_BYTES, 4096):
        columns = (batch.column("lang").to_pylist(), batch.column("source").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist())
        for lang, source, text in zip(*columns):
            if (lang, source) not in block:
                block[lang, source] = Counter(), Counter()
                held += 4  # an empty group takes the room of some postings
            count, docs = block[lang, source]
            held -= len(count)
            seen: set[bytes] = set()
            for part in text_parts(text):
                terms = _TERM.findall(part.lower())
                count.update(terms)
                seen.update(terms)
            docs.update(seen)
            held += len(count)
            if held >= postings:
                yield from _spilled(block, shards)
                block, held = {}, 0
    yield from _spilled(block, shards)


FREQUENCY = pa.schema([("lang", pa.string()), ("term", pa.string()), ("source", pa.string()), ("count", pa.int64()),
                       ("lang_count", pa.int64()), ("leads", pa.bool_())])
FREQUENCY_DDL = "lang string, term string, source string, count long, lang_count long, leads boolean"


class RunMerge:
    """Heap merge of chunks that arrive in the order of their first terms, within one language.
    The heap holds open chunks by their next term."""

    def __init__(self, min_docs: int):
        self.min_docs = min_docs
        self.heap: list = []
        self.lang, self.arrived = "", 0

    def add(self, terms: bytes, names: list[str], source: bytes, count: bytes, docs: bytes) -> None:
        """A chunk, as it comes in a run."""
        words = terms.split(b" ")
        columns = (pa.array(names, pa.string()).take(pa.array(np.frombuffer(source, "<i4"))),
                   pa.array(np.frombuffer(count, "<i8")), pa.array(np.frombuffer(docs, "<i8")))
        self.arrived += 1
        heappush(self.heap, (words[0], self.arrived, 0, words, columns))

    def advance(self, limit: bytes | None) -> Iterator[pa.RecordBatch]:
        """Take the postings of all terms below ``limit`` (of all terms, without one) off the open
        chunks, and sum them."""
        heap, parts = self.heap, []
        while heap and (limit is None or heap[0][0] < limit):
            _, order, at, terms, columns = heappop(heap)
            end = len(terms) if limit is None else bisect_left(terms, limit, at)
            parts.append([pa.array(terms[at:end], pa.binary()), *(c.slice(at, end - at) for c in columns)])
            if end < len(terms):
                heappush(heap, (terms[end], order, end, terms, columns))
        if parts:
            postings = pa.table([pa.concat_arrays(c) for c in zip(*parts)], ["term", "source", "count", "docs"])
            whole = postings.group_by("term").aggregate([("docs", "sum"), ("count", "sum")])
            whole = whole.filter(pc.greater_equal(whole["docs_sum"], self.min_docs))
            if whole.num_rows:
                yield self._kept(postings.filter(pc.is_in(postings["term"], whole["term"])), whole)

    def _kept(self, postings: pa.Table, whole: pa.Table) -> pa.RecordBatch:
        rows = postings.group_by(["term", "source"]).aggregate([("count", "sum")]).combine_chunks()
        at = pc.index_in(rows["term"], whole["term"])
        leads = np.zeros(rows.num_rows, bool)
        leads[np.unique(at.to_numpy(), return_index=True)[1]] = True
        columns = [pa.array([self.lang] * rows.num_rows), rows["term"].cast(pa.string()), rows["source"], rows["count_sum"],
                   whole["count_sum"].take(at), pa.array(leads)]
        return pa.Table.from_arrays(columns, schema=FREQUENCY).combine_chunks().to_batches()[0]


def merged(batches: Iterable[pa.RecordBatch], min_docs: int) -> Iterator[pa.RecordBatch]:
    merge = RunMerge(min_docs)
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            langs, firsts = part.column("lang").to_pylist(), part.column("first").to_pylist()
            chunks = zip(*(part.column(c).to_pylist() for c in ("terms", "names", "source", "count", "docs")))
            for i, (lang, chunk) in enumerate(zip(langs, chunks)):
                if lang != merge.lang:
                    yield from merge.advance(None)
                    merge.lang = lang
                merge.add(*chunk)
                if i + 1 == len(langs) or langs[i + 1] != lang:
                    yield from merge.advance(firsts[i])  # no later chunk of the language begins below this
    yield from merge.advance(None)


def groups_of(docs: DataFrame) -> DataFrame:
    return docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")))


def frequencies(docs: DataFrame, min_docs: int = MIN_DOCS, block_postings: int = BLOCK_POSTINGS) -> DataFrame:
    """One row per kept term and source that has it: lang, term, source, count, lang_count (the
    term's count in the language), leads (true once per lang and term)."""
    shards = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = groups_of(docs).mapInArrow(partial(block_runs, shards=shards, postings=block_postings), RUN_DDL)
    dealt = runs.repartitionById(shards, F.col("shard")).sortWithinPartitions("lang", "first")
    return dealt.mapInArrow(partial(merged, min_docs=min_docs), FREQUENCY_DDL)


def probability(count: Column, total: Column) -> Column:
    """``1 + floor(10**9 * count / total)`` for count <= total, without a product over 1000 * total."""
    value, rest = F.lit(0).cast("long"), count
    for _ in range(3):
        rest = rest * 1000
        value = value * 1000 + F.call_function("div", rest, total)
        rest = rest % total
    return 1 + value


def _pair_sums(codes: list[np.ndarray], sums: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    code, at = np.unique(np.concatenate(codes), return_inverse=True)
    total = np.zeros(len(code), np.int64)
    np.add.at(total, at, np.concatenate(sums))
    return code, total


class PairCorrections:
    """Sums of C per pair of sources of one language."""

    def __init__(self):
        self.lang, self.number, self.names = None, {}, []
        self.codes: list[np.ndarray] = []
        self.sums: list[np.ndarray] = []
        self.held = 0

    def add(self, sources: list[str], p: list[int], least: list[int]) -> None:
        """The postings of one term, by source: p and the source's p0."""
        for s in sources:
            if s not in self.number:
                self.number[s] = len(self.names)
                self.names.append(s)
        at = np.array([self.number[s] for s in sources], np.int64)
        p, p0 = np.array(p, np.int64), np.array(least, np.int64)
        step = max(1, PAIR_ENTRIES // len(at))
        for i in range(0, len(at), step):
            a = slice(i, i + step)
            d = abs(p[a, None] - p) - abs(p[a, None] - p0) - abs(p0[a, None] - p) + abs(p0[a, None] - p0)
            low = at[a, None] < at
            self.codes.append((at[a, None] << 32 | at)[low])
            self.sums.append(d[low])
            self.held += len(self.codes[-1])
            if self.held >= 4 * PAIR_ENTRIES:
                code, total = _pair_sums(self.codes, self.sums)
                self.codes, self.sums, self.held = [code], [total], len(code)

    def taken(self) -> Iterator[pa.RecordBatch]:
        """Partial sums so far, a pair's lesser source first."""
        if self.codes:
            code, total = _pair_sums(self.codes, self.sums)
            for i in range(0, len(code), 1 << 14):
                pairs = [sorted((self.names[c >> 32], self.names[c & 0xFFFFFFFF])) for c in code[i:i + (1 << 14)].tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([self.lang] * len(pairs), pa.string()), pa.array([a for a, _ in pairs], pa.string()),
                     pa.array([b for _, b in pairs], pa.string()), pa.array(total[i:i + (1 << 14)], pa.int64())],
                    ["lang", "a", "b", "both"])
        self.codes, self.sums, self.held = [], [], 0
        self.number, self.names = {}, []


def corrected(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Postings in the order of lang and term -> partial sums of C per pair."""
    pairs, term, held = PairCorrections(), None, ([], [], [])
    for batch in batches:
        for lang, t, *posting in zip(*(batch.column(c).to_pylist() for c in ("lang", "term", "source", "p", "p0"))):
            if (lang, t) != (pairs.lang, term):
                if len(held[0]) > 1:
                    pairs.add(*held)
                if lang != pairs.lang or pairs.held >= 2 * PAIR_ENTRIES:
                    yield from pairs.taken()
                pairs.lang, term, held = lang, t, ([], [], [])
            for column, value in zip(held, posting):
                column.append(value)
    if len(held[0]) > 1:
        pairs.add(*held)
    yield from pairs.taken()


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS, block_postings: int = BLOCK_POSTINGS) -> DataFrame:
    """Rows lang, source, part, item, value, rank. Part ``pair``: the distance to every other
    source of the language; part ``term``: the ``top`` terms that the source has more often than
    the language as a whole. Ranks go by value, descending, then by item."""
    counted = stored(frequencies(docs, min_docs, block_postings), "divergence")
    of_lang = counted.groupBy("lang").agg(F.sum(F.col("leads").cast("long")).alias("V"), F.sum("count").alias("lang_N"))
    of_group = counted.groupBy("lang", "source").agg(F.sum("count").alias("N"))
    known = groups_of(docs).select("lang", "source").distinct()
    total = F.coalesce("N", F.lit(0)) + SMOOTH * F.col("V")
    groups = known.join(of_group, ["lang", "source"], "left").join(of_lang, "lang", "left").select(
        "lang", "source", "V", total.alias("total"), (F.col("lang_N") + SMOOTH * F.col("V")).alias("lang_total"),
        probability(F.lit(SMOOTH).cast("long"), total).alias("p0"))
    postings = counted.join(groups, ["lang", "source"]).withColumn("p", probability(F.col("count") + SMOOTH, F.col("total")))

    by_rank = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    excess = F.col("p") - probability(F.col("lang_count") + SMOOTH, F.col("lang_total"))
    terms = (postings.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), excess.alias("value"))
             .filter("value > 0").withColumn("rank", F.row_number().over(by_rank)).filter(F.col("rank") <= top))

    both = (postings.select("lang", "term", "source", "p", "p0").repartition("lang", "term").sortWithinPartitions("lang", "term")
            .mapInArrow(corrected, "lang string, a string, b string, both long").groupBy("lang", "a", "b").agg(F.sum("both").alias("both")))
    shapes = (postings.groupBy("lang", "source", "p").agg(F.count("*").alias("n"))
              .groupBy("lang", "source").agg(F.collect_list(F.struct("p", "n")).alias("has")))
    sides = groups.select("lang", "source", "V", "p0").join(shapes, ["lang", "source"], "left")
    a = sides.select("lang", "V", *(F.col(c).alias(f"{c}_a") for c in ("source", "p0", "has")))
    b = sides.select("lang", *(F.col(c).alias(f"{c}_b") for c in ("source", "p0", "has")))
    base = F.abs(F.col("p0_a") - F.col("p0_b"))

    def owned(has: str, other: str) -> Column:
        return F.coalesce(F.aggregate(has, F.lit(0).cast("long"), lambda s, h: s + h["n"] * (F.abs(h["p"] - F.col(other)) - base)), F.lit(0))

    distance = F.col("V") * base + owned("has_a", "p0_b") + owned("has_b", "p0_a") + F.coalesce("both", F.lit(0))
    half = (a.join(b, "lang").filter("source_a < source_b")
            .join(both.withColumnsRenamed({"a": "source_a", "b": "source_b"}), ["lang", "source_a", "source_b"], "left")
            .select("lang", "source_a", "source_b", F.coalesce(distance, F.lit(0)).alias("value")))
    pairs = (half.select("lang", "value", F.explode(F.array(F.struct(F.col("source_a").alias("source"), F.col("source_b").alias("item")),
                                                             F.struct(F.col("source_b").alias("source"), F.col("source_a").alias("item")))).alias("side"))
             .select("lang", "side.source", F.lit("pair").alias("part"), "side.item", "value")
             .withColumn("rank", F.row_number().over(by_rank)))
    return pairs.unionByName(terms)
