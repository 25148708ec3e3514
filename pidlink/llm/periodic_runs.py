"""Periodic runs of words: Lyndon arrays by Baier's grouping, roots extended by LCE.

A run is a stretch of consecutive words with smallest period q that no neighbouring word
extends, of at least ``max(MIN_LENGTH, MIN_POWER * q)`` words. Every run has a root that is the
longest Lyndon word at its start, under the order of the words or under the reverse order. So
the first phase of Baier's suffix sorter runs under both orders: its groups, taken from the
highest to the lowest, end with the length of the longest Lyndon word at every position, which
gives at most two candidates (start, period) a position. Each is extended to both sides by
longest common extensions, read off tables of equal blocks of 1, 2, 4, ... words.

Before that, words that cannot lie in a run are left out without loss: in a stretch of at least
``max(24, 3q)`` words every nine consecutive words stand again q words earlier or later, so a
run lies inside a stretch of at least sixteen consecutive nine-word windows that all occur
twice or more in the text. Window hashes only select such pieces (equal windows have equal
hashes; a collision keeps a piece too many); runs are found by comparing words.

Everything is a function of one text, so texts stay where they are; a task holds one chunk of
texts and, for one piece, 13 tables of equal blocks (52 bytes a word).

Defined results: a null or empty text has no words and no runs; overlapping runs of different
periods are all kept; repeated rows give repeated results; texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pidlink.llm.common import WORD, pieces

MIN_LENGTH = 24
MIN_POWER = 3
#: The longest window that every run of MIN_LENGTH words and MIN_POWER periods repeats.
GRAM = 9
#: Equal-block tables go up to 2**12 words; longer extensions take several steps.
TOP = 12
CHUNK_BYTES = 2 << 20

Run = tuple[int, int, int]


def repeated_pieces(words: np.ndarray) -> list[tuple[int, int]]:
    """Disjoint [start, end) stretches outside of which no run lies. Equal words have equal numbers."""
    n = len(words) - GRAM + 1
    if n < MIN_LENGTH - GRAM + 1:
        return []
    grams = np.zeros(n, np.uint64)
    for j in range(GRAM):
        grams *= np.uint64(0x9E3779B97F4A7C15)
        grams += words[j:j + n].astype(np.uint64)
    order = np.argsort(grams, kind="stable")
    same = grams[order[1:]] == grams[order[:-1]]
    if not same.any():
        return []
    twice = np.zeros(n + 2, np.int8)
    twice[order[1:][same] + 1] = 1
    twice[order[:-1][same] + 1] = 1
    change = np.diff(twice)
    starts, ends = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    keep = ends - starts >= MIN_LENGTH - GRAM + 1
    return [(int(a), int(b) + GRAM - 1) for a, b in zip(starts[keep], ends[keep])]


def lyndon_array(ranks: list[int], top: int) -> list[int]:
    """Length of the longest Lyndon word at every position; ``ranks`` are 0 .. top-1.

    A group holds positions, ascending, whose suffixes begin with one context. The highest group
    is final: its context is the longest Lyndon word there. Its members leave the text, and the
    position then left of a member takes the context over, as often as it stands there: it moves
    to a new group directly above its own. Each position moves once for a neighbour that leaves,
    so the work is linear.
    """
    n = len(ranks)
    members: list[list[int]] = [[] for _ in range(top)]
    for i, r in enumerate(ranks, 1):  # positions 1 .. n; 0 and n + 1 bound the text
        members[r].append(i)
    group = [-1, *ranks, -1]
    context = [1] * top
    below, above = list(range(-1, top - 1)), list(range(1, top + 1))
    left, right = list(range(-1, n + 1)), list(range(1, n + 3))
    length = [0] * (n + 2)
    g = top - 1
    while g >= 0:
        ctx = context[g]
        taken: dict[int, dict[int, list[int]]] = {}  # group, copies of the context -> positions
        last = copies = 0
        for i in members[g]:
            if group[i] != g:
                continue
            length[i] = ctx
            a, b = left[i], right[i]
            right[a] = b
            left[b] = a
            if a == last:
                copies += 1
            else:
                if last:
                    taken.setdefault(group[last], {}).setdefault(copies, []).append(last)
                last, copies = a, 1
        if last:
            taken.setdefault(group[last], {}).setdefault(copies, []).append(last)
        for h, by_copies in taken.items():
            low, high = h, above[h]
            for t in sorted(by_copies):
                new = len(members)
                members.append(by_copies[t])
                context.append(context[h] + t * ctx)
                below.append(low)
                above.append(high)
                above[low] = new
                for j in by_copies[t]:
                    group[j] = new
                low = new
            if high < len(below):
                below[high] = low
        members[g] = []
        g = below[g]
    return length[1:n + 1]


class EqualBlocks:
    """Longest common extensions of two positions, by tables of equal blocks of 2**k words."""

    def __init__(self, ranks: np.ndarray):
        self.n = len(ranks)
        self.tables = [ranks.astype(np.int32)]
        while len(self.tables) <= TOP and 2 << (len(self.tables) - 1) <= self.n:
            half, t = 1 << (len(self.tables) - 1), self.tables[-1]
            pair = t[:-half].astype(np.int64) << 32 | t[half:]
            self.tables.append(np.unique(pair, return_inverse=True)[1].astype(np.int32))

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words from i and from j on that agree; i < j."""
        return self._walk(i, j, lambda at, size: at, lambda i, j, size: j + size <= self.n, 1)

    def backward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words that agree before i and before j; i < j."""
        return self._walk(i, j, lambda at, size: at - size, lambda i, j, size: i >= size, -1)

    def _walk(self, i, j, block, fits, sign):
        total = np.zeros(len(i), np.int64)
        i, j, open_ = i.copy(), j.copy(), np.arange(len(i))
        for k in reversed(range(len(self.tables))):
            size, table, live = 1 << k, self.tables[k], open_
            while len(live):
                live = live[fits(i[live], j[live], size)]
                live = live[table[block(i[live], size)] == table[block(j[live], size)]]
                total[live] += size
                i[live] += sign * size
                j[live] += sign * size
                if k < len(self.tables) - 1:
                    break  # after the largest blocks, a smaller one fits at most once
        return total


def piece_runs(words: np.ndarray) -> set[Run]:
    """Runs (start, length, period) of one piece."""
    names, ranks = np.unique(words, return_inverse=True)
    n, top = len(ranks), len(names)
    starts, periods = [], []
    for order in (ranks, top - 1 - ranks):
        found = np.array(lyndon_array(order.tolist(), top), np.int64)
        at = np.flatnonzero(found * MIN_POWER <= n)
        starts.append(at)
        periods.append(found[at])
    i, p = np.concatenate(starts), np.concatenate(periods)
    # a run repeats its root: only roots that the next word does not contradict are extended
    follows = i + p < n
    i, p = i[follows], p[follows]
    blocks = EqualBlocks(ranks)
    start = i - blocks.backward(i, i + p)
    length = i + p + blocks.forward(i, i + p) - start
    keep = length >= np.maximum(MIN_LENGTH, MIN_POWER * p)
    return set(zip(start[keep].tolist(), length[keep].tolist(), p[keep].tolist()))


def runs(words: list[bytes]) -> list[Run]:
    """All runs (start, length, period) of a text's words, by start, then period."""
    if len(words) < MIN_LENGTH:
        return []
    hashed = np.fromiter(map(hash, words), np.int64, len(words))
    found: list[Run] = []
    for a, b in repeated_pieces(hashed):
        number: dict[bytes, int] = {}
        exact = np.array([number.setdefault(w, len(number)) for w in words[a:b]], np.int64)
        found += [(a + s, length, p) for s, length, p in piece_runs(exact)]
    return sorted(found, key=lambda r: (r[0], r[2]))


def longest(found: list[Run]) -> Run | None:
    """The run of the greatest length / period; ties go to the smallest start, then period."""
    best = None
    for r in found:  # by start, then period
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def kept_words(words: list[bytes], found: list[Run]) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not found:
        return words
    out, done = [], 0
    for a, b in sorted((s + p, s + length) for s, length, p in found):
        if a > done:
            out += words[done:a]
        done = max(done, b)
    return out + words[done:]


_RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def run_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text", CHUNK_BYTES, 4096):
        lists, collapsed = [], []
        for text in batch.column("text").cast(pa.binary()).to_pylist():
            words = (text or b"").split()  # bytes.split() cuts at the six ASCII white spaces
            found = runs(words)
            lists.append([{"start": s, "length": n, "period": p} for s, n, p in found])
            collapsed.append(b" ".join(kept_words(words, found)).decode())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(lists, _RUN), pa.array(collapsed, pa.string())],
                                         ["doc_id", "runs", "collapsed"])


def periodic_runs(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, runs (start, length, period; by start, then period) and the
    collapsed text: its words, without what runs repeat, joined by single spaces."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return docs.select("doc_id", "text").mapInArrow(run_batches, schema)


def longest_run(found: Column) -> Column:
    """``longest`` of an array of runs, as a column; null if there is none."""
    return F.reduce(found, F.get(found, F.lit(0)),
                    lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best))


def planted(docs: DataFrame) -> DataFrame:
    """``docs`` with periodic tails: where crc32 of the decimal doc_id is a multiple of ten, the
    text's words from some word a on are replaced by repetitions of the p words that begin at a."""
    h = F.crc32(F.col("doc_id").cast("string"))
    chosen = docs.select("doc_id", "text", h.alias("h"),
                         F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(f"({WORD})"))).alias("words"))
    g = F.floor(F.col("h") / 10)
    sized = chosen.withColumn("n", F.size("words"))
    sized = sized.withColumn("a", F.when(F.col("n") > 0, (g % F.col("n")).cast("int")))
    sized = sized.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + g % 8))).cast("int"))
    tail = F.col("n") - F.col("a")
    block = F.slice("words", F.col("a") + 1, F.col("p"))
    copies = F.flatten(F.array_repeat(block, F.ceil(tail / F.col("p")).cast("int")))
    text = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(copies, F.lit(1), tail)), " ")
    return sized.select("doc_id", F.when(F.col("p").isNotNull(), text).otherwise(F.col("text")).alias("text"))
