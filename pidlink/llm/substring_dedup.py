"""Repeated passages: Rabin-Karp hashes of every window of WINDOW words, counted in Spark.

A word is removed if a window that covers it also starts in a document with a smaller id.

Moving every window hash would cost several times the corpus. Windows that stand alone are
ruled out first, without loss: each window has a key, the least hash of the GRAM-word grams
inside it, so equal windows have equal keys, and neighbouring windows mostly share one (a run).
1. An Arrow pass stores, per document, its runs: key, first window, number of windows.
2. Spark counts the rows of each key. A key that only one document holds proves all its
   windows unique; the others are shared.
3. The shared runs are joined back to their documents, where the hash of each of their windows
   is taken (the words move once, and only hashes of possible repeats go on).
4. Runs are grouped by key, sorted by document, and streamed: a window that a smaller
   document has had is repeated. Keys with many rows are split by document into salted groups
   of about SALT_ROWS rows; each group passes on only the first document of every distinct
   window, and a second, pre-aggregated grouping settles these.
5. Repeated windows merge into maximal removal intervals per document.

Two windows are taken as equal if both their 64-bit hash and the 64-bit hash that is their key
agree. Texts are handled whole; long runs are stored in rows of at most RUN windows.

Defined results: a null text has no words; rows that share an id are compared with documents
of smaller ids, not with each other; rows without an id are never cut and cut no other; with
fewer than WINDOW words nothing is removed; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pidlink.llm import bytegrams as G
from pidlink.llm.common import pieces, stored

WINDOW = 50
GRAM = 10
RUN = 256
SALT_ROWS = 50_000
CHUNK_BYTES = 1 << 20


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def windows_of(texts: pa.Array, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text number, place in the text, key and hash of every window of the texts."""
    data, at = G.buffer_of(texts)
    starts, ends, doc = G.words_of(data, at)
    words = G.word_hashes(data, starts, ends, G.BASES[0])
    n = len(words) - window + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none.view(np.uint64), none.view(np.uint64)
    gram = min(GRAM, window)
    p = np.arange(len(words) - gram + 1)
    key = G.mixed(G.span_hashes(words, p, p + gram, G.BASES[1]))
    span, width = window - gram + 1, 1  # least of `span` neighbouring grams, by doubling
    while 2 * width <= span:
        key = np.minimum(key[:-width], key[width:])
        width *= 2
    if span > width:
        key = np.minimum(key[:width - span], key[span - width:])
    p = p[:n]
    hashes = G.mixed(G.span_hashes(words, p, p + window, G.BASES[1]) ^ G.MIX)
    inside = doc[:n] == doc[window - 1:]
    first_word = np.searchsorted(doc, np.arange(len(at) - 1))
    return doc[:n][inside], (p - first_word[doc[:n]])[inside], key[inside], hashes[inside]


def run_batches(batches: Iterable[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """(id, rid, text) -> (id, rid, key, start, n): the runs of each text."""
    for batch in pieces(batches, "text", CHUNK_BYTES, 4096):
        doc, place, key, _ = windows_of(batch.column("text"), window)
        if not len(doc):
            continue
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])])
        since = np.arange(len(new)) - np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
        first = np.flatnonzero(since % RUN == 0)
        n = np.diff(np.concatenate([first, [len(doc)]]))
        row = pa.array(doc[first])
        yield pa.RecordBatch.from_arrays(
            [batch.column("id").take(row), batch.column("rid").take(row), _signed(key[first]),
             pa.array(place[first].astype(np.int32)), pa.array(n.astype(np.int32))],
            ["id", "rid", "key", "start", "n"])


def hash_batches(batches: Iterable[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """(id, rid, text, runs) -> (key, salt, id, rid, start, hashes): the windows of the runs."""
    for batch in pieces(batches, "text", CHUNK_BYTES, 4096):
        doc, place, _, h = windows_of(batch.column("text"), window)
        begin = np.searchsorted(doc, np.arange(len(batch)))
        runs = batch.column("runs")
        flat = runs.flatten()
        row = np.repeat(np.arange(len(batch)), pc.list_value_length(runs).to_numpy())
        start, n = flat.field("start").to_numpy(), flat.field("n").to_numpy()
        at = begin[row] + start
        bounds = np.concatenate([[0], np.cumsum(n)])
        index = np.arange(bounds[-1]) - np.repeat(bounds[:-1] - at, n)
        hashes = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), _signed(h[index]))
        taken = pa.array(row)
        yield pa.RecordBatch.from_arrays(
            [flat.field("key"), flat.field("salt"), batch.column("id").take(taken), batch.column("rid").take(taken),
             flat.field("start"), hashes, flat.field("salted")],
            ["key", "salt", "id", "rid", "start", "hashes", "salted"])


REPEATS = "id long, rid long, start int, n int, key long, hash long"


def repeat_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (key, salt) groups, sorted by group and id -> spans of repeated windows (id,
    rid, start, n), and for salted groups every window of the first document that has it
    (id, rid, start, 1, key, hash). Holds a batch and the distinct windows of one group."""
    seen_h, seen_id = np.zeros(0, np.int64), np.zeros(0, np.int64)
    group_before = None
    for batch in batches:
        if not len(batch):
            continue
        col = {name: batch.column(name) for name in batch.schema.names}
        key, salt, ids = (col[c].to_numpy() for c in ("key", "salt", "id"))
        sizes = pc.list_value_length(col["hashes"]).to_numpy()
        row = np.repeat(np.arange(len(batch)), sizes)
        h = col["hashes"].flatten().to_numpy()
        place = np.arange(len(h)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + col["start"].to_numpy()[row]
        change = np.concatenate([[True], (key[1:] != key[:-1]) | (salt[1:] != salt[:-1])])
        group = np.cumsum(change)
        if group_before != (key[0], salt[0]):
            seen_h, seen_id = seen_h[:0], seen_id[:0]
        # windows seen before of the group that goes on stand in front, with their first id
        all_h, all_id = np.concatenate([seen_h, h]), np.concatenate([seen_id, ids[row]])
        all_group = np.concatenate([np.full(len(seen_h), 1), group[row]])
        order = np.lexsort((all_id, all_h, all_group))
        g, w = all_group[order], all_h[order]
        new = np.concatenate([[True], (g[1:] != g[:-1]) | (w[1:] != w[:-1])])
        least = np.empty(len(order), np.int64)
        least[order] = all_id[order][np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
        last = new & (g == group[-1])
        seen_h, seen_id, group_before = w[last], all_id[order][last], (key[-1], salt[-1])
        repeated = (all_id > least)[len(all_h) - len(h):]
        yield _spans(col, row, place, repeated)
        firsts = np.flatnonzero(~repeated & col["salted"].to_numpy(zero_copy_only=False)[row])
        if len(firsts):
            at = pa.array(row[firsts])
            yield pa.RecordBatch.from_arrays(
                [col["id"].take(at), col["rid"].take(at), pa.array(place[firsts].astype(np.int32)),
                 pa.array(np.ones(len(firsts), np.int32)), col["key"].take(at), pa.array(h[firsts])],
                ["id", "rid", "start", "n", "key", "hash"])


def _spans(col: dict, row: np.ndarray, place: np.ndarray, repeated: np.ndarray) -> pa.RecordBatch:
    at = np.flatnonzero(repeated)
    new = np.concatenate([[True] * bool(len(at)), (np.diff(at) != 1) | (np.diff(row[at]) != 0)]).astype(bool)
    first = at[new]
    n = np.diff(np.concatenate([np.flatnonzero(new), [len(at)]]))
    none = pa.nulls(len(first), pa.int64())
    rows = pa.array(row[first])
    return pa.RecordBatch.from_arrays(
        [col["id"].take(rows), col["rid"].take(rows), pa.array(place[first].astype(np.int32)),
         pa.array(n.astype(np.int32)), none, none], ["id", "rid", "start", "n", "key", "hash"])


def _rid() -> Column:
    return F.xxhash64("text")


def repeated_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per (id, rid) that has repeated windows: spans, an array of (start, n) of first
    windows and their number. ``rid`` is a hash of the text, for rows that share an id."""
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), _rid().alias("rid"), "text").where(
        F.col("id").isNotNull() & F.col("text").isNotNull())
    runs = stored(texts.mapInArrow(partial(run_batches, window=window),
                                   "id long, rid long, key long, start int, n int"), "windows")
    keys = runs.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count(F.lit(1)).alias("rows"))
    salts = F.ceil(F.col("rows") / SALT_ROWS).cast("int")
    shared = keys.where("lo < hi").select("key", salts.alias("salts"))
    salt = F.pmod(F.xxhash64("id"), F.col("salts")).cast("int")
    per_doc = (
        runs.join(shared, "key")
        .groupBy("id", "rid")
        .agg(F.collect_set(F.struct("key", salt.alias("salt"), (F.col("salts") > 1).alias("salted"), "start", "n"))
             .alias("runs")))
    wanted = texts.join(per_doc, ["id", "rid"])
    hashed = wanted.select("id", "rid", "text", "runs").mapInArrow(
        partial(hash_batches, window=window),
        "key long, salt int, id long, rid long, start int, hashes array<long>, salted boolean")
    grouped = hashed.repartition("key", "salt").sortWithinPartitions("key", "salt", "id")
    found = stored(grouped.mapInArrow(repeat_batches, REPEATS), "repeats")
    spans = found.where(F.col("key").isNull()).select("id", "rid", "start", "n")
    firsts = found.where(F.col("key").isNotNull())
    least = firsts.groupBy("key", "hash").agg(F.min("id").alias("first_id"))
    late = firsts.join(least, ["key", "hash"]).where("id > first_id").select("id", "rid", "start", "n")
    return spans.unionByName(late).groupBy("id", "rid").agg(F.collect_set(F.struct("start", "n")).alias("spans"))


def merged_intervals(spans: list[tuple[int, int]], window: int) -> list[tuple[int, int]]:
    """Maximal intervals of words covered by spans (first window, number of windows)."""
    out: list[tuple[int, int]] = []
    for start, n in sorted(spans):
        end = start + n - 1 + window
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def cut_batches(batches: Iterable[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, spans) -> (doc_id, n_words, removed, kept)."""
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    for batch in pieces(batches, "text", CHUNK_BYTES, 4096):
        sizes, removed, kept = [], [], []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
            words = (text or "").encode().split()  # bytes: ASCII white space only
            cuts = merged_intervals([(s["start"], s["n"]) for s in spans or ()], window)
            sizes.append(len(words))
            removed.append([{"start": a, "end": b} for a, b in cuts])
            for a, b in reversed(cuts):
                del words[a:b]
            kept.append(b" ".join(words).decode())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, kind), pa.array(kept, pa.string())],
            ["doc_id", "n_words", "removed", "kept"])


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: doc_id, n_words, removed (maximal intervals of word numbers, end
    exclusive) and kept, the remaining words joined by one space. The texts meet their spans
    by id."""
    spans = repeated_spans(docs, window).withColumnsRenamed({"id": "s_id", "rid": "s_rid"})
    texts = docs.select("doc_id", "text", F.col("doc_id").cast("long").alias("id"), _rid().alias("rid"))
    joined = texts.join(spans, (F.col("id") == F.col("s_id")) & (F.col("rid") == F.col("s_rid")), "left")
    schema = docs.select("doc_id").schema.add("n_words", "long")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
    return joined.select("doc_id", "text", "spans").mapInArrow(
        partial(cut_batches, window=window), f"{kinds}, removed array<struct<start:int,end:int>>, kept string")
