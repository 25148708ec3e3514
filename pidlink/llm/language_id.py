"""Language id: a bidirectional gated recurrent network over bytes.

Every byte of every text is read. Texts are cut into segments of SEGMENT bytes, at which the
states start anew; a network
with an update gate runs over each segment in both directions and labels every position with
a distribution over the learned languages. A document's probabilities are the mean over all
its positions.

The network is trained in numpy by backpropagation through time, on at most SLOTS documents of
each language (the least hash of each of SLOTS slots, pre-aggregated, so a frequent language
is no hot task) and WINDOWS windows of SEGMENT characters of each, all bytes of them. Only text and lang of documents outside the
held-out quarter are used for that. The trained weights, some tens of kilobytes, are the only
thing broadcast besides the ids of the sample.

Defined results: a text that is null or has no letter is ``und`` with score 0; without any
labelled document every text is ``und``; equal probabilities go to the first language by code
point; rows that repeat are judged alike; only text decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pidlink.llm import bytegrams as G
from pidlink.llm.common import pieces

HIDDEN = 12
SEGMENT = 64
SLOTS = 512
WINDOWS = 4
EPOCHS = 6
BATCH = 256
RATE = 0.02
SEED = 7
PAD = 256
UNKNOWN = "und"
CHUNK_BYTES = 1 << 20
#: Segments that run through the network together.
TOGETHER = 1024


@dataclass
class Network:
    """Weights of both directions: inputs (2, 257, 2H), recurrent (2, H, 2H), output (2, H, K)
    and its bias. The first H columns of a step are the gate's, halved so that one tanh serves
    gate and candidate. The row of the padding closes the gate, so a state passes through."""

    langs: list[str]
    inputs: np.ndarray
    recurrent: np.ndarray
    output: np.ndarray
    bias: np.ndarray

    @staticmethod
    def fresh(langs: list[str], hidden: int = HIDDEN, seed: int = SEED) -> Network:
        rng = np.random.default_rng(seed)
        inputs = rng.normal(0, 0.3, (2, PAD + 1, 2 * hidden)).astype(np.float32)
        inputs[:, PAD, :hidden], inputs[:, PAD, hidden:] = -40, 0
        recurrent = rng.normal(0, 0.5 / np.sqrt(hidden), (2, hidden, 2 * hidden)).astype(np.float32)
        output = rng.normal(0, 0.3, (2, hidden, len(langs))).astype(np.float32)
        return Network(langs, inputs, recurrent, output, np.zeros(len(langs), np.float32))

    def parameters(self) -> list[np.ndarray]:
        return [self.inputs, self.recurrent, self.output, self.bias]


def _both(x: np.ndarray, t: int) -> np.ndarray:
    """The bytes that the two directions read at step t."""
    return np.stack([x[t], x[len(x) - 1 - t]])


def _states(net: Network, x: np.ndarray, keep: bool = False):
    """States (T, 2, B, H) after each step over x (T, B); with ``keep`` also the steps' tanh."""
    steps, many = x.shape
    hidden = net.recurrent.shape[1]
    h = np.zeros((2, many, hidden), net.recurrent.dtype)
    out = np.empty((steps, 2, many, hidden), h.dtype)
    tanhs = np.empty((steps, 2, many, 2 * hidden), h.dtype) if keep else None
    a = np.empty((2, many, 2 * hidden), h.dtype)
    for t in range(steps):
        np.matmul(h, net.recurrent, out=a)
        a[0] += net.inputs[0][x[t]]
        a[1] += net.inputs[1][x[steps - 1 - t]]
        np.tanh(a, out=a)
        h = h + (a[..., :hidden] + 1) * 0.5 * (a[..., hidden:] - h)
        out[t] = h
        if keep:
            tanhs[t] = a
    return (out, tanhs) if keep else out


def _probabilities(net: Network, states: np.ndarray) -> np.ndarray:
    """Distribution over the languages at every position, (T, B, K)."""
    logits = states[:, 0] @ net.output[0] + states[::-1, 1] @ net.output[1] + net.bias
    logits -= logits.max(axis=-1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=-1, keepdims=True)
    return logits


def loss_and_gradients(net: Network, x: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross-entropy over all positions of x (T, B) that are no padding, labelled with
    their segment's language y (B), and its gradients by backpropagation through time."""
    steps, many = x.shape
    hidden = net.recurrent.shape[1]
    states, tanhs = _states(net, x, keep=True)
    p = _probabilities(net, states)
    real = (x != PAD).astype(p.dtype)
    n = real.sum()
    picked = p[:, np.arange(many), y]
    loss = float(-(np.log(picked + 1e-12) * real).sum() / n)
    d = p
    d[:, np.arange(many), y] -= 1
    d *= (real / n)[..., None]
    flat = d.reshape(-1, d.shape[-1])
    g_out = np.stack([states[:, 0].reshape(-1, hidden).T @ flat,
                      np.ascontiguousarray(states[::-1, 1]).reshape(-1, hidden).T @ flat])
    g_in, g_rec = np.zeros_like(net.inputs), np.zeros_like(net.recurrent)
    back = np.zeros((2, many, hidden), p.dtype)
    for t in range(steps - 1, -1, -1):
        back = back + np.stack([d[t] @ net.output[0].T, d[steps - 1 - t] @ net.output[1].T])
        before = states[t - 1] if t else np.zeros_like(back)
        s, c = tanhs[t][..., :hidden], tanhs[t][..., hidden:]
        z = (s + 1) * 0.5
        g = np.concatenate([back * (c - before) * 0.5 * (1 - s * s), back * z * (1 - c * c)], axis=-1)
        for side, read in enumerate(_both(x, t)):
            np.add.at(g_in[side], read, g[side])
        g_rec += before.transpose(0, 2, 1) @ g
        back = back * (1 - z) + g @ net.recurrent.transpose(0, 2, 1)
    g_in[:, PAD] = 0
    return loss, [g_in, g_rec, g_out, flat.sum(axis=0)]


def segment_bounds(at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of every segment of the texts of a byte buffer, and the number of segments of
    each text."""
    count = -(-np.diff(at) // SEGMENT)
    text = np.repeat(np.arange(len(count)), count)
    first = np.cumsum(count) - count
    begin = at[:-1][text] + (np.arange(len(text)) - first[text]) * SEGMENT
    return begin, np.minimum(begin + SEGMENT, at[1:][text]), count


def padded(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Segments as (SEGMENT, N), padded at their ends."""
    place = begin[:, None] + np.arange(SEGMENT)
    inside = place < end[:, None]
    x = np.full(place.shape, PAD, np.int16)
    x[inside] = data[place[inside]]
    return np.ascontiguousarray(x.T)


def train(windows: list[tuple[str, str]], epochs: int = EPOCHS) -> Network | None:
    """Fit a network to (lang, text window) pairs with Adam."""
    langs = sorted({lang for lang, _ in windows})
    if not langs:
        return None
    net = Network.fresh(langs)
    raw = [text.encode() for _, text in windows]  # up to four segments each, all of which train
    begin, end, count = segment_bounds(np.cumsum([0, *map(len, raw)]))
    x = padded(np.frombuffer(b"".join(raw), np.uint8), begin, end)
    y = np.repeat([langs.index(lang) for lang, _ in windows], count)
    rng = np.random.default_rng(SEED)
    weights = net.parameters()
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    step, steps = 0, epochs * -(-len(y) // BATCH)
    for _ in range(epochs):
        for some in np.array_split(rng.permutation(len(y)), -(-len(y) // BATCH)):
            _, grads = loss_and_gradients(net, x[:, some], y[some])
            step += 1
            rate = RATE * (1 - 0.9 * step / steps)
            for w, g, m, v in zip(weights, grads, first, second):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                w -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return net


def pooled(net: Network, texts: pa.Array) -> np.ndarray:
    """Mean probability of each language over all positions of each text, (texts, K); zeros
    for an empty text."""
    data, at = G.buffer_of(texts)
    begin, end, count = segment_bounds(at)
    sums = np.zeros((len(begin), len(net.langs)))
    for a in range(0, len(begin), TOGETHER):  # what is held besides the text is bounded by TOGETHER segments
        some = slice(a, a + TOGETHER)
        part = padded(data, begin[some], end[some])
        p = _probabilities(net, _states(net, part))
        sums[some] = np.einsum("tbk,tb->bk", p, (part != PAD).astype(p.dtype))
    out = np.zeros((len(texts), len(net.langs)))
    np.add.at(out, np.repeat(np.arange(len(texts)), count), sums)
    return out / np.maximum(np.diff(at), 1)[:, None]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_windows(docs: DataFrame) -> list[tuple[str, str]]:
    """The bounded sample: (lang, window) pairs in a fixed order. Of rows that repeat an id in a
    language, the one with the least windows is used."""
    rows = docs.select("doc_id", "text", "lang").where(
        ~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    h = F.xxhash64(F.lit(SEED), F.col("doc_id"))
    ids = (
        rows.groupBy("lang", F.pmod(h, F.lit(SLOTS)).alias("slot")).agg(F.min_by("doc_id", h).alias("s_id"))
        .select(F.col("lang").alias("s_lang"), "s_id"))
    picked = rows.join(F.broadcast(ids), (F.col("doc_id") == F.col("s_id")) & (F.col("lang") == F.col("s_lang")))
    room = F.greatest(F.length("text") - SEGMENT, F.lit(0))
    cuts = F.array(*[F.substring("text", F.floor(room * i / max(WINDOWS - 1, 1)).cast("int") + 1, F.lit(SEGMENT))
                     for i in range(WINDOWS)])
    lettered = picked.select("lang", "s_id", F.filter(F.array_distinct(cuts), lambda w: w.rlike("\\p{L}")).alias("ws"))
    one = lettered.where(F.size("ws") > 0).groupBy("lang", "s_id").agg(F.min("ws").alias("ws"))
    windows = one.select("lang", F.explode("ws").alias("w"))
    return sorted((r[0], r[1]) for r in windows.collect())  # at most SLOTS * WINDOWS of a language


def identify(docs: DataFrame, net: Network | None) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    kind = T.StructType().add("lang", "string").add("score", "double")
    if net is None:
        found = F.lit(None).cast(kind)
    else:
        shared = docs.sparkSession.sparkContext.broadcast(net)

        @F.arrow_udf(kind)
        def read(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for texts in batches:
                net = shared.value
                parts = pieces([pa.RecordBatch.from_arrays([texts], ["text"])], "text", CHUNK_BYTES, 4096)
                p = np.concatenate([np.zeros((0, len(net.langs))), *[pooled(net, b.column("text")) for b in parts]])
                best = p.argmax(axis=1)
                score = np.clip(p[np.arange(len(p)), best], 0, 1)
                yield pa.StructArray.from_arrays(
                    [pa.array([net.langs[i] for i in best], pa.string()), pa.array(score)], ["lang", "score"])

        found = read("text")
    known = F.coalesce(F.col("text").rlike("\\p{L}"), F.lit(False)) & F.lit(net is not None)
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), known.alias("known"), found.alias("found"))
    return rows.select(
        "doc_id", "held_out",
        F.when(F.col("known"), F.col("found.lang")).otherwise(F.lit(UNKNOWN)).alias("lang_pred"),
        F.when(F.col("known"), F.col("found.score")).otherwise(F.lit(0.0)).alias("score"))


def languages(docs: DataFrame) -> DataFrame:
    """Train on the documents outside the held-out quarter, then identify all."""
    return identify(docs, train(training_windows(docs)))
