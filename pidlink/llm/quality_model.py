"""Quality by importance resampling over hashed n-grams.

Two bag-of-n-grams models are fitted: one of the target (documents labelled good), one of the
raw corpus (every document). A document's ratio is the mean log ratio of its n-grams under the two;
PRIOR n-grams of ratio 1 are counted in, which keep the mean of a few n-grams near 0. A mean does
not grow with the length of a text, but its scale is not that of probabilities either: n-grams of
one text are far from independent. So it is calibrated on labelled documents that the target model
was not fitted on: a logistic fit turns it into log odds, and those are the log importance weights.

Gumbel noise is added to the weights and the k largest keys stay, which samples k documents
without replacement in proportion to the weights (the odds). k is the number of documents that
are more likely good than not, or a stated ``share`` of all documents. Clear documents are far
above or below the cut whatever their noise; for the doubtful ones the draw decides.

Features are hashed into a fixed number of buckets: byte trigrams, and unigrams and bigrams of
words in which a word equal to its predecessor is replaced by one marker. Counts of the raw
corpus cover all documents; each task counts its share into one dense vector, so what is
shuffled and what the driver gets is bounded by the number of buckets. The target model is
fitted on three quarters of at most SAMPLE good documents, chosen by hash, one text of each
(the least, where rows repeat an id); ids of at most ``2 * SAMPLE`` labelled documents are the only
other thing that is broadcast, and their ratios the only other thing that is collected.

The logistic fit sees the sampled bad documents and the good ones held out (if all or none of the
sampled good ones were held out, all serve for both); a small ridge keeps the odds finite where the
labels are separable. The k-th largest key, to 1/8192, is
found by radix selection over a stored table of keys: four counts of at most 2**16 groups; the last
id of a tie likewise.

Defined results: a null or empty text has ratio 0; equal keys are ordered by id, and rows
that share an id and a key are taken together; labels that are null, or of ids that are not
there, are not used; without labelled good and bad documents every document is kept, and weights
are the ratios as they are.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pidlink.llm import bytegrams as G
from pidlink.llm.common import pieces, stored, unused

#: log2 of the buckets of each of the two families of features.
BITS = 15
BUCKETS = 2 << BITS
#: Labelled documents of each kind that the target model and the level are fitted on.
SAMPLE = 4096
SMOOTH = 1.0
#: n-grams of ratio 1 counted in.
PRIOR = 50
#: One in so many sampled good documents is kept for the calibration.
HELD = 4
#: Ridge of the logistic fit, on standardised ratios.
RIDGE = 1e-3
SEED = "gumbel-1"
CHUNK_BYTES = 1 << 18
_SAME = G.U64(0x5A4D)


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every n-gram of the texts, and the text it belongs to."""
    data, at = G.buffer_of(texts)
    size = len(data)
    gram = data[:-2].astype(np.uint32) | data[1:-1].astype(np.uint32) << 8 | data[2:].astype(np.uint32) << 16 \
        if size > 2 else np.zeros(0, np.uint32)
    gram = gram * np.uint32(0x9E3779B1) >> np.uint32(32 - BITS)
    owner = np.repeat(np.arange(len(at) - 1, dtype=np.int32), np.diff(at))
    whole = owner[:-2] == owner[2:] if size > 2 else np.zeros(0, bool)
    starts, ends, doc = G.words_of(data, at)
    h = G.word_hashes(data, starts, ends, G.BASES[0])
    follows = doc[1:] == doc[:-1]
    h[1:][follows & (h[1:] == h[:-1])] = _SAME
    two = G.mixed(h[:-1] * G.BASES[1] + h[1:])[follows]
    top = G.U64(64 - BITS)
    buckets = [gram[whole], (h >> top) + G.U64(1 << BITS), (two >> top) + G.U64(1 << BITS)]
    owners = [owner[:-2][whole] if size > 2 else owner[:0], doc, doc[1:][follows]]
    return np.concatenate([b.astype(np.int32) for b in buckets]), np.concatenate([o.astype(np.int32) for o in owners])


def count_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, target) -> (bucket, raw, target): one partial count per bucket and task. Rows with
    ``target`` count for the target model only, the others for the raw one."""
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in pieces(batches, "text", CHUNK_BYTES, 4096):
        bucket, owner = features(batch.column("text"))
        good = np.asarray(batch.column("target").to_numpy(zero_copy_only=False), bool)[owner]
        raw += np.bincount(bucket[~good], minlength=BUCKETS)
        target += np.bincount(bucket[good], minlength=BUCKETS)
    used = np.flatnonzero(raw + target)
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(raw[used]), pa.array(target[used])],
                                     ["bucket", "raw", "target"])


def ratios(texts: pa.Array, ratio: np.ndarray) -> np.ndarray:
    """Mean log ratio of the n-grams of each text."""
    bucket, owner = features(texts)
    total = np.bincount(owner, weights=ratio[bucket], minlength=len(texts))
    return total / (np.bincount(owner, minlength=len(texts)) + PRIOR)


def sampled(labels: DataFrame) -> DataFrame:
    """At most 2 * SAMPLE labelled ids, (l_id, good, held): the least hash of each of SAMPLE
    slots of each kind. Slots are pre-aggregated, so a hot kind is no hot task. ``held`` marks
    the good ones that the target model is not fitted on."""
    h = F.xxhash64(F.lit(SEED), F.col("doc_id"))
    rows = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)).select(
        F.col("doc_id"), (F.col("quality") == 1).alias("good"), h.alias("h"))
    return rows.groupBy("good", F.pmod("h", F.lit(SAMPLE)).alias("slot")).agg(
        F.min_by("doc_id", "h").alias("l_id")).select("l_id", "good").distinct().withColumn(
        "held", F.col("good") & (F.pmod(F.xxhash64(F.lit(SEED + "-held"), "l_id"), F.lit(HELD)) == 0))


def labelled(labels: DataFrame) -> DataFrame:
    """The sampled ids, (l_id, good), without those held out for the calibration."""
    return sampled(labels).where(~F.col("held")).select("l_id", "good")


def log_ratio(docs: DataFrame, labels: DataFrame) -> np.ndarray | None:
    """log p_target - log p_raw of every bucket; None without labelled good documents. If all of
    them were held out, the model is fitted on them."""
    ratio = _fitted(docs, labelled(labels).where("good").select("l_id"))
    held = sampled(labels).where("held").select("l_id")
    return ratio if ratio is not None or held.isEmpty() else _fitted(docs, held)


def _fitted(docs: DataFrame, ids: DataFrame) -> np.ndarray | None:
    """The log ratio with a target model of one text of each of these ids; None if there are none."""
    found = docs.select("doc_id", "text").join(F.broadcast(ids), F.col("doc_id") == F.col("l_id"))
    chosen = found.groupBy("l_id").agg(F.min("text").alias("text"))
    marked = docs.select("text", F.lit(False).alias("target")).unionAll(chosen.select("text", F.lit(True).alias("target")))
    parts = marked.mapInArrow(count_batches, "bucket int, raw long, target long")
    rows = parts.groupBy("bucket").agg(F.sum("raw"), F.sum("target")).collect()  # at most BUCKETS rows
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for bucket, r, t in rows:
        raw[bucket], target[bucket] = r, t
    if not target.sum():
        return None
    out = np.zeros(BUCKETS)
    for family in (slice(0, BUCKETS // 2), slice(BUCKETS // 2, BUCKETS)):
        t, r = target[family] + SMOOTH, raw[family] + SMOOTH
        out[family] = np.log(t / t.sum()) - np.log(r / r.sum())
    return out


def ratio_column(docs: DataFrame, ratio: np.ndarray | None) -> Column:
    """The ratio of each text as a column of ``docs`` (an Arrow function of the text alone)."""
    if ratio is None:
        return F.lit(0.0)
    shared = docs.sparkSession.sparkContext.broadcast(ratio)  # BUCKETS doubles

    @F.arrow_udf("double")
    def measure(texts: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([texts], ["text"])
        got = [ratios(b.column("text"), shared.value) for b in pieces([batch], "text", CHUNK_BYTES, 4096)]
        return pa.array(np.concatenate([np.zeros(0), *got]))

    return measure(docs["text"])


def gumbel(doc_id: Column, seed: str = SEED) -> Column:
    """Standard Gumbel noise, a fixed function of seed and id."""
    key = F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("")))
    u = (F.conv(F.substring(F.md5(key.cast("binary")), 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)
    return -F.log(-F.log(u))


def logistic(good: np.ndarray, bad: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of the log odds of being good, given ratios of both kinds: Newton steps
    on standardised ratios, halved until the loss falls, with a ridge that keeps the odds of
    separable labels finite. The slope is at least 0."""
    x = np.concatenate([np.sort(good), np.sort(bad)])
    t = np.repeat([1.0, 0.0], [len(good), len(bad)])
    mean, scale = x.mean(), x.std() or 1.0
    rows = np.stack([(x - mean) / scale, np.ones(len(x))], axis=1)

    def loss(c: np.ndarray) -> float:
        z = rows @ c
        return float(np.sum(np.logaddexp(0, z) - t * z) + RIDGE / 2 * c @ c)

    c = np.zeros(2)
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(rows @ c, -500, 500)))
        hessian = rows.T @ (rows * (p * (1 - p))[:, None]) + RIDGE * np.eye(2)
        step = np.linalg.solve(hessian, rows.T @ (t - p) - RIDGE * c)
        while loss(c + step) > loss(c) and np.abs(step).max() > 1e-9:
            step = step / 2
        c = c + step
        if np.abs(step).max() < 1e-9:
            break
    slope = max(float(c[0]) / scale, 0.0)
    return slope, float(c[1] - slope * mean)


def calibration(scored: DataFrame, labels: DataFrame) -> tuple[float, float] | None:
    """``logistic`` of the sampled labelled documents, the good ones being those held out, if there
    are any; None without both kinds."""
    sample = sampled(labels)
    found = scored.join(F.broadcast(sample), scored["doc_id"] == sample["l_id"])
    rows = found.groupBy("l_id", "good", "held").agg(F.min("ratio").alias("ratio")).collect()  # a row per sampled id
    held = any(r.held for r in rows)
    good = np.array([r.ratio for r in rows if r.good and r.held == held])
    bad = np.array([r.ratio for r in rows if not r.good])
    return logistic(good, bad) if len(good) and len(bad) else None


def _ordered(key: Column) -> Column:
    """A long of 0 .. 2**61 with the order of a double: steps of 1/8192, shifted as a long, where
    nothing is lost. Keys beyond +-2**47 are not distinguished."""
    span = float(1 << 47)
    steps = F.round(F.least(F.greatest(key, F.lit(-span)), F.lit(span)) * 8192.0).cast("long")
    return steps + F.lit(1 << 60)


def kth_largest(keys: DataFrame, column: str, k: int) -> int:
    """The k-th largest of a column of longs, read as unsigned, by four counts of 16 bits each."""
    prefix, rest = 0, k
    for shift in (48, 32, 16, 0):
        level = keys if shift == 48 else keys.where(F.shiftrightunsigned(column, shift + 16) == prefix)
        digit = F.shiftrightunsigned(column, shift).bitwiseAND(F.lit(0xFFFF))
        counts = sorted(((r[0], r[1]) for r in level.groupBy(digit.alias("d")).count().collect()), reverse=True)
        for value, n in counts:
            if rest <= n:
                prefix = prefix << 16 | value
                break
            rest -= n
    return prefix


def kth_smallest_id(rows: DataFrame, k: int) -> int:
    """The k-th smallest doc_id, nulls first; for a null, the least long."""
    nulls = rows.where(F.col("doc_id").isNull()).count()
    if k <= nulls:
        return -(1 << 63)
    # the complement turns the order round, the flipped sign makes it the order of unsigned longs
    sign = F.shiftleft(F.lit(1).cast("long"), 63)
    turned = F.bitwise_not(F.col("doc_id").cast("long")).bitwiseXOR(sign)
    ids = rows.where(F.col("doc_id").isNotNull()).select(turned.alias("turned"))
    return (1 << 63) - 1 - kth_largest(ids, "turned", k - nulls)


def _weight(ratio: Column, fit: tuple[float, float] | None) -> Column:
    return ratio if fit is None else ratio * F.lit(fit[0]) + F.lit(fit[1])


def _keyed(scored: DataFrame, fit: tuple[float, float] | None, seed: str) -> DataFrame:
    rows = scored.select("doc_id", _weight(F.col("ratio"), fit).alias("weight"))
    rows = rows.withColumn("key", F.col("weight") + gumbel(F.col("doc_id"), seed))
    return rows.withColumn("rank_key", _ordered(F.col("key")))


def top_keys(keyed: DataFrame, k: int) -> tuple[int, int | None]:
    """The cut of the k largest keys of a stored table: a document is among them if (rank_key,
    -doc_id) is at least (cut, -tie); a tie of None takes all."""
    if not k:
        return 1 << 62, None
    cut = kth_largest(keyed, "rank_key", k)
    above = keyed.where(F.col("rank_key") > cut).count()
    tied = keyed.where(F.col("rank_key") == cut).select("doc_id")
    return cut, kth_smallest_id(tied, k - above)


def resample(docs: DataFrame, labels: DataFrame, share: float | None = None, seed: str = SEED
             ) -> tuple[DataFrame, tuple[np.ndarray | None, tuple[float, float] | None], tuple[int, int | None]]:
    """The stored scores (doc_id, weight, key, rank_key), the model (log ratios of buckets, log odds
    of ratios), and the cut of ``top_keys``."""
    ratio = log_ratio(docs, labels)
    scored = stored(docs.select("doc_id", ratio_column(docs, ratio).alias("ratio")), "quality-ratios")
    fit = calibration(scored, labels) if ratio is not None else None
    keyed = stored(_keyed(scored, fit, seed), "quality")
    if fit is None:
        return keyed, (ratio, fit), (0, None)
    if share is None:
        k = keyed.where(F.col("weight") >= 0).count()
    else:
        k = round(share * keyed.count())
    return keyed, (ratio, fit), top_keys(keyed, k)


def _kept(rank_key: Column, doc_id: Column, cut: int, last: int | None) -> Column:
    tie = F.lit(True) if last is None else F.coalesce(doc_id <= F.lit(last), F.lit(True))
    return (rank_key > F.lit(cut)) | ((rank_key == F.lit(cut)) & tie)


def quality_rows(docs: DataFrame, labels: DataFrame, share: float | None = None, seed: str = SEED) -> DataFrame:
    """One row per document: doc_id, weight, key, kept."""
    scored, _, cut = resample(docs, labels, share, seed)
    return scored.select("doc_id", "weight", "key", _kept(F.col("rank_key"), F.col("doc_id"), *cut).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, share: float | None = None, seed: str = SEED) -> DataFrame:
    """The documents that the resampling keeps, all columns unchanged. The key of a document
    is a function of its id and text, so it is computed again where the document is; the texts
    do not move."""
    _, (ratio, fit), cut = resample(docs, labels, share, seed)
    name = unused(docs, "_ratio")
    out = docs.withColumn(name, ratio_column(docs, ratio))
    key = _ordered(_weight(F.col(name), fit) + gumbel(docs["doc_id"], seed))
    return out.where(_kept(key, docs["doc_id"], *cut)).drop(name)
