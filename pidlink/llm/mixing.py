"""Mixing sources to target weights by capped water-filling.

Every source gets a share of the corpus by its weight, but never more than ``MAX_EPOCHS``
times its own size; what a clamped source leaves over goes to the others in proportion to
their weights until nothing exceeds its cap. With the sources ordered by cap / weight the
clamped ones are a prefix of that order, so one pass of running sums over the source table
(one row per source) finds the final level that the repeated redistribution ends at.

A target then means target / size repetitions of each document of a source: the whole part
for each, and the fraction for some, in the order of a seeded hash of the id until their
sizes fill the fractional goal (the document that crosses it is taken if more than half of
it fits). The running sum over documents is cut in two: sums of 2**16 ranges of that hash per
source, pre-aggregated, find the range in which the goal is reached; only that range's
documents are ordered one by one. So no task ever holds a source, however large.

Defined results: a null text has size 0; a null source is a source of its own, last in the
order; an empty text is taken 0 words; rows that repeat an id are documents of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pidlink.llm.common import n_words, stored, unused

MAX_EPOCHS = 3
WEIGHTS = (1, 2, 3)
SEED = "mix-1"
#: Sources that a mix may have: their table is ordered in one task and broadcast. More are an error.
MAX_SOURCES = 1 << 18
#: Sums of draws are kept for 2**BUCKET_BITS ranges per source.
BUCKET_BITS = 16


def source_targets(sizes: DataFrame) -> DataFrame:
    """One row per source of (source, size) rows: source, source_size, target, whole, goal.

    ``whole`` is the number of full repetitions, ``goal`` the words that the fractional
    repetition should add.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # one row per source from here on: the weight table of the mix, not the corpus
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(w).cast("long") for w in WEIGHTS])
    per = per.select("*", F.get(weights, (F.row_number().over(by_name) - 1) % len(WEIGHTS)).alias("w"),
                     (F.col("source_size") * MAX_EPOCHS).alias("cap"))
    everything = Window.partitionBy()
    before = Window.orderBy((F.col("cap") / F.col("w")).asc(), F.col("source").asc_nulls_last()) \
                   .rowsBetween(Window.unboundedPreceding, -1)
    # what a unit of weight gets if exactly the sources before this one are clamped; it rises
    # while clamping is due and falls afterwards, so its maximum is the feasible level
    level = ((F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
             / (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0))))
    few = F.count(F.lit(1)).over(everything) <= MAX_SOURCES
    level = F.when(few, level).otherwise(F.raise_error(F.lit(f"a mix of more than {MAX_SOURCES} sources")).cast("double"))
    per = per.withColumn("level", level).withColumn("level", F.max("level").over(everything))
    per = per.withColumn("target", F.least(F.col("cap").cast("double"), F.col("level") * F.col("w")))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    return per.withColumn("whole", whole.cast("long")).select(
        "source", "source_size", "target", "whole",
        (F.col("target") - F.col("whole") * F.col("source_size")).alias("goal"))


def draw(doc_id: Column) -> Column:
    """Seeded place of a document in its source's order: 48 bits, the same on every run."""
    key = F.concat(F.lit(SEED + ":"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 12), 16, 10).cast("long")


def repetitions(sized: DataFrame) -> DataFrame:
    """The mix as one stored row per source: source, source_size, target, whole, last_draw.

    A document of the source is taken ``whole`` times, and once more if its draw is at most
    ``last_draw``. ``sized`` has source, size and draw of every document.
    """
    targets = stored(source_targets(sized), "mix-targets")
    bucket = F.shiftright("draw", 48 - BUCKET_BITS)
    sums = sized.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("start", F.coalesce(F.sum("words").over(before), F.lit(0)))
    t = targets.select(F.col("source").alias("t_source"), "goal")
    edge = (
        starts.join(t, F.col("source").eqNullSafe(F.col("t_source")))
        .where(F.col("start") <= F.col("goal"))
        .groupBy(F.col("source").alias("e_source"), F.col("goal"))
        .agg(F.max(F.struct("bucket", "start")).alias("edge")))
    edge = stored(edge.select("e_source", "goal", "edge.bucket", "edge.start"), "mix-edges")
    # the documents of one bucket per source, ordered one by one; equal draws count as one
    inside = sized.join(edge, sized["source"].eqNullSafe(edge["e_source"]) & (bucket == edge["bucket"]))
    by_draw = inside.groupBy("e_source", "draw").agg(
        F.sum("size").alias("words"), F.first("start").alias("start"), F.first("goal").alias("goal"))
    upto = F.col("start") + F.sum("words").over(Window.partitionBy("e_source").orderBy("draw"))
    last = (
        by_draw.withColumn("upto", upto).where(2 * F.col("upto") - F.col("words") <= 2 * F.col("goal"))
        .groupBy("e_source").agg(F.max("draw").alias("last")))
    # nothing of the bucket fits: the draw just below it
    edge = edge.join(last.withColumnRenamed("e_source", "l_source"),
                     F.col("e_source").eqNullSafe(F.col("l_source")), "left")
    below = F.shiftleft(F.col("bucket").cast("long"), 48 - BUCKET_BITS) - 1
    edge = edge.select("e_source", F.coalesce("last", below).alias("last_draw"))
    out = targets.join(edge, F.col("source").eqNullSafe(F.col("e_source")), "left")
    return stored(out.select("source", "source_size", "target", "whole",
                             F.coalesce("last_draw", F.lit(-1).cast("long")).alias("last_draw")), "mix-reps")


def sizes_of(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id"), F.col("source"), n_words(F.col("text")).alias("size"),
                       draw(F.col("doc_id")).alias("draw"))


def mixed_sizes(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken."""
    sized = stored(sizes_of(docs), "mix-sizes")
    per = repetitions(sized).withColumnRenamed("source", "m_source")
    times = F.col("whole") + (F.col("draw") <= F.col("last_draw")).cast("long")
    return sized.join(F.broadcast(per), sized["source"].eqNullSafe(per["m_source"])).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * times).alias("taken"))


def mix(docs: DataFrame) -> DataFrame:
    """The mixed corpus: the documents, each repeated as often as the mix takes it.

    The table of sources, of at most MAX_SOURCES rows, is broadcast, so the texts do not move.
    """
    sized = stored(sizes_of(docs), "mix-sizes")
    src, times = unused(docs, "_mix_source"), unused(docs, "_mix_times")
    per = repetitions(sized).select(F.col("source").alias(src), "whole", "last_draw")
    n = per["whole"] + (draw(docs["doc_id"]) <= per["last_draw"]).cast("long")
    out = docs.join(F.broadcast(per), docs["source"].eqNullSafe(per[src])).select(*[docs[c] for c in docs.columns], n.alias(times))
    return out.where(F.col(times) > 0).withColumn(
        times, F.explode(F.array_repeat(F.lit(1), F.col(times).cast("int")))).drop(times)
