"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

Scan 1 keeps only the byte length and a hash of the first bytes of each text and counts rows per
(length, prefix hash), pre-aggregated; rows of equal length that differ in the prefix fall into
different counts, so the two steps take one shuffle and no length is a task of its own. The
groups of two and more are marked in a table of at most ``BUCKETS`` hash buckets, the only thing that
is broadcast. Scan 2 reads the full content of the rows whose bucket is marked and takes its
SHA-256; all other rows are known to be unique. A bucket that two groups share only makes a
unique row pay for its SHA-256, it never changes a result. Texts do not move: every shuffle
holds ids, lengths and hashes, and every group is pre-aggregated before it.

Defined results: a null text is the empty text; a null id is smaller than any other; rows
equal in id and text are one group, of which exactly one row is kept (``drop_exact`` keeps the one
whose other columns, as JSON, come first); other columns are neither read nor compared. An empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pidlink.llm.common import stored, unused

#: Characters that the prefix hash reads.
PREFIX = 64
#: Upper bound of the broadcast table of surviving groups (longs).
BUCKETS = 1 << 20


def content(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def _bucket() -> Column:
    return F.pmod(F.xxhash64("_len", "_prefix"), F.lit(BUCKETS))


def _cheap_keys(text: Column) -> list[Column]:
    return [F.octet_length(text).alias("_len"), F.xxhash64(F.substring(text, 1, PREFIX)).alias("_prefix")]


def prefix_groups(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Rows per length and prefix hash: _len, _prefix, _n."""
    return docs.select(*_cheap_keys(content(F.col(text_col)))).groupBy("_len", "_prefix").agg(F.count(F.lit(1)).alias("_n"))


def refinement(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """One row: how many of the ``rows`` share their length with another row, and how many also
    share their prefix hash, which are those whose full content is read."""
    groups = prefix_groups(docs, text_col)
    lengths = groups.groupBy("_len").agg(F.sum("_n").alias("_all"), F.sum(F.when(F.col("_n") > 1, F.col("_n")).otherwise(0)).alias("_same"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return lengths.agg(total("_all").alias("rows"), total(F.when(F.col("_all") > 1, F.col("_all"))).alias("same_length"),
                       total("_same").alias("same_prefix"))


def content_hashes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **more: Column) -> DataFrame:
    """One stored row per document: _id, _row (a row number of the stored table) and _full,
    the SHA-256 of its text, or null where no other document can hold the same text.
    ``more`` are further columns of the stored row, computed from _text in scan 2."""
    text = content(F.col(text_col))
    cheap = docs.select(F.col(id_col).alias("_id"), text.alias("_text"), *_cheap_keys(text))
    by_prefix = prefix_groups(docs, text_col).where("_n > 1")
    marked = by_prefix.select(_bucket().alias("_b")).distinct()
    rows = cheap.withColumn("_b", _bucket()).join(F.broadcast(marked.withColumn("_hit", F.lit(True))), "_b", "left")
    full = F.when(F.col("_hit"), F.unhex(F.sha2(F.encode("_text", "UTF-8"), 256)))
    return stored(rows.select("_id", F.monotonically_increasing_id().alias("_row"), full.alias("_full"),
                              *[c.alias(name) for name, c in more.items()]), "exact")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **more: Column) -> DataFrame:
    """One row per document: doc_id, keep_id (the largest id of its text), group_size, kept,
    and the columns ``more``."""
    rows = content_hashes(docs, id_col, text_col, **more)
    alone = rows.where(F.col("_full").isNull()).select(
        F.col("_id").alias("doc_id"), F.col("_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), *more)
    many = rows.where(F.col("_full").isNotNull())
    groups = many.groupBy("_full").agg(
        F.max(F.struct("_id", "_row")).alias("_keep"), F.count(F.lit(1)).alias("group_size"))
    grouped = many.join(groups, "_full").select(
        F.col("_id").alias("doc_id"), F.col("_keep._id").alias("keep_id"), "group_size",
        (F.col("_row") == F.col("_keep._row")).alias("kept"), *more)
    return alone.unionByName(grouped)


def with_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``exact_groups`` and text_sha256, the lowercase hex SHA-256 of every text."""
    digest = F.sha2(F.encode("_text", "UTF-8"), 256)
    return exact_groups(docs, id_col, text_col, text_sha256=digest)


def drop_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, all columns unchanged.

    Rows are told apart by id and full hash. The anti join moves the texts once; ids are
    spread, so no copy group is hot in it. Rows equal in id and text are thinned to one.
    """
    rows = content_hashes(docs, id_col, text_col).where(F.col("_full").isNotNull())
    same = rows.groupBy("_full", "_id").agg(F.count(F.lit(1)).alias("_copies"))
    groups = same.groupBy("_full").agg(F.max(F.struct("_id")).alias("_keep"))
    marked = same.join(groups, "_full").select(
        "_id", "_full", (F.col("_keep._id").eqNullSafe(F.col("_id"))).alias("_stays"), "_copies")
    gone = marked.where(~F.col("_stays")).select("_id", "_full")
    sha = F.unhex(F.sha2(F.encode(content(F.col(text_col)), "UTF-8"), 256))
    digest = unused(docs, "_doc_full")
    left = docs.withColumn(digest, sha)

    def on(other: DataFrame) -> Column:
        return left[id_col].eqNullSafe(other["_id"]) & (left[digest] == other["_full"])

    repeated = marked.where(F.col("_stays") & (F.col("_copies") > 1)).select("_id", "_full")
    if repeated.isEmpty():
        return left.join(gone, on(gone), "left_anti").drop(digest)
    # the least of the rows by their other columns, so that every run keeps the same one
    row = F.struct(*(left[c] for c in docs.columns))
    thinned = (left.join(repeated, on(repeated), "left_semi").groupBy(id_col, digest)
               .agg(F.min_by(row, F.to_json(F.struct(*(left[c] for c in docs.columns if c != text_col)))).alias("_row")))
    out = gone.unionByName(repeated)
    rest = left.join(out, on(out), "left_anti").drop(digest)
    return rest.unionByName(thinned.select(*(F.col("_row").getField(c).alias(c) for c in docs.columns)))
