"""Counts, filters, distributions and pivots around the mapping outputs.

All are projections and (partially aggregated) group-bys, plus two joins: the inverted
multi-mapped check, done as "count per OpenAlex id, then semi join back" so that an id
reached by very many records is counted map-side instead of being windowed in one task,
and the venue/record overlap (distinct venue OMIDs left-joined to the record OMIDs).
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pidlink.functions import constants as K
from pidlink.functions import tokens
from pidlink.operators import pids as P

COMPOSITIONS = ("works", "sources", "both")


def oaid_list(c: str | Column = "openalex_id") -> Column:
    """The space-joined list as split on single blanks (the helpers' own split)."""
    return F.split(F.col(c) if isinstance(c, str) else c, " ")


def oaid_count(c: str | Column = "openalex_id") -> Column:
    """List length, but 0 for a one-element list (kept as found in the helper)."""
    n = F.size(oaid_list(c))
    return F.when(n > 1, n).otherwise(0).cast("bigint")


def composition(c: str | Column = "openalex_id") -> Column:
    """works (all W), sources (all S), both (some W or S), '' otherwise."""
    ids = oaid_list(c)
    return (
        F.when(F.forall(ids, lambda x: x.startswith("W")), "works")
        .when(F.forall(ids, lambda x: x.startswith("S")), "sources")
        .when(F.exists(ids, lambda x: x.startswith("W") | x.startswith("S")), "both")
        .otherwise("")
    )


def unspecified(c: str | Column = "type", label: str = "Unspecified") -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.when(c != "", c), F.lit(label))


def with_composition(mm: DataFrame) -> DataFrame:
    """omid, openalex_id, type ('' -> Unspecified), oaid_count, composition; rows with an
    empty composition dropped."""
    return (
        mm.select("omid", "openalex_id", unspecified("type").alias("type"),
                  oaid_count().alias("oaid_count"), composition().alias("composition"))
        .where(F.col("composition") != "")
    )


def filter_mm(df: DataFrame, res_type: str | None = None, composition_: str | None = None,
              oaid_count_: int | None = 2) -> DataFrame:
    """Filter by BR type, composition and exact id count; any subset of the three."""
    if composition_ not in (*COMPOSITIONS, None):
        raise ValueError('composition must be one of "works", "sources", "both", or None')
    if not res_type and not composition_ and not oaid_count_:
        warnings.warn("no filter given: the whole table is returned", UserWarning)
        return df
    cond = F.lit(True)
    if res_type:
        cond = cond & (F.col("type") == res_type)
    if composition_:
        cond = cond & (F.col("composition") == composition_)
    if oaid_count_:
        cond = cond & (F.col("oaid_count") == oaid_count_)
    return df.where(cond)


def _strict_composition(c: str | Column = "openalex_id") -> Column:
    ids = oaid_list(c)
    w = F.forall(ids, lambda x: x.startswith("W"))
    s = F.forall(ids, lambda x: x.startswith("S"))
    return F.when(w & ~s, "works").when(s & ~w, "sources").otherwise("both")


def distribution_by_type(mm: DataFrame, res_type: str | None = None) -> DataFrame:
    """Rows per (type, composition) and, inside, per list length; NULL marks the totals.

    Output: type, composition, n_oaids, n. Grouping sets (type, composition, n_oaids),
    (type, composition), (type): one aggregation, no self-join.
    """
    base = mm if res_type is None else mm.where(F.col("type") == res_type)
    b = base.select("type", _strict_composition().alias("composition"),
                    F.size(oaid_list()).cast("bigint").alias("n_oaids"))
    return b.groupingSets(
        [["type", "composition", "n_oaids"], ["type", "composition"], ["type"]],
        "type", "composition", "n_oaids",
    ).agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def type_stats(mm: DataFrame) -> DataFrame:
    """Average (2 decimals), min, max of OpenAlex ids per record, per BR type."""
    n = F.size(tokens("openalex_id"))
    return mm.groupBy("type").agg(
        F.round(F.avg(n), 2).alias("avg_oaids"),
        F.min(n).cast("bigint").alias("min_oaids"),
        F.max(n).cast("bigint").alias("max_oaids"),
        F.count(F.lit(1)).cast("bigint").alias("n_records"),
    )


def histogram(mm: DataFrame) -> DataFrame:
    """Bar data: frequency per (oaid_count, type, composition) and the per-type total of the
    legend. Missing type -> 'unspecified' (as the chart cell does)."""
    base = mm.select(oaid_count().alias("oaid_count"), composition().alias("composition"),
                     unspecified("type", "unspecified").alias("type")).where(F.col("composition") != "")
    h = base.groupBy("oaid_count", "type", "composition").agg(F.count(F.lit(1)).cast("bigint").alias("frequency"))
    return h.withColumn("type_total", F.sum("frequency").over(Window.partitionBy("type")).cast("bigint"))


def api_urls(mm: DataFrame, verbose: bool = True) -> DataFrame:
    """API urls of a row: the OMID url and the list of OpenAlex urls (text only, no request)."""
    urls = F.transform(F.split(F.trim(F.col("openalex_id")), r"\s+"), lambda x: F.concat(F.lit(K.OPENALEX_API), x))
    cols = [F.concat(F.lit(K.META_API), F.col("omid")).alias("omid"), urls.alias("openalex_id")]
    if verbose:
        cols += [c for c in mm.columns if c not in ("omid", "openalex_id")]
    return mm.select(*cols)


def inverted_multi_mapped(one_to_one: DataFrame) -> DataFrame:
    """(omid, openalex_id) of 1:1 rows whose OpenAlex id is reached by more than one row."""
    pairs = one_to_one.select("omid", F.explode(tokens("openalex_id")).alias("openalex_id"))
    shared = pairs.groupBy("openalex_id").agg(F.count(F.lit(1)).alias("_k")).where(F.col("_k") > 1)
    return pairs.join(shared.select("openalex_id"), "openalex_id", "left_semi").select("omid", "openalex_id")


def venue_row_overlap(meta: DataFrame, omids: DataFrame) -> DataFrame:
    """Distinct venue OMIDs named in venue cells, how many are rows of their own, and the
    difference. One row."""
    from pidlink.functions import bracket_content

    inner = bracket_content(F.col("venue"))
    venue_omids = (
        meta.where(F.col("venue").isNotNull() & (F.col("venue") != ""))
        .select(F.explode(F.filter(tokens(inner), lambda t: t.startswith("omid:"))).alias("omid"))
        .distinct()
    )
    known = omids.select("omid").distinct().withColumn("_row", F.lit(True))
    j = venue_omids.join(known, "omid", "left")
    return j.agg(
        F.count(F.lit(1)).cast("bigint").alias("venues_in_venue_field"),
        F.count(F.col("_row")).cast("bigint").alias("venues_as_rows"),
    ).withColumn("difference", F.col("venues_in_venue_field") - F.col("venues_as_rows"))


def meta_coverage(meta: DataFrame) -> DataFrame:
    """Meta rows; rows with more than one id token; of those, rows with a scheme both
    catalogues support; non-mappable rows; mappable percentage (2 decimals)."""
    tok = tokens("id")
    supported = F.exists(tok, lambda t: F.substring_index(t, ":", 1).isin(*K.MUTUALLY_SUPPORTED))
    multi = F.size(tok) > 1
    agg = meta.agg(
        F.count(F.lit(1)).cast("bigint").alias("n_rows"),
        F.count(F.when(multi, True)).cast("bigint").alias("n_with_external_pids"),
        F.count(F.when(multi & supported, True)).cast("bigint").alias("n_with_supported_pids"),
    )
    return agg.select(
        "n_rows", "n_with_external_pids", "n_with_supported_pids",
        (F.col("n_rows") - F.col("n_with_supported_pids")).alias("n_non_mappable"),
        F.round(F.col("n_with_supported_pids") * 100.0 / F.col("n_rows"), 2).alias("pct_mappable"),
    )


def openalex_coverage(works: DataFrame, sources: DataFrame) -> DataFrame:
    """Works and Sources totals, how many have at least one PID the other catalogue
    supports (the mapping's own extractors decide), the percentage; plus a total row.
    One aggregation with grouping sets (per entity, and all)."""
    flags = works.where(F.col("id").isNotNull()).select(
        F.lit("works").alias("entity"), (F.size(P.work_pid_array(works)) > 0).alias("has_pid")
    ).unionByName(sources.where(F.col("id").isNotNull()).select(
        F.lit("sources").alias("entity"), (F.size(P.source_pid_array(sources)) > 0).alias("has_pid")))
    agg = flags.groupingSets([["entity"], []], "entity").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_records"),
        F.count(F.when(F.col("has_pid"), True)).cast("bigint").alias("n_with_pid"))
    return agg.select(
        F.coalesce(F.col("entity"), F.lit("total")).alias("entity"), "n_records", "n_with_pid",
        F.round(F.col("n_with_pid") * 100.0 / F.col("n_records"), 2).alias("pct_with_pid"),
    )


def outcome_counts(result: DataFrame) -> DataFrame:
    """Rows per mapping outcome."""
    return result.groupBy("outcome").agg(F.count(F.lit(1)).cast("bigint").alias("n"))

