"""Mapping of Meta records to OpenAlex records through shared PIDs.

Plan: choose the PIDs to look up (one tier) and sort them: records with the same PID set map to the
same ids, so each distinct set is resolved once and the list joined back last.

* The key of a record with one PID (nearly all) is that PID, its list the PID's row of ``pid_lists``.
* The distinct sets of several PIDs are exploded, joined with ``pid_lists``, and their lists united
  per set; such a record's key is its set.

Records then join the lists of PIDs and sets by their key. A record crosses a shuffle once, on its key, without any id list; lists move once per PID and once
per distinct set. A PID shared by very many records is a hot key of the join's left side only:
both sides are plain shuffles when ``pid_lists`` is stored (as ``run_mapping`` makes it), and AQE's
skew join splits the hot partition at run time. Records without a PID get keys of their own, which
match nothing, so they do not meet in one partition either.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pidlink.functions import tokens
from pidlink.operators.extract import has_openalex_id

MAPPED = "mapped"
MULTI_MAPPED = "multi_mapped"
UNMAPPED = "unmapped"


def lookup_pids(ids: str | Column = "ids") -> Column:
    """PIDs of a record to look up, one tier only (no fallback between tiers).

    Any ISSN -> only ISSNs; else any DOI -> only DOIs; else PMID, PMCID and Wikidata
    together. ISBN and other schemes are never looked up.
    """
    tok = tokens(ids)
    return (
        F.when(F.exists(tok, lambda t: t.startswith("issn:")), F.filter(tok, lambda t: t.startswith("issn")))
        .when(F.exists(tok, lambda t: t.startswith("doi:")), F.filter(tok, lambda t: t.startswith("doi:")))
        .otherwise(
            F.filter(
                tok,
                lambda t: t.startswith("pmid:") | t.startswith("pmcid:") | t.startswith("wikidata:"),
            )
        )
    )


def pid_lists(index: DataFrame) -> DataFrame:
    """The index with one row per PID: pid, and ``oaids``, the sorted distinct OpenAlex ids that
    hold it. A list is as long as the ids that any record with this PID maps to, which the result
    of that record lists in one row anyway."""
    # the filter is what an inner join would add: both joins then share one exchange
    held = index.where(F.col("supported_id").isNotNull())
    return held.groupBy(F.col("supported_id").alias("pid")).agg(F.array_sort(F.collect_set("openalex_id")).alias("oaids"))


def keyed_records(entities: DataFrame, columns: list[str]) -> DataFrame:
    """Records with their lookup key: the one PID; several sorted PIDs, joined by blanks, which no PID
    holds; or, without any, a key that no PID equals."""
    if "_key" in entities.columns:
        return entities.select(*columns, "_key")
    pids = entities.select(*columns, F.array_sort(F.array_distinct(lookup_pids("ids"))).alias("_pids"))
    none = F.concat(F.lit("-"), F.col("omid"))
    return pids.select(*columns, F.when(F.size("_pids") == 0, none).otherwise(F.array_join("_pids", " ")).alias("_key"))


def _several() -> Column:
    return F.col("_key").contains(" ")


def _exploded_sets(records: DataFrame) -> DataFrame:
    """Each distinct set of several PIDs once: (_key, pid)."""
    return records.where(_several()).select("_key").distinct().select("_key", F.explode(F.split("_key", " ")).alias("pid"))


def _lists_of_pids(lists: DataFrame) -> DataFrame:
    return lists.select(F.col("pid").alias("_key"), "oaids")


def _lists_of_sets(records: DataFrame, lists: DataFrame) -> DataFrame:
    return _exploded_sets(records).join(lists, "pid").groupBy("_key").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("oaids")))).alias("oaids"))


def multi_mapped_lists(records: DataFrame, index: DataFrame) -> DataFrame:
    """The id lists of the multi-mapped records, each once: (_key, openalex_id text). ``records`` are those
    of ``keyed_records``; the ones with such a key are the rows of ``multi_mapped(map_records(...))``."""
    lists = index if "oaids" in index.columns else pid_lists(index)
    several = _lists_of_pids(lists).unionByName(_lists_of_sets(records, lists)).where(F.size("oaids") > 1)
    return several.join(records.select("_key"), "_key", "left_semi").select("_key", F.array_join("oaids", " ").alias("openalex_id"))


def map_records(
    entities: DataFrame,
    index: DataFrame,
    *,
    type_field: bool = True,
    all_rows: bool = True,
    index_in_place: bool = False,
) -> DataFrame:
    """All records with their sorted distinct OpenAlex ids and outcome.

    ``index`` is the PID index, or its stored ``pid_lists``. Input: (omid, ids[, type]), or records
    of ``keyed_records``. Output: omid, [type,] openalex_ids (array, sorted), n_openalex (bigint), outcome
    ('mapped' | 'multi_mapped' | 'unmapped'), one row per input row. ``index_in_place`` is for an index
    that is stored in buckets of its PIDs: records with one PID then join it by themselves, where it
    lies, and the others join the sets; the records are read once more for that.
    """
    if not all_rows:
        entities = entities.where(~has_openalex_id("ids"))
    columns = ["omid"] + (["type"] if type_field else [])
    lists = index if "oaids" in index.columns else pid_lists(index)
    records = keyed_records(entities, columns)
    of_sets, of_pids = _lists_of_sets(records, lists), _lists_of_pids(lists)

    def matched(some: DataFrame, found: DataFrame) -> DataFrame:
        # the number is taken on the side that holds each list once
        found = found.select("_key", "oaids", F.size("oaids").cast("bigint").alias("_n"))
        return some.join(found, "_key", "left").select(*columns, "oaids", "_n")

    if index_in_place:
        found = matched(records.where(~_several()), of_pids).unionByName(matched(records.where(_several()), of_sets))
    else:
        found = matched(records, of_pids.unionByName(of_sets))
    n = F.coalesce("_n", F.lit(0).cast("bigint"))
    return found.select(
        *columns,
        F.coalesce("oaids", F.array().cast("array<string>")).alias("openalex_ids"),
        n.alias("n_openalex"),
        F.when(n == 0, UNMAPPED).when(n == 1, MAPPED).otherwise(MULTI_MAPPED).alias("outcome"),
    )


def unmapped_records(entities: DataFrame, index: DataFrame, *, type_field: bool = True, all_rows: bool = True) -> DataFrame:
    """The unmapped records alone: omid[, type]. Like ``unmapped(map_records(...))``, by an anti join
    with the PIDs of the index and the sets that hold one: no list of OpenAlex ids is made."""
    if not all_rows:
        entities = entities.where(~has_openalex_id("ids"))
    columns = ["omid"] + (["type"] if type_field else [])
    known = index.select(F.col("pid" if "oaids" in index.columns else "supported_id").alias("pid"))
    records = keyed_records(entities, columns)
    of_sets = _exploded_sets(records).join(known, "pid", "left_semi").select("_key").distinct()
    return records.join(known.select(F.col("pid").alias("_key")).unionByName(of_sets), "_key", "left_anti").select(*columns)


def openalex_id_text(df: DataFrame) -> Column:
    """Space-joined id list, the text form of the output files."""
    return F.array_join("openalex_ids", " ")


def mapped(result: DataFrame) -> DataFrame:
    """Records matched to exactly one OpenAlex id: omid, openalex_id[, type]."""
    cols = ["omid", openalex_id_text(result).alias("openalex_id")] + (["type"] if "type" in result.columns else [])
    return result.where(F.col("outcome") == MAPPED).select(*cols)


def multi_mapped(result: DataFrame) -> DataFrame:
    """Records matched to more than one OpenAlex id: omid, openalex_id[, type]."""
    cols = ["omid", openalex_id_text(result).alias("openalex_id")] + (["type"] if "type" in result.columns else [])
    return result.where(F.col("outcome") == MULTI_MAPPED).select(*cols)


def unmapped(result: DataFrame) -> DataFrame:
    """Records matched to nothing: omid[, type]."""
    cols = ["omid"] + (["type"] if "type" in result.columns else [])
    return result.where(F.col("outcome") == UNMAPPED).select(*cols)
