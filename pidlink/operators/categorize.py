"""Why does one Meta record match several OpenAlex records? Category per multi-mapped row.

The rules are a first-match scan over the row's OpenAlex ids in list order. As a set
computation: each position gets its own event (D, B, E from the Work's DOI); one
aggregation per row takes the earliest event (ties at a position in the order A, D, B, E),
where 'A' is the first position holding a PID value already seen earlier (found from the
row's own sorted (value, position) pairs). Rows without any event fall to the end-of-list
rule (F, C or non classified). Sources: 'A' when two positions share an ISSN. Lists are
the sorted id lists of the mapping.

Shuffles: the one join of exploded positions with the Works' attributes (one row per Work) and
the group by row. Every group is bounded by the size of one row's id list, which
already exists as one row.

Many rows may have one id list (the records of one ISSN). ``Listed`` holds each list once: lists are
then exploded and classified once each, and a row meets its list only in the last join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pidlink.functions import constants as K
from pidlink.functions import non_blank, strip_prefix, tokens

ROW_KEY = ["omid", "openalex_id", "type"]
NON_CLASSIFIED = "non classified"


@dataclass
class Listed:
    """Multi-mapped records with each id list once: ``rows`` (omid, type, _list; rows of other lists do
    not count) and ``lists`` (_list, openalex_id; one row per _list)."""

    rows: DataFrame
    lists: DataFrame


def listed(mm: DataFrame) -> Listed:
    """A multi-mapped table with each id list once. A list's key is its text, or the SHA-256 of a long one."""
    key = F.when(F.length("openalex_id") > 64, F.sha2("openalex_id", 256)).otherwise(F.col("openalex_id")).alias("_list")
    return Listed(mm.select("omid", "type", key), mm.select(key, "openalex_id").distinct())


def _to_classify(mm: DataFrame | Listed, entity: str) -> tuple[list[str], DataFrame]:
    """What is classified once, of one entity case, with its id list: each list, or each distinct row
    with its multiplicity; and the columns that name it."""
    if isinstance(mm, Listed):
        keys, rows = ["_list"], mm.lists
    else:
        keys, rows = [*ROW_KEY, "_n"], mm.select(*ROW_KEY).groupBy(*ROW_KEY).agg(F.count(F.lit(1)).alias("_n"))
    found = (
        F.when(F.col("openalex_id").startswith("W"), "works").when(F.col("openalex_id").startswith("S"), "sources")
    )
    return keys, rows.where(found == entity).select(*keys, tokens("openalex_id").alias("_ids"))


def _positions(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.select(
        *keys, F.size("_ids").alias("n_ids"),
        F.posexplode("_ids").alias("pos", "oaid"),
    ).withColumn("oa_uri", F.concat(F.lit(K.OPENALEX_URI), F.col("oaid")))


def _per_row(mm: DataFrame | Listed, categories: DataFrame) -> DataFrame:
    """omid, openalex_id, type, category: one row per input row."""
    if isinstance(mm, Listed):
        return mm.rows.join(mm.lists.join(categories, "_list"), "_list").select(*ROW_KEY, "category")
    return categories.select(
        *ROW_KEY, "category", F.explode(F.array_repeat(F.lit(1), F.col("_n").cast("int"))).alias("_copy"),
    ).drop("_copy")


def primary_location_version(primary_locations: DataFrame) -> DataFrame:
    """One version per Work: the first row in (work_id, source_id) key order."""
    return primary_locations.groupBy("work_id").agg(F.min_by("version", "source_id").alias("version"))


def joined_attributes(works_ids: DataFrame, works: DataFrame, primary_locations: DataFrame) -> DataFrame:
    """The attributes of each Work from the three loaded tables, in one row (as
    ``flatten.work_attributes`` gives it from the records)."""
    return (
        works_ids.select("work_id", "openalex", "doi", "pmid", "pmcid")
        .join(works.select(F.col("id").alias("work_id"), F.col("type").alias("work_type")), "work_id", "full")
        .join(primary_location_version(primary_locations), "work_id", "full")
    )


def preprint_clues(split_clues: bool = False) -> list[str]:
    """The category-E clues. One entry fuses two clues with a blank, so it can never match
    (kept for parity); ``split_clues=True`` uses its two parts as separate clues."""
    if not split_clues:
        return list(K.PREPRINT_STRING_CLUES)
    return [part for clue in K.PREPRINT_STRING_CLUES for part in clue.split()]


def doi_events(doi: Column, version: Column, split_clues: bool = False) -> tuple[Column, Column, Column]:
    """(normalised DOI, DOI prefix, event code D/B/E or NULL) of one position."""
    dn = strip_prefix(F.lower(doi), K.DOI_URI)
    prefix = F.substring_index(dn, "/", 1)
    suffix = dn.substr(F.length(prefix) + 1, F.length(dn) + 1)
    is_d = dn.rlike(K.VERSION_PATTERN)
    is_b = prefix.isin(*K.PREPRINT_DOI_PREFIXES) & version.isin(*K.REPOSITORY_VERSIONS)
    is_e = F.lit(False)
    for clue in preprint_clues(split_clues):
        is_e = is_e | suffix.startswith(clue)
    has = non_blank(doi)
    code = F.when(has & is_d, "D").when(has & is_b, "B").when(has & is_e, "E")
    return dn, prefix, code


def _rank(code: Column) -> Column:
    """Order of the checks at one position: A, then D, B, E."""
    return F.when(code == "A", 0).when(code == "D", 1).when(code == "B", 2).otherwise(3)


def categorize_works(mm: DataFrame, works_ids: DataFrame, works: DataFrame, primary_locations: DataFrame,
                     split_clues: bool = False) -> DataFrame:
    """Category of every multi-mapped row whose first id is a Work, from the analysis tables.

    Output: omid, openalex_id, type, category (one row per input row).
    """
    return categorize_by_attributes(mm, joined_attributes(works_ids, works, primary_locations), split_clues)


def categorize_by_attributes(mm: DataFrame | Listed, attributes: DataFrame, split_clues: bool = False) -> DataFrame:
    """As ``categorize_works``, from one row per Work (``flatten.work_attributes``): the positions
    of all id lists meet the Works in one join."""
    keys, rows = _to_classify(mm, "works")
    pos = _positions(rows, keys).join(attributes.withColumnRenamed("work_id", "oa_uri"), "oa_uri", "left")
    _, prefix, code = doi_events(F.col("doi"), F.col("version"), split_clues)
    has_doi = non_blank(F.col("doi"))
    per_pos = pos.select(
        *keys, "n_ids", "pos",
        F.array_distinct(F.filter(F.array("openalex", "doi", "pmid", "pmcid"), lambda v: non_blank(v))).alias("_vals"),
        has_doi.alias("has_doi"),
        F.when(has_doi, prefix).alias("doi_prefix"),
        (has_doi & F.col("work_type").isin(*K.MINOR_WORK_TYPES)).alias("minor_type"),
        code.alias("code"),
    )

    # earliest D/B/E event as one long (position, then check order): no sort needed
    ev = F.when(F.col("code").isNotNull(), F.col("pos").cast("long") * 4 + _rank(F.col("code")))
    summary = per_pos.groupBy(*keys, "n_ids").agg(
        F.min(ev).alias("_ev"),
        F.collect_list(F.struct("pos", "_vals")).alias("_pv"),
        F.max(F.when(F.col("pos") == F.col("n_ids") - 1, F.col("has_doi"))).alias("last_has_doi"),
        (F.min("doi_prefix") == F.max("doi_prefix")).alias("one_prefix"),
        F.max("minor_type").alias("any_minor"),
    )
    # 'A': a PID value already seen at an earlier position. Sorting the record's own
    # (value, position) pairs puts every repeat right after an earlier occurrence; the
    # earliest such repeat is the position where the scan would have stopped. The sorted
    # pairs are a column of their own, compared with their own tail, so the work per record
    # is one sort (an array built inside a lambda would be rebuilt for every element).
    pairs = F.array_sort(F.flatten(F.transform(
        F.col("_pv"), lambda p: F.transform(p.getField("_vals"), lambda v: F.struct(v.alias("v"), p.getField("pos").alias("p"))))))
    summary = summary.withColumn("_pairs", pairs)
    rest = F.greatest(F.size("_pairs") - 1, F.lit(0))
    repeats = F.zip_with(F.slice("_pairs", F.lit(1), rest), F.slice("_pairs", F.lit(2), rest),
                         lambda x, y: F.when(x.getField("v") == y.getField("v"), y.getField("p")))
    summary = summary.withColumn("first_event", F.least(F.col("_ev"), F.array_min(repeats).cast("long") * 4))
    same_issuer = F.coalesce(F.col("last_has_doi"), F.lit(False)) & F.coalesce(F.col("one_prefix"), F.lit(False))
    codes = F.array(*[F.lit(c) for c in ("A", "D", "B", "E")])
    category = (
        F.when(F.col("first_event").isNotNull(),
               F.element_at(codes, (F.col("first_event") % 4).cast("int") + 1))
        .when(same_issuer & F.coalesce(F.col("any_minor"), F.lit(False)), "F")
        .when(same_issuer & (F.col("n_ids") == 2), "C")
        .otherwise(NON_CLASSIFIED)
    )
    return _per_row(mm, summary.select(*keys, category.alias("category")))


def issn_list(issn: Column, is_text: bool) -> Column:
    """ISSN list of a sources_ids row (JSON text in the flat table, or already an array)."""
    arr = F.from_json(issn, "array<string>") if is_text else issn
    return F.coalesce(arr, F.array().cast("array<string>"))


def categorize_sources(mm: DataFrame | Listed, sources_ids: DataFrame) -> DataFrame:
    """Category of every multi-mapped row whose first id is a Source: 'A' when two of its
    Sources share an ISSN (Wikidata and ISSN-L ignored), else non classified."""
    keys, rows = _to_classify(mm, "sources")
    is_text = dict(sources_ids.dtypes).get("issn") == "string"
    sids = sources_ids.select(F.col("source_id").alias("oa_uri"), issn_list(F.col("issn"), is_text).alias("_issn"))
    pos = _positions(rows, keys).join(sids, "oa_uri", "left")
    # the ISSNs of each position once; a value left over after removing repeats is shared
    own = F.array_distinct(F.filter("_issn", lambda v: non_blank(v)))
    per_list = pos.groupBy(*keys).agg(F.flatten(F.collect_list(F.coalesce(own, F.array().cast("array<string>")))).alias("_v"))
    category = F.when(F.size("_v") > F.size(F.array_distinct("_v")), "A").otherwise(NON_CLASSIFIED)
    return _per_row(mm, per_list.select(*keys, category.alias("category")))


def category_counts(works_cats: DataFrame, sources_cats: DataFrame) -> DataFrame:
    """entity, type, category, n (bigint)."""
    w = works_cats.select(F.lit("works").alias("entity"), "type", "category")
    s = sources_cats.select(F.lit("sources").alias("entity"), "type", "category")
    return w.unionByName(s).groupBy("entity", "type", "category").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def category_pivot(counts: DataFrame) -> DataFrame:
    """BR type x category, missing = 0 (the category list is fixed, so no extra pass)."""
    cats = list(K.WORK_CATEGORIES)
    p = counts.groupBy("entity", "type").pivot("category", cats).agg(F.sum("n"))
    return p.select(
        "entity", "type",
        *[F.coalesce(F.col(f"`{c}`"), F.lit(0)).cast("bigint").alias(c.replace(" ", "_")) for c in cats],
    )


def nested_counts_json(counts: DataFrame) -> DataFrame:
    """One row, one column ``json``: {entity: {type: {category: n}}} (a bounded, tiny table)."""
    by_type = counts.groupBy("entity", "type").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("category", "n")))).alias("m"))
    by_entity = by_type.groupBy("entity").agg(F.map_from_entries(F.collect_list(F.struct("type", "m"))).alias("m"))
    return by_entity.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("entity", "m")))).alias("json"))
