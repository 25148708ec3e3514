"""Flatten nested OpenAlex records into relational tables, and keyed keep-last loading.

Every table is a projection or an ``explode`` of the record DataFrame (narrow, no
shuffle); columns the input schema lacks come out as typed NULLs, and unknown JSON keys
are ignored. The only shuffles are the keep-first of Sources (first record per id wins)
and the keyed keep-last load (``max_by`` per primary key: a partial aggregate, so a hot
key is combined map-side instead of landing whole in one task).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from pidlink.functions import constants as K
from pidlink.functions import non_blank, strip_prefix, tokens

# primary keys of the analysis tables (keep-last load)
PRIMARY_KEYS = {
    "sources": ["id"],
    "sources_counts_by_year": ["source_id", "year"],
    "sources_ids": ["source_id"],
    "works": ["id"],
    "works_primary_locations": ["work_id", "source_id"],
    "works_locations": ["work_id", "source_id"],
    "works_best_oa_locations": ["work_id", "source_id"],
    "works_authorships": ["work_id", "author_position"],
    "works_biblio": ["work_id"],
    "works_concepts": ["work_id", "concept_id"],
    "works_ids": ["work_id"],
    "works_mesh": ["work_id", "descriptor_ui"],
    "works_open_access": ["work_id"],
    "works_referenced_works": ["work_id", "referenced_work_id"],
    "works_related_works": ["work_id", "related_work_id"],
}

# ------------------------------------------------------------------ helpers


def _lookup_type(dt: DataType, path: list[str]) -> DataType | None:
    for p in path:
        if isinstance(dt, StructType) and p in dt.fieldNames():
            dt = dt[p].dataType
        else:
            return None
    return dt


def field(df_or_type, path: str, cast: str | None = None) -> Column:
    """Column ``a.b.c`` of a DataFrame (or schema), NULL when the schema lacks it."""
    root_type = df_or_type.schema if isinstance(df_or_type, DataFrame) else df_or_type
    parts = path.split(".")
    if _lookup_type(root_type, parts) is None:
        return F.lit(None).cast(cast or "string")
    c = F.col(parts[0])
    for p in parts[1:]:
        c = c.getField(p)
    return c.cast(cast) if cast else c


def _json_text(c: Column, dt: DataType | None) -> Column:
    """JSON text of a list/map value; kept as is when already text."""
    if dt is None:
        return F.lit(None).cast("string")
    if isinstance(dt, (ArrayType, MapType, StructType)):
        return F.to_json(c)
    return c.cast("string")


def _truthy_struct(c: Column, dt: DataType | None) -> Column:
    """A nested object is present. OpenAlex writes objects such as ``biblio`` with all keys
    and NULL values, which count as present; after parsing with a schema an empty ``{}``
    reads the same way and is kept too (the one case that differs from a dict test)."""
    if not isinstance(dt, StructType):
        return F.lit(False)
    return c.isNotNull()


def _elem_type(df: DataFrame, path: str) -> DataType | None:
    dt = _lookup_type(df.schema, path.split("."))
    return dt.elementType if isinstance(dt, ArrayType) else None


def _sub(elem_type: DataType | None, base: Column, path: str, cast: str | None = None) -> Column:
    if elem_type is None or _lookup_type(elem_type, path.split(".")) is None:
        return F.lit(None).cast(cast or "string")
    c = base
    for p in path.split("."):
        c = c.getField(p)
    return c.cast(cast) if cast else c


# ------------------------------------------------------------ keep-first / keep-last


def keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the one loaded last (greatest ``order``), like a keyed upsert.

    ``max_by`` is a partial aggregate: a key holding many rows is combined in each map
    task before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    ordv = F.struct(*[F.col(c) for c in order])
    return (
        df.groupBy(*keys)
        .agg(F.max_by(F.struct(*[F.col(c) for c in rest]), ordv).alias("_row"))
        .select(*keys, *[F.col("_row").getField(c).alias(c) for c in rest])
    )


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the one loaded first (least ``order``)."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    ordv = F.struct(*[F.col(c) for c in order])
    return (
        df.groupBy(*keys)
        .agg(F.min_by(F.struct(*[F.col(c) for c in rest]), ordv).alias("_row"))
        .select(*keys, *[F.col("_row").getField(c).alias(c) for c in rest])
    )


ORD = "_ord"


def load_order(df: DataFrame, order_col: str | None) -> tuple[DataFrame, str]:
    """The load-order column: the caller's, else the reader's ``_ord`` (file, position).
    Without one the "first" or "last" row of a key would not be fixed under a retry."""
    for col in (order_col, ORD):
        if col and col in df.columns:
            return df, col
    raise ValueError(f"a keyed load needs an order column: pass one, or read with {ORD}")


def _ord(df: DataFrame) -> list[Column]:
    """The record's load order, carried into every flattened row when the input has one."""
    return [F.col(ORD)] if ORD in df.columns else []


def _ord_at(df: DataFrame, *positions: str) -> list[Column]:
    """Load order of an exploded element: (record order, position(s) in its lists)."""
    if ORD not in df.columns:
        return []
    return [F.struct(F.col(ORD).alias("r"), *[F.col(p) for p in positions]).alias(ORD)]


# ------------------------------------------------------------------ multi-mapped ids


def mm_oaids(mm: DataFrame) -> DataFrame:
    """Distinct OpenAlex ids of the multi-mapped table, with their entity (works / sources)."""
    ids = mm.select(F.explode(tokens("openalex_id")).alias("openalex_id")).distinct()
    entity = F.when(F.col("openalex_id").startswith("W"), "works").when(F.col("openalex_id").startswith("S"), "sources")
    return ids.select("openalex_id", entity.alias("entity")).where(F.col("entity").isNotNull())


def select_records(records: DataFrame, keys: DataFrame, key_col: str = "openalex_id") -> DataFrame:
    """Full records whose id (URL prefix stripped) is in ``keys``: a left-semi join.

    Spark broadcasts ``keys`` only when its measured size is under the broadcast
    threshold (AQE re-plans at run time); otherwise it is a shuffled semi join.
    """
    k = keys.select(F.col(key_col).alias("_key"))
    return records.join(k, strip_prefix(F.col("id"), K.OPENALEX_URI) == F.col("_key"), "left_semi")


# ------------------------------------------------------------------ Sources


def flatten_sources(sources: DataFrame, order_col: str | None = None) -> dict[str, DataFrame]:
    """sources, sources_ids, sources_counts_by_year; first record per id wins."""
    src, ord_col = load_order(sources.where(non_blank(F.col("id"))), order_col)
    first = keep_first(src, ["id"], [ord_col])
    s = first.schema
    issn_t = _lookup_type(s, ["issn"])
    sources_tbl = first.select(
        "id", field(s, "issn_l"),
        F.coalesce(_json_text(F.col("issn") if issn_t else F.lit(None), issn_t), F.lit("null")).alias("issn"),
        *[field(s, c).alias(c) for c in ["display_name", "publisher"]],
        field(s, "works_count", cast="bigint").alias("works_count"),
        field(s, "cited_by_count", cast="bigint").alias("cited_by_count"),
        field(s, "is_oa", cast="boolean").alias("is_oa"),
        field(s, "is_in_doaj", cast="boolean").alias("is_in_doaj"),
        *[field(s, c).alias(c) for c in ["homepage_url", "works_api_url", "updated_date", "type"]],
    )
    ids_t = _lookup_type(s, ["ids"])
    ids_issn_t = _lookup_type(s, ["ids", "issn"])
    sources_ids = first.where(_truthy_struct(F.col("ids"), ids_t) if ids_t else F.lit(False)).select(
        F.col("id").alias("source_id"),
        field(s, "ids.openalex").alias("openalex"),
        field(s, "ids.issn_l").alias("issn_l"),
        F.coalesce(_json_text(field(s, "ids.issn") if ids_issn_t else F.lit(None), ids_issn_t), F.lit("null")).alias("issn"),
        field(s, "ids.mag", cast="string").alias("mag"),
        field(s, "ids.wikidata").alias("wikidata"),
        field(s, "ids.fatcat").alias("fatcat"),
    )
    et = _elem_type(first, "counts_by_year")
    cby = F.col("counts_by_year") if et is not None else F.array()
    keep_pos = [F.col("_p").alias(ORD)] if ORD in sources.columns else []
    counts = first.select(F.col("id").alias("source_id"), F.posexplode(cby).alias("_p", "c")).select(
        "source_id", *keep_pos,
        _sub(et, F.col("c"), "year", "int").alias("year"),
        _sub(et, F.col("c"), "works_count", "bigint").alias("works_count"),
        _sub(et, F.col("c"), "cited_by_count", "bigint").alias("cited_by_count"),
        _sub(et, F.col("c"), "oa_works_count", "bigint").alias("oa_works_count"),
    )
    return {"sources": sources_tbl, "sources_ids": sources_ids, "sources_counts_by_year": counts}


# ------------------------------------------------------------------ Works


def works_table(works: DataFrame) -> DataFrame:
    s = works.schema
    abstract_t = _lookup_type(s, ["abstract_inverted_index"])
    return works.where(non_blank(F.col("id"))).select(
        "id",
        *[field(s, c).alias(c) for c in ["doi", "title", "display_name"]],
        field(s, "publication_year", cast="int").alias("publication_year"),
        field(s, "publication_date", cast="string").alias("publication_date"),
        field(s, "type").alias("type"),
        field(s, "cited_by_count", cast="bigint").alias("cited_by_count"),
        field(s, "is_retracted", cast="boolean").alias("is_retracted"),
        field(s, "is_paratext", cast="boolean").alias("is_paratext"),
        field(s, "cited_by_api_url").alias("cited_by_api_url"),
        _json_text(F.col("abstract_inverted_index") if abstract_t else F.lit(None), abstract_t).alias(
            "abstract_inverted_index"),
        field(s, "language").alias("language"),
        *_ord(works),
    )


def _location_rows(work_id: Column, loc: Column, loc_type: DataType | None) -> list[Column]:
    return [
        work_id.alias("work_id"),
        _sub(loc_type, loc, "source.id").alias("source_id"),
        _sub(loc_type, loc, "landing_page_url").alias("landing_page_url"),
        _sub(loc_type, loc, "pdf_url").alias("pdf_url"),
        _sub(loc_type, loc, "is_oa", "boolean").alias("is_oa"),
        _sub(loc_type, loc, "version").alias("version"),
        _sub(loc_type, loc, "license").alias("license"),
    ]


def _single_location(works: DataFrame, name: str) -> DataFrame:
    lt = _lookup_type(works.schema, [name])
    if lt is None:
        return works.limit(0).select(*_location_rows(F.col("id"), F.lit(None), None), *_ord(works))
    return (
        works.where(non_blank(F.col("id")))
        .select(*_location_rows(F.col("id"), F.col(name), lt), *_ord(works))
        .where(non_blank(F.col("source_id")))
    )


def works_primary_locations(works: DataFrame) -> DataFrame:
    """Primary location of a Work, only when its source has an id."""
    return _single_location(works, "primary_location")


def works_best_oa_locations(works: DataFrame) -> DataFrame:
    return _single_location(works, "best_oa_location")


def works_locations(works: DataFrame) -> DataFrame:
    """One row per location having a source id."""
    et = _elem_type(works, "locations")
    arr = F.col("locations") if et is not None else F.array()
    return (
        works.where(non_blank(F.col("id")))
        .select(F.col("id").alias("_wid"), *_ord(works), F.posexplode(arr).alias("_p", "_loc"))
        .select(*_location_rows(F.col("_wid"), F.col("_loc"), et), *_ord_at(works, "_p"))
        .where(non_blank(F.col("source_id")))
    )


def works_authorships(works: DataFrame) -> DataFrame:
    """Author x institution rows. Authors without id are skipped; NULL institution ids are
    dropped, and an author left with none gives one row with a NULL institution."""
    et = _elem_type(works, "authorships")
    arr = F.col("authorships") if et is not None else F.array()
    a = F.col("_a")
    inst_t = _lookup_type(et, ["institutions"]) if et is not None else None
    if isinstance(inst_t, ArrayType):
        inst_ids = F.filter(
            F.transform(F.coalesce(a.getField("institutions"), F.array()), lambda i: i.getField("id")),
            lambda x: non_blank(x),
        )
    else:
        inst_ids = F.array().cast("array<string>")
    rows = (
        works.where(non_blank(F.col("id")))
        .select(F.col("id").alias("work_id"), *_ord(works), F.posexplode(arr).alias("_p", "_a"))
        .where(non_blank(_sub(et, a, "author.id")))
        .select(
            "work_id", *_ord(works), "_p",
            _sub(et, a, "author_position").alias("author_position"),
            _sub(et, a, "author.id").alias("author_id"),
            F.posexplode_outer(inst_ids).alias("_q", "institution_id"),
            _sub(et, a, "raw_affiliation_string").alias("raw_affiliation_string"),
        )
    )
    return rows.select("work_id", "author_position", "author_id", "institution_id", "raw_affiliation_string",
                       *_ord_at(works, "_p", "_q"))


def _single_object(works: DataFrame, name: str, cols: list[tuple[str, str | None]]) -> DataFrame:
    t = _lookup_type(works.schema, [name])
    base = works.where(non_blank(F.col("id")))
    cond = _truthy_struct(F.col(name), t) if t is not None else F.lit(False)
    return base.where(cond).select(
        F.col("id").alias("work_id"),
        *[(_sub(t, F.col(name), c, cast) if t is not None else F.lit(None).cast(cast or "string")).alias(c)
          for c, cast in cols],
        *_ord(works),
    )


def works_biblio(works: DataFrame) -> DataFrame:
    return _single_object(works, "biblio", [("volume", "string"), ("issue", "string"),
                                             ("first_page", "string"), ("last_page", "string")])


def works_ids(works: DataFrame) -> DataFrame:
    return _single_object(works, "ids", [("openalex", None), ("doi", None), ("mag", "string"),
                                          ("pmid", None), ("pmcid", None)])


def works_open_access(works: DataFrame) -> DataFrame:
    return _single_object(works, "open_access", [("is_oa", "boolean"), ("oa_status", None), ("oa_url", None),
                                                  ("any_repository_has_fulltext", "boolean")])


def _exploded(works: DataFrame, name: str) -> tuple[DataFrame, DataType | None]:
    et = _elem_type(works, name)
    arr = F.col(name) if et is not None else F.array()
    df = works.where(non_blank(F.col("id"))).select(F.col("id").alias("work_id"), *_ord(works),
                                                    F.posexplode(arr).alias("_p", "_e"))
    return df.select("work_id", "_e", *_ord_at(works, "_p")), et


def works_concepts(works: DataFrame) -> DataFrame:
    """Concepts having an id."""
    df, et = _exploded(works, "concepts")
    e = F.col("_e")
    return df.where(non_blank(_sub(et, e, "id"))).select(
        "work_id", _sub(et, e, "id").alias("concept_id"), _sub(et, e, "score", "double").alias("score"), *_ord(df))


def works_mesh(works: DataFrame) -> DataFrame:
    df, et = _exploded(works, "mesh")
    e = F.col("_e")
    return df.select(
        "work_id",
        *[_sub(et, e, c).alias(c) for c in ["descriptor_ui", "descriptor_name", "qualifier_ui", "qualifier_name"]],
        _sub(et, e, "is_major_topic", "boolean").alias("is_major_topic"),
        *_ord(df),
    )


def _work_links(works: DataFrame, name: str, out: str) -> DataFrame:
    df, _ = _exploded(works, name)
    return df.where(non_blank(F.col("_e").cast("string"))).select(
        "work_id", F.col("_e").cast("string").alias(out), *_ord(df))


def works_referenced_works(works: DataFrame) -> DataFrame:
    """Referenced works; blank entries skipped."""
    return _work_links(works, "referenced_works", "referenced_work_id")


def works_related_works(works: DataFrame) -> DataFrame:
    return _work_links(works, "related_works", "related_work_id")


def flatten_works(works: DataFrame) -> dict[str, DataFrame]:
    """The twelve Work tables (no de-duplication at this step)."""
    return {
        "works": works_table(works),
        "works_primary_locations": works_primary_locations(works),
        "works_locations": works_locations(works),
        "works_best_oa_locations": works_best_oa_locations(works),
        "works_authorships": works_authorships(works),
        "works_biblio": works_biblio(works),
        "works_concepts": works_concepts(works),
        "works_ids": works_ids(works),
        "works_mesh": works_mesh(works),
        "works_open_access": works_open_access(works),
        "works_referenced_works": works_referenced_works(works),
        "works_related_works": works_related_works(works),
    }


def work_attributes(works: DataFrame) -> DataFrame:
    """One row per Work with what the categories read of its three tables: work_id, openalex, doi,
    pmid, pmcid, work_type, version.

    The same values as the keyed loads of ``works_ids``, ``works`` and ``works_primary_locations``
    give, a Work that is there several times included: the ids and the type are each of the last
    record that has them, the version is the last one at the first of the Work's primary sources.
    Two partial aggregates: per (Work, source), then per Work.
    """
    works, order = load_order(works.where(non_blank(F.col("id"))), None)
    s = works.schema
    ids_t, loc_t = _lookup_type(s, ["ids"]), _lookup_type(s, ["primary_location"])
    ids = F.struct(*(field(s, f"ids.{c}").alias(c) for c in ("openalex", "doi", "pmid", "pmcid")))
    source = _sub(loc_t, F.col("primary_location"), "source.id") if loc_t else F.lit(None).cast("string")
    rows = works.select(
        F.col("id").alias("work_id"), F.when(non_blank(source), source).alias("source_id"), F.col(order).alias("_o"),
        F.when(_truthy_struct(F.col("ids") if ids_t else F.lit(None), ids_t), F.col(order)).alias("_ids_o"), ids.alias("ids"),
        field(s, "type").alias("type"), (_sub(loc_t, F.col("primary_location"), "version") if loc_t else F.lit(None).cast("string")).alias("version"))
    per_source = rows.groupBy("work_id", "source_id").agg(
        F.max_by("ids", "_ids_o").alias("ids"), F.max("_ids_o").alias("_ids_o"),
        F.max_by("type", "_o").alias("type"), F.max_by("version", "_o").alias("version"), F.max("_o").alias("_o"))
    per_work = per_source.groupBy("work_id").agg(
        F.max_by("ids", "_ids_o").alias("ids"), F.max_by("type", "_o").alias("work_type"), F.min_by("version", "source_id").alias("version"))
    return per_work.select("work_id", "ids.openalex", "ids.doi", "ids.pmid", "ids.pmcid", "work_type", "version")


SOURCES_TABLES = ("sources", "sources_ids", "sources_counts_by_year")


def load_tables(tables: dict[str, DataFrame], order: dict[str, list[str]] | None = None) -> dict[str, DataFrame]:
    """Keyed keep-last load of flattened tables (the analysis database, as DataFrames).

    ``order`` gives the load-order columns per table; otherwise the ``_ord`` the flattening
    carried from the reader (record order, then position in its lists) decides. The tables of
    Sources come from one record per id and carry none: should such a record hold a key
    twice, the greater row stays, which a retried task finds as well.
    """
    out = {}
    for name, df in tables.items():
        keys = PRIMARY_KEYS[name]
        cols = (order or {}).get(name)
        if not cols and name in SOURCES_TABLES and ORD not in df.columns:
            rest = [c for c in df.columns if c not in keys]
            df, cols = df.withColumn(ORD, F.struct(*rest)), [ORD]
        if not cols:
            df, oc = load_order(df, None)
            cols = [oc]
        out[name] = keep_last(df, keys, cols).drop(ORD)
    return out
