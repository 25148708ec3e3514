"""Identifier extraction from Meta dump rows (primary entity, venue, responsible agents).

A Meta row holds its own identifiers in ``id`` (space separated, one ``omid:`` token
plus external PIDs) and embedded entities in ``venue`` / ``author`` / ``publisher`` /
``editor`` cells shaped ``Name [omid:.. pid ..]`` (author and editor hold several,
joined by ``'; '``). Every operator here is a narrow projection (no shuffle) except the
``distinct`` of venues and agents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pidlink.functions import bracket_content, last_with_prefix, tokens, without_prefix

RA_FIELDS = ("author", "publisher", "editor")


def _split_ids(tok: Column) -> tuple[Column, Column]:
    """(omid, ids) of a token array: last ``omid:`` token (or ''), the rest joined by a blank."""
    omid = F.coalesce(last_with_prefix(tok, "omid:"), F.lit(""))
    ids = F.array_join(without_prefix(tok, "omid:"), " ")
    return omid, ids


def has_openalex_id(id_col: str = "id") -> Column:
    """True when the row already carries an ``openalex:`` identifier."""
    return F.exists(tokens(id_col), lambda t: t.startswith("openalex:"))


def skip_openalex_rows(meta: DataFrame, all_rows: bool = True, id_col: str = "id") -> DataFrame:
    """``all_rows=False`` drops whole rows (and so their venue and agents) holding ``openalex:``."""
    return meta if all_rows else meta.where(~has_openalex_id(id_col))


def primary_entities(meta: DataFrame, all_rows: bool = True) -> DataFrame:
    """One row per Meta row with at least one non-OMID token: (omid, ids, type).

    Duplicate tokens are kept in order; rows are not de-duplicated.
    """
    meta = skip_openalex_rows(meta, all_rows)
    tok = tokens("id")
    omid, ids = _split_ids(tok)
    return (
        meta.select(omid.alias("omid"), ids.alias("ids"), F.coalesce(F.col("type"), F.lit("")).alias("type"))
        .where(F.col("ids") != "")
    )


def venues(meta: DataFrame, all_rows: bool = True, last_bracket: bool = False) -> DataFrame:
    """Distinct (omid, ids) of the venue cells having at least one external PID.

    Cells without both brackets cannot be parsed and are dropped. The first ``[...]`` is
    read (parity); ``last_bracket=True`` reads the last one, for names with brackets.
    """
    meta = skip_openalex_rows(meta, all_rows)
    inner = bracket_content(F.col("venue"), last=last_bracket)
    tok = tokens(inner)
    omid, ids = _split_ids(tok)
    return (
        meta.where(F.col("venue").isNotNull() & (F.col("venue") != ""))
        .select(inner.alias("_inner"), omid.alias("omid"), ids.alias("ids"))
        .where(F.col("_inner").isNotNull() & (F.col("ids") != ""))
        .select("omid", "ids")
        .distinct()
    )


def _ra_entities(field: str) -> Column:
    """Array of (role, entity text) for one agent field; publisher is one entity."""
    cell = F.col(field)
    parts = F.array(cell) if field == "publisher" else F.split(cell, "; ")
    return F.when(
        cell.isNotNull() & (cell != ""),
        F.transform(parts, lambda e: F.struct(F.lit(field).alias("ra_role"), e.alias("entity"))),
    ).otherwise(F.array().cast("array<struct<ra_role:string,entity:string>>"))


def responsible_agents(meta: DataFrame, all_rows: bool = True, fields=RA_FIELDS,
                       last_bracket: bool = False) -> DataFrame:
    """Distinct (omid, ids, ra_role) of authors, publishers and editors with an external PID.

    Entities without both brackets are skipped; ``last_bracket`` as in ``venues``.
    """
    meta = skip_openalex_rows(meta, all_rows)
    ents = meta.select(F.explode(F.concat(*[_ra_entities(f) for f in fields])).alias("e"))
    inner = bracket_content(F.col("e.entity"), last=last_bracket)
    tok = tokens(inner)
    omid, ids = _split_ids(tok)
    return (
        ents.select(inner.alias("_inner"), omid.alias("omid"), ids.alias("ids"), F.col("e.ra_role").alias("ra_role"))
        .where(F.col("_inner").isNotNull() & (F.col("ids") != ""))
        .select("omid", "ids", "ra_role")
        .distinct()
    )


def unparsable_venues(meta: DataFrame) -> DataFrame:
    """Rows whose non-empty venue cell lacks a bracket (dropped from ``venues``; for counting
    and logging)."""
    return meta.where(F.col("venue").isNotNull() & (F.col("venue") != "") & bracket_content(F.col("venue")).isNull())


def unparsable_agents(meta: DataFrame, fields=RA_FIELDS) -> DataFrame:
    """(ra_role, entity) of agent entries without brackets (skipped by ``responsible_agents``)."""
    ents = meta.select(F.explode(F.concat(*[_ra_entities(f) for f in fields])).alias("e"))
    return ents.where(bracket_content(F.col("e.entity")).isNull()).select("e.ra_role", F.trim("e.entity").alias("entity"))
