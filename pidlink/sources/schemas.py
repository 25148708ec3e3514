"""Explicit read schemas of the OpenAlex and JSON-LD inputs.

Reading with a schema prunes columns at the scan and ignores unknown keys. Objects whose
keys are data (``abstract_inverted_index``) are declared STRING, so Spark keeps their JSON
text as is.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from pidlink.functions import constants as K


def _s(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t) for n, t in fields])


S, L, I, B, D = StringType(), LongType(), IntegerType(), BooleanType(), DoubleType()


def _location() -> StructType:
    return _s(("source", _s(("id", S), ("display_name", S))), ("landing_page_url", S), ("pdf_url", S),
              ("is_oa", B), ("version", S), ("license", S))


def work_schema() -> StructType:
    return _s(
        ("id", S), ("doi", S), ("title", S), ("display_name", S), ("publication_year", I), ("publication_date", S),
        ("type", S), ("cited_by_count", L), ("is_retracted", B), ("is_paratext", B), ("cited_by_api_url", S),
        ("abstract_inverted_index", S), ("language", S),
        ("ids", _s(("openalex", S), ("doi", S), ("mag", S), ("pmid", S), ("pmcid", S))),
        ("primary_location", _location()), ("best_oa_location", _location()),
        ("locations", ArrayType(_location())),
        ("authorships", ArrayType(_s(("author_position", S), ("author", _s(("id", S), ("display_name", S))),
                                     ("institutions", ArrayType(_s(("id", S), ("display_name", S)))),
                                     ("raw_affiliation_string", S)))),
        ("biblio", _s(("volume", S), ("issue", S), ("first_page", S), ("last_page", S))),
        ("concepts", ArrayType(_s(("id", S), ("score", D)))),
        ("mesh", ArrayType(_s(("descriptor_ui", S), ("descriptor_name", S), ("qualifier_ui", S),
                              ("qualifier_name", S), ("is_major_topic", B)))),
        ("open_access", _s(("is_oa", B), ("oa_status", S), ("oa_url", S), ("any_repository_has_fulltext", B))),
        ("referenced_works", ArrayType(S)), ("related_works", ArrayType(S)),
    )


def source_schema() -> StructType:
    return _s(
        ("id", S), ("issn_l", S), ("issn", ArrayType(S)), ("display_name", S), ("publisher", S),
        ("works_count", L), ("cited_by_count", L), ("is_oa", B), ("is_in_doaj", B), ("homepage_url", S),
        ("works_api_url", S), ("updated_date", S), ("type", S),
        ("ids", _s(("openalex", S), ("issn_l", S), ("issn", ArrayType(S)), ("mag", S), ("wikidata", S),
                   ("fatcat", S))),
        ("counts_by_year", ArrayType(_s(("year", I), ("works_count", L), ("cited_by_count", L),
                                        ("oa_works_count", L)))),
    )


def author_schema() -> StructType:
    return _s(("id", S), ("ids", _s(("openalex", S), ("orcid", S))))


def ror_wikidata_schema() -> StructType:
    """Institutions, publishers, funders."""
    return _s(("id", S), ("ids", _s(("openalex", S), ("ror", S), ("wikidata", S))))


def _refs() -> ArrayType:
    return ArrayType(_s(("@id", S)))


def prov_graph_schema() -> StructType:
    snapshot = _s(("@id", S), (K.PROV_PRIMARY_SOURCE, _refs()), (K.PROV_SPECIALIZATION_OF, _refs()))
    return _s(("@id", S), ("@graph", ArrayType(snapshot)))


def br_graph_schema() -> StructType:
    node = _s(("@id", S), ("@type", ArrayType(S)), (K.DATACITE_HAS_IDENTIFIER, _refs()))
    return _s(("@id", S), ("@graph", ArrayType(node)))
