"""Shape the fixture views into the nested records the jobs read from real dumps.

Real inputs are nested JSON (OpenAlex Works/Sources, JSON-LD graphs); the fixture views
are flat. These adapters only wrap flat rows into that nested schema (``struct`` /
``array``, and ``collect_list`` where a record owns a list). They decide nothing that the
jobs compute: no id is extracted, matched, de-duplicated or classified here.
"""

from __future__ import annotations

import itertools
import os
import zipfile
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from typing import BinaryIO

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pidlink.fixtures import base_table, fixture
from pidlink.functions import constants as K



def _null_str() -> Column:
    return F.lit(None).cast("string")


def _obj(**fields: Column) -> Column:
    return F.struct(*[c.alias(n) for n, c in fields.items()])


def _id_obj(c: Column) -> Column:
    """``{'@id': c}``."""
    return F.struct(c.alias("@id"))


# ------------------------------------------------------------------ Meta dump


def meta_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Meta dump rows: id, venue, author, publisher, editor, type (all text)."""
    return fixture(spark, sf_dir, "fx_meta").select("id", "venue", "author", "publisher", "editor", "type")


# ------------------------------------------------------------------ OpenAlex records


def work_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Work records: id, doi, type, ids{openalex, doi, mag, pmid, pmcid}, primary_location.

    The primary location carries the Work's version; its source is a fixed placeholder id
    because the fixture has no source per Work (only its presence is read downstream).
    """
    w = fixture(spark, sf_dir, "fx_works")
    return w.select(
        "id", "doi", "type",
        _obj(openalex=F.col("id"), doi=F.col("doi"), mag=_null_str(), pmid=F.col("pmid"), pmcid=F.col("pmcid")).alias("ids"),
        _obj(source=_obj(id=F.lit(K.OPENALEX_URI + "S0")), landing_page_url=_null_str(), pdf_url=_null_str(),
             is_oa=F.lit(None).cast("boolean"), version=F.col("version"), license=_null_str()).alias("primary_location"),
    )


def ordered(records: DataFrame) -> DataFrame:
    """Records with a load order, as the reader adds one (here the record's id)."""
    return records.withColumn("_ord", F.col("id"))


def source_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source records: id, issn_l, issn[], ids{openalex, issn_l, issn[], mag, wikidata, fatcat}."""
    s = fixture(spark, sf_dir, "fx_sources")
    issn = F.filter(F.array("issn1", "issn2"), lambda x: x.isNotNull())
    return s.select(
        "id", "issn_l", issn.alias("issn"),
        _obj(openalex=F.col("id"), issn_l=F.col("issn_l"), issn=issn, mag=_null_str(), wikidata=F.col("wikidata"),
             fatcat=_null_str()).alias("ids"),
    )


def source_count_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source records holding only their ``counts_by_year`` list."""
    c = fixture(spark, sf_dir, "fx_counts_by_year")
    return c.groupBy(F.col("source_id").alias("id")).agg(F.collect_list(_obj(
        year=F.col("year").cast("int"), works_count=F.col("works_count").cast("bigint"),
        cited_by_count=F.lit(None).cast("bigint"), oa_works_count=F.col("oa_works_count").cast("bigint"),
    )).alias("counts_by_year"))


def agent_records(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """Author (ids{orcid}) or institution/publisher/funder (ids{ror, wikidata}) records."""
    a = fixture(spark, sf_dir, "fx_agents")
    if kind == "author":
        ids = _obj(orcid=F.col("orcid"))
    else:
        ids = _obj(ror=F.col("ror"), wikidata=F.col("wikidata"))
    return a.select("id", ids.alias("ids"))


def _location(source_id: Column, landing: Column, is_oa: Column, version: Column) -> Column:
    return _obj(source=F.when(source_id.isNotNull(), _obj(id=source_id)), landing_page_url=landing,
                pdf_url=_null_str(), is_oa=is_oa, version=version, license=_null_str())


def location_records(spark: SparkSession, sf_dir: str, field: str) -> DataFrame:
    """One Work record per location row, carrying it as ``primary_location`` or
    ``best_oa_location``."""
    loc = fixture(spark, sf_dir, "fx_locations")
    return loc.select(F.col("work_id").alias("id"), _location(F.col("source_id"), F.col("landing_page_url"),
                                                              F.col("is_oa"), F.col("version")).alias(field))


def locations_list_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Work records with their ``locations`` list."""
    loc = fixture(spark, sf_dir, "fx_locations")
    return loc.groupBy(F.col("work_id").alias("id")).agg(F.collect_list(_location(
        F.col("source_id"), F.col("landing_page_url"), F.col("is_oa"), F.col("version"))).alias("locations"))


def authorship_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Work records with their ``authorships`` list; an author who stands several times at a
    position of a Work is one authorship with several institutions."""
    a = fixture(spark, sf_dir, "fx_authorships")
    each = a.groupBy("work_id", "author_position", "author_id").agg(
        F.collect_list(_obj(id=F.col("institution_id"))).alias("institutions"))
    return each.groupBy(F.col("work_id").alias("id")).agg(F.collect_list(_obj(
        author_position=F.col("author_position"), author=_obj(id=F.col("author_id")),
        institutions=F.col("institutions"), raw_affiliation_string=_null_str(),
    )).alias("authorships"))


def _order_work_id() -> Column:
    return F.concat(F.lit(K.OPENALEX_URI + "W"), F.col("o_orderkey").cast("string"))


def biblio_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Work records with ``biblio`` (volume k % 50, issue k % 12, two page numbers); every
    eleventh order has none."""
    o = base_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    biblio = _obj(volume=(k % 50).cast("string"), issue=(k % 12).cast("string"),
                  first_page=(k % 97 + 1).cast("string"), last_page=(k % 97 + 12).cast("string"))
    return o.select(_order_work_id().alias("id"), F.when(k % 11 != 0, biblio).alias("biblio"))


def open_access_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Work records with ``open_access`` (flag and status from the order status)."""
    o = base_table(spark, sf_dir, "orders")
    st = F.col("o_orderstatus")
    oa = _obj(is_oa=st == "F", oa_status=F.when(st == "F", "gold").when(st == "O", "closed").otherwise("hybrid"),
              oa_url=_null_str(), any_repository_has_fulltext=st == "P")
    return o.select(_order_work_id().alias("id"), oa.alias("open_access"))


def line_list_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Work records with ``concepts`` and ``mesh`` lists built from the order's lines
    (part keys; every tenth part has a concept without id)."""
    li = base_table(spark, sf_dir, "lineitem")
    p = F.col("l_partkey")
    concept = _obj(id=F.when(p % 10 != 0, F.concat(F.lit(K.OPENALEX_URI + "C"), p.cast("string"))),
                   score=F.col("l_discount").cast("double"))
    mesh = _obj(descriptor_ui=F.concat(F.lit("D"), p.cast("string")),
                descriptor_name=F.concat(F.lit("Descriptor "), p.cast("string")),
                qualifier_ui=F.concat(F.lit("Q"), F.col("l_suppkey").cast("string")), qualifier_name=_null_str(),
                is_major_topic=F.col("l_linenumber") == 1)
    return li.groupBy(F.concat(F.lit(K.OPENALEX_URI + "W"), F.col("l_orderkey").cast("string")).alias("id")).agg(
        F.collect_list(concept).alias("concepts"), F.collect_list(mesh).alias("mesh"))


def reference_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Work records with ``referenced_works`` and ``related_works`` lists (blanks included)."""
    r = fixture(spark, sf_dir, "fx_refs")
    return r.groupBy(F.col("work_id").alias("id")).agg(
        F.collect_list("referenced_work_id").alias("referenced_works"),
        F.collect_list("referenced_work_id").alias("related_works"))


# ------------------------------------------------------------------ archives


#: A member of an archive ends after so many bytes of lines.
MEMBER_BYTES = 32 << 20


@contextmanager
def _member(archive: zipfile.ZipFile, kind: str, number: int, header: str) -> Iterator[BinaryIO]:
    """A member of an archive, open for its lines; ``prov`` and ``br`` members are archives, streamed too."""
    block = 1000 * (number + 1)
    if kind == "csv":
        with archive.open(f"csv/part{block}.csv", "w") as out:
            out.write(f"{header}\n".encode())
            yield out
        return
    outer, inner = (f"br/060/{block}/prov/se.zip", "se.json") if kind == "prov" else (f"br/060/{block}.zip", f"{block}.json")
    with archive.open(outer, "w") as member, zipfile.ZipFile(member, "w", zipfile.ZIP_DEFLATED) as nested, nested.open(inner, "w") as out:
        out.write(b"[")
        yield out
        out.write(b"]")


def write_archives(lines: DataFrame, folder: str, kind: str, header: str = "", member_bytes: int = MEMBER_BYTES) -> None:
    """One zip archive per partition of one column of text lines, as the dumps have them: ``csv`` with
    members of CSV lines below the header, ``prov`` and ``br`` with nested archives that hold a
    JSON list of lines. Lines are streamed into members of about ``member_bytes``, so a task holds
    one Arrow batch however many lines it has. A retried task writes the same file again."""
    os.makedirs(folder, exist_ok=True)
    between = "\n" if kind == "csv" else ",\n"

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = (t for b in batches for t in b.column(0).to_pylist())
        path = os.path.join(folder, f"{TaskContext.get().partitionId():05}.zip")
        n, text = 0, next(texts, None)
        with zipfile.ZipFile(f"{path}.tmp", "w", zipfile.ZIP_DEFLATED) as z:
            for number in itertools.count():
                with _member(z, kind, number, header) as out:
                    held = 0
                    while text is not None and held < member_bytes:
                        held += out.write((between * (held > 0) + text).encode())
                        n, text = n + 1, next(texts, None)
                    if kind == "csv":
                        out.write(b"\n")
                if text is None:
                    break
        os.replace(f"{path}.tmp", path)
        yield pa.RecordBatch.from_pydict({"n": [n]})

    lines.mapInArrow(write, "n long").agg(F.sum("n")).collect()


# ------------------------------------------------------------------ JSON-LD graphs


def provenance_graphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One provenance graph per fixture snapshot row: a first snapshot naming the primary
    source (if any), a second naming the described resource."""
    p = fixture(spark, sf_dir, "fx_prov")
    snap = lambda src, br: F.struct(src.alias(K.PROV_PRIMARY_SOURCE), br.alias(K.PROV_SPECIALIZATION_OF))
    none = F.lit(None).cast("array<struct<`@id`:string>>")
    first = snap(F.when(F.col("source_uri").isNotNull(), F.array(_id_obj(F.col("source_uri")))).otherwise(none), none)
    second = snap(none, F.array(_id_obj(F.col("br_uri"))))
    return p.select(F.concat(F.col("br_uri"), F.lit("/prov/")).alias("@id"), F.array(first, second).alias("@graph"))


def br_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bibliographic-resource nodes: @id, @type [Expression, specific], hasIdentifier list."""
    b = fixture(spark, sf_dir, "fx_br")
    ident = F.when(F.col("has_identifier") == 1, F.array(_id_obj(F.concat(F.col("br_uri"), F.lit("/id"))))) \
        .otherwise(F.array().cast("array<struct<`@id`:string>>"))
    return b.select(
        F.col("br_uri").alias("@id"),
        F.array(F.lit(K.FABIO_EXPRESSION), F.col("type_uri")).alias("@type"),
        ident.alias(K.DATACITE_HAS_IDENTIFIER),
    )
