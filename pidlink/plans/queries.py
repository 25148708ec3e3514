"""The driver's registered queries: one per operator group, each (spark, sf_dir) -> DataFrame.

Every query reads the driver's tables through the fixture views and runs the library's own
operators on them; the matching DuckDB SQL is in ``pidlink.plans.oracle``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pidlink.fixtures import fixture
from pidlink.operators import categorize as C
from pidlink.operators import extract as X
from pidlink.operators import flatten as FL
from pidlink.operators import mapping as M
from pidlink.operators import pids as P
from pidlink.operators import provenance as PV
from pidlink.operators import stats as S
from pidlink.plans import adapters as A
from pidlink.plans import jobs as J
from pidlink.session import checkpoint_dir, parts_for
from pidlink.sources import dumps as D
from pidlink.sources import readers as R
from pidlink.sources import schemas as SC
from pidlink.sources import sinks as W
from pidlink.sources.keyed import KeyedTable

Query = Callable[[SparkSession, str], DataFrame]


# ------------------------------------------------------------------ shared steps


def _mapping(spark: SparkSession, sf: str, all_rows: bool = True) -> J.MappingResult:
    return J.mapping_job(A.meta_rows(spark, sf), A.work_records(spark, sf), A.source_records(spark, sf),
                         all_rows=all_rows)


def _map_view(result: DataFrame) -> DataFrame:
    return result.select("omid", "type", F.array_join("openalex_ids", " ").alias("openalex_id"), "n_openalex",
                         "outcome")


def _multi(spark: SparkSession, sf: str) -> DataFrame:
    return _mapping(spark, sf).multi_mapped()


def _categories(spark: SparkSession, sf: str) -> J.Categories:
    return J.categorisation_job(_mapping(spark, sf).multi_mapped_listed(), A.ordered(A.work_records(spark, sf)),
                                A.ordered(A.source_records(spark, sf)))


def _provenance(spark: SparkSession, sf: str) -> J.ProvenanceResult:
    # read by the records to trace and by their PID sets, and as the set of processed records
    entities = J.cut_lineage(M.keyed_records(X.primary_entities(A.meta_rows(spark, sf)), ["omid", "type"]))
    unmapped = M.unmapped_records(entities, J.build_index(A.work_records(spark, sf), A.source_records(spark, sf)))
    return J.provenance_job(A.provenance_graphs(spark, sf), A.br_nodes(spark, sf), entities, unmapped)


# ------------------------------------------------------------------ extraction


def meta_primary_entities(spark: SparkSession, sf: str) -> DataFrame:
    return X.primary_entities(A.meta_rows(spark, sf))


def meta_venues(spark: SparkSession, sf: str) -> DataFrame:
    return X.venues(A.meta_rows(spark, sf))


def meta_responsible_agents(spark: SparkSession, sf: str) -> DataFrame:
    return X.responsible_agents(A.meta_rows(spark, sf))


def meta_primary_entities_new_only(spark: SparkSession, sf: str) -> DataFrame:
    return X.primary_entities(A.meta_rows(spark, sf), all_rows=False)


def meta_unparsable_agents(spark: SparkSession, sf: str) -> DataFrame:
    return X.unparsable_agents(A.meta_rows(spark, sf))


# ------------------------------------------------------------------ PIDs


def pids_works(spark: SparkSession, sf: str) -> DataFrame:
    return P.openalex_ids_table(A.work_records(spark, sf), "work")


def pids_sources(spark: SparkSession, sf: str) -> DataFrame:
    return P.openalex_ids_table(A.source_records(spark, sf), "source")


def pids_authors(spark: SparkSession, sf: str) -> DataFrame:
    return P.openalex_ids_table(A.agent_records(spark, sf, "author"), "author")


def pids_institutions(spark: SparkSession, sf: str) -> DataFrame:
    return P.openalex_ids_table(A.agent_records(spark, sf, "institution"), "institution")


def pids_publishers(spark: SparkSession, sf: str) -> DataFrame:
    return P.openalex_ids_table(A.agent_records(spark, sf, "publisher"), "publisher")


def pids_funders(spark: SparkSession, sf: str) -> DataFrame:
    return P.openalex_ids_table(A.agent_records(spark, sf, "funder"), "funder")


def pid_index_by_scheme(spark: SparkSession, sf: str) -> DataFrame:
    return P.index_summary(J.build_index(A.work_records(spark, sf), A.source_records(spark, sf)))


# ------------------------------------------------------------------ mapping


def map_all(spark: SparkSession, sf: str) -> DataFrame:
    return _map_view(_mapping(spark, sf).result)


def map_one_to_one(spark: SparkSession, sf: str) -> DataFrame:
    return _mapping(spark, sf).mapped()


def map_multi(spark: SparkSession, sf: str) -> DataFrame:
    return _mapping(spark, sf).multi_mapped()


def map_unmapped(spark: SparkSession, sf: str) -> DataFrame:
    m = _mapping(spark, sf)
    return M.unmapped_records(J.cut_lineage(M.keyed_records(m.primary_entities, ["omid", "type"])), m.index)


def map_new_only(spark: SparkSession, sf: str) -> DataFrame:
    return _map_view(_mapping(spark, sf, all_rows=False).result)


def map_venues_untyped(spark: SparkSession, sf: str) -> DataFrame:
    m = _mapping(spark, sf)
    r = J.map_venues(m.venues, m.index)
    return r.select("omid", F.array_join("openalex_ids", " ").alias("openalex_id"), "n_openalex", "outcome")


def outcome_counts(spark: SparkSession, sf: str) -> DataFrame:
    return S.outcome_counts(_mapping(spark, sf).result)


# ------------------------------------------------------------------ multi-mapped ids, flattening


def mm_ids_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return FL.mm_oaids(_multi(spark, sf))


def full_metadata_semi_join(spark: SparkSession, sf: str) -> DataFrame:
    keys = FL.mm_oaids(_multi(spark, sf)).where(F.col("entity") == "works")
    return FL.select_records(A.work_records(spark, sf), keys).select("id", "doi", "type")


def flat_sources(spark: SparkSession, sf: str) -> DataFrame:
    return FL.flatten_sources(A.ordered(A.source_records(spark, sf)))["sources"]


def flat_sources_ids(spark: SparkSession, sf: str) -> DataFrame:
    return FL.flatten_sources(A.ordered(A.source_records(spark, sf)))["sources_ids"]


def flat_sources_keep_first(spark: SparkSession, sf: str) -> DataFrame:
    """Sources that stand twice, every third with other values first: the first in load order stays."""
    s = A.source_records(spark, sf)
    first = F.col("id").rlike("[369]$")
    twice = s.withColumn("_ord", F.when(first, 2).otherwise(1)).unionByName(
        s.withColumn("issn_l", F.concat(F.lit("other-"), F.col("issn_l"))).withColumn("_ord", F.when(first, 1).otherwise(2)))
    return FL.flatten_sources(twice)["sources"].select("id", "issn_l", "issn")


def flat_sources_counts(spark: SparkSession, sf: str) -> DataFrame:
    return FL.flatten_sources(A.ordered(A.source_count_records(spark, sf)))["sources_counts_by_year"].drop(FL.ORD)


def flat_works(spark: SparkSession, sf: str) -> DataFrame:
    return FL.works_table(A.work_records(spark, sf))


def flat_primary_locations(spark: SparkSession, sf: str) -> DataFrame:
    return FL.works_primary_locations(A.location_records(spark, sf, "primary_location"))


def flat_locations(spark: SparkSession, sf: str) -> DataFrame:
    return FL.works_locations(A.locations_list_records(spark, sf))


def flat_best_oa_locations(spark: SparkSession, sf: str) -> DataFrame:
    return FL.works_best_oa_locations(A.location_records(spark, sf, "best_oa_location"))


def flat_authorships(spark: SparkSession, sf: str) -> DataFrame:
    return FL.works_authorships(A.authorship_records(spark, sf))


def flat_biblio(spark: SparkSession, sf: str) -> DataFrame:
    return FL.works_biblio(A.biblio_records(spark, sf))


def flat_concepts(spark: SparkSession, sf: str) -> DataFrame:
    return FL.works_concepts(A.line_list_records(spark, sf))


def flat_works_ids(spark: SparkSession, sf: str) -> DataFrame:
    return FL.works_ids(A.work_records(spark, sf))


def flat_mesh(spark: SparkSession, sf: str) -> DataFrame:
    return FL.works_mesh(A.line_list_records(spark, sf))


def flat_open_access(spark: SparkSession, sf: str) -> DataFrame:
    return FL.works_open_access(A.open_access_records(spark, sf))


def flat_referenced(spark: SparkSession, sf: str) -> DataFrame:
    return FL.works_referenced_works(A.reference_records(spark, sf))


def flat_related(spark: SparkSession, sf: str) -> DataFrame:
    return FL.works_related_works(A.reference_records(spark, sf))


def upsert_keep_last(spark: SparkSession, sf: str) -> DataFrame:
    a = fixture(spark, sf, "fx_authorships")
    return FL.keep_last(a, FL.PRIMARY_KEYS["works_authorships"], ["ord1", "ord2", "ord3"])


# ------------------------------------------------------------------ categories


def mm_categories_works(spark: SparkSession, sf: str) -> DataFrame:
    return _categories(spark, sf).works


def mm_categories_sources(spark: SparkSession, sf: str) -> DataFrame:
    return _categories(spark, sf).sources


def mm_category_counts(spark: SparkSession, sf: str) -> DataFrame:
    return _categories(spark, sf).counts()


def mm_category_pivot(spark: SparkSession, sf: str) -> DataFrame:
    return C.category_pivot(_categories(spark, sf).counts())


def mm_categories_keep_last(spark: SparkSession, sf: str) -> DataFrame:
    """Works that stand twice, the earlier time with another type, DOI and version: the last in load
    order decides, whatever the order of ids and rows."""
    w = A.work_records(spark, sf)
    earlier = w.withColumn("type", F.lit("erratum")).withColumn("ids", F.col("ids").withField("doi", F.lit("https://doi.org/10.1101/same.v1"))) \
        .withColumn("primary_location", F.col("primary_location").withField("version", F.lit("submittedVersion")))
    works = w.withColumn("_ord", F.lit(2)).unionByName(earlier.withColumn("_ord", F.lit(1)))
    return J.categorisation_job(_mapping(spark, sf).multi_mapped_listed(), works, A.ordered(A.source_records(spark, sf))).works


# ------------------------------------------------------------------ provenance


def prov_sources_per_br(spark: SparkSession, sf: str) -> DataFrame:
    p = PV.provenance_table(A.provenance_graphs(spark, sf))
    return p.select("br_uri", F.array_join("sources", " ").alias("sources"),
                    F.size("sources").cast("bigint").alias("n_sources"))


def prov_dropped_graphs(spark: SparkSession, sf: str) -> DataFrame:
    return PV.dropped_graphs(A.provenance_graphs(spark, sf)).select(F.col("`@id`").alias("graph_id"))


def prov_extra_brs(spark: SparkSession, sf: str) -> DataFrame:
    nodes = A.br_nodes(spark, sf)
    processed = PV.processed_omids(X.primary_entities(A.meta_rows(spark, sf)), parts_for(nodes.count()))  # needs no mapping
    return PV.extra_records(nodes, processed)


def prov_missing(spark: SparkSession, sf: str) -> DataFrame:
    return _provenance(spark, sf).missing


def prov_counts(spark: SparkSession, sf: str) -> DataFrame:
    return _provenance(spark, sf).counts


def prov_by_type(spark: SparkSession, sf: str) -> DataFrame:
    return PV.provenance_by_type(_provenance(spark, sf).counts)


def prov_pivot(spark: SparkSession, sf: str) -> DataFrame:
    return PV.provenance_pivot(_provenance(spark, sf).counts)


def prov_contribution(spark: SparkSession, sf: str) -> DataFrame:
    return PV.contribution_by_source(_provenance(spark, sf).counts)


# ------------------------------------------------------------------ statistics


def mm_composition(spark: SparkSession, sf: str) -> DataFrame:
    return S.with_composition(_multi(spark, sf))


def mm_filter(spark: SparkSession, sf: str) -> DataFrame:
    return S.filter_mm(S.with_composition(_multi(spark, sf)), "journal article", "works", 2)


def mm_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return S.distribution_by_type(_multi(spark, sf))


def mm_type_stats(spark: SparkSession, sf: str) -> DataFrame:
    return S.type_stats(_multi(spark, sf))


def mm_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return S.histogram(_multi(spark, sf))


def mm_api_urls(spark: SparkSession, sf: str) -> DataFrame:
    u = S.api_urls(_multi(spark, sf), verbose=True)
    return u.select("omid", F.array_join("openalex_id", " ").alias("openalex_id"), "type")


def inverted_multi_mapped(spark: SparkSession, sf: str) -> DataFrame:
    # the 1:1 table is read twice (count per id, then the rows): stored once first
    return S.inverted_multi_mapped(J.cut_lineage(_mapping(spark, sf).mapped()))


def venue_row_overlap(spark: SparkSession, sf: str) -> DataFrame:
    m = _mapping(spark, sf)
    return S.venue_row_overlap(A.meta_rows(spark, sf), PV.processed_omids(m.primary_entities))


def coverage_meta(spark: SparkSession, sf: str) -> DataFrame:
    return S.meta_coverage(A.meta_rows(spark, sf))


def coverage_openalex(spark: SparkSession, sf: str) -> DataFrame:
    return S.openalex_coverage(A.work_records(spark, sf), A.source_records(spark, sf))


# ------------------------------------------------------------------ sources and sinks


def _folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def io_csv_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Rolled CSV folders written and read back by column name: the files of the first have two
    column orders, those of the second lack a column."""
    meta, path = A.meta_rows(spark, sf), _folder(spark, "csv")
    W.write_csv(meta, f"{path}/a", rows_per_file=5000)
    W.write_csv(meta.select(*reversed(meta.columns)), f"{path}/a", rows_per_file=5000, mode="append")
    W.write_csv(meta.drop("editor"), f"{path}/b", rows_per_file=5000)
    return R.read_csv_tables(spark, f"{path}/a", f"{path}/b").select("id", "venue", "author", "publisher", "editor", "type")


def io_json_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Rolled JSON lines of Work records, written and read back."""
    path = _folder(spark, "json")
    W.write_json_lines(A.work_records(spark, sf), path, rows_per_file=5000)
    back = R.read_json_records(spark, path, SC.work_schema())
    return back.select("id", "type", F.col("ids.doi").alias("doi"), F.col("primary_location.version").alias("version"))


def io_openalex_dump(spark: SparkSession, sf: str) -> DataFrame:
    """A gz dump of Source records in which some lines are cut off: records read, lines
    reported as malformed, and well-formed lines of the uncompressed copy."""
    path, copy = _folder(spark, "gz"), _folder(spark, "copy")
    s = A.source_records(spark, sf)
    line = F.to_json(F.struct(*s.columns))
    cut = F.substring(line, 1, 20)  # ends inside a string
    s.select(F.when(F.col("id").endswith("7"), cut).otherwise(line).alias("value")).write.option(
        "compression", "gzip").text(path)
    records, malformed = R.read_openalex(spark, path, SC.source_schema())
    R.copy_json_lines(spark, path, copy)
    found = records.select(F.lit("records").alias("kind"), F.col("ids.issn_l").alias("issn_l")).unionByName(
        malformed.select(F.lit("malformed").alias("kind"), F.lit(None).cast("string").alias("issn_l"))).unionByName(
        spark.read.text(f"{copy}/kind=lines").select(F.lit("copied").alias("kind"), F.get_json_object("value", "$.ids.issn_l").alias("issn_l")))
    return found.groupBy("kind").agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                                     F.countDistinct("issn_l").cast("bigint").alias("n_issn_l"))


def io_counts_document(spark: SparkSession, sf: str) -> DataFrame:
    """The nested counts document written and read back as the long table."""
    w, path = A.work_records(spark, sf), _folder(spark, "doc")
    counts = w.groupBy(F.lit("works").alias("entity"), "type", F.col("primary_location.version").alias("category")).agg(
        F.count(F.lit(1)).alias("n"))
    W.write_document(C.nested_counts_json(counts), path)
    return R.read_category_counts(spark, path)


def io_append_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """A table appended to twice, then updated by key: the last of the new rows wins."""
    works, path = A.work_records(spark, sf), _folder(spark, "append")
    W.append(works.where("type = 'erratum'").select("id", "type"), path)
    W.append(works.where("type <> 'erratum'").select("id", "type"), path)
    newer = works.where("primary_location.version = 'submittedVersion'")
    incoming = newer.select("id", F.lit("first").alias("type"), F.lit(1).alias("seq")).unionByName(
        newer.select("id", F.lit("second").alias("type"), F.lit(2).alias("seq")))
    return W.upsert(spark.read.parquet(path), incoming, ["id"], "seq").select("id", "type")


def io_partial_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """A keyed table of which an update rewrites only the touched buckets."""
    works, path = A.work_records(spark, sf), _folder(spark, "keyed")
    table = KeyedTable.create(works.select("id", "type", F.lit(0).alias("seq")), path, ["id"], ["seq"], buckets=16)
    newer = works.where("primary_location.version = 'submittedVersion'")
    table.update(newer.select("id", F.lit("first").alias("type"), F.lit(1).alias("seq")).unionByName(
        newer.select("id", F.lit("second").alias("type"), F.lit(2).alias("seq"))), ["seq"])
    return table.read().select("id", "type")


def io_single_csv(spark: SparkSession, sf: str) -> DataFrame:
    """The multi-mapped table as one CSV file, read back with the number of its files."""
    path = _folder(spark, "single")
    W.write_single_csv(_multi(spark, sf), path)
    n = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(path).select("path").count()
    return R.read_csv_tables(spark, path).select("omid", "openalex_id", "type", F.lit(n).cast("bigint").alias("n_files"))


def io_inverted_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """The 1:1 table as rolled CSV, the job that inverts it, and its CSV read back."""
    path = _folder(spark, "inverted")
    W.write_csv(_mapping(spark, sf).mapped(), f"{path}/mapped", rows_per_file=5000)
    return R.read_csv_tables(spark, J.run_inverted(spark, f"{path}/mapped", path)["inverted"]).select("omid", "openalex_id")


def io_matching_records(spark: SparkSession, sf: str) -> DataFrame:
    """A gz dump of Work records, some lines cut off: the records of multi-mapped ids, parsed after
    the join with them, and the numbers of lines read and rejected."""
    path, works = _folder(spark, "dump"), A.work_records(spark, sf)
    line = F.to_json(F.struct("id", "type", "doi", "ids"))
    works.select(F.when(F.col("id").endswith("7"), F.substring(line, 1, 20)).otherwise(line).alias("value")).write.option(
        "compression", "gzip").text(f"{path}/gz")
    ids = FL.mm_oaids(_multi(spark, sf)).where(F.col("entity") == "works").select("openalex_id")
    kept = D.keep_matching(spark, f"{path}/gz", SC.work_schema(), ids, f"{path}/kept")
    counts = [F.lit(kept.counts[c]).cast("bigint").alias(f"n_{c}") for c in ("lines", "malformed")]
    return kept.records.select("id", "doi", "type", *counts)


def meta_reduced_tables(spark: SparkSession, sf: str) -> DataFrame:
    """The three reduced tables of one parse of the Meta rows, as the mapping job makes them."""
    meta = J.cut_lineage(A.meta_rows(spark, sf))
    tables = {"primary_ents": X.primary_entities(meta), "venues": X.venues(meta), "resp_ags": X.responsible_agents(meta)}
    kind = {"primary_ents": "type", "resp_ags": "ra_role"}
    parts = [df.select(F.lit(name).alias("table_name"), "omid", "ids", (F.col(kind[name]) if name in kind else F.lit(None).cast("string")).alias("kind"))
             for name, df in tables.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def pid_index_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """A stored index, and its rows for the PIDs of the Meta rows that name an ISSN."""
    path = _folder(spark, "index")
    P.write_pid_index(J.build_index(A.work_records(spark, sf), A.source_records(spark, sf)), path)
    pids = X.primary_entities(A.meta_rows(spark, sf)).select(F.explode(M.lookup_pids("ids")).alias("pid")).where("pid LIKE 'issn:%'")
    return P.index_of_pids(spark, path, pids).select("table_name", "supported_id", "openalex_id")


def _local(folder: str) -> str:
    """The mounted path of a folder: archives are written and read as files."""
    return folder.removeprefix("file://").removeprefix("file:")


def io_zipped_meta(spark: SparkSession, sf: str) -> DataFrame:
    """Zip archives of Meta CSV, half of the members with their columns in reverse, read by name."""
    path, meta = _local(_folder(spark, "zip")), A.meta_rows(spark, sf)
    for half, names in ((0, meta.columns), (1, meta.columns[::-1])):
        rows = meta.where(F.pmod(F.xxhash64("id"), F.lit(2)) == half)
        line = F.to_csv(F.struct(*names), {"quoteAll": "true", "escape": '"', "emptyValue": ""}).alias("line")
        A.write_archives(rows.select(line), f"{path}/{half}", "csv", header=",".join(names))
    parts = [R.read_zipped_csv(spark, f"{path}/{half}", tuple(meta.columns)) for half in (0, 1)]
    return parts[0].unionByName(parts[1])


def io_zipped_graphs(spark: SparkSession, sf: str) -> DataFrame:
    """Provenance graphs from lists in nested archives, as sources per resource."""
    path, graphs = _local(_folder(spark, "zip")), A.provenance_graphs(spark, sf)
    A.write_archives(graphs.select(F.to_json(F.struct(*(F.col(f"`{c}`") for c in graphs.columns))).alias("line")), path, "prov")
    p = PV.provenance_table(R.read_provenance_graphs(spark, path))
    return p.select("br_uri", F.array_join("sources", " ").alias("sources"), F.size("sources").cast("bigint").alias("n_sources"))


def io_zipped_nodes(spark: SparkSession, sf: str) -> DataFrame:
    """Resource nodes from lists in nested archives, as the records that the mapping did not process."""
    path, nodes = _local(_folder(spark, "zip")), A.br_nodes(spark, sf)
    graph = F.struct(F.col("`@id`"), F.array(F.struct(*(F.col(f"`{c}`") for c in nodes.columns))).alias("@graph"))
    A.write_archives(nodes.select(F.to_json(graph).alias("line")), path, "br")
    processed = PV.processed_omids(X.primary_entities(A.meta_rows(spark, sf)), parts_for(nodes.count()))
    return PV.extra_records(R.read_br_nodes(spark, path), processed)


def io_create_once(spark: SparkSession, sf: str) -> DataFrame:
    """A new table, and the refusal to write it again."""
    path, w = _folder(spark, "create"), A.work_records(spark, sf).select("id", "type")
    W.create(w, path)
    try:
        W.create(w, path)
        refused = False
    except AnalysisException:
        refused = True
    return spark.read.parquet(path).select("id", "type", F.lit(refused).alias("refused"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in [
        meta_primary_entities, meta_venues, meta_responsible_agents, meta_primary_entities_new_only,
        meta_unparsable_agents,
        pids_works, pids_sources, pids_authors, pids_institutions, pids_publishers, pids_funders,
        pid_index_by_scheme,
        map_all, map_one_to_one, map_multi, map_unmapped, map_new_only, map_venues_untyped, outcome_counts,
        mm_ids_distinct, full_metadata_semi_join,
        flat_sources, flat_sources_ids, flat_sources_keep_first, flat_sources_counts, flat_works, flat_primary_locations, flat_locations,
        flat_best_oa_locations, flat_authorships, flat_biblio, flat_concepts, flat_works_ids, flat_mesh,
        flat_open_access, flat_referenced, flat_related, upsert_keep_last,
        mm_categories_works, mm_categories_keep_last, mm_categories_sources, mm_category_counts, mm_category_pivot,
        prov_sources_per_br, prov_dropped_graphs, prov_extra_brs, prov_missing, prov_counts, prov_by_type, prov_pivot,
        prov_contribution,
        mm_composition, mm_filter, mm_distribution, mm_type_stats, mm_histogram, mm_api_urls,
        inverted_multi_mapped, venue_row_overlap, coverage_meta, coverage_openalex,
        io_csv_tables, io_json_lines, io_openalex_dump, io_counts_document, io_append_upsert, io_create_once,
        io_partial_upsert, io_single_csv, io_inverted_pairs, io_matching_records, meta_reduced_tables, pid_index_lookup,
        io_zipped_meta, io_zipped_graphs, io_zipped_nodes,
    ]
}

