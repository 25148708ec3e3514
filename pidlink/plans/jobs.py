"""The three jobs (mapping, categorisation, provenance) composed from the operators.

Functions here take and return DataFrames; the ``run_*`` wrappers at the end read the
dumps and write the outputs.
Intermediate results that several consumers share (the mapping result) are cut from
their lineage with a reliable checkpoint in the cluster's shared checkpoint folder.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pidlink.operators import categorize as C
from pidlink.operators import extract as X
from pidlink.operators import flatten as FL
from pidlink.operators import mapping as M
from pidlink.operators import pids as P
from pidlink.operators import provenance as PV
from pidlink.session import cut_lineage, parts_for, scratch_folder
from pidlink.sources.dumps import Dump


# ------------------------------------------------------------------ E1 mapping


@dataclass
class MappingResult:
    meta: DataFrame
    all_rows: bool
    primary_entities: DataFrame
    index: DataFrame
    index_in_place: bool = False

    @cached_property
    def keyed(self) -> DataFrame:
        """The records with their keys, which are read by the join and by the resolution of PID sets:
        they are stored once."""
        entities = self.primary_entities if self.all_rows else self.primary_entities.where(~X.has_openalex_id("ids"))
        return cut_lineage(M.keyed_records(entities, ["omid", "type"]))

    @cached_property
    def result(self) -> DataFrame:
        """omid, type, openalex_ids, n_openalex, outcome."""
        return M.map_records(self.keyed, self.index, index_in_place=self.index_in_place)

    @property
    def venues(self) -> DataFrame:
        return X.venues(self.meta, self.all_rows)

    @property
    def responsible_agents(self) -> DataFrame:
        return X.responsible_agents(self.meta, self.all_rows)

    def mapped(self) -> DataFrame:
        return M.mapped(self.result)

    def multi_mapped(self) -> DataFrame:
        return M.multi_mapped(self.result)

    def multi_mapped_listed(self) -> C.Listed:
        """``multi_mapped`` with each id list once: no list is written once per record."""
        lists = M.multi_mapped_lists(self.keyed, self.index).withColumnRenamed("_key", "_list")
        return C.Listed(self.keyed.withColumnRenamed("_key", "_list"), lists)

    def unmapped(self) -> DataFrame:
        return M.unmapped(self.result)


def build_index(works: DataFrame, sources: DataFrame) -> DataFrame:
    return P.pid_index(P.work_pids(works), P.source_pids(sources))


def mapping_job(meta: DataFrame, works: DataFrame, sources: DataFrame, *, all_rows: bool = True,
                index: DataFrame | None = None, index_in_place: bool = False) -> MappingResult:
    """Meta rows x OpenAlex Works/Sources -> reduced Meta tables, PID index, mapping."""
    entities = X.primary_entities(meta, all_rows=all_rows)
    idx = index if index is not None else build_index(works, sources)
    return MappingResult(meta, all_rows, entities, idx, index_in_place)


def map_venues(venues: DataFrame, index: DataFrame, index_in_place: bool = False) -> DataFrame:
    """Mapping of the venue table, which has no type column."""
    keyed = cut_lineage(M.keyed_records(venues, ["omid"]))
    return M.map_records(keyed, index, type_field=False, index_in_place=index_in_place)


# ------------------------------------------------------------------ E2 categorisation


def work_attributes(multi_mapped: DataFrame, works: DataFrame) -> DataFrame:
    """Attributes of the multi-mapped Works (semi join), one row each, for the categories."""
    needed = [c for c in ("id", "type", "ids", "primary_location", FL.ORD) if c in works.columns]  # prunes the scan
    keys = FL.mm_oaids(multi_mapped).where(F.col("entity") == "works")
    return FL.work_attributes(FL.select_records(works.select(*needed), keys))


def source_ids_table(multi_mapped: DataFrame, sources: DataFrame,
                     order: dict[str, list[str]] | None = None) -> DataFrame:
    """``sources_ids`` of the Sources that multi-mapped records name (first record per id),
    loaded keyed."""
    narrow = sources.select(*[c for c in ("id", "ids", FL.ORD) if c in sources.columns])
    narrow = FL.select_records(narrow, FL.mm_oaids(multi_mapped).where(F.col("entity") == "sources"))
    return FL.load_tables({"sources_ids": FL.flatten_sources(narrow)["sources_ids"]}, order)["sources_ids"]


class Categories:
    """Categories of the multi-mapped records. Each side is built on first use, so asking
    for the Sources categories never selects Works."""

    def __init__(self, multi_mapped: DataFrame | C.Listed, works: DataFrame, sources: DataFrame):
        self.multi_mapped, self._works_in, self._sources_in = multi_mapped, works, sources
        self._id_lists = multi_mapped.lists if isinstance(multi_mapped, C.Listed) else multi_mapped
        self._works = self._sources = None

    @property
    def works(self) -> DataFrame:
        if self._works is None:
            self._works = C.categorize_by_attributes(self.multi_mapped, work_attributes(self._id_lists, self._works_in))
        return self._works

    @property
    def sources(self) -> DataFrame:
        if self._sources is None:
            self._sources = C.categorize_sources(self.multi_mapped, source_ids_table(self._id_lists, self._sources_in))
        return self._sources

    def counts(self) -> DataFrame:
        return C.category_counts(self.works, self.sources)


def categorisation_job(multi_mapped: DataFrame | C.Listed, works: DataFrame, sources: DataFrame,
                       materialize: bool = True) -> Categories:
    """``multi_mapped`` is read by the id selection and by both classifiers: it (of a listed one, its
    lists) is checkpointed once unless the caller passes an already stored table."""
    if materialize and isinstance(multi_mapped, C.Listed):
        multi_mapped = C.Listed(multi_mapped.rows, cut_lineage(multi_mapped.lists))
    elif materialize:
        multi_mapped = cut_lineage(multi_mapped)
    return Categories(multi_mapped, works, sources)


# ------------------------------------------------------------------ E3 provenance


@dataclass
class ProvenanceResult:
    provenance: DataFrame  # br_uri, sources
    extra: DataFrame  # omid, type, omid_only
    records: DataFrame  # extra + unmapped
    counts: DataFrame  # type, source, omid_only, other_pids, total, type_total
    missing: DataFrame  # omid, type


def provenance_job(graphs: DataFrame, br_nodes: DataFrame, primary_entities: DataFrame,
                   unmapped: DataFrame) -> ProvenanceResult:
    """The provenance of each graph is stored once, for the dictionary of sources and for the masks. The
    nodes are counted first: the set of processed records, which is about as large, is dealt by that."""
    graphs = cut_lineage(PV.graph_provenance(graphs))
    prov = PV.provenance_table(graphs)
    extra = PV.extra_records(br_nodes, PV.processed_omids(primary_entities, parts_for(br_nodes.count())))
    records = PV.records_to_trace(extra, unmapped)
    names = PV.source_names(graphs)
    if names is None:  # too many sources for masks: their texts, as in the provenance table
        return ProvenanceResult(prov, extra, records, PV.provenance_counts(records, prov), PV.missing_provenance(records, prov))
    masks = PV.provenance_masks(graphs, names)
    return ProvenanceResult(prov, extra, records, PV.provenance_counts_by_mask(records, masks, names), PV.missing_provenance(records, masks))


# ------------------------------------------------------------------ storage-level wrappers


def _write_rejected(spark, tables: dict[str, DataFrame], lines: dict[str, int], out_dir: str) -> dict[str, str]:
    """Write each table of rejected input, and ``rejected_counts`` (name, n, n_read) of all: n is a
    metric of the pass that writes the table, n_read the lines of its dump (NULL for cells)."""
    paths = {name: f"{out_dir}/{name}" for name in (*tables, "rejected_counts")}
    counts = []
    for name, df in tables.items():
        n = Observation()
        df.observe(n, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(paths[name])
        counts.append((name, n.get["n"], lines.get(name)))
    spark.createDataFrame(counts, "name string, n long, n_read long").coalesce(1).write.mode("overwrite").parquet(paths["rejected_counts"])
    return paths


def _rejected_lines(works: Dump, sources: Dump) -> tuple[dict[str, DataFrame], dict[str, int]]:
    dumps = {"malformed_works": works, "malformed_sources": sources}
    return {k: d.malformed for k, d in dumps.items()}, {k: d.counts["lines"] for k, d in dumps.items()}


def run_mapping(spark, meta_dump: str, works_dir: str, sources_dir: str, out_dir: str, *,
                all_rows: bool = True, rows_per_file: int = 10_000, index_table: str | None = None,
                index_buckets: int = 0, rebuild_index: bool = False, single_file: bool = False) -> dict[str, str]:
    """Meta dump (zip or CSV folder) + OpenAlex Works/Sources dumps -> CSV folders:
    ``primary_ents``, ``venues``, ``resp_ags``, ``pid_index`` (parquet, by lookup table),
    ``pid_lists`` (one row per PID, what the mappings join), ``mapped``, ``multi_mapped``,
    ``non_mapped``, and the same three for venues (``venues_*``, without type).

    An index that is already there is an error unless ``rebuild_index``. The multi-mapped
    tables are folders like the others; ``single_file`` asks for one file each, which one
    task then writes. Nothing is left out silently: lines of the dumps that are no JSON go to
    ``malformed_works`` and ``malformed_sources``, cells that cannot be parsed to
    ``unparsable_venues`` and ``unparsable_agents``, and ``rejected_counts`` has their numbers.

    With ``index_table`` and ``index_buckets`` the index is stored as a bucketed catalog
    table instead, so both mappings (and later runs) join it without shuffling it.
    """
    from pidlink.sources import dumps as D
    from pidlink.sources import readers as R
    from pidlink.sources import schemas as SC
    from pidlink.sources import sinks as W

    index_mode = "overwrite" if rebuild_index else "errorifexists"
    write_multi = W.write_single_csv if single_file else lambda df, path: W.write_csv(df, path, rows_per_file)
    paths = {k: f"{out_dir}/{k}" for k in ("primary_ents", "venues", "resp_ags", "pid_index", "mapped",
                                           "multi_mapped", "non_mapped", "venues_mapped", "venues_multi_mapped",
                                           "venues_non_mapped", "pid_lists")}
    if not (rebuild_index or index_table) and R.is_folder(spark, paths["pid_index"]):
        raise AnalysisException(f"there is an index already: {paths['pid_index']}")  # before the dumps are read
    with scratch_folder(spark, "mapping") as scratch:
        # one scan of each dump: ids, PIDs and rejected lines are stored, everything else reads those
        works = D.parse_dump(spark, works_dir, SC.work_schema(), with_order=False)
        works = D.keep(works.select("id", P.work_pid_array(works).alias("pids"), D.CORRUPT), f"{scratch}/works")
        sources = D.parse_dump(spark, sources_dir, SC.source_schema(), with_order=False)
        sources = D.keep(sources.select("id", P.source_pid_array(sources).alias("pids"), D.CORRUPT), f"{scratch}/sources")
        built = P.pid_index(P.exploded_pids(works.records), P.exploded_pids(sources.records))
        if index_table and index_buckets > 0:
            P.write_bucketed_index(built, index_table, index_buckets, mode=index_mode)
            index = spark.table(index_table)
            paths["pid_index"] = index_table
        else:
            P.write_pid_index(built, paths["pid_index"], mode=index_mode)
            M.pid_lists(spark.read.parquet(paths["pid_index"])).write.mode("overwrite").parquet(paths["pid_lists"])  # read by both mappings
            index = spark.read.parquet(paths["pid_lists"])
        # one parse of the Meta dump, of the columns the tables read
        meta = cut_lineage(R.read_meta_dump(spark, meta_dump, ("id", "author", "venue", "type", "publisher", "editor")))
        m = mapping_job(meta, works.records, sources.records, all_rows=all_rows, index=index,
                        index_in_place=bool(index_table))
        W.write_csv(m.primary_entities, paths["primary_ents"], rows_per_file)
        W.write_csv(m.venues, paths["venues"], rows_per_file)
        W.write_csv(m.responsible_agents, paths["resp_ags"], rows_per_file)
        result = cut_lineage(m.result)  # three outputs from one computation
        W.write_csv(M.mapped(result), paths["mapped"], rows_per_file)
        write_multi(M.multi_mapped(result), paths["multi_mapped"])
        W.write_csv(M.unmapped(result), paths["non_mapped"], rows_per_file)
        vres = cut_lineage(map_venues(spark.read.options(**R.CSV_OPTIONS).csv(paths["venues"]), index, bool(index_table)))
        W.write_csv(M.mapped(vres), paths["venues_mapped"], rows_per_file)
        write_multi(M.multi_mapped(vres), paths["venues_multi_mapped"])
        W.write_csv(M.unmapped(vres), paths["venues_non_mapped"], rows_per_file)
        tables, lines = _rejected_lines(works, sources)
        tables |= {"unparsable_venues": X.unparsable_venues(meta), "unparsable_agents": X.unparsable_agents(meta)}
        return paths | _write_rejected(spark, tables, lines, out_dir)


def _only(schema: StructType, *names: str) -> StructType:
    return StructType([schema[n] for n in names])


def run_categorisation(spark, multi_mapped_dir: str, works_dir: str, sources_dir: str, out_dir: str) -> dict[str, str]:
    """Multi-mapped CSV folder + OpenAlex dumps -> per-row categories (CSV), counts (CSV)
    and the nested counts document (JSON). Each dump is scanned once; only the lines of
    multi-mapped ids are parsed. Rejected lines go to ``malformed_works`` and
    ``malformed_sources``, their numbers to ``rejected_counts``."""
    from pidlink.sources import dumps as D
    from pidlink.sources import readers as R
    from pidlink.sources import schemas as SC
    from pidlink.sources import sinks as W

    mm = cut_lineage(R.read_csv_tables(spark, multi_mapped_dir))
    ids = cut_lineage(FL.mm_oaids(mm))
    paths = {k: f"{out_dir}/{k}" for k in ("works_categories", "sources_categories", "counts", "counts_json")}
    with scratch_folder(spark, "categorisation") as scratch:
        works = D.keep_matching(spark, works_dir, _only(SC.work_schema(), "id", "type", "ids", "primary_location"),
                                ids.where("entity = 'works'").select("openalex_id"), f"{scratch}/works")
        sources = D.keep_matching(spark, sources_dir, _only(SC.source_schema(), "id", "ids"),
                                  ids.where("entity = 'sources'").select("openalex_id"), f"{scratch}/sources")
        cats = categorisation_job(C.listed(mm), works.records, sources.records)
        W.write_csv(cats.works, paths["works_categories"])
        W.write_csv(cats.sources, paths["sources_categories"])
        counts = cut_lineage(cats.counts())
        W.write_csv(counts, paths["counts"])
        W.write_document(C.nested_counts_json(counts), paths["counts_json"])
        return paths | _write_rejected(spark, *_rejected_lines(works, sources), out_dir)


def run_provenance(spark, br_rdf_zip: str, primary_ents_dir: str, non_mapped_dir: str, out_dir: str) -> dict[str, str]:
    """Meta RDF dump + processed primary entities + unmapped records -> extra records,
    provenance counts (CSV and nested JSON), the records without provenance, and the graphs
    that were left out, with their count. The archive is parsed once; graphs and records are
    kept in the shared checkpoint folder."""
    from pidlink.sources import readers as R
    from pidlink.sources import sinks as W

    graphs = cut_lineage(R.read_provenance_graphs(spark, br_rdf_zip))
    res = provenance_job(graphs, cut_lineage(R.read_br_nodes(spark, br_rdf_zip)),
                         R.read_csv_tables(spark, primary_ents_dir), R.read_csv_tables(spark, non_mapped_dir))
    paths = {k: f"{out_dir}/{k}" for k in ("extra_br", "counts", "counts_json", "missing")}
    W.write_csv(res.extra.select("omid", "type", W.flag_text("omid_only")), paths["extra_br"])
    counts = cut_lineage(res.counts)
    W.write_csv(counts, paths["counts"])
    W.write_document(W.provenance_document(counts), paths["counts_json"])
    W.write_csv(res.missing, paths["missing"])
    return paths | _write_rejected(spark, {"dropped_graphs": PV.dropped_graphs(graphs)}, {}, out_dir)


def run_inverted(spark, mapped_dir: str, out_dir: str, rows_per_file: int = 10_000) -> dict[str, str]:
    """1:1 CSV folder of a mapping -> ``inverted`` (CSV): the pairs whose OpenAlex record is reached
    by more than one Meta record."""
    from pidlink.operators import stats as S
    from pidlink.sources import readers as R
    from pidlink.sources import sinks as W

    pairs = S.inverted_multi_mapped(R.read_csv_tables(spark, mapped_dir, columns=("omid", "openalex_id")))
    W.write_csv(pairs, f"{out_dir}/inverted", rows_per_file)
    return {"inverted": f"{out_dir}/inverted"}


def run_analysis_tables(spark, multi_mapped_dir: str, works_dir: str, sources_dir: str, out_dir: str,
                        mode: str = "errorifexists") -> dict[str, str]:
    """Multi-mapped table + OpenAlex dumps -> the analysis database as Parquet folders: the
    full records of the multi-mapped Works (``mm_works``), and the 15 flattened tables of
    those Works and of all Sources, each loaded keyed (the last record of a key wins; Sources
    by their first). A table that is already there is an error unless ``mode`` says otherwise.

    Each dump is scanned once and stored by columns: of the Works only the lines of multi-mapped
    ids are parsed, and each table then reads its own columns of the stored records. Rejected
    lines and their numbers are written as in ``run_categorisation``."""
    from pidlink.sources import dumps as D
    from pidlink.sources import readers as R
    from pidlink.sources import schemas as SC

    keys = FL.mm_oaids(R.read_csv_tables(spark, multi_mapped_dir)).where(F.col("entity") == "works")
    paths = {"mm_works": f"{out_dir}/mm_works"}
    with scratch_folder(spark, "analysis") as scratch:
        works = D.keep_matching(spark, works_dir, SC.work_schema(), keys.select("openalex_id"), f"{scratch}/works")
        works.records.write.mode(mode).parquet(paths["mm_works"])
        sources = D.keep(D.parse_dump(spark, sources_dir, SC.source_schema()), f"{scratch}/sources")
        tables = FL.load_tables(FL.flatten_sources(sources.records) | FL.flatten_works(works.records))
        for name, df in tables.items():
            paths[name] = f"{out_dir}/{name}"
            df.write.mode(mode).parquet(paths[name])
        return paths | _write_rejected(spark, *_rejected_lines(works, sources), out_dir)
