"""PID tables of OpenAlex entities and the lookup index of the mapping.

Each extractor turns a DataFrame of OpenAlex records (``id`` plus an ``ids`` struct) into
rows ``(supported_id, openalex_id)``: one per distinct PID of a record, none when the
record has no PID. All narrow (``explode`` of a per-row array); no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pidlink.functions import constants as K
from pidlink.functions import non_blank, scheme, strip_prefix


def _field(ids: StructType | None, name: str) -> Column:
    """``ids.<name>`` when the struct has it, else NULL (unknown keys are simply absent)."""
    if ids is not None and name in ids.fieldNames():
        return F.col("ids").getField(name)
    return F.lit(None).cast("string")


def _ids_type(df: DataFrame) -> StructType | None:
    if "ids" not in df.columns:
        return None
    t = df.schema["ids"].dataType
    return t if isinstance(t, StructType) else None


def _prefixed(value: Column, label: str, uri: str | None = None) -> Column:
    v = strip_prefix(value, uri) if uri else value
    return F.when(value.isNotNull(), F.concat(F.lit(label + ":"), v))


def _wikidata(value: Column) -> Column:
    """Wikidata URL in http or https form; any other form is ignored."""
    return (
        F.when(value.startswith("http:"), F.concat(F.lit("wikidata:"), strip_prefix(value, K.WIKIDATA_HTTP_URI)))
        .when(value.startswith("https:"), F.concat(F.lit("wikidata:"), strip_prefix(value, K.WIKIDATA_HTTPS_URI)))
    )


def _clean(pids: Column) -> Column:
    return F.array_distinct(F.filter(pids, lambda x: x.isNotNull()))


def _explode_pids(df: DataFrame, pids: Column) -> DataFrame:
    oaid = strip_prefix(F.col("id"), K.OPENALEX_URI)
    return df.where(F.col("id").isNotNull()).select(F.explode(_clean(pids)).alias("supported_id"),
                                                    oaid.alias("openalex_id"))


def exploded_pids(rows: DataFrame) -> DataFrame:
    """PID table of rows (id, pids) that hold a record's PID array."""
    return _explode_pids(rows, F.col("pids"))


def work_pid_array(works: DataFrame) -> Column:
    """Distinct DOI, PMID, PMCID of a Work, URL prefix stripped, scheme prefix added."""
    t = _ids_type(works)
    return _clean(F.array(
        _prefixed(_field(t, "doi"), "doi", K.DOI_URI),
        _prefixed(_field(t, "pmid"), "pmid", K.PUBMED_URI),
        _prefixed(_field(t, "pmcid"), "pmcid", K.PMC_URI),
    ))


def work_pids(works: DataFrame) -> DataFrame:
    """One row per distinct Work PID: (supported_id, openalex_id)."""
    return _explode_pids(works, work_pid_array(works))


def source_pids(sources: DataFrame) -> DataFrame:
    """One row per distinct Source PID: (supported_id, openalex_id)."""
    return _explode_pids(sources, source_pid_array(sources))


def source_pid_array(sources: DataFrame) -> Column:
    """Every ISSN of a Source, its Wikidata id (http/https URL form only), and the ISSN-L
    only when the ISSN list is missing or empty."""
    t = _ids_type(sources)
    issn = _field(t, "issn") if t is not None and "issn" in t.fieldNames() else F.lit(None)
    issn = F.coalesce(issn.cast("array<string>"), F.array().cast("array<string>"))
    issn_l = _field(t, "issn_l")
    pids = F.concat(
        F.transform(issn, lambda i: F.concat(F.lit("issn:"), i)),
        F.array(
            _wikidata(_field(t, "wikidata")),
            F.when((F.size(issn) == 0) & non_blank(issn_l), F.concat(F.lit("issn:"), issn_l)),
        ),
    )
    return _clean(pids)


def author_pids(authors: DataFrame) -> DataFrame:
    """ORCID of Authors (experimental; never part of the mapping index)."""
    t = _ids_type(authors)
    return _explode_pids(authors, F.array(_prefixed(_field(t, "orcid"), "orcid", K.ORCID_URI)))


def _ror_wikidata_pids(df: DataFrame) -> DataFrame:
    t = _ids_type(df)
    return _explode_pids(df, F.array(_prefixed(_field(t, "ror"), "ror", K.ROR_URI), _wikidata(_field(t, "wikidata"))))


def institution_pids(institutions: DataFrame) -> DataFrame:
    """ROR and Wikidata of Institutions (experimental)."""
    return _ror_wikidata_pids(institutions)


def publisher_pids(publishers: DataFrame) -> DataFrame:
    """ROR and Wikidata of Publishers (experimental)."""
    return _ror_wikidata_pids(publishers)


def funder_pids(funders: DataFrame) -> DataFrame:
    """ROR and Wikidata of Funders (experimental)."""
    return _ror_wikidata_pids(funders)


EXTRACTORS = {
    "work": work_pids,
    "source": source_pids,
    "author": author_pids,
    "institution": institution_pids,
    "publisher": publisher_pids,
    "funder": funder_pids,
}


def openalex_ids_table(records: DataFrame, entity_type: str) -> DataFrame:
    """PID table of a whole dump of one entity type (work, source, author, ...)."""
    key = entity_type.lower().strip()
    if key not in EXTRACTORS:
        raise ValueError(f"the entity type '{entity_type}' is not supported")
    return EXTRACTORS[key](records)


def index_table_name(entity_type: str, id_type: str) -> str:
    """Name of one lookup table, e.g. ('work', 'doi') -> 'WorksDoi'."""
    return f"{entity_type.capitalize()}s{id_type.capitalize()}"


def _tagged(pid_table: DataFrame, entity_type: str, id_types: list[str]) -> DataFrame:
    """One pass over an entity's PID table, tagged with its lookup table name."""
    sch = scheme(F.col("supported_id"))
    name = F.lit(None).cast("string")
    for t in reversed(id_types):
        name = F.when(sch == t, F.lit(index_table_name(entity_type, t))).otherwise(name)
    return pid_table.select(name.alias("table_name"), sch.alias("scheme"), "supported_id", "openalex_id").where(
        sch.isin(*id_types))


def pid_index(work_pid_table: DataFrame, source_pid_table: DataFrame) -> DataFrame:
    """The lookup index of the mapping: (table_name, scheme, supported_id, openalex_id).

    Only the five Work/Source tables enter it, so a PID of another entity type (e.g. an
    institution's Wikidata id) can never be matched. Duplicates are kept: a PID shared by
    several OpenAlex records maps to all of them. Each dump's PID table is read once.
    """
    by_entity: dict[str, list[str]] = {}
    for entity, id_type in K.INDEX_TABLES:
        by_entity.setdefault(entity, []).append(id_type)
    return _tagged(work_pid_table, "work", by_entity["work"]).unionByName(
        _tagged(source_pid_table, "source", by_entity["source"]))


#: Bits of the Bloom filter of a row group are sized for so many distinct PIDs.
BLOOM_PIDS = 1_000_000
#: A look-up of at most so many PIDs is pushed into the scan of a stored index.
PUSHED_PIDS = 2_000


def write_pid_index(index: DataFrame, path: str, mode: str = "errorifexists", row_group_bytes: int = 32 << 20) -> None:
    """Persist the index partitioned by lookup table (a lookup then reads one partition), so that a
    small look-up reads few of its row groups.

    Rows are dealt to the writing tasks by ranges of (table, PID, OpenAlex id): no task holds a
    lookup table, nor all rows of a PID that very many records share. Inside a file they are
    sorted by PID, so the row groups of a table have disjoint PID ranges, and each row group has a
    Bloom filter of its PIDs. ``mode='errorifexists'`` mirrors the refusal to rebuild an existing table.
    """
    order = ["table_name", "supported_id", "openalex_id"]
    spread = index.repartitionByRange(*order).sortWithinPartitions(*order)
    (spread.write.mode(mode).partitionBy("table_name")
     .option("parquet.block.size", row_group_bytes)
     .option("parquet.bloom.filter.enabled#supported_id", "true")
     .option("parquet.bloom.filter.expected.ndv#supported_id", BLOOM_PIDS)
     .option("parquet.bloom.filter.adaptive.enabled", "true").parquet(path))


def index_of_pids(spark: SparkSession, path: str, pids: DataFrame) -> DataFrame:
    """The rows of a stored index whose PID is in ``pids`` (one column, repeats allowed).

    The PIDs of a small batch, at most PUSHED_PIDS, are counted first and go into the scan as a
    filter on the PID and on the tables they can stand in: Parquet then skips the row groups whose
    range or Bloom filter excludes all of them. More PIDs are a semi join.
    """
    wanted = pids.select(F.col(pids.columns[0]).alias("pid")).where(F.col("pid").isNotNull()).distinct()
    few = [r.pid for r in wanted.limit(PUSHED_PIDS + 1).collect()]
    # a session of its own: the filter goes down as single values, not as the range around them
    session = spark.newSession() if len(few) <= PUSHED_PIDS else spark
    index = session.read.parquet(path)
    if len(few) > PUSHED_PIDS:
        return index.join(wanted, F.col("supported_id") == F.col("pid"), "left_semi")
    session.conf.set("spark.sql.parquet.pushdown.inFilterThreshold", str(PUSHED_PIDS))
    schemes = {p.split(":", 1)[0] for p in few}
    tables = [index_table_name(entity, t) for entity, t in K.INDEX_TABLES if t in schemes]
    return index.where(F.col("table_name").isin(tables) & F.col("supported_id").isin(few))


def write_bucketed_index(index: DataFrame, table: str, buckets: int, mode: str = "errorifexists") -> None:
    """Store the index as a catalog table bucketed and sorted on ``supported_id``.

    A mapping that joins this table then shuffles only the (smaller) Meta side: the index,
    the largest input of the job, is read in place, bucket by bucket. Choose ``buckets``
    so one bucket is about 128-256 MB.
    """
    spread = index.repartition(buckets, "supported_id")  # one task per bucket: one file each
    spread.write.mode(mode).bucketBy(buckets, "supported_id").sortBy("supported_id").saveAsTable(table)


def index_summary(index: DataFrame) -> DataFrame:
    """Rows, distinct ids and duplicated ids per lookup table."""
    per_id = index.groupBy("table_name", "scheme", "supported_id").agg(F.count(F.lit(1)).alias("n"))
    return per_id.groupBy("table_name", "scheme").agg(
        F.sum("n").cast("bigint").alias("n_rows"),
        F.count(F.lit(1)).cast("bigint").alias("n_ids"),
        F.count(F.when(F.col("n") > 1, True)).cast("bigint").alias("n_shared_ids"),
    )
