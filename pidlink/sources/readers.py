"""Readers for the inputs of the three jobs.

* Meta CSV dump: a zip of CSV members (Python Data Source) or a directory of CSV files, matched by
  column name file by file.
* OpenAlex dump: gz JSON lines under a directory tree, read with an explicit schema (unknown keys
  ignored). Malformed lines give no records; ``dumps.keep``, ``copy_json_lines`` and
  ``read_json_records(counts=...)`` count them in the pass that reads the records.
* Meta RDF dump: JSON-LD graphs in nested zips (provenance graphs and resource nodes).
* Flat CSV / JSON outputs of earlier steps, and nested JSON result files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pidlink.sources import schemas as SC
from pidlink.sources import zipsource
from pidlink.sources.csvheaders import CSV_OPTIONS, read_csv_files  # noqa: F401 - the options are for callers too
from pidlink.sources.dumps import CORRUPT, parse_dump

META_COLUMNS = ("id", "title", "author", "issue", "volume", "venue", "page", "pub_date", "type", "publisher", "editor")


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether a path of any file system that Spark knows is an existing folder."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


def read_csv_tables(spark: SparkSession, *dirs: str, columns: tuple[str, ...] | None = None) -> DataFrame:
    """All ``*.csv`` files directly inside one or more directories, as text columns.

    Columns are matched by name, file by file: the files of one folder may have other column
    orders, and a column that a file lacks is NULL for its rows."""
    for d in dirs:
        if not is_folder(spark, d):
            raise ValueError(f"no such folder: {d}")
    return read_csv_files(spark, dirs, columns)


def read_meta_dump(spark: SparkSession, path: str, columns: tuple[str, ...] = META_COLUMNS) -> DataFrame:
    """Meta CSV dump: a directory of CSV files on any file system, or a zip archive (``.csv``
    members only), which must be on a path that the driver and every executor have mounted."""
    if is_folder(spark, path):
        return read_csv_tables(spark, path, columns=columns)
    return read_zipped_csv(spark, path, columns)


def read_zipped_csv(spark: SparkSession, path: str, columns: tuple[str, ...]) -> DataFrame:
    """The ``.csv`` members of a zip archive, or of all ``*.zip`` archives of a folder, by name."""
    zipsource.register(spark)
    schema = ", ".join(f"`{c}` string" for c in columns)
    return spark.read.format("pidlink_zipcsv").schema(schema).load(path)


def read_openalex(spark: SparkSession, path: str, schema: StructType, glob: str = "*.gz",
                  with_order: bool = True) -> tuple[DataFrame, DataFrame]:
    """OpenAlex JSON lines (recursive directory walk, ``glob`` files only): (records, malformed).

    Both come from one parse definition but are two DataFrames: using both scans the dump
    twice. A job that needs both keeps them with ``dumps.keep``, as the jobs here do.
    ``with_order`` adds ``_ord``, the load order (file path, then position in the scan),
    used by keep-first / keep-last loading. A gz file is one task: give the dump in files of
    about 128 MB, several per core, as the published ones are.
    """
    raw = parse_dump(spark, path, schema, glob, with_order)
    # A scan may not read the corrupt-record column alone (e.g. under ``count()``), so the
    # filter keeps a data column referenced.
    keep_id = F.length(F.coalesce(F.col("id").cast("string"), F.lit(""))) >= 0
    malformed = raw.where(F.col(CORRUPT).isNotNull() & keep_id).select("id", CORRUPT)
    return raw.where(F.col(CORRUPT).isNull()).drop(CORRUPT), malformed


def read_works(spark: SparkSession, path: str, glob: str = "*.gz") -> DataFrame:
    return read_openalex(spark, path, SC.work_schema(), glob)[0]


def read_sources(spark: SparkSession, path: str, glob: str = "*.gz") -> DataFrame:
    return read_openalex(spark, path, SC.source_schema(), glob)[0]


def read_json_records(spark: SparkSession, path: str, schema: StructType, counts: Observation | None = None) -> DataFrame:
    """Flat directory of uncompressed ``*.json`` lines (blank lines skipped). Malformed lines give
    no records; ``counts`` receives the numbers of ``lines`` and of ``malformed`` ones when the
    records are first computed in full."""
    raw = parse_dump(spark, path, schema, glob="*.json")
    if counts is not None:
        raw = raw.observe(counts, F.count(F.lit(1)).alias("lines"), F.count(CORRUPT).alias("malformed"))
    return raw.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def read_provenance_graphs(spark: SparkSession, br_zip: str) -> DataFrame:
    """Provenance graphs: outer members ``*prov/se.zip``, inner ``se.json`` (a JSON list)."""
    zipsource.register(spark)
    raw = (spark.read.format("pidlink_zipjson").option("memberSuffix", "prov/se.zip")
           .option("innerSuffix", "se.json").load(br_zip))
    return raw.select(F.from_json("json", SC.prov_graph_schema()).alias("g")).select("g.*")


def read_br_nodes(spark: SparkSession, br_zip: str) -> DataFrame:
    """Resource nodes: outer ``*.zip`` members outside ``prov`` paths, inner ``*.json`` lists
    of graphs, every ``@graph`` node."""
    zipsource.register(spark)
    raw = (spark.read.format("pidlink_zipjson").option("memberSuffix", ".zip").option("memberExclude", "prov")
           .option("innerSuffix", ".json").load(br_zip))
    graphs = raw.select(F.from_json("json", SC.br_graph_schema()).alias("g"))
    return graphs.select(F.explode("g.`@graph`").alias("n")).select("n.*")


def read_category_counts(spark: SparkSession, path: str) -> DataFrame:
    """A nested category-count result file back as the long table (entity, type, category, n)."""
    txt = spark.read.text(path, wholetext=True)
    m = F.from_json("value", "map<string, map<string, map<string, bigint>>>")
    return (
        txt.select(F.explode(m).alias("entity", "by_type"))
        .select("entity", F.explode("by_type").alias("type", "by_cat"))
        .select("entity", "type", F.explode("by_cat").alias("category", "n"))
    )


def read_provenance_counts(spark: SparkSession, path: str) -> DataFrame:
    """A nested provenance result file back as the long table (type, source, omid_only, other_pids)."""
    txt = spark.read.text(path, wholetext=True)
    m = F.from_json("value", "map<string, map<string, struct<omid_only: bigint, other_pids: bigint>>>")
    return (
        txt.select(F.explode(m).alias("type", "by_source"))
        .select("type", F.explode("by_source").alias("source", "c"))
        .select("type", "source", "c.omid_only", "c.other_pids")
    )


def copy_json_lines(spark: SparkSession, in_dir: str, out_dir: str, glob: str = "*.gz",
                    rows_per_file: int = 10_000) -> dict[str, int]:
    """Uncompressed copy of a JSON-lines dump, each line as written, rolled every ``rows_per_file``
    lines: well-formed lines in ``kind=lines`` of ``out_dir``, others in ``kind=malformed``. One pass
    writes both; returns the numbers of ``lines`` read and of ``malformed`` ones."""
    counts = Observation()
    malformed = F.get_json_object("value", "$").isNull()
    lines = (spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).text(in_dir).where(F.trim("value") != "")
             .select("value", F.when(malformed, "malformed").otherwise("lines").alias("kind")))
    lines = lines.observe(counts, F.count(F.lit(1)).alias("lines"), F.count_if(F.col("kind") == "malformed").alias("malformed"))
    lines.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).partitionBy("kind").text(out_dir)
    return counts.get
