"""JSON-lines dumps read once: records, rejected lines and their counts come from one scan.

``parse_dump`` parses every line; ``keep`` stores what a job needs of it, rejected lines included,
in a scratch folder as Parquet, so that later steps read columns of the stored rows and never
the dump again. The numbers of lines and of rejected ones are metrics of that same pass.

``keep_matching`` is for a job that needs few records of a large dump: the id is taken off the raw
line, the line is joined with the asked-for ids, and only surviving lines are parsed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pidlink.functions import constants as K
from pidlink.functions import strip_prefix

CORRUPT = "_corrupt_record"
#: Load order of a record: file, then position in the scan.
ORD = "_ord"

#: The id that a line begins with, as OpenAlex writes its records.
_LEADING_ID = r'^\s*\{\s*"id"\s*:\s*"([^"\\]+)"'


@dataclass
class Dump:
    """What was kept of a dump: the stored rows, and the counts ``lines`` and ``malformed``."""

    rows: DataFrame
    counts: dict[str, int]

    @property
    def records(self) -> DataFrame:
        return self.rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT)

    @property
    def malformed(self) -> DataFrame:
        return self.rows.where(F.col(CORRUPT).isNotNull()).select(CORRUPT)


def _order() -> Column:
    return F.struct(F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_pos")).alias(ORD)


def parse_dump(spark: SparkSession, path: str, schema: StructType, glob: str = "*.gz", with_order: bool = True) -> DataFrame:
    """All lines of a dump (recursive directory walk, ``glob`` files only), parsed: the columns of
    ``schema``, ``_corrupt_record`` (the text of a line that is no JSON, else NULL) and ``_ord``."""
    full = schema if CORRUPT in schema.fieldNames() else StructType([*schema.fields]).add(CORRUPT, "string")
    raw = (
        spark.read.schema(full)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .json(path)
    )
    return raw.select(*full.fieldNames(), *([_order()] if with_order else []))


def _stored(rows: DataFrame, folder: str, lines: Observation) -> Dump:
    bad = Observation()
    rows.observe(bad, F.count(CORRUPT).alias("malformed")).write.mode("overwrite").parquet(folder)
    return Dump(rows.sparkSession.read.schema(rows.schema).parquet(folder), lines.get | bad.get)


def keep(rows: DataFrame, folder: str) -> Dump:
    """Store rows of a parsed dump (columns picked from ``parse_dump``, ``_corrupt_record`` among
    them) in ``folder``."""
    lines = Observation()
    return _stored(rows.observe(lines, F.count(F.lit(1)).alias("lines")), folder, lines)


def keep_matching(spark: SparkSession, path: str, schema: StructType, ids: DataFrame, folder: str, glob: str = "*.gz") -> Dump:
    """Store the records of a dump whose id (URL prefix stripped) is in ``ids``, a column of distinct ids.

    Lines are joined by the id they begin with (or hold, where it does not come first) and parsed
    after the join. Rejected are lines without an id, lines that do not end as an object does, and
    surviving lines that are no JSON; other lines are not parsed, so not judged further.
    """
    line = F.col("value")
    leading = F.regexp_extract(line, _LEADING_ID, 1)
    found = F.when(leading != "", leading).otherwise(F.get_json_object(line, "$.id"))
    lines = Observation()
    text = (spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).text(path)
            .select("value", _order(), found.alias("_id")).where(F.trim(line) != "").observe(lines, F.count(F.lit(1)).alias("lines")))
    wanted = ids.select(F.col(ids.columns[0]).alias("_key"), F.lit(True).alias("_wanted"))
    broken = F.col("_id").isNull() | ~F.rtrim(line).endswith("}")
    kept = (text.join(wanted, strip_prefix(F.col("_id"), K.OPENALEX_URI) == F.col("_key"), "left")
            .select("value", ORD, "_wanted", broken.alias("_broken")).where(F.col("_broken") | F.col("_wanted")))
    full = StructType([*schema.fields]).add(CORRUPT, "string")
    parsed = F.when(~F.col("_broken"), F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}))
    rows = kept.select("value", "_broken", ORD, parsed.alias("r")).select(
        *(F.col("r").getField(c).alias(c) for c in schema.fieldNames()), ORD,
        F.when(F.col("_broken"), F.col("value")).otherwise(F.col("r").getField(CORRUPT)).alias(CORRUPT))
    return _stored(rows, folder, lines)
