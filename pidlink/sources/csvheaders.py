"""CSV folders read by column name, file by file.

Spark's CSV reader takes the columns of all files of one scan by position. Files of one folder
may have their columns in different order, or lack some; so the header of every file is read
first, in one distributed pass in which a task opens one file and stops after its first record (of
very many files, small ones share tasks).
Files with the same header then form one scan, whose columns are picked by name, and the scans
are united by name. Every scan stays a native one: only the asked-for columns are parsed. A large
file of which every line is a record, which one pass by lines finds out, is read by several tasks; one
with line breaks in quotes is one task.

What reaches the driver is one header per file, as the file list itself does.

Defined results: a column that a file lacks is NULL for its rows; of two columns with one name
the last counts; names are matched exactly; files without any record give no rows; a folder
without files gives an empty table of the asked-for columns.
"""

from __future__ import annotations

import csv
from collections.abc import Collection, Iterable, Iterator, Sequence
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Options that read the CSV dialect of the dumps back exactly: quoted fields, doubled quotes,
#: embedded newlines, and a quoted empty field kept as '' (never NULL).
CSV_OPTIONS = {"header": "true", "escape": '"', "multiLine": "true", "nullValue": "\u0000", "mode": "FAILFAST"}

#: A file counts as this large when files are dealt to tasks, so that each task gets one.
_ONE_FILE_A_TASK = str(1 << 40)
#: With more files a core than this, those up to so many bytes share tasks: reading one to its end
#: costs less than a task.
FILES_A_CORE, SHARED_BYTES = 32, 8 << 20


def _header(held: str) -> list[str] | None:
    """The header in the first lines of a file, if they hold a whole record."""
    if held.strip() and held.count('"') % 2 == 0:
        return next(csv.reader([held + "\n"], dialect="unix"))
    return None


def _first_records(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first record of the one file that a task reads, as (path, header)."""
    held = ""
    for batch in batches:
        for line, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            held = f"{held}\n{line}" if held else line.removeprefix("﻿")
            if (header := _header(held)) is not None:
                yield pa.RecordBatch.from_pydict({"path": [path], "header": [header]})
                return  # the rest of the file is not read


def _first_records_of_each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first record of each of the whole files that a task reads one after the other, as (path,
    header). Only the lines up to a file's first record become Python texts."""
    current, held, found = None, "", True
    for batch in batches:
        runs = pc.run_end_encode(batch.column(1))
        start = 0
        out: list[tuple[str, list[str]]] = []
        for path, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
            if path != current:
                current, held, found = path, "", False
            while start < end and not found:
                line = batch.column(0)[start].as_py()
                held = f"{held}\n{line}" if held else line.removeprefix("﻿")
                start += 1
                if (header := _header(held)) is not None:
                    out.append((path, header))
                    held, found = "", True
            start = end
        yield pa.RecordBatch.from_pydict({"path": [p for p, _ in out], "header": [h for _, h in out]},
                                         pa.schema([("path", pa.string()), ("header", pa.list_(pa.string()))]))


_HEADERS = "path string, header array<string>"

#: Above so many bytes, a file is read by several tasks if each of its lines is a record.
SPLIT_BYTES = 64 << 20
#: A line that is a record to both of Spark's CSV readers, the multi-line and the splitting one: fields are quoted as
#: a whole, or have no quotes. (Possessive: a long line takes no deep stack.)
_FIELD = r'(?:"(?:[^"\r\x00]++|"")*+"|[^",\r\x00]*+)'
_RECORD = rf"^(?=[\s\S]*[^\x00-\x20]){_FIELD}(?:,{_FIELD})*+$"


def split_headers(spark: SparkSession, paths: Sequence[str], glob: str = "*.csv") -> dict[str, list[str]]:
    """Header of each large file (more than SPLIT_BYTES) without any quoted line break, carriage return,
    stray quote or blank line: every line is a record, so tasks may begin at any line."""
    lines = spark.read.option("pathGlobFilter", glob).option("lineSep", "\n").text(list(paths))
    lines = lines.where(F.col("_metadata.file_size") > SPLIT_BYTES).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").rlike(_RECORD).alias("ok"),
        F.when(F.col("_metadata.file_block_start") == 0, F.col("value")).alias("line"))
    found = lines.groupBy("path").agg(F.bool_and("ok").alias("ok"), F.first("line", ignorenulls=True).alias("line")).where("ok").collect()
    headers = {r.path: _header(r.line.removeprefix("\ufeff")) for r in found}
    return {path: header for path, header in headers.items() if header is not None}


def all_headers(spark: SparkSession, paths: Sequence[str], glob: str = "*.csv", known: Collection[str] = ()) -> list[tuple[str, list[str]]]:
    """(path, header) of every CSV file with a record, without the ``known`` ones, sorted. Of very many files, the small ones are
    read several a task, to their ends; each larger one has a task that stops after its first record."""
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", str(128 << 20))  # none of the small files is split
    session.conf.set("spark.sql.files.openCostInBytes", str(1 << 20))
    lines = session.read.option("pathGlobFilter", glob).text(list(paths))
    parts = [file_headers(spark, paths, glob, known=known)]
    if len(lines.inputFiles()) > FILES_A_CORE * spark.sparkContext.defaultParallelism:
        small = lines.where(F.col("_metadata.file_size") <= SHARED_BYTES).select("value", "_metadata.file_path")
        parts = [file_headers(spark, paths, glob, SHARED_BYTES, known), small.mapInArrow(_first_records_of_each, _HEADERS)]
    return sorted((r["path"], r["header"]) for part in parts for r in part.collect())


def file_headers(spark: SparkSession, paths: Sequence[str], glob: str = "*.csv", above: int = -1, known: Collection[str] = ()) -> DataFrame:
    """(path, header) of every CSV file with a record that has more than ``above`` bytes, in the given
    folders or files, without the ``known`` ones: those are not opened."""
    session = spark.newSession()  # same context, settings of its own
    session.conf.set("spark.sql.files.maxPartitionBytes", _ONE_FILE_A_TASK)
    session.conf.set("spark.sql.files.openCostInBytes", _ONE_FILE_A_TASK)
    session.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    lines = session.read.option("pathGlobFilter", glob).text(list(paths))
    if above >= 0:
        lines = lines.where(F.col("_metadata.file_size") > above)
    if known:
        lines = lines.where(~F.col("_metadata.file_path").isin(list(known)))
    return lines.select("value", "_metadata.file_path").mapInArrow(_first_records, _HEADERS)


def _literal_path(uri: str) -> str:
    """A file's path for a reader: unescaped as an address, escaped against glob patterns."""
    return "".join("\\" + c if c in "\\*?[]{}" else c for c in unquote(uri))


def _column(header: tuple[str, ...], name: str) -> Column:
    at = [i for i, h in enumerate(header) if h == name]
    return (F.col(f"_{at[-1]}") if at else F.lit(None).cast("string")).alias(name)


def _scan(spark: SparkSession, paths: Sequence[str], header: tuple[str, ...], names: Sequence[str], glob: str, split: bool = False) -> DataFrame:
    """Files of one header, by position, named; ``split`` if each line of them is a record."""
    schema = ", ".join(f"`_{i}` string" for i in range(len(header)))
    options = CSV_OPTIONS | ({"multiLine": "false", "lineSep": "\n"} if split else {})
    rows = spark.read.options(**options).option("pathGlobFilter", glob).schema(schema).csv(list(paths))
    return rows.select(*(_column(header, n) for n in names))


def read_csv_files(spark: SparkSession, paths: Sequence[str], columns: Sequence[str] | None = None, glob: str = "*.csv") -> DataFrame:
    """All CSV files in folders or under file names, as text columns matched by name: those of
    ``columns``, or all, in the order of their first file."""
    split = split_headers(spark, paths, glob)
    headers = sorted([*all_headers(spark, paths, glob, known=split), *split.items()])
    by_header: dict[tuple[tuple[str, ...], bool], list[str]] = {}
    for path, header in headers:
        by_header.setdefault((tuple(header), path in split), []).append(_literal_path(path))
    names = list(columns or dict.fromkeys(n for header, _ in by_header for n in header))
    if len(by_header) <= 1:  # one header: the folders themselves are the scan
        only, whole = next(iter(by_header), (tuple(names), False))
        by_header = {(only, whole): list(paths)} if only else {}
    scans = [_scan(spark, files, header, names, glob, whole) for (header, whole), files in by_header.items()]
    if not scans:
        return spark.createDataFrame([], ", ".join(f"`{n}` string" for n in names))
    return reduce(DataFrame.unionByName, scans)
