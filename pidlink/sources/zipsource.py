"""Python Data Sources for zip archives, in Arrow batches and bounded memory.

The driver only lists the archive's central directory and packs members into partitions by their
compressed size; every task opens the archive itself and streams its own members, in the order in
which they lie in the file. A task holds one Arrow batch, one read-ahead chunk and the element or
row it is reading, however large a member or a nested archive is. The archive path must be
reachable from the executors (shared file system).

* ``pidlink_zipcsv``  -- CSV members (header row, unix dialect: quoted fields, doubled
  quotes, embedded newlines), all columns text, matched by name member by member; a field that a
  row or a member lacks is NULL.
* ``pidlink_zipjson`` -- JSON-list documents, directly in the archive or inside zips
  nested in it; one output row (column ``json``) per list element, as JSON text, to be
  parsed with ``from_json``. The text is only split here, at the brackets outside of strings; it is
  parsed once, in the JVM. A document that is one object is one row.
"""

from __future__ import annotations

import csv
import io
import os
import re
import zipfile
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StringType, StructField, StructType

FIELD_SIZE_LIMIT = 131072 * 12
#: Members are packed into partitions of about so many compressed bytes.
PARTITION_BYTES = 32 << 20
#: Arrow batches end at so many bytes of text, or rows.
BATCH_BYTES, BATCH_ROWS = 1 << 20, 4096
CHUNK = 256 << 10


@dataclass
class MemberPartition(InputPartition):
    path: str
    members: tuple[str, ...]


def packed(path: str, suffix: str, exclude: str | None, partition_bytes: int) -> list[MemberPartition]:
    """Members of an archive (of each ``*.zip`` of a folder), in file order, in groups of about
    ``partition_bytes`` compressed."""
    if os.path.isdir(path):
        archives = sorted(os.path.join(path, f) for f in os.listdir(path) if f.endswith(".zip"))
        return [part for a in archives for part in packed(a, suffix, exclude, partition_bytes)]
    with zipfile.ZipFile(path) as z:
        members = [m for m in z.infolist() if m.filename.endswith(suffix) and not (exclude and exclude in m.filename)]
    groups: list[list[str]] = []
    held = partition_bytes
    for m in sorted(members, key=lambda m: m.header_offset):
        if held + m.compress_size > partition_bytes:
            groups.append([])
            held = 0
        groups[-1].append(m.filename)
        held += m.compress_size
    return [MemberPartition(path, tuple(g)) for g in groups]


def text_batches(rows: Iterable[tuple[str | bytes | None, ...]], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows of texts (as strings, or as UTF-8) as Arrow batches of bounded size."""
    held: list[tuple] = []
    size = 0

    def taken() -> pa.RecordBatch:
        columns = [pa.array(c, pa.binary() if any(isinstance(v, bytes) for v in c) else pa.string()).cast(pa.string()) for c in zip(*held)]
        held.clear()
        return pa.RecordBatch.from_arrays(columns, names)

    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row if v)
        if size >= BATCH_BYTES or len(held) >= BATCH_ROWS:
            yield taken()
            size = 0
    if held:
        yield taken()


# ------------------------------------------------------------------ CSV


def csv_rows(stream: BinaryIO, columns: list[str]) -> Iterator[tuple[str | None, ...]]:
    csv.field_size_limit(FIELD_SIZE_LIMIT)
    reader = csv.reader(io.TextIOWrapper(stream, encoding="utf-8", newline=""), dialect="unix")
    header = next(reader, [])
    at = {name: i for i, name in enumerate(header)}  # of two columns with one name the last counts
    places = [at.get(c, len(header)) for c in columns]
    missing = [None] * (len(header) + 1)
    for row in reader:
        if row:
            row = row[:len(header)] + missing[len(row):]  # short rows end in NULLs, as all do at the place past the header
            yield tuple(row[p] if p < len(row) else None for p in places)


class _ZipCsvReader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        self.path = options["path"].removeprefix("file://").removeprefix("file:")
        self.suffix = options.get("memberSuffix", ".csv")
        self.partition_bytes = int(options.get("partitionBytes", PARTITION_BYTES))
        self.columns = schema.fieldNames()

    def partitions(self):
        return packed(self.path, self.suffix, None, self.partition_bytes)

    def _rows(self, partition: MemberPartition):
        with zipfile.ZipFile(partition.path) as z:
            for member in partition.members:
                with z.open(member) as raw:
                    yield from csv_rows(raw, self.columns)

    def read(self, partition: MemberPartition):
        yield from text_batches(self._rows(partition), self.columns)


class ZipCsvSource(DataSource):
    """``spark.read.format('pidlink_zipcsv').schema('a string, b string').load(zip_path)``."""

    @classmethod
    def name(cls) -> str:
        return "pidlink_zipcsv"

    def schema(self):
        cols = self.options.get("columns")
        if not cols:
            raise ValueError("pidlink_zipcsv needs a schema or a 'columns' option")
        return StructType([StructField(c.strip(), StringType()) for c in cols.split(",")])

    def reader(self, schema: StructType) -> DataSourceReader:
        return _ZipCsvReader(self.options, schema)


# ------------------------------------------------------------------ JSON

#: A whole string, a bracket, or the quote of a string that does not end yet.
_TOKEN = re.compile(rb'"[^"\\]*(?:\\.[^"\\]*)*"|[\[\]{}]|"', re.S)


def json_elements(stream: BinaryIO) -> Iterator[bytes]:
    """The elements of a JSON list, as they are written, read piece by piece; the whole of a
    document that is one object. Elements must be objects or lists."""
    head = buf = b""
    while not buf or len(head) < 3:
        more = stream.read(CHUNK)
        if not more:
            break
        head += more
        buf = head.removeprefix(b"\xef\xbb\xbf").lstrip()
    if not buf:
        return
    listed = buf[:1] == b"["
    at = free = int(listed)  # scanned up to `at`; from `free` on, only blanks and commas may precede an element
    depth, start = 0, -1  # depth inside the element that began at `start`

    def between(text: bytes) -> None:
        if text.strip(b" \t\r\n,"):
            raise ValueError("elements of the document must be objects or lists")

    while True:
        stopped = len(buf)
        for m in _TOKEN.finditer(buf, at):
            c = buf[m.start()]
            if c == 0x22:  # a quote
                if m.end() - m.start() == 1:
                    stopped = m.start()  # the string's end is not read yet
                    break
                if depth == 0:
                    between(m.group())
            elif c in b"[{":
                if depth == 0:
                    between(buf[free:m.start()])
                    start = m.start()
                depth += 1
            elif depth == 0:  # the list ends
                between(buf[free:m.start()])
                return
            else:
                depth -= 1
                if depth == 0:
                    yield buf[start:m.end()]
                    start, free = -1, m.end()
                    if not listed:
                        return
        keep = start if depth else free
        more = stream.read(max(CHUNK, len(buf) - keep))  # a long element doubles the chunk: linear work
        if not more:
            raise ValueError("the JSON document ends early")
        buf = buf[keep:] + more
        at, start, free = stopped - keep, 0 if depth else -1, 0


class _ZipJsonReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"].removeprefix("file://").removeprefix("file:")
        self.suffix = options.get("memberSuffix", ".json")
        self.exclude = options.get("memberExclude")
        self.inner_suffix = options.get("innerSuffix")  # set -> members are zips holding JSON
        self.partition_bytes = int(options.get("partitionBytes", PARTITION_BYTES))

    def partitions(self):
        return packed(self.path, self.suffix, self.exclude, self.partition_bytes)

    def _elements(self, partition: MemberPartition) -> Iterator[bytes]:
        with zipfile.ZipFile(partition.path) as outer:
            for name in partition.members:
                with outer.open(name) as member:
                    if not self.inner_suffix:
                        yield from json_elements(member)
                        continue
                    # the nested archive is read through its seekable member, front to back
                    with zipfile.ZipFile(member) as inner:
                        for info in sorted(inner.infolist(), key=lambda i: i.header_offset):
                            if info.filename.endswith(self.inner_suffix):
                                with inner.open(info) as fh:
                                    yield from json_elements(fh)

    def read(self, partition: MemberPartition):
        yield from text_batches(((e,) for e in self._elements(partition)), ["json"])


class ZipJsonSource(DataSource):
    """``spark.read.format('pidlink_zipjson').option('memberSuffix', 'prov/se.zip')
    .option('innerSuffix', 'se.json').load(zip_path)`` -> rows ``json`` (text)."""

    @classmethod
    def name(cls) -> str:
        return "pidlink_zipjson"

    def schema(self):
        return StructType([StructField("json", StringType())])

    def reader(self, schema: StructType) -> DataSourceReader:
        return _ZipJsonReader(self.options)


def register(spark) -> None:
    spark.dataSource.register(ZipCsvSource)
    spark.dataSource.register(ZipJsonSource)
