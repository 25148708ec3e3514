"""Writers for the job outputs (Spark's committers make every write all-or-nothing).

* CSV directories with a header, every field quoted, rolled every ``rows_per_file`` rows.
* JSON-lines directories (non-ASCII kept), same rolling.
* One CSV file, only on request. All tasks write it, each at its place, if the path is mounted.
* Nested JSON result documents, built from small, already aggregated tables.
* Appends, keyed upserts (keep-last), and refusal to overwrite an existing table.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pidlink.functions import constants as K
from pidlink.operators.flatten import keep_last


def write_csv(df: DataFrame, path: str, rows_per_file: int = K.ROWS_PER_FILE, mode: str = "overwrite") -> None:
    """Header, all fields quoted (doubled inner quotes), at most ``rows_per_file`` rows per file."""
    (df.write.mode(mode).option("header", "true").option("quoteAll", "true").option("escape", '"')
     .option("maxRecordsPerFile", rows_per_file).csv(path))


#: Bytes of a single file that a task copies to their place, and of one read.
PLACED_BYTES, BLOCK_BYTES = 64 << 20, 1 << 20

#: A stretch of a part: file, first byte, bytes, first byte in the single file.
Stretch = tuple[str, int, int, int]


def _stretches(parts: Sequence[tuple[str, int]], size: int) -> list[list[Stretch]]:
    """The parts (file, bytes) end to end, cut at every multiple of ``size``."""
    cut: list[list[Stretch]] = []
    at = 0
    for file, length in parts:
        done = 0
        while done < length:
            n = min(length - done, size - at % size)
            if at % size == 0:
                cut.append([])
            cut[-1].append((file, done, n, at))
            done, at = done + n, at + n
    return cut


def _place(whole: str, stretches: list[Stretch]) -> None:
    """Copy stretches to their places in a file that is there. Repeated, it writes the same bytes."""
    with open(whole, "r+b") as out:
        for file, start, length, at in stretches:
            out.seek(at)
            with open(file, "rb") as part:
                part.seek(start)
                while length:
                    block = part.read(min(BLOCK_BYTES, length))
                    if not block:
                        raise OSError(f"{file} is shorter than it was")
                    out.write(block)
                    length -= len(block)


def write_single_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One CSV file, rows in the order of the partitions.

    All tasks write parts beside the folder, then copy them to their places in the one file, at most
    PLACED_BYTES a task; the finished folder is renamed last. Files are written at places only on
    a path that the driver and every executor have mounted (as archives are); on another file system
    one task writes the table, which it streams.
    """
    spark = df.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    exists = fs.exists(folder)
    if fs.getUri().getScheme() != "file" or (exists and mode.lower() != "overwrite"):  # an append, or Spark's refusal
        write_csv(df.coalesce(1), path, rows_per_file=0, mode=mode)
        return
    name = uuid.uuid4().hex
    staged = fs.makeQualified(folder).suffix(f"-{name}")
    local = staged.toUri().getPath()
    try:
        rows = df.write.option("quoteAll", "true").option("escape", '"').option("header", "false")
        rows.csv(f"{staged.toString()}/parts")
        os.makedirs(f"{local}/one")
        with open(f"{local}/header", "w", encoding="utf-8") as f:
            f.write(",".join('"' + c.replace('"', '""') + '"' for c in df.columns) + "\n")
        parts = [(int(m[1]), f.path) for f in os.scandir(f"{local}/parts") if (m := re.match(r"part-(\d+)-", f.name))]
        files = [f"{local}/header", *(f for _, f in sorted(parts))]
        whole = f"{local}/one/part-00000-{name}-c000.csv"
        open(whole, "xb").close()
        cut = _stretches([(f, os.path.getsize(f)) for f in files], PLACED_BYTES)
        spark.sparkContext.parallelize(cut, len(cut)).foreach(lambda some: _place(whole, some))
        open(f"{local}/one/_SUCCESS", "xb").close()
        if exists:
            fs.delete(folder, True)
        elif (above := folder.getParent()) is not None:
            fs.mkdirs(above)
        one = spark._jvm.org.apache.hadoop.fs.Path(staged, "one")
        if not fs.rename(one, folder):
            raise OSError(f"cannot rename {one} to {path}")
    finally:
        fs.delete(staged, True)


def write_json_lines(df: DataFrame, path: str, rows_per_file: int = K.ROWS_PER_FILE, mode: str = "overwrite") -> None:
    """JSON lines; Spark writes non-ASCII characters as they are."""
    df.write.mode(mode).option("maxRecordsPerFile", rows_per_file).json(path)


def write_document(doc: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A text result of one column (e.g. nested counts JSON), its lines in order, as a single
    file. The lines are streamed into it; no row holds the whole document."""
    if len(doc.columns) != 1:
        raise ValueError("a document is one text column")
    doc.coalesce(1).write.mode(mode).text(path)


def _quoted(c: str) -> "F.Column":
    """A text as a JSON string."""
    q = F.to_json(F.array(F.col(c)))
    return q.substr(F.lit(2), F.length(q) - 2)


def provenance_document(counts: DataFrame) -> DataFrame:
    """{type: {source: {omid_only, other_pids}}} as the ordered lines of one JSON text, a line
    per (type, source); sources by total (descending) inside a type, types by their total
    (descending), as the keys are written in order.

    A row opens (closes) its type if its place in the order is the least (greatest) of the type,
    and the document if its type's place is the least (greatest) of all. The places are partial
    aggregates per type and one over the types, joined back; the lines are then sorted by
    ranges. So no task holds a type, however many sources it has.
    """
    n = F.col("omid_only") + F.col("other_pids")
    rows = counts.select("type", "source", "omid_only", "other_pids", n.alias("_n"), F.struct((-n).alias("n"), "source").alias("_at"))
    types = rows.groupBy(F.col("type").alias("_type")).agg(
        F.sum("_n").alias("_t"), F.min("_at").alias("_first"), F.max("_at").alias("_last"))
    place = F.struct((-F.col("_t")).alias("t"), F.col("_type").alias("type"))
    least, greatest = types.agg(F.min(place)).scalar(), types.agg(F.max(place)).scalar()
    types = types.select("*", place.eqNullSafe(least).alias("_begins"), place.eqNullSafe(greatest).alias("_ends"))
    rows = rows.join(types, rows["type"].eqNullSafe(types["_type"]))
    opens, closes = F.col("_at").eqNullSafe(F.col("_first")), F.col("_at").eqNullSafe(F.col("_last"))
    line = F.concat(
        F.when(opens & F.col("_begins"), "{").otherwise(""),
        F.when(opens, F.concat(_quoted("type"), F.lit(": {"))).otherwise(""),
        _quoted("source"), F.lit(": "), F.to_json(F.struct("omid_only", "other_pids")),
        F.when(~closes, ",").when(F.col("_ends"), "}}").otherwise("},"))
    return rows.orderBy(F.col("_t").desc(), "type", F.col("_n").desc(), "source").select(line.alias("json"))


def flag_text(c: str) -> "F.Column":
    """A boolean flag as the text the source tables use: 'True' or empty."""
    return F.when(F.col(c), F.lit("True")).otherwise(F.lit("")).alias(c)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def create(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Write a new table; fails if it already exists."""
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def upsert(existing: DataFrame, incoming: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Keyed upsert: rows of ``incoming`` replace rows of ``existing`` with the same key;
    among incoming rows with one key the last in ``order`` (a numeric load-order column)
    wins. Returns the merged table: write it to a new location, then swap."""
    cols = list(existing.columns)
    old = existing.select(*cols, F.lit(0).alias("_gen"), F.lit(None).cast("long").alias("_seq"))
    new = incoming.select(*cols, F.lit(1).alias("_gen"), F.col(order).cast("long").alias("_seq"))
    return keep_last(old.unionByName(new), keys, ["_gen", "_seq"])
