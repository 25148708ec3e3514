"""Shared helpers of the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pidlink.session import checkpoint_dir, scratch_folder

#: A word is a run of characters other than ASCII white space.
WORD = "[^\\x20\\x09-\\x0D]+"
GAP = "[\\x20\\x09-\\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


#: Folders that ``stored`` writes to, the innermost last; without any, the checkpoint folder.
_folders: list[str] = []


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Tables that operators store inside the block are deleted at its end: what the block returns
    must not read them any more."""
    with scratch_folder(spark, "llm") as folder:
        _folders.append(folder)
        try:
            yield
        finally:
            _folders.pop()


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back.

    Cuts the lineage like ``checkpoint()``, but compressed and column-wise, so that later
    readers prune columns. The files survive the loss of any executor.
    """
    base = _folders[-1] if _folders else checkpoint_dir(df.sparkSession)
    path = f"{base}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def n_words(text: Column) -> Column:
    """Number of words of a text as a long; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def pieces(batches: Iterable[pa.RecordBatch], column: str, max_bytes: int, max_rows: int) -> Iterator[pa.RecordBatch]:
    """Slices of Arrow batches that hold at most ``max_bytes`` of ``column`` and ``max_rows``
    rows (a single longer text is a slice of its own). Slices copy nothing."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
        first, held = 0, 0
        for i, size in enumerate(sizes):
            if i > first and (held + size > max_bytes or i - first >= max_rows):
                yield batch.slice(first, i - first)
                first, held = i, 0
            held += size
        if first < len(sizes):
            yield batch.slice(first)


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it (Spark ignores case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
