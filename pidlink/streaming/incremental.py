"""Incremental mapping: Meta CSV files dropped into a folder are mapped as they arrive.

A Structured Streaming file source watches the folder; each micro-batch holds the paths of the new
files, which are read by column name as in the batch job and mapped (extraction -> tiered lookup ->
join with the static PID index -> outcome) through ``foreachBatch``. Output is written per batch id
with overwrite, so a batch replayed after a failure rewrites the same files (exactly-once with
the stream checkpoint).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pidlink.operators import extract as X
from pidlink.operators import mapping as M
from pidlink.sources.csvheaders import read_csv_files
from pidlink.sources.readers import META_COLUMNS


def new_files(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of the paths of CSV files as they arrive; their content is not read."""
    r = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    r = r.option("pathGlobFilter", "*.csv")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(folder).select("path")


def map_batch(batch: DataFrame, index: DataFrame, all_rows: bool = True) -> DataFrame:
    """One micro-batch of Meta rows -> omid, type, openalex_id (text), n_openalex, outcome."""
    res = M.map_records(X.primary_entities(batch, all_rows=all_rows), index, all_rows=all_rows)
    return res.select("omid", "type", F.array_join("openalex_ids", " ").alias("openalex_id"), "n_openalex", "outcome")


def start_incremental_mapping(spark: SparkSession, meta_folder: str, index: DataFrame, out_folder: str,
                              checkpoint_location: str, *, available_now: bool = True,
                              all_rows: bool = True) -> StreamingQuery:
    """Start the stream; with ``available_now`` it processes what is there and stops."""

    def write(batch: DataFrame, batch_id: int) -> None:
        paths = [r["path"] for r in batch.collect()]  # the files of one trigger
        rows = read_csv_files(spark, paths, META_COLUMNS)
        map_batch(rows, index, all_rows).write.mode("overwrite").parquet(f"{out_folder}/batch_id={batch_id}")

    w = new_files(spark, meta_folder).writeStream.foreachBatch(write).option(
        "checkpointLocation", checkpoint_location)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
