"""Spark session defaults for the jobs, and the checkpoint folder rule."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that matter for this workload (see README "Scale"):
#  * AQE re-plans joins and coalesces small shuffle partitions at run time;
#  * skew join splits a shuffle partition holding a hot PID;
#  * files are read in 128 MB splits, shuffles sized for the cluster by the caller.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    # a tiny shuffle is not merged below 256 KB partitions, so CPU-heavy steps after it keep
    # several tasks (large shuffles are governed by the 128 MB advisory size)
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256KB",
    "spark.sql.files.maxPartitionBytes": "128MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app: str = "pidlink", shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    return b.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster in ``spark.checkpoint.dir``.

    Only a single-process session without one (master ``local`` or ``local[n]``: tests, a
    laptop) gets a scratch folder; on a cluster, ``local-cluster`` included, a machine-local folder would not be readable by other executors, so a missing
    setting is an error there.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        d = tempfile.mkdtemp(prefix="pidlink-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # core conf may be read-only at run time; the context setting below suffices
            pass
    current = re.sub(r"^\w+:(//[^/]*)?", "", spark.sparkContext.getCheckpointDir() or "")
    if not current.startswith(re.sub(r"^\w+:(//[^/]*)?", "", d).rstrip("/") + "/"):
        spark.sparkContext.setCheckpointDir(d)  # makes a folder of its own there each time, so once
    return d


@contextmanager
def scratch_folder(spark: SparkSession, name: str) -> Iterator[str]:
    """A new folder below the shared checkpoint folder, deleted when the block ends."""
    folder = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    try:
        yield folder
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Rows of a key table that a task of a join takes.
ROWS_A_TASK = 250_000


def parts_for(rows: int) -> int:
    """Partitions for so many rows. An adaptive plan sizes its tasks by compressed bytes and by the number
    of cores: of short keys, which compress well, a task then takes millions."""
    return max(1, -(-rows // ROWS_A_TASK))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
