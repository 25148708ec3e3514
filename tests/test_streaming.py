import os
import shutil

from conftest import golden, read_golden, rows

from pidlink.operators import pids as P
from pidlink.streaming.incremental import map_batch, start_incremental_mapping


def test_incremental_mapping_matches_batch(spark, tmpdir_path):
    inbox = os.path.join(tmpdir_path, "inbox")
    os.makedirs(inbox)
    shutil.copy(golden("meta_sample.csv"), os.path.join(inbox, "part1.csv"))
    idx = P.pid_index(read_golden(spark, "works_pid_index.csv"), read_golden(spark, "sources_pid_index.csv"))
    q = start_incremental_mapping(spark, inbox, idx, os.path.join(tmpdir_path, "out"),
                                  os.path.join(tmpdir_path, "ckpt"))
    q.awaitTermination(120)
    got = spark.read.parquet(os.path.join(tmpdir_path, "out"))
    exp = map_batch(read_golden(spark, "meta_sample.csv"), idx)
    cols = ["omid", "type", "openalex_id", "outcome"]
    assert rows(got, cols) == rows(exp, cols)
    assert got.where("outcome = 'mapped'").count() == 13
