"""Keyed tables: an update rewrites only the buckets it touches."""

import os
import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from pidlink.sources.keyed import KeyedTable

ROW = "k string, n long, v string, seq long"


def files(path):
    return {os.path.relpath(os.path.join(d, f), path) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def frame(spark, rows):
    return spark.createDataFrame(rows, ROW).repartition(3)


def content(table):
    return {(r.k, r.n): r.v for r in table.read().collect()}


def test_untouched_files_keep_their_names(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "t")
    t = KeyedTable.create(frame(spark, [(f"k{i}", i, "old", i) for i in range(400)]), path, ["k", "n"], ["seq"], buckets=16)
    before = files(path)
    assert len(before) == 16
    touched = t.update(frame(spark, [("k7", 7, "new", 1), ("k7", 7, "newer", 2), ("fresh", 1, "x", 1)]), ["seq"])
    after = files(path)
    assert 1 <= len(touched) <= 2
    assert {f for f in before if int(f.split("/")[0].split("=")[1]) not in touched} == before & after
    assert len(after) == 16 and len(before & after) == 16 - len(touched)
    want = {(f"k{i}", i): "old" for i in range(400)} | {("k7", 7): "newer", ("fresh", 1): "x"}
    assert content(t) == want == content(KeyedTable.open(spark, path, ["k", "n"]))
    assert not os.path.exists(path + "__staged") and not os.path.exists(path + "__staged_incoming")


def test_updates_match_a_dictionary(spark, tmpdir_path):
    rng = random.Random(3)
    path, want = os.path.join(tmpdir_path, "t"), {}

    def batch(n):
        return [(rng.choice([None, "", *"abcdefgh"]), rng.choice([None, 1, 2, 3]), f"v{rng.randrange(10**6)}", i) for i in range(n)]

    rows = batch(60)
    t = KeyedTable.create(frame(spark, rows), path, ["k", "n"], ["seq"], buckets=8)
    want.update({(r[0], r[1]): r[2] for r in rows})
    assert content(t) == want
    for n in (1, 0, 15, 3):
        rows = batch(n)
        t.update(frame(spark, rows), ["seq"])
        want.update({(r[0], r[1]): r[2] for r in rows})
        assert content(t) == want
    keys = spark.createDataFrame([(None, 1), ("a", 2), ("zz", 9)], "k string, n long")
    assert {(r.k, r.n): r.v for r in t.lookup(keys).collect()} == {k: v for k, v in want.items() if k in ((None, 1), ("a", 2))}


def test_lost_update_is_finished_from_its_stage(spark, tmpdir_path, monkeypatch):
    path = os.path.join(tmpdir_path, "t")
    t = KeyedTable.create(frame(spark, [(f"k{i}", i, "old", i) for i in range(50)]), path, ["k", "n"], ["seq"], buckets=4)
    original, calls = KeyedTable.recover, []

    def dies(self):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost while buckets are replaced")
        return original(self)

    monkeypatch.setattr(KeyedTable, "recover", dies)
    with pytest.raises(RuntimeError):
        t.update(frame(spark, [("k1", 1, "new", 1)]), ["seq"])
    monkeypatch.undo()
    assert content(t)["k1", 1] == "old"
    again = KeyedTable.open(spark, path, ["k", "n"])
    assert again.recover() and content(again)["k1", 1] == "new" and not again.recover()
    # a stage that was never completed is dropped
    os.makedirs(path + "__staged/_bucket_of_4=1")
    assert not again.recover() and not os.path.exists(path + "__staged") and len(content(again)) == 50


def test_create_once_and_open(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "t")
    rows = frame(spark, [("a", 1, "x", 1)])
    KeyedTable.create(rows, path, ["k"], ["seq"], buckets=2)
    with pytest.raises(AnalysisException):
        KeyedTable.create(rows, path, ["k"], ["seq"], buckets=2)
    rows.write.parquet(os.path.join(tmpdir_path, "plain"))
    with pytest.raises(ValueError):
        KeyedTable.open(spark, os.path.join(tmpdir_path, "plain"), ["k"])


def test_lookup_reads_only_the_buckets_of_its_keys(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "t")
    t = KeyedTable.create(frame(spark, [(f"k{i}", i, "v", i) for i in range(2000)]), path, ["k"], ["seq"], buckets=32)
    found = t.lookup(spark.createDataFrame([("k5",)], "k string"))
    assert [r.n for r in found.collect()] == [5]
    assert "PartitionFilters: [isnotnull(_bucket_of_32" in found._jdf.queryExecution().executedPlan().toString()
    assert found.select(F.input_file_name().alias("f")).distinct().count() == 1
