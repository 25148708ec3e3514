"""CSV folders are read by column name, file by file."""

import os

import pytest
from conftest import read_golden, rows

from pidlink.operators import extract as X
from pidlink.operators import pids as P
from pidlink.sources import readers as R
from pidlink.sources.csvheaders import file_headers, read_csv_files
from pidlink.streaming.incremental import map_batch, start_incremental_mapping


def put(folder, **files):
    os.makedirs(folder, exist_ok=True)
    for name, text in files.items():
        with open(os.path.join(folder, f"{name}.csv"), "w", encoding="utf-8", newline="") as f:
            f.write(text)
    return folder


def test_files_of_one_folder_in_other_column_orders(spark, tmpdir_path):
    d = put(os.path.join(tmpdir_path, "mixed"), a='"omid","type"\n"omid:br/1","book"\n', b='"type","omid"\n"journal","omid:br/2"\n',
            c='"omid"\n"omid:br/3"\n', d='"type","omid","extra"\n"x","omid:br/4","e,""q"""\n')
    got = R.read_csv_tables(spark, d)
    assert got.columns == ["omid", "type", "extra"]
    assert {r["omid"]: (r["type"], r["extra"]) for r in got.collect()} == {
        "omid:br/1": ("book", None), "omid:br/2": ("journal", None), "omid:br/3": (None, None), "omid:br/4": ("x", 'e,"q"')}


def test_meta_folder_by_name(spark, tmpdir_path):
    d = put(os.path.join(tmpdir_path, "meta"), a='"editor","id","title"\n"editor-val","id-val","t\n2"\n')
    row = R.read_meta_dump(spark, d).collect()[0]
    assert (row["id"], row["editor"], row["title"], row["venue"]) == ("id-val", "editor-val", "t\n2", None)


def test_shuffled_meta_gives_the_same_entities(spark, tmpdir_path):
    """The sample's rows in one file per column order give the tables of the sample itself."""
    sample = read_golden(spark, "meta_sample.csv")
    names = sample.columns
    d = os.path.join(tmpdir_path, "orders")
    for shift in range(3):
        order = names[shift * 3:] + names[:shift * 3]
        sample.select(*order).coalesce(1).write.mode("append").options(header=True, quoteAll=True, escape='"').csv(d)
    meta = R.read_meta_dump(spark, d)
    for table in (X.primary_entities, X.venues, X.responsible_agents):
        assert set(map(tuple, table(meta).collect())) == set(map(tuple, table(sample).collect()))
    assert meta.count() == 3 * sample.count()


def test_one_task_reads_one_header(spark, tmpdir_path):
    """The header pass stops after the first record: later lines are never parsed."""
    d = put(os.path.join(tmpdir_path, "big"), a="x,y\n" + "1,2\n" * 200_000, b='"a ""b""","two\nlines"\n"1","2"\n', c="\n\nz\n1\n", d="", e="﻿x,y\n")
    found = {os.path.basename(r["path"]): r["header"] for r in file_headers(spark, [d]).collect()}
    assert found == {"a.csv": ["x", "y"], "b.csv": ['a "b"', "two\nlines"], "c.csv": ["z"], "e.csv": ["x", "y"]}
    assert file_headers(spark, [d]).rdd.getNumPartitions() >= 4
    got = R.read_csv_tables(spark, d, columns=("y", "two\nlines"))
    assert got.columns == ["y", "two\nlines"]
    assert got.where("y = '2'").count() == 200_000


def test_odd_file_names_repeated_names_and_empty_folders(spark, tmpdir_path):
    d = put(os.path.join(tmpdir_path, "a b {c}"), **{"x y%20[1]": "k,v,v\n1,2,3\n", "z": "v,k\n4,5\n"})
    got = read_csv_files(spark, [d.replace("{", "\\{").replace("}", "\\}")])  # folders may be patterns
    assert {(r["k"], r["v"]) for r in got.collect()} == {("1", "3"), ("5", "4")}
    empty = put(os.path.join(tmpdir_path, "none"))
    with open(os.path.join(empty, "notes.txt"), "w") as f:
        f.write("no csv")
    assert R.read_csv_tables(spark, empty, columns=("a", "b")).columns == ["a", "b"]
    assert R.read_csv_tables(spark, empty, columns=("a", "b")).count() == 0


def test_a_row_of_other_length_is_an_error(spark, tmpdir_path):
    d = put(os.path.join(tmpdir_path, "bad"), a="k,v\n1,2,3\n", b="v,k\n1,2\n")
    with pytest.raises(Exception):  # noqa: B017, PT011 - Spark wraps it in several classes
        R.read_csv_tables(spark, d).collect()


def test_only_asked_for_columns_are_parsed(spark, tmpdir_path):
    d = put(os.path.join(tmpdir_path, "wide"), a="a,b,c\n1,2,3\n", b="c,b,a\n6,5,4\n")
    plan = R.read_csv_tables(spark, d).select("a")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReadSchema: struct<_0:string>") == 1 and plan.count("ReadSchema: struct<_2:string>") == 1


def test_stream_reads_files_by_name(spark, tmpdir_path):
    sample = read_golden(spark, "meta_sample.csv")
    inbox = os.path.join(tmpdir_path, "inbox")
    for order in (sample.columns, sample.columns[::-1]):
        sample.select(*order).coalesce(1).write.mode("append").options(header=True, quoteAll=True, escape='"').csv(inbox)
    idx = P.pid_index(read_golden(spark, "works_pid_index.csv"), read_golden(spark, "sources_pid_index.csv"))
    out = os.path.join(tmpdir_path, "out")
    start_incremental_mapping(spark, inbox, idx, out, os.path.join(tmpdir_path, "ckpt")).awaitTermination(120)
    once = map_batch(read_golden(spark, "meta_sample.csv"), idx)
    cols = ["omid", "type", "openalex_id", "outcome"]
    assert rows(spark.read.parquet(out), cols) == sorted(2 * rows(once, cols))


def test_many_small_files_share_tasks(spark, tmpdir_path, monkeypatch):
    """The header pass over very many small files has few tasks, and finds the headers that one task a
    file finds: headers of several lines, blank first lines, marks, files without a record."""
    from pidlink.sources import csvheaders as H

    texts = ["x,y\n1,2\n", '"a ""b""","two\nlines"\n"1","2"\n', "\n\nz\n1\n", "", "﻿x,y\n", "y,x\n" + "1,2\n" * 3_000]
    d = put(os.path.join(tmpdir_path, "many"), **{f"f{i}": texts[i % len(texts)] for i in range(60)})
    want = sorted((r["path"], r["header"]) for r in file_headers(spark, [d]).collect())
    assert len(want) == 50 and file_headers(spark, [d]).rdd.getNumPartitions() > 40
    tracker = spark.sparkContext.statusTracker()
    for shared in (H.SHARED_BYTES, 5_000):  # then the largest files have a task each
        monkeypatch.setattr(H, "SHARED_BYTES", shared)
        monkeypatch.setattr(H, "FILES_A_CORE", 1)
        spark.sparkContext.setJobGroup(f"headers-{shared}", "headers")
        assert H.all_headers(spark, [d]) == want
        jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(f"headers-{shared}")]
        tasks = sum(tracker.getStageInfo(s).numTasks for j in jobs for s in j.stageIds)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert jobs and tasks < 40


def test_large_files_are_split_if_every_line_is_a_record(spark, tmpdir_path, monkeypatch):
    """Files that may not be split give the rows of the multi-line reader."""
    from pidlink.sources import csvheaders as H

    plain = "".join(f'"{i}","a ""q"", {i}",x\n' for i in range(2000))
    odd = {"broken": '"1","line\nbreak",x\n', "stray": '1,a"b,"x\ny"\n', "blank": "\n  , ,\n", "returned": '"1","a\r\nb",x\r\n', "zero": '"1","a\x00b",x\n'}
    d = put(os.path.join(tmpdir_path, "plain"), a="a,b,c\n" + plain, b="a,b,c\n" + plain[:-1])
    folders = {k: put(os.path.join(tmpdir_path, k), t="a,b,c\n" + plain + v + plain) for k, v in odd.items()}
    before = {k: rows(R.read_csv_tables(spark, f)) for k, f in (folders | {"plain": d}).items()}
    assert len(before["plain"]) == 4000
    monkeypatch.setattr(H, "SPLIT_BYTES", 10_000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        got = R.read_csv_tables(spark, d)
        assert got.rdd.getNumPartitions() > 4 and rows(got) == before["plain"]
        split = H.split_headers(spark, [d])
        assert set(map(tuple, split.values())) == {("a", "b", "c")} and len(split) == 2
        assert H.file_headers(spark, [d], known=split).count() == 0 and H.file_headers(spark, [d]).count() == 2
        assert got.select("b").where("b like '%, 7'").count() == 2
        for name, folder in folders.items():
            assert not H.split_headers(spark, [folder])
            assert rows(R.read_csv_tables(spark, folder)) == before[name], name
        mixed = R.read_csv_tables(spark, d, folders["broken"])
        assert rows(mixed) == sorted(before["plain"] + before["broken"])
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
