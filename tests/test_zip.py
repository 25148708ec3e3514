"""Zip archives: Arrow batches, bounded memory, lists split without parsing."""

import csv
import io
import json
import os
import random
import subprocess
import sys
import zipfile

import pyarrow as pa
import pytest

from pidlink.sources import readers as R
from pidlink.sources import zipsource as Z

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


class Slow(io.BytesIO):
    """Gives few bytes at a time."""

    def __init__(self, data, most):
        super().__init__(data)
        self.most = most

    def read(self, n=-1):
        return super().read(min(n, self.most) if n >= 0 else self.most)


def value(rng, depth=0):
    kind = rng.randrange(7 if depth < 4 else 4)
    if kind == 0:
        return "".join(rng.choice('ab"\\{}[], \né日\U0001f600') for _ in range(rng.randrange(12)))
    if kind in (1, 2):
        return rng.choice([1, -2.5, True, None, "x\\", '"'])
    if kind == 3:
        return []
    if kind == 4:
        return [value(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {f"k{i}{rng.choice(['', '}', '\"'])}": value(rng, depth + 1) for i in range(rng.randrange(4))}


@pytest.mark.parametrize("most", [1, 3, 17, 1 << 20])
def test_list_is_split_into_its_elements(most):
    rng = random.Random(most)
    for _ in range(120):
        items = [value(rng) for _ in range(rng.randrange(6))]
        items = [x if isinstance(x, (list, dict)) else {"v": x} for x in items]
        for ascii_only in (True, False):
            text = json.dumps(items, ensure_ascii=ascii_only, indent=rng.choice([None, 1])).encode()
            assert [json.loads(e) for e in Z.json_elements(Slow(text, most))] == items
    assert [json.loads(e) for e in Z.json_elements(Slow(b'\xef\xbb\xbf {"a": [1, "]"]}', most))] == [{"a": [1, "]"]}]
    assert list(Z.json_elements(Slow(b"", most))) == []


@pytest.mark.parametrize("text", [b'[{"a": 1}', b'[{"a": "x', b'{"a": [1, 2}', b"[1, 2]", b'["a"]', b'[{"a": 1} x {"b": 2}]', b"[{"])
def test_broken_lists_are_errors(text):
    with pytest.raises(ValueError):
        list(Z.json_elements(io.BytesIO(text)))


def test_one_element_longer_than_many_chunks(monkeypatch):
    monkeypatch.setattr(Z, "CHUNK", 64)
    long = {"t": 'x"\\' * 100_000, "l": [{"i": i} for i in range(20_000)]}
    assert [json.loads(e) for e in Z.json_elements(io.BytesIO(json.dumps([long, {"a": 1}]).encode()))] == [long, {"a": 1}]


def test_csv_rows_by_name():
    text = 'b,a,a\n"1","2","3"\n\n"x ""y""\nz",4\n5,6,7,8\n'
    assert list(Z.csv_rows(io.BytesIO(text.encode()), ["a", "b", "c"])) == [("3", "1", None), (None, 'x "y"\nz', None), ("7", "5", None)]
    want = list(csv.DictReader(io.StringIO(text), dialect="unix"))
    assert [(r["a"], r["b"]) for r in want] == [("3", "1"), (None, 'x "y"\nz'), ("7", "5")]
    assert list(Z.csv_rows(io.BytesIO(b""), ["a"])) == []


def archive(path, members, kind=zipfile.ZIP_DEFLATED):
    with zipfile.ZipFile(path, "w", kind) as z:
        for name, data in members:
            z.writestr(name, data)
    return path


def test_small_members_share_partitions(tmpdir_path):
    rng = random.Random(1)
    path = archive(os.path.join(tmpdir_path, "m.zip"), [(f"d/{i:03}.csv", rng.randbytes(1000)) for i in range(50)] + [("d/x.txt", b"")])
    parts = Z.packed(path, ".csv", None, 10_500)
    assert [len(p.members) for p in parts] == [10] * 5
    assert [m for p in parts for m in p.members] == [f"d/{i:03}.csv" for i in range(50)]
    assert len(Z.packed(path, ".csv", "/00", 1)) == 40


def test_meta_archive_with_many_members(spark, tmpdir_path):
    members = [(f"csv/{i}.csv", "type,id\n" + "".join(f'"t{i}","id {i} {j}"\n' for j in range(30)) if i % 2 else
                "id,type\n" + "".join(f'"id {i} {j}","t{i}"\n' for j in range(30))) for i in range(40)]
    df = R.read_meta_dump(spark, archive(os.path.join(tmpdir_path, "meta.zip"), members), columns=("id", "type", "venue"))
    got = {(r["id"], r["type"], r["venue"]) for r in df.collect()}
    assert got == {(f"id {i} {j}", f"t{i}", None) for i in range(40) for j in range(30)}
    assert df.rdd.getNumPartitions() == 1  # all fit into one partition


def test_batches_end_by_bytes_and_rows(monkeypatch):
    monkeypatch.setattr(Z, "BATCH_BYTES", 100)
    monkeypatch.setattr(Z, "BATCH_ROWS", 7)
    out = list(Z.text_batches([("é" * (i % 50), None) for i in range(300)], ["a", "b"]))
    assert all(isinstance(b, pa.RecordBatch) and b.num_rows <= 7 for b in out) and sum(b.num_rows for b in out) == 300
    assert out[0].schema.types == [pa.string(), pa.string()]


MEASURE = """
import json, resource, sys, zipfile
sys.path.insert(0, {root!r})
from pidlink.sources import zipsource as Z
reader = Z._ZipJsonReader({options!r})
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
n = size = 0
for part in reader.partitions():
    for batch in reader.read(part):
        n += batch.num_rows
        size += batch.nbytes
print(json.dumps([n, size, (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024]))
"""


@pytest.mark.parametrize("nested", [False, True])
def test_memory_does_not_grow_with_the_member(tmpdir_path, nested):
    """A member of 200 MB, plain or in a nested archive of about 60 MB, in less than 60 MB."""
    rng = random.Random(2)
    path = os.path.join(tmpdir_path, "big.zip")
    plain = os.path.join(tmpdir_path, "se.json")
    rows = 40_000
    with open(plain, "wb") as f:
        for i in range(rows):
            f.write((b"[" if i == 0 else b",\n") + json.dumps({"@id": i, "@graph": [{"s": rng.randbytes(700).hex(), "pad": "}" * 3500}]}).encode())
        f.write(b"]")
    assert os.path.getsize(plain) > 180 << 20
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as z:
        if nested:
            inner = os.path.join(tmpdir_path, "inner.zip")
            with zipfile.ZipFile(inner, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as y:
                y.write(plain, "se.json")
            z.write(inner, "a/prov/se.zip")
        else:
            z.write(plain, "a/prov/se.json")
    options = {"path": path, "memberSuffix": "prov/se.zip" if nested else "se.json"} | ({"innerSuffix": "se.json"} if nested else {})
    out = subprocess.run([sys.executable, "-c", MEASURE.format(root=ROOT, options=options)], capture_output=True, check=True, text=True)
    n, size, grown = json.loads(out.stdout)
    assert n == rows and size > 180 << 20 and grown < 60


def test_archives_are_streamed_in_members(spark, tmpdir_path):
    """A partition's lines go to members of bounded size, whatever their number; none is lost."""
    from pyspark.sql import functions as F

    from pidlink.functions import constants as K
    from pidlink.plans import adapters as A
    from pidlink.sources import readers as R

    ids = spark.range(0, 3000, 1, 2).select(F.concat(F.lit("r"), F.col("id").cast("string")).alias("@id"))
    sent = sorted(r["@id"] for r in ids.collect())
    node = F.struct(F.col("`@id`"), F.array(F.lit(K.FABIO_EXPRESSION)).alias("@type"))
    lines = {"prov": F.to_json(F.struct("`@id`")), "br": F.to_json(F.struct("`@id`", F.array(node).alias("@graph"))), "csv": F.to_csv(F.struct("`@id`"))}
    for kind, line in lines.items():
        folder = os.path.join(tmpdir_path, kind)
        A.write_archives(ids.select(line.alias("line")), folder, kind, header="@id", member_bytes=1500)
        archives = sorted(os.listdir(folder))
        assert len(archives) == 2
        for a in archives:
            with zipfile.ZipFile(os.path.join(folder, a)) as z:
                sizes = [m.file_size for m in z.infolist()]
                assert len(sizes) > 3 and (kind != "csv" or max(sizes) < 1600)
        read = {"prov": R.read_provenance_graphs, "br": R.read_br_nodes, "csv": lambda s, p: R.read_zipped_csv(s, p, ("@id",))}[kind]
        assert sorted(r["@id"] for r in read(spark, folder).select("`@id`").collect()) == sent
    A.write_archives(ids.where("`@id` = 'none'").select(lines["prov"].alias("line")), os.path.join(tmpdir_path, "none"), "prov")
    assert R.read_provenance_graphs(spark, os.path.join(tmpdir_path, "none")).count() == 0
