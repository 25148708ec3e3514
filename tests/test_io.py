import gzip
import io
import json
import os
import shutil
import zipfile

import pytest
from conftest import golden, read_golden, rows

from pyspark.errors import AnalysisException

from pidlink.functions import constants as K
from pidlink.operators import categorize as C
from pidlink.sources import readers as R
from pidlink.sources import schemas as SC
from pidlink.sources import sinks as W


def test_zip_meta_dump_reads_csv_members(spark, tmpdir_path):
    z = os.path.join(tmpdir_path, "meta.zip")
    sample = open(golden("meta_sample.csv"), encoding="utf-8").read()
    lines = sample.splitlines(keepends=True)
    with zipfile.ZipFile(z, "w") as a:
        a.writestr("csv/part1.csv", "".join(lines[:10]))
        a.writestr("csv/part2.csv", lines[0] + "".join(lines[10:]))
        a.writestr("csv/readme.txt", "not a table")
    got = R.read_meta_dump(spark, z)
    exp = read_golden(spark, "meta_sample.csv")
    assert rows(got, list(R.META_COLUMNS)) == rows(exp, list(R.META_COLUMNS))


def test_csv_directory_reader_rejects_files(spark, tmpdir_path):
    import pytest
    with pytest.raises(ValueError):
        R.read_csv_tables(spark, golden("meta_sample.csv"))


def test_openalex_gz_with_malformed_line(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "works", "updated_date=2024-01-01")
    os.makedirs(d)
    with gzip.open(os.path.join(d, "part_000.gz"), "wt", encoding="utf-8") as f:
        f.write(json.dumps({"id": "https://openalex.org/W1", "ids": {"doi": "https://doi.org/10.1/x"}, "extra": 1}) + "\n")
        f.write("{broken\n")
        f.write(json.dumps({"id": "https://openalex.org/W2", "title": "Ünïcode"}) + "\n")
    open(os.path.join(d, "manifest"), "w").write("skip me")
    recs, bad = R.read_openalex(spark, os.path.join(tmpdir_path, "works"), SC.work_schema())
    assert rows(recs, ["id", "title"]) == [("https://openalex.org/W1", None), ("https://openalex.org/W2", "Ünïcode")]
    assert bad.count() == 1


def test_nested_zip_graphs_and_nodes(spark, tmpdir_path):
    prov = [{"@id": "g", "@graph": [{K.PROV_PRIMARY_SOURCE: [{"@id": "crossref"}],
                                     K.PROV_SPECIALIZATION_OF: [{"@id": K.META_URI + "br/1"}]}]}]
    brs = [{"@id": "x", "@graph": [{"@id": K.META_URI + "br/1", "@type": [K.FABIO_EXPRESSION]},
                                   {"@id": K.META_URI + "br/2", "@type": []}]}]

    def inner(name, obj):
        b = io.BytesIO()
        with zipfile.ZipFile(b, "w") as z:
            z.writestr(name, json.dumps(obj))
        return b.getvalue()

    path = os.path.join(tmpdir_path, "br.zip")
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("br/060/10000/1000/prov/se.zip", inner("se.json", prov))
        z.writestr("br/060/10000/1000.zip", inner("1000.json", brs))
    g = R.read_provenance_graphs(spark, path)
    assert g.count() == 1
    n = R.read_br_nodes(spark, path)
    assert sorted(r["@id"] for r in n.collect()) == [K.META_URI + "br/1", K.META_URI + "br/2"]


def test_csv_sink_rolls_files_and_quotes_all(spark, tmpdir_path):
    df = spark.range(25).selectExpr("concat('omid:br/', id) AS omid", "'a \"b\", c' AS ids", "'' AS type").coalesce(1)
    out = os.path.join(tmpdir_path, "out")
    W.write_csv(df, out, rows_per_file=10)
    files = [f for f in os.listdir(out) if f.endswith(".csv")]
    assert len(files) == 3
    first = open(os.path.join(out, sorted(files)[0]), encoding="utf-8").read().splitlines()
    assert first[0] == '"omid","ids","type"' and first[1].endswith('"a ""b"", c",""')
    back = R.read_csv_tables(spark, out)
    assert rows(back) == rows(df)


def test_json_sink_and_nested_document_round_trip(spark, tmpdir_path):
    counts = spark.createDataFrame([("works", "book", "A", 2), ("works", "", "C", 1), ("sources", "journal", "A", 3)],
                                   "entity string, type string, category string, n bigint")
    path = os.path.join(tmpdir_path, "cats")
    W.write_document(C.nested_counts_json(counts), path)
    assert rows(R.read_category_counts(spark, path)) == rows(counts)
    W.write_json_lines(counts, os.path.join(tmpdir_path, "j"), rows_per_file=2)
    assert spark.read.json(os.path.join(tmpdir_path, "j")).count() == 3


def test_upsert_keep_last(spark):
    old = spark.createDataFrame([("W1", "v1"), ("W2", "v1")], "id string, v string")
    new = spark.createDataFrame([("W1", "v2", 1), ("W1", "v3", 2), ("W3", "v1", 3)], "id string, v string, o long")
    got = rows(W.upsert(old, new.select("id", "v", "o"), ["id"], order="o"), ["id", "v"])
    assert got == [("W1", "v3"), ("W2", "v1"), ("W3", "v1")]


def test_run_mapping_end_to_end(spark, tmpdir_path):
    from pidlink.plans import jobs as J

    works_dir = os.path.join(tmpdir_path, "works")
    src_dir = os.path.join(tmpdir_path, "sources")
    os.makedirs(works_dir)
    os.makedirs(src_dir)
    with gzip.open(os.path.join(works_dir, "part_0.gz"), "wt") as f:
        f.write('{"id": "broken\n')
        for r in read_golden(spark, "works_pid_index.csv").collect():
            scheme, value = r.supported_id.split(":", 1)
            ids = {"doi": "https://doi.org/" + value} if scheme == "doi" else {scheme: value}
            f.write(json.dumps({"id": "https://openalex.org/" + r.openalex_id, "ids": ids}) + "\n")
    with gzip.open(os.path.join(src_dir, "part_0.gz"), "wt") as f:
        for r in read_golden(spark, "sources_pid_index.csv").collect():
            scheme, value = r.supported_id.split(":", 1)
            ids = {"issn": [value]} if scheme == "issn" else {"wikidata": "https://www.wikidata.org/entity/" + value}
            f.write(json.dumps({"id": "https://openalex.org/" + r.openalex_id, "ids": ids}) + "\n")
    out = os.path.join(tmpdir_path, "out")
    meta_dir = os.path.join(tmpdir_path, "meta")
    os.makedirs(meta_dir)
    shutil.copy(golden("meta_sample.csv"), os.path.join(meta_dir, "meta.csv"))
    paths = J.run_mapping(spark, meta_dir, works_dir, src_dir, out)
    mapped = R.read_csv_tables(spark, paths["mapped"])
    assert rows(mapped) == rows(read_golden(spark, "mapped.csv"), ["omid", "openalex_id", "type"])
    assert R.read_csv_tables(spark, paths["non_mapped"]).count() == 13
    assert rows(R.read_csv_tables(spark, "file://" + paths["multi_mapped"]), ["omid"]) == rows(
        read_golden(spark, "multi_mapped.csv"), ["omid"])
    # rejected input is kept and counted, and an index that is there is not rebuilt unasked
    counts = {r["name"]: r.n for r in spark.read.parquet(paths["rejected_counts"]).collect()}
    assert set(counts) == {"malformed_works", "malformed_sources", "unparsable_venues", "unparsable_agents"}
    assert counts["malformed_works"] == 1 and counts["malformed_sources"] == 0
    assert spark.read.parquet(paths["malformed_works"]).count() == 1
    with pytest.raises(AnalysisException):
        J.run_mapping(spark, meta_dir, works_dir, src_dir, out)
    again = J.run_mapping(spark, meta_dir, works_dir, src_dir, out, rebuild_index=True, single_file=True)
    assert len([f for f in os.listdir(again["multi_mapped"]) if f.endswith(".csv")]) == 1


def test_csv_folders_with_different_headers(spark, tmpdir_path):
    for name, text in (("a", "omid,type,omid_only\n1,x,True\n"), ("b", "omid,type\n2,y\n"), ("c", "type,omid\nz,3\n")):
        os.makedirs(os.path.join(tmpdir_path, name))
        with open(os.path.join(tmpdir_path, name, "t.csv"), "w") as f:
            f.write(text)
    a, b, c = (os.path.join(tmpdir_path, n) for n in "abc")
    want = [("1", "x", "True"), ("2", "y", None), ("3", "z", None)]
    for dirs in ((a, b, c), (b, c, "file://" + a)):
        got = R.read_csv_tables(spark, *dirs).collect()
        assert sorted((r.omid, r.type, r.omid_only) for r in got) == want
    with pytest.raises(ValueError):
        R.read_csv_tables(spark, os.path.join(a, "t.csv"))


def test_run_analysis_tables(spark, tmpdir_path):
    from pidlink.operators import flatten as FL
    from pidlink.plans import jobs as J

    mm_dir = os.path.join(tmpdir_path, "mm")
    os.makedirs(mm_dir)
    with open(os.path.join(mm_dir, "t.csv"), "w") as f:
        f.write('"omid","openalex_id","type"\n"omid:br/1","W1 W2","x"\n"omid:br/3","S1 S2","y"\n')
    U = K.OPENALEX_URI
    work = {"type": "article", "authorships": [{"author_position": "first", "author": {"id": "A1"}, "institutions": [{"id": "I1"}, {"id": "I2"}]}],
            "primary_location": {"source": {"id": "S1"}, "version": "v"}, "locations": [{"source": {"id": "S1"}}, {"source": None}],
            "best_oa_location": {"source": {"id": "S2"}}, "biblio": {"volume": "1"}, "concepts": [{"id": "C1", "score": 0.5}],
            "mesh": [{"descriptor_ui": "D", "qualifier_ui": "Q", "is_major_topic": True}], "open_access": {"is_oa": True},
            "referenced_works": [U + "W7"], "related_works": [U + "W8", U + "W9"]}
    _gz_lines(os.path.join(tmpdir_path, "works", "p.gz"), [
        work | {"id": U + "W1", "ids": {"openalex": U + "W1"}}, work | {"id": U + "W2", "ids": {"openalex": U + "W2"}, "type": "old"},
        work | {"id": U + "W2", "ids": {"openalex": U + "W2"}, "type": "new"}, work | {"id": U + "W5", "ids": {"openalex": U + "W5"}}])
    _gz_lines(os.path.join(tmpdir_path, "sources", "p.gz"), [
        {"id": U + "S1", "ids": {"openalex": U + "S1", "issn": ["1"]}, "counts_by_year": [{"year": 2020, "works_count": 3}]},
        {"id": U + "S4", "ids": {"openalex": U + "S4"}}])
    args = (mm_dir, os.path.join(tmpdir_path, "works"), os.path.join(tmpdir_path, "sources"), os.path.join(tmpdir_path, "out"))
    paths = J.run_analysis_tables(spark, *args)
    rejected = {"malformed_works", "malformed_sources", "rejected_counts"}
    assert set(paths) == {"mm_works", *FL.PRIMARY_KEYS, *rejected}
    n = {name: spark.read.parquet(p).count() for name, p in paths.items() if name not in rejected}
    assert n == {"mm_works": 3, "sources": 2, "sources_ids": 2, "sources_counts_by_year": 1, "works": 2, "works_primary_locations": 2,
                 "works_locations": 2, "works_best_oa_locations": 2, "works_authorships": n["works_authorships"], "works_biblio": 2,
                 "works_concepts": 2, "works_ids": 2, "works_mesh": 2, "works_open_access": 2, "works_referenced_works": 2,
                 "works_related_works": 4}
    assert n["works_authorships"] in (2, 4)
    assert {(r.id[-2:], r.type) for r in spark.read.parquet(paths["works"]).collect()} == {("W1", "article"), ("W2", "new")}
    with pytest.raises(AnalysisException):
        J.run_analysis_tables(spark, *args)


def test_copy_json_lines_skips_malformed(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "src")
    os.makedirs(d)
    with gzip.open(os.path.join(d, "part.gz"), "wt") as f:
        f.write('{"id": "S1"}\n{oops\n{"id": "S2", "name": "Zoë"}\n')
    out = os.path.join(tmpdir_path, "copy")
    assert R.copy_json_lines(spark, d, out) == {"lines": 3, "malformed": 1}
    back = spark.read.json(f"{out}/kind=lines")
    assert rows(back, ["id"]) == [("S1",), ("S2",)]
    assert [r.value for r in spark.read.text(f"{out}/kind=malformed").collect()] == ["{oops"]


def _gz_lines(path, recs):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with gzip.open(path, "wt", encoding="utf-8") as f:
        for r in recs:
            f.write(json.dumps(r) + "\n")


def test_run_categorisation_end_to_end(spark, tmpdir_path):
    from pidlink.plans import jobs as J

    mm_dir = os.path.join(tmpdir_path, "mm")
    os.makedirs(mm_dir)
    with open(os.path.join(mm_dir, "multi_mapped_omids.csv"), "w") as f:
        f.write('"omid","openalex_id","type"\n"omid:br/1","W1 W2","journal article"\n'
                '"omid:br/2","W3 W4","book"\n"omid:br/3","S1 S2","journal"\n')
    U = K.OPENALEX_URI
    _gz_lines(os.path.join(tmpdir_path, "works", "p.gz"), [
        {"id": U + "W1", "type": "article", "ids": {"openalex": U + "W1", "doi": "https://doi.org/10.1234/x.v2"}},
        {"id": U + "W2", "type": "article", "ids": {"openalex": U + "W2", "doi": "https://doi.org/10.1234/x"}},
        {"id": U + "W3", "type": "article", "ids": {"openalex": U + "W3", "pmid": "P1"}},
        {"id": U + "W4", "type": "article", "ids": {"openalex": U + "W4", "pmid": "P1"}},
        {"id": U + "W9", "type": "article", "ids": {"openalex": U + "W9"}},
    ])
    _gz_lines(os.path.join(tmpdir_path, "sources", "p.gz"), [
        {"id": U + "S1", "ids": {"openalex": U + "S1", "issn": ["1"]}},
        {"id": U + "S2", "ids": {"openalex": U + "S2", "issn": ["1", "2"]}},
    ])
    out = os.path.join(tmpdir_path, "out")
    paths = J.run_categorisation(spark, mm_dir, os.path.join(tmpdir_path, "works"),
                                 os.path.join(tmpdir_path, "sources"), out)
    got = {r.omid: r.category for r in R.read_csv_tables(spark, paths["works_categories"]).collect()}
    assert got == {"omid:br/1": "D", "omid:br/2": "A"}
    src = {r.omid: r.category for r in R.read_csv_tables(spark, paths["sources_categories"]).collect()}
    assert src == {"omid:br/3": "A"}
    doc = R.read_category_counts(spark, paths["counts_json"])
    assert doc.where("entity = 'works'").count() == 2


def test_run_provenance_end_to_end(spark, tmpdir_path):
    from pidlink.plans import jobs as J

    M_ = K.META_URI

    def inner(name, obj):
        b = io.BytesIO()
        with zipfile.ZipFile(b, "w") as z:
            z.writestr(name, json.dumps(obj))
        return b.getvalue()

    prov = [{"@id": M_ + "br/06076/prov/", "@graph": [
        {K.PROV_PRIMARY_SOURCE: [{"@id": "https://api.crossref.org/"}],
         K.PROV_SPECIALIZATION_OF: [{"@id": M_ + "br/06076"}]}]},
        {"@id": M_ + "br/0699/prov/", "@graph": [
            {K.PROV_PRIMARY_SOURCE: [{"@id": "https://api.datacite.org/"}],
             K.PROV_SPECIALIZATION_OF: [{"@id": M_ + "br/0699"}]}]}]
    brs = [{"@id": "g", "@graph": [
        {"@id": M_ + "br/0699", "@type": [K.FABIO_EXPRESSION, "http://purl.org/spar/fabio/Book"]},
        {"@id": M_ + "br/06076", "@type": [K.FABIO_EXPRESSION]}]}]
    path = os.path.join(tmpdir_path, "rdf.zip")
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("rdf/br/060/10000/1000/prov/se.zip", inner("se.json", prov))
        z.writestr("rdf/br/060/10000/1000.zip", inner("1000.json", brs))
    pe, nm = os.path.join(tmpdir_path, "pe"), os.path.join(tmpdir_path, "nm")
    os.makedirs(pe)
    os.makedirs(nm)
    shutil.copy(golden("primary_ents.csv"), os.path.join(pe, "a.csv"))
    shutil.copy(golden("unmapped.csv"), os.path.join(nm, "a.csv"))
    paths = J.run_provenance(spark, path, pe, nm, os.path.join(tmpdir_path, "out"))
    extra = rows(R.read_csv_tables(spark, paths["extra_br"]))
    assert extra == [("omid:br/0699", "book", "True")]
    import json as _json
    doc = _json.loads(open([os.path.join(paths["counts_json"], f) for f in os.listdir(paths["counts_json"])
                            if f.endswith(".txt")][0]).read())
    assert list(doc) == ["book", "book series"] or list(doc) == ["book series", "book"]
    counts = rows(R.read_provenance_counts(spark, paths["counts_json"]))
    assert counts == [("book", "https://api.datacite.org/", 1, 0), ("book series", "https://api.crossref.org/", 0, 1)]
    assert R.read_csv_tables(spark, paths["missing"]).count() == 12


def test_command_line_mapping(spark, tmpdir_path):
    from pidlink.__main__ import main

    works = os.path.join(tmpdir_path, "works")
    _gz_lines(os.path.join(works, "p.gz"), [
        {"id": "https://openalex.org/W2006761296",
         "ids": {"doi": "https://doi.org/10.1002/1522-239x(200205)113:1/2<152::aid-fedr152>3.0.co;2-1"}}])
    sources = os.path.join(tmpdir_path, "sources")
    _gz_lines(os.path.join(sources, "p.gz"), [{"id": "https://openalex.org/S1", "ids": {"issn": ["2411-8974"]}}])
    meta = os.path.join(tmpdir_path, "meta")
    os.makedirs(meta)
    shutil.copy(golden("meta_sample.csv"), os.path.join(meta, "m.csv"))
    out = main(["mapping", "--meta", meta, "--works", works, "--sources", sources, "--out",
                os.path.join(tmpdir_path, "out")])
    mapped = {r.omid: r.openalex_id for r in R.read_csv_tables(spark, out["mapped"]).collect()}
    assert mapped == {"omid:br/06041": "W2006761296", "omid:br/06076": "S1"}


def test_create_refuses_an_existing_table(spark, tmpdir_path):
    import pytest
    from pyspark.errors import AnalysisException

    from pidlink.operators import pids as P

    df = spark.createDataFrame([("doi:a", "W1"), ("issn:1", "S1")], "supported_id string, openalex_id string")
    idx = P.pid_index(df, df)
    path = os.path.join(tmpdir_path, "index")
    P.write_pid_index(idx, path)
    assert sorted(f for f in os.listdir(path) if f.startswith("table_name=")) == [
        "table_name=SourcesIssn", "table_name=WorksDoi"]
    with pytest.raises(AnalysisException):
        P.write_pid_index(idx, path)
    W.create(df, os.path.join(tmpdir_path, "t"))
    with pytest.raises(AnalysisException):
        W.create(df, os.path.join(tmpdir_path, "t"))
    W.append(df, os.path.join(tmpdir_path, "t"))
    assert spark.read.parquet(os.path.join(tmpdir_path, "t")).count() == 4


def test_flat_json_lines_skip_blank_lines_and_other_files(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "flat")
    os.makedirs(d)
    with open(os.path.join(d, "a.json"), "w") as f:
        f.write('{"id": "https://openalex.org/S1", "issn": ["1"]}\n\n   \n{"id": "https://openalex.org/S2"}\n')
    with open(os.path.join(d, "notes.txt"), "w") as f:
        f.write('{"id": "https://openalex.org/S9"}\n')
    recs = R.read_json_records(spark, d, SC.source_schema())
    assert rows(recs, ["id"]) == [("https://openalex.org/S1",), ("https://openalex.org/S2",)]


def test_provenance_document_is_ordered_by_totals(spark):
    counts = spark.createDataFrame(
        [("book", "a", 1, 0), ("book", "b", 0, 5), ("journal", "a", 10, 10), ("book", "c", 2, 2)],
        "type string, source string, omid_only bigint, other_pids bigint")
    lines = [r[0] for r in W.provenance_document(counts).collect()]
    assert len(lines) == counts.count()
    doc = json.loads("\n".join(lines))
    assert list(doc) == ["journal", "book"]
    assert list(doc["book"]) == ["b", "c", "a"]
    assert doc["book"]["c"] == {"omid_only": 2, "other_pids": 2}
    tied = spark.createDataFrame([("", 'say "a"', 1, 0), ("x\\y", "é", 1, 0), ("z", "s", 1, 0)],
                                 "type string, source string, omid_only bigint, other_pids bigint")
    doc = json.loads("".join(r[0] for r in W.provenance_document(tied).collect()))
    assert doc == {"": {'say "a"': {"omid_only": 1, "other_pids": 0}}, "x\\y": {"é": {"omid_only": 1, "other_pids": 0}},
                   "z": {"s": {"omid_only": 1, "other_pids": 0}}}


def test_provenance_document_needs_no_window_of_a_type(spark, tmpdir_path):
    """Many sources of few types, spread over tasks: the document of the plain nesting, and no task holds a type."""
    import random

    rng = random.Random(2)
    data = [(t, f"s{i}", rng.randrange(5), rng.randrange(5)) for t in ("a", "b\"", "", "é") for i in range(rng.randint(1, 120))]
    counts = spark.createDataFrame(data, "type string, source string, omid_only long, other_pids long").repartition(5)
    doc = W.provenance_document(counts)
    assert "Window" not in doc._jdf.queryExecution().executedPlan().toString()
    W.write_document(doc, os.path.join(tmpdir_path, "doc"))
    text = "".join(r.value + "\n" for r in spark.read.text(os.path.join(tmpdir_path, "doc")).coalesce(1).collect())
    total = lambda t: sum(r[2] + r[3] for r in data if r[0] == t)
    want = {t: {s: {"omid_only": a, "other_pids": b} for _, s, a, b in sorted((r for r in data if r[0] == t), key=lambda r: (-r[2] - r[3], r[1]))}
            for t in sorted({r[0] for r in data}, key=lambda t: (-total(t), t))}
    assert json.dumps(json.loads(text)) == json.dumps(want)
    empty = W.provenance_document(counts.limit(0))
    assert empty.count() == 0


def test_single_csv_is_written_by_all_tasks(spark, tmpdir_path, monkeypatch):
    """The same bytes as of one task, without one."""
    texts = ['a"b', "c,d", "e\nf", "", None, "é\r\nü", "x" * 3000]
    df = spark.createDataFrame([(i, texts[i % len(texts)]) for i in range(500)], 'n int, `the "text", all of it` string').repartition(7, "n")
    W.write_csv(df.coalesce(1), os.path.join(tmpdir_path, "want"), rows_per_file=0)

    def bytes_of(name):
        files = [f for f in os.listdir(os.path.join(tmpdir_path, name)) if f.endswith(".csv")]
        assert len(files) == 1
        with open(os.path.join(tmpdir_path, name, files[0]), "rb") as f:
            return f.read()

    def refused(*_):
        raise AssertionError("the table goes through one task")

    with monkeypatch.context() as m:
        m.setattr(type(df), "coalesce", refused)
        for size in (64 << 20, 1000, 37):
            m.setattr(W, "PLACED_BYTES", size)
            W.write_single_csv(df, "file://" + os.path.join(tmpdir_path, "got"))  # the second and third over the first
            assert bytes_of("got") == bytes_of("want")
        W.write_single_csv(df.where("n < 0"), os.path.join(tmpdir_path, "none"))
        assert bytes_of("none").count(b"\n") == 1
    with pytest.raises(AnalysisException):
        W.write_single_csv(df, os.path.join(tmpdir_path, "got"), mode="errorifexists")
    W.write_single_csv(df, os.path.join(tmpdir_path, "got"), mode="ignore")
    assert bytes_of("got") == bytes_of("want")
    assert sorted(os.listdir(tmpdir_path)) == ["got", "none", "want"]  # nothing else is left


def test_stretches_cover_the_parts():
    parts = [("a", 5), ("b", 0), ("c", 12), ("d", 3)]
    cut = W._stretches(parts, 4)
    assert cut[1] == [("a", 4, 1, 4), ("c", 0, 3, 5)]
    assert [sum(n for _, _, n, _ in some) for some in cut] == [4, 4, 4, 4, 4]
    assert [at for some in cut for _, _, _, at in some][:3] == [0, 4, 5]
