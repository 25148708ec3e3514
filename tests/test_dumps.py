"""Dumps are read once: records, rejected lines and counts from one scan; late parsing; one row per Work."""

import gzip
import json
import os
import random

from pyspark.sql import functions as F

from pidlink.functions import constants as K
from pidlink.operators import categorize as C
from pidlink.operators import flatten as FL
from pidlink.plans import jobs as J
from pidlink.session import checkpoint_dir
from pidlink.sources import dumps as D
from pidlink.sources import readers as R
from pidlink.sources import schemas as SC

U = K.OPENALEX_URI


def gz(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with gzip.open(os.path.join(folder, name), "wt", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    return folder


def dump_lines():
    good = [json.dumps({"id": f"{U}W{i}", "type": f"t{i}", "ids": {"doi": f"https://doi.org/10.1/{i}"}, "title": "é \" }"}, ensure_ascii=False)
            for i in range(20)]
    late_id = json.dumps({"type": "late", "primary_location": {"source": {"id": f"{U}S1"}}, "id": f"{U}W30"})
    return good, late_id, ['{"id": "' + U + 'W3", "type": "cut', "{oops", "[1]x", '{"no": "id"}']


def scans(df, word):
    return df._jdf.queryExecution().executedPlan().toString().count(word)


def test_keep_counts_and_stores_in_one_scan(spark, tmpdir_path):
    good, late, bad = dump_lines()
    d = gz(os.path.join(tmpdir_path, "d", "p=1"), "a.gz", [*good, late, *bad[:3], "", "  "])
    raw = D.parse_dump(spark, os.path.join(tmpdir_path, "d"), SC.work_schema())
    kept = D.keep(raw.select("id", "type", D.CORRUPT, D.ORD), os.path.join(tmpdir_path, "kept"))
    assert kept.counts == {"lines": 24, "malformed": 3} and d
    assert sorted(r[D.CORRUPT] for r in kept.malformed.collect()) == sorted(bad[:3])
    assert kept.records.count() == 21 and kept.records.where("id is null").count() == 0
    assert scans(kept.records, "FileScan json") == 0 and scans(kept.malformed, "FileScan json") == 0


def test_only_matching_lines_are_parsed(spark, tmpdir_path):
    good, late, bad = dump_lines()
    d = gz(os.path.join(tmpdir_path, "works"), "a.gz", [*good, late, *bad, "", '{"id": "' + U + 'W5", "ids": 7, "x": }', '{"id": "' + U + 'W99", "x": }'])
    ids = spark.createDataFrame([("W3",), ("W5",), ("W30",), ("W77",)], "openalex_id string")
    kept = D.keep_matching(spark, d, SC.work_schema(), ids, os.path.join(tmpdir_path, "kept"))
    want = [r for r in D.parse_dump(spark, d, SC.work_schema(), with_order=False).collect()
            if r[D.CORRUPT] is None and r["id"] in {f"{U}W3", f"{U}W5", f"{U}W30"}]
    got = kept.records.drop(D.ORD).collect()
    assert sorted(map(str, got)) == sorted(str(r).replace(", _corrupt_record=None", "") for r in want) and len(got) == 3
    # cut off, not an object, without id; and the broken line of a wanted id, but not that of W99
    assert {r[D.CORRUPT] for r in kept.malformed.collect()} == {*bad, '{"id": "' + U + 'W5", "ids": 7, "x": }'}
    assert kept.counts == {"lines": 27, "malformed": 5}


def test_load_order_is_that_of_the_lines(spark, tmpdir_path):
    d = gz(os.path.join(tmpdir_path, "works"), "a.gz", [json.dumps({"id": f"{U}W1", "type": f"t{i}"}) for i in range(40)])
    kept = D.keep_matching(spark, d, SC.work_schema(), spark.createDataFrame([("W1",)], "k string"), os.path.join(tmpdir_path, "k"))
    assert [r.type for r in FL.load_tables({"works": FL.works_table(kept.records)})["works"].collect()] == ["t39"]


def test_parsing_comes_after_the_join(spark, tmpdir_path):
    seen = []
    d = gz(os.path.join(tmpdir_path, "works"), "a.gz", dump_lines()[0])
    original = D._stored
    try:
        D._stored = lambda rows, folder, lines: seen.append(rows) or original(rows, folder, lines)
        D.keep_matching(spark, d, SC.work_schema(), spark.createDataFrame([("W1",)], "k string"), os.path.join(tmpdir_path, "k"))
    finally:
        D._stored = original
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("from_json") < plan.index("Join") and "from_json" not in plan[plan.index("Join"):]


def test_flat_json_reports_counts(spark, tmpdir_path):
    from pyspark.sql import Observation

    d = os.path.join(tmpdir_path, "flat")
    os.makedirs(d)
    with open(os.path.join(d, "a.json"), "w") as f:
        f.write('{"id": "S1"}\n\n{broken\n{"id": "S2"}\n')
    counts = Observation()
    records = R.read_json_records(spark, d, SC.source_schema(), counts)
    assert sorted(r.id for r in records.collect()) == ["S1", "S2"] and counts.get == {"lines": 3, "malformed": 1}


def random_works(rng, n=60):
    """Works that stand several times, with other or lacking ids, types and primary locations."""
    out = []
    for i in range(n):
        w = {"id": f"{U}W{rng.randrange(12)}", "type": rng.choice(["article", "erratum", None])}
        if rng.random() < 0.7:
            w["ids"] = {"openalex": w["id"], "doi": rng.choice([None, "https://doi.org/10.1101/x", f"https://doi.org/10.1/{rng.randrange(3)}.v1", "https://doi.org/10.1/y"]),
                        "pmid": rng.choice([None, "p1", "p2"])}
        if rng.random() < 0.8:
            w["primary_location"] = {"source": rng.choice([None, {"id": None}, {"id": ""}, {"id": f"{U}S{rng.randrange(3)}"}]),
                                     "version": rng.choice([None, "submittedVersion", "publishedVersion"])}
        out.append(w | {"_ord": i})
    return out


def test_one_row_per_work_equals_the_three_loaded_tables(spark):
    schema = SC.work_schema().add("_ord", "long")
    for seed in range(8):
        rng = random.Random(seed)
        works = spark.createDataFrame([{f: w.get(f) for f in schema.fieldNames()} for w in random_works(rng)], schema).repartition(3)
        t = FL.load_tables({k: v for k, v in FL.flatten_works(works).items() if k in ("works_ids", "works", "works_primary_locations")})
        want = C.joined_attributes(t["works_ids"], t["works"], t["works_primary_locations"])
        got = FL.work_attributes(works)
        assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
        mm = spark.createDataFrame([(f"omid:br/{i}", " ".join(sorted({f"W{rng.randrange(12)}" for _ in range(3)})), "t") for i in range(30)],
                                   "omid string, openalex_id string, type string")
        by_tables = C.categorize_works(mm, t["works_ids"], t["works"], t["works_primary_locations"])
        assert sorted(map(tuple, C.categorize_by_attributes(mm, got).collect())) == sorted(map(tuple, by_tables.collect()))


def test_categories_need_one_join_on_the_work(spark):
    schema = SC.work_schema().add("_ord", "long")
    works = spark.createDataFrame([{f: w.get(f) for f in schema.fieldNames()} for w in random_works(random.Random(1))], schema)
    mm = spark.createDataFrame([("o", "W1 W2", "t")], "omid string, openalex_id string, type string")
    plan = J.Categories(mm, works, works.select("id", "ids", "_ord")).works._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 1 and plan.count("Join LeftSemi") == 1 and plan.count("Join ") == 2


def scratch(spark):
    d = checkpoint_dir(spark).removeprefix("file:")
    return {f for f in os.listdir(d) if f.split("-")[0] in ("mapping", "categorisation", "analysis")}


def test_jobs_report_rejected_lines_and_leave_no_scratch(spark, tmpdir_path):
    good, late, bad = dump_lines()
    works = gz(os.path.join(tmpdir_path, "works"), "a.gz", [*good, late, *bad])
    sources = gz(os.path.join(tmpdir_path, "sources"), "a.gz", [json.dumps({"id": f"{U}S1", "ids": {"issn": ["1"]}}), '{"id": "cut'])
    mm = os.path.join(tmpdir_path, "mm")
    os.makedirs(mm)
    with open(os.path.join(mm, "t.csv"), "w") as f:
        f.write("omid,openalex_id,type\no1,W1 W2,x\no2,S1 S2,y\n")
    for i, job in enumerate((J.run_categorisation, J.run_analysis_tables)):
        paths = job(spark, mm, works, sources, os.path.join(tmpdir_path, f"out{i}"))
        counts = {r["name"]: (r["n"], r["n_read"]) for r in spark.read.parquet(paths["rejected_counts"]).collect()}
        assert counts == {"malformed_works": (4, 25), "malformed_sources": (1, 2)}
        for name, (n, _) in counts.items():
            assert spark.read.parquet(paths[name]).count() == n
    assert scratch(spark) == set()


def test_keep_first_and_keep_last_of_repeated_sources(spark):
    schema = SC.source_schema().add("_ord", "long")
    rows = [{"id": f"{U}S{i % 4}", "display_name": f"n{i}", "ids": {"issn_l": f"i{i}"} if i > 3 else None,
             "counts_by_year": [{"year": 2020, "works_count": i}], "_ord": (i * 7) % 20} for i in range(20)]
    df = spark.createDataFrame([{f: r.get(f) for f in schema.fieldNames()} for r in rows], schema).repartition(3)
    first = {}
    for r in sorted(rows, key=lambda r: r["_ord"]):
        first.setdefault(r["id"], r)
    t = FL.flatten_sources(df)
    assert {(r.id, r.display_name) for r in t["sources"].collect()} == {(k, r["display_name"]) for k, r in first.items()}
    assert {(r.source_id, r.issn_l) for r in t["sources_ids"].collect()} == {(k, r["ids"]["issn_l"]) for k, r in first.items() if r["ids"]}
    assert {(r.source_id, r.works_count) for r in t["sources_counts_by_year"].select("source_id", F.col("works_count")).collect()} \
        == {(k, r["counts_by_year"][0]["works_count"]) for k, r in first.items()}
