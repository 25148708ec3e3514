import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from pidlink.operators import pids as P
from pidlink.sources import schemas as SC


def works(spark, recs):
    return spark.createDataFrame(recs, "id string, ids struct<openalex:string, doi:string, mag:string, pmid:string, pmcid:string>")


def test_work_pids_strip_prefixes(spark):
    w = works(spark, [
        ("https://openalex.org/W1", ("https://openalex.org/W1", "https://doi.org/10.1/a", None,
                                     "https://pubmed.ncbi.nlm.nih.gov/11", "https://www.ncbi.nlm.nih.gov/pmc/articles/PMC2")),
        ("https://openalex.org/W2", ("https://openalex.org/W2", None, "123", None, None)),
        ("https://openalex.org/W3", None),
    ])
    assert rows(P.work_pids(w)) == [("doi:10.1/a", "W1"), ("pmcid:PMC2", "W1"), ("pmid:11", "W1")]


def sources(spark, recs):
    return spark.createDataFrame(
        recs, "id string, ids struct<openalex:string, issn_l:string, issn:array<string>, wikidata:string>")


def test_source_pids_issn_wikidata_and_issn_l_fallback(spark):
    s = sources(spark, [
        ("https://openalex.org/S1", ("x", "1111-1111", ["1111-1111", "2222-2222"], "http://www.wikidata.org/entity/Q1")),
        ("https://openalex.org/S2", ("x", "3333-3333", [], "https://www.wikidata.org/entity/Q2")),
        ("https://openalex.org/S3", ("x", "4444-4444", None, "Q3")),
        ("https://openalex.org/S4", ("x", None, None, None)),
    ])
    assert rows(P.source_pids(s)) == [
        ("issn:1111-1111", "S1"), ("issn:2222-2222", "S1"), ("issn:3333-3333", "S2"), ("issn:4444-4444", "S3"),
        ("wikidata:Q1", "S1"), ("wikidata:Q2", "S2")]


def test_agent_pids(spark):
    a = spark.createDataFrame([("https://openalex.org/A1", ("https://orcid.org/0000-1",)), ("https://openalex.org/A2", (None,))],
                              "id string, ids struct<orcid:string>")
    assert rows(P.author_pids(a)) == [("orcid:0000-1", "A1")]
    i = spark.createDataFrame([("https://openalex.org/I1", ("https://ror.org/0abc", "https://www.wikidata.org/entity/Q5")),
                               ("https://openalex.org/I2", (None, "Q6"))], "id string, ids struct<ror:string, wikidata:string>")
    for f in (P.institution_pids, P.publisher_pids, P.funder_pids):
        assert rows(f(i)) == [("ror:0abc", "I1"), ("wikidata:Q5", "I1")]


def test_dispatch_and_table_names(spark):
    with pytest.raises(ValueError):
        P.openalex_ids_table(works(spark, []), "concept")
    assert P.openalex_ids_table(works(spark, []), " Work ").count() == 0
    assert P.index_table_name("work", "doi") == "WorksDoi"
    assert P.index_table_name("source", "wikidata") == "SourcesWikidata"


def test_index_keeps_only_work_and_source_schemes(spark):
    wp = spark.createDataFrame([("doi:a", "W1"), ("doi:a", "W2"), ("pmid:1", "W1"), ("orcid:x", "W1")],
                               "supported_id string, openalex_id string")
    sp = spark.createDataFrame([("issn:1", "S1"), ("wikidata:Q1", "S1"), ("doi:z", "S1")],
                               "supported_id string, openalex_id string")
    idx = P.pid_index(wp, sp)
    assert rows(idx, ["table_name", "supported_id", "openalex_id"]) == [
        ("SourcesIssn", "issn:1", "S1"), ("SourcesWikidata", "wikidata:Q1", "S1"),
        ("WorksDoi", "doi:a", "W1"), ("WorksDoi", "doi:a", "W2"), ("WorksPmid", "pmid:1", "W1")]
    summ = {r.table_name: (r.n_rows, r.n_ids, r.n_shared_ids) for r in P.index_summary(idx).collect()}
    assert summ["WorksDoi"] == (2, 1, 1)


def test_reader_schemas_build(spark):
    for s in (SC.work_schema(), SC.source_schema(), SC.prov_graph_schema(), SC.br_graph_schema()):
        assert spark.createDataFrame([], s).count() == 0


def test_index_write_is_spread_over_tasks(spark, tmpdir_path):
    """No task writes a whole lookup table: rows are dealt by PID."""
    idx = spark.range(4000).select(
        F.lit("WorksDoi").alias("table_name"), F.lit("doi").alias("scheme"),
        F.concat(F.lit("doi:10.1/"), F.col("id")).alias("supported_id"), F.concat(F.lit("W"), F.col("id")).alias("openalex_id"))
    path = os.path.join(tmpdir_path, "index")
    was = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        P.write_pid_index(idx, path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", was)
    assert len([f for f in os.listdir(os.path.join(path, "table_name=WorksDoi")) if f.endswith(".parquet")]) > 1
    assert spark.read.parquet(path).count() == 4000


def row_groups(path):
    import pyarrow.parquet as pq

    out = []
    for d, _, names in os.walk(path):
        for f in sorted(n for n in names if n.endswith(".parquet")):
            meta = pq.ParquetFile(os.path.join(d, f)).metadata
            at = meta.schema.names.index("supported_id")
            out += [(os.path.basename(d), meta.row_group(i).num_rows, meta.row_group(i).column(at).statistics) for i in range(meta.num_row_groups)]
    return out


def scanned(df):
    """Rows that the scan of a collected DataFrame put out."""
    todo, n = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        todo += [node.children().apply(k) for k in range(node.children().size())]
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
        if node.nodeName().startswith("Scan parquet"):
            n += node.metrics().apply("numOutputRows").value()
    return n


def test_stored_index_skips_row_groups(spark, tmpdir_path):
    """Row groups of a table have disjoint PID ranges and Bloom filters; a small look-up reads few of them."""
    path, n = os.path.join(tmpdir_path, "index"), 60_000
    idx = spark.range(n).select(F.when(F.col("id") % 2 == 0, "WorksDoi").otherwise("SourcesIssn").alias("table_name"),
                                F.when(F.col("id") % 2 == 0, "doi").otherwise("issn").alias("scheme"),
                                F.concat(F.when(F.col("id") % 2 == 0, "doi:10.1/").otherwise("issn:"), F.md5(F.col("id").cast("string"))).alias("supported_id"),
                                F.concat(F.lit("W"), "id").alias("openalex_id")).repartition(3)
    P.write_pid_index(idx, path, row_group_bytes=64 << 10)
    groups = row_groups(path)
    assert len(groups) > 20
    for table in ("table_name=WorksDoi", "table_name=SourcesIssn"):
        ranges = sorted((s.min, s.max) for t, _, s in groups if t == table)
        assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
    wanted = [r.supported_id for r in idx.where("openalex_id IN ('W10', 'W2000', 'W59998')").collect()]
    asked = spark.createDataFrame([(p,) for p in [*wanted, wanted[0], "doi:10.1/none", None]], "pid string")
    found = P.index_of_pids(spark, path, asked)
    assert sorted(r.openalex_id for r in found.collect()) == ["W10", "W2000", "W59998"]
    assert scanned(found) < n / 5  # three of more than twenty row groups, of one of two tables
    none = P.index_of_pids(spark, path, spark.createDataFrame([("doi:10.1/5",), ("doi:10.1/8zz",)], "pid string"))
    assert none.collect() == [] and scanned(none) == 0  # inside the ranges, excluded by the Bloom filters


def test_large_look_ups_are_joined(spark, tmpdir_path, monkeypatch):
    path = os.path.join(tmpdir_path, "index")
    idx = spark.createDataFrame([("WorksDoi", "doi", f"doi:{i % 50}", f"W{i}") for i in range(200)], "table_name string, scheme string, supported_id string, openalex_id string")
    P.write_pid_index(idx, path)
    asked = idx.select("supported_id").where("supported_id < 'doi:3'")
    want = rows(idx.where("supported_id < 'doi:3'"), ["supported_id", "openalex_id"])
    assert rows(P.index_of_pids(spark, path, asked), ["supported_id", "openalex_id"]) == want
    monkeypatch.setattr(P, "PUSHED_PIDS", 3)
    assert rows(P.index_of_pids(spark, path, asked), ["supported_id", "openalex_id"]) == want


def test_rows_of_a_shared_pid_are_spread(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "index")
    idx = spark.range(30_000).select(F.lit("WorksDoi").alias("table_name"), F.lit("doi").alias("scheme"),
                                     F.when(F.col("id") % 3 == 0, "doi:hot").otherwise(F.concat(F.lit("doi:"), "id")).alias("supported_id"),
                                     F.concat(F.lit("W"), "id").alias("openalex_id"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so small a table would be one file
    try:
        P.write_pid_index(idx, path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert max(n for _, n, _ in row_groups(path)) < 15_000


def row_groups(path):
    import pyarrow.parquet as pq

    out = []
    for d, _, names in os.walk(path):
        for f in sorted(n for n in names if n.endswith(".parquet")):
            meta = pq.ParquetFile(os.path.join(d, f)).metadata
            at = meta.schema.names.index("supported_id")
            out += [(os.path.basename(d), meta.row_group(i).num_rows, meta.row_group(i).column(at).statistics) for i in range(meta.num_row_groups)]
    return out


def scanned(df):
    """Rows that the scan of a collected DataFrame put out."""
    todo, n = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        todo += [node.children().apply(k) for k in range(node.children().size())]
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
        if node.nodeName().startswith("Scan parquet"):
            n += node.metrics().apply("numOutputRows").value()
    return n


def test_stored_index_skips_row_groups(spark, tmpdir_path):
    """Row groups of a table have disjoint PID ranges and Bloom filters; a small look-up reads few of them."""
    path, n = os.path.join(tmpdir_path, "index"), 60_000
    even = F.col("id") % 2 == 0
    idx = spark.range(n).select(F.when(even, "WorksDoi").otherwise("SourcesIssn").alias("table_name"), F.when(even, "doi").otherwise("issn").alias("scheme"),
                                F.concat(F.when(even, "doi:10.1/").otherwise("issn:"), F.md5(F.col("id").cast("string"))).alias("supported_id"),
                                F.concat(F.lit("W"), "id").alias("openalex_id")).repartition(3)
    P.write_pid_index(idx, path, row_group_bytes=64 << 10)
    groups = row_groups(path)
    assert len(groups) > 20
    for table in ("table_name=WorksDoi", "table_name=SourcesIssn"):
        ranges = sorted((s.min, s.max) for t, _, s in groups if t == table)
        assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
    wanted = [r.supported_id for r in idx.where("openalex_id IN ('W10', 'W2000', 'W59998')").collect()]
    asked = spark.createDataFrame([(p,) for p in [*wanted, wanted[0], "doi:10.1/none", None]], "pid string")
    found = P.index_of_pids(spark, path, asked)
    assert sorted(r.openalex_id for r in found.collect()) == ["W10", "W2000", "W59998"]
    assert scanned(found) < n / 5  # three of more than twenty row groups, of one of two tables
    none = P.index_of_pids(spark, path, spark.createDataFrame([("doi:10.1/5",), ("doi:10.1/8zz",)], "pid string"))
    assert none.collect() == [] and scanned(none) == 0  # inside the ranges, excluded by the Bloom filters


def test_large_look_ups_are_joined(spark, tmpdir_path, monkeypatch):
    path = os.path.join(tmpdir_path, "index")
    schema = "table_name string, scheme string, supported_id string, openalex_id string"
    idx = spark.createDataFrame([("WorksDoi", "doi", f"doi:{i % 50}", f"W{i}") for i in range(200)], schema)
    P.write_pid_index(idx, path)
    asked = idx.select("supported_id").where("supported_id < 'doi:3'")
    want = rows(idx.where("supported_id < 'doi:3'"), ["supported_id", "openalex_id"])
    assert rows(P.index_of_pids(spark, path, asked), ["supported_id", "openalex_id"]) == want
    monkeypatch.setattr(P, "PUSHED_PIDS", 3)
    assert rows(P.index_of_pids(spark, path, asked), ["supported_id", "openalex_id"]) == want


def test_rows_of_a_shared_pid_are_spread(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "index")
    idx = spark.range(30_000).select(F.lit("WorksDoi").alias("table_name"), F.lit("doi").alias("scheme"),
                                     F.when(F.col("id") % 3 == 0, "doi:hot").otherwise(F.concat(F.lit("doi:"), "id")).alias("supported_id"),
                                     F.concat(F.lit("W"), "id").alias("openalex_id"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so small a table would be one file
    try:
        P.write_pid_index(idx, path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert max(n for _, n, _ in row_groups(path)) < 15_000
