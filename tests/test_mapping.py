import random
import tempfile

from conftest import read_golden, rows
from pyspark.sql import functions as F

from pidlink.operators import mapping as M
from pidlink.operators import pids as P


def golden_index(spark):
    return P.pid_index(read_golden(spark, "works_pid_index.csv"), read_golden(spark, "sources_pid_index.csv"))


def run(spark, inp="primary_ents.csv", **kw):
    return M.map_records(read_golden(spark, inp), golden_index(spark), **kw)


def test_mapped_golden(spark):
    r = run(spark)
    assert rows(M.mapped(r), ["omid", "openalex_id", "type"]) == rows(read_golden(spark, "mapped.csv"),
                                                                       ["omid", "openalex_id", "type"])


def test_multi_mapped_golden_as_token_bags(spark):
    got = {(x.omid, tuple(sorted(x.openalex_id.split())), x.type) for x in M.multi_mapped(run(spark)).collect()}
    exp = {(x.omid, tuple(sorted(x.openalex_id.split())), x.type)
           for x in read_golden(spark, "multi_mapped.csv").collect()}
    assert got == exp and len(got) == 2


def test_multi_mapped_ids_are_sorted(spark):
    for x in M.multi_mapped(run(spark)).collect():
        assert x.openalex_id.split() == sorted(x.openalex_id.split())


def test_unmapped_golden(spark):
    assert rows(M.unmapped(run(spark))) == rows(read_golden(spark, "unmapped.csv"), ["omid", "type"])


def test_all_rows_golden(spark):
    r = run(spark, "mapping_input_all_rows.csv")
    assert rows(M.mapped(r), ["omid", "openalex_id", "type"]) == rows(read_golden(spark, "mapped_all_rows.csv"),
                                                                       ["omid", "openalex_id", "type"])


def test_all_rows_false_skips_records_with_openalex_ids(spark):
    r = run(spark, "mapping_input_all_rows.csv", all_rows=False)
    inp = read_golden(spark, "mapping_input_all_rows.csv")
    assert r.count() == inp.where(~F.col("ids").contains("openalex:")).count()
    assert r.where(F.col("omid") == "omid:br/06041").count() == 0


def test_issn_blocks_doi_lookup(spark):
    r = run(spark).where(F.col("omid") == "omid:br/06085").collect()
    assert r[0]["outcome"] == M.UNMAPPED


def test_outcomes_partition_the_input(spark):
    r = run(spark)
    n = read_golden(spark, "primary_ents.csv").count()
    parts = [M.mapped(r).count(), M.multi_mapped(r).count(), M.unmapped(r).count()]
    assert sum(parts) == n and parts == [13, 2, 13]


def test_duplicate_input_rows_give_duplicate_output_rows(spark):
    inp = read_golden(spark, "primary_ents.csv")
    r = M.map_records(inp.unionByName(inp.where(F.col("omid") == "omid:br/06041")), golden_index(spark))
    assert r.where(F.col("omid") == "omid:br/06041").count() == 2


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def random_input(spark, n=400, seed=11):
    rng = random.Random(seed)
    pool = [f"doi:{i}" for i in range(40)] + [f"pmid:{i}" for i in range(20)] + [f"issn:{i}" for i in range(20)] + ["wikidata:Q1", "isbn:9"]
    ents = [(f"omid:br/{i % 350}", " ".join(rng.choices(pool, k=rng.randint(0, 5))), rng.choice(["a", "b", "", None])) for i in range(n)]
    idx = [(rng.choice(pool), f"{rng.choice('WS')}{rng.randrange(30)}") for _ in range(80)]
    return (ents, idx, spark.createDataFrame(ents, "omid string, ids string, type string"),
            spark.createDataFrame(idx, "supported_id string, openalex_id string"))


def tier(ids):
    t = ids.split()
    if any(x.startswith("issn:") for x in t):
        return [x for x in t if x.startswith("issn")]
    if any(x.startswith("doi:") for x in t):
        return [x for x in t if x.startswith("doi:")]
    return [x for x in t if x.startswith(("pmid:", "pmcid:", "wikidata:"))]


def test_sets_are_resolved_like_single_lookups(spark):
    ents, idx, e, i = random_input(spark)
    want = sorted((o, str(t), tuple(sorted({w for p in tier(ids) for q, w in idx if p == q}))) for o, ids, t in ents)
    for index, in_place in ((i, False), (M.pid_lists(i), False), (i, True)):
        got = M.map_records(e, index, index_in_place=in_place).collect()
        assert sorted((r.omid, str(r.type), tuple(r.openalex_ids)) for r in got) == want
        assert all(r.n_openalex == len(r.openalex_ids) for r in got)
        lacking = M.unmapped_records(e, index).collect()
        assert sorted((r.omid, str(r.type)) for r in lacking) == sorted((o, t) for o, t, ids in want if not ids)
    untyped = M.unmapped_records(e.drop("type"), i, type_field=False)
    assert untyped.columns == ["omid"] and untyped.count() == sum(not ids for _, _, ids in want)


def test_no_id_list_crosses_a_shuffle_per_record(spark):
    """Lists are exchanged by PID and by PID set only; a record is exchanged on its key, without one."""
    _, _, e, i = random_input(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = M.map_records(e, i)._jdf.queryExecution().executedPlan()
        exchanges, todo = [], [plan]
        while todo:
            node = todo.pop()
            todo += [node.children().apply(k) for k in range(node.children().size())]
            if node.nodeName() == "Exchange":
                exchanges.append([node.output().apply(k).name() for k in range(node.output().size())])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(exchanges) >= 4
    of_records = [x for x in exchanges if "omid" in x]
    assert len(of_records) == 1 and all(set(x) == {"omid", "type", "_key"} for x in of_records)


def test_many_records_on_one_pid_of_many_ids(spark):
    n = 10_000
    ents = spark.range(n).select(F.concat(F.lit("omid:br/"), "id").alias("omid"),
                                 F.when(F.col("id") % 2 == 0, "doi:10.0/x").otherwise("doi:10.0/x doi:10.0/y").alias("ids"),
                                 F.lit("t").alias("type"))
    idx = spark.range(n).select(F.lit("doi:10.0/x").alias("supported_id"), F.concat(F.lit("W"), "id").alias("openalex_id"))
    r = M.map_records(ents, idx)
    assert r.agg(F.sum("n_openalex")).first()[0] == n * n
    length = sum(len(f"W{i}") for i in range(n)) + n - 1
    assert M.multi_mapped(r).where(F.length("openalex_id") == length).count() == n
    assert M.unmapped_records(ents, idx).count() == 0


def test_tiers(spark):
    idx = spark.createDataFrame(
        [("issn:1", "S1"), ("doi:d", "W1"), ("pmid:p", "W2"), ("pmcid:c", "W3"), ("wikidata:Q1", "S2"),
         ("doi:d", "W9")], "supported_id string, openalex_id string")
    ents = spark.createDataFrame(
        [("a", "issn:9 doi:d", "t"), ("b", "doi:d pmid:p", "t"), ("c", "pmid:p pmcid:c wikidata:Q1 isbn:1", "t"),
         ("d", "isbn:1", "t"), ("e", "issn:1 issn:1", "t")], "omid string, ids string, type string")
    got = {r.omid: (list(r.openalex_ids), r.outcome) for r in M.map_records(ents, idx).collect()}
    assert got == {"a": ([], "unmapped"), "b": (["W1", "W9"], "multi_mapped"),
                   "c": (["S2", "W2", "W3"], "multi_mapped"), "d": ([], "unmapped"), "e": (["S1"], "mapped")}


def test_venue_mapping_without_type(spark):
    ven = spark.createDataFrame([("omid:br/9", "issn:0044-295X")], "omid string, ids string")
    r = M.map_records(ven, golden_index(spark), type_field=False).collect()
    assert "type" not in r[0].asDict() and list(r[0]["openalex_ids"]) == ["S2754884180"]


def test_mapping_with_a_hot_placeholder_pid(spark):
    n = 3000
    ents = spark.range(n).select(
        F.concat(F.lit("omid:br/"), F.col("id").cast("string")).alias("omid"),
        F.when(F.col("id") % 3 == 0, F.lit("doi:10.0/placeholder"))
        .otherwise(F.concat(F.lit("doi:10.1/"), (F.col("id") % 700).cast("string"))).alias("ids"),
        F.lit("t").alias("type"))
    idx = spark.range(700).select(F.concat(F.lit("doi:10.1/"), F.col("id").cast("string")).alias("supported_id"),
                                  F.concat(F.lit("W"), F.col("id").cast("string")).alias("openalex_id")) \
        .unionByName(spark.createDataFrame([("doi:10.0/placeholder", "W900"), ("doi:10.0/placeholder", "W901")],
                                           "supported_id string, openalex_id string"))
    plain = rows(M.map_records(ents, idx), ["omid", "outcome", "n_openalex"])
    stored = rows(M.map_records(ents, M.pid_lists(idx)), ["omid", "outcome", "n_openalex"])
    assert plain == stored
    assert sum(1 for r in plain if r[1] == M.MULTI_MAPPED) == 1000


def test_repeated_records_keep_their_number(spark):
    ents = spark.createDataFrame(
        [("a", "doi:1 doi:2 doi:2", "t")] * 3 + [("a", "doi:1 doi:2 doi:2", None)] * 2 + [("b", "isbn:9", "t")] * 4
        + [("c", "doi:7", "t")], "omid string, ids string, type string")
    idx = spark.createDataFrame([("doi:1", "W1"), ("doi:1", "W2"), ("doi:2", "W2"), ("doi:2", "W2")],
                                "supported_id string, openalex_id string")
    got = sorted((r.omid, str(r.type), tuple(r.openalex_ids)) for r in M.map_records(ents, idx).collect())
    assert got == [("a", "None", ("W1", "W2"))] * 2 + [("a", "t", ("W1", "W2"))] * 3 + [("b", "t", ())] * 4 + [("c", "t", ())]


def test_bucketed_index_is_joined_without_shuffling_it(spark):
    import uuid

    name = "idx_" + uuid.uuid4().hex[:8]
    P.write_bucketed_index(golden_index(spark), name, 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        r = M.map_records(read_golden(spark, "primary_ents.csv"), spark.table(name), index_in_place=True)
        assert rows(M.mapped(r), ["omid", "openalex_id", "type"]) == rows(read_golden(spark, "mapped.csv"),
                                                                           ["omid", "openalex_id", "type"])
        def index_shuffles(df):
            return sum("Exchange hashpartitioning(supported_id" in line and "ReusedExchange" not in line for line in executed(df).split("\n"))

        assert index_shuffles(r) == 0  # only the Meta side is shuffled on the PID
        assert index_shuffles(M.map_records(read_golden(spark, "primary_ents.csv"), golden_index(spark))) == 1  # once for both joins
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_aqe_splits_the_hot_pid_partition(spark):
    n = 20000
    ents = spark.range(n).select(
        F.concat(F.lit("omid:br/"), F.col("id").cast("string")).alias("omid"),
        F.when(F.col("id") % 3 == 0, F.lit("doi:10.0/placeholder"))
        .otherwise(F.concat(F.lit("doi:10.1/"), F.col("id").cast("string"))).alias("ids"),
        F.lit("t").alias("type"))
    idx = spark.createDataFrame([("doi:10.0/placeholder", "W1"), ("doi:10.1/5", "W2")],
                                "supported_id string, openalex_id string")
    confs = {"spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
             "spark.sql.adaptive.coalescePartitions.enabled": "false",
             "spark.sql.shuffle.partitions": "8"}
    old = {k: spark.conf.get(k, None) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        # stored, as run_mapping does it: both sides of the join are plain shuffles then
        path = tempfile.mkdtemp() + "/lists"
        M.pid_lists(idx).write.parquet(path)
        r = M.map_records(ents, spark.read.parquet(path))
        got = {x.outcome: x.n for x in r.groupBy("outcome").agg(F.count("*").alias("n")).collect()}
        qe = r._jdf.queryExecution()
        qe.toRdd().count()  # run this DataFrame's own plan so AQE finalises it
        plan = qe.executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    hot = len(range(0, n, 3))
    assert got == {"mapped": hot + 1, "unmapped": n - hot - 1}
    assert "SortMergeJoin(skew=true)" in plan
