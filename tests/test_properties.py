"""Property and metamorphic checks (batched: one Spark job per property)."""

import random

from conftest import read_golden, rows
from pyspark.sql import functions as F

from pidlink.functions import bracket_content, tokens
from pidlink.operators import mapping as M
from pidlink.operators import pids as P
from pidlink.plans import jobs as J

BLANKS = [" ", "\t", "\n", "\x0b", "\x0c", "\r", "\x1c", "\x1d", "\x1e", "\x1f", "\x85", "\xa0", " ", "　"]
CHARS = list("abc:/[]12.;") + BLANKS


def test_tokens_and_brackets_match_python_on_random_text(spark):
    rng = random.Random(11)
    texts = ["".join(rng.choice(CHARS) for _ in range(rng.randint(0, 30))) for _ in range(400)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    got = {r.i: (list(r.t), r.b) for r in df.select("i", tokens("s").alias("t"), bracket_content("s").alias("b")).collect()}

    def py_bracket(v):
        try:
            return v[v.index("[") + 1:v.index("]")]
        except ValueError:
            return None

    for i, t in enumerate(texts):
        assert got[i] == (t.split(), py_bracket(t)), repr(t)


def golden_index(spark):
    return P.pid_index(read_golden(spark, "works_pid_index.csv"), read_golden(spark, "sources_pid_index.csv"))


def test_mapping_is_independent_of_input_order_and_partitioning(spark):
    inp = read_golden(spark, "primary_ents.csv")
    a = rows(M.map_records(inp, golden_index(spark)), ["omid", "type", "outcome", "n_openalex"])
    shuffled = inp.repartition(7).orderBy(F.rand(3)).repartition(3)
    b = rows(M.map_records(shuffled, golden_index(spark).repartition(5)), ["omid", "type", "outcome", "n_openalex"])
    assert a == b


def test_categories_cover_every_multi_mapped_row(spark):
    from pidlink.plans import adapters as A

    sf = "/root/testdata/sf0.001"
    import os
    if not os.path.isdir(sf):
        return
    m = J.mapping_job(A.meta_rows(spark, sf), A.work_records(spark, sf), A.source_records(spark, sf))
    mm = m.multi_mapped()
    cats = J.categorisation_job(mm, A.ordered(A.work_records(spark, sf)), A.ordered(A.source_records(spark, sf)))
    total = cats.counts().agg(F.sum("n")).collect()[0][0]
    assert total == mm.count()
    outcomes = {r.outcome: r.n for r in m.result.groupBy("outcome").agg(F.count("*").alias("n")).collect()}
    assert sum(outcomes.values()) == m.primary_entities.count()


def test_version_regex_same_in_java_and_python(spark):
    import re

    from pidlink.functions import constants as K

    rng = random.Random(5)
    alphabet = list("v./0123456789abx") + ["\n"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 14))) for _ in range(600)]
    texts += ["10.1/abc.v1", "10.1/abc/v12/x", "10.1/x/3", "10.1/xv2", "10.1/abcv2", "10.1/a.v123"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    got = {r.i: r.m for r in df.select("i", F.col("s").rlike(K.VERSION_PATTERN).alias("m")).collect()}
    pattern = re.compile(K.VERSION_PATTERN)
    for i, t in enumerate(texts):
        assert got[i] == bool(pattern.findall(t)), repr(t)
