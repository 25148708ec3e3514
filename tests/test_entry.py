"""Driver contract: every query has an oracle and matches it on the smallest data set."""

import os
import shutil
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as E
from pidlink.plans import oracle, queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("orders", "customer", "lineitem", "supplier"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_keys_match():
    assert set(queries.QUERIES) == set(oracle.oracle_sql())
    assert set(queries.QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


def copy_of_the_core(tmp_path):
    root = os.path.dirname(os.path.abspath(E.__file__))
    ignored = shutil.ignore_patterns("llm", "__pycache__")
    shutil.copytree(os.path.join(root, "pidlink"), tmp_path / "pidlink", ignore=ignored)
    shutil.copy(os.path.join(root, "__spark_entry__.py"), tmp_path)
    return tmp_path


def test_entry_without_the_optional_part(tmp_path):
    code = """
import __spark_entry__ as E
from pidlink.plans import queries
assert set(E.queries()) == set(E.oracle_sql()) == set(queries.QUERIES)
"""
    subprocess.run([sys.executable, "-c", code], check=True, cwd=copy_of_the_core(tmp_path))


def test_a_broken_optional_part_is_an_error(tmp_path):
    root = copy_of_the_core(tmp_path)
    (root / "pidlink" / "llm").mkdir()
    (root / "pidlink" / "llm" / "__init__.py").write_text("")
    (root / "corpus_pipeline.py").write_text("import a_library_that_is_missing\n")
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__"], capture_output=True, text=True, cwd=root)
    assert done.returncode and "a_library_that_is_missing" in done.stderr


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["omid", "type", "openalex_id", "n_openalex", "outcome"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    con = duck
    df = queries.QUERIES[name](spark, SF)
    con.execute(f"CREATE OR REPLACE VIEW oracle_view AS {oracle.oracle_sql()[name]}")
    res = con.execute("SELECT * FROM oracle_view")
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    def norm(v):
        if v is None:
            return (0, "")
        return (1, round(v, 6) if isinstance(v, float) else v)

    got = sorted(tuple(norm(r[c]) for c in sorted(df.columns)) for r in df.collect())
    idx = [ocols.index(c) for c in sorted(ocols)]
    exp = sorted(tuple(norm(r[i]) for i in idx) for r in res.fetchall())
    assert got == exp



def test_tables_are_dealt_to_more_partitions_the_larger_they_are(spark, tmp_path, monkeypatch):
    """The rows of a partition do not grow with the table; no row is lost or repeated."""
    from pidlink import fixtures as FX

    spark.range(20_000).selectExpr("id AS o_orderkey", "uuid() AS o_comment").write.parquet(str(tmp_path / "orders.parquet"))
    assert FX.base_table(spark, str(tmp_path), "orders").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(FX, "PARTITION_BYTES", 50_000)
    dealt = FX.base_table(spark, str(tmp_path), "orders")
    assert dealt.rdd.getNumPartitions() >= FX.stored_bytes(spark, str(tmp_path / "orders.parquet")) / 50_000 > 8
    assert sorted(r.o_orderkey for r in dealt.select("o_orderkey").collect()) == list(range(20_000))
