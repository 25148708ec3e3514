from conftest import read_golden, rows
from pyspark.sql import functions as F

from pidlink.functions import bracket_content, tokens
from pidlink.operators import extract as X


def meta(spark):
    return read_golden(spark, "meta_sample.csv")


def test_primary_entities_golden(spark):
    got = X.primary_entities(meta(spark))
    assert rows(got) == rows(read_golden(spark, "primary_ents.csv"), ["omid", "ids", "type"])


def test_empty_type_stays_empty_string(spark):
    got = X.primary_entities(meta(spark)).where(F.col("omid") == "omid:br/060183").collect()
    assert got[0]["type"] == ""


def test_venues_golden(spark):
    got = X.venues(meta(spark))
    assert rows(got) == rows(read_golden(spark, "venues.csv"), ["omid", "ids"])


def test_responsible_agents_golden(spark):
    got = X.responsible_agents(meta(spark))
    assert rows(got) == rows(read_golden(spark, "resp_ags.csv"), ["omid", "ids", "ra_role"])


def test_duplicate_orcid_token_is_kept(spark):
    got = X.responsible_agents(meta(spark)).where(F.col("omid") == "omid:ra/0621023450").collect()
    assert got[0]["ids"] == "orcid:0000-0002-0604-6590 orcid:0000-0002-0604-6590"


def test_tokens_split_like_python(spark):
    samples = ["  omid:br/1\tdoi:10.1/x pmid:2 \x1cissn:3  ", "", None, "omid:br/1"]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    got = [r[0] for r in df.select(tokens("s")).collect()]
    assert got == [(s or "").split() for s in samples]


def test_bracket_content_like_python_slice(spark):
    samples = ["Name [omid:br/1 issn:2]", "x ] y [ z", "no brackets", "a [b", "[]", "[a] [b]"]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    got = [r[0] for r in df.select(bracket_content("s")).collect()]

    def py(v):
        try:
            return v[v.index("[") + 1:v.index("]")]
        except ValueError:
            return None

    assert got == [py(s) for s in samples]


def test_last_omid_wins_and_rows_without_pids_drop(spark):
    df = spark.createDataFrame(
        [("omid:br/1 doi:a omid:br/2 doi:a", "t"), ("omid:br/3", "t"), ("doi:b", "x")], "id string, type string")
    got = rows(X.primary_entities(df))
    assert got == [("", "doi:b", "x"), ("omid:br/2", "doi:a doi:a", "t")]


def test_all_rows_false_skips_row_and_its_entities(spark):
    df = spark.createDataFrame(
        [("omid:br/1 doi:a openalex:W1", "V [omid:br/9 issn:1]", "A [omid:ra/1 orcid:1]", "", "", "t"),
         ("omid:br/2 doi:b", "V [omid:br/8 issn:2]", "", "", "", "t")],
        "id string, venue string, author string, publisher string, editor string, type string")
    assert [r.omid for r in X.primary_entities(df, all_rows=False).collect()] == ["omid:br/2"]
    assert [r.omid for r in X.venues(df, all_rows=False).collect()] == ["omid:br/8"]
    assert X.responsible_agents(df, all_rows=False).count() == 0
    assert X.primary_entities(df, all_rows=True).count() == 2


def test_agent_without_brackets_is_skipped(spark):
    df = spark.createDataFrame([("Doe [omid:ra/1 orcid:1]; NoBracket; Roe [omid:ra/2]", "P [omid:ra/3 crossref:1]",
                                 "")], "author string, publisher string, editor string")
    got = rows(X.responsible_agents(df))
    assert got == [("omid:ra/1", "orcid:1", "author"), ("omid:ra/3", "crossref:1", "publisher")]


def test_unparsable_cells_are_reported(spark):
    df = spark.createDataFrame(
        [("omid:br/1 doi:a", "Venue without brackets", "A [omid:ra/1 orcid:1]; NoBracket", "", "", "t"),
         ("omid:br/2 doi:b", "V [omid:br/8 issn:2]", "", "P", "", "t")],
        "id string, venue string, author string, publisher string, editor string, type string")
    assert X.unparsable_venues(df).count() == 1
    assert rows(X.unparsable_agents(df)) == [("author", "NoBracket"), ("publisher", "P")]


def test_last_bracket_option(spark):
    df = spark.createDataFrame([("Proc. [2020] Conf [omid:br/1 issn:1]",), ("Plain [omid:br/2 issn:2]",)], "s string")
    first = [r[0] for r in df.select(bracket_content("s")).collect()]
    last = [r[0] for r in df.select(bracket_content("s", last=True)).collect()]
    assert first == ["2020", "omid:br/2 issn:2"]
    assert last == ["omid:br/1 issn:1", "omid:br/2 issn:2"]
