"""Input views derived from the driver's parquet tables.

The driver's tables hold no bibliographic identifiers, so every registered query starts
from these views: one CTE chain that runs unchanged in Spark SQL and in DuckDB (prefix
``WITH``, append a ``SELECT``). They only shape rows into the schemas the jobs expect
(Meta dump rows, flat OpenAlex id objects, provenance snapshots, ...); all the work of a
query is done afterwards by the library's operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("orders", "customer", "lineitem", "supplier")

FIXTURE_VIEWS = (
    "fx_key", "fx_meta", "fx_works", "fx_sources", "fx_br", "fx_prov",
    "fx_authorships", "fx_agents", "fx_locations", "fx_counts_by_year", "fx_refs",
)

CTE = """
fx_key AS (
  SELECT o_orderkey AS k, o_custkey AS c, o_orderpriority AS pri,
    CASE o_orderkey % 8
      WHEN 0 THEN concat('10.5281/zenodo.', CAST(o_orderkey AS STRING))
      WHEN 1 THEN concat('10.6084/m9.figshare.', CAST(o_orderkey AS STRING), '.v', CAST(1 + o_orderkey % 3 AS STRING))
      WHEN 2 THEN concat('10.1101/2020.', lpad(CAST(o_orderkey AS STRING), 7, '0'))
      ELSE concat('10.1016/j.x.', CAST(o_orderkey AS STRING)) END AS doi
  FROM orders),
fx_meta_once AS (
  SELECT a.k AS k,
    concat_ws(' ', concat('omid:br/06', CAST(a.k AS STRING)),
      CASE WHEN a.k % 12 IN (0,1,2,3,4,5,6,8) THEN concat('doi:', a.doi) END,
      CASE WHEN a.k % 12 IN (2,3,4,5) AND b.doi IS NOT NULL THEN concat('doi:', b.doi) END,
      CASE WHEN a.k % 24 = 5 AND d.doi IS NOT NULL THEN concat('doi:', d.doi) END,
      CASE WHEN a.k % 12 IN (7,8) THEN concat('issn:1000-', lpad(CAST(a.c % 10000 AS STRING), 4, '0')) END,
      CASE WHEN a.k % 12 = 9 THEN concat('pmid:', CAST(a.k AS STRING)) END,
      CASE WHEN a.k % 12 IN (9,10) THEN concat('pmcid:PMC', CAST(a.k AS STRING)) END,
      CASE WHEN a.k % 24 = 10 THEN concat('wikidata:Q', CAST(a.c AS STRING)) END,
      CASE WHEN a.k % 24 = 11 THEN concat('isbn:978', lpad(CAST(a.k AS STRING), 10, '0')) END,
      CASE WHEN a.k % 10 = 0 THEN concat('openalex:W', CAST(a.k AS STRING)) END) AS id,
    CASE WHEN a.k % 5 = 0 THEN '' ELSE concat('Venue ', CAST(a.c AS STRING), ' [omid:br/07', CAST(a.c AS STRING),
      CASE WHEN a.c % 3 = 0 THEN '' ELSE concat(' issn:1000-', lpad(CAST(a.c % 10000 AS STRING), 4, '0')) END, ']') END AS venue,
    CASE WHEN a.k % 6 = 0 THEN '' ELSE concat('Doe, J. [omid:ra/06', CAST(a.c AS STRING), ' orcid:0000-', lpad(CAST(a.c AS STRING), 6, '0'),
      ']; Roe, R. [omid:ra/07', CAST(a.k % 50 AS STRING), ']; NoBracket') END AS author,
    concat('Pub [omid:ra/08', CAST(a.c % 9 AS STRING), ' crossref:', CAST(a.c % 9 AS STRING), ']') AS publisher,
    CASE WHEN a.k % 4 = 0 THEN concat('Ed, E. [omid:ra/09', CAST(a.c % 20 AS STRING), ' orcid:9-', CAST(a.c % 20 AS STRING), ']') ELSE '' END AS editor,
    CASE a.pri WHEN '1-URGENT' THEN 'journal article' WHEN '2-HIGH' THEN 'book' WHEN '3-MEDIUM' THEN 'journal'
      WHEN '5-LOW' THEN '' ELSE 'dataset' END AS type
  FROM fx_key a
  LEFT JOIN fx_key b ON b.k = a.k + CASE WHEN a.k % 24 = 15 THEN 3 ELSE 8 END
  LEFT JOIN fx_key d ON d.k = a.k + 16),
fx_meta AS (
  SELECT k, id, venue, author, publisher, editor, type FROM fx_meta_once
  UNION ALL
  SELECT -k, id, venue, author, publisher, editor, type FROM fx_meta_once WHERE k % 40 = 4),
fx_own AS (
  SELECT k, CASE WHEN k % 7 = 6 THEN concat('10.9999/none.', CAST(k AS STRING)) ELSE doi END AS doi,
    CAST(k + CASE WHEN k % 7 = 6 THEN 90000000000 ELSE 0 END AS STRING) AS held
  FROM fx_key),
fx_works AS (
  SELECT concat('https://openalex.org/W', CAST(k AS STRING)) AS id, concat('https://doi.org/', doi) AS doi,
    CASE WHEN k % 12 = 9 THEN concat('https://pubmed.ncbi.nlm.nih.gov/', held) END AS pmid,
    CASE WHEN k % 12 IN (9,10) AND k % 5 <> 0 THEN concat('https://www.ncbi.nlm.nih.gov/pmc/articles/PMC', held) END AS pmcid,
    CASE WHEN k % 5 = 1 THEN 'erratum' ELSE 'article' END AS type,
    CASE WHEN k % 3 = 2 THEN 'submittedVersion' ELSE 'publishedVersion' END AS version
  FROM fx_own
  UNION ALL
  SELECT concat('https://openalex.org/W', CAST(900000000 + k AS STRING)), concat('https://doi.org/', doi),
    CAST(NULL AS STRING), CAST(NULL AS STRING), 'article', 'publishedVersion'
  FROM fx_key WHERE k % 13 = 0),
fx_sources AS (
  SELECT id, issn_l, CASE WHEN c % 11 <> 3 THEN issn_l END AS issn1,
    CASE WHEN c % 5 = 0 AND c % 11 <> 3 THEN concat(region, lpad(CAST((c + 1) % 10000 AS STRING), 4, '0')) END AS issn2,
    CASE WHEN c % 4 = 0 THEN concat('https://www.wikidata.org/entity/Q', held)
         WHEN c % 4 = 1 THEN concat('http://www.wikidata.org/entity/Q', held) END AS wikidata
  FROM (SELECT c, region, held, concat('https://openalex.org/S', CAST(c AS STRING)) AS id,
          concat(region, lpad(CAST(c % 10000 AS STRING), 4, '0')) AS issn_l
        FROM (SELECT c_custkey AS c, CASE WHEN c_custkey % 6 = 5 THEN '2000-' ELSE '1000-' END AS region,
                CAST(c_custkey + CASE WHEN c_custkey % 6 = 5 THEN 900000000 ELSE 0 END AS STRING) AS held
              FROM customer) c1) c2),
fx_br AS (
  SELECT concat('https://w3id.org/oc/meta/br/06', CAST(k AS STRING)) AS br_uri,
    CASE pri WHEN '1-URGENT' THEN 'http://purl.org/spar/fabio/JournalArticle' WHEN '2-HIGH' THEN 'http://purl.org/spar/fabio/Book'
      WHEN '3-MEDIUM' THEN 'http://purl.org/spar/fabio/Journal' WHEN '5-LOW' THEN 'http://purl.org/spar/fabio/Expression'
      ELSE 'http://example.org/Unlisted' END AS type_uri,
    CASE WHEN k % 24 = 23 AND k % 10 <> 0 THEN 0 ELSE 1 END AS has_identifier
  FROM fx_key
  UNION ALL
  SELECT concat('https://w3id.org/oc/meta/br/07', CAST(c_custkey AS STRING)), 'http://purl.org/spar/fabio/Journal',
    CASE WHEN c_custkey % 3 = 0 THEN 0 ELSE 1 END
  FROM customer),
fx_prov AS (
  SELECT concat('https://w3id.org/oc/meta/br/06', CAST(l_orderkey AS STRING)) AS br_uri,
    CASE l_suppkey % 4 WHEN 0 THEN 'https://api.crossref.org/' WHEN 1 THEN 'https://api.datacite.org/'
      WHEN 2 THEN 'https://doi.org/10.5281/zenodo' ELSE CAST(NULL AS STRING) END AS source_uri
  FROM lineitem
  UNION ALL
  SELECT concat('https://w3id.org/oc/meta/br/07', CAST(c_custkey AS STRING)),
    CASE WHEN c_custkey % 7 <> 0 THEN 'https://api.crossref.org/' END
  FROM customer),
fx_authorships AS (
  SELECT concat('https://openalex.org/W', CAST(l_orderkey AS STRING)) AS work_id,
    CASE WHEN l_linenumber = 1 THEN 'first' ELSE 'middle' END AS author_position,
    concat('A', CAST(l_suppkey AS STRING)) AS author_id,
    CASE WHEN l_partkey % 4 = 0 THEN CAST(NULL AS STRING) ELSE concat('I', CAST(l_partkey AS STRING)) END AS institution_id,
    l_linenumber AS ord1, l_partkey AS ord2, l_suppkey AS ord3
  FROM lineitem),
fx_agents AS (
  SELECT concat('https://openalex.org/A', CAST(s_suppkey AS STRING)) AS id,
    CASE WHEN s_suppkey % 2 = 0 THEN concat('https://orcid.org/0000-', lpad(CAST(s_suppkey AS STRING), 4, '0')) END AS orcid,
    CASE WHEN s_suppkey % 3 <> 0 THEN concat('https://ror.org/0', CAST(s_nationkey AS STRING)) END AS ror,
    CASE WHEN s_suppkey % 4 = 0 THEN concat('http://www.wikidata.org/entity/Q', CAST(s_suppkey AS STRING))
         WHEN s_suppkey % 4 = 1 THEN concat('https://www.wikidata.org/entity/Q', CAST(s_suppkey AS STRING))
         WHEN s_suppkey % 4 = 2 THEN concat('Q', CAST(s_suppkey AS STRING)) END AS wikidata
  FROM supplier),
fx_locations AS (
  SELECT concat('https://openalex.org/W', CAST(l_orderkey AS STRING)) AS work_id,
    CASE WHEN l_suppkey % 5 = 0 THEN CAST(NULL AS STRING) ELSE concat('https://openalex.org/S', CAST(l_suppkey AS STRING)) END AS source_id,
    concat('https://example.org/l/', CAST(l_partkey AS STRING)) AS landing_page_url, l_returnflag = 'N' AS is_oa,
    CASE l_linestatus WHEN 'O' THEN 'submittedVersion' ELSE 'publishedVersion' END AS version,
    l_linenumber AS ord1, l_partkey AS ord2
  FROM lineitem),
fx_counts_by_year AS (
  SELECT concat('https://openalex.org/S', CAST(o_custkey AS STRING)) AS source_id, year(o_orderdate) AS year,
    count(*) AS works_count, count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS oa_works_count
  FROM orders GROUP BY o_custkey, year(o_orderdate)),
fx_refs AS (
  SELECT concat('https://openalex.org/W', CAST(l_orderkey AS STRING)) AS work_id,
    CASE WHEN l_partkey % 9 = 0 THEN '' ELSE concat('https://openalex.org/W', CAST(l_partkey AS STRING)) END AS referenced_work_id
  FROM lineitem)
"""


def with_fixtures(select_sql: str) -> str:
    """``WITH <fixture chain> <select_sql>``; the select may add ``, name AS (...)`` CTEs
    by starting with a comma."""
    body = select_sql.lstrip()
    if body.startswith(","):
        return "WITH " + CTE.strip() + "\n" + body
    return "WITH " + CTE.strip() + "\n" + body


# A driver table may be one parquet file (one split). It is spread over the cluster's cores, and over
# more partitions the larger it is, by a hash of its key (deterministic, so a retried task sees the
# same rows).
PARTITION_BYTES = 4 << 20
TABLE_KEYS = {"orders": "o_orderkey", "lineitem": "l_orderkey", "customer": "c_custkey", "supplier": "s_suppkey"}


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of a file or folder of any file system that Spark knows."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(p).getLength()


def base_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    df = spark.read.parquet(path)
    key = TABLE_KEYS.get(name)
    if key is None:
        return df
    return df.repartition(max(spark.sparkContext.defaultParallelism, -(-stored_bytes(spark, path) // PARTITION_BYTES), 1), key)


def register_base_tables(spark: SparkSession, sf_dir: str) -> None:
    for t in BASE_TABLES:
        base_table(spark, sf_dir, t).createOrReplaceTempView(t)


_MEMO: dict[tuple[str, str, str], DataFrame] = {}


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One fixture view as a DataFrame, read from ``sf_dir`` (analysed once per session)."""
    if name not in FIXTURE_VIEWS:
        raise KeyError(name)
    key = (spark.sparkContext.applicationId, sf_dir, name)  # unique per running context
    if key not in _MEMO:
        register_base_tables(spark, sf_dir)
        _MEMO[key] = spark.sql(with_fixtures(f"SELECT * FROM {name}"))
    return _MEMO[key]
