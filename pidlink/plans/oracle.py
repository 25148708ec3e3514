"""DuckDB SQL equivalents of the registered queries (the driver's correctness oracle).

Each string is ``WITH <fixture chain>, <query CTEs> SELECT ...`` over the pre-registered
parquet views. Written set-at-a-time in DuckDB's dialect, independently of the Spark
plans; the fixture key ``k`` serves as the row key here (each Meta row has its own).
"""

from __future__ import annotations

from pidlink.fixtures import with_fixtures
from pidlink.functions import constants as K
from pidlink.operators.provenance import pivot_types


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _strip(col: str, prefix: str) -> str:
    return f"(CASE WHEN starts_with({col}, {_q(prefix)}) THEN substr({col}, {len(prefix) + 1}) ELSE {col} END)"


def _tokens(col: str) -> str:
    return f"list_filter(regexp_split_to_array(coalesce({col}, ''), '\\s+'), lambda t: t <> '')"


def _bracket(col: str) -> str:
    s, e = f"strpos({col}, '[')", f"strpos({col}, ']')"
    return (f"(CASE WHEN {s} > 0 AND {e} > 0 THEN (CASE WHEN {e} - {s} - 1 > 0 "
            f"THEN substr({col}, {s} + 1, {e} - {s} - 1) ELSE '' END) END)")


def _omid_of(tok: str) -> str:
    return f"coalesce(list_filter({tok}, lambda t: starts_with(t, 'omid:'))[-1], '')"


def _ids_of(tok: str) -> str:
    return f"array_to_string(list_filter({tok}, lambda t: NOT starts_with(t, 'omid:')), ' ')"


def _in(values) -> str:
    return "(" + ", ".join(_q(v) for v in values) + ")"


# ------------------------------------------------------------------ shared CTE blocks

META = f""",
o_tok AS (SELECT k, {_tokens('id')} AS tok, coalesce(type, '') AS type FROM fx_meta),
o_pe AS (SELECT k, {_omid_of('tok')} AS omid, {_ids_of('tok')} AS ids, type,
                len(list_filter(tok, lambda t: starts_with(t, 'openalex:'))) > 0 AS has_oa FROM o_tok),
o_ents AS (SELECT k, omid, ids, type, has_oa FROM o_pe WHERE ids <> ''),
o_vinner AS (SELECT k, {_bracket('venue')} AS inner_ FROM fx_meta WHERE venue IS NOT NULL AND venue <> ''),
o_ven AS (SELECT DISTINCT omid, ids FROM (
    SELECT {_omid_of('t')} AS omid, {_ids_of('t')} AS ids
    FROM (SELECT {_tokens('inner_')} AS t FROM o_vinner WHERE inner_ IS NOT NULL)) WHERE ids <> '')"""

RESPONSIBLE = f""",
o_raw AS (
  SELECT 'author' AS ra_role, unnest(string_split(author, '; ')) AS e FROM fx_meta WHERE author IS NOT NULL AND author <> ''
  UNION ALL SELECT 'publisher', publisher FROM fx_meta WHERE publisher IS NOT NULL AND publisher <> ''
  UNION ALL SELECT 'editor', unnest(string_split(editor, '; ')) FROM fx_meta WHERE editor IS NOT NULL AND editor <> ''),
o_rai AS (SELECT ra_role, {_bracket('e')} AS inner_ FROM o_raw),
o_rat AS (SELECT ra_role, {_tokens('inner_')} AS t FROM o_rai WHERE inner_ IS NOT NULL),
o_ra AS (SELECT DISTINCT omid, ids, ra_role FROM (SELECT {_omid_of('t')} AS omid, {_ids_of('t')} AS ids, ra_role FROM o_rat)
         WHERE ids <> '')"""

OA_ID = _strip("id", K.OPENALEX_URI)

INDEX = f""",
o_wp AS (
  SELECT 'doi:' || {_strip('doi', K.DOI_URI)} AS supported_id, {OA_ID} AS openalex_id FROM fx_works WHERE doi IS NOT NULL
  UNION ALL SELECT 'pmid:' || {_strip('pmid', K.PUBMED_URI)}, {OA_ID} FROM fx_works WHERE pmid IS NOT NULL
  UNION ALL SELECT 'pmcid:' || {_strip('pmcid', K.PMC_URI)}, {OA_ID} FROM fx_works WHERE pmcid IS NOT NULL),
o_sp AS (
  SELECT 'issn:' || issn1 AS supported_id, {OA_ID} AS openalex_id FROM fx_sources WHERE issn1 IS NOT NULL
  UNION ALL SELECT 'issn:' || issn2, {OA_ID} FROM fx_sources WHERE issn2 IS NOT NULL
  UNION ALL SELECT 'issn:' || issn_l, {OA_ID} FROM fx_sources WHERE issn1 IS NULL AND issn2 IS NULL
  UNION ALL SELECT 'wikidata:' || (CASE WHEN starts_with(wikidata, 'http:') THEN {_strip('wikidata', K.WIKIDATA_HTTP_URI)}
                                        ELSE {_strip('wikidata', K.WIKIDATA_HTTPS_URI)} END), {OA_ID}
    FROM fx_sources WHERE starts_with(wikidata, 'http:') OR starts_with(wikidata, 'https:')),
o_idx AS (
  SELECT 'WorksDoi' AS table_name, supported_id, openalex_id FROM o_wp WHERE starts_with(supported_id, 'doi')
  UNION ALL SELECT 'WorksPmid', supported_id, openalex_id FROM o_wp WHERE starts_with(supported_id, 'pmid')
  UNION ALL SELECT 'WorksPmcid', supported_id, openalex_id FROM o_wp WHERE starts_with(supported_id, 'pmcid')
  UNION ALL SELECT 'SourcesIssn', supported_id, openalex_id FROM o_sp WHERE starts_with(supported_id, 'issn')
  UNION ALL SELECT 'SourcesWikidata', supported_id, openalex_id FROM o_sp WHERE starts_with(supported_id, 'wikidata'))"""


def _lookup(t: str) -> str:
    return f"""(CASE WHEN len(list_filter({t}, lambda x: starts_with(x, 'issn:'))) > 0
          THEN list_filter({t}, lambda x: starts_with(x, 'issn'))
        WHEN len(list_filter({t}, lambda x: starts_with(x, 'doi:'))) > 0
          THEN list_filter({t}, lambda x: starts_with(x, 'doi:'))
        ELSE list_filter({t}, lambda x: starts_with(x, 'pmid:') OR starts_with(x, 'pmcid:') OR starts_with(x, 'wikidata:'))
   END)"""


def _map_block(name: str, src: str, key: str, cols: str) -> str:
    """Mapping of table ``src`` (row key ``key``, carried columns ``cols``) -> CTE ``name``."""
    return f""",
{name}_look AS (SELECT {key}, {cols}, list_distinct({_lookup('t2')}) AS pids
   FROM (SELECT *, {_tokens('ids')} AS t2 FROM {src})),
{name}_hit AS (SELECT l.{key}, i.openalex_id FROM (SELECT {key}, unnest(pids) AS pid FROM {name}_look) l
   JOIN o_idx i ON i.supported_id = l.pid),
{name}_agg AS (SELECT {key}, list_sort(list_distinct(list(openalex_id))) AS oaids FROM {name}_hit GROUP BY {key}),
{name} AS (SELECT l.{key}, {', '.join('l.' + c.strip() for c in cols.split(','))},
    array_to_string(coalesce(a.oaids, []::VARCHAR[]), ' ') AS openalex_id,
    len(coalesce(a.oaids, []::VARCHAR[]))::BIGINT AS n_openalex,
    CASE WHEN len(coalesce(a.oaids, []::VARCHAR[])) = 0 THEN 'unmapped'
         WHEN len(a.oaids) = 1 THEN 'mapped' ELSE 'multi_mapped' END AS outcome
  FROM {name}_look l LEFT JOIN {name}_agg a ON a.{key} = l.{key})"""


MAPPING = META + INDEX + _map_block("o_map", "o_ents", "k", "omid, type, has_oa")

INVERTED = MAPPING + """ SELECT omid, openalex_id FROM (
  SELECT omid, openalex_id, count(*) OVER (PARTITION BY openalex_id) AS c FROM o_map WHERE outcome = 'mapped')
WHERE c > 1"""

MM = MAPPING + """,
o_mm AS (SELECT k, omid, openalex_id, type, string_split(openalex_id, ' ') AS ids FROM o_map
         WHERE outcome = 'multi_mapped')"""

_CLUES = " OR ".join(f"starts_with(sfx, {_q(c)})" for c in K.PREPRINT_STRING_CLUES)

CATEGORIES = MM + f""",
o_mmw AS (SELECT * FROM o_mm WHERE starts_with(openalex_id, 'W')),
o_pos AS (SELECT k, len(ids) AS n_ids, unnest(ids) AS oaid, generate_subscripts(ids, 1) - 1 AS pos FROM o_mmw),
o_pp AS (
  SELECT p.k, p.n_ids, p.pos, w.id AS v_oa, w.doi, w.pmid, w.pmcid, w.type AS wtype, w.version,
    coalesce(w.doi IS NOT NULL AND w.doi <> '', false) AS has_doi,
    {_strip('lower(w.doi)', K.DOI_URI)} AS dn
  FROM o_pos p LEFT JOIN fx_works w ON w.id = {_q(K.OPENALEX_URI)} || p.oaid),
o_pp2 AS (SELECT *, split_part(dn, '/', 1) AS pfx, substr(dn, length(split_part(dn, '/', 1)) + 1) AS sfx FROM o_pp),
o_ev AS (
  SELECT k, pos, CASE
      WHEN has_doi AND regexp_matches(dn, {_q(K.VERSION_PATTERN)}) THEN 1
      WHEN has_doi AND pfx IN {_in(K.PREPRINT_DOI_PREFIXES)} AND version IN {_in(K.REPOSITORY_VERSIONS)} THEN 2
      WHEN has_doi AND ({_CLUES}) THEN 3 END AS rank
  FROM o_pp2),
o_vals AS (SELECT DISTINCT k, pos, v FROM (SELECT k, pos, unnest([v_oa, doi, pmid, pmcid]) AS v FROM o_pp)
           WHERE v IS NOT NULL AND v <> ''),
o_aev AS (SELECT k, pos, 0 AS rank FROM (
    SELECT k, pos, row_number() OVER (PARTITION BY k, v ORDER BY pos) AS rn FROM o_vals) WHERE rn = 2),
o_first AS (SELECT k, min(pos * 10 + rank) AS code FROM (
    SELECT k, pos, rank FROM o_ev WHERE rank IS NOT NULL UNION ALL SELECT k, pos, rank FROM o_aev) GROUP BY k),
o_sum AS (SELECT k, max(n_ids) AS n_ids, bool_or(pos = n_ids - 1 AND has_doi) AS last_has_doi,
    count(DISTINCT CASE WHEN has_doi THEN pfx END) AS n_pfx,
    coalesce(bool_or(has_doi AND wtype IN {_in(K.MINOR_WORK_TYPES)}), false) AS any_minor
  FROM o_pp2 GROUP BY k),
o_catw AS (
  SELECT m.omid, m.openalex_id, m.type, CASE
      WHEN f.code IS NOT NULL THEN (CASE f.code % 10 WHEN 0 THEN 'A' WHEN 1 THEN 'D' WHEN 2 THEN 'B' ELSE 'E' END)
      WHEN s.last_has_doi AND s.n_pfx = 1 AND s.any_minor THEN 'F'
      WHEN s.last_has_doi AND s.n_pfx = 1 AND s.n_ids = 2 THEN 'C'
      ELSE 'non classified' END AS category
  FROM o_mmw m JOIN o_sum s ON s.k = m.k LEFT JOIN o_first f ON f.k = m.k),
o_mms AS (SELECT * FROM o_mm WHERE starts_with(openalex_id, 'S')),
o_spos AS (SELECT k, unnest(ids) AS oaid, generate_subscripts(ids, 1) - 1 AS pos FROM o_mms),
o_siss AS (SELECT DISTINCT k, pos, v FROM (
    SELECT p.k, p.pos, unnest([s.issn1, s.issn2]) AS v FROM o_spos p
    JOIN fx_sources s ON s.id = {_q(K.OPENALEX_URI)} || p.oaid) WHERE v IS NOT NULL AND v <> ''),
o_shared AS (SELECT DISTINCT k FROM (SELECT k, v FROM o_siss GROUP BY k, v HAVING count(*) >= 2)),
o_cats AS (SELECT m.omid, m.openalex_id, m.type,
    CASE WHEN s.k IS NOT NULL THEN 'A' ELSE 'non classified' END AS category
  FROM o_mms m LEFT JOIN o_shared s ON s.k = m.k),
o_ccount AS (
  SELECT entity, type, category, count(*)::BIGINT AS n FROM (
    SELECT 'works' AS entity, type, category FROM o_catw UNION ALL SELECT 'sources', type, category FROM o_cats)
  GROUP BY entity, type, category)"""

_TYPE_CASE = "CASE b.type_uri " + " ".join(
    f"WHEN {_q(u)} THEN {_q(lbl)}" for u, lbl in K.URI_TYPE_LABELS.items() if lbl) + " ELSE b.type_uri END"

PROVENANCE = MAPPING + f""",
o_prov AS (SELECT br_uri, list_sort(list_distinct(list(source_uri))) AS srcs FROM fx_prov
           WHERE source_uri IS NOT NULL GROUP BY br_uri),
o_omids AS (SELECT DISTINCT omid FROM o_ents),
o_brn AS (SELECT replace(b.br_uri, {_q(K.META_URI)}, 'omid:') AS lookup,
    'omid:' || {_strip('b.br_uri', K.META_URI)} AS omid,
    CASE WHEN b.type_uri = {_q(K.FABIO_EXPRESSION)} OR b.type_uri IS NULL THEN '' ELSE {_TYPE_CASE} END AS type,
    b.has_identifier = 0 AS omid_only
  FROM fx_br b),
o_extra AS (SELECT omid, type, omid_only FROM o_brn n WHERE NOT EXISTS (SELECT 1 FROM o_omids o WHERE o.omid = n.lookup)),
o_rec AS (SELECT omid, type, omid_only FROM o_extra
          UNION ALL SELECT omid, type, CAST(NULL AS BOOLEAN) FROM o_map WHERE outcome = 'unmapped'),
o_recp AS (SELECT r.*, array_to_string(p.srcs, ' ') AS source FROM o_rec r
           JOIN o_prov p ON p.br_uri = replace(r.omid, 'omid:', {_q(K.META_URI)})),
o_pc AS (SELECT type, source,
    count(*) FILTER (WHERE coalesce(omid_only, false))::BIGINT AS omid_only,
    count(*) FILTER (WHERE NOT coalesce(omid_only, false))::BIGINT AS other_pids
  FROM o_recp GROUP BY type, source)"""

MMSTATS = MM + """,
o_mml AS (SELECT *, string_split(openalex_id, ' ') AS l FROM o_mm),
o_comp AS (SELECT omid, openalex_id, type,
    (CASE WHEN len(l) > 1 THEN len(l) ELSE 0 END)::BIGINT AS oaid_count,
    CASE WHEN list_bool_and(list_transform(l, lambda x: starts_with(x, 'W'))) THEN 'works'
         WHEN list_bool_and(list_transform(l, lambda x: starts_with(x, 'S'))) THEN 'sources'
         WHEN list_bool_or(list_transform(l, lambda x: starts_with(x, 'W') OR starts_with(x, 'S'))) THEN 'both'
         ELSE '' END AS composition
  FROM o_mml)"""


def _flat_null(*cols: tuple[str, str]) -> str:
    return ", ".join(f"CAST(NULL AS {t}) AS {c}" for c, t in cols)


def _work_uri(key: str) -> str:
    return f"{_q(K.OPENALEX_URI + 'W')} || CAST({key} AS VARCHAR)"


_LOCATIONS = """ SELECT work_id, source_id, landing_page_url, CAST(NULL AS VARCHAR) AS pdf_url, is_oa, version,
  CAST(NULL AS VARCHAR) AS license FROM fx_locations WHERE source_id IS NOT NULL AND source_id <> ''"""

_PIVOT_TYPES = pivot_types()

SQL: dict[str, str] = {
    # ---------------------------------------------------------- extraction
    "meta_primary_entities": META + " SELECT omid, ids, type FROM o_ents",
    "meta_primary_entities_new_only": META + " SELECT omid, ids, type FROM o_ents WHERE NOT has_oa",
    "meta_venues": META + " SELECT omid, ids FROM o_ven",
    "meta_responsible_agents": RESPONSIBLE + " SELECT omid, ids, ra_role FROM o_ra",
    "meta_reduced_tables": META + RESPONSIBLE + """
SELECT 'primary_ents' AS table_name, omid, ids, type AS kind FROM o_ents
UNION ALL SELECT 'venues', omid, ids, NULL FROM o_ven
UNION ALL SELECT 'resp_ags', omid, ids, ra_role FROM o_ra""",
    "meta_unparsable_agents": f""",
o_raw AS (
  SELECT 'author' AS ra_role, unnest(string_split(author, '; ')) AS e FROM fx_meta WHERE author IS NOT NULL AND author <> ''
  UNION ALL SELECT 'publisher', publisher FROM fx_meta WHERE publisher IS NOT NULL AND publisher <> ''
  UNION ALL SELECT 'editor', unnest(string_split(editor, '; ')) FROM fx_meta WHERE editor IS NOT NULL AND editor <> '')
SELECT ra_role, trim(e) AS entity FROM o_raw WHERE {_bracket('e')} IS NULL""",
    # ---------------------------------------------------------- PIDs
    "pids_works": INDEX + " SELECT supported_id, openalex_id FROM o_wp",
    "pids_sources": INDEX + " SELECT supported_id, openalex_id FROM o_sp",
    "pids_authors": f" SELECT 'orcid:' || {_strip('orcid', K.ORCID_URI)} AS supported_id, {OA_ID} AS openalex_id "
                    "FROM fx_agents WHERE orcid IS NOT NULL",
    "pid_index_by_scheme": INDEX + """ SELECT table_name, scheme, sum(n)::BIGINT AS n_rows, count(*)::BIGINT AS n_ids,
  count(*) FILTER (WHERE n > 1)::BIGINT AS n_shared_ids
FROM (SELECT table_name, split_part(supported_id, ':', 1) AS scheme, supported_id, count(*) AS n FROM o_idx
      GROUP BY table_name, scheme, supported_id) GROUP BY table_name, scheme""",
    # ---------------------------------------------------------- mapping
    "map_all": MAPPING + " SELECT omid, type, openalex_id, n_openalex, outcome FROM o_map",
    "map_new_only": MAPPING + " SELECT omid, type, openalex_id, n_openalex, outcome FROM o_map WHERE NOT has_oa",
    "map_one_to_one": MAPPING + " SELECT omid, openalex_id, type FROM o_map WHERE outcome = 'mapped'",
    "map_multi": MAPPING + " SELECT omid, openalex_id, type FROM o_map WHERE outcome = 'multi_mapped'",
    "map_unmapped": MAPPING + " SELECT omid, type FROM o_map WHERE outcome = 'unmapped'",
    "outcome_counts": MAPPING + " SELECT outcome, count(*)::BIGINT AS n FROM o_map GROUP BY outcome",
    "map_venues_untyped": META + INDEX + ",\no_venk AS (SELECT omid || '|' || ids AS vk, omid, ids FROM o_ven)"
    + _map_block("o_vmap", "o_venk", "vk", "omid")
    + " SELECT omid, openalex_id, n_openalex, outcome FROM o_vmap",
    # ---------------------------------------------------------- multi-mapped ids, flattening
    "mm_ids_distinct": MM + """ SELECT DISTINCT u AS openalex_id,
  CASE WHEN starts_with(u, 'W') THEN 'works' ELSE 'sources' END AS entity
FROM (SELECT unnest(ids) AS u FROM o_mm) WHERE starts_with(u, 'W') OR starts_with(u, 'S')""",
    "full_metadata_semi_join": MM + f""" SELECT id, doi, type FROM fx_works
WHERE {OA_ID} IN (SELECT u FROM (SELECT unnest(ids) AS u FROM o_mm) WHERE starts_with(u, 'W'))""",
    "flat_sources_keep_first": """ SELECT id, CASE WHEN regexp_matches(id, '[369]$') THEN 'other-' || issn_l ELSE issn_l END AS issn_l,
  to_json(list_filter([issn1, issn2], lambda x: x IS NOT NULL)) AS issn FROM fx_sources""",
    "flat_sources": f""" SELECT id, issn_l,
  to_json(list_filter([issn1, issn2], lambda x: x IS NOT NULL)) AS issn,
  {_flat_null(('display_name', 'VARCHAR'), ('publisher', 'VARCHAR'), ('works_count', 'BIGINT'),
              ('cited_by_count', 'BIGINT'), ('is_oa', 'BOOLEAN'), ('is_in_doaj', 'BOOLEAN'),
              ('homepage_url', 'VARCHAR'), ('works_api_url', 'VARCHAR'), ('updated_date', 'VARCHAR'),
              ('type', 'VARCHAR'))}
FROM fx_sources""",
    "flat_sources_ids": f""" SELECT id AS source_id, id AS openalex, issn_l,
  to_json(list_filter([issn1, issn2], lambda x: x IS NOT NULL)) AS issn, CAST(NULL AS VARCHAR) AS mag,
  wikidata, CAST(NULL AS VARCHAR) AS fatcat FROM fx_sources""",
    "flat_sources_counts": """ SELECT source_id, CAST(year AS INTEGER) AS year, CAST(works_count AS BIGINT) AS works_count,
  CAST(NULL AS BIGINT) AS cited_by_count, CAST(oa_works_count AS BIGINT) AS oa_works_count FROM fx_counts_by_year""",
    "flat_works": f""" SELECT id, doi, {_flat_null(('title', 'VARCHAR'), ('display_name', 'VARCHAR'),
  ('publication_year', 'INTEGER'), ('publication_date', 'VARCHAR'))}, type,
  {_flat_null(('cited_by_count', 'BIGINT'), ('is_retracted', 'BOOLEAN'), ('is_paratext', 'BOOLEAN'),
              ('cited_by_api_url', 'VARCHAR'), ('abstract_inverted_index', 'VARCHAR'), ('language', 'VARCHAR'))}
FROM fx_works""",
    "flat_primary_locations": _LOCATIONS,
    "flat_locations": _LOCATIONS,
    "flat_best_oa_locations": _LOCATIONS,
    "flat_works_ids": " SELECT id AS work_id, id AS openalex, doi, CAST(NULL AS VARCHAR) AS mag, pmid, pmcid FROM fx_works",
    "flat_authorships": """ SELECT work_id, author_position, author_id, institution_id,
  CAST(NULL AS VARCHAR) AS raw_affiliation_string FROM fx_authorships
WHERE author_id IS NOT NULL AND author_id <> '' AND institution_id <> ''
UNION ALL SELECT work_id, author_position, author_id, NULL, NULL FROM fx_authorships
WHERE author_id IS NOT NULL AND author_id <> ''
GROUP BY work_id, author_position, author_id HAVING count(nullif(institution_id, '')) = 0""",
    "flat_biblio": f""" SELECT {_work_uri('o_orderkey')} AS work_id,
  CAST(o_orderkey % 50 AS VARCHAR) AS volume, CAST(o_orderkey % 12 AS VARCHAR) AS issue,
  CAST(o_orderkey % 97 + 1 AS VARCHAR) AS first_page, CAST(o_orderkey % 97 + 12 AS VARCHAR) AS last_page
FROM orders WHERE o_orderkey % 11 <> 0""",
    "flat_concepts": f""" SELECT {_work_uri('l_orderkey')} AS work_id,
  {_q(K.OPENALEX_URI + 'C')} || CAST(l_partkey AS VARCHAR) AS concept_id, CAST(l_discount AS DOUBLE) AS score
FROM lineitem WHERE l_partkey % 10 <> 0""",
    "flat_mesh": f""" SELECT {_work_uri('l_orderkey')} AS work_id,
  'D' || CAST(l_partkey AS VARCHAR) AS descriptor_ui, 'Descriptor ' || CAST(l_partkey AS VARCHAR) AS descriptor_name,
  'Q' || CAST(l_suppkey AS VARCHAR) AS qualifier_ui, CAST(NULL AS VARCHAR) AS qualifier_name,
  l_linenumber = 1 AS is_major_topic FROM lineitem""",
    "flat_open_access": f""" SELECT {_work_uri('o_orderkey')} AS work_id, o_orderstatus = 'F' AS is_oa,
  CASE WHEN o_orderstatus = 'F' THEN 'gold' WHEN o_orderstatus = 'O' THEN 'closed' ELSE 'hybrid' END AS oa_status,
  CAST(NULL AS VARCHAR) AS oa_url, o_orderstatus = 'P' AS any_repository_has_fulltext FROM orders""",
    "flat_referenced": """ SELECT work_id, referenced_work_id FROM fx_refs
WHERE referenced_work_id IS NOT NULL AND referenced_work_id <> ''""",
    "flat_related": """ SELECT work_id, referenced_work_id AS related_work_id FROM fx_refs
WHERE referenced_work_id IS NOT NULL AND referenced_work_id <> ''""",
    "upsert_keep_last": """ SELECT work_id, author_position, author_id, institution_id FROM (
  SELECT *, row_number() OVER (PARTITION BY work_id, author_position ORDER BY ord1 DESC, ord2 DESC, ord3 DESC) AS rn
  FROM fx_authorships) WHERE rn = 1""",
    # ---------------------------------------------------------- categories
    "mm_categories_works": CATEGORIES + " SELECT omid, openalex_id, type, category FROM o_catw",
    "mm_categories_keep_last": CATEGORIES + " SELECT omid, openalex_id, type, category FROM o_catw",
    "mm_categories_sources": CATEGORIES + " SELECT omid, openalex_id, type, category FROM o_cats",
    "mm_category_counts": CATEGORIES + " SELECT entity, type, category, n FROM o_ccount",
    "mm_category_pivot": CATEGORIES + " SELECT entity, type, " + ", ".join(
        f"coalesce(sum(n) FILTER (WHERE category = {_q(c)}), 0)::BIGINT AS {c.replace(' ', '_')}"
        for c in K.WORK_CATEGORIES) + " FROM o_ccount GROUP BY entity, type",
    # ---------------------------------------------------------- provenance
    "prov_sources_per_br": PROVENANCE + " SELECT br_uri, array_to_string(srcs, ' ') AS sources, "
                                        "len(srcs)::BIGINT AS n_sources FROM o_prov",
    "prov_dropped_graphs": " SELECT br_uri || '/prov/' AS graph_id FROM fx_prov WHERE source_uri IS NULL",
    "prov_extra_brs": PROVENANCE + " SELECT omid, type, omid_only FROM o_extra",
    "prov_missing": PROVENANCE + f""" SELECT omid, type FROM o_rec r
WHERE NOT EXISTS (SELECT 1 FROM o_prov p WHERE p.br_uri = replace(r.omid, 'omid:', {_q(K.META_URI)}))""",
    "prov_counts": PROVENANCE + """ SELECT type, source, omid_only, other_pids, (omid_only + other_pids)::BIGINT AS total,
  sum(omid_only + other_pids) OVER (PARTITION BY type)::BIGINT AS type_total FROM o_pc""",
    "prov_by_type": PROVENANCE + """ SELECT CASE WHEN type = '' THEN 'Unspecified' ELSE type END AS type,
  sum(omid_only)::BIGINT AS omid_only_sum, sum(other_pids)::BIGINT AS other_pids_sum,
  sum(omid_only + other_pids)::BIGINT AS n_records FROM o_pc GROUP BY 1""",
    "prov_pivot": PROVENANCE + f""",
o_pv AS (SELECT CASE WHEN coalesce(type, '') = '' THEN 'Unspecified' WHEN type IN {_in(_PIVOT_TYPES)} THEN type
                ELSE 'other' END AS type, source, omid_only + other_pids AS n FROM o_pc)
SELECT source, """ + ", ".join(f"""coalesce(sum(n) FILTER (WHERE type = {_q(t)}), 0)::BIGINT AS "{t}\""""
                                for t in (*_PIVOT_TYPES, "other")) + " FROM o_pv GROUP BY source",
    "prov_contribution": PROVENANCE + """ SELECT type, single_source, sum(n)::BIGINT AS total FROM (
  SELECT type, unnest(string_split(source, ' ')) AS single_source, omid_only + other_pids AS n FROM o_pc)
GROUP BY type, single_source""",
    # ---------------------------------------------------------- sources and sinks
    "io_csv_tables": """ SELECT id, venue, author, publisher, editor, type FROM fx_meta
UNION ALL SELECT id, venue, author, publisher, editor, type FROM fx_meta
UNION ALL SELECT id, venue, author, publisher, NULL, type FROM fx_meta""",
    "io_json_lines": " SELECT id, type, doi, version FROM fx_works",
    "io_openalex_dump": """,
o_ok AS (SELECT issn_l FROM fx_sources WHERE NOT ends_with(id, '7'))
SELECT 'records' AS kind, count(*)::BIGINT AS n, count(DISTINCT issn_l)::BIGINT AS n_issn_l FROM o_ok
UNION ALL SELECT 'copied', count(*)::BIGINT, count(DISTINCT issn_l)::BIGINT FROM o_ok
UNION ALL SELECT 'malformed', count(*)::BIGINT, 0::BIGINT FROM fx_sources WHERE ends_with(id, '7')""",
    "io_counts_document": """ SELECT 'works' AS entity, type, version AS category, count(*)::BIGINT AS n FROM fx_works
GROUP BY type, version""",
    "io_append_upsert": " SELECT id, CASE WHEN version = 'submittedVersion' THEN 'second' ELSE type END AS type FROM fx_works",
    "io_partial_upsert": " SELECT id, CASE WHEN version = 'submittedVersion' THEN 'second' ELSE type END AS type FROM fx_works",
    "io_single_csv": MM + " SELECT omid, openalex_id, type, 1::BIGINT AS n_files FROM o_mm",
    "io_inverted_pairs": INVERTED,
    "io_matching_records": MM + f""",
o_lines AS (SELECT count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE ends_with(id, '7'))::BIGINT AS n_malformed FROM fx_works)
SELECT id, doi, type, n_lines, n_malformed FROM fx_works, o_lines
WHERE NOT ends_with(id, '7') AND {OA_ID} IN (SELECT u FROM (SELECT unnest(ids) AS u FROM o_mm) WHERE starts_with(u, 'W'))""",
    "pid_index_lookup": META + INDEX + f""" SELECT table_name, supported_id, openalex_id FROM o_idx
WHERE supported_id IN (SELECT p FROM (SELECT unnest({_lookup('t2')}) AS p FROM (SELECT {_tokens('ids')} AS t2 FROM o_ents)) WHERE starts_with(p, 'issn:'))""",
    "io_zipped_meta": " SELECT id, venue, author, publisher, editor, type FROM fx_meta",
    "io_create_once": " SELECT id, type, true AS refused FROM fx_works",
    # ---------------------------------------------------------- statistics
    "mm_composition": MMSTATS + """ SELECT omid, openalex_id,
  CASE WHEN type IS NULL OR type = '' THEN 'Unspecified' ELSE type END AS type, oaid_count, composition
FROM o_comp WHERE composition <> ''""",
    "mm_filter": MMSTATS + """ SELECT * FROM (SELECT omid, openalex_id,
  CASE WHEN type IS NULL OR type = '' THEN 'Unspecified' ELSE type END AS type, oaid_count, composition
FROM o_comp WHERE composition <> '') WHERE type = 'journal article' AND composition = 'works' AND oaid_count = 2""",
    "mm_distribution": MMSTATS + """ SELECT type, composition, n_oaids, count(*)::BIGINT AS n FROM (
  SELECT type, len(l)::BIGINT AS n_oaids,
    CASE WHEN list_bool_and(list_transform(l, lambda x: starts_with(x, 'W')))
              AND NOT list_bool_and(list_transform(l, lambda x: starts_with(x, 'S'))) THEN 'works'
         WHEN list_bool_and(list_transform(l, lambda x: starts_with(x, 'S')))
              AND NOT list_bool_and(list_transform(l, lambda x: starts_with(x, 'W'))) THEN 'sources'
         ELSE 'both' END AS composition FROM o_mml)
GROUP BY GROUPING SETS ((type, composition, n_oaids), (type, composition), (type))""",
    "mm_type_stats": MM + f""" SELECT type, round(avg(n), 2) AS avg_oaids, min(n)::BIGINT AS min_oaids,
  max(n)::BIGINT AS max_oaids, count(*)::BIGINT AS n_records
FROM (SELECT type, len({_tokens('openalex_id')}) AS n FROM o_mm) GROUP BY type""",
    "mm_histogram": MMSTATS + """ SELECT oaid_count, type, composition, count(*)::BIGINT AS frequency,
  (sum(count(*)) OVER (PARTITION BY type))::BIGINT AS type_total
FROM (SELECT oaid_count, composition, CASE WHEN type IS NULL OR type = '' THEN 'unspecified' ELSE type END AS type
      FROM o_comp WHERE composition <> '') GROUP BY oaid_count, type, composition""",
    "mm_api_urls": MM + f""" SELECT {_q(K.META_API)} || omid AS omid,
  array_to_string(list_transform(regexp_split_to_array(trim(openalex_id), '\\s+'),
                                 lambda x: {_q(K.OPENALEX_API)} || x), ' ') AS openalex_id, type FROM o_mm""",
    "inverted_multi_mapped": INVERTED,
    "venue_row_overlap": META + f""",
o_vo AS (SELECT DISTINCT u AS omid FROM (
  SELECT unnest(list_filter({_tokens('inner_')}, lambda x: starts_with(x, 'omid:'))) AS u
  FROM o_vinner WHERE inner_ IS NOT NULL))
SELECT count(*)::BIGINT AS venues_in_venue_field, count(e.omid)::BIGINT AS venues_as_rows,
  (count(*) - count(e.omid))::BIGINT AS difference
FROM o_vo v LEFT JOIN (SELECT DISTINCT omid FROM o_ents) e ON e.omid = v.omid""",
    "coverage_meta": f""",
o_cm AS (SELECT {_tokens('id')} AS t FROM fx_meta),
o_cm2 AS (SELECT count(*)::BIGINT AS n_rows,
    count(*) FILTER (WHERE len(t) > 1)::BIGINT AS n_with_external_pids,
    count(*) FILTER (WHERE len(t) > 1 AND list_bool_or(list_transform(t,
        lambda x: split_part(x, ':', 1) IN {_in(K.MUTUALLY_SUPPORTED)})))::BIGINT AS n_with_supported_pids
  FROM o_cm)
SELECT n_rows, n_with_external_pids, n_with_supported_pids, n_rows - n_with_supported_pids AS n_non_mappable,
  round(CAST(n_with_supported_pids AS DOUBLE) * 100 / n_rows, 2) AS pct_mappable FROM o_cm2""",
    "coverage_openalex": """,
o_cw AS (
  SELECT 'works' AS entity, count(*) AS n_records,
    count(*) FILTER (WHERE doi IS NOT NULL OR pmid IS NOT NULL OR pmcid IS NOT NULL) AS n_with_pid
  FROM fx_works WHERE id IS NOT NULL
  UNION ALL
  SELECT 'sources', count(*), count(*) FILTER (WHERE issn1 IS NOT NULL OR issn2 IS NOT NULL OR issn_l IS NOT NULL
    OR starts_with(wikidata, 'http:') OR starts_with(wikidata, 'https:'))
  FROM fx_sources WHERE id IS NOT NULL),
o_cw2 AS (SELECT entity, n_records, n_with_pid FROM o_cw
          UNION ALL SELECT 'total', sum(n_records), sum(n_with_pid) FROM o_cw)
SELECT entity, CAST(n_records AS BIGINT) AS n_records, CAST(n_with_pid AS BIGINT) AS n_with_pid,
  round(CAST(n_with_pid AS DOUBLE) * 100 / n_records, 2) AS pct_with_pid FROM o_cw2""",
}

_RW = f"""CASE WHEN starts_with(wikidata, 'http:') THEN 'wikidata:' || {_strip('wikidata', K.WIKIDATA_HTTP_URI)}
  WHEN starts_with(wikidata, 'https:') THEN 'wikidata:' || {_strip('wikidata', K.WIKIDATA_HTTPS_URI)} END"""
_ROR_WIKIDATA = f""" SELECT supported_id, openalex_id FROM (
  SELECT 'ror:' || {_strip('ror', K.ROR_URI)} AS supported_id, {OA_ID} AS openalex_id FROM fx_agents WHERE ror IS NOT NULL
  UNION ALL SELECT {_RW}, {OA_ID} FROM fx_agents WHERE starts_with(wikidata, 'http:') OR starts_with(wikidata, 'https:'))"""
SQL["io_zipped_graphs"] = SQL["prov_sources_per_br"]
SQL["io_zipped_nodes"] = SQL["prov_extra_brs"]
for _k in ("pids_institutions", "pids_publishers", "pids_funders"):
    SQL[_k] = _ROR_WIKIDATA


def oracle_sql() -> dict[str, str]:
    """Full SQL text per query key."""
    return {k: with_fixtures(v) for k, v in SQL.items()}
