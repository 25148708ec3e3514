"""Registered queries of the training-data operators, and their DuckDB SQL where it exists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pidlink.llm import (bpe_trie, exact_dedup, language_id, mixing, near_dedup, periodic_runs, pii, quality_model, quality_rules, secrets,
                         source_divergence, substring_dedup, token_counts)
from pidlink.llm.common import documents, labels

VOCABULARY = "byte_bpe_50k.json"


def vocabulary(name: str = VOCABULARY) -> str:
    """Path of a vocabulary file of the installed package of public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_byte_birnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.languages(documents(spark, sf_dir))


def op2_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.quality_rows(documents(spark, sf_dir), labels(spark, sf_dir))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir), vocabulary())


def op4_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_components(documents(spark, sf_dir))


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_sizes(documents(spark, sf_dir))


def op6_repeated_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = substring_dedup.without_repeats(documents(spark, sf_dir))
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + (r["end"] - r["start"]).cast("long"))
    return rows.select("doc_id", "n_words", removed.alias("n_removed"),
                       F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


def op7_bpe_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bpe_trie.encoded(documents(spark, sf_dir), vocabulary(), packed=True, decoded=True)
    return rows.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


def _spans(column: str) -> Column:
    return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op8_deobfuscated_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts and the digest are of the base spans; n_added is what the method adds."""
    rows = pii.personal_data(documents(spark, sf_dir))
    counts = [F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}") for kind in pii.KINDS]
    return rows.select("doc_id", *counts, F.sha2(F.encode(_spans("base"), "UTF-8"), 256).alias("base_sha256"),
                       _spans("spans").alias("spans"), (F.size("spans") - F.size("base")).cast("long").alias("n_added"))


def op9_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(documents(spark, sf_dir), labels(spark, sf_dir))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.with_digest(documents(spark, sf_dir))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.divergence(documents(spark, sf_dir))


def op12_zstd_novelty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts and the digest are of the base spans; n_added is what the method adds."""
    rows = secrets.secret_spans(documents(spark, sf_dir))
    counts = [F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}") for kind in secrets.BASE]
    return rows.select("doc_id", *counts, F.sha2(F.encode(_spans("base"), "UTF-8"), 256).alias("base_sha256"),
                       _spans("spans").alias("spans"), (F.size("spans") - F.size("base")).cast("long").alias("n_added"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = periodic_runs.periodic_runs(periodic_runs.planted(documents(spark, sf_dir)))
    top = periodic_runs.longest_run(F.col("runs"))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    found = rows.select("doc_id", "collapsed", F.size("runs").cast("long").alias("n_runs"), top.alias("top"), lines.alias("lines"))
    return found.select("doc_id", "n_runs", "top.start", "top.length", "top.period",
                        F.expr("1000 * top.length div top.period").alias("exponent_milli"),
                        F.sha2(F.encode("lines", "UTF-8"), 256).alias("runs_sha256"),
                        F.sha2(F.encode("collapsed", "UTF-8"), 256).alias("collapsed_sha256"))


QUERIES = {
    "op1_byte_birnn": op1_byte_birnn,
    "op2_importance_resampling": op2_importance_resampling,
    "op3_token_counts": op3_token_counts,
    "op4_simhash_pivots": op4_simhash_pivots,
    "op5_source_mix": op5_source_mix,
    "op6_repeated_windows": op6_repeated_windows,
    "op7_bpe_trie": op7_bpe_trie,
    "op8_deobfuscated_pii": op8_deobfuscated_pii,
    "op9_decision_list": op9_decision_list,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_source_divergence": op11_source_divergence,
    "op12_zstd_novelty": op12_zstd_novelty,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE_SQL = {
    "op6_repeated_windows": r"""
        WITH w AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
        n AS (SELECT doc_id, words, len(words) AS n_words FROM w),
        win AS (
            SELECT doc_id, i, hash(list_slice(words, i, i + 49)) AS h, md5(array_to_string(list_slice(words, i, i + 49), ' ')) AS m
            FROM n, unnest(generate_series(1, n_words - 49)) AS t(i)),
        first AS (SELECT h, m, min(doc_id) AS first_id FROM win GROUP BY h, m),
        hit AS (SELECT win.doc_id, win.i FROM win JOIN first USING (h, m) WHERE win.doc_id > first.first_id),
        gone AS (
            SELECT doc_id, list(DISTINCT i + j) AS at FROM hit, unnest(generate_series(0, 49)) AS u(j) GROUP BY doc_id),
        kept AS (
            SELECT n.doc_id, n.n_words, coalesce(len(gone.at), 0) AS n_removed,
                   CASE WHEN gone.at IS NULL THEN words ELSE list_filter(words, lambda x, k: NOT list_contains(gone.at, k)) END AS rest
            FROM n LEFT JOIN gone USING (doc_id))
        SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(n_removed AS BIGINT) AS n_removed,
               sha256(array_to_string(rest, ' ')) AS kept_sha256
        FROM kept
    """,
    "op10_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
    """,
    "op5_source_mix": r"""
        WITH sized AS (
            SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
                   CAST('0x' || substr(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12) AS BIGINT) AS draw
            FROM documents),
        per AS (
            SELECT source, CAST(sum(size) AS DOUBLE) AS source_size, 3 * CAST(sum(size) AS DOUBLE) AS cap,
                   1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w
            FROM sized GROUP BY source),
        lev AS (
            SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0))
                      / (sum(w) OVER () - coalesce(sum(w) OVER b, 0)) AS level
            FROM per WINDOW b AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        tgt AS (SELECT *, least(cap, max(level) OVER () * w) AS target FROM lev),
        goals AS (
            SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM tgt),
        draws AS (
            SELECT source, draw, sum(size) AS words,
                   sum(sum(size)) OVER (PARTITION BY source ORDER BY draw) AS upto
            FROM sized GROUP BY source, draw)
        SELECT s.doc_id, s.size, CAST(g.source_size AS BIGINT) AS source_size, g.target,
               CAST(s.size * (g.whole + CASE WHEN 2 * d.upto - d.words <= 2 * (g.target - g.whole * g.source_size)
                                             THEN 1 ELSE 0 END) AS BIGINT) AS taken
        FROM sized s
        JOIN goals g ON s.source IS NOT DISTINCT FROM g.source
        JOIN draws d ON s.source IS NOT DISTINCT FROM d.source AND s.draw = d.draw
    """,
    "op11_source_divergence": r"""
        WITH d AS (
            SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS id,
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
            FROM documents),
        seen AS (
            SELECT lang, source, id, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
        kept AS (
            SELECT lang, term, count(*) AS n FROM seen GROUP BY lang, term HAVING count(DISTINCT id) >= 30),
        langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
        had AS (SELECT lang, source, term, count(*) AS n FROM seen JOIN kept USING (lang, term) GROUP BY lang, source, term),
        sums AS (SELECT lang, source, sum(n) AS total FROM had GROUP BY lang, source),
        groups AS (SELECT DISTINCT lang, source FROM d),
        p AS (
            SELECT g.lang, g.source, k.term, coalesce(h.n, 0) AS n,
                   1 + (CAST(1000000000 AS HUGEINT) * (coalesce(h.n, 0) + 5)) // (coalesce(s.total, 0) + 5 * l.v) AS p,
                   1 + (CAST(1000000000 AS HUGEINT) * (k.n + 5)) // (l.total + 5 * l.v) AS q
            FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang)
            LEFT JOIN sums s ON s.lang = g.lang AND s.source = g.source
            LEFT JOIN had h ON h.lang = g.lang AND h.source = g.source AND h.term = k.term),
        dist AS (
            SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
            FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
        pairs AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value
            FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN dist x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
        every AS (
            SELECT * FROM pairs
            UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM every)
        SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
        FROM ranked WHERE part = 'pair' OR rank <= 50
    """,
}
