"""Registered queries of this package, and the SQL that they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stratiform.llm.bpe_tree import op9_bpe_tree
from stratiform.llm.decontamination import op2_decontamination
from stratiform.llm.html_extraction import op5_html_extraction
from stratiform.llm.language_id import op1_language_id
from stratiform.llm.license_scan import op7_license_scan, oracle_sql
from stratiform.llm.lm_scoring import op6_lm_scoring
from stratiform.llm.ngram_join import op4_ngram_join
from stratiform.llm.periodic_runs import op12_periodic_runs
from stratiform.llm.quality_rules import op3_quality_rules
from stratiform.llm.ranked_search import op11_ranked_search
from stratiform.llm.ranked_search import oracle_sql as ranked_sql
from stratiform.llm.suffix_dedup import op13_suffix_dedup
from stratiform.llm.token_files import op8_token_files
from stratiform.llm.warc import op10_warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_decontamination": op2_decontamination,
    "op3_quality_rules": op3_quality_rules,
    "op4_ngram_join": op4_ngram_join,
    "op5_html_extraction": op5_html_extraction,
    "op6_lm_scoring": op6_lm_scoring,
    "op7_license_scan": op7_license_scan,
    "op8_token_files": op8_token_files,
    "op9_bpe_tree": op9_bpe_tree,
    "op10_warc": op10_warc,
    "op11_ranked_search": op11_ranked_search,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_suffix_dedup": op13_suffix_dedup,
}

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL: dict[str, str] = {
    "op4_ngram_join": f"""
        WITH RECURSIVE words AS (
            SELECT doc_id, list_filter(string_split_regex({_LOWER}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents
        ),
        sets AS (
            SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [w]
                ELSE [w[i:i + 4] FOR i IN range(1, len(w) - 3)] END) AS s
            FROM words
        ),
        tokens AS (SELECT doc_id, unnest(s) AS token FROM sets),
        shared_tokens AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
            FROM tokens a JOIN tokens b ON a.token = b.token AND a.doc_id <> b.doc_id GROUP BY ALL
        ),
        links AS (
            SELECT a, b FROM shared_tokens JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b
            WHERE 100 * n >= 75 * (len(x.s) + len(y.s) - n)
        ),
        reached(doc_id, other) AS (
            SELECT a, b FROM links UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other
        )
        SELECT sets.doc_id, len(s) AS n_shingles, least(sets.doc_id, min(other)) AS component_id
        FROM sets LEFT JOIN reached ON reached.doc_id = sets.doc_id GROUP BY sets.doc_id, s
    """,
    "op10_warc": """
        WITH payloads AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
        ),
        firsts AS (
            SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS response FROM payloads
        )
        SELECT page_id, payload_bytes, payload_digest,
            CASE WHEN payload_bytes >= 1000 AND page_id <> response THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN payload_bytes >= 1000 AND page_id <> response THEN response END AS refers_to
        FROM firsts
    """,
    "op7_license_scan": oracle_sql(),
    "op11_ranked_search": ranked_sql(),
}
