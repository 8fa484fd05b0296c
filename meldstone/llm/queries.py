"""Queries of the corpus operators and, where SQL can express them, their SQL."""

from __future__ import annotations

import public_tokenizers

from meldstone.llm import (
    bpe,
    decontamination,
    fingerprints,
    language_id,
    near_dedup,
    pii,
    quality_classifier,
    quality_rules,
    sharding,
    spelling,
    substring_dedup,
    warc,
    whitening,
)
from meldstone.llm.common import table

RANK_FILE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def _op7(spark, sf_dir):
    tokenizer = bpe.Tokenizer(spark, RANK_FILE, public_tokenizers.PATTERN)
    return bpe.token_report(table(spark, sf_dir, "documents"), tokenizer)


QUERIES = {
    "op1_quality_rules": lambda spark, sf_dir: quality_rules.rules_report(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    ),
    "op2_substring_dedup": lambda spark, sf_dir: substring_dedup.repeat_report(table(spark, sf_dir, "documents")),
    "op3_language_id": lambda spark, sf_dir: language_id.language_report(table(spark, sf_dir, "documents")),
    "op4_quality_classifier": lambda spark, sf_dir: quality_classifier.quality_report(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    ),
    "op5_warc": lambda spark, sf_dir: warc.archive_report(table(spark, sf_dir, "pages")),
    "op6_decontamination": lambda spark, sf_dir: decontamination.contamination_report(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    ),
    "op7_bpe": _op7,
    "op8_near_dedup": lambda spark, sf_dir: near_dedup.near_duplicate_report(table(spark, sf_dir, "documents")),
    "op9_sharding": lambda spark, sf_dir: sharding.shard_report(table(spark, sf_dir, "documents")),
    "op10_pii": lambda spark, sf_dir: pii.pii_report(table(spark, sf_dir, "documents")),
    "op11_fingerprints": lambda spark, sf_dir: fingerprints.neighbour_report(table(spark, sf_dir, "documents")),
    "op12_whitening": lambda spark, sf_dir: whitening.whitening_report(table(spark, sf_dir, "embeddings")),
    "op13_spelling": lambda spark, sf_dir: spelling.spelling_report(table(spark, sf_dir, "documents")),
}

ORACLE = {
    "op5_warc": f"""WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d FROM pages),
g AS (SELECT n, d, max(page_id) AS newest FROM p WHERE n >= {warc.REVISIT_BYTES} GROUP BY n, d),
j AS (SELECT page_id, n, d, CASE WHEN newest IS NOT NULL AND page_id IS DISTINCT FROM newest THEN newest END AS refers_to
      FROM p LEFT JOIN g USING (n, d))
SELECT page_id, n AS payload_bytes, d AS payload_digest,
       CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to FROM j""",
    "op8_near_dedup": """WITH RECURSIVE
w AS (SELECT doc_id, list_filter(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'),
        lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN
        list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
        WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS shingle FROM w),
n AS (SELECT w.doc_id, count(shingle) AS n FROM w LEFT JOIN s ON w.doc_id = s.doc_id GROUP BY w.doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle
           WHERE a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT x, y FROM shared JOIN n p ON x = p.doc_id JOIN n q ON y = q.doc_id WHERE 100 * c >= 75 * (p.n + q.n - c)),
edges AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach(doc_id, seen) AS (SELECT x, y FROM edges UNION SELECT r.doc_id, e.y FROM reach r JOIN edges e ON r.seen = e.x),
least_ids AS (SELECT doc_id, min(seen) AS seen FROM reach GROUP BY doc_id)
SELECT n.doc_id, n.n AS n_shingles, least(n.doc_id, coalesce(seen, n.doc_id)) AS component_id,
       n.doc_id = least(n.doc_id, coalesce(seen, n.doc_id)) AS kept FROM n LEFT JOIN least_ids l ON n.doc_id = l.doc_id""",
}
