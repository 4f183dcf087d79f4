"""The same results as SQL for DuckDB, where SQL can express them."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

ORACLES["op3_exact_dedup"] = """
WITH normal AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
    FROM documents
)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(body) AS text_sha256
FROM normal WINDOW w AS (PARTITION BY body)
"""

ORACLES["op10_url_filters"] = r"""
WITH parts AS (
    SELECT page_id, coalesce(url, '') AS url, strpos(coalesce(url, ''), '://') AS mark FROM pages
), cut AS (
    SELECT page_id, CASE WHEN mark > 0 THEN substr(url, mark + 3) ELSE '' END AS rest FROM parts
), named AS (
    SELECT page_id,
           translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM cut
), rules(rule_host, rule_path, outcome) AS (
    VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
           ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), fits AS (
    SELECT page_id, host, path, rule_host || rule_path AS rule, outcome,
           row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC NULLS LAST) AS place
    FROM named LEFT JOIN rules
      ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
)
SELECT page_id, host, path, rule, coalesce(outcome, 'allow') AS verdict FROM fits WHERE place = 1
"""
