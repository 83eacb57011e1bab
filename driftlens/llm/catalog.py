"""The corpus operators' queries and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from . import decontamination, licenses, near_dups, packing, secret_scan, sharding, token_counts, topk, toxicity, url_rules

QUERIES = {
    "op1_token_counts": token_counts.op1_token_counts,
    "op2_best_fit_packing": packing.op2_best_fit_packing,
    "op3_exact_topk": topk.op3_exact_topk,
    "op4_url_filters": url_rules.op4_url_filters,
    "op5_secret_scans": secret_scan.op5_secret_scans,
    "op6_simhash_near_dedup": near_dups.op6_simhash_near_dedup,
    "op7_license_scans": licenses.op7_license_scans,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_benchmark_decontamination": decontamination.op9_benchmark_decontamination,
    "op10_sharding": sharding.op10_sharding,
}

ORACLE_SQL: dict[str, str] = {
    "op3_exact_topk": """
        WITH v AS MATERIALIZED (
            SELECT row_number() OVER () AS place, vec_id, list_transform(embedding, lambda x: floor(256::DOUBLE * x::DOUBLE)) AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.place, q.vec_id AS query_id, c.vec_id AS vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
            FROM v q JOIN v c ON q.place <> c.place WHERE q.vec_id % 50 = 0
        ), ranked AS (
            SELECT query_id, row_number() OVER (PARTITION BY place ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
    "op4_url_filters": r"""
        WITH cut AS (
            SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
        ), parts AS (
            SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM cut
        ), judged AS (
            SELECT *, CASE
                WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
                WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
                WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
                WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
                WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/'
            END AS rule FROM parts
        )
        SELECT page_id, host, path, rule,
               CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict
        FROM judged
    """,
}
