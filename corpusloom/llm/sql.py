"""SQL of the queries of this subpackage that SQL can express."""

from __future__ import annotations


def oracle_sql() -> dict[str, str]:
    p1 = """
        WITH m AS (SELECT doc_id, regexp_replace(lower(trim(domain)), '^www\\.', '') AS domain FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY enriched_at DESC NULLS LAST, domain DESC NULLS LAST) AS i FROM enriched_meta) WHERE i = 1),
        d AS (SELECT * FROM (SELECT doc_id, text, row_number() OVER (PARTITION BY doc_id ORDER BY fetched_at DESC NULLS LAST) AS i FROM extracted_docs WHERE doc_id IS NOT NULL) WHERE i = 1),
        l AS (SELECT d.doc_id, m.domain, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS line_no FROM d JOIN m USING (doc_id) WHERE m.domain <> ''),
        k AS (SELECT *, regexp_replace(lower(line), '\\P{L}+', '', 'g') AS key FROM l),
        h AS (SELECT domain, key FROM k WHERE length(key) >= 6 GROUP BY ALL HAVING count(DISTINCT doc_id) >= 6)
        SELECT doc_id, line_no FROM k JOIN h USING (domain, key)"""
    p3 = """
        WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY fetched_at DESC) AS i FROM wet_records WHERE text IS NOT NULL AND doc_id IN (SELECT doc_id FROM fuzzy_docs)) WHERE i = 1),
        g AS (SELECT doc_id, list_distinct([array_to_string(w[i:i + 2], ' ') for i in range(1, len(w) - 1)]) AS g FROM d WHERE len(w) >= 3),
        s AS (SELECT doc_id, len(g) AS n, unnest(g) AS x FROM g)
        SELECT a.doc_id AS doc_id_a, b.doc_id AS doc_id_b FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2, a.n, b.n HAVING count(*) / (a.n + b.n - count(*))::DOUBLE >= 0.6"""
    groups = f"""
        WITH RECURSIVE p AS ({p3}),
        d AS (SELECT doc_id, list_sort(list_distinct([array_to_string(w[i:i + 2], ' ') for i in range(1, len(w) - 1)])) AS g FROM (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS w, row_number() OVER (PARTITION BY doc_id ORDER BY fetched_at DESC) AS i FROM wet_records
          WHERE text IS NOT NULL AND doc_id IN (SELECT doc_id FROM fuzzy_docs)) WHERE i = 1 AND len(w) >= 3),
        l AS (SELECT doc_id_a AS a, doc_id_b AS b FROM p UNION ALL SELECT doc_id_b, doc_id_a FROM p),
        r AS (SELECT doc_id, doc_id AS to_ FROM d UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.to_),
        g AS (SELECT doc_id, min(to_) AS group_id FROM r GROUP BY 1)
        SELECT doc_id, min(doc_id) OVER (PARTITION BY d.g) AS class_id, group_id, count(*) OVER (PARTITION BY d.g) AS copies FROM d JOIN g USING (doc_id)"""
    p1_clean = """
        WITH m AS (SELECT doc_id, regexp_replace(lower(trim(domain)), '^www\\.', '') AS domain FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY enriched_at DESC NULLS LAST, domain DESC NULLS LAST) AS i FROM enriched_meta) WHERE i = 1),
        d AS (SELECT doc_id, text, fetched_at::DATE AS day FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY fetched_at DESC NULLS LAST) AS i FROM extracted_docs WHERE doc_id IS NOT NULL) WHERE i = 1),
        x AS (SELECT d.*, m.domain, min(day) OVER (PARTITION BY m.domain, text) AS first FROM d JOIN m USING (doc_id) WHERE m.domain <> '' AND text IS NOT NULL),
        l AS (SELECT *, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS n FROM x), k AS (SELECT *, regexp_replace(lower(line), '\\P{L}+', '', 'g') AS key FROM l),
        h AS (SELECT domain, key FROM k WHERE length(key) >= 6 GROUP BY ALL HAVING count(DISTINCT doc_id) >= 6 AND count(DISTINCT text) >= 6 AND count(DISTINCT first) >= 2),
        g AS (SELECT doc_id, count(*) AS removed FROM k JOIN h USING (domain, key) GROUP BY 1), r AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY n) AS t FROM k ANTI JOIN h USING (domain, key) GROUP BY 1)
        SELECT d.doc_id, CASE WHEN g.removed IS NULL THEN d.text ELSE coalesce(r.t, '') END AS text, coalesce(g.removed, 0) AS removed_lines FROM d LEFT JOIN g USING (doc_id) LEFT JOIN r USING (doc_id)"""
    p6 = """
        WITH d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY fetched_at DESC NULLS LAST) AS i FROM extracted_docs WHERE doc_id IS NOT NULL) WHERE i = 1),
        m AS (SELECT doc_id, token_count, nullif(regexp_replace(lower(trim(domain)), '^www\\.', ''), '') AS domain FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY enriched_at DESC NULLS LAST, token_count DESC NULLS LAST, domain DESC NULLS LAST) AS i FROM enriched_meta) WHERE i = 1),
        n AS (SELECT lower(trim(lang)) AS low, * FROM d),
        x AS (SELECT coalesce(nullif(lower(regexp_replace(source, '^\\s+|\\s+$', '', 'g')), ''), '(none)') AS source,
          coalesce(CASE WHEN low IN ('', 'und', 'unknown') THEN NULL WHEN low IN ('rw', 'kin', 'kin_latn') THEN 'kin_Latn' WHEN low IN ('en', 'eng', 'eng_latn') THEN 'eng_Latn' WHEN low IN ('fr', 'fra', 'fra_latn') THEN 'fra_Latn'
            WHEN low IN ('sw', 'swh', 'swh_latn') THEN 'swh_Latn' WHEN low IN ('rn', 'run', 'run_latn') THEN 'run_Latn' WHEN low = 'zxx_latn' THEN 'zxx_Latn' ELSE low END, '(none)') AS lang,
          coalesce(m.domain, '(none)') AS domain, m.token_count AS claim, coalesce(length(text), 0) > 0 AS filled FROM n LEFT JOIN m USING (doc_id))
        SELECT CASE grouping(source, lang, domain) WHEN 7 THEN 'all' WHEN 3 THEN 'source' WHEN 5 THEN 'lang' WHEN 6 THEN 'domain' ELSE 'source+lang+domain' END AS slice, source, lang, domain, count(*) AS docs, sum(claim)::BIGINT AS meta_tokens, bool_or(filled) AS counted
        FROM x GROUP BY GROUPING SETS ((), (source), (lang), (domain), (source, lang, domain))"""
    p7 = """
        SELECT profile, (SELECT count(*) FROM documents WHERE length(text) > 0) AS placed, 0 AS missing, 0 AS lost_tokens, 0 AS split_though_fitting, 0 AS overfull, 0 AS misreported, true AS few_containers FROM pack_profiles WHERE capacity_tokens > 0 AND profile IS NOT NULL"""
    p8 = """
        SELECT t.source, t.max_repeats, count(d.doc_id) AS docs_available, false AS too_often, false AS off FROM (SELECT lower(trim(source)) AS source, max_repeats FROM mix_targets WHERE source IS NOT NULL) t
        LEFT JOIN (SELECT doc_id, lower(regexp_replace(source, '^\\s+|\\s+$', '', 'g')) AS source FROM documents) d ON d.source = t.source GROUP BY ALL"""
    return {"p1_found": p1, "p1_clean": p1_clean, "p3_found": p3, "p3_groups": groups, "p6_claims": p6, "p7_checks": p7, "p8_checks": p8}
