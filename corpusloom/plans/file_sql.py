"""The queries of :mod:`corpusloom.plans.file_queries` in SQL: what must come out, straight from the tables."""

from __future__ import annotations

from .sql import INDEX, NETLOC, SPLIT_SEED, decided, domain, host, path, strip


def _first(table: str, key: str, order: str, where: str = "true") -> str:
    return f"(SELECT * EXCLUDE (i) FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS i FROM {table} WHERE {where}) WHERE i = 1)"


def _hex(t: str, n: int = 4) -> str:
    return f"('0x' || substr(sha256({t}), 1, {n}))::BIGINT"


def oracle_sql() -> dict[str, str]:
    squeezed = lambda c: f"sha256(regexp_replace({c}, '\\s+', '', 'g'))"
    control = "[\\x{0}-\\x{8}\\x{b}\\x{c}\\x{e}-\\x{1f}]"
    lowered = "regexp_replace(lower(trim({d})), '^www\\.', '')"
    d = lowered.format(d="domain")
    lp = f"lower({path('url')})"
    query = "regexp_extract(url, '^[^?#]*\\?([^#]*)', 1)"
    kind = f"""CASE WHEN {lp} LIKE '%.pdf' THEN 'pdf' WHEN regexp_matches({lp}, '(?:\\.docx|\\.doc|\\.pptx)$') THEN 'document'
        WHEN contains({lp}, '/fileadmin/') AND NOT regexp_matches({lp}, '(?:\\.jpg|\\.jpeg|\\.png|\\.gif|\\.svg|\\.webp|\\.css|\\.js)$') THEN 'pdf' WHEN contains({lp}, '/news-details/') THEN 'news'
        WHEN regexp_matches(lower({query}), 'tx_news_pi1|tx_filelist_filelist') THEN 'listing' WHEN contains({lp}, '/amakuru') AND NOT contains(lower({query}), 'currentpage') THEN 'listing' ELSE 'static' END"""
    bucket = f"(('0x' || substr(sha256('{SPLIT_SEED}:' || {{k}}), 1, 8))::BIGINT % 10000)"
    label = f"({_hex('doc_id')} % 17 - 1)"
    labels = "['politics', 'sport', 'economy', 'health', 'entertainment', 'history', 'technology', 'tourism', 'culture', 'fashion', 'religion', 'environment', 'education', 'relationship']"
    prefix = """CASE source WHEN 'commoncrawl' THEN 'cc/v1/' WHEN 'targeted_web' THEN 'curated/v1/targeted_web/' WHEN 'wayback' THEN 'curated/v1/wayback/' WHEN 'cc_index' THEN 'curated/v1/cc_index/'
        WHEN 'books_corpus' THEN 'curated/v1/books/' WHEN 'parallel_web' THEN 'supervision/v1/parallel/' WHEN 'instructions_rw' THEN 'supervision/v1/instructions/' WHEN 'wikipedia' THEN 'wiki/v1/'
        WHEN 'mbazanlp_v01.1' THEN 'external/v1/mbazanlp/' WHEN 'kinnews' THEN 'external/v1/kinnews/' ELSE 'unknown/' END"""
    dataset = """CASE WHEN source IN ('commoncrawl', 'targeted_web', 'wikipedia', 'mbazanlp_v01.1', 'kinnews', 'wayback', 'cc_index', 'cc_lang', 'books_corpus') THEN 'pretrain' WHEN source = 'parallel_web' THEN 'parallel'
        WHEN source = 'instructions_rw' THEN 'instructions' ELSE 'none' END"""
    bare = "regexp_replace(text, '[\\s\\x{b}\\x{85}\\p{Z}]+', '', 'g')"
    letters = "trim(regexp_replace(text, '[^a-zA-Z]+', ' ', 'g'))"
    norm = f"regexp_extract(plain, '^([a-z]+://)', 1) || lower({NETLOC.format(u='plain')}) || CASE WHEN {path('plain')} = '' THEN '/' ELSE '' END || regexp_extract(plain, '^[a-z]+://[^/?#]*(.*)$', 1)"
    kept = "SELECT *, sha256(text) AS h FROM wet_records WHERE text IS NOT NULL AND keep"
    chars = "unnest(string_split(text, ''))"
    return {
        "wet_round_trip": "SELECT url, sha256(regexp_replace(replace(text, chr(13), ''), '^\\s+|\\s+$', '', 'g')) AS sha256 FROM wet_records WHERE url IS NOT NULL AND regexp_replace(coalesce(text, ''), '\\s+', '', 'g') <> ''",
        "warc_round_trip": """
            SELECT DISTINCT capture_id, coalesce(warc_type, '') AS warc_type, coalesce(target_url, '') AS target_url, CASE WHEN warc_type = 'response' THEN coalesce(octet_length(body), 0) ELSE 0 END AS bytes, coalesce(warc_type = 'response', false) AS ok,
              CASE WHEN warc_type = 'response' THEN '' ELSE 'not_response: ' || coalesce(warc_type, '') END AS error, CASE WHEN warc_type = 'response' THEN http_headers['content-type'] END AS content_type
            FROM warc_records WHERE capture_id IS NOT NULL""",
        "cdx_round_trip": """
            SELECT target_url AS url, capture_id AS "offset", octet_length(body) AS length, '200' AS status, 'text/html' AS mime, sha1(body) AS digest, 'c1' AS crawl FROM warc_records
            WHERE http_status = 200 AND regexp_extract(http_headers['content-type'], '^[^;]*') = 'text/html' AND target_url IS NOT NULL AND capture_id IS NOT NULL AND body IS NOT NULL""",
        "archive_cdx_round_trip": "SELECT DISTINCT capture_ts AS timestamp, url AS original_url, 'text/html' AS mime_type, coalesce(octet_length(html_bytes), 0) AS length FROM page_fetches WHERE capture_ts IS NOT NULL AND url IS NOT NULL",
        "wiki_round_trip": f"""
            SELECT n AS page_id, {squeezed('title')} AS title, {squeezed(f"regexp_replace(text, '{control}', '', 'g')")} AS text
            FROM (SELECT *, {_hex('doc_id')} AS n FROM {_first('extracted_docs', 'doc_id', 'fetched_at NULLS FIRST, text NULLS FIRST', f"{strip("coalesce(title, '')")} <> ''")})
            WHERE n % 5 <> 0 AND n % 7 <> 0 AND regexp_replace(coalesce(text, ''), '\\s+', '', 'g') <> ''""",
        "seed_round_trip": f"SELECT domain, CASE WHEN {_hex('domain')} % 3 = 0 THEN 'precision' ELSE 'recall' END AS mode, count(*) AS n FROM (SELECT {d} AS domain FROM wet_records WHERE domain IS NOT NULL) GROUP BY ALL",
        "seeds_allow": f"""
            SELECT url, d <> '' AND {_hex('d')} % 5 <> 0 AND ({_hex('d')} % 2 <> 0 OR starts_with({path('url')}, '/amakuru/')) AS allowed FROM (SELECT DISTINCT url, {lowered.format(d=host('url'))} AS d FROM extracted_docs WHERE url IS NOT NULL)""",
        "parent_domain_matches": f"""
            WITH w AS (SELECT {d} AS d FROM wet_records WHERE domain IS NOT NULL), s AS (SELECT DISTINCT regexp_extract(d, '([^.]+\\.[^.]+)$', 1) AS suffix FROM w)
            SELECT suffix, count(*) AS n FROM w JOIN s ON suffix <> '' AND (d = suffix OR d LIKE '%.' || suffix) GROUP BY 1""",
        "shard_round_trip": f"SELECT source, lang, count(*) AS n, sum(length(text))::BIGINT AS chars, bit_xor(('0x' || substr(h, 1, 15))::BIGINT) AS ids FROM ({kept}) GROUP BY ALL",
        "shard_validation": f"SELECT count(*) AS records, sum(length(text))::BIGINT AS chars, 0 AS bad_lines, 0 AS other_records, 0 AS other_bytes, 0 AS other_checksums FROM ({kept})",
        "shard_publication": "SELECT unnest(['copied', 'there', 'resolved', 'removed']) AS step, true AS all_shards",
        "shards_by_source": f"SELECT source, count(*) AS shards, count(DISTINCT run_id) AS runs, 'store/' || {prefix} AS prefix, {dataset} AS dataset FROM ({INDEX}) GROUP BY ALL",
        "split_files": f"""
            SELECT CASE WHEN b < 9800 THEN 'train' WHEN b < 9900 THEN 'val' ELSE 'test' END AS split, count(*) AS keys, min(key) AS "first", max(key) AS "last" FROM (SELECT doc_id::VARCHAR AS key, {bucket.format(k='doc_id')} AS b FROM documents) GROUP BY 1""",
        "train_uris": f"SELECT 's3://store/' || k AS uri FROM (SELECT {prefix} || 'shards/run_id=' || run_id || '/' || filename AS k FROM ({INDEX})) WHERE {bucket.format(k='k')} < 9800",
        "packed_files": f"""
            WITH t AS (SELECT coalesce(source, 'none') || '/' || floor(doc_id / 5000)::BIGINT AS shard, unicode({chars}) AS c FROM documents WHERE length(text) > 0),
            s AS (SELECT shard, count(*) FILTER (c > 0) AS n, sum(c) AS total, count(*) AS filled FROM t GROUP BY 1),
            x AS (SELECT *, {bucket.format(k='shard')} AS b FROM s)
            SELECT CASE WHEN b < 8000 THEN 'train' WHEN b < 9000 THEN 'val' ELSE 'test' END AS split, sum(n)::BIGINT AS tokens, sum(total)::BIGINT AS checksum, 1024 AS longest FROM x GROUP BY 1""",
        "enrichment_round_trip": f"SELECT doc_id, shard_name, token_count, char_count, content_type, quality_score FROM {_first('enriched_meta', 'doc_id', 'enriched_at DESC NULLS LAST, domain NULLS FIRST, token_count NULLS FIRST', 'doc_id IS NOT NULL')}",
        "dead_letter_files": "SELECT DISTINCT capture_id, url, error AS reason, NOT regexp_matches(error, '^http_4|content_type') AS retryable, channel AS stage FROM page_fetches WHERE NOT ok",
        "crawl_lists": "SELECT 'https://data.example/crawl-data/' || crawl || '/wet.paths.gz' AS url FROM (SELECT DISTINCT crawl FROM wet_records WHERE crawl LIKE 'CC-MAIN-%' AND substr(crawl, 9) >= '2024-10' AND substr(crawl, 9) <= '2025-40') ORDER BY crawl DESC LIMIT 8",
        "columnar_index_scan": """
            SELECT coalesce(url, '') AS url, count(*) AS n, coalesce(sum(length(text)), 0)::BIGINT AS chars, true AS listed FROM extracted_docs
            WHERE (lang = 'kin_Latn' OR lang LIKE 'kin\\_Latn,%' ESCAPE '\\') AND NOT contains(url, '.ru/') AND NOT contains(url, '.news.') GROUP BY 1""",
        "news_import": f"""
            WITH e AS (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS row_no FROM {_first('extracted_docs', 'doc_id', 'fetched_at NULLS FIRST, text NULLS FIRST', 'doc_id IS NOT NULL')})
            SELECT CASE WHEN {label} BETWEEN 0 AND 13 THEN {labels}[{label} + 1] ELSE 'unknown_' || {label} END AS category, count(*) AS docs,
              sum(length({strip('text')}) + CASE WHEN {strip("coalesce(title, '')")} <> '' THEN length({strip('title')}) + 2 ELSE 0 END)::BIGINT AS chars, max(row_no) AS last_id FROM e WHERE {strip("coalesce(text, '')")} <> '' GROUP BY 1""",
        "monolingual_import": f"SELECT doc_id::VARCHAR AS source_id, sha256(text) AS sha256, '01.1' AS version FROM documents WHERE {strip("coalesce(text, '')")} <> ''",
        "first_documents": "SELECT source, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS i FROM documents WHERE source IS NOT NULL) WHERE i <= 50",
        "harvested_classes": f"SELECT k AS url_class, count(*) AS n FROM (SELECT {kind} AS k FROM (SELECT DISTINCT url FROM extracted_docs WHERE url IS NOT NULL)) WHERE k IN ('news', 'pdf', 'document', 'static') GROUP BY 1",
        "page_round_trip": f"SELECT doc_id, CASE WHEN {bare} = '' THEN NULL ELSE 'A & B' END AS title, CASE WHEN {bare} <> '' THEN sha256({bare}) END AS sha256 FROM documents WHERE text IS NOT NULL",
        "link_round_trip": f"""
            WITH u AS (SELECT url, regexp_extract(url, '^([a-z]+://[^/?#]+)', 1) AS site, regexp_replace(url, '#.*$', '') AS plain FROM (SELECT DISTINCT url FROM extracted_docs WHERE url IS NOT NULL))
            SELECT url, unnest([0, 1, 3]) AS pos, unnest([lower(site) || '/top?x=1&y=2', {norm}, regexp_extract(url, '^([a-z]+:)', 1) || '//other.example/z']) AS target FROM u""",
        "wikitext_round_trip": f"SELECT doc_id, sha256(t || ' label' || chr(10) || chr(10) || 'Amateka' || chr(10) || t || ' \"w\" named') AS sha256 FROM (SELECT doc_id, {letters} AS t FROM documents WHERE text IS NOT NULL) WHERE t <> ''",
        "office_round_trip": f"""
            WITH x AS (SELECT doc_id, regexp_replace(text, '[\\x{{0}}-\\x{{8}}\\x{{b}}\\x{{c}}\\x{{d}}\\x{{e}}-\\x{{1f}}\\x{{fffe}}\\x{{ffff}}]', '', 'g') AS text FROM documents WHERE text IS NOT NULL),
            y AS (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'office' WHEN 1 THEN 'pdf' ELSE 'html' END AS route,
              CASE doc_id % 3 WHEN 0 THEN CASE WHEN length({strip("array_to_string(list_filter(string_split(text, chr(10)), lambda l: " + strip('l') + " <> ''), chr(10))")}) >= 50 THEN text END WHEN 1 THEN NULL ELSE nullif({letters}, '') END AS t FROM x)
            SELECT doc_id, route, sha256(regexp_replace(t, '[\\s\\x{{b}}\\x{{85}}\\p{{Z}}]+', '', 'g')) AS sha256, CASE WHEN t IS NULL THEN CASE route WHEN 'pdf' THEN 'reject.pdf_extraction_failed' WHEN 'office' THEN 'reject.office_extraction_failed' ELSE 'reject.extraction_failed' END END AS reason FROM y""",
        "robots_rules": f"""
            SELECT url, x % 5 <> 0 AND (x % 5 < 3 OR NOT starts_with({path('url')}, '/amakuru/')) AS anyone, x % 5 <> 0 AND (x % 5 < 3 OR NOT starts_with({path('url')}, '/news/')) AS loom
            FROM (SELECT url, {_hex('url')} AS x FROM (SELECT DISTINCT url FROM extracted_docs WHERE url IS NOT NULL))""",
        "example_round_trip": f"""
            SELECT coalesce(task_type, 'qa') AS task_type, count(*) AS n, sum(length(p))::BIGINT AS prompt_chars, sum(length(r))::BIGINT AS response_chars FROM (SELECT task_type, {strip('prompt')} AS p, {strip('response')} AS r FROM instruction_examples) WHERE p <> '' AND r <> '' GROUP BY 1""",
        "shard_documents_form": f"SELECT DISTINCT sha256(t) AS id, 'commoncrawl' AS source, nullif(url, '') AS url, crawl, lang, lid_score, run_id AS run FROM ({decided()}) WHERE keep2",
    }
