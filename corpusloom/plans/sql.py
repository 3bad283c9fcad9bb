"""The queries of :mod:`corpusloom.plans.queries` in SQL, for DuckDB over the same tables."""

from __future__ import annotations

from types import SimpleNamespace

# Fixed values, written out here a second time: a wrong one in an operator must not reach the SQL that checks it.
WS = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]"
SPLIT_SEED = "v1-stable"
_GENERAL = SimpleNamespace(
    languages=("kin_Latn", "rw"), min_confidence=0.80, min_chars=200, max_chars=100_000, min_words=30, max_url_ratio=0.20, max_repeated_lines=0.30, min_alpha_ratio=0.70, max_ngram_2=0.30, max_ngram_3=0.25, max_ngram_4=0.20, max_non_latin=0.10
)
_BOOKS = SimpleNamespace(**vars(_GENERAL) | {"min_confidence": 0.70, "max_chars": 1_000_000, "max_ngram_2": 0.50, "max_ngram_3": 0.40, "max_ngram_4": 0.35})
_TARGETED = SimpleNamespace(**vars(_GENERAL) | {"min_confidence": 0.85})
_LOWEST = SimpleNamespace(**vars(_GENERAL) | {"min_confidence": 0.50})
_TYPE_RATIOS = {"news": 0.15, "government": 0.05, "academic": 0.10, "religious": 0.10, "wiki": 0.10, "other": 0.50}
_LID_BINS = (0.8, 0.85, 0.9, 0.95, 1.0)
_LENGTH_BINS = (200, 500, 1000, 2000, 5000, 10000)
_PRETRAIN_SOURCES = ("commoncrawl", "targeted_web", "wikipedia", "mbazanlp_v01.1", "kinnews", "wayback", "cc_index", "cc_lang", "books_corpus")
_NEWS = (
    "igihe.com", "umuseke.rw", "ktpress.rw", "newtimes.co.rw", "kigalitoday.com", "inyarwanda.com", "isimbi.rw", "intyoza.com", "rba.co.rw", "imvahonshya.co.rw", "umuryango.rw", "flash.rw", "taarifa.rw",
)
_RELIGIOUS = ("bible.com", "jw.org", "diocesecyangugu.com", "bfrw.org", "eglisecatholiquerwanda.org", "adepr.rw")
_ACADEMIC = ("ur.ac.rw", "ines.ac.rw", "reb.rw", "nesa.gov.rw")
_SKIPPED = (
    ".doc", ".docx", ".xls", ".xlsx", ".ppt", ".pptx", ".zip", ".tar", ".gz", ".bz2", ".7z", ".rar", ".jpg", ".jpeg", ".png", ".gif", ".bmp", ".svg", ".webp", ".ico", ".mp3",
    ".mp4", ".avi", ".mov", ".wmv", ".flv", ".webm", ".exe", ".dmg", ".msi", ".deb", ".rpm", ".css", ".js", ".json", ".xml", ".rss", ".atom", ".woff", ".woff2", ".ttf", ".eot",
)
_STATIC = (
    ".jpg", ".jpeg", ".png", ".gif", ".svg", ".webp", ".ico", ".css", ".js", ".woff", ".woff2", ".ttf", ".eot", ".mp3", ".mp4", ".wav", ".avi", ".mov", ".zip", ".rar", ".gz", ".tar",
    ".xml", ".json", ".rss",
)
_FRAME = "Sign in to your account$|Log ?in$|Sign ?up$|Subscribe( now)?$|Share this|Cookie|Accept (all )?cookies|Privacy policy$|Terms (of|and) |All rights reserved\\.?$|Copyright ©|Powered by "


def _words(t: str) -> str:
    return f"list_filter(regexp_split_to_array({t}, '{WS}+'), lambda w: w <> '')"


def strip(t: str) -> str:
    return f"regexp_replace({t}, '^{WS}+|{WS}+$', '', 'g')"


def _list(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _grams(n: int, words: str = "w") -> str:
    return f"[array_to_string({words}[i:i + {n - 1}], ' ') for i in range(1, len({words}) - {n} + 2)]"


def _repetition(n: int) -> str:
    return f"CASE WHEN len(w) < 10 THEN 0.0 ELSE coalesce(list_sum(list_filter(map_values(list_histogram({_grams(n)})), lambda c: c > 1)), 0) / (len(w) - {n - 1})::DOUBLE END"


def _collapsed(c: str) -> str:
    for a, b in (
        ("[\\x{200b}\\x{200c}\\x{200d}\\x{feff}]", ""), ("[\\x{0}-\\x{8}\\x{b}\\x{c}\\x{e}-\\x{1f}\\x{7f}-\\x{9f}]", ""), ("\\r\\n?", "\\n"), ("!!+", "!"), ("\\?\\?+", "?"),
        ("(\\n[ \\t]*[-=*_]{3,}[ \\t]*){3,}", "\\n\\n"), ("\\n{3,}", "\\n\\n"), ("[\\t\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{202f}\\x{205f}\\x{3000} ]+", " "),
    ):
        c = f"regexp_replace({c}, '{a}', '{b}', 'g')" if "\\n" not in b else f"regexp_replace({c}, '{a}', {'||'.join(['chr(10)'] * b.count(chr(92) + 'n'))}, 'g')"
    return c


def _normal(c: str) -> str:
    """Canonical text as far as these tables need it: of all that NFKC changes they have no-break spaces only, of references two."""
    return strip(_collapsed(f"replace(replace(replace({c}, chr(160), ' '), '&#39;', chr(39)), '&eacute;', 'é')"))


def _measures(table: str, extra: str = "", text: str = "text") -> str:
    """Per row of ``table``: its columns, the words ``w`` and all measures of the text."""
    return f"""
    SELECT *, CASE WHEN n = 0 THEN 0.0 ELSE coalesce(list_sum([length(u) for u in regexp_extract_all(t, 'https?://\\S+')]), 0) / n::DOUBLE END AS url_ratio,
      CASE WHEN n = 0 THEN 0.0 ELSE length(letters) / n::DOUBLE END AS alpha_ratio,
      CASE WHEN letters = '' THEN 0.0 ELSE length(regexp_replace(letters, '\\p{{Latin}}+', '', 'g')) / length(letters)::DOUBLE END AS non_latin_ratio,
      CASE WHEN len(l) <= 3 THEN 0.0 ELSE list_max(map_values(list_histogram(l))) / len(l)::DOUBLE END AS repeated_lines,
      {_repetition(2)} AS rep_2, {_repetition(3)} AS rep_3, {_repetition(4)} AS rep_4
    FROM (SELECT *, length(t) AS n, regexp_replace(t, '\\P{{L}}+', '', 'g') AS letters, {_words("t")} AS w,
            list_filter([{strip("x")} for x in string_split(t, chr(10))], lambda x: x <> '') AS l FROM (SELECT *, coalesce({text}, '') AS t {extra} FROM {table}))"""


def _filters(p: SimpleNamespace) -> list[tuple[str, str]]:
    return [
        ("min_chars", f"n < {p.min_chars}"), ("max_chars", f"n > {p.max_chars}"), ("min_words", f"len(w) < {p.min_words}"), ("url_ratio", f"url_ratio > {p.max_url_ratio}"), ("alpha_ratio", f"alpha_ratio < {p.min_alpha_ratio}"),
        ("repetition", f"repeated_lines > {p.max_repeated_lines}"), ("word_ngram_repetition", f"rep_2 > {p.max_ngram_2} OR rep_3 > {p.max_ngram_3} OR rep_4 > {p.max_ngram_4}"), ("mixed_script", f"non_latin_ratio > {p.max_non_latin}"),
    ]


def _reasons(p: SimpleNamespace) -> str:
    return f"SELECT doc_id, array_to_string(list_filter([{', '.join(f'CASE WHEN {c} THEN {chr(39)}reject.filter.{k}{chr(39)} END' for k, c in _filters(p))}], lambda x: x IS NOT NULL), ',') AS reasons FROM ({_measures('documents')})"


def decided(p: SimpleNamespace = _GENERAL) -> str:
    when = " ".join(f"WHEN {c} THEN 'reject.filter.{k}'" for k, c in _filters(p))
    return f"""
    SELECT *, reason2 = 'keep' AS keep2 FROM (SELECT *, CASE WHEN n < {p.min_chars} THEN 'reject.too_short' WHEN NOT coalesce(lang IN {_list(p.languages)}, false) THEN 'reject.lid.not_rw'
      WHEN coalesce(lid_score, 0) < greatest({p.min_confidence}::DOUBLE, CASE WHEN n < 300 THEN 0.95 WHEN n < 500 THEN 0.9 WHEN n < 1000 THEN 0.85 ELSE 0.7 END::DOUBLE) THEN 'reject.lid.low_confidence' {when} ELSE 'keep' END AS reason2
      FROM ({_measures('wet_records', text=_normal('text'))}))"""


def _bucket(v: str, bins) -> str:
    c = f"CASE WHEN {v} < {bins[0]} THEN '<{bins[0]}' "
    return c + " ".join(f"WHEN {v} < {b} THEN '{a}-{b}'" for a, b in zip(bins, bins[1:])) + f" ELSE '>={bins[-1]}' END"


NETLOC = "regexp_extract({u}, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)', 1)"


def domain(u: str) -> str:
    return f"regexp_replace(regexp_replace(lower({NETLOC.format(u=u)}), ':.*$', ''), '^www\\.', '')"


def host(u: str) -> str:
    return f"regexp_replace(regexp_replace(lower({NETLOC.format(u=u)}), '^.*@', ''), ':.*$', '')"


def path(u: str) -> str:
    return f"regexp_extract({u}, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)"


def _scheme(u: str) -> str:
    return f"lower(regexp_extract({u}, '^([A-Za-z][A-Za-z0-9+.-]*):', 1))"


def _ends(p: str, endings) -> str:
    return f"regexp_matches({p}, '(?:{'|'.join(e.replace('.', chr(92) + '.') for e in endings)})$')"


def _type(source: str, d: str) -> str:
    return f"""CASE WHEN {source} = 'wikipedia' THEN 'wiki' WHEN {source} IN {_list(("kinnews", "mbazanlp_v01.1"))} THEN 'external_dataset' WHEN {d} LIKE '%.gov.rw' OR {d} = 'gov.rw' THEN 'government'
      WHEN {d} IN {_list(_NEWS)} THEN 'news' WHEN {d} IN {_list(_RELIGIOUS)} THEN 'religious' WHEN {d} IN {_list(_ACADEMIC)} OR {d} LIKE '%.ac.rw' THEN 'academic' ELSE 'other' END"""


INDEX = """
    SELECT filename, regexp_extract(filename, '^[^_]+_(.+)_([^_]+)_part-', 1) AS source, regexp_extract(filename, '^[^_]+_(.+)_([^_]+)_part-', 2) AS run_id, records_count, bytes, token_estimate
    FROM (SELECT shard_name AS filename, count(*) AS records_count, coalesce(sum(char_count), 0)::BIGINT AS bytes, coalesce(sum(token_count), 0)::BIGINT AS token_estimate FROM enriched_meta WHERE shard_name IS NOT NULL GROUP BY 1)"""
_PRETRAIN = _list(_PRETRAIN_SOURCES)
_TYPES = """
    SELECT shard_name, content_type FROM (SELECT *, row_number() OVER (PARTITION BY shard_name ORDER BY n DESC, f NULLS FIRST, content_type) AS i
      FROM (SELECT shard_name, content_type, count(*) AS n, min(doc_id) AS f FROM enriched_meta WHERE shard_name IS NOT NULL AND content_type IS NOT NULL GROUP BY ALL)) WHERE i = 1"""


def _mixed(size: str = "token_estimate") -> str:
    ratios = ", ".join(f"('{k}', {v})" for k, v in _TYPE_RATIOS.items())
    return f"""
    WITH s AS (SELECT i.filename AS s3_key, t.content_type, i.{size} AS token_estimate FROM ({INDEX}) i JOIN ({_TYPES}) t ON t.shard_name = i.filename),
    tot AS (SELECT sum(token_estimate)::DOUBLE AS total FROM s), r(content_type, ratio) AS (VALUES {ratios}),
    a AS (SELECT r.content_type, r.ratio::DOUBLE AS ratio, coalesce(sum(s.token_estimate), 0)::DOUBLE AS have FROM r LEFT JOIN s USING (content_type) GROUP BY ALL),
    u AS (SELECT *, have <= total * ratio AS under FROM a, tot),
    z AS (SELECT coalesce(sum(CASE WHEN under AND have < total * ratio THEN ratio - have / total END), 0) AS surplus, sum(CASE WHEN NOT under THEN ratio END) AS share FROM u),
    g AS (SELECT content_type, total * (ratio + surplus * ratio / share) AS goal, have FROM u, z WHERE NOT under),
    o AS (SELECT s.*, goal, have, coalesce(sum(token_estimate) OVER (PARTITION BY content_type ORDER BY sha256('{SPLIT_SEED}:' || s3_key) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM s LEFT JOIN g USING (content_type))
    SELECT s3_key, content_type, token_estimate FROM o WHERE goal IS NULL OR have <= goal OR before < goal"""


def _split(key: str, ratios=(0.8, 0.1, 0.1)) -> str:
    b = f"(('0x' || substr(sha256('{SPLIT_SEED}:' || {key}), 1, 8))::BIGINT % 10000)"
    first = int(ratios[0] * 10000)
    return f"CASE WHEN {b} < {first} THEN 'train' WHEN {b} < {first + int(ratios[1] * 10000)} THEN 'val' ELSE 'test' END"


def _portal_kind() -> str:
    p, q = f"lower({path('url')})", "lower(regexp_extract(url, '^[^?#]*\\?([^#]*)', 1))"
    return f"""CASE WHEN {p} LIKE '%.pdf' THEN 'pdf' WHEN {_ends(p, ('.docx', '.doc', '.pptx'))} THEN 'document' WHEN contains({p}, '/fileadmin/') AND NOT {_ends(p, ('.jpg', '.jpeg', '.png', '.gif', '.svg', '.webp', '.css', '.js'))} THEN 'pdf'
      WHEN contains({p}, '/news-details/') THEN 'news' WHEN regexp_matches({q}, 'tx_news_pi1|tx_filelist_filelist') THEN 'listing' WHEN contains({p}, '/amakuru') AND NOT contains({q}, 'currentpage') THEN 'listing' ELSE 'static' END"""


_RUN = """count(*) AS docs_seen, count(*) FILTER (keep2) AS docs_kept, coalesce(sum(CASE WHEN keep2 THEN n ELSE 0 END), 0)::BIGINT AS chars_kept"""
_ID = "substr(sha256(coalesce(source, '') || '||' || coalesce(prompt, '') || '||' || coalesce(response, '')), 1, 16)"


def _dedup(rows: str) -> str:
    return f"""SELECT CASE WHEN grouping(source) = 1 THEN 'all' ELSE 'source' END AS level, source, count(*) AS total_docs, count(*) FILTER (kept) AS unique_docs, count(*) FILTER (NOT kept) AS exact_dupes, 0 AS fuzzy_dupes,
      round_even(count(*) FILTER (NOT kept) / count(*)::DOUBLE, 4) AS dedup_ratio, count(DISTINCT floor(doc_id / 1000)) AS shards_processed, count(DISTINCT floor(doc_id / 1000)) FILTER (NOT kept) AS shards_with_dupes FROM ({rows}) GROUP BY GROUPING SETS ((), (source))"""


def _words_model(texts: str, key: str) -> str:
    """Per text of ``texts`` (``key``, ``text``) the points of each language by word frequencies of the reference: ``key, lang, s, n``."""
    letters = "regexp_extract_all(lower({c}), '\\p{{L}}+')"
    return f"""
      m AS (SELECT lang, unnest({letters.format(c='text')}) AS w FROM lid_reference WHERE lang IS NOT NULL), c AS (SELECT lang, w, count(*) AS n FROM m GROUP BY ALL), v AS (SELECT count(DISTINCT w) AS v FROM c),
      t AS (SELECT lang, sum(n) AS total FROM c GROUP BY 1), b AS (SELECT DISTINCT w FROM c),
      p AS (SELECT t.lang, b.w, round(1000 * ln((coalesce(c.n, 0) + 1) / (t.total + v.v)::DOUBLE))::BIGINT AS pts FROM t, b, v LEFT JOIN c ON c.lang = t.lang AND c.w = b.w),
      d AS ({texts}), x AS (SELECT {key}, unnest({letters.format(c='text')}) AS w FROM d), y AS (SELECT {key}, w, count(*) AS k FROM x GROUP BY ALL),
      z AS (SELECT {key}, lang, sum(pts * k) AS s, sum(k) AS n FROM y JOIN p USING (w) GROUP BY ALL),
      r AS (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY s DESC, lang) AS i, max(s) OVER (PARTITION BY {key}) AS top FROM z),
      e AS (SELECT *, exp((s - top) / (1000 * sqrt(n::DOUBLE))) AS ex FROM r),
      q AS (SELECT *, round(ex / sum(ex) OVER (PARTITION BY {key}), 4) AS pr FROM e),
      said AS (SELECT d.{key}, coalesce(any_value(lang) FILTER (i = 1), 'zxx_Latn') AS lang, coalesce(any_value(pr) FILTER (i = 1), 1.0) AS score, any_value(lang) FILTER (i = 2) AS lang_2, coalesce(any_value(pr) FILTER (i = 2), 0.0) AS score_2,
        round(coalesce(any_value(pr) FILTER (i = 1), 1.0) - coalesce(any_value(pr) FILTER (i = 2), 0.0), 4) AS gap FROM d LEFT JOIN q ON q.{key} = d.{key} GROUP BY 1)"""


def oracle_sql() -> dict[str, str]:
    reports = ("docs_seen", "docs_kept", "docs_deduped", "bytes_written", "shards_written", "token_estimate_total")
    kind = f"""CASE WHEN lp LIKE '%.pdf' THEN 'pdf' WHEN {_ends('lp', ('.docx', '.doc', '.pptx', '.xlsx'))} THEN 'document' WHEN contains(lp, '/fileadmin/') AND NOT {_ends('lp', _STATIC)} THEN 'pdf' ELSE 'page' END"""
    parts = "list_filter(string_split(p, '/'), lambda s: s <> '')"
    good = f"list_filter({parts}, lambda s: NOT regexp_matches(s, '^[0-9]+$') AND length(s) > 1)"
    skip = "|".join(e.replace(".", "\\.") for e in sorted(_SKIPPED, key=len, reverse=True))
    portal = """CASE WHEN regexp_matches(lp, '/amakuru|/news-details/') THEN 'amakuru'
        WHEN contains(lp, '/inyandiko/') THEN CASE WHEN regexp_extract(lp, '/inyandiko/+([^/]+)', 1) <> '' THEN 'inyandiko/' || regexp_extract(lp, '/inyandiko/+([^/]+)', 1) ELSE 'inyandiko' END
        WHEN contains(lp, '/fileadmin/') THEN CASE WHEN regexp_matches(lp, 'laws|policies') THEN 'inyandiko/amategeko' WHEN regexp_matches(lp, 'books|published') THEN 'inyandiko/ibitabo' WHEN contains(lp, 'educational') THEN 'inyandiko/ubukangurambaga' ELSE 'inyandiko' END
        WHEN contains(lp, '/ikigo') THEN 'ikigo' WHEN regexp_matches(lp, '/serivisi|/serivski') THEN 'serivisi' ELSE 'other' END"""
    collapsed = _collapsed("text")
    frame = _FRAME
    own = {
        "filter_reasons": _reasons(_GENERAL),
        "filter_reasons_books": _reasons(_BOOKS),
        "text_measures": f"SELECT doc_id, len(w)::BIGINT AS words, url_ratio, alpha_ratio, non_latin_ratio, repeated_lines, floor(n / {2.55}::DOUBLE)::BIGINT AS tokens FROM ({_measures('documents')})",
        "ngram_repetition": f"SELECT doc_id, rep_2, rep_3, rep_4 FROM ({_measures('documents')})",
        "keep_decision": f"SELECT doc_id, reason2 AS reason, keep2 AS keep FROM ({decided()})",
        "keep_decision_targeted": f"SELECT reason2 AS reason, count(*) AS n FROM ({decided(_TARGETED)}) GROUP BY 1",
        "collapsed_text": f"SELECT DISTINCT doc_id, sha256(c) AS sha256, length(c) AS chars FROM (SELECT doc_id, {strip(collapsed)} AS c FROM extracted_docs)",
        "frame_lines_removed": f"SELECT DISTINCT doc_id, length({strip(f'''array_to_string(list_filter(string_split(text, chr(10)), lambda l: NOT regexp_matches({strip('l')}, '(?i)^(?:{frame})')), chr(10))''')}) AS chars FROM extracted_docs",
        "shingle_counts": f"SELECT doc_id, CASE WHEN len(w) = 0 THEN 0 WHEN len(w) < 5 THEN 1 ELSE len(list_distinct({_grams(5)})) END AS shingles FROM (SELECT doc_id, {_words('lower(text)')} AS w FROM documents)",
        "index_language_scan": "SELECT DISTINCT doc_id, coalesce(url, '') AS url, lang FROM extracted_docs WHERE lang IS NOT NULL AND (lang = 'kin_Latn' OR lang LIKE 'kin\\_Latn,%' ESCAPE '\\') AND NOT contains(url, '.gov.')",
        "instruction_reasons": f"""
            SELECT id, CASE WHEN p = '' THEN 'reject.empty_prompt' WHEN r = '' THEN 'reject.empty_response' WHEN length(p) < 10 OR length(r) < 10 THEN 'reject.too_short' WHEN length(prompt) > 4000 OR length(response) > 8000 THEN 'reject.too_long'
              WHEN len(l) >= 3 AND 1 - len(list_distinct(l)) / len(l)::DOUBLE > 0.5 THEN 'reject.low_quality' ELSE '' END AS reason
            FROM (SELECT *, {strip("coalesce(prompt, '')")} AS p, {strip("coalesce(response, '')")} AS r, list_filter(string_split(response, chr(10)), lambda x: length(x) >= 10) AS l FROM instruction_examples)""",
        "pair_reasons": f"""
            WITH rw AS (SELECT *, row_number() OVER (PARTITION BY {domain('url')} ORDER BY url) AS place FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY text NULLS FIRST, lang NULLS FIRST, lid_score NULLS FIRST) AS i FROM wet_records WHERE url IS NOT NULL) WHERE i = 1),
            e AS (SELECT *, row_number() OVER (PARTITION BY {domain('url')} ORDER BY url) AS place FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY doc_id NULLS FIRST, fetched_at NULLS FIRST, text NULLS FIRST) AS i FROM extracted_docs WHERE url IS NOT NULL) WHERE i = 1),
            q AS (SELECT doc_id, max(quality_score) AS score FROM enriched_meta WHERE doc_id IS NOT NULL GROUP BY 1),
            x AS (SELECT rw.text AS a, e.text AS b, rw.lang AS la, rw.lid_score AS sa, e.lang AS lb, q.score AS sb FROM rw JOIN e ON {domain('e.url')} = {domain('rw.url')} AND e.place = rw.place LEFT JOIN q ON q.doc_id = e.doc_id)
            SELECT CASE WHEN coalesce(a, '') = '' OR coalesce(b, '') = '' THEN 'reject.extract_failed' WHEN length(a) < 200 OR length(b) < 200 THEN 'reject.too_short' WHEN NOT coalesce(la IN ('kin_Latn', 'rw'), false) THEN 'reject.lid.rw'
              WHEN coalesce(sa, 0) < 0.7 THEN 'reject.lid.rw_low' WHEN NOT coalesce(lb IN ('eng_Latn', 'en'), false) THEN 'reject.lid.en' WHEN coalesce(sb, 0) < 0.7 THEN 'reject.lid.en_low' ELSE 'ok' END AS reason, count(*) AS n FROM x GROUP BY 1""",
        "example_ids": f"SELECT id, {_ID} AS example_id FROM instruction_examples",
        "url_parts": f"""
            SELECT DISTINCT url, {domain('url')} AS domain, CASE WHEN len({parts}) = 0 THEN 'root' WHEN len({good}) > 0 THEN ({good})[1] ELSE ({parts})[1] END AS section, {kind} AS kind, {portal} AS portal_section,
              CASE WHEN {_scheme('v')} IN ('http', 'https') AND {host('v')} <> '' THEN {_scheme('v')} || '://' || lower({NETLOC.format(u='v')}) || CASE WHEN rest = '' THEN '/' WHEN rest LIKE '?%' THEN '/' || rest ELSE rest END END AS normalized
            FROM (SELECT *, {path('url')} AS p, lower({path('url')}) AS lp, regexp_replace(trim(url), '#.*$', '') AS v, regexp_extract(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(.*)$', 1) AS rest FROM extracted_docs)""",
        "url_safety": f"""
            WITH a AS (SELECT DISTINCT regexp_replace(lower(trim(domain)), '^www\\.', '') AS domain FROM wet_records WHERE trim(domain) <> ''),
            f AS (SELECT DISTINCT capture_id, url, final_url, regexp_replace({host('url')}, '^www\\.', '') AS d, regexp_replace({host('final_url')}, '^www\\.', '') AS fd, regexp_extract(lower({path('url')}), '({skip})$', 1) AS ext FROM page_fetches)
            SELECT DISTINCT capture_id, CASE WHEN {_scheme('url')} NOT IN ('http', 'https') THEN 'bad_scheme' WHEN {host('url')} = '' THEN 'no_hostname' WHEN a.domain IS NULL THEN 'off_allowlist' WHEN ext <> '' THEN 'skip_extension:' || ext ELSE 'ok' END AS safety,
              CASE WHEN final_url IS NULL OR final_url = '' OR final_url = url THEN 'no_redirect' WHEN {host('final_url')} = '' THEN 'redirect_no_hostname' WHEN b.domain IS NULL THEN 'redirect_off_allowlist' ELSE 'ok' END AS redirect
            FROM f LEFT JOIN a ON a.domain = f.d LEFT JOIN a AS b ON b.domain = f.fd""",
        "capture_urls": "SELECT DISTINCT capture_id, 'https://web.archive.org/web/' || capture_ts || 'id_/' || url AS capture_url, url || ':' || capture_ts AS done_key FROM page_fetches WHERE capture_ts IS NOT NULL",
        "warc_outcomes": "SELECT warc_type, http_status, ok, error, http_headers['content-type'] AS content_type, count(*) AS n, coalesce(sum(octet_length(body)), 0)::BIGINT AS bytes FROM warc_records GROUP BY ALL",
        "exact_dedup": "SELECT doc_id, sha256(text) AS sha256, CASE WHEN row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) > 1 THEN 'reject.dedup.exact' ELSE 'keep' END AS reason FROM documents WHERE text IS NOT NULL",
        "exact_dedup_across_runs": """
            WITH s AS (SELECT DISTINCT sha256(text) AS h FROM wet_records WHERE text IS NOT NULL AND keep), e AS (SELECT *, sha256(text) AS h, row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id, fetched_at) AS i FROM extracted_docs WHERE text IS NOT NULL)
            SELECT source, CASE WHEN i > 1 OR s.h IS NOT NULL THEN 'reject.dedup.exact' ELSE 'keep' END AS reason, count(*) AS n FROM e LEFT JOIN s USING (h) GROUP BY ALL""",
        "pair_dedup": "WITH e AS (SELECT DISTINCT id, created_at, prompt, response FROM instruction_examples), h AS (SELECT *, sha256(coalesce(prompt, '') || '||' || coalesce(response, '')) AS pair_hash FROM e) SELECT id, pair_hash, row_number() OVER (PARTITION BY pair_hash ORDER BY id) > 1 AS duplicate FROM h",
        "pending_ids": "SELECT doc_id, source FROM fuzzy_docs f WHERE NOT EXISTS (SELECT 1 FROM wet_records w WHERE w.doc_id = f.doc_id AND w.text IS NOT NULL)",
        "newest_meta": "SELECT doc_id, domain, content_type FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY enriched_at DESC NULLS LAST, domain DESC NULLS LAST, content_type DESC NULLS LAST) AS i FROM enriched_meta) WHERE i = 1",
        "latest_captures": "SELECT url, day AS capture_ts, capture_id FROM (SELECT url, substr(capture_ts, 1, 8) AS day, capture_id, row_number() OVER (PARTITION BY url ORDER BY substr(capture_ts, 1, 8) DESC, capture_id) AS i FROM page_fetches WHERE capture_ts IS NOT NULL AND url IS NOT NULL) WHERE i = 1",
        "shard_documents": "SELECT shard_name, count(*) AS listed, count(e.doc_id) AS found FROM (SELECT DISTINCT doc_id, shard_name FROM enriched_meta) m LEFT JOIN (SELECT DISTINCT doc_id FROM extracted_docs) e USING (doc_id) GROUP BY 1",
        "run_stats": f"SELECT *, round_even(coalesce(docs_kept / nullif(docs_seen, 0)::DOUBLE, 0), 4) AS keep_ratio, round_even(coalesce(chars_kept / nullif(docs_kept, 0)::DOUBLE, 0), 1) AS avg_chars_kept, floor(chars_kept / 2.55::DOUBLE)::BIGINT AS token_estimate FROM (SELECT run_id, {_RUN} FROM ({decided()}) GROUP BY 1)",
        "domain_yield": f"SELECT domain, {_RUN} FROM ({decided()}) WHERE domain IS NOT NULL GROUP BY 1",
        "reject_reasons": f"SELECT reason2 AS reason, count(*) AS n FROM ({decided()}) WHERE NOT keep2 GROUP BY 1",
        "lid_histogram": f"SELECT {_bucket('lid_score', _LID_BINS)} AS bucket, count(*) AS n FROM wet_records WHERE lid_score > 0 GROUP BY 1",
        "length_histogram": f"SELECT {_bucket('length(text)', _LENGTH_BINS)} AS bucket, count(*) AS n FROM documents WHERE text IS NOT NULL GROUP BY 1",
        "top_domains": "SELECT domain, count(*) AS n FROM wet_records WHERE domain IS NOT NULL GROUP BY 1 ORDER BY n DESC, domain LIMIT 20",
        "combined_reasons": "SELECT key, sum(n)::BIGINT AS n FROM (SELECT unnest(map_keys(reject_reasons)) AS key, unnest(map_values(reject_reasons)) AS n FROM run_reports) GROUP BY 1",
        "combined_histogram": "SELECT key, sum(n)::BIGINT AS n FROM (SELECT unnest(map_keys(lid_score_histogram)) AS key, unnest(map_values(lid_score_histogram)) AS n FROM run_reports) GROUP BY 1",
        "combined_domains": "SELECT domain, docs FROM (SELECT d.domain AS domain, sum(d.docs)::BIGINT AS docs FROM (SELECT unnest(top_domains_kept) AS d FROM run_reports) GROUP BY 1) ORDER BY docs DESC, domain LIMIT 30",
        "combined_reports": f"""
            WITH r AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY run_id, docs_seen, docs_kept, token_estimate_total) AS i FROM run_reports) WHERE i = 1)
            SELECT count(*) AS reports, count(DISTINCT run_id) AS runs, {', '.join(f'coalesce(sum({c}), 0)::BIGINT AS {c}' for c in reports)},
              round_even(coalesce(sum(avg_doc_chars_kept * docs_kept) / nullif(sum(docs_kept) FILTER (avg_doc_chars_kept IS NOT NULL), 0), 0), 1) AS avg_doc_chars_kept, count(DISTINCT config_fingerprint) AS configs, count(DISTINCT config_fingerprint) <= 1 AS config_consistent FROM r""",
        "dataset_index": f"SELECT 'pretrain' AS dataset, run_id, source, filename AS shard_name, 'corpus/v1/' || source || '/shards/run_id=' || run_id || '/' || filename AS s3_key, bytes, records_count AS records, token_estimate, sha256(filename) AS checksum_sha256 FROM ({INDEX}) WHERE source IN {_PRETRAIN}",
        "dataset_stats": f"""
            SELECT CASE WHEN grouping(source, run_id) = 3 THEN 'all' WHEN grouping(source, run_id) = 1 THEN 'source' ELSE 'run' END AS level, source, run_id, count(*) AS shards, sum(bytes)::BIGINT AS bytes, sum(records_count)::BIGINT AS records, sum(token_estimate)::BIGINT AS tokens
            FROM ({INDEX}) WHERE source IN {_PRETRAIN} GROUP BY GROUPING SETS ((), (source), (run_id))""",
        "token_ratio_percentiles": """
            SELECT content_type, n, round_even(s[1], 4) AS min, round_even(s[n * 5 // 100 + 1], 4) AS p5, round_even(s[n // 4 + 1], 4) AS p25, round_even(s[n // 2 + 1], 4) AS median, round_even(s[n * 3 // 4 + 1], 4) AS p75, round_even(s[n * 95 // 100 + 1], 4) AS p95, round_even(s[n], 4) AS max, round_even(list_avg(s), 4) AS mean
            FROM (SELECT content_type, count(*) AS n, list_sort(list(char_count / token_count::DOUBLE)) AS s FROM enriched_meta WHERE token_count > 0 AND content_type IS NOT NULL AND char_count IS NOT NULL GROUP BY 1)""",
        "threshold_yields": "SELECT t.threshold::DOUBLE AS threshold, count(*) AS docs, count(*) FILTER (lang IN ('kin_Latn', 'rw') AND lid_score >= t.threshold) AS kept, round_even(count(*) FILTER (lang IN ('kin_Latn', 'rw') AND lid_score >= t.threshold) / count(*)::DOUBLE, 6) AS yield FROM wet_records, (VALUES (0.5), (0.65), (0.8)) t(threshold) GROUP BY 1",
        "keep_precision": f"SELECT *, round_even(coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0), 4) AS precision, round_even(coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0), 4) AS recall, round_even(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0), 4) AS f1 FROM (SELECT count(*) FILTER (keep2 AND keep) AS tp, count(*) FILTER (keep2 AND NOT coalesce(keep, false)) AS fp, count(*) FILTER (NOT keep2 AND keep) AS fn, count(*) FILTER (NOT keep2 AND NOT coalesce(keep, false)) AS tn FROM ({decided()}))",
        "task_counts": "SELECT task_type, count(*) AS n, count(DISTINCT id) AS ids FROM instruction_examples GROUP BY 1",
        "enriched_documents": f"""
            SELECT DISTINCT doc_id, floor(length(text) / {2.55}::DOUBLE)::BIGINT AS token_count, length(text) AS char_count, d AS domain, {_type('source', 'd')} AS content_type, greatest(0.0::DOUBLE, least(1.0::DOUBLE, coalesce(lid_score, 0))) AS quality_score
            FROM (SELECT *, {domain("coalesce(url, '')")} AS d FROM wet_records) WHERE {strip('text')} <> ''""",
        "splits": f"SELECT key, {_split('key')} AS split FROM (SELECT doc_id::VARCHAR AS key FROM documents)",
        "majority_types": _TYPES,
        "mixed_selection": _mixed(),
        "stratified_sample": """
            WITH x AS (SELECT doc_id, domain, sha256('sample:' || doc_id) AS h FROM documents WHERE domain IS NOT NULL), q AS (SELECT domain, greatest(1, round(200 * count(*) / (SELECT count(*) FROM x)::DOUBLE))::INT AS quota FROM x GROUP BY 1),
            r AS (SELECT x.*, row_number() OVER (PARTITION BY domain ORDER BY h, doc_id) AS i FROM x) SELECT doc_id, domain FROM r JOIN q USING (domain) WHERE i <= quota ORDER BY h, doc_id LIMIT 200""",
        "interleaved_domains": """
            WITH r AS (SELECT doc_id, domain, row_number() OVER (PARTITION BY domain ORDER BY doc_id) AS i, min(doc_id) OVER (PARTITION BY domain) AS f FROM documents WHERE domain IS NOT NULL)
            SELECT doc_id, domain, i::INT AS turn FROM r WHERE i <= 5 ORDER BY i, f LIMIT 300""",
        "seeded_top": f"SELECT doc_id, sha256('{SPLIT_SEED}:' || doc_id) AS place FROM documents ORDER BY place LIMIT 100",
        "index_verification": f"""
            WITH i AS (SELECT 'corpus/v1/' || source || '/shards/run_id=' || run_id || '/' || filename AS s3_key, ('0x' || substr(sha256(filename), 1, 6))::BIGINT AS x FROM ({INDEX}) WHERE source IN {_PRETRAIN})
            SELECT s3_key, CASE WHEN x % 7 = 0 THEN 'missing' ELSE 'size_mismatch' END AS state FROM i WHERE x % 7 = 0 OR x % 5 = 0""",
        "dead_letters": "SELECT channel, error AS reason, NOT regexp_matches(error, '^http_4|content_type') AS retryable, count(DISTINCT capture_id) AS n FROM page_fetches WHERE NOT ok GROUP BY ALL",
        "all_sources": "SELECT source, count(*) AS n, coalesce(sum(length(text)), 0)::BIGINT AS chars FROM (SELECT source, text FROM wet_records UNION ALL SELECT source, text FROM extracted_docs UNION ALL SELECT source, text FROM documents) GROUP BY 1",
        "prompts_of_templates": "SELECT '[' || lang || '] ' || subject || '?' AS prompt, subject FROM (SELECT DISTINCT lang FROM subject_reference), (SELECT DISTINCT subject FROM subject_reference)",
        "dedup_report": f"SELECT * FROM ({_dedup('SELECT doc_id, source, row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1 AS kept FROM documents WHERE text IS NOT NULL')})",
        "latest_events": "SELECT user_id, ts, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS i FROM events) WHERE i = 1",
        "first_events": "SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS i FROM events) WHERE i = 1",
        "confidence_needed": "SELECT CASE WHEN length(text) < 300 THEN 0.95 WHEN length(text) < 500 THEN 0.9 WHEN length(text) < 1000 THEN 0.85 ELSE 0.7 END::DOUBLE AS confidence, count(*) AS n FROM documents GROUP BY 1",
        "event_windows": "SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n, sum(value::DECIMAL(18, 4)) AS value FROM events GROUP BY ALL",
        "streamed_keep": f"SELECT sha256(t) AS sha256, 1 AS times FROM ({decided()}) WHERE keep2 GROUP BY 1",
        "normalized_text": f"SELECT doc_id, sha256(t) AS sha256, length(t) AS chars FROM (SELECT doc_id, {_normal('text')} AS t FROM documents)",
        "identified_languages": f"WITH {_words_model('SELECT doc_id, text FROM documents WHERE text IS NOT NULL', 'doc_id')} SELECT doc_id, lang, score, lang_2, score_2, gap FROM said",
        "instruction_languages": f"""
            WITH {_words_model('SELECT row_number() OVER (ORDER BY id, text) AS rid, text FROM (SELECT DISTINCT id, response AS text FROM instruction_examples WHERE response IS NOT NULL)', 'rid')}
            SELECT CASE WHEN lang = 'kin_Latn' THEN '' ELSE 'reject.not_rw' END AS reason, lang = 'zxx_Latn' OR (score < 0.3 AND lang <> 'kin_Latn') AS garbled, count(*) AS n FROM said GROUP BY ALL""",
        "identifier_gate": f"""
            WITH {_words_model('SELECT ref_id, text FROM subject_reference WHERE text IS NOT NULL', 'ref_id')},
            g AS (SELECT s.*, f.lang AS truth FROM said s JOIN subject_reference f USING (ref_id) WHERE coalesce(f.lang, '') <> ''),
            n AS (SELECT count(*) FILTER (lang = 'kin_Latn' AND truth = 'kin_Latn') AS tp, count(*) FILTER (lang = 'kin_Latn' AND truth <> 'kin_Latn') AS fp, count(*) FILTER (lang <> 'kin_Latn' AND truth = 'kin_Latn') AS fn, count(*) FILTER (lang <> 'kin_Latn' AND truth <> 'kin_Latn') AS tn,
              count(*) AS labeled, count(*) FILTER (lang_2 = 'run_Latn') AS second, avg(gap) FILTER (lang_2 = 'run_Latn') AS g, count(*) FILTER (truth = 'run_Latn') AS neighbours FROM g)
            SELECT tp, fp, fn, tn, round_even(coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0), 4) AS precision, round_even(coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0), 4) AS recall, round_even(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0), 4) AS f1,
              labeled, round_even(second / labeled::DOUBLE, 4) AS second_rate, round_even(coalesce(g, 0), 4) AS mean_gap, neighbours, CASE WHEN neighbours > labeled * 0.05 THEN 'INCLUDE' ELSE 'EXCLUDE' END AS suggestion FROM n""",
        "run_reports_built": f"""
            WITH d AS (SELECT *, keep2 AS k, reason2 AS r, {_bucket('coalesce(lid_score, 0)', _LID_BINS)} AS lb, {_bucket('n', _LENGTH_BINS)} AS cb FROM ({decided()})),
            base AS (SELECT run_id, count(*) AS docs_seen, count(*) FILTER (k) AS docs_kept, round_even(coalesce(sum(n) FILTER (k) / nullif(count(*) FILTER (k), 0)::DOUBLE, 0), 1) AS avg_chars_kept FROM d GROUP BY 1),
            a AS (SELECT run_id, string_agg(r || '=' || n, ',' ORDER BY r) AS v FROM (SELECT run_id, r, count(*) AS n FROM d WHERE NOT k GROUP BY ALL) GROUP BY 1),
            b AS (SELECT run_id, string_agg(lb || '=' || n, ',' ORDER BY lb) AS v FROM (SELECT run_id, lb, count(*) AS n FROM d WHERE k OR lid_score > 0 GROUP BY ALL) GROUP BY 1),
            c AS (SELECT run_id, string_agg(cb || '=' || n, ',' ORDER BY cb) AS v FROM (SELECT run_id, cb, count(*) AS n FROM d WHERE k GROUP BY ALL) GROUP BY 1),
            o AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY n DESC, domain) AS i FROM (SELECT run_id, domain, count(*) AS n FROM d WHERE k AND domain <> '' GROUP BY ALL)), t AS (SELECT run_id, string_agg(domain || '=' || n, ',' ORDER BY i) AS v FROM o WHERE i <= 20 GROUP BY 1)
            SELECT base.*, coalesce(a.v, '') AS reject_reasons, coalesce(b.v, '') AS lid_score_histogram, coalesce(c.v, '') AS doc_length_histogram, coalesce(t.v, '') AS top_domains_kept
            FROM base LEFT JOIN a USING (run_id) LEFT JOIN b USING (run_id) LEFT JOIN c USING (run_id) LEFT JOIN t USING (run_id)""",
        "import_reports": f"""
            WITH d AS ({decided()}) SELECT count(*) AS docs_seen, count(*) FILTER (keep2) AS docs_kept, coalesce(sum(n) FILTER (keep2), 0)::BIGINT AS total_kept_chars, round_even(count(*) FILTER (keep2) / count(*)::DOUBLE, 4) AS keep_rate,
              (SELECT string_agg(reason2 || '=' || n, ',' ORDER BY reason2) FROM (SELECT reason2, count(*) AS n FROM d WHERE NOT keep2 GROUP BY 1)) AS reject_reasons FROM d""",
        "harvest_stats": f"""
            SELECT source, count(*) AS total_processed, count(*) FILTER (keep2) AS kept, 0 AS duplicates, count(*) FILTER (reason2 = 'reject.lid.not_rw') AS lid_not_rw, count(*) FILTER (reason2 = 'reject.lid.low_confidence') AS lid_low_confidence,
              0 AS pdf_extraction_failed, 0 AS extraction_failed, count(*) FILTER (reason2 LIKE 'reject.filter.%') AS filter_rejections FROM ({decided()}) GROUP BY 1""",
        "yield_gate": f"""
            WITH d AS ({decided(_LOWEST)}), n AS (SELECT count(*) AS docs_seen, count(*) FILTER (lang IN ('kin_Latn', 'rw') AND reason2 <> 'reject.too_short') AS l, count(*) FILTER (keep2 AND lid_score >= 0.5) AS a, count(*) FILTER (keep2 AND lid_score >= 0.65) AS b, count(*) FILTER (keep2 AND lid_score >= 0.8) AS c FROM d),
            t AS (SELECT *, unnest([0.5, 0.65, 0.8]::DOUBLE[]) AS threshold, unnest([a, b, c]) AS kept, CASE WHEN b > 3 * c THEN 'THRESHOLD_TOO_STRICT' WHEN l < 50 THEN 'REAL_SCARCITY' ELSE 'MODERATE_SCARCITY' END AS decision FROM n)
            SELECT threshold, docs_seen, kept, round_even(kept / docs_seen::DOUBLE, 8) AS keep_rate, decision FROM t""",
        "labelled_scores": """
            SELECT n, round_even(s[1], 4) AS min, round_even(s[n // 4 + 1], 4) AS p25, round_even(s[n // 2 + 1], 4) AS median, round_even(s[n * 3 // 4 + 1], 4) AS p75, round_even(s[n], 4) AS max, round_even(list_avg(s), 4) AS mean
            FROM (SELECT count(*) AS n, list_sort(list(lid_score)) AS s FROM wet_records WHERE lang IN ('kin_Latn', 'rw') AND lid_score IS NOT NULL)""",
        "top_labels": "SELECT lang, count(*) AS n FROM wet_records WHERE lang IS NOT NULL GROUP BY 1 ORDER BY n DESC, lang LIMIT 20",
        "tokenizer_report": """
            WITH t AS (SELECT source, doc_id, CASE WHEN unicode(c) > 383 THEN 0 ELSE unicode(c) END AS id FROM (SELECT source, doc_id, unnest(string_split(text, '')) AS c FROM documents WHERE length(text) >= 50)),
            s AS (SELECT source, count(DISTINCT doc_id) AS docs_tokenized, count(*) AS n, count(*) FILTER (id = 0) AS u, count(DISTINCT id) AS k FROM t GROUP BY 1)
            SELECT source, docs_tokenized, n AS total_tokens, n AS total_chars, u AS total_unk_tokens, round(u / n::DOUBLE, 6) AS unk_rate, k AS unique_tokens_used, round(k / 384::DOUBLE, 4) AS vocab_coverage, floor(n / 2.55::DOUBLE)::BIGINT AS current_estimate_tokens, u / n::DOUBLE > 0.001 AS flagged FROM s""",
        "dataset_meta": f"""
            SELECT 'pretrain' AS dataset, 'v1' AS version, (SELECT string_agg(source, ',' ORDER BY source) FROM (SELECT DISTINCT source FROM ({INDEX}) WHERE source IN {_PRETRAIN})) AS sources, count(*) AS total_shards, sum(records_count)::BIGINT AS total_records,
              sum(token_estimate)::BIGINT AS total_token_estimate FROM ({INDEX}) WHERE source IN {_PRETRAIN}""",
        "near_duplicate_stats": "SELECT count(*) AS documents, 0.8::DOUBLE AS threshold, 128 AS num_perm FROM documents WHERE text IS NOT NULL",
        "fuzzy_checks": "SELECT count(*) AS documents, 0 AS kept_sharing, 0 AS dropped_without FROM documents WHERE text IS NOT NULL",
        "parallel_dedup": f"""
            WITH e AS (SELECT *, sha256({_normal("coalesce(prompt, '')")} || '||' || {_normal("coalesce(response, '')")}) AS h FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY created_at NULLS FIRST, prompt NULLS FIRST, response NULLS FIRST) AS i FROM instruction_examples WHERE id IS NOT NULL) WHERE i = 1)
            SELECT count(*) AS pairs, count(*) - count(DISTINCT h) AS repeated, 0 AS repeated_accepted, count(DISTINCT h) AS kinds FROM e""",
        "discovered_classes": f"SELECT {_portal_kind()} AS url_class, count(*) AS n FROM (SELECT DISTINCT url FROM extracted_docs WHERE url IS NOT NULL) GROUP BY 1",
        "report_tops": """
            SELECT run_id, key, n FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY n DESC, key) AS i FROM (SELECT run_id, key, max(n) AS n FROM (SELECT run_id, unnest(map_keys(reject_reasons)) AS key, unnest(map_values(reject_reasons)) AS n FROM run_reports) GROUP BY ALL)) WHERE i <= 10""",
        "run_ages": """
            WITH r AS (SELECT DISTINCT run_id, started_at, bytes_written AS b, epoch(TIMESTAMPTZ '2026-01-01 00:00:00+00') - epoch(try_cast(started_at AS TIMESTAMPTZ)) AS s FROM run_reports)
            SELECT run_id, CASE WHEN coalesce(started_at, '') = '' THEN '—' WHEN s IS NULL THEN started_at WHEN s < 3600 THEN trunc(s / 60)::BIGINT || 'm ago' WHEN s < 86400 THEN printf('%.1f', round_even(s / 3600, 1)) || 'h ago' ELSE floor(s / 86400)::BIGINT || 'd ago' END AS age,
              CASE WHEN b < 1024 THEN b || ' B' WHEN b < 1048576 THEN printf('%.1f', round_even(b / 1024::DOUBLE, 1)) || ' KB' ELSE printf('%.1f', round_even(b / 1048576::DOUBLE, 1)) || ' MB' END AS written FROM r""",
        "capped_sides": """
            WITH RECURSIVE e AS (SELECT *, row_number() OVER (PARTITION BY prompt, response ORDER BY id) > 1 AS again, row_number() OVER (ORDER BY id) AS n FROM (
              SELECT *, row_number() OVER (PARTITION BY id ORDER BY prompt, response) AS i FROM instruction_examples WHERE prompt IS NOT NULL AND response IS NOT NULL) WHERE i = 1),
            r AS (SELECT 0::BIGINT AS n, NULL::VARCHAR AS id, false AS accepted, MAP {}::MAP(VARCHAR, INT) AS p, MAP {}::MAP(VARCHAR, INT) AS q
              UNION ALL SELECT n, id, ok, CASE WHEN ok THEN map_concat(p, MAP {prompt: a + 1}) ELSE p END, CASE WHEN ok THEN map_concat(q, MAP {response: b + 1}) ELSE q END
              FROM (SELECT e.n, e.id, e.prompt, e.response, r.p, r.q, coalesce(r.p[e.prompt], 0) AS a, coalesce(r.q[e.response], 0) AS b, NOT e.again AND coalesce(r.p[e.prompt], 0) < 2 AND coalesce(r.q[e.response], 0) < 2 AS ok FROM r JOIN e ON e.n = r.n + 1))
            SELECT id, accepted FROM r WHERE n > 0""",
        "language_sections": f"""
            WITH par AS (SELECT doc_id, list_filter([{strip('x')} for x in regexp_split_to_array(text, '\\n\\s*\\n')], lambda x: x <> '') AS p FROM documents WHERE doc_id IS NOT NULL),
            red AS (SELECT doc_id, list_reduce([{{'done': []::VARCHAR[], 'now': x, 'held': length(x)}} for x in p], lambda a, x: CASE WHEN a.held + x.held >= 2000
                THEN {{'done': list_append(a.done, CASE WHEN a.now = '' THEN x.now ELSE a.now || chr(10) || chr(10) || x.now END), 'now': '', 'held': 0::BIGINT}}
                ELSE {{'done': a.done, 'now': CASE WHEN a.now = '' THEN x.now ELSE a.now || chr(10) || chr(10) || x.now END, 'held': a.held + x.held}} END, {{'done': []::VARCHAR[], 'now': '', 'held': 0::BIGINT}}) AS r FROM par WHERE len(p) > 0),
            blk AS (SELECT doc_id, list_filter(list_append(r.done, r.now), lambda b: length(b) >= 50) AS b FROM red), each AS (SELECT doc_id, unnest(b) AS text, unnest(range(len(b))) AS pos FROM blk),
            {_words_model("SELECT doc_id || '/' || pos AS rid, text FROM each", 'rid')},
            kept AS (SELECT doc_id, sum(length(text)) AS n, count(*) AS c FROM each JOIN said ON said.rid = doc_id || '/' || pos WHERE lang = 'kin_Latn' AND score >= 0.8 GROUP BY 1)
            SELECT o.doc_id, CASE WHEN n >= 200 THEN (n + 2 * (c - 1))::BIGINT END AS chars FROM documents o LEFT JOIN kept USING (doc_id) WHERE o.doc_id IS NOT NULL""",
        "first_of_prompts": f"""
            SELECT DISTINCT id, sha256(CASE WHEN {strip("coalesce(response, '')")} <> '' THEN response WHEN {strip("coalesce(prompt, '')")} <> '' THEN prompt ELSE '' END) AS "first", floor((coalesce(length(response), 0) + coalesce(length(prompt), 0)) / 2.55::DOUBLE)::BIGINT AS tokens
            FROM instruction_examples WHERE id IS NOT NULL""",
        "portal_paths": f"""
            SELECT regexp_matches(lower({path('url')}), '^(?:/en/|/fr/|/index\\.php/)') OR regexp_replace(lower({path('url')}), '/+$', '') IN ('/1/servisi-kuri-murandasi', '/servisi-kuri-murandasi', '/online-services', '/en/online-services') AS portal,
              {_ends(f"lower({path('url')})", _STATIC)} OR starts_with(lower({path('url')}), '/amakuru') AS site, count(*) AS n FROM (SELECT DISTINCT url FROM extracted_docs WHERE url IS NOT NULL) GROUP BY ALL""",
        "wiki_addresses": "SELECT DISTINCT 'https://w.example/wiki/' || replace(title, ' ', '_') AS url FROM extracted_docs WHERE title IS NOT NULL",
        "mixed_splits": f"SELECT s3_key, {_split('s3_key', (0.98, 0.01, 0.01))} AS split FROM ({_mixed()})",
        "mixed_by_records": f"SELECT s3_key, content_type, token_estimate AS records FROM ({_mixed('records_count')})",
        "language_pairs": r"""
            WITH p AS (SELECT DISTINCT capture_id, url FROM page_fetches WHERE ok AND url IS NOT NULL)
            SELECT capture_id, CASE WHEN capture_id % 3 = 0 THEN regexp_replace(url, '^([a-z]+://[^/]+)/', '\1/rw/') ELSE regexp_replace(url, '#.*$', '') || '?lang=rw' END AS url_rw, CASE WHEN capture_id % 3 = 0 THEN regexp_replace(url, '^([a-z]+://[^/]+)/', '\1/en/') ELSE regexp_replace(url, '#.*$', '') || '?lang=en' END AS url_en,
              CASE WHEN capture_id % 3 = 0 THEN 0.5 ELSE 0.4 END::DOUBLE AS confidence, 'url_pattern' AS method FROM p WHERE capture_id % 3 < 2""".replace("\\\\1", "\\1"),
        "frontier": f"""
            WITH u AS (SELECT DISTINCT CASE WHEN {_scheme('v')} IN ('http', 'https') AND {host('v')} <> '' THEN {_scheme('v')} || '://' || lower({NETLOC.format(u='v')}) || CASE WHEN rest = '' THEN '/' WHEN rest LIKE '?%' THEN '/' || rest ELSE rest END END AS url
              FROM (SELECT regexp_replace(trim(url), '#.*$', '') AS v, regexp_extract(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(.*)$', 1) AS rest FROM extracted_docs)),
            r AS (SELECT url, row_number() OVER (PARTITION BY {domain('url')} ORDER BY url) AS n FROM u WHERE url IS NOT NULL)
            SELECT url, length(bin(n)) - 1 AS depth FROM r""",
        "packed_sequences": """
            WITH RECURSIVE d AS (SELECT concat_ws('-', coalesce(source, 'none'), floor(doc_id / 5000)::BIGINT) AS shard, row_number() OVER (PARTITION BY coalesce(source, 'none'), floor(doc_id / 5000) ORDER BY doc_id) AS i, length(text) AS n, text FROM documents WHERE length(text) > 0),
            o AS (SELECT shard, i, 0::BIGINT AS at, n::BIGINT AS upto FROM d WHERE i = 1 UNION ALL SELECT d.shard, d.i, o.upto + CASE WHEN o.upto % 4096 > 0 THEN 1 ELSE 0 END, o.upto + CASE WHEN o.upto % 4096 > 0 THEN 1 ELSE 0 END + d.n FROM o JOIN d ON d.shard = o.shard AND d.i = o.i + 1),
            c AS (SELECT o.shard, o.at + unnest(range(length(text))) AS place, unicode(unnest(string_split(text, ''))) AS code FROM o JOIN d USING (shard, i)), e AS (SELECT shard, max(upto) AS total FROM o GROUP BY 1)
            SELECT shard, place // 4096 AS seq_no, max(least(4096, total - 4096 * (place // 4096)))::INT AS length, sum(code)::BIGINT AS checksum FROM c JOIN e USING (shard) GROUP BY ALL""",
    }
    from . import file_sql

    return own | file_sql.oracle_sql()
