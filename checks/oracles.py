"""The same queries as plain SQL for DuckDB, worked out from the tables directly."""

from __future__ import annotations

from checks import standins as st
from vitarium import fixed

WS = fixed.WHITESPACE
SITE = st.SITE.lower()
BIO = f"{SITE}/Search/Type,Biography/bio/"


def norm(x: str) -> str:
    return f"trim(regexp_replace(coalesce({x}, ''), '{WS}+', ' ', 'g'))"


def plain(x: str) -> str:
    return f"trim(regexp_replace(replace(strip_accents(lower({x})), 'ł', 'l'), '[^a-z0-9-]+', ' ', 'g'))"


def pieces(x: str) -> str:
    return (f"[y for y in [regexp_replace(x, '^{WS}+|{WS}+$', '', 'g') "
            f"for x in string_split_regex(coalesce({x}, ''), '[|;,]')] if y <> '']")


def unescaped(x: str) -> str:
    for name, char in [("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")]:
        x = f"replace({x}, '{name}', '{char}')"
    return x


def encoded(x: str) -> str:
    return f"array_to_string([CASE WHEN unicode(c) > 127 THEN url_encode(c) ELSE c END for c in string_split({x}, '')], '')"


KEY = f"lower({norm('coalesce(nullif(url, $$$$), nullif(biography_url, $$$$), name)')})"
LOG = f"log AS ({st.for_duckdb(st.RECORD_LOG)}), keyed AS (SELECT *, {KEY} AS record_key FROM log)"
DETAILS = "(coalesce(biography_text, '') <> '' OR coalesce(biography_error, '') <> '')"
PROGRESS = f"progress AS ({st.for_duckdb(st.PROGRESS)})"
STATE = f"""{PROGRESS}, state AS (
    SELECT index_url, arg_max(page, seq) AS page, arg_max(total_pages, seq) AS total_pages,
           arg_max(completed, seq) AS completed, arg_max(html, seq) AS html,
           arg_max_null(page, seq) AS last_page, arg_max_null(updated_at, seq) AS updated_at
    FROM progress GROUP BY index_url)"""
NAV = """nav AS (
    SELECT page_id, regexp_extract(url, '^https?://[^/]+') AS origin,
           regexp_extract_all(regexp_extract(html, '<nav>.*?</nav>'), '<a href="([^"]*)"', 1) AS hrefs FROM pages),
    links AS (SELECT page_id, origin, unnest(hrefs) AS href, CAST(unnest(range(len(hrefs))) AS INT) AS pos FROM nav),
    resolved AS (SELECT page_id, pos, origin || """ + encoded("href") + """ AS link FROM links)"""



def to_three_digits(x: str) -> str:
    """Half up on the exact double: down from round() if that went past the half-way point."""
    n = f"round(round({x}, 3) * 1000)"
    head = f"CAST(CAST({x} AS FLOAT) AS DOUBLE)"
    return f"(({n} - CASE WHEN ({head} * 2000 - ({n} * 2 - 1)) + ({x} - {head}) * 2000 < 0 THEN 1 ELSE 0 END) / 1000)"


# --- occupations: brute force over all pairs ----------------------------------
MODEL = f"""seeds AS ({st.for_duckdb(st.SEEDS)}),
    aliases AS (SELECT seed_pos, qid, label, unnest(aliases) AS raw, CAST(unnest(range(len(aliases))) AS INT) AS alias_pos
                FROM seeds),
    model AS (SELECT *, string_split(alias, ' ') AS words
              FROM (SELECT seed_pos, qid, label, alias_pos, {plain('raw')} AS alias FROM aliases))"""


def built_in_model() -> str:
    rows = ", ".join(
        "({}, '{}', '{}', '{}')".format(pos, qid, label, alias)
        for pos, (qid, label, aliases) in enumerate(fixed.OCCUPATIONS) for alias in aliases)
    return f"""given(seed_pos, qid, label, raw) AS (VALUES {rows}),
    model AS (SELECT *, string_split(alias, ' ') AS words
              FROM (SELECT seed_pos, qid, label, {plain('raw')} AS alias FROM given))"""


def linking(source: str, record_id: str, activity: str, threshold: float) -> str:
    """CTEs from a table of records to ranked suggestions."""
    return f"""cut AS (SELECT {record_id}, {pieces(activity)} AS parts FROM {source}),
    numbered AS (SELECT {record_id}, unnest(parts) AS piece, unnest(range(len(parts))) AS pos FROM cut),
    pieces AS (SELECT {record_id}, piece, min(pos) AS pos, {plain('piece')} AS text FROM numbered GROUP BY ALL),
    texts AS (SELECT DISTINCT text, string_split(text, ' ') AS have FROM pieces WHERE text <> ''),
    raw_pairs AS (
        SELECT text, seed_pos, qid, label, CASE
            WHEN text = alias THEN 1.0
            WHEN contains(text, alias) OR contains(alias, text)
                THEN 0.75 + (0.2::DOUBLE * least(length(text), length(alias))) / greatest(length(text), length(alias))
            WHEN len([w for w in words if list_contains(have, w)]) > 0
                THEN 0.45 + 0.35::DOUBLE * (len([w for w in words if list_contains(have, w)]) / len(words))
            ELSE 0 END AS score
        FROM texts, model),
    pairs AS (SELECT text, seed_pos, qid, label, {to_three_digits('score')} AS score FROM raw_pairs),
    scored AS (SELECT text, seed_pos, qid, label, max(score) AS confidence FROM pairs GROUP BY ALL),
    matches AS (SELECT text, qid, min(seed_pos) AS seed_pos, arg_min(label, seed_pos) AS label,
                       arg_min(confidence, seed_pos) AS confidence
                FROM scored WHERE confidence >= {threshold} GROUP BY text, qid),
    suggestions AS (
        SELECT {record_id}, CAST(row_number() OVER (PARTITION BY {record_id}
                   ORDER BY confidence DESC, label COLLATE pl, pos, seed_pos) AS INT) AS rank,
               piece AS source_activity, qid AS occupation_qid, label AS occupation_label, confidence
        FROM pieces JOIN matches USING (text))"""


LINKABLE = f"linkable AS ({st.for_duckdb(st.LINKABLE)})"
SUGGESTED = f"{LINKABLE}, {MODEL}, {linking('linkable', 'id', 'activity', 0.7)}"
STATED = f"""{SUGGESTED}, stated AS (
    SELECT id, rank, coalesce(nullif(name, ''), nullif(biography_name, ''), '') AS name, coalesce(activity, '') AS activity,
           coalesce(wikidata_qid, '') AS item_qid,
           coalesce(nullif(url, ''), nullif(biography_url, ''), '') AS source_url,
           source_activity, occupation_qid, occupation_label, confidence, 'P106' AS property,
           'P854' AS reference_property, coalesce(nullif(url, ''), nullif(biography_url, ''), '') AS reference_url
    FROM suggestions JOIN linkable USING (id))"""

# --- what the derived pages say ------------------------------------------------
CARDS = f"""cards AS (
    SELECT doc_id AS page_seq, 0 AS card_pos, '{BIO}' || doc_id AS url, 'Doc ' || source || ' & ' || lang AS name,
           n_chars || '-' AS dates, lang || ' | ' || source AS activity FROM documents
    UNION ALL SELECT doc_id, 1, '{BIO}' || (doc_id + 1), 'next', '', '' FROM documents
    UNION ALL SELECT doc_id, 2, '', '', 'x', '' FROM documents)"""
DETAIL = f"""detail AS (
    SELECT '{BIO}' || doc_id AS biography_url, lang,
           CASE WHEN lang = 'de' THEN 'Title "' || doc_id || '"' ELSE lang || ' ' || source END AS biography_name,
           CAST(n_chars AS VARCHAR) AS biography_birth_date, CAST(doc_id AS VARCHAR) AS biography_death_date,
           source || ' | ' || lang AS biography_activities, {norm('text')} AS biography_text FROM documents)"""
ANSWERED = f"""{DETAIL}, answered AS (
    SELECT biography_url, CASE WHEN lang <> 'es' THEN biography_name END AS biography_name,
           CASE WHEN lang <> 'es' THEN biography_birth_date END AS biography_birth_date,
           CASE WHEN lang <> 'es' THEN biography_death_date END AS biography_death_date,
           CASE WHEN lang <> 'es' THEN biography_activities END AS biography_activities,
           CASE WHEN lang <> 'es' THEN biography_text END AS biography_text,
           CASE WHEN lang = 'es' THEN 'HTTP 404 for ' || biography_url END AS biography_error
    FROM detail)"""
PEOPLE = f"""{CARDS}, people AS (
    SELECT lower(url) AS record_key, url, arg_max(name, page_seq) AS name, arg_max(dates, page_seq) AS dates,
           arg_max(activity, page_seq) AS activity
    FROM cards WHERE url <> '' GROUP BY url)"""

FIRST_SEEN = f"""{CARDS}, {ANSWERED}, first_seen AS (
    SELECT lower(url) AS record_key, url, name, page_seq, batch_id FROM (
        SELECT *, row_number() OVER (PARTITION BY url ORDER BY batch_id, page_seq, card_pos) AS rn FROM (
            SELECT cards.*, CASE WHEN lang <> 'en' THEN 0 ELSE 1 END AS batch_id FROM cards JOIN documents ON doc_id = page_seq
            WHERE url <> '')) WHERE rn = 1)"""

# --- a log of two batches --------------------------------------------------------
TWO_BATCHES = f"""{LOG}, rows AS (
    SELECT record_key, ingest_seq AS page_seq, 0 AS stage, name, dates, biography_text FROM keyed WHERE record_key <> ''
    UNION ALL
    SELECT record_key, ingest_seq, 1, name, NULL, 'again ' || ingest_seq FROM keyed
    WHERE record_key <> '' AND url IS NOT NULL)"""

MERGED_LOG = f"""WITH {LOG} SELECT record_key, {', '.join(f'arg_max({c}, ingest_seq) AS {c}' for c in st.LOG_COLUMNS)},
        min(ingest_seq) AS first_seq FROM keyed WHERE record_key <> '' GROUP BY record_key"""

ORACLES = {
    "normalize_text": f"SELECT doc_id, {norm('text')} AS clean FROM documents",
    "match_key": f"SELECT doc_id, {plain('text')} AS key FROM documents",
    "split_activities": f"""WITH cut AS (SELECT doc_id, {pieces('text')} AS parts FROM documents)
        SELECT doc_id, CAST(unnest(range(len(parts))) AS INT) AS pos, unnest(parts) AS piece FROM cut""",
    "join_labels": """SELECT p_partkey, concat_ws(' | ', p_type, p_brand, p_name, p_type) AS every,
        concat_ws(' | ', p_type, p_brand, p_name) AS once FROM part""",
    "leading_int": r"""SELECT o_orderkey,
        TRY_CAST(regexp_extract(o_orderpriority, '^\s*([+-]?[0-9]+)', 1) AS BIGINT) AS level,
        TRY_CAST(regexp_extract(o_orderstatus, '^\s*([+-]?[0-9]+)', 1) AS BIGINT) AS none FROM orders""",
    "absolute_url": f"WITH {NAV} SELECT page_id, pos, link AS resolved FROM resolved",
    "record_key": f"WITH {LOG} SELECT ingest_seq, record_key FROM keyed",
    "index_urls": f"""WITH e AS (SELECT p_partkey, replace(url_encode(p_brand || ' ż(' || p_name), '%28', '(') AS enc FROM part)
        SELECT p_partkey, '{st.SITE}/x/Initial,' || enc || '/Initial,B' AS swapped,
               'https://h.example/Search/Type,Biography/Initial,' || enc || '/' AS built FROM e""",
    "page_title": f"""SELECT page_id, {norm(unescaped("regexp_extract(html, '<title>(.*?)</title>', 1, 's')"))} AS title,
        {norm(unescaped("regexp_extract(html, '<article><h1>(.*?)</h1>', 1, 's')"))} AS h1 FROM pages""",
    "page_name_fallback": f"""SELECT page_id, coalesce(
        nullif({norm(unescaped("regexp_extract(html, '<div class=.ad.>(.*?)</div>', 1, 's')"))}, ''),
        {norm(unescaped("regexp_extract(html, '<title>(.*?)</title>', 1, 's')"))}) AS name FROM pages""",
    "nav_links": f"""WITH {NAV}, firsts AS (SELECT page_id, link, min(pos) AS pos FROM resolved GROUP BY page_id, link)
        SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY pos) - 1 AS INT) AS link_pos, link
        FROM firsts""",
    "index_links": f"""SELECT doc_id AS page_seq, 0 AS link_pos,
            '{SITE}/Search/Type,Biography/Initial,' || lang || '/' AS index_url FROM documents
        UNION ALL SELECT doc_id, 1, '{SITE}/Search/Type,Biography/Initial,B/' FROM documents""",
    "listing_cards": f"WITH {CARDS} SELECT * FROM cards",
    "detail_fields": f"""WITH {DETAIL} SELECT biography_url, biography_name, biography_birth_date,
        biography_death_date, biography_activities, biography_text, CAST(NULL AS VARCHAR) AS biography_error FROM detail""",
    "pager_summary": """SELECT doc_id AS page_seq, greatest(doc_id + 1, 7) AS total_pages, doc_id AS current_page
        FROM documents""",
    "pager_links": """WITH links AS (
            SELECT doc_id AS page_seq, doc_id + 1 AS page_no, false AS is_next, 'pg_' || (doc_id + 1) AS dom_id
            FROM documents WHERE doc_id + 1 <> 7
            UNION ALL SELECT doc_id, 7, false, 'pg_seven' FROM documents
            UNION ALL SELECT doc_id, NULL, true, 'pg_next' FROM documents)
        SELECT *, replace(dom_id, '_', '$') AS target FROM links""",
    "merge_records": MERGED_LOG,
    "compact_latest": f"""WITH {LOG} SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY record_key ORDER BY ingest_seq DESC) AS rn,
                   min(ingest_seq) OVER (PARTITION BY record_key) AS first_seq
            FROM keyed WHERE record_key <> '') WHERE rn = 1""",
    "new_records_only": """SELECT 'Customer#' || o_custkey AS name, min(o_orderkey) AS o_orderkey,
            arg_min(o_totalprice, o_orderkey) AS o_totalprice, 'customer#' || o_custkey AS record_key
        FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) GROUP BY o_custkey""",
    "log_progress": f"""WITH {LOG} SELECT count(DISTINCT nullif(record_key, '')) AS known_keys,
        count(DISTINCT CASE WHEN {DETAILS} THEN nullif(url, '') END) AS enriched_urls, count(*) AS row_count FROM keyed""",
    "detail_frontier": f"""WITH {LOG}, firsts AS (
            SELECT *, row_number() OVER (PARTITION BY url ORDER BY ingest_seq) AS rn,
                   bool_or({DETAILS}) OVER (PARTITION BY url) AS done
            FROM log WHERE url <> '')
        SELECT * EXCLUDE (rn, done) FROM firsts WHERE rn = 1 AND NOT done
            AND url NOT IN (SELECT 'https://People.example/P/' || n_nationkey FROM nation)""",
    "enrich": """WITH o AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '' ELSE 'c/' || o_custkey END AS url,
                o_orderpriority AS name FROM orders),
            d AS (SELECT 'c/' || c_custkey AS biography_url, CASE WHEN c_acctbal > 0 THEN c_name END AS name,
                CASE WHEN c_nationkey > 5 THEN c_mktsegment ELSE '' END AS biography_text FROM customer)
        SELECT o_orderkey, url, coalesce(d.name, o.name) AS name, biography_url, biography_text
        FROM o LEFT JOIN d ON o.url = d.biography_url""",
    "capture_errors": """WITH latest AS (SELECT o_custkey, arg_max(CASE o_orderstatus WHEN 'F' THEN 200 WHEN 'O' THEN 404
                ELSE 500 END, o_orderkey) AS status FROM orders GROUP BY o_custkey)
        SELECT 'c/' || c_custkey AS biography_url, 'HTTP ' || status || ' for c/' || c_custkey AS biography_error
        FROM customer JOIN latest ON c_custkey = o_custkey WHERE status <> 200""",
    "enrich_stats": f"""WITH {LOG}, counts AS (SELECT
            count(DISTINCT CASE WHEN {DETAILS} THEN nullif(url, '') END) AS skipped,
            count(DISTINCT nullif(url, '')) AS total_seen, count(DISTINCT nullif(record_key, '')) AS records_saved FROM keyed)
        SELECT total_seen - skipped AS scraped, skipped, total_seen, records_saved FROM counts""",
    "fold_listing_state": f"WITH {STATE} SELECT * FROM state",
    "listing_events": f"""WITH {PROGRESS} SELECT seq, coalesce(page >= total_pages, false) AS completed FROM progress""",
    "resume_points": f"""WITH {STATE}, index_pages AS (SELECT 'https://people.example/Initial,' || c_custkey AS index_url FROM customer),
            joined AS (SELECT i.index_url, completed, last_page, coalesce(html <> '' AND last_page <> 0, false) AS resumed
                FROM index_pages i LEFT JOIN state s ON i.index_url = s.index_url)
        SELECT index_url, CASE WHEN resumed THEN last_page ELSE 1 END AS start_page, resumed
        FROM joined WHERE NOT coalesce(completed, false)""",
    "pages_ahead": f"""WITH {STATE} SELECT index_url,
            unnest(generate_series(coalesce(last_page, 0) + 1, least(total_pages, 40))) AS page_no
        FROM state WHERE total_pages IS NOT NULL""",
    "page_gaps": """SELECT o_orderkey AS l_orderkey, n AS page_no FROM orders, range(1, 8) numbers(n)
        WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o_orderkey AND l.l_linenumber = n)""",
    "crawl_totals": """WITH per AS (SELECT l_orderkey, max(l_linenumber) AS total,
                count(*) FILTER (WHERE l_returnflag <> 'R') AS read FROM lineitem GROUP BY l_orderkey)
        SELECT CAST(sum(total) AS BIGINT) AS total_pages, CAST(sum(read) AS BIGINT) AS scraped_pages FROM per""",
    "taxonomy_model": f"""WITH {MODEL} SELECT seed_pos, qid, label, alias_pos, alias,
        array_to_string(words, '/') AS tokens FROM model""",
    "score_pairs": f"""WITH {LINKABLE}, {MODEL}, {linking('linkable', 'id', 'activity', 0.001)}
        SELECT text, qid, seed_pos, label, confidence FROM matches""",
    "suggest": f"WITH {SUGGESTED} SELECT * FROM suggestions",
    "top_suggestion": f"WITH {SUGGESTED} SELECT * FROM suggestions WHERE rank <= 1",
    "statements": f"WITH {STATED} SELECT * FROM stated",
    "statement_columns": f"WITH {STATED} SELECT {', '.join(fixed.STATEMENT_COLUMNS)} FROM stated",
    "quickstatements": f"""WITH {STATED} SELECT concat_ws(chr(9), item_qid, 'P106', occupation_qid, 'S854',
            '"' || replace(reference_url, '"', '%22') || '"', 'S813', '+2026-06-23T00:00:00Z/11') AS value
        FROM stated WHERE item_qid <> '' AND reference_url <> ''""",
    "link_documents": f"""WITH {built_in_model()}, {linking('documents', 'doc_id', 'text', 0.6)}
        SELECT * FROM suggestions""",
    "write_statements": f"""WITH {STATED} SELECT {', '.join(f"coalesce(CAST({c} AS VARCHAR), '') AS {c}"
        for c in fixed.STATEMENT_COLUMNS)} FROM stated""",
    "write_quickstatements": f"""WITH {STATED} SELECT concat_ws(chr(9), item_qid, 'P106', occupation_qid, 'S854',
            '"' || replace(reference_url, '"', '%22') || '"', 'S813', '+2026-06-23T00:00:00Z/11') AS line
        FROM stated WHERE item_qid <> '' AND reference_url <> ''""",
    "csv_to_statements": f"WITH {STATED} SELECT {', '.join(fixed.STATEMENT_COLUMNS)} FROM stated",
    "read_pages": "SELECT page_id, url, length(html) AS n FROM pages",
    "csv_two_headers": """SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, c_mktsegment AS activity FROM customer
        UNION ALL SELECT 's' || s_suppkey, s_name, '' FROM supplier""",
    "csv_roundtrip": """SELECT CAST(doc_id AS VARCHAR) AS id, text AS name, '' AS dates, ' "' || lang || ', " ' AS activity
        FROM documents""",
    "union_align": """SELECT CAST(NULL AS VARCHAR) AS url, c_name AS name, c_mktsegment AS activity, c_acctbal AS balance,
            CAST(NULL AS BIGINT) AS supplier FROM customer
        UNION ALL SELECT 's/' || s_suppkey, s_name, NULL, NULL, s_suppkey FROM supplier""",
    "append_then_compact": f"""WITH {TWO_BATCHES} SELECT record_key, page_seq, stage, dates, biography_text, first_page
        FROM (SELECT *, row_number() OVER (PARTITION BY record_key ORDER BY stage DESC, page_seq DESC) AS rn,
                     first_value(page_seq) OVER (PARTITION BY record_key ORDER BY stage, page_seq) AS first_page FROM rows)
        WHERE rn = 1""",
    "load_existing": f"""WITH {TWO_BATCHES}, placed AS (SELECT *, stage * 1000000000000 + page_seq AS place FROM rows)
        SELECT record_key, arg_max(name, place) AS name, arg_max(dates, place) AS dates,
               arg_max(biography_text, place) AS biography_text FROM placed GROUP BY record_key""",
    "log_snapshot": f"""WITH {LOG} SELECT ingest_seq AS page_seq, record_key, name, 0 AS stage FROM keyed
        WHERE record_key <> ''""",
    "save_snapshot": MERGED_LOG,
    "build_catalogue": f"""WITH {PEOPLE}, {ANSWERED} SELECT people.*, answered.* FROM people
        LEFT JOIN answered ON url = biography_url""",
    "ingest_stream": f"WITH {PEOPLE} SELECT record_key, url FROM people",
    "enrich_stream": f"""WITH {PEOPLE}, {ANSWERED} SELECT url, biography_name, biography_text, biography_error
        FROM people JOIN answered ON url = biography_url""",
    "compact_job": f"""WITH {PEOPLE}, {ANSWERED} SELECT record_key, url, biography_text, biography_error
        FROM people LEFT JOIN answered ON url = biography_url""",
    "extend_log": f"""WITH {PEOPLE}, {ANSWERED} SELECT
        (SELECT count(*) FROM people SEMI JOIN answered ON url = biography_url) AS scraped, CAST(0 AS BIGINT) AS skipped,
        count(*) AS total_seen, count(*) AS records_saved FROM people""",
    "extend_log_without_details": f"""WITH {PEOPLE}, {ANSWERED} SELECT CAST(0 AS BIGINT) AS scraped,
        (SELECT count(*) FROM people SEMI JOIN (SELECT * FROM answered
            WHERE coalesce(biography_text, '') <> '' OR coalesce(biography_error, '') <> '') ON url = biography_url) AS skipped,
        count(*) AS total_seen, count(*) AS records_saved FROM people""",
    "extend_log_rerun": f"""WITH {PEOPLE}, {ANSWERED}
        SELECT record_key, url, 0 AS stage, NULL AS biography_text FROM people UNION ALL
        SELECT record_key, url, 1, biography_text FROM people JOIN answered ON url = biography_url""",
    "extend_log_reordered": f"""WITH {FIRST_SEEN}
        SELECT record_key, url, name, 0 AS stage, batch_id, NULL AS biography_text FROM first_seen UNION ALL
        SELECT record_key, url, name, 1, batch_id, biography_text FROM first_seen JOIN answered ON url = biography_url""",
    "resume_after_compaction": f"""WITH {FIRST_SEEN} SELECT record_key, url, name, batch_id, biography_text, biography_error,
        page_seq AS first_page, batch_id AS first_batch FROM first_seen LEFT JOIN answered ON url = biography_url""",
    "read_listing_once": f"""SELECT doc_id AS page_seq, CASE WHEN lang <> 'es' THEN 3 END AS n_cards,
        CASE WHEN lang <> 'es' THEN greatest(doc_id + 1, 7) END AS total_pages, CASE WHEN lang <> 'es' THEN doc_id END AS current_page,
        CASE WHEN lang <> 'es' THEN CASE WHEN doc_id + 1 = 7 THEN 2 ELSE 3 END END AS n_pager_links,
        CASE WHEN lang <> 'es' THEN 2 END AS n_index_links,
        CASE WHEN lang = 'es' THEN 'HTTP 500 for {st.SITE}/Search/Type,Biography/Initial,es/' || doc_id END AS error FROM documents""",
    "listing_ends": """WITH t AS (SELECT lang, count(*) AS size FROM documents GROUP BY lang)
        SELECT lang AS index_url, size AS last_page, size + 3 AS total_pages, lang NOT IN ('de', 'fr') AS completed,
            CASE lang WHEN 'de' THEN 3 WHEN 'fr' THEN 4 ELSE 0 END AS n_missing FROM t""",
    "listing_errors": f"""WITH p AS ({st.for_duckdb(st.LISTING_PAGES)})
        SELECT url, page_seq, CASE WHEN initial = 'es' THEN 'HTTP 500 for ' || url ELSE 'no html captured' END AS error
        FROM p WHERE initial IN ('es', 'fr')""",
    "missing_listing_pages": """WITH t AS (SELECT lang, max(greatest(doc_id + 1, 7)) AS total FROM documents GROUP BY lang),
            wanted AS (SELECT lang, unnest(range(1, total + 1)) AS page_no FROM t)
        SELECT lang AS index_url, page_no FROM wanted w
        WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.lang = w.lang AND d.doc_id = page_no)""",
    "listing_state": """SELECT lang AS index_url, max(doc_id) AS last_page, max(greatest(doc_id + 1, 7)) AS total_pages,
        max(doc_id) >= max(greatest(doc_id + 1, 7)) AS completed FROM documents GROUP BY lang""",
    "stream_dedupe": f"""WITH {LOG} SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY record_key ORDER BY ingest_seq) AS rn FROM keyed WHERE record_key <> '')
        WHERE rn = 1""",
    "stream_state": f"WITH {STATE} SELECT * FROM state",
}
