"""Catalogue inputs derived from the given tables, as SQL that both engines run.

The given tables hold no biographies, so each stand-in maps whole tables onto one of
the catalogue's inputs: captured pages, a record log, listing progress, seeds, records
to link.  Placeholders in braces are table names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vitarium.sources.tables import read_table

SITE = "https://Catalogue.example"

LISTING_PAGES = f"""
SELECT '{SITE}/Search/Type,Biography/Initial,' || lang || '/' || doc_id AS url,
       doc_id AS page_seq, 200 AS status, lang AS initial,
       '<!DOCTYPE html><html><body><ul class="alphabet"><li><a href="/Search/Type,Biography/Initial,' || lang
       || '/">x</a><li><a href="/Search/Type,Biography/Initial,B/">B</a>'
       || '<li><a href="/Search/Type,Biography/Initial,B/">B again</a></ul>'
       || '<div class="top pages"><span> ' || doc_id || ' </span><a id="pg_' || (doc_id + 1) || '">' || (doc_id + 1)
       || '</a><a id="pg_old">7</a><a id="pg_seven">7</a><a id="pg_next">&gt;</a><a>no id</a></div>'
       || '<script>var x = "<div class=personItem>";</script>'
       || '<div class="personItem"><div class="name"><a href="../bio/' || doc_id || '"> Doc <b>' || source
       || '</b>\n &amp; ' || lang || '</a><a href="/other">other</a></div><span class="dates">' || n_chars
       || '-</span><div class="activity"><a>' || lang || '</a><a> </a><a>' || source || '</a></div></div>'
       || '<div class="personItem"><div class="name"><a href="/Search/Type,Biography/bio/' || (doc_id + 1)
       || '">next</a></div></div>'
       || '<div class="personItem"><div class="name">no link</div><span class="dates">x</span></div>'
       || '</body>' AS html
FROM {{documents}}
"""

DETAIL_PAGES = f"""
SELECT '{SITE.lower()}/Search/Type,Biography/bio/' || doc_id AS url, doc_id AS page_seq,
       CASE WHEN lang = 'es' THEN 404 ELSE 200 END AS status,
       '<html><head><meta property="og:title" content="Title &quot;' || doc_id || '&quot;"><title>t</title></head><body>'
       || CASE WHEN lang = 'de' THEN ''
               ELSE '<h1><span itemprop="givenName"> ' || lang || '</span> <span itemprop="familyName">' || source
                    || '</span></h1>' END
       || '<p class="birthDateText">' || n_chars || '<p class="deathDateText"> ' || doc_id || '</p>'
       || '<div class="personalDataControl"><div class="black-bg"><a href="/Search/Type,Biography/Tag,1/">' || source
       || '</a><a href="/Search/Type,Biography/Tag,2/">' || lang || '</a><a href="/Search/Type,Biography/Tag,1/">'
       || source || '</a><a href="/else">else</a></div></div><div itemprop="description">'
       || replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '"', '&quot;')
       || '</div><div itemprop="description">second</div>' AS html
FROM {{documents}}
"""

#: Each language is a listing of its own, numbered through.  Every pager names a page three further than there is; only
#: the last page of German links on, and the second page of French is missing.
SERIES = f"""
SELECT '{SITE}/Search/Type,Biography/Initial,' || lang || '/' AS url, doc_id AS page_seq, lang AS initial,
       '<div class="pages"><span>' || n || '</span><a>' || (size + 3) || '</a>'
       || CASE WHEN n < size OR lang = 'de' THEN '<a id="pg_x">' || (n + 1) || '</a>' ELSE '' END
       || CASE WHEN n < size THEN '<a id="pg_next">&gt;</a>' ELSE '<a>&gt;</a>' END || '</div>' AS html
FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS n,
             count(*) OVER (PARTITION BY lang) AS size FROM {{documents}}) numbered
WHERE NOT (lang = 'fr' AND n = 2)
"""

RECORD_LOG = """
SELECT event_id AS ingest_seq,
       CASE event_type WHEN 'view' THEN 'https://People.example/P/' || user_id
                       WHEN 'click' THEN 'https://people.example/p/' || user_id
                       WHEN 'error' THEN 'https://people.example/p/' || user_id
                       WHEN 'purchase' THEN ''
                       ELSE CASE WHEN value < 5 THEN ' ' END END AS url,
       CASE event_type WHEN 'view' THEN 'Person ' || event_id WHEN 'purchase' THEN ''
                       WHEN 'signup' THEN 'Member  ' || user_id END AS name,
       CASE WHEN event_type = 'view' THEN 'b. ' || event_id END AS dates,
       CASE WHEN event_type = 'view' AND value > 3 THEN 'poet | ' || props END AS activity,
       CASE WHEN event_type IN ('purchase', 'click') THEN 'https://people.example/p/' || user_id END AS biography_url,
       CASE WHEN event_type = 'click' THEN CASE WHEN value > 20 THEN 'Name ' || event_id ELSE '' END END
           AS biography_name,
       CASE WHEN event_type = 'click' AND value > 40 THEN 'Text ' || props END AS biography_text,
       CASE WHEN event_type = 'error' AND value > 45 THEN 'HTTP 500' END AS biography_error
FROM {events}
"""
LOG_COLUMNS = ["url", "name", "dates", "activity", "biography_url", "biography_name", "biography_text",
               "biography_error"]

PROGRESS = """
SELECT 'https://people.example/Initial,' || user_id AS index_url, event_id AS seq, ts AS updated_at,
       CAST(floor(value) AS BIGINT) AS page,
       CASE WHEN event_type <> 'error' THEN CAST(floor(value) AS BIGINT) + 3 END AS total_pages,
       CASE WHEN event_type = 'signup' THEN value > 30 END AS completed,
       CASE WHEN event_type = 'view' THEN CASE WHEN value > 10 THEN props ELSE '' END END AS html
FROM {events}
"""

SEEDS = """
SELECT CAST(min(p_partkey) AS INT) AS seed_pos, 'Q' || min(p_partkey) AS qid, noun AS label,
       ARRAY_OF(noun, noun || 's', 'Small ' || noun || ' maker') AS aliases
FROM (SELECT p_partkey, split_part(p_name, ' ', 2) AS noun FROM {part}) nouns GROUP BY noun
UNION ALL
SELECT CAST(min(p_partkey) AS INT) + 100000000 AS seed_pos, 'A' || min(p_partkey) AS qid, 'ż' || adjective AS label,
       ARRAY_OF(adjective || ' thing', adjective || ', very ' || adjective) AS aliases
FROM (SELECT p_partkey, split_part(p_name, ' ', 1) AS adjective FROM {part}) adjectives GROUP BY adjective
"""

LINKABLE = """
SELECT p_partkey AS id, p_name || ' | ' || p_type || ';  ' || p_brand || ',, Thing ' || p_name || '|' || p_name AS activity,
       CASE WHEN p_size > 25 THEN '' ELSE 'Q' || p_partkey END AS wikidata_qid,
       CASE WHEN p_size > 10 THEN p_name END AS name, p_type AS biography_name,
       CASE WHEN p_size > 40 THEN '' ELSE 'https://x.example/"' || p_brand END AS url,
       'https://y.example/' || p_partkey AS biography_url
FROM {part}
"""


def for_duckdb(sql: str) -> str:
    return sql.replace("{", "").replace("}", "").replace("ARRAY_OF(", "list_value(")


#: Tables whose rows take real work, with a column of distinct values to spread them by.
SPREAD = {"documents": "doc_id", "pages": "page_id", "part": "p_partkey", "events": "event_id"}


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet", list(columns) or None, SPREAD.get(name))


def standin(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    tables = {n: table(spark, sf_dir, n) for n in SPREAD if "{" + n + "}" in sql}
    return spark.sql(sql.replace("ARRAY_OF(", "array("), **tables)
