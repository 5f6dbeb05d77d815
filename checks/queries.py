"""One query per operator, over whole tables, for the side-by-side check."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import standins as st
from vitarium.functions import text as tx
from vitarium.functions import urls
from vitarium.operators import listing, occupations, pages, records
from vitarium.operators.extract import Rule, extract
from vitarium.plans import catalogue, linking
from vitarium.schema import DETAIL_STAGE, LISTING_STAGE, LOG_ORDER, PAGES
from vitarium.session import scratch_path
from vitarium.sources import csv_files, log
from vitarium.sources import pages as page_tables
from vitarium.sources import statements as statement_files
from vitarium.sources.pages import stream_pages
from vitarium.streaming import jobs

Spark = SparkSession
NAV_LINKS = "nav a"
RETRIEVED = datetime.date(2026, 6, 23)


# --- text and URLs -----------------------------------------------------------
def normalize_text(spark: Spark, sf: str) -> DataFrame:
    return st.table(spark, sf, "documents", "doc_id", "text").select("doc_id", tx.normalize_text("text").alias("clean"))


def match_key(spark: Spark, sf: str) -> DataFrame:
    return st.table(spark, sf, "documents", "doc_id", "text").select("doc_id", tx.match_key("text").alias("key"))


def split_activities(spark: Spark, sf: str) -> DataFrame:
    documents = st.table(spark, sf, "documents", "doc_id", "text")
    return documents.select("doc_id", F.posexplode(tx.split_activities("text")).alias("pos", "piece"))


def join_labels(spark: Spark, sf: str) -> DataFrame:
    words = F.split(F.concat_ws(",", "p_type", F.lit("  "), "p_brand", "p_name", "p_type"), ",")
    return st.table(spark, sf, "part").select(
        "p_partkey", tx.join_labels(words).alias("every"), tx.join_labels(words, distinct=True).alias("once"))


def leading_int(spark: Spark, sf: str) -> DataFrame:
    return st.table(spark, sf, "orders", "o_orderkey", "o_orderpriority", "o_orderstatus").select(
        "o_orderkey", tx.leading_int("o_orderpriority").alias("level"), tx.leading_int("o_orderstatus").alias("none"))


def absolute_url(spark: Spark, sf: str) -> DataFrame:
    links = extract(st.table(spark, sf, "pages"), [Rule("hrefs", NAV_LINKS, attr="href")], keep=["page_id", "url"])
    return links.select("page_id", "url", F.posexplode("hrefs").alias("pos", "href")).select(
        "page_id", "pos", urls.absolute_url("url", "href").alias("resolved"))


def record_key(spark: Spark, sf: str) -> DataFrame:
    return urls.with_record_key(st.standin(spark, sf, st.RECORD_LOG)).select("ingest_seq", "record_key")


def index_urls(spark: Spark, sf: str) -> DataFrame:
    initials = st.table(spark, sf, "part", "p_partkey", "p_name", "p_brand")
    initials = initials.withColumn("initial", F.concat_ws(" ż(", "p_brand", "p_name")).select("p_partkey", "initial")
    swapped = urls.index_urls(initials, f"{st.SITE}/x/initial,A/Initial,B", alias="swapped")
    return urls.index_urls(swapped, "https://h.example/any/where", alias="built").drop("initial")


# --- pages -------------------------------------------------------------------
def page_title(spark: Spark, sf: str) -> DataFrame:
    found = extract(st.table(spark, sf, "pages"), [Rule("title", "title"), Rule("h1", "article h1")], keep=["page_id"])
    return found.select("page_id", tx.first_text("title").alias("title"), tx.first_text("h1").alias("h1"))


def page_name_fallback(spark: Spark, sf: str) -> DataFrame:
    rules = [Rule("missing", 'h1[itemprop="name"]'), Rule("ad", "div.ad"), Rule("title", "html title")]
    found = extract(st.table(spark, sf, "pages"), rules, keep=["page_id"])
    return found.select("page_id", tx.first_truthy(*map(tx.first_text, ("missing", "ad", "title"))).alias("name"))


def nav_links(spark: Spark, sf: str) -> DataFrame:
    links = pages.index_links(
        st.table(spark, sf, "pages"), selector=NAV_LINKS, keep=["page_id", "url"], alias="link")
    return links.select("page_id", "link_pos", "link")


def index_links(spark: Spark, sf: str) -> DataFrame:
    return pages.index_links(st.standin(spark, sf, st.LISTING_PAGES), keep=["page_seq", "url"]).drop("url")


def listing_cards(spark: Spark, sf: str) -> DataFrame:
    return pages.listing_cards(st.standin(spark, sf, st.LISTING_PAGES), keep=["page_seq"])


def detail_fields(spark: Spark, sf: str) -> DataFrame:
    return pages.detail_fields(st.standin(spark, sf, st.DETAIL_PAGES))


def pager_summary(spark: Spark, sf: str) -> DataFrame:
    return pages.pager_summary(st.standin(spark, sf, st.LISTING_PAGES), keep=["page_seq"])


def pager_links(spark: Spark, sf: str) -> DataFrame:
    return pages.pager_links(st.standin(spark, sf, st.LISTING_PAGES), keep=["page_seq"])


# --- records -----------------------------------------------------------------
def merge_records(spark: Spark, sf: str) -> DataFrame:
    return records.merge_records(st.standin(spark, sf, st.RECORD_LOG), seq="ingest_seq")


def compact_latest(spark: Spark, sf: str) -> DataFrame:
    return records.compact_latest(st.standin(spark, sf, st.RECORD_LOG), seq="ingest_seq")


def new_records_only(spark: Spark, sf: str) -> DataFrame:
    batch = st.table(spark, sf, "orders").select(
        F.concat(F.lit("Customer#"), "o_custkey").alias("name"), "o_orderkey", "o_totalprice")
    known = st.table(spark, sf, "customer").filter("c_acctbal > 0").select(
        F.concat(F.lit("CUSTOMER#"), "c_custkey").alias("name"))
    return records.new_records_only(urls.with_record_key(batch), known, seq="o_orderkey")


def log_progress(spark: Spark, sf: str) -> DataFrame:
    return records.log_progress(st.standin(spark, sf, st.RECORD_LOG))


def detail_frontier(spark: Spark, sf: str) -> DataFrame:
    rows = st.standin(spark, sf, st.RECORD_LOG)
    done = st.table(spark, sf, "nation").select(
        F.concat(F.lit("https://People.example/P/"), "n_nationkey").alias("url"))
    return records.detail_frontier(rows, seq="ingest_seq", done=done)


def enrich(spark: Spark, sf: str) -> DataFrame:
    orders = st.table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", "").otherwise(F.concat(F.lit("c/"), "o_custkey")).alias("url"),
        F.col("o_orderpriority").alias("name"))
    details = st.table(spark, sf, "customer").select(
        F.concat(F.lit("c/"), "c_custkey").alias("biography_url"),
        F.when(F.col("c_acctbal") > 0, F.col("c_name")).alias("name"),
        F.when(F.col("c_nationkey") > 5, F.col("c_mktsegment")).otherwise("").alias("biography_text"))
    return records.enrich(orders, details, spread_by=["o_orderkey"])


def capture_errors(spark: Spark, sf: str) -> DataFrame:
    frontier = st.table(spark, sf, "customer").select(F.concat(F.lit("c/"), "c_custkey").alias("url"))
    captured = st.table(spark, sf, "orders").select(
        F.concat(F.lit("c/"), "o_custkey").alias("url"), "o_orderkey",
        F.expr("CASE o_orderstatus WHEN 'F' THEN 200 WHEN 'O' THEN 404 ELSE 500 END").alias("status"))
    return records.capture_errors(frontier, captured, seq="o_orderkey")


def enrich_stats(spark: Spark, sf: str) -> DataFrame:
    return records.enrich_stats(st.standin(spark, sf, st.RECORD_LOG))


# --- listing state -----------------------------------------------------------
def fold_listing_state(spark: Spark, sf: str) -> DataFrame:
    return listing.fold_listing_state(st.standin(spark, sf, st.PROGRESS), seq="seq")


def listing_events(spark: Spark, sf: str) -> DataFrame:
    return listing.listing_events(st.standin(spark, sf, st.PROGRESS)).select("seq", "completed")


def resume_points(spark: Spark, sf: str) -> DataFrame:
    index = st.table(spark, sf, "customer").select(
        F.concat(F.lit("https://people.example/Initial,"), "c_custkey").alias("index_url"))
    return listing.resume_points(index, fold_listing_state(spark, sf))


def pages_ahead(spark: Spark, sf: str) -> DataFrame:
    return listing.pages_ahead(fold_listing_state(spark, sf), max_pages=40)


def page_gaps(spark: Spark, sf: str) -> DataFrame:
    lines = st.table(spark, sf, "lineitem", "l_orderkey", "l_linenumber")
    totals = st.table(spark, sf, "orders", "o_orderkey").select(
        F.col("o_orderkey").alias("l_orderkey"), F.lit(7).alias("total_pages"))
    return listing.page_gaps(lines, totals, index_url="l_orderkey", page_no="l_linenumber")


def crawl_totals(spark: Spark, sf: str) -> DataFrame:
    lines = st.table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_returnflag")
    lines = lines.withColumn("resumed", F.col("l_returnflag") == "R")
    return listing.crawl_totals(lines, index_url="l_orderkey", total_pages="l_linenumber", resumed="resumed")


# --- occupations -------------------------------------------------------------
def _model(spark: Spark, sf: str) -> DataFrame:
    return occupations.occupation_model(st.standin(spark, sf, st.SEEDS))


def taxonomy_model(spark: Spark, sf: str) -> DataFrame:
    return _model(spark, sf).withColumn("tokens", F.array_join("alias_tokens", "/")).drop("alias_tokens")


def score_pairs(spark: Spark, sf: str) -> DataFrame:
    pieces = occupations.activity_pieces(st.standin(spark, sf, st.LINKABLE), record_id="id")
    return occupations.match_labels(pieces.select("text").distinct(), _model(spark, sf), min_confidence=0.001)


def suggest(spark: Spark, sf: str) -> DataFrame:
    return occupations.suggest(st.standin(spark, sf, st.LINKABLE), _model(spark, sf), record_id="id")


def top_suggestion(spark: Spark, sf: str) -> DataFrame:
    return occupations.best_suggestions(suggest(spark, sf), 1)


def statements(spark: Spark, sf: str) -> DataFrame:
    return linking.link_occupations(
        st.standin(spark, sf, st.LINKABLE), record_id="id", seeds=st.standin(spark, sf, st.SEEDS))


def statement_columns(spark: Spark, sf: str) -> DataFrame:
    return occupations.statement_columns(statements(spark, sf))


def quickstatements(spark: Spark, sf: str) -> DataFrame:
    return occupations.quickstatements(statements(spark, sf), RETRIEVED)


def link_documents(spark: Spark, sf: str) -> DataFrame:
    """Whole texts against the built-in vocabulary."""
    documents = st.table(spark, sf, "documents", "doc_id", "text")
    model = occupations.occupation_model(occupations.occupation_seeds(spark))
    return occupations.suggest(documents, model, record_id="doc_id", activity="text", min_confidence=0.6)


# --- sources and sinks -------------------------------------------------------
def csv_roundtrip(spark: Spark, sf: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    documents = st.table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("id"), F.col("text").alias("name"), F.lit(None).cast("string").alias("dates"),
        F.concat(F.lit(' "'), "lang", F.lit(', " ')).alias("activity"))
    csv_files.write_records(documents, path)
    return csv_files.read_records(spark, path)


def csv_two_headers(spark: Spark, sf: str) -> DataFrame:
    """Two files whose columns differ in order and number."""
    path = scratch_path(spark, "csv")
    customers = st.table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("activity"))
    suppliers = st.table(spark, sf, "supplier").select(
        F.col("s_name").alias("name"), F.concat(F.lit("s"), "s_suppkey").alias("id"))
    csv_files.write_records(customers, f"{path}/part=a")
    csv_files.write_records(suppliers, f"{path}/part=b")
    return csv_files.read_records(spark, path, mixed_headers=True).select("id", "name", "activity")


def write_statements(spark: Spark, sf: str) -> DataFrame:
    path = scratch_path(spark, "statements")
    statement_files.write_statements(statements(spark, sf), path, record_id="id")
    return csv_files.read_records(spark, path)


def write_quickstatements(spark: Spark, sf: str) -> DataFrame:
    path = scratch_path(spark, "quickstatements")
    statement_files.write_quickstatements(statements(spark, sf), path, record_id="id", retrieved=F.lit(RETRIEVED))
    return spark.read.text(path).withColumnRenamed("value", "line")


def csv_to_statements(spark: Spark, sf: str) -> DataFrame:
    """Records in a CSV file to statements, rows told apart by where they stand."""
    path = scratch_path(spark, "records")
    records_in = st.standin(spark, sf, st.LINKABLE)
    csv_files.write_records(records_in.select(*(F.col(c).cast("string").alias(c) for c in records_in.columns)), path)
    read = csv_files.read_records(spark, path, multi_line=False, position=True)
    found = linking.link_occupations(read, record_id=["file_path", "file_block", "row_no"], seeds=st.standin(spark, sf, st.SEEDS))
    return occupations.statement_columns(found)


def read_pages(spark: Spark, sf: str) -> DataFrame:
    return page_tables.read_pages(spark, f"{sf}/pages.parquet").select("page_id", "url", F.length("html").alias("n"))


def union_align(spark: Spark, sf: str) -> DataFrame:
    customers = st.table(spark, sf, "customer").select(
        F.col("c_acctbal").alias("balance"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("activity"))
    suppliers = st.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("supplier"), F.concat(F.lit("s/"), "s_suppkey").alias("url"),
        F.col("s_name").alias("name"))
    return csv_files.align_columns([customers, suppliers])


def _written_log(spark: Spark, sf: str) -> tuple[str, DataFrame]:
    path = scratch_path(spark, "log")
    rows = st.standin(spark, sf, st.RECORD_LOG).withColumn("page_seq", F.col("ingest_seq"))
    first = rows.withColumn("card_pos", F.lit(0))
    log.append_checkpoint(first, path, batch_id=0)
    again = first.filter("url IS NOT NULL").withColumn("biography_text", F.concat_ws(" ", F.lit("again"), "page_seq"))
    log.append_checkpoint(again.drop("dates"), path, batch_id=1, stage=DETAIL_STAGE)
    return path, rows


def append_then_compact(spark: Spark, sf: str) -> DataFrame:
    path, _ = _written_log(spark, sf)
    latest = records.compact_latest(log.scan_log(spark, path), seq=LOG_ORDER)
    return latest.select("record_key", "page_seq", "stage", "dates", "biography_text",
                         F.col("first_seq.page_seq").alias("first_page"))


def load_existing(spark: Spark, sf: str) -> DataFrame:
    path, _ = _written_log(spark, sf)
    return log.load_existing(spark, path).select("record_key", "name", "dates", "biography_text")


def log_snapshot(spark: Spark, sf: str) -> DataFrame:
    path, _ = _written_log(spark, sf)
    return log.scan_log(spark, path, upto=(LISTING_STAGE, 0)).select("page_seq", "record_key", "name", "stage")


def save_snapshot(spark: Spark, sf: str) -> DataFrame:
    path = scratch_path(spark, "snapshot")
    log.save_snapshot(st.standin(spark, sf, st.RECORD_LOG), path, seq="ingest_seq")
    return spark.read.parquet(path)


# --- plans and streams -------------------------------------------------------
def build_catalogue(spark: Spark, sf: str) -> DataFrame:
    return catalogue.build_catalogue(
        st.standin(spark, sf, st.LISTING_PAGES), st.standin(spark, sf, st.DETAIL_PAGES)).drop("first_seq", "page_seq")


#: One file of pages stands for this many bytes of the documents table.
FILE_BYTES = 8 << 20


def _page_files(spark: Spark, sf: str, sql: str) -> DataFrame:
    path = scratch_path(spark, "pages")
    rows = st.standin(spark, sf, sql).select(*[F.col(f.name).cast(f.dataType) for f in PAGES])
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    size = int(str(documents._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    files = max(4, -(-size // FILE_BYTES))
    # half of the files a micro-batch, four files at least; ranges keep early pages in early files
    rows.repartitionByRange(files, "page_seq").write.parquet(path)
    return stream_pages(spark, path, files_per_batch=-(-files // 2))


def _streamed_log(spark: Spark, sf: str, details: bool) -> str:
    path = scratch_path(spark, "log")
    jobs.ingest_stream(
        _page_files(spark, sf, st.LISTING_PAGES), path, scratch_path(spark, "ingest")).awaitTermination()
    if details:
        jobs.enrich_stream(
            _page_files(spark, sf, st.DETAIL_PAGES), path, scratch_path(spark, "enrich")).awaitTermination()
    return path


def ingest_stream(spark: Spark, sf: str) -> DataFrame:
    rows = log.scan_log(spark, _streamed_log(spark, sf, details=False))
    return rows.select("record_key", "url")


def enrich_stream(spark: Spark, sf: str) -> DataFrame:
    rows = log.scan_log(spark, _streamed_log(spark, sf, details=True)).filter(F.col("stage") == DETAIL_STAGE)
    return rows.select("url", "biography_name", "biography_text", "biography_error")


def compact_job(spark: Spark, sf: str) -> DataFrame:
    path = _streamed_log(spark, sf, details=True)
    snapshot = scratch_path(spark, "snapshot")
    catalogue.compact_job(spark, path, snapshot)
    return spark.read.parquet(snapshot).select("record_key", "url", "biography_text", "biography_error")


def extend_log(spark: Spark, sf: str) -> DataFrame:
    path = scratch_path(spark, "log")
    return catalogue.extend_log(
        spark, st.standin(spark, sf, st.LISTING_PAGES), st.standin(spark, sf, st.DETAIL_PAGES), path, batch_id=0)


def extend_log_without_details(spark: Spark, sf: str) -> DataFrame:
    """A run after one with details, itself without."""
    path, lists = scratch_path(spark, "log"), st.standin(spark, sf, st.LISTING_PAGES)
    catalogue.extend_log(spark, lists, st.standin(spark, sf, st.DETAIL_PAGES), path, batch_id=0)
    return catalogue.extend_log(spark, lists, None, path, batch_id=1)


def extend_log_rerun(spark: Spark, sf: str) -> DataFrame:
    """The log after one batch was run twice."""
    path, lists = scratch_path(spark, "log"), st.standin(spark, sf, st.LISTING_PAGES)
    details = st.standin(spark, sf, st.DETAIL_PAGES)
    for _ in range(2):
        catalogue.extend_log(spark, lists, details, path, batch_id=0)
    return log.scan_log(spark, path).select("record_key", "url", "stage", "biography_text")


def _two_runs(spark: Spark, sf: str, path: str, order: list[int]) -> None:
    """Runs 0 (all listing pages but the English ones) and 1 (all of them), in this order."""
    lists, details = st.standin(spark, sf, st.LISTING_PAGES), st.standin(spark, sf, st.DETAIL_PAGES)
    for run in order:
        catalogue.extend_log(spark, lists.filter("initial <> 'en'") if run == 0 else lists, details, path, batch_id=run)


def extend_log_reordered(spark: Spark, sf: str) -> DataFrame:
    """Two runs, then both once more, each after the other."""
    path = scratch_path(spark, "log")
    _two_runs(spark, sf, path, [0, 1, 0, 1, 0])
    return log.scan_log(spark, path).select("record_key", "url", "name", "stage", "batch_id", "biography_text")


def resume_after_compaction(spark: Spark, sf: str) -> DataFrame:
    """A second run that starts from the snapshot of the first, whose batches are gone."""
    path = scratch_path(spark, "log")
    _two_runs(spark, sf, path, [0])
    catalogue.compact_job(spark, path, drop=True)
    _two_runs(spark, sf, path, [1, 0])  # the first run is in the snapshot for good
    rows = log.latest_rows(spark, path)
    return rows.select("record_key", "url", "name", "batch_id", "biography_text", "biography_error",
                       F.col("first_seq.page_seq").alias("first_page"), F.col("first_seq.batch_id").alias("first_batch"))


def read_listing_once(spark: Spark, sf: str) -> DataFrame:
    """Cards, pager, links and errors of pages that were parsed once."""
    lists = st.standin(spark, sf, st.LISTING_PAGES)
    lists = lists.withColumn("status", F.when(F.col("initial") == "es", 500).otherwise(F.col("status")))
    parsed = catalogue.read_once(spark, lists, scratch_path(spark, "parsed"))
    keep = ["url", "page_seq"]

    def counted(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy("page_seq").agg(F.count("*").alias(name))

    out = counted(pages.listing_cards(parsed, keep=keep), "n_cards")
    for more in (pages.pager_summary(parsed, keep=keep).drop("url"), counted(pages.pager_links(parsed, keep=keep), "n_pager_links"),
                 counted(pages.index_links(parsed, keep=keep), "n_index_links")):
        out = out.join(more, "page_seq")
    return out.join(catalogue.listing_errors(parsed).drop("url"), "page_seq", "full")


def listing_errors(spark: Spark, sf: str) -> DataFrame:
    """Pages of one language answered with an error, those of another without HTML."""
    lists = st.standin(spark, sf, st.LISTING_PAGES)
    broken = lists.withColumn("status", F.when(F.col("initial") == "es", 500).otherwise(F.col("status"))).withColumn(
        "html", F.when(F.col("initial") != "fr", F.col("html")))
    return catalogue.listing_errors(broken)


def missing_listing_pages(spark: Spark, sf: str) -> DataFrame:
    progress = catalogue.listing_progress(st.standin(spark, sf, st.LISTING_PAGES), index_url="initial")
    return catalogue.missing_listing_pages(progress)


def listing_state(spark: Spark, sf: str) -> DataFrame:
    progress = catalogue.listing_progress(st.standin(spark, sf, st.LISTING_PAGES), index_url="initial")
    return catalogue.listing_state(progress)


def listing_ends(spark: Spark, sf: str) -> DataFrame:
    """Listings that name higher pages than they ever link to."""
    progress = catalogue.listing_progress(st.standin(spark, sf, st.SERIES), index_url="initial")
    missing = catalogue.missing_listing_pages(progress).groupBy("index_url").agg(F.count("*").alias("n_missing"))
    return catalogue.listing_state(progress).join(missing, "index_url", "left").na.fill(0, ["n_missing"])


def _stream_of(spark: Spark, df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(spark, name)
    df.repartition(4).write.parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 2).parquet(path)


def _in_order(spark: Spark, df: DataFrame, seq: str, name: str, files: int = 4) -> DataFrame:
    """A stream of ``df`` in files written one after another, two a micro-batch."""
    path = scratch_path(spark, name)
    low, high = df.agg(F.min(seq), F.max(seq)).first()
    part = F.floor((F.col(seq) - low) * files / (high - low + 1))
    for n in range(files):
        df.filter(part == n).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 2).parquet(path)


def stream_dedupe(spark: Spark, sf: str) -> DataFrame:
    """Whole first records; every key is remembered for longer than the events last."""
    rows = st.standin(spark, sf, st.RECORD_LOG).withColumn("seen_at", F.timestamp_seconds(F.col("ingest_seq") + 1_000_000_000))
    first = jobs.stream_dedupe(_in_order(spark, rows, "ingest_seq", "records"), seq="ingest_seq", event_time="seen_at",
                               forget_after="4000 days")
    out = scratch_path(spark, "deduped")
    (first.drop("seen_at").writeStream.format("parquet").option("path", out)
     .option("checkpointLocation", scratch_path(spark, "dedupe")).trigger(availableNow=True).start().awaitTermination())
    return spark.read.parquet(out)


def stream_state(spark: Spark, sf: str) -> DataFrame:
    state = jobs.stream_state(_stream_of(spark, st.standin(spark, sf, st.PROGRESS), "progress"), seq="seq", keep_html=True)
    out = scratch_path(spark, "state")
    jobs.write_state(state, out, scratch_path(spark, "fold")).awaitTermination()
    return jobs.read_state(spark, out, state.schema)


QUERIES = {
    f.__name__: f
    for f in [
        normalize_text, match_key, split_activities, join_labels, leading_int, absolute_url, record_key, index_urls,
        page_title, page_name_fallback, nav_links, index_links, listing_cards, detail_fields, pager_summary,
        pager_links, merge_records, compact_latest, new_records_only, log_progress, detail_frontier, enrich,
        capture_errors, enrich_stats, fold_listing_state, listing_events, resume_points, pages_ahead, page_gaps,
        crawl_totals, taxonomy_model, score_pairs, suggest, top_suggestion, statements, statement_columns,
        quickstatements, link_documents, write_statements, write_quickstatements, csv_to_statements, read_pages,
        csv_roundtrip, csv_two_headers, union_align, append_then_compact, load_existing,
        log_snapshot, save_snapshot, build_catalogue, ingest_stream, enrich_stream, compact_job, extend_log,
        extend_log_without_details, extend_log_rerun, extend_log_reordered, resume_after_compaction, read_listing_once,
        listing_errors, missing_listing_pages, listing_state, listing_ends,
        stream_dedupe, stream_state,
    ]
}
