"""End-to-end plans: captured pages to a catalogue of biographies."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitarium import fixed
from vitarium.functions.urls import index_urls, with_record_key
from vitarium.operators.listing import crawl_totals, index_totals, listing_ends, listing_events, page_gaps
from vitarium.operators.pages import (
    DETAILS,
    PAGER,
    detail_fields,
    index_links,
    listing_cards,
    page_errors,
    pager_summary,
    parse_pages,
)
from vitarium.operators.records import (
    detail_frontier,
    details_of_existing,
    enrich,
    enriched_urls,
    merge_records,
    new_records_only,
    run_counts,
)
from vitarium.schema import DETAIL_STAGE, LISTING_STAGE, LOG_ORDER
from vitarium.sources.files import remove
from vitarium.sources.log import (
    append_checkpoint,
    commit_snapshot,
    covered,
    drop_covered,
    latest_rows,
    scan_batches,
    scan_log,
    scan_snapshot,
    snapshot_of,
)
from vitarium.sources.pages import good_pages

PAGE_KEYS = ["url", "page_seq"]
CARD_ORDER = ["page_seq", "card_pos"]


def index_url_table(spark: SparkSession, base_url: str, initials: Sequence[str] | None = fixed.INITIALS) -> DataFrame:
    """The index pages of a catalogue; without initials the base URL alone."""
    if not initials:
        return spark.createDataFrame([(None, base_url)], "initial string, index_url string")
    return index_urls(spark.createDataFrame([(i,) for i in initials], "initial string"), base_url)


def discovered_index_urls(first_pages: DataFrame, base_url: str | None = None) -> DataFrame:
    """Index pages linked from captured start pages; a page without such links is one itself."""
    if base_url is not None:
        first_pages = first_pages.withColumn("url", F.lit(base_url))
    return index_links(first_pages, otherwise="url").select("index_url", "link_pos")


def build_catalogue(listing_pages: DataFrame, detail_pages: DataFrame | None, *,
                    existing: DataFrame | None = None) -> DataFrame:
    """Records from listing pages, with details where captured, merged per person.

    ``existing`` records (log columns) come first; where they have details these
    replace everything the listing says.  One lazy plan, in which each page is parsed once.
    """
    cards = (
        listing_cards(good_pages(listing_pages), keep=PAGE_KEYS)
        .drop("page_url")
        .withColumn("stage", F.lit(LISTING_STAGE))
        .withColumn("batch_id", F.lit(0).cast("bigint"))
    )
    rows = cards
    if existing is not None:
        earlier = existing.select(*fixed.RECORD_COLUMNS, *LOG_ORDER).withColumn("stage", F.lit(-1))
        rows = earlier.unionByName(cards, allowMissingColumns=True)
    details = None
    if detail_pages is not None:
        details = _page_details(detail_pages).withColumn("detail_url", F.col("biography_url"))
        details = details.drop("page_seq")
    if existing is not None:
        finished = details_of_existing(earlier, seq=LOG_ORDER)
        if details is None:
            details = finished
        else:
            fresh = details.join(finished.select("detail_url"), "detail_url", "left_anti")
            details = finished.unionByName(fresh, allowMissingColumns=True)
    if details is not None:
        rows = enrich(rows, details, detail_key="detail_url", spread_by=LOG_ORDER)
        rows = rows.drop("detail_url")
    return merge_records(rows, seq=LOG_ORDER)


def _page_details(pages: DataFrame) -> DataFrame:
    """Details of the latest capture of each page, errors included, one row per URL."""
    if "part" not in pages.columns:
        with_seq = pages if "page_seq" in pages.columns else pages.withColumn("page_seq", F.lit(0).cast("bigint"))
        pages = parse_pages(with_seq, [DETAILS], keep=PAGE_KEYS)
    fields = detail_fields(pages, keep=PAGE_KEYS)
    values = [c for c in fields.columns if c != "biography_url"]
    return (
        fields.groupBy("biography_url")
        .agg(F.max_by(F.struct(*values), "page_seq").alias("row"))
        .select("biography_url", "row.*")
    )


def read_once(spark: SparkSession, listing_pages: DataFrame, path: str, *, keep: Sequence[str] = PAGE_KEYS) -> DataFrame:
    """Parses listing pages once, into a table at ``path`` with all that the jobs below ask of them.

    Give the result to them in place of the pages: cards, pager, links, errors and progress are then picked
    from their own folders of that table.
    """
    parsed = parse_pages(listing_pages, keep=list(dict.fromkeys([*PAGE_KEYS, *keep])))
    parsed.write.partitionBy("part").parquet(path)
    return spark.read.schema(parsed.schema).parquet(path)


def append_listing(spark: SparkSession, pages: DataFrame, log_path: str, *, batch_id: int) -> bool:
    """Appends the persons of listing pages whose key the log does not know yet.

    Every detail row stems from a listing row, so the keys of listing batches are all that is
    known.  This batch's own rows do not count: run again with the same pages it leaves the same
    rows, whatever batches came between.  Of a snapshot only the buckets are read that the
    pages' keys fall into.  False if a snapshot covers the batch: it is in the log for good.
    """
    state = snapshot_of(spark, log_path)
    if state is not None and state.covers(LISTING_STAGE, batch_id):
        return False
    cards = with_record_key(listing_cards(good_pages(pages), keep=PAGE_KEYS).drop("page_url"))
    batches = scan_batches(spark, log_path, state)
    known = batches.filter((F.col("stage") == LISTING_STAGE) & (F.col("batch_id") != batch_id)).select("record_key")
    if state is None:
        fresh = new_records_only(cards, known, seq=CARD_ORDER)
        return append_checkpoint(fresh, log_path, batch_id=batch_id, stage=LISTING_STAGE)
    # parsed once: which buckets to ask is known only after
    work = f"{log_path}/_work/{uuid.uuid4().hex}"
    unseen = new_records_only(cards, known, seq=CARD_ORDER)
    unseen.write.parquet(work)
    parsed = spark.read.schema(unseen.schema).parquet(work)
    fresh = new_records_only(parsed, scan_snapshot(spark, log_path, state, keys=parsed), seq=CARD_ORDER)
    done = append_checkpoint(fresh, log_path, batch_id=batch_id, stage=LISTING_STAGE)
    remove(spark, work)
    return done


def open_persons(spark: SparkSession, log_path: str, *, batch_id: int, retry_errors: bool = False,
                 captured: DataFrame | None = None) -> DataFrame:
    """The first listing row of each URL without details from detail batches other than ``batch_id``.

    Only detail rows have details, so their folders alone are asked which URLs are done.
    ``captured`` (column ``url``) limits what is read of a snapshot to the buckets of these URLs' keys.
    """
    state = snapshot_of(spark, log_path)
    log = scan_batches(spark, log_path, state)
    details = log.filter((F.col("stage") == DETAIL_STAGE) & (F.col("batch_id") != batch_id))
    listed = log.filter(F.col("stage") == LISTING_STAGE)
    if state is not None:
        keys = None if captured is None else with_record_key(captured.select("url"))
        listed = listed.unionByName(scan_snapshot(spark, log_path, state, keys=keys).select(*listed.columns))
    open_ = detail_frontier(listed, seq=LOG_ORDER, done=enriched_urls(details, retry_errors=retry_errors),
                            retry_errors=retry_errors)
    # what a snapshot says of a failed page does not outlive the retry
    stale = [c for c in fixed.RECORD_COLUMNS if c.startswith("biography_")]
    return open_.withColumns({c: F.lit(None).cast("string") for c in stale})


def append_details(spark: SparkSession, pages: DataFrame, log_path: str, *, batch_id: int,
                   retry_errors: bool = False) -> bool:
    """Appends a row with details for each person of the log that lacked them and
    whose page is among ``pages``.

    Pages are parsed before they meet the frontier: parsing is local to each file and
    shrinks a page to a few fields, while joining first would shuffle whole pages.
    False if a snapshot covers the batch.
    """
    if covered(spark, log_path, DETAIL_STAGE, batch_id):
        return False
    frontier = open_persons(spark, log_path, batch_id=batch_id, retry_errors=retry_errors, captured=pages)
    rows = enrich(frontier.drop("page_seq"), _page_details(pages), how="inner")
    return append_checkpoint(rows.withColumn("card_pos", F.lit(0)), log_path, batch_id=batch_id, stage=DETAIL_STAGE)


def extend_log(spark: SparkSession, listing_pages: DataFrame, detail_pages: DataFrame | None, log_path: str, *,
               batch_id: int) -> DataFrame:
    """One incremental run: listing rows are in the log before any details are added.

    Returns what the run did: rows with details it added (none without detail pages), URLs
    that have details from other runs, and keys in the log.  Run again with one ``batch_id`` and the same
    pages it leaves the same log.
    """
    append_listing(spark, listing_pages, log_path, batch_id=batch_id)
    if detail_pages is not None:
        append_details(spark, detail_pages, log_path, batch_id=batch_id)
    log = scan_log(spark, log_path)
    own = (F.col("stage") == DETAIL_STAGE) & (F.col("batch_id") == batch_id)
    return run_counts(log, own if detail_pages is not None else F.lit(False), ~own)


def compact_job(spark: SparkSession, log_path: str, snapshot_path: str | None = None, *, drop: bool = False) -> None:
    """Compacts a log to the latest row per person.

    Without ``snapshot_path`` the snapshot becomes the start of the log itself, and the next run reads it
    in place of the batches it covers; ``drop`` removes those once it is committed.  With a path the
    rows are written to that new folder and the log stays as it is.
    """
    if snapshot_path is not None:
        latest_rows(spark, log_path).write.mode("errorifexists").parquet(snapshot_path)
        return
    commit_snapshot(spark, log_path)
    if drop:
        drop_covered(spark, log_path)


def listing_errors(listing_pages: DataFrame) -> DataFrame:
    """Listing pages that give no cards because they could not be read: answered with an error
    status, without HTML, or not parsed.  Every page is either here or was read."""
    if "part" not in listing_pages.columns:
        listing_pages = parse_pages(listing_pages, [PAGER], keep=PAGE_KEYS)
    return page_errors(listing_pages, keep=PAGE_KEYS)


def listing_progress(listing_pages: DataFrame, *, index_url: str = "url") -> DataFrame:
    """One progress event per captured listing page: its number, the total its pager
    shows, whether it is the last, and whether it links any further.  Fold it to get the listing state."""
    keep = list(dict.fromkeys([index_url, "page_seq"]))
    summary = pager_summary(good_pages(listing_pages), keep=keep, onward=True)
    return listing_events(summary.select(
        F.col(index_url).alias("index_url"),
        F.col("current_page").alias("page"),
        "total_pages",
        "onward",
        F.col("page_seq").alias("seq"),
    ))


def listing_state(progress: DataFrame) -> DataFrame:
    """Per index: the last page read, the highest total any page showed, completed or not.

    Completed is an index whose last page read is the highest any pager showed, or that was walked from page 1
    to a page that links no further, whatever higher number a pager named.
    """
    state = progress.groupBy("index_url").agg(
        F.max_by("page", "seq").alias("last_page"),
        F.max("total_pages").alias("total_pages"),
    ).withColumn("completed", F.coalesce(F.col("last_page") >= F.col("total_pages"), F.lit(False)))
    if "onward" not in progress.columns:
        return state
    ends = listing_ends(progress).select("index_url", "ended")
    return state.join(ends, "index_url", "left").withColumn(
        "completed", F.col("completed") | F.coalesce("ended", F.lit(False))).drop("ended")


def missing_listing_pages(progress: DataFrame, *, max_pages: int | None = None) -> DataFrame:
    """Listing pages that pagers speak of and that were not captured; of an index walked to its end, none after that."""
    captured = progress.select("index_url", F.col("page").alias("page_no"))
    totals = index_totals(progress)
    if "onward" in progress.columns:
        ends = listing_ends(progress).filter("ended").select("index_url", "reached")
        totals = totals.join(ends, "index_url", "left").select(
            "index_url", F.least("total_pages", F.coalesce("reached", "total_pages")).alias("total_pages"))
    return page_gaps(captured, totals, max_pages=max_pages)


def listing_totals(listing_pages: DataFrame, *, index_url: str = "url") -> DataFrame:
    """Pages available over all indexes and pages captured."""
    return crawl_totals(listing_progress(listing_pages, index_url=index_url))
