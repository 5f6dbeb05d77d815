"""Keyed operators on record tables: merge, compaction, frontiers, enrichment.

There are four rules for which row of a key counts, one operator for each:
``merge_records`` latest value per column, ``compact_latest`` latest whole row,
``new_records_only`` first row of an unknown key, ``detail_frontier`` first row of
a URL without details.  ``seq`` names the column or columns that order the rows;
positions must not tie within a key.

All of them combine rows per key before the shuffle, so a key that holds a large
share of the rows sends one row per task and not its whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitarium.functions.urls import with_record_key
from vitarium.operators.pages import http_error
from vitarium.operators.skew import lookup_join, order_by, seq_columns

Seq = str | Sequence[str]


def _with_key(df: DataFrame, key: str) -> DataFrame:
    return df if key in df.columns else with_record_key(df, key)


def _keyed(df: DataFrame, key: str) -> DataFrame:
    return _with_key(df, key).filter(F.coalesce(F.col(key), F.lit("")) != "")


def merge_records(df: DataFrame, *, seq: Seq, key: str = "record_key") -> DataFrame:
    """One row per key; each column has its latest value that is not NULL.

    Rows without a key are dropped.  ``first_seq`` is the position of the key's
    first row: order by it to list keys as first seen.
    """
    order = order_by(seq)
    keyed = _keyed(df, key)
    values = [c for c in df.columns if c not in (key, *seq_columns(seq))]
    latest = [F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(c) for c in values]
    return keyed.groupBy(key).agg(*latest, F.min(order).alias("first_seq"))


def compact_latest(df: DataFrame, *, seq: Seq, key: str = "record_key", first: str | None = None) -> DataFrame:
    """The latest whole row of each key, NULLs included, with ``first_seq``.

    ``first`` names a column with the first position of rows that were compacted before.
    """
    order = order_by(seq)
    rows = _keyed(df, key).groupBy(key).agg(
        F.max_by(F.struct(*[c for c in df.columns if c not in (key, first)]), order).alias("row"),
        F.min(order if first is None else F.col(first)).alias("first_seq"),
    )
    return rows.select(key, "row.*", "first_seq")


def _first_rows(df: DataFrame, key: str, order: Column) -> DataFrame:
    others = [c for c in df.columns if c != key]
    rows = df.groupBy(key).agg(F.min_by(F.struct(*others), order).alias("row"))
    return rows.select(key, "row.*").select(*df.columns)


def new_records_only(batch: DataFrame, known: DataFrame, *, seq: Seq, key: str = "record_key") -> DataFrame:
    """Records of the batch whose key is not among ``known``; of several, the first.

    The batch is reduced to one row per key first; the anti-join then reuses that
    partitioning and can meet no repeated key on either side.
    """
    fresh = _first_rows(_keyed(batch, key), key, order_by(seq))
    return fresh.join(known_keys(known, key), key, "left_anti").select(*fresh.columns)


def has_details(df: DataFrame, retry_errors: bool = False) -> Column:
    """A record is done once it has a text or an error; an error is final unless
    ``retry_errors``."""
    def filled(column):
        return F.coalesce(F.col(column) != "", F.lit(False)) if column in df.columns else F.lit(False)

    text = filled("biography_text")
    return text if retry_errors else text | filled("biography_error")


def known_keys(log: DataFrame, key: str = "record_key") -> DataFrame:
    """The distinct keys of a log."""
    return _keyed(log, key).select(key).distinct()


def enriched_urls(log: DataFrame, *, url: str = "url", retry_errors: bool = False) -> DataFrame:
    """The distinct URLs, as written, that have details."""
    done = log.filter(has_details(log, retry_errors))
    return done.select(url).filter(F.coalesce(F.col(url), F.lit("")) != "").distinct()


def log_progress(log: DataFrame, *, key: str = "record_key", url: str = "url") -> DataFrame:
    """One row: distinct keys, distinct URLs with details, and rows of any kind."""
    keyed = _with_key(log, key)
    address = F.nullif(F.col(url), F.lit(""))
    return keyed.agg(
        F.count_distinct(F.nullif(F.col(key), F.lit(""))).alias("known_keys"),
        F.count_distinct(F.when(has_details(log), address)).alias("enriched_urls"),
        F.count("*").alias("row_count"),
    )


def detail_frontier(records: DataFrame, *, seq: Seq, done: DataFrame | None = None, url: str = "url",
                    retry_errors: bool = False) -> DataFrame:
    """The first row of each URL that still lacks details.

    Details may stand on any row of the URL, or the URL may be listed in ``done``.
    """
    order = order_by(seq)
    others = [c for c in records.columns if c != url]
    finished = has_details(records, retry_errors)
    per_url = (
        records.filter(F.coalesce(F.col(url), F.lit("")) != "")
        .groupBy(url)
        .agg(
            # a row with details rules its URL out, so its texts need not travel
            F.min_by(F.when(~finished, F.struct(*others)), order).alias("row"),
            F.max(finished).alias("done"),
        )
        .filter(~F.col("done"))
    )
    if done is not None:
        per_url = per_url.join(done.select(url).distinct(), url, "left_anti")
    return per_url.select(url, "row.*").select(*records.columns)


def enrich(records: DataFrame, details: DataFrame, *, url: str = "url", detail_key: str = "biography_url",
           seq: Seq | None = None, how: str = "left", spread_by: Sequence[str] | None = None) -> DataFrame:
    """Puts the details of its URL on every record; values present there win.

    The join is on the URL as written, so rows that share one share its details, and
    rows without one pass unchanged.  ``details`` has one row per ``detail_key`` or,
    with ``seq``, its latest row counts.  ``spread_by`` names columns that tell
    records without a URL apart (default: all).
    """
    if seq is not None:
        columns = [c for c in details.columns if c not in (detail_key, *seq_columns(seq))]
        details = (
            details.groupBy(detail_key)
            .agg(F.max_by(F.struct(*columns), order_by(seq)).alias("row"))
            .select(detail_key, "row.*")
        )
    fields = [c for c in details.columns if c != url]
    right = details.select(
        F.col(detail_key).alias("__url"),
        *[F.col(c).alias(f"__d_{c}") for c in fields],
    )
    joined = lookup_join(records.withColumn("__url", F.col(url)), right, "__url", how=how, spread_by=spread_by)
    merged = [F.coalesce(f"__d_{c}", c).alias(c) if c in fields else F.col(c) for c in records.columns]
    added = [F.col(f"__d_{c}").alias(c) for c in fields if c not in records.columns]
    return joined.select(*merged, *added)


def details_of_existing(existing: DataFrame, *, seq: Seq, url: str = "url") -> DataFrame:
    """Finished records as details: all their columns, latest whole record per URL.

    The URL is repeated as ``detail_url`` to join on.
    """
    done = existing.filter(has_details(existing)).filter(F.coalesce(F.col(url), F.lit("")) != "")
    columns = [c for c in existing.columns if c not in seq_columns(seq)]
    rows = done.groupBy(F.col(url).alias("detail_url")).agg(
        F.max_by(F.struct(*columns), order_by(seq)).alias("row")
    )
    return rows.select("detail_url", "row.*")


def capture_errors(frontier: DataFrame, pages: DataFrame, *, seq: Seq, url: str = "url",
                   status: str = "status") -> DataFrame:
    """Error rows for frontier URLs whose latest capture has a status outside 200-299.

    URLs that were not captured at all stay in the frontier and give no row.
    """
    latest = pages.groupBy(url).agg(F.max_by(status, order_by(seq)).alias(status))
    return (
        frontier.select(url).join(latest, url, "inner")
        .filter(~F.col(status).between(200, 299))
        .select(
            F.col(url).alias("biography_url"),
            http_error(status, url).alias("biography_error"),
        )
    )


def enrich_stats(log: DataFrame, *, url: str = "url", key: str = "record_key") -> DataFrame:
    """One row on a log before enrichment: URLs to do, already done, seen, and keys."""
    address = F.nullif(F.col(url), F.lit(""))
    counts = _with_key(log, key).agg(
        F.count_distinct(F.when(has_details(log), address)).alias("skipped"),
        F.count_distinct(address).alias("total_seen"),
        F.count_distinct(F.nullif(F.col(key), F.lit(""))).alias("records_saved"),
    )
    return counts.select(
        (F.col("total_seen") - F.col("skipped")).alias("scraped"), "skipped", "total_seen", "records_saved"
    )


def run_counts(log: DataFrame, now: Column, before: Column, *, url: str = "url", key: str = "record_key") -> DataFrame:
    """One row on a log after a run: rows the run added (``now``), URLs that rows from ``before`` had
    finished, keys seen and keys saved (the log keeps every key it has seen)."""
    counts = log.agg(
        F.count(F.when(now, F.lit(1))).alias("scraped"),
        F.count_distinct(F.when(before & has_details(log), F.nullif(F.col(url), F.lit("")))).alias("skipped"),
        F.count_distinct(F.nullif(F.col(key), F.lit(""))).alias("records_saved"),
    )
    return counts.select("scraped", "skipped", F.col("records_saved").alias("total_seen"), "records_saved")
