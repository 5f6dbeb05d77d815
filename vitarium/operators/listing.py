"""Listing state: how far each index page has been read, and what is left."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitarium.operators.records import Seq
from vitarium.operators.skew import order_by, seq_columns


def fold_listing_state(events: DataFrame, *, seq: Seq, index_url: str = "index_url", page: str = "page",
                       updated_at: str = "updated_at") -> DataFrame:
    """One row per index page: each column's latest present value, plus ``last_page``
    and ``updated_at`` of the latest event whatever it holds."""
    order = order_by(seq)
    fixed = (index_url, updated_at, *seq_columns(seq))
    values = [c for c in events.columns if c not in fixed]
    return events.groupBy(index_url).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(c) for c in values],
        F.max_by(page, order).alias("last_page"),
        F.max_by(updated_at, order).alias(updated_at),
    )


def listing_events(progress: DataFrame, *, page: str = "page", total_pages: str = "total_pages") -> DataFrame:
    """Marks an event completed only once the last page has been read.

    A page limit that ends a listing early therefore does not mark it completed.
    """
    return progress.withColumn("completed", F.coalesce(F.col(page) >= F.col(total_pages), F.lit(False)))


def listing_ends(progress: DataFrame, *, index_url: str = "index_url", page: str = "page", onward: str = "onward",
                 seq: Seq = "seq") -> DataFrame:
    """How far each index can be walked: ``reached``, the last page of the unbroken run that starts at page 1, and
    ``ended``, whether the latest capture of that page links no further.

    An index whose first page was not captured has no row.  A page and its successor meet in one aggregation:
    each captured page is counted under its own number and asks for the next.
    """
    pages = progress.groupBy(index_url, F.col(page).cast("bigint").alias("no")).agg(
        F.max_by(F.coalesce(F.col(onward), F.lit(True)), order_by(seq)).alias("onward"))
    met = pages.select(index_url, F.explode(F.array(
        F.struct("no", F.lit(True).alias("captured"), F.lit(None).cast("boolean").alias("linked")),
        F.struct((F.col("no") + 1).alias("no"), F.lit(False).alias("captured"), F.col("onward").alias("linked")),
    )).alias("p")).groupBy(index_url, "p.no").agg(F.max("p.captured").alias("captured"), F.max("p.linked").alias("linked"))
    gap = F.when(~F.col("captured") & (F.col("no") > 1), F.col("no"))
    return (
        met.groupBy(index_url)
        .agg(F.max((F.col("no") == 1) & F.col("captured")).alias("begun"), F.min(gap).alias("gap"),
             F.min_by("linked", gap).alias("linked"))
        .filter("begun")
        .select(index_url, (F.col("gap") - 1).alias("reached"), (~F.col("linked")).alias("ended"))
    )


def resume_points(index_urls: DataFrame, state: DataFrame, *, index_url: str = "index_url") -> DataFrame:
    """Index pages still to read and where to start: after the saved page if its number
    and HTML were saved, else at page 1.

    A state without an ``html`` column stands for pages kept in the pages table.
    """
    saved = F.coalesce(F.col("last_page") != 0, F.lit(False))
    columns = [index_url, "completed", "last_page"]
    if "html" in state.columns:
        saved = saved & F.coalesce(F.col("html") != "", F.lit(False))
        columns.append("html")
    return (
        index_urls.join(state.select(*columns), index_url, "left")
        .filter(~F.coalesce("completed", F.lit(False)))
        .select(
            *index_urls.columns,
            F.when(saved, F.col("last_page")).otherwise(1).cast("bigint").alias("start_page"),
            saved.alias("resumed"),
        )
    )


#: Page numbers are listed in spans of this many, so one long index becomes many tasks.
PAGE_SPAN = 10_000


def pages_ahead(state: DataFrame, *, max_pages: int | None = None, index_url: str = "index_url",
                last_page: str = "last_page", total_pages: str = "total_pages") -> DataFrame:
    """Page numbers after the last one read, up to the total or the page limit."""
    start = F.coalesce(F.col(last_page), F.lit(0)).cast("bigint") + 1
    stop = F.col(total_pages).cast("bigint")
    if max_pages:
        # least() would pass over an unknown total
        stop = F.when(stop.isNotNull(), F.least(stop, F.lit(max_pages).cast("bigint")))
    # sequence() would count down over an empty range, hence the filter
    span = state.filter(stop >= start).select(index_url, stop.alias("__stop"), F.explode(
        F.sequence(start, stop, F.lit(PAGE_SPAN).cast("bigint"))).alias("__start"))
    partitions = int(state.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return span.repartition(partitions, index_url, "__start").select(
        index_url,
        F.explode(F.sequence("__start", F.least("__stop", F.col("__start") + (PAGE_SPAN - 1)))).alias("page_no"),
    )


def page_gaps(captured: DataFrame, totals: DataFrame, *, max_pages: int | None = None,
              index_url: str = "index_url", page_no: str = "page_no",
              total_pages: str = "total_pages") -> DataFrame:
    """Pages of each index that should exist, from 1 to its total, and are not captured."""
    first = totals.withColumn("__before", F.lit(0))
    expected = pages_ahead(first, max_pages=max_pages, index_url=index_url,
                           last_page="__before", total_pages=total_pages)
    have = captured.select(index_url, F.col(page_no).cast("bigint").alias("page_no")).distinct()
    return expected.join(have, [index_url, "page_no"], "left_anti")


def index_totals(progress: DataFrame, *, index_url: str = "index_url",
                 total_pages: str = "total_pages") -> DataFrame:
    """The highest page total ever seen for each index."""
    return progress.groupBy(index_url).agg(F.max(total_pages).alias("total_pages"))


def crawl_totals(progress: DataFrame, *, index_url: str = "index_url", total_pages: str = "total_pages",
                 resumed: str | None = None) -> DataFrame:
    """One row: pages available over all indexes, and pages read in this run.

    ``progress`` has a row per page read; rows flagged ``resumed`` (a saved page read
    in an earlier run) count towards the totals only.
    """
    read = F.count("*") if resumed is None else F.count_if(~F.coalesce(F.col(resumed), F.lit(False)))
    per_index = progress.groupBy(index_url).agg(F.max(total_pages).alias("total"), read.alias("read"))
    return per_index.agg(
        F.coalesce(F.sum("total"), F.lit(0)).cast("bigint").alias("total_pages"),
        F.coalesce(F.sum("read"), F.lit(0)).cast("bigint").alias("scraped_pages"),
    )
