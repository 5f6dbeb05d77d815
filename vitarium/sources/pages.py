"""Captured pages: ``url, html, page_seq`` (the order of capture) and optionally ``status``.

Jobs on listing pages need ``page_seq``; detail pages without it count as captured at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitarium.schema import PAGES


#: Bytes of stored pages that one task should parse.
TASK_BYTES = 1 << 20


def read_pages(spark: SparkSession, path: str, *, spread: bool = True) -> DataFrame:
    """Pages of a parquet table.

    Parsing is the costly step.  If the scan has fewer partitions than the table's bytes are worth, up to the
    session's cores, rows are dealt out by a hash of the whole row, so pages of one url go to all tasks.
    ``spread=False`` leaves rows where they are, for queries that do not parse.
    """
    pages = spark.read.parquet(path)
    if not spread:
        return pages
    size = int(str(pages._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    wanted = min(spark.sparkContext.defaultParallelism, -(-size // TASK_BYTES))
    if pages.rdd.getNumPartitions() >= wanted:
        return pages
    return pages.repartition(wanted, F.xxhash64(*(F.col(f"`{c}`") for c in pages.columns)))


def stream_pages(spark: SparkSession, path: str, *, files_per_batch: int | None = None) -> DataFrame:
    """The same as a stream of newly arriving files."""
    reader = spark.readStream.schema(PAGES)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def good_pages(pages: DataFrame) -> DataFrame:
    """Pages that were answered with a status of 200-299; no status counts as good."""
    if "status" not in pages.columns:
        return pages
    return pages.filter(F.coalesce(F.col("status").between(200, 299), F.lit(True)))
