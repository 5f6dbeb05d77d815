"""Incremental form of the catalogue: captured pages arrive as files.

The jobs use ``foreachBatch`` on batch operators.  Each micro-batch owns one folder
of the log, so a batch that is run again after a failure replaces its own output.
"""

from __future__ import annotations

from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout
from pyspark.sql.types import LongType, StructField, StructType

from vitarium.functions.urls import with_record_key
from vitarium.operators.listing import fold_listing_state
from vitarium.operators.records import Seq, known_keys
from vitarium.plans.catalogue import append_details, append_listing
from vitarium.schema import DETAIL_STAGE, LISTING_STAGE
from vitarium.sources.log import commit_snapshot, finished_batches, snapshot_of

#: Micro-batches of one run get ids ``run_id * RUN_SPAN + n``.
RUN_SPAN = 1 << 40
#: Micro-batches of listing pages between two snapshots of the log.
COMPACT_EVERY = 32


def _begun(spark: SparkSession, checkpoint: str) -> bool:
    try:
        spark.read.text(f"{checkpoint}/metadata")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def _used(spark: SparkSession, log_path: str, stage: int, first: int) -> bool:
    """Whether the log has batches of a run, in folders or in its snapshot."""
    state = snapshot_of(spark, log_path)
    runs = [(s, b, b) for s, b in finished_batches(spark, log_path)] + (state.covered if state else [])
    return any(s == stage and low < first + RUN_SPAN and high >= first for s, low, high in runs)


def _start(pages: DataFrame, append, log_path: str, stage: int, checkpoint: str, run_id: int,
           compact_every: int | None) -> StreamingQuery:
    spark, first = pages.sparkSession, run_id * RUN_SPAN
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    if not _begun(spark, checkpoint):
        if _used(spark, log_path, stage, first):
            raise ValueError(f"run_id {run_id} is used in this log: a new checkpoint folder needs a higher one")

    def batch(df: DataFrame, epoch: int) -> None:
        # The session of a stream plans without adaptive execution.  A micro-batch is plain
        # batch work and wants its partition sizes and joins chosen at run time.
        df.sparkSession.conf.set("spark.sql.adaptive.enabled", adaptive)
        append(df.sparkSession, df, log_path, batch_id=first + epoch)
        if compact_every and (epoch + 1) % compact_every == 0:
            commit_snapshot(df.sparkSession, log_path)

    return (
        pages.writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest_stream(pages: DataFrame, log_path: str, checkpoint: str, *, run_id: int = 0,
                  compact_every: int | None = COMPACT_EVERY) -> StreamingQuery:
    """Listing pages to new listing rows of the log.

    Micro-batches count from 0 in each checkpoint folder, so give a higher ``run_id``
    whenever you begin with a new one.  Each micro-batch reads the keys of the batches since
    the last snapshot, and of the snapshot the buckets its own keys fall into.  A snapshot is
    committed every ``compact_every`` micro-batches (None: never); let only one stream of a log do that.
    """
    return _start(pages, append_listing, log_path, LISTING_STAGE, checkpoint, run_id, compact_every)


def enrich_stream(pages: DataFrame, log_path: str, checkpoint: str, *, run_id: int = 0,
                  retry_errors: bool = False, compact_every: int | None = None) -> StreamingQuery:
    """Detail pages to detail rows of the log, for persons that still lack details."""
    append = partial(append_details, retry_errors=retry_errors)
    return _start(pages, append, log_path, DETAIL_STAGE, checkpoint, run_id, compact_every)


def stream_dedupe(records: DataFrame, *, seq: str, event_time: str, forget_after: str, known: DataFrame | None = None) -> DataFrame:
    """The first whole record of each key within a stream: of the first micro-batch that has the key, the least ``seq``.

    A key is remembered until the watermark, ``forget_after`` behind the latest ``event_time``, has passed the
    last time it was first seen; so state holds the keys of that span and no more.  Records that come
    later than the watermark are dropped.  ``known`` (say, the keys of the log) rules out older keys for good.
    """
    keyed = records if "record_key" in records.columns else with_record_key(records)
    keyed = keyed.filter(F.coalesce(F.col("record_key"), F.lit("")) != "").withWatermark(event_time, forget_after)
    if known is not None:
        keyed = keyed.join(known_keys(known), "record_key", "left_anti")
    columns = keyed.columns

    def first(key, parts, state):
        if state.hasTimedOut:
            state.remove()
            return
        best, latest = None, None
        for part in parts:  # a hot key comes in portions; one row of it is held
            row = part.loc[[part[seq].idxmin()]]
            best = row if best is None or row[seq].iloc[0] < best[seq].iloc[0] else best
            newest = part[event_time].max()
            latest = newest if latest is None or newest > latest else latest
        if state.exists:
            return
        state.update((True,))
        state.setTimeoutTimestamp(max(int(latest.timestamp() * 1000), state.getCurrentWatermarkMs() + 1))
        yield best[columns]

    return keyed.groupBy("record_key").applyInPandasWithState(
        first, keyed.schema, "seen boolean", "append", GroupStateTimeout.EventTimeTimeout)


def stream_state(events: DataFrame, *, seq: Seq, index_url: str = "index_url", page: str = "page",
                 updated_at: str = "updated_at", keep_html: bool = False) -> DataFrame:
    """Listing state kept up to date.

    ``keep_html`` holds the latest page's HTML of each index in the state, so that a resumed run can read on from it;
    by default it stays in the pages table.
    """
    events = events if keep_html else events.drop("html")
    return fold_listing_state(events, seq=seq, index_url=index_url, page=page, updated_at=updated_at)


def write_state(state: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Writes each micro-batch's changed indexes, and only those, as a new version of a keyed table."""
    def version(df: DataFrame, epoch: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/version={epoch}")

    return (
        state.writeStream.outputMode("update").foreachBatch(version)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def read_state(spark: SparkSession, path: str, schema: StructType, *, index_url: str = "index_url") -> DataFrame:
    """The latest version of each index's state."""
    rows = spark.read.schema(StructType([*schema.fields, StructField("version", LongType())])).parquet(path)
    values = [c for c in schema.names if c != index_url]
    return rows.groupBy(index_url).agg(F.max_by(F.struct(*values), "version").alias("row")).select(index_url, "row.*")
