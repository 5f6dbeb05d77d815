"""The append-only record log and its snapshots, both parquet.

A log is a folder ``stage=<s>/batch_id=<b>/`` of parquet files.  Each append owns one
such folder and replaces it as a whole, so a batch that is run again after a failure
leaves the same rows and not a second copy.  ``LOG_ORDER`` orders all rows of a log.

A snapshot within the log stands for every batch it covers: the latest row of each key,
filed in buckets by a hash of the key.  It counts once its manifest is there, which is
written last; a compaction that dies before leaves the log as it was.  From then on the log
is read as the snapshot and the batches after it, and the folders of covered batches may go.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitarium.functions.urls import with_record_key
from vitarium.operators.records import compact_latest, merge_records
from vitarium.schema import LISTING_STAGE, LOG, LOG_ORDER
from vitarium.sources.files import exists, folders, remove

PARTITIONS = ["stage", "batch_id"]
#: Rows a bucket of a snapshot should hold, and the most buckets; a batch reads only those its keys fall into.
BUCKET_ROWS = 100_000
MAX_BUCKETS = 4096

_FIRST = T.StructField("first_seq", T.StructType([LOG[c] for c in LOG_ORDER]))
SNAPSHOT = T.StructType([*LOG.fields, _FIRST, T.StructField("bucket", T.IntegerType())])
#: One row per run of batch ids that a snapshot covers.
MANIFEST = T.StructType([
    T.StructField("folder", T.StringType()), T.StructField("buckets", T.IntegerType()),
    T.StructField("stage", T.IntegerType()), T.StructField("first", T.LongType()), T.StructField("last", T.LongType())])


class Snapshot(NamedTuple):
    """The snapshot a log starts from: its rows, and the batches they stand for."""

    folder: str
    buckets: int
    covered: list[tuple[int, int, int]]

    def covers(self, stage: int, batch_id: int) -> bool:
        return any(stage == s and first <= batch_id <= last for s, first, last in self.covered)

    def batches(self) -> set[tuple[int, int]]:
        return {(s, b) for s, first, last in self.covered for b in range(first, last + 1)}


def _is_missing(error: AnalysisException) -> bool:
    return error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def snapshot_of(spark: SparkSession, path: str) -> Snapshot | None:
    """The latest committed snapshot of a log."""
    for name in reversed(folders(spark, f"{path}/_commits")):
        rows = spark.read.schema(MANIFEST).json(f"{path}/_commits/{name}").collect()
        if rows:  # else its writer died
            return Snapshot(rows[0].folder, rows[0].buckets, sorted((r.stage, r.first, r.last) for r in rows))
    return None


def covered(spark: SparkSession, path: str, stage: int, batch_id: int) -> bool:
    """Whether a snapshot stands for this batch already."""
    state = snapshot_of(spark, path)
    return state is not None and state.covers(stage, batch_id)


def finished_batches(spark: SparkSession, path: str) -> list[tuple[int, int]]:
    """``(stage, batch_id)`` of all batches that were written to the end."""
    return [
        (int(stage.split("=")[1]), int(batch.split("=")[1]))
        for stage in folders(spark, path) if stage.startswith("stage=")
        for batch in folders(spark, f"{path}/{stage}") if exists(spark, f"{path}/{stage}/{batch}/_SUCCESS")
    ]


def append_checkpoint(df: DataFrame, path: str, *, batch_id: int, stage: int = LISTING_STAGE) -> bool:
    """Writes one batch of keyed records to the log.

    Rows without a key are dropped, columns the log does not have as well; columns
    the table lacks are NULL.  ``batch_id`` must grow from append to append within a
    stage; using one again replaces that batch.  A batch that a snapshot covers is in
    the log for good: nothing is written, and the result is False.
    """
    if covered(df.sparkSession, path, stage, batch_id):
        return False
    keyed = df if "record_key" in df.columns else with_record_key(df)
    columns = [
        (F.col(f.name) if f.name in keyed.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in LOG if f.name not in PARTITIONS
    ]
    rows = keyed.filter(F.coalesce(F.col("record_key"), F.lit("")) != "").select(*columns)
    rows.write.mode("overwrite").parquet(f"{path}/stage={stage}/batch_id={batch_id}")
    return True


def scan_batches(spark: SparkSession, path: str, state: Snapshot | None = None) -> DataFrame:
    """The rows of the batches that ``state`` does not cover; the files of others are not read."""
    try:
        log = spark.read.schema(LOG).option("basePath", path).parquet(path)
    except AnalysisException as error:
        if not _is_missing(error):
            raise
        return spark.createDataFrame([], LOG)
    for stage, first, last in state.covered if state else ():
        log = log.filter(~((F.col("stage") == stage) & F.col("batch_id").between(first, last)))
    return log


def bucket_of(state: Snapshot, key: str | Column = "record_key") -> Column:
    return F.pmod(F.xxhash64(key), F.lit(state.buckets)).cast("int")


def scan_snapshot(spark: SparkSession, path: str, state: Snapshot, *, keys: DataFrame | None = None) -> DataFrame:
    """The rows of a snapshot.

    ``keys`` (column ``record_key``) limits it to the buckets these fall into; at most
    ``MAX_BUCKETS`` numbers are asked for, and files of other buckets are not read.
    """
    rows = spark.read.schema(SNAPSHOT).parquet(f"{path}/_snapshots/{state.folder}")
    if keys is not None:
        touched = [r[0] for r in keys.select(bucket_of(state)).distinct().collect()]
        rows = rows.filter(F.col("bucket").isin(touched))
    return rows.drop("bucket")


def scan_log(spark: SparkSession, path: str, *, upto: Sequence[int] | None = None) -> DataFrame:
    """The rows of a log, from its snapshot on; none if it does not exist yet.

    ``upto=(stage, batch_id)`` bounds the scan: rows of later batches of that stage,
    or of later stages, are not seen, and their files are not read.  If the snapshot
    covers more than that, the covered batches are read instead, unless they were dropped.
    """
    state = snapshot_of(spark, path)
    if state is not None and upto is not None and any(b > tuple(upto) for b in state.batches()):
        if not state.batches() <= set(finished_batches(spark, path)):
            raise ValueError(f"the snapshot of {path} covers batches after {tuple(upto)}, which were dropped")
        state = None
    log = scan_batches(spark, path, state)
    if upto is not None:
        stage, batch_id = upto
        log = log.filter(
            (F.col("stage") < stage) | ((F.col("stage") == stage) & (F.col("batch_id") <= batch_id)))
    if state is None:
        return log
    return scan_snapshot(spark, path, state).select(*LOG.names).unionByName(log)


def latest_rows(spark: SparkSession, path: str, *, batches: Sequence[tuple[int, int]] | None = None) -> DataFrame:
    """The latest row per key of a log, with the place of its first.  ``batches`` limits those read beside the snapshot."""
    state = snapshot_of(spark, path)
    rows = scan_batches(spark, path, state)
    if batches is not None:
        wanted = F.lit(False)
        for stage, first, last in _runs(batches):
            wanted = wanted | ((F.col("stage") == stage) & F.col("batch_id").between(first, last))
        rows = rows.filter(wanted)
    rows = rows.withColumn("first_seq", F.struct(*LOG_ORDER))
    if state is not None:
        rows = scan_snapshot(spark, path, state).unionByName(rows)
    return compact_latest(rows, seq=LOG_ORDER, first="first_seq")


def _runs(batches: Sequence[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """Batches as runs of successive ids of a stage."""
    runs: list[tuple[int, int, int]] = []
    for stage, batch_id in sorted(batches):
        if runs and runs[-1][0] == stage and runs[-1][2] + 1 == batch_id:
            runs[-1] = (stage, runs[-1][1], batch_id)
        else:
            runs.append((stage, batch_id, batch_id))
    return runs


def commit_snapshot(spark: SparkSession, path: str, *, bucket_rows: int = BUCKET_ROWS) -> bool:
    """Compacts a log into a snapshot of its own, from which later reads start.

    Covers every batch written to the end by now.  False if there is none beside those covered.
    Of two that run at once one fails on the manifest, and its rows are never read.
    """
    state = snapshot_of(spark, path)
    before = state.batches() if state else set()
    batches = sorted(set(finished_batches(spark, path)) - before)
    if not batches:
        return False
    number = len(folders(spark, f"{path}/_commits"))
    rows = latest_rows(spark, path, batches=batches)
    most = scan_batches(spark, path, state).count() + (scan_snapshot(spark, path, state).count() if state else 0)
    new = Snapshot(uuid.uuid4().hex, min(MAX_BUCKETS, max(1, -(-most // bucket_rows))), _runs([*before, *batches]))
    rows = rows.withColumn("bucket", bucket_of(new)).select(*(F.col(f.name).cast(f.dataType) for f in SNAPSHOT))
    rows.repartition("bucket").write.partitionBy("bucket").parquet(f"{path}/_snapshots/{new.folder}")
    manifest = spark.createDataFrame([(new.folder, new.buckets, *run) for run in new.covered], MANIFEST)
    manifest.coalesce(1).write.mode("errorifexists").json(f"{path}/_commits/{number:08d}")
    return True


def drop_covered(spark: SparkSession, path: str) -> None:
    """Removes what the committed snapshot stands for: batches it covers and earlier snapshots.

    Not while older readers still run: they name the files they are about to read.
    """
    state = snapshot_of(spark, path)
    if state is None:
        return
    for stage, batch_id in state.batches() & set(finished_batches(spark, path)):
        remove(spark, f"{path}/stage={stage}/batch_id={batch_id}")
    for folder in folders(spark, f"{path}/_snapshots"):
        if folder != state.folder:
            remove(spark, f"{path}/_snapshots/{folder}")


def load_existing(spark: SparkSession, path: str) -> DataFrame:
    """The log merged to one row per key (latest present value per column)."""
    return merge_records(scan_log(spark, path), seq=LOG_ORDER)


def save_snapshot(df: DataFrame, path: str, *, seq: str | Sequence[str]) -> None:
    """Merges records and writes them to a new folder; an existing one is an error,
    since it may be an input of the same plan."""
    merge_records(df, seq=seq).write.mode("errorifexists").parquet(path)
