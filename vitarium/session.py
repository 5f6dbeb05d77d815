"""Session settings and the shared scratch folder."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SCRATCH_SETTING = "spark.checkpoint.dir"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("vitarium")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


@functools.cache
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="vitarium-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder named in ``spark.checkpoint.dir``.

    The folder must be reachable by every executor, so it is taken from the session.
    Only a session that runs in one process (``local[...]``) may do without.
    """
    root = spark.conf.get(SCRATCH_SETTING, None)
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"{SCRATCH_SETTING} must name a folder that all executors share")
        root = _local_scratch()
    return f"{root.rstrip('/')}/vitarium/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: no lineage, no recomputation."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
