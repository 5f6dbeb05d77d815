"""Reading plain tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


#: A scan partition is cut into at most this many.
SPREAD = 8


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None,
               spread_by: str | None = None) -> DataFrame:
    """Scans parquet; ``columns`` limits the scan.

    ``spread_by`` names a column of distinct values to spread the rows by if the scan
    has fewer partitions than the session has cores, as one file of little size does.
    Inputs with enough partitions are left where they are.
    """
    df = spark.read.parquet(path)
    if columns is not None:
        df = df.select(*columns)
    if spread_by:
        have = df.rdd.getNumPartitions()
        wanted = min(spark.sparkContext.defaultParallelism, SPREAD * have)
        if have < wanted:
            df = df.repartition(wanted, spread_by)
    return df
