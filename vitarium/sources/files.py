"""What folders hold, asked of whatever file system a path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _at(spark, path)
    return system.exists(place)


def folders(spark: SparkSession, path: str) -> list[str]:
    """The names of the folders in a folder, in order; none if it does not exist."""
    system, place = _at(spark, path)
    if not system.exists(place):
        return []
    return sorted(entry.getPath().getName() for entry in system.listStatus(place) if entry.isDirectory())


def remove(spark: SparkSession, path: str) -> None:
    """Removes a folder with all it holds; nothing happens if there is none."""
    system, place = _at(spark, path)
    system.delete(place, True)
