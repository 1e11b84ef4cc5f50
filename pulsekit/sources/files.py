"""The few things done to folders as a whole, on whatever file system Spark writes to."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, system = _place(spark, path)
    return system.exists(place)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none if it is not there."""
    place, system = _place(spark, path)
    if not system.exists(place):
        return []
    return sorted(f.getPath().getName() for f in system.listStatus(place) if f.isDirectory())


def remove(spark: SparkSession, path: str) -> None:
    place, system = _place(spark, path)
    system.delete(place, True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    place, system = _place(spark, source)
    if not system.rename(place, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"could not rename {source} to {target}")
