"""Folders of whatever store Spark reads, by its own file systems."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _at(spark, path)
    return system.exists(place)


def names(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder, none if it isn't there."""
    system, place = _at(spark, path)
    return [s.getPath().getName() for s in system.listStatus(place)] if system.exists(place) else []


def remove(spark: SparkSession, path: str) -> None:
    """Removes a folder and all in it; nothing if it isn't there."""
    system, place = _at(spark, path)
    system.delete(place, True)
