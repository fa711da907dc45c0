"""Folders of partitioned tables in any store that Spark reaches."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, system = _path(spark, path)
    return system.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder; nothing happens if it is not there."""
    place, system = _path(spark, path)
    system.delete(place, True)


def rename(spark: SparkSession, path: str, new: str) -> None:
    """Move a folder. In stores with folders this is one step."""
    place, system = _path(spark, path)
    if not system.rename(place, _path(spark, new)[0]):
        raise OSError(f"cannot rename {path} to {new}")


def make_folder(spark: SparkSession, path: str) -> None:
    place, system = _path(spark, path)
    system.mkdirs(place)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder; none if it is not there."""
    place, system = _path(spark, path)
    return [status.getPath().getName() for status in system.listStatus(place)] if system.exists(place) else []


def partition_folder(spark: SparkSession, root: str, column: str, value: str | None) -> str:
    """The folder that holds the rows with this value (as text) of the partition column."""
    names = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    name = names.DEFAULT_PARTITION_NAME() if value in (None, "") else names.escapePathName(value)
    return f"{root.rstrip('/')}/{column}={name}"
