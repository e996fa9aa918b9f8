"""Files and folders on whatever file system a URI names; each call is one of the file system's own."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _at(spark, path)
    return files.exists(place)


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder, in order; nothing if there is no such folder."""
    files, place = _at(spark, folder)
    if not files.exists(place):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(place))


def touch(spark: SparkSession, path: str) -> None:
    """An empty file, there at once or not at all."""
    files, place = _at(spark, path)
    if not files.createNewFile(place):
        raise FileExistsError(path)


def move(spark: SparkSession, source: str, target: str) -> None:
    """One rename; the target must not be there."""
    files, place = _at(spark, source)
    to = _at(spark, target)[1]
    files.mkdirs(to.getParent())
    if files.exists(to) or not files.rename(place, to):
        raise OSError(f"{source} cannot be moved to {target}")


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if it is there."""
    files, place = _at(spark, path)
    files.delete(place, True)


def same_path(path: str, encoded: bool = False) -> str:
    """A path in one spelling: Spark's columns differ in slashes and in how they encode."""
    plain = unquote(path) if encoded else path
    return re.sub(r"^(\w+):/+", r"\1:/", plain)
