"""Tables by path that are replaced as a whole, never in place.

A new version is written beside the old one, in a hidden folder of the table, and published by one
empty file whose name says which version counts. Until then, and if the writer dies, readers see the
old version whole. The version before is kept for readers that have begun with it; older ones, and
what dead writers left, go with the next publication. One writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import SparkSession

from oreline.sources import files

T = TypeVar("T")

_VERSION, _MARK = "_v-", "_published-"
KEPT = 2


def _published(names: list[str]) -> list[tuple[int, str]]:
    """(number, version) of all publications, the latest one last."""
    marks = [name.removeprefix(_MARK).split("-") for name in names if name.startswith(_MARK)]
    return sorted((int(number), version) for number, version in marks)


def current(spark: SparkSession, path: str) -> str:
    """The folder that holds the table now: its latest version, or the path itself."""
    known = _published(files.names_in(spark, path))
    return f"{path}/{_VERSION}{known[-1][1]}" if known else path


def publish(spark: SparkSession, path: str, write: Callable[[str], T]) -> T:
    """Let ``write`` fill the folder of a new version, then make that the table."""
    version = uuid.uuid4().hex
    result = write(f"{path}/{_VERSION}{version}")
    names = files.names_in(spark, path)
    known = _published(names)
    number = known[-1][0] + 1 if known else 1
    files.touch(spark, f"{path}/{_MARK}{number:08d}-{version}")
    kept = [v for _, v in known[1 - KEPT :]] + [version]
    for name in names:
        old = name.startswith((_VERSION, _MARK)) and name.rpartition("-")[2] not in kept
        # Files of a table that was written straight to its path before.
        if old or name.startswith(("part-", ".part-", "_SUCCESS")):
            files.delete(spark, f"{path}/{name}")
    return result
