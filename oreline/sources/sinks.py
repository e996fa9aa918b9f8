"""Writes. Each is one action; rows are counted while they are written."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from oreline.sources.versions import current, publish


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The frame, and an observation that holds its ``rows`` once it has been written."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def write_plain(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> int:
    """Write files to a path itself and return the rows written."""
    watched, seen = counted(df)
    watched.write.format(fmt).mode(mode).save(path)
    return seen.get["rows"]


def write_path(df: DataFrame, path: str, fmt: str = "parquet") -> int:
    """Replace the table at a path by a new version and return the rows written.

    The version before stays readable until the new one is whole; ``read_path`` finds the latest.
    """
    return publish(df.sparkSession, path, lambda version: write_plain(df, version, fmt))


def append_path(df: DataFrame, path: str, fmt: str = "parquet") -> int:
    """Add rows; what is stored stays untouched."""
    return write_plain(df, current(df.sparkSession, path), fmt, mode="append")


def write_table(
    df: DataFrame,
    name: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    bucket_by: Sequence[str] = (),
    buckets: int = 0,
) -> int:
    """Write a catalog table and return the rows written.

    Two tables bucketed alike on their join key are joined without a shuffle.
    """
    watched, seen = counted(df)
    writer = watched.write.format(fmt).mode(mode)
    if bucket_by:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    writer.saveAsTable(name)
    return seen.get["rows"]


def publish_table(df: DataFrame, name: str, fmt: str = "parquet") -> int:
    """Replace a catalog table by a view change and return the rows written.

    Rows go to a table of their own; ``name`` is a view of the latest one, so it is whole at any
    time. The table before is kept for readers that have begun with it, older ones are dropped.
    """
    spark = df.sparkSession
    database, _, table = name.rpartition(".")
    within = f"{database}." if database else ""
    known = spark.sql(f"SHOW TABLES {f'IN {database} ' if database else ''}LIKE '{table}*'")
    known = sorted(r.tableName for r in known.where("NOT isTemporary").collect())
    pattern = rf"{re.escape(table.lower())}__v(\d{{8}})_[0-9a-f]{{8}}"
    versions = [t for t in known if re.fullmatch(pattern, t)]
    number = int(re.fullmatch(pattern, versions[-1])[1]) + 1 if versions else 1
    # The folder of a run that died may still be there, so no name comes twice.
    version = f"{within}{table}__v{number:08d}_{uuid.uuid4().hex[:8]}"
    rows = write_table(df, version, fmt)
    if table.lower() in known and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {name}")  # as it was kept before there were versions
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {version}")
    for old in versions[:-1]:
        spark.sql(f"DROP TABLE IF EXISTS {within}{old}")
    return rows


def write_all(
    frames: Mapping[str, DataFrame], base: str, fmt: str = "parquet", at_once: int = 4
) -> dict[str, int]:
    """Write each frame to ``base/<name>``; rows written per name.

    A few writes run side by side, so that the last tasks of one do not leave the cluster idle.
    They keep the caller's job group, description and scheduler pool.
    """
    return side_by_side(frames, lambda df, name: write_path(df, f"{base}/{name}", fmt), at_once)


def publish_all(
    frames: Mapping[str, DataFrame], name_of: Callable[[str], str], fmt: str = "parquet",
    at_once: int = 4,
) -> dict[str, int]:
    """As :func:`write_all`, for catalog tables."""
    return side_by_side(frames, lambda df, name: publish_table(df, name_of(name), fmt), at_once)


def side_by_side(
    frames: Mapping[str, DataFrame], put: Callable[[DataFrame, str], int], at_once: int
) -> dict[str, int]:
    if not frames:
        return {}
    spark = next(iter(frames.values())).sparkSession

    def write(name: str) -> int:
        return put(frames[name], name)

    with ThreadPoolExecutor(max_workers=at_once) as pool:
        # Wrapped once per name: the caller's settings are copied when wrapping.
        started = [pool.submit(inheritable_thread_target(spark)(write), name) for name in frames]
        return {name: job.result() for name, job in zip(frames, started)}


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def write_json_records(df: DataFrame, path: str) -> int:
    """One JSON object per line, missing values written as ``null``."""
    watched, seen = counted(df)
    watched.write.option("ignoreNullFields", "false").mode("overwrite").json(path)
    return seen.get["rows"]


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    """Delimited text with a header that ``read_csv`` gives back unchanged."""
    watched, seen = counted(df)
    options = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    watched.write.options(header="true", escape='"', emptyValue="", **options).mode(mode).csv(path)
    return seen.get["rows"]
