"""Typed reads. Delimited columns are found by the name in the header, never by position."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from oreline.operators.reshape import quoted
from oreline.sources.files import same_path
from oreline.sources.versions import current

CORRUPT_COLUMN = "_corrupt_record"

_OPTIONS = {
    "header": "true",
    "mode": "PERMISSIVE",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "escape": '"',
    # A file whose header is not in the order of the schema fails instead of swapping columns.
    "enforceSchema": "false",
    "columnNameOfCorruptRecord": CORRUPT_COLUMN,
}


class HeaderMismatch(ValueError):
    """A delimited file does not have the columns it must."""


def header_of(spark: SparkSession, path: str | Sequence[str]) -> list[str]:
    """Column names of a delimited file, or of the first one of several."""
    options = {k: v for k, v in _OPTIONS.items() if k != "columnNameOfCorruptRecord"}
    return spark.read.options(**options).csv(path).columns


def _lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """The lines that hold anything: path, at (where the line's block begins), line, value."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("at"),
        F.monotonically_increasing_id().alias("line"),
        "value",
    )
    return lines.where(F.trim("value") != "")


def _cut_off() -> Column:
    """Whether a line has an odd number of quotes: then a quoted field goes on in the next one."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return quotes % 2 == 1


@dataclass(frozen=True)
class Survey:
    """What one pass over the lines of delimited files tells.

    ``headers`` has the first line of each file that can be a header, ``broken`` the files with line
    breaks in quoted fields, ``lines`` the lines of all files, headers included.
    """

    headers: dict[str, str]
    broken: set[str]
    lines: int


def survey(spark: SparkSession, path: str | Sequence[str], names: Sequence[str]) -> Survey:
    """One pass on the executors; the driver gets one row per file."""
    seen = Observation()
    lines = _lines(spark, path).observe(seen, F.count(F.lit(1)).alias("lines"))
    # A first line that names all columns; what is odd about it shows when the file is read.
    header = F.col("at") == 0
    for name in names:
        header = header & F.contains("value", F.lit(name))
    found = (
        lines.withColumn("header", F.when(header, F.struct("line", "value")))
        .withColumn("broken", _cut_off())
        .where("header IS NOT NULL OR broken")
        .groupBy("path")
        .agg(F.min("header").alias("header"), F.max("broken").alias("broken"))
        .collect()
    )
    return Survey(
        {same_path(r.path, encoded=True): r.header.value for r in found if r.header},
        {same_path(r.path, encoded=True) for r in found if r.broken},
        seen.get["lines"],
    )


def listed(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """path, modificationTime, length of the files of a path; their content is not read."""
    found = spark.read.format("binaryFile").load(path)
    return found.select("path", "modificationTime", "length")


def _read(
    spark: SparkSession, path: str | Sequence[str], found: Sequence[str], schema: str,
    keep_corrupt: bool, line_breaks: bool,
) -> DataFrame:
    wanted = spark.createDataFrame([], schema).schema
    if sorted(found) != sorted(wanted.names):
        raise HeaderMismatch(f"columns {found} where {wanted.names} are expected")
    in_file = type(wanted)([wanted[name] for name in found])
    if keep_corrupt:
        in_file = in_file.add(CORRUPT_COLUMN, "string")
    reader = spark.read.schema(in_file).options(**_OPTIONS)
    rows = (reader.option("multiLine", "true") if line_breaks else reader).csv(path)
    last = [CORRUPT_COLUMN] if keep_corrupt else []
    return rows.select(*[F.col(quoted(c)) for c in wanted.names], *last)


def _united(frames: Sequence[DataFrame]) -> DataFrame:
    whole = frames[0]
    for more in frames[1:]:
        whole = whole.unionByName(more)
    return whole


def read_csv(
    spark: SparkSession, path: str | Sequence[str], schema: str, keep_corrupt: bool = True
) -> DataFrame:
    """Delimited text with a header, read with a given DDL schema (no inference pass).

    Columns come back in the schema's order, whatever their order in the files. All files of one
    read must share a header: one with other columns raises, one in another order fails the job.
    A line that does not fit is kept whole in ``_corrupt_record`` unless ``keep_corrupt`` is off.

    Quoted fields may hold line breaks. A pass over the lines finds the files that have such fields;
    those are read one task a file, all others are split between tasks.
    """
    found = header_of(spark, path)
    broken = survey(spark, path, found).broken
    if not broken:
        return _read(spark, path, found, schema, keep_corrupt, False)
    each = [r.path for r in listed(spark, path).select("path").collect()]
    parts = {flag: [p for p in each if (same_path(p) in broken) is flag] for flag in (False, True)}
    return _united(
        [_read(spark, some, found, schema, keep_corrupt, flag) for flag, some in parts.items() if some]
    )


def count_csv(spark: SparkSession, path: str | Sequence[str], schema: str) -> int:
    """Rows of delimited files: their lines without the headers, where no field holds a line break."""
    seen = survey(spark, path, spark.createDataFrame([], schema).columns)
    if seen.broken:
        return read_csv(spark, path, schema, keep_corrupt=False).count()
    return seen.lines - len(seen.headers)


def read_csv_files(
    spark: SparkSession, paths: Sequence[str], schema: str, keep_corrupt: bool = True
) -> tuple[DataFrame, int | None]:
    """As :func:`read_csv`, for files that need not share the order of their columns.

    Headers and line breaks are found in one pass on the executors, and files are read together that
    share both. Beside the rows stands how many there must be, by that pass; None if fields hold line
    breaks. Files without a line hold no rows.
    """
    names = spark.createDataFrame([], schema).columns
    seen = survey(spark, list(paths), names)
    groups: dict[tuple[tuple[str, ...], bool], list[str]] = {}
    for path in paths:
        place = same_path(path)
        if place in seen.headers:
            header = tuple(next(csv.reader([seen.headers[place]])))
        elif not (header := tuple(header_of(spark, path))):
            continue
        if sorted(header) != sorted(names):
            raise HeaderMismatch(f"columns {list(header)} in {path} where {names} are expected")
        groups.setdefault((header, place in seen.broken), []).append(path)
    frames = [
        _read(spark, some, header, schema, keep_corrupt, line_breaks)
        for (header, line_breaks), some in groups.items()
    ]
    if not frames:
        kept = f", {CORRUPT_COLUMN} string" if keep_corrupt else ""
        return spark.createDataFrame([], schema + kept), 0
    return _united(frames), None if seen.broken else seen.lines - sum(map(len, groups.values()))


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_path(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The table at a path: its latest version, where it is kept in versions."""
    return spark.read.format(fmt).load(current(spark, path))
