"""Landing folder: each new batch file is appended to bronze once.

Which files have been taken in is a table of its own, the ledger: one row per file with its length
and batch, and per batch the rows that its files hold and the rows that were written. New files are
those of the folder that the ledger does not have, found by an anti-join: nothing is remembered in a
checkpoint or by the driver, which handles the files of one batch at a time.

A batch is written aside, moved into the table by one rename, and counts from its entry in the ledger
on. What a dead run has left without an entry is deleted by the next one. Bronze is a plain table of
partitions: rows appended by other jobs, as partitions of their own, are seen like any others. One run
at a time takes in files.
"""

from __future__ import annotations

import hashlib
import itertools
import uuid
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from oreline.sources import files
from oreline.sources.files import same_path
from oreline.sources.readers import listed, read_csv_files
from oreline.sources.sinks import write_plain

BATCH = "batch"
LANDED = "landed-"
FILES_PER_BATCH = 4_096
LEDGER = "_ledger"
_STAGED = "_staged"
_ENTRY = (
    "batch string, path string, length bigint, modified timestamp, expected bigint, rows bigint, "
    "landed boolean"
)

# Rows of files, and how many there must be by another count (None if that cannot be told).
ReadFiles = Callable[[Sequence[str]], tuple[DataFrame, int | None]]


def ledger(spark: SparkSession, table: str) -> DataFrame:
    """One row per file taken in, and one per batch that another job appended (without a path).

    ``expected`` and ``rows`` stand for the whole batch: what its files hold, what was written.
    """
    entries = [n for n in files.names_in(spark, f"{table}/{LEDGER}") if not n.startswith("_")]
    if not entries:
        return spark.createDataFrame([], _ENTRY)
    return spark.read.schema(_ENTRY).parquet(f"{table}/{LEDGER}")


def batches(spark: SparkSession, table: str) -> DataFrame:
    """batch, files, expected, rows, landed of every batch in the ledger."""
    return ledger(spark, table).groupBy(BATCH).agg(
        F.count("path").alias("files"),
        F.max("expected").alias("expected"),
        F.max("rows").alias("rows"),
        F.max("landed").alias("landed"),
    )


def _enter(spark: SparkSession, table: str, name: str, entries: list[tuple]) -> None:
    """The batch counts from here on: its entries appear by one rename."""
    aside = f"{table}/{_STAGED}/{uuid.uuid4().hex}"
    spark.createDataFrame(entries, _ENTRY).coalesce(1).write.parquet(aside)
    (part,) = [n for n in files.names_in(spark, aside) if n.startswith("part-")]
    place = f"{table}/{LEDGER}/{name}.parquet"
    files.delete(spark, place)
    files.move(spark, f"{aside}/{part}", place)
    files.delete(spark, aside)


def _put(df: DataFrame, table: str, name: str, fmt: str) -> int:
    """Rows written aside, then moved into the table as the batch ``name``."""
    spark = df.sparkSession
    aside = f"{table}/{_STAGED}/{uuid.uuid4().hex}"
    rows = write_plain(df, aside, fmt)
    files.delete(spark, f"{table}/{BATCH}={name}")
    files.move(spark, aside, f"{table}/{BATCH}={name}")
    return rows


def _clear(spark: SparkSession, table: str) -> None:
    """Without what dead runs have left: rows set aside, landed batches without an entry."""
    files.delete(spark, f"{table}/{_STAGED}")
    known = {n.removesuffix(".parquet") for n in files.names_in(spark, f"{table}/{LEDGER}")}
    for name in files.names_in(spark, table):
        batch = name.removeprefix(f"{BATCH}=")
        if batch != name and batch.startswith(LANDED) and batch not in known:
            files.delete(spark, f"{table}/{name}")


def new_files(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """path, modificationTime, length of the files of a folder that the ledger does not have."""
    taken = ledger(spark, table).select("path")
    return listed(spark, folder).join(taken, "path", "left_anti")


def _chunks(rows: Iterator[Row], size: int) -> Iterator[list[Row]]:
    while some := list(itertools.islice(rows, size)):
        yield some


def _archived(archive: str, path: str) -> str:
    """Where a file goes once taken in: its whole path below the archive folder."""
    return f"{archive}/{same_path(path).partition(':')[2].lstrip('/')}"


def _archive(spark: SparkSession, paths: Sequence[str], archive: str | None) -> None:
    """Taken-in files moved to the archive; one that is there already is left where it is."""
    for path in paths if archive else ():
        if files.exists(spark, path) and not files.exists(spark, _archived(archive, path)):
            files.move(spark, path, _archived(archive, path))


def _landed_name(chunk: Sequence[Row]) -> str:
    paths = "\n".join(same_path(r.path) for r in chunk)
    return LANDED + hashlib.sha256(paths.encode()).hexdigest()[:24]


def _take(
    spark: SparkSession, table: str, chunk: list[Row], read: ReadFiles, fmt: str, name: str
) -> int:
    """The files of ``chunk`` (path, length, modificationTime, place to read from) as one batch."""
    rows, expected = read([r["place"] if "place" in r else r.path for r in chunk])
    written = _put(rows, table, name, fmt)
    entries = [
        (name, r.path, r.length, r.modificationTime, expected, written, True) for r in chunk
    ]
    _enter(spark, table, name, entries)
    return written


def take_in(
    spark: SparkSession,
    folder: str,
    table: str,
    read: ReadFiles,
    fmt: str = "parquet",
    max_files: int | None = None,
    archive: str | None = None,
) -> dict[str, int]:
    """Append the files not taken in before, oldest first; batches, files and rows of this run.

    ``read`` gives the rows of up to ``max_files`` files. ``archive`` names a folder (outside
    ``folder``) to which files go once they are taken in.
    """
    _clear(spark, table)
    done = {"batches": 0, "files": 0, "rows": 0}
    new = new_files(spark, folder, table).orderBy("modificationTime", "path")
    for chunk in _chunks(new.toLocalIterator(), max_files or FILES_PER_BATCH):
        done["rows"] += _take(spark, table, chunk, read, fmt, _landed_name(chunk))
        done["batches"] += 1
        done["files"] += len(chunk)
        _archive(spark, [r.path for r in chunk], archive)
    if archive:  # what a run that died after its entry has left behind
        left = listed(spark, folder).join(ledger(spark, table), "path", "left_semi")
        for chunk in _chunks(left.select("path").toLocalIterator(), FILES_PER_BATCH):
            _archive(spark, [r.path for r in chunk], archive)
    return done


def _csv(spark: SparkSession, schema: str, keep_corrupt: bool) -> ReadFiles:
    return lambda paths: read_csv_files(spark, paths, schema, keep_corrupt)


def append_new_files(
    spark: SparkSession,
    folder: str,
    schema: str,
    table: str,
    keep_corrupt: bool = True,
    **options: str | int | None,
) -> dict[str, int]:
    """:func:`take_in` for delimited files with a header."""
    return take_in(spark, folder, table, _csv(spark, schema, keep_corrupt), **options)


def append_batch(df: DataFrame, table: str, name: str, fmt: str = "parquet") -> int:
    """Append rows as the batch ``name``; the same name again replaces them."""
    if name.startswith(LANDED):
        raise ValueError(f"names of landed batches begin with {LANDED}: {name}")
    rows = _put(df, table, name, fmt)
    _enter(df.sparkSession, table, name, [(name, None, None, None, rows, rows, False)])
    return rows


def retake(
    spark: SparkSession,
    folder: str,
    table: str,
    read: ReadFiles,
    fmt: str = "parquet",
    max_files: int | None = None,
    archive: str | None = None,
) -> dict[str, int]:
    """Every landed batch written anew from its files, wherever they are now, then new files.

    A file is read from the landing folder or from the archive. A batch of which a file is in neither
    is kept as it is, and so are batches of other jobs. Each batch replaces its own rows, so a reload
    that dies leaves every batch, old or new.
    """
    _clear(spark, table)
    taken = ledger(spark, table).where("landed")
    for name in [r[BATCH] for r in taken.select(BATCH).distinct().orderBy(BATCH).collect()]:
        chunk = []
        for r in taken.where(F.col(BATCH) == name).orderBy("modified", "path").collect():
            places = [r.path, _archived(archive, r.path)] if archive else [r.path]
            place = next((p for p in places if files.exists(spark, p)), None)
            chunk.append(
                Row(path=r.path, length=r.length, modificationTime=r.modified, place=place)
            )
        if all(r.place for r in chunk):
            _take(spark, table, chunk, read, fmt, name)
    return take_in(spark, folder, table, read, fmt, max_files, archive)


def reload_files(
    spark: SparkSession,
    folder: str,
    schema: str,
    table: str,
    keep_corrupt: bool = True,
    **options: str | int | None,
) -> dict[str, int]:
    """:func:`retake` for delimited files with a header."""
    return retake(spark, folder, table, _csv(spark, schema, keep_corrupt), **options)


def batch_counts(spark: SparkSession, table: str, fmt: str = "parquet") -> DataFrame:
    """batch, files, expected, rows, stored, ok: the ledger against what the table holds.

    ``expected`` is a count of lines, ``rows`` what was written, ``stored`` what is there now. Batches
    that are in no ledger belong to other jobs and are as long as they are. No source is read again.
    """
    known = batches(spark, table)
    if any(n.startswith(f"{BATCH}=") for n in files.names_in(spark, table)):
        # As text, whatever the names look like.
        rows = spark.read.format(fmt).load(table).select(F.col(BATCH).cast("string").alias(BATCH))
        stored = rows.groupBy(BATCH).agg(F.count(F.lit(1)).alias("stored"))
    else:
        stored = spark.createDataFrame([], "batch string, stored bigint")
    there = F.coalesce("stored", F.lit(0))
    expected, written = F.coalesce("expected", "rows", there), F.coalesce("rows", there)
    return known.join(stored, BATCH, "full").select(
        BATCH,
        F.coalesce("files", F.lit(0)).alias("files"),
        expected.alias("expected"),
        written.alias("rows"),
        there.alias("stored"),
        ((expected == written) & (there == written)).alias("ok"),
    )
