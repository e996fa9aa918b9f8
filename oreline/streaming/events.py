"""Trip events: JSON message bodies to a bronze table, bad ones to quarantine.

One query with one checkpoint writes both, as partitions of one plain table, so the source is read
once and a restart neither loses nor repeats a message.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreline.functions.parse import parse_iso_timestamp, parse_number
from oreline.schemas import TRIP_EVENT_SCHEMA
from oreline.streaming.landing import BATCH, take_in

# In practice without a limit: Spark's own default skips files a week older than the newest seen.
MAX_FILE_AGE = "36500d"
PARSED = "parsed"
QUARANTINED = "quarantined"
JSON_BLANKS = " \t\r\n"

_FIELDS = [part.split()[0] for part in TRIP_EVENT_SCHEMA.split(", ")]
# Everything as text first: a field of the wrong kind must not pass for a missing one.
_WIRE = f"array<struct<{', '.join(f'{name}: string' for name in _FIELDS)}>>"


def text_source(
    spark: SparkSession,
    folder: str,
    max_files: int | None = None,
    max_file_age: str = MAX_FILE_AGE,
    archive: str | None = None,
) -> DataFrame:
    """One message body per line of the files dropped in a folder, as a stream, whatever their age.

    The stream remembers each file for ``max_file_age``. Where that list may grow long, name an
    ``archive`` folder to which files go once taken in, or use :func:`append_event_files`.
    """
    reader = spark.readStream.format("text").option("maxFileAge", max_file_age)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.load(folder)


def parse_events(bodies: DataFrame) -> DataFrame:
    """Bodies to typed fields plus ``event_ts``, ``raw_body`` and ``state``.

    Every body is kept as it came in ``raw_body``, with the fields that are not known here. Empty
    bodies are skipped. A body that is not exactly one JSON object, or whose fare is not a number,
    is marked ``quarantined``; a time that is not in ISO form is only NULL.
    """
    body = F.btrim("value", F.lit(JSON_BLANKS))
    given = bodies.where(F.length(body) > 0)
    # As the one element of an array, so that anything after the object is an error too.
    objects = F.from_json(
        F.concat(F.lit("["), F.col("value"), F.lit("]")), _WIRE, {"allowSingleQuotes": "false"}
    )
    parsed = given.select("value", objects.alias("objects")).withColumn(
        "event", F.get("objects", F.lit(0))
    )
    fare = F.col("event.fare_amount")
    one_object = (F.size("objects") == 1) & body.startswith("{") & body.endswith("}")
    fare_reads = fare.isNull() | parse_number(fare).isNotNull()
    sound = one_object & F.col("event").isNotNull() & fare_reads
    typed = {
        **{c: F.col(f"event.{c}") for c in _FIELDS},
        "fare_amount": parse_number(fare),
        "event_ts": parse_iso_timestamp(F.col("event.timestamp")),
    }
    return parsed.withColumn("sound", F.coalesce(sound, F.lit(False))).select(
        *[F.when(F.col("sound"), value).alias(name) for name, value in typed.items()],
        F.col("value").alias("raw_body"),
        F.when(F.col("sound"), PARSED).otherwise(QUARANTINED).alias("state"),
    )


def drain_events(bodies: DataFrame, table: str, checkpoint: str, name: str = "stream") -> dict:
    """Write everything available now to ``table``, then stop; a later call takes up from there.

    Each micro-batch is a partition ``batch=<name>-<number>`` of its own, with good and bad messages
    below it, which a repeated batch replaces. Rows of other jobs, as other partitions, are seen like
    any others. Returns the last progress report.
    """

    def put(rows: DataFrame, number: int) -> None:
        rows.write.partitionBy("state").mode("overwrite").parquet(f"{table}/{BATCH}={name}-{number}")

    query = (
        parse_events(bodies)
        .writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(put)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query.lastProgress or {}


def append_event_files(spark: SparkSession, folder: str, table: str, **options) -> dict[str, int]:
    """Bodies of the files dropped in a folder, one per line, each file once.

    Files are found and remembered as in :mod:`oreline.streaming.landing`: no list of them grows with
    a stream's checkpoint.
    """

    def read(paths: Sequence[str]) -> tuple[DataFrame, int | None]:
        return parse_events(spark.read.text(list(paths))), None

    return take_in(spark, folder, table, read, **options)


def read_events(spark: SparkSession, table: str, raw: bool = False) -> DataFrame:
    """The parsed events; ``raw`` adds their bodies as they came."""
    return (
        spark.read.schema(f"{TRIP_EVENT_SCHEMA}, event_ts timestamp, raw_body string, state string")
        .parquet(table)
        .where(F.col("state") == PARSED)
        .drop(*([] if raw else ["raw_body"]), "state", BATCH)
    )


def read_quarantine(spark: SparkSession, table: str) -> DataFrame:
    """The bodies that could not be parsed."""
    return (
        spark.read.schema("raw_body string, state string")
        .parquet(table)
        .where(F.col("state") == QUARANTINED)
        .select("raw_body")
    )
