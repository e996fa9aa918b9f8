"""The subject areas derived from the sample order tables.

``orders`` plays the fact table; ``customer`` and ``nation`` are looked up by their unique key.
The sample tables hold no dirt, so missing, blank, padded and bad values are put in by arithmetic
on the order key. Callers name the columns they need: a lookup no column needs is not joined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreline.schemas import HOSPITAL_TO_ADMISSIONS, HOSPITAL_TO_PATIENTS, TRIP_COLUMNS
from oreline.streaming.events import MAX_FILE_AGE

_TABLES = {
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "nation": "n_nationkey int, n_name string",
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
}

_CANCELLED = "o_orderstatus = 'P'"
_REQUESTED = "(o_orderdate + (o_orderkey % 1380) * INTERVAL '1' MINUTE)"
_PICKED_UP = "(o_orderdate + (o_orderkey % 1380 + 3 + o_orderkey % 10) * INTERVAL '1' MINUTE)"
_DROPPED = "(o_orderdate + (o_orderkey % 1380 + 20 + o_orderkey % 40) * INTERVAL '1' MINUTE)"
_PLACE = "CASE WHEN o_orderkey % 11 = 0 THEN '  ' || lower(n_name) || ' ' ELSE n_name END"


def _text_time(moment: str) -> str:
    return f"date_format({moment}, 'yyyy-MM-dd HH:mm:ss')"


_RATING = (
    f"CASE WHEN {_CANCELLED} OR o_orderkey % 43 = 0 THEN NULL "
    "ELSE cast(32 + (o_custkey + o_orderkey) % 19 AS double) / 10 END"
)
_FARE = "CASE WHEN o_orderkey % 53 = 0 THEN NULL ELSE cast(floor(o_totalprice) AS double) / 100 END"

_TRIPS = {
    "trip_id": "o_orderkey",
    "driver_id": (
        "CASE WHEN o_orderkey % 37 = 0 THEN NULL WHEN o_orderkey % 37 = 1 THEN '' "
        "ELSE 'D' || o_custkey END"
    ),
    "driver_name": (
        "CASE WHEN o_orderkey % 41 = 0 THEN NULL WHEN o_orderkey % 41 = 1 THEN '' ELSE c_name END"
    ),
    "rider_id": "'R' || (o_custkey % 400)",
    "pickup_city": "n_name",
    "pickup_location": _PLACE,
    "dropoff_city": "n_name",
    "dropoff_location": _PLACE,
    "request_time": f"cast({_REQUESTED} AS timestamp)",
    "distance_km": "cast(floor(o_totalprice / 1500) AS double) / 10",
    "fare_amount": _FARE,
    "surge_multiplier": (
        "cast(CASE o_orderkey % 5 WHEN 0 THEN 1.2 WHEN 1 THEN 1.5 ELSE 1.0 END AS double)"
    ),
    "payment_type": "CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE o_orderpriority END",
    "trip_status": f"CASE WHEN {_CANCELLED} THEN 'cancelled' ELSE 'completed' END",
    "rating": _RATING,
    "vehicle_type": "c_mktsegment",
}
# Finer than cents and tenths: sums must not round what they add.
_FINE = {
    "fare_amount": (
        f"{_FARE} + cast(o_orderkey % 1000 AS double) / 100000 "
        "+ CASE WHEN o_orderkey % 3 = 0 THEN 0.004 ELSE 0.0 END"
    ),
    # Far below the cent, and of all sizes.
    "tiny": (
        "CASE o_orderkey % 5 WHEN 0 THEN 4e-11D WHEN 1 THEN 8e-11D WHEN 2 THEN 1.2e-10D "
        "WHEN 3 THEN 1.6e-10D ELSE 2e-10D END"
    ),
    "spread": "CASE o_orderkey % 4 WHEN 0 THEN 4e-11D WHEN 1 THEN 3e11D WHEN 2 THEN 0.25D END",
    "rating": f"{_RATING} + cast(o_orderkey % 7 AS double) / 100000",
}
# As it arrives: times are text, some of it bad or empty.
_TEXT_TIMES = {
    "request_time": (
        f"CASE WHEN o_orderkey % 59 = 0 THEN 'bad' ELSE {_text_time(_REQUESTED)} END"
    ),
    "pickup_time": _text_time(_PICKED_UP),
    "dropoff_time": f"CASE WHEN {_CANCELLED} THEN '' ELSE {_text_time(_DROPPED)} END",
}
# As a spreadsheet export gives it: numbers are text too, some of it not a number.
_TEXT_NUMBERS = {
    "trip_id": "cast(o_orderkey AS string)",
    "fare_amount": f"CASE WHEN o_orderkey % 47 = 0 THEN 'n/a' ELSE cast({_FARE} AS string) END",
    "rating": f"cast({_RATING} AS string)",
}

_ADMISSIONS = {
    "admission_id": "o_orderkey",
    "patient_name": (
        "CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE ' ' || c_name || '  ' END"
    ),
    "age": "CASE WHEN o_custkey % 101 = 0 THEN NULL ELSE cast(o_custkey % 90 AS int) END",
    "gender": "CASE WHEN o_custkey % 2 = 0 THEN 'Female' ELSE ' male ' END",
    "blood_type": (
        "CASE o_custkey % 4 WHEN 0 THEN 'a+' WHEN 1 THEN 'B-' WHEN 2 THEN ' O+' ELSE 'AB-' END"
    ),
    "medical_condition": (
        "CASE WHEN o_orderkey % 7 = 0 THEN ' ' || lower(c_mktsegment) ELSE c_mktsegment END"
    ),
    "date_of_admission": "cast(o_orderdate AS date)",
    "doctor": "'Dr ' || o_custkey",
    "hospital": "'Hospital ' || (o_orderkey % 997)",
    "insurance_provider": "n_name",
    "billing_amount": (
        "CASE WHEN o_orderkey % 61 = 0 THEN NULL "
        "ELSE cast(floor(o_totalprice) AS double) / 10 - 200 END"
    ),
    "room_number": "cast(101 + o_orderkey % 400 AS int)",
    "admission_type": (
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'Emergency' WHEN '2-HIGH' THEN 'urgent ' "
        "ELSE 'Elective' END"
    ),
    "discharge_date": (
        "CASE WHEN o_orderkey % 71 = 0 THEN NULL "
        "ELSE date_add(cast(o_orderdate AS date), cast(o_orderkey % 32 - 1 AS int)) END"
    ),
    "medication": "'Med ' || (o_orderkey % 5)",
    "test_results": (
        "CASE o_orderkey % 3 WHEN 0 THEN 'Normal' WHEN 1 THEN 'Abnormal' ELSE 'Inconclusive' END"
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A sample table, read with a given schema so that no footer job runs first."""
    return spark.read.schema(_TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _derive(
    spark: SparkSession, sf_dir: str, meanings: dict[str, str], columns: tuple[str, ...]
) -> DataFrame:
    wanted = columns or tuple(meanings)
    chosen = {name: meanings[name] for name in wanted}
    needs = " ".join(chosen.values())
    df = table(spark, sf_dir, "orders")
    if "c_" in needs or "n_name" in needs:
        customer = table(spark, sf_dir, "customer")
        df = df.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
    if "n_name" in needs:
        nation = table(spark, sf_dir, "nation")
        df = df.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return df.selectExpr(*[f"{meaning} AS {name}" for name, meaning in chosen.items()])


def trips(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Trips with typed request time, as the analytical queries read them."""
    return _derive(spark, sf_dir, _TRIPS, columns)


def fine_trips(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Trips whose fares and ratings have up to five decimals."""
    return _derive(spark, sf_dir, {**_TRIPS, **_FINE}, columns)


def bronze_trips(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Trips as they arrive, the three times as text."""
    meanings = {**_TRIPS, **_TEXT_TIMES}
    return _derive(spark, sf_dir, meanings, columns or tuple(TRIP_COLUMNS))


def exported_trips(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Trips as an export: untidy headers, numbers as text, a wholly empty row here and there."""
    wanted = columns or tuple(TRIP_COLUMNS)
    meanings = {**_TRIPS, **_TEXT_TIMES, **_TEXT_NUMBERS}
    derived = _derive(spark, sf_dir, meanings, tuple(dict.fromkeys(("trip_id", *wanted))))
    # An empty row follows some of the rows.
    filled = "CASE WHEN bigint(trip_id) % 73 = 0 THEN array(true, false) ELSE array(true) END"
    titles = {name: f" {name.replace('_', ' ').title()} " for name in wanted}
    return derived.withColumn("_filled", F.explode(F.expr(filled))).selectExpr(
        *[f"CASE WHEN _filled THEN {name} END AS `{title}`" for name, title in titles.items()]
    )


def admissions(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Admissions with their key, patients and stays in one wide row."""
    return _derive(spark, sf_dir, _ADMISSIONS, columns)


def admission_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Admission dates as text, some of them bad or empty."""
    meanings = {
        "admission_id": _ADMISSIONS["admission_id"],
        "date_of_admission": (
            "CASE WHEN o_orderkey % 89 = 0 THEN '31/12/2024' WHEN o_orderkey % 83 = 0 THEN '' "
            "ELSE cast(cast(o_orderdate AS date) AS string) END"
        ),
    }
    return _derive(spark, sf_dir, meanings, ())


def hospital_rows(spark: SparkSession, sf_dir: str, keyed: bool = True) -> DataFrame:
    """The wide rows under their source headings, with or without the key."""
    headings = {**HOSPITAL_TO_PATIENTS, **HOSPITAL_TO_ADMISSIONS}
    wide = admissions(spark, sf_dir)
    key = ["admission_id"] if keyed else []
    return wide.selectExpr(*key, *[f"{new} AS `{old}`" for old, new in headings.items()])


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream of files."""
    reader = spark.readStream.schema(_TABLES["events"]).option("maxFileAge", MAX_FILE_AGE)
    return reader.parquet(f"{sf_dir}/events*.parquet")


def event_bodies(events: DataFrame) -> DataFrame:
    """Message bodies made of events: mostly JSON, some broken, some empty."""
    body = F.to_json(
        F.struct(
            F.concat(F.lit("EVT"), F.expr("1000 + event_id % 9000")).alias("event_id"),
            F.col("event_type"),
            F.concat(F.lit("T"), F.col("event_id")).alias("trip_id"),
            F.concat(F.lit("D"), F.col("user_id")).alias("driver_id"),
            F.concat(F.lit("R"), F.expr("user_id % 400")).alias("rider_id"),
            F.concat(F.lit("City "), F.expr("user_id % 5")).alias("city"),
            F.col("value").alias("fare_amount"),
            F.expr(
                "CASE WHEN event_id % 31 = 0 THEN 'soon' "
                "ELSE date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\") END"
            ).alias("timestamp"),
        )
    )
    return events.select(
        F.expr("CASE WHEN event_id % 47 = 0 THEN 'not json' || event_id END").alias("_bad"),
        F.expr("CASE WHEN event_id % 53 = 0 THEN '' END").alias("_empty"),
        body.alias("_body"),
    ).select(F.coalesce("_bad", "_empty", "_body").alias("value"))
