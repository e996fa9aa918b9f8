"""Named queries over the sample tables: name to ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreline.functions.parse import parse_date
from oreline.operators import quality
from oreline.operators.reshape import normalise_columns
from oreline.plans import admissions as adm
from oreline.plans import layers
from oreline.plans import trip_queries as q
from oreline.plans import trips as tr
from oreline.schemas import (
    HOSPITAL_TO_ADMISSIONS,
    HOSPITAL_TO_PATIENTS,
    LOCATION_COLUMNS,
    TIME_COLUMNS,
    TRIP_COLUMNS,
    TRIP_TEXT_SCHEMA,
)
from oreline.session import scratch_path
from oreline.sources import samples
from oreline.sources.readers import CORRUPT_COLUMN, read_csv, read_path
from oreline.sources.sinks import write_all, write_csv, write_path
from oreline.streaming import events, landing

Query = Callable[[SparkSession, str], DataFrame]

# Columns each gold table reads of bronze trips; a lookup none of them needs is not joined.
_TRIP_INPUTS = {
    "driver_performance": (
        "trip_id", "driver_id", "driver_name", "vehicle_type", "trip_status", "fare_amount",
        "rating",
    ),
    "city_summary": (
        "trip_id", "driver_id", "pickup_city", "trip_status", "fare_amount", "rating",
    ),
    "daily_trends": (
        "trip_id", "request_time", "trip_status", "fare_amount", "surge_multiplier",
    ),
    "payment_breakdown": ("trip_id", "payment_type", "trip_status", "fare_amount"),
    "vehicle_performance": (
        "trip_id", "vehicle_type", "trip_status", "distance_km", "fare_amount", "rating",
        "surge_multiplier",
    ),
}
_ADMISSION_COLUMNS = (adm.KEY, *HOSPITAL_TO_ADMISSIONS.values())
_PATIENT_COLUMNS = (adm.KEY, *HOSPITAL_TO_PATIENTS.values())
_TRIP_FREQUENCIES = ("trip_status", "pickup_city", "vehicle_type", "surge_multiplier")
_ADMISSION_FREQUENCIES = ("admission_type", "medical_condition")
_CATEGORIES = (
    "gender", "admission_type", "medical_condition", "insurance_provider", "test_results",
    "medication",
)


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and times without a zone, so that any client compares them alike."""
    kinds = {T.DecimalType: "double", T.TimestampType: "timestamp_ntz"}
    casts = {f.name: kinds[type(f.dataType)] for f in df.schema if type(f.dataType) in kinds}
    return df.withColumns({c: F.col(c).cast(kind) for c, kind in casts.items()}) if casts else df


def _over_trips(build: Callable[[DataFrame], DataFrame], *columns: str) -> Query:
    return lambda spark, d: build(samples.trips(spark, d, *columns))


def _over_bronze_trips(build: Callable[[DataFrame], DataFrame], *columns: str) -> Query:
    return lambda spark, d: build(samples.bronze_trips(spark, d, *columns))


def _silver_trips(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """Silver over the sample trips; the mean fare is taken without the lookups."""
    fares = samples.bronze_trips(spark, d, "fare_amount")
    return tr.silver_trips(samples.bronze_trips(spark, d, *columns), fares=fares)


def _over_silver_trips(build: Callable[[DataFrame], DataFrame], *columns: str) -> Query:
    return lambda spark, d: build(_silver_trips(spark, d, *columns))


def _clean_trips(spark: SparkSession, d: str) -> DataFrame:
    fares = samples.exported_trips(spark, d, "fare_amount")
    return tr.clean_trips(samples.exported_trips(spark, d), fares)


def _over_exported(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, d: build(samples.exported_trips(spark, d))


def _stays(spark: SparkSession, d: str) -> DataFrame:
    return adm.silver_admissions(samples.admissions(spark, d, *_ADMISSION_COLUMNS))


def _patients(spark: SparkSession, d: str) -> DataFrame:
    return adm.silver_patients(samples.admissions(spark, d, *_PATIENT_COLUMNS))


def _over_stays(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, d: build(_stays(spark, d))


def _joined(spark: SparkSession, d: str) -> DataFrame:
    return adm.with_patients(_stays(spark, d), _patients(spark, d))


def _gold_stays(table: str) -> Query:
    if table == "disease_trends":
        return lambda spark, d: adm.GOLD[table](_joined(spark, d))
    return _over_stays(adm.GOLD[table])


def _brief(table: str) -> Query:
    return lambda spark, d: adm.brief(table, _gold_stays(table)(spark, d))


def _gold_row_counts(spark: SparkSession, d: str) -> DataFrame:
    """Rows of the five gold tables, counted while they are written from one stored silver table."""
    base = scratch_path(spark, "gold")
    needed = dict.fromkeys(c for columns in _TRIP_INPUTS.values() for c in columns)
    write_path(_silver_trips(spark, d, *needed), f"{base}/silver")
    rows = write_all(tr.gold_tables(read_path(spark, f"{base}/silver")), f"{base}/gold")
    counted = [(f"gold_{name}", n) for name, n in rows.items()]
    return spark.createDataFrame(counted, "table_name string, rows bigint")


def _fill_check(spark: SparkSession, d: str) -> DataFrame:
    needed = ("payment_type", "fare_amount", "rating")
    names = {"null_payment": "payment_type", "null_fare": "fare_amount", "null_rating": "rating"}
    return quality.null_counts(tr.fill_missing(samples.bronze_trips(spark, d, *needed)), names)


def _location_padding(spark: SparkSession, d: str) -> DataFrame:
    """Padded locations before and after trimming, in one pass: both kinds of column in one row."""
    raw = samples.bronze_trips(spark, d, *LOCATION_COLUMNS)
    after = [F.trim(c).alias(f"trimmed_{c}") for c in LOCATION_COLUMNS]
    both = raw.select(*LOCATION_COLUMNS, *after)
    return quality.padded_counts(both, both.columns)


def _silver_frequencies(spark: SparkSession, d: str) -> DataFrame:
    ages = quality.frequencies_of(_patients(spark, d), ["age_group"])
    stays = quality.frequencies_of(_stays(spark, d), ["billing_category", "data_quality"])
    return ages.unionAll(stays).orderBy("column", F.desc("rows"), F.asc_nulls_last("value"))


def _hospital_shape(spark: SparkSession, d: str) -> DataFrame:
    return quality.profile_shape(samples.hospital_rows(spark, d, keyed=False), "hospital")


def _landing_trips(spark: SparkSession, d: str) -> DataFrame:
    """Trips written as delimited batch files, taken in from the landing folder, read back."""
    base = scratch_path(spark, "landing")
    write_csv(samples.bronze_trips(spark, d), f"{base}/landing")
    landing.append_new_files(spark, f"{base}/landing", TRIP_TEXT_SCHEMA, f"{base}/bronze")
    return read_path(spark, f"{base}/bronze").drop(CORRUPT_COLUMN, landing.BATCH)


def _age(spark: SparkSession, folder: str, days: int) -> None:
    """Set back the modification time of the files in a folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in files.listStatus(path):
        before = status.getModificationTime() - days * 86_400_000
        files.setTimes(status.getPath(), before, -1)


def _landing_late(spark: SparkSession, d: str) -> DataFrame:
    """Two landed batches: the later one older, with its columns in another order and bad fares."""
    base = scratch_path(spark, "landing-late")
    rows = samples.bronze_trips(spark, d, "trip_id", *[c for c in TRIP_COLUMNS if c != "trip_id"])
    late = F.col("trip_id") % 4 == 1
    table, source = f"{base}/bronze", f"{base}/landing"
    write_csv(rows.where(~late), f"{source}/first")
    landing.append_new_files(spark, f"{source}/*", TRIP_TEXT_SCHEMA, table)
    bad = F.when(F.col("trip_id") % 61 == 0, "n/a").otherwise(F.col("fare_amount").cast("string"))
    turned = rows.where(late).withColumn("fare_amount", bad).select(*reversed(rows.columns))
    write_csv(turned, f"{source}/second")
    _age(spark, f"{source}/second", 40)
    landing.append_new_files(spark, f"{source}/*", TRIP_TEXT_SCHEMA, table)
    return read_path(spark, table).select(
        "trip_id", "pickup_city", "vehicle_type", "fare_amount",
        F.when(F.col(CORRUPT_COLUMN).contains("n/a"), "n/a").alias("unread"),
    )


def _landing_reload(spark: SparkSession, d: str) -> DataFrame:
    """Four drops, archived as they are taken in, beside another job's batch; then a reload."""
    base = scratch_path(spark, "landing-reload")
    place = (spark, f"{base}/landing/*", TRIP_TEXT_SCHEMA, f"{base}/bronze")
    rows = samples.bronze_trips(spark, d)
    for drop in range(4):
        write_csv(rows.where(F.col("trip_id") % 4 == drop), f"{base}/landing/{drop}")
        landing.append_new_files(*place, archive=f"{base}/taken" if drop < 3 else None)
    bronze = read_path(spark, f"{base}/bronze")
    landing.append_batch(bronze.where("trip_id % 7 = 0").drop(landing.BATCH), f"{base}/bronze", "other")
    landing.reload_files(*place, archive=f"{base}/taken")
    counts = landing.batch_counts(spark, f"{base}/bronze")
    kind = F.when(F.col(landing.BATCH).startswith(landing.LANDED), "landed").otherwise("other")
    checked = counts.groupBy(kind.alias("kind")).agg(
        F.count("*").cast("int").alias("batches"), F.every("ok").alias("ok")
    )
    cents = F.rint(F.col("fare_amount") * 100).cast("bigint")
    held = read_path(spark, f"{base}/bronze").groupBy(kind.alias("kind")).agg(
        F.count("*").alias("trips"), F.sum(cents).alias("cents")
    )
    return checked.join(held, "kind")


def _line_breaks(spark: SparkSession, d: str) -> DataFrame:
    """Trips as delimited files, some of them with line breaks and quotes within fields."""
    base = scratch_path(spark, "line-breaks")
    rows = samples.bronze_trips(spark, d)
    broken = F.col("trip_id") % 10 == 0
    said = F.concat(F.lit('said "go",\n\n'), F.col("pickup_city"))
    write_csv(rows.where(~broken), f"{base}/in/plain")
    write_csv(rows.where(broken).withColumn("pickup_location", said), f"{base}/in/broken")
    read = read_csv(spark, f"{base}/in/*", TRIP_TEXT_SCHEMA)
    return read.select("trip_id", "pickup_city", "pickup_location", "fare_amount")


def _versioned_rebuild(spark: SparkSession, d: str) -> DataFrame:
    """Silver as readers see it: after a rebuild that died half-way, then after one that did not."""
    path = f"{scratch_path(spark, 'versioned')}/trips"
    rows = samples.bronze_trips(spark, d, "trip_id", "trip_status", "fare_amount")
    write_path(rows.where("trip_status = 'completed'"), path)
    lost = F.when(F.col("trip_id") % 1009 == 0, F.raise_error(F.lit("lost"))).otherwise(F.col("trip_id"))
    try:
        write_path(rows.withColumn("trip_id", lost.cast("bigint")), path)
    except Exception as died:
        if "lost" not in str(died):
            raise
    cents = F.sum(F.rint(F.col("fare_amount") * 100).cast("bigint")).alias("cents")
    seen = []
    for state in ("before", "after"):
        if state == "after":
            write_path(rows, path)
        held = read_path(spark, path).agg(F.count("*").alias("trips"), cents)
        seen.append(held.select(F.lit(state).alias("state"), "trips", "cents"))
    return seen[0].unionAll(seen[1])


def _event_files(spark: SparkSession, d: str) -> DataFrame:
    """Message bodies dropped as text files in two goes, each file taken in once."""
    base = scratch_path(spark, "event-files")
    bodies = samples.event_bodies(samples.events(spark, d)).withColumn(
        "drop", F.pmod(F.xxhash64("value"), F.lit(2))
    )
    for drop in range(2):
        bodies.where(F.col("drop") == drop).select("value").write.text(f"{base}/in/{drop}")
        for _ in range(2):
            events.append_event_files(spark, f"{base}/in/*", f"{base}/bronze")
    return events.read_events(spark, f"{base}/bronze")


def _validate_row_counts(spark: SparkSession, d: str) -> DataFrame:
    """The admissions layers from delimited source rows to gold, and their row-count checks."""
    base = scratch_path(spark, "admissions")
    write_csv(samples.hospital_rows(spark, d, keyed=False), f"{base}/source")
    cfg = layers.LayerConfig(source=f"{base}/source", base=base)
    layers.admissions_bronze(spark, cfg)
    layers.admissions_silver(spark, cfg)
    layers.admissions_gold(spark, cfg)
    return layers.admissions_checks(spark, cfg)


def _validate_trip_layers(spark: SparkSession, d: str) -> DataFrame:
    """The trips layers end to end: a first run, a full reload, new files, a second run; checks.

    Files are archived as they are taken in, so the reload reads them from there.
    """
    base = scratch_path(spark, "trips")
    rows = samples.bronze_trips(spark, d)
    cfg = layers.LayerConfig(source=f"{base}/landing/*", base=base, archive=f"{base}/taken")
    early = F.col("trip_id") % 2 == 0
    write_csv(rows.where(early), f"{base}/landing/first")
    layers.run_trips(spark, cfg)
    layers.trips_reload(spark, cfg)
    write_csv(rows.where(~early), f"{base}/landing/second")
    layers.run_trips(spark, cfg)
    return layers.trips_checks(spark, cfg)


def _catalog_gold(spark: SparkSession, d: str) -> DataFrame:
    """The admissions layers kept in a catalog database, a gold table read through its view."""
    base = scratch_path(spark, "catalog")
    database = "layers_" + base.rpartition("-")[2]
    spark.sql(f"CREATE DATABASE {database} LOCATION '{base}/tables'")
    write_csv(samples.hospital_rows(spark, d, keyed=False), f"{base}/source")
    cfg = layers.LayerConfig(source=f"{base}/source", base=base, catalog=database)
    layers.run_admissions(spark, cfg)
    return layers.register_views(spark, cfg, ["gold/insurance_analysis"])["gold/insurance_analysis"]


def _clean_file(spark: SparkSession, d: str) -> DataFrame:
    """An export as a delimited file, cleaned by the job, read back from its JSON records."""
    base = scratch_path(spark, "clean")
    write_csv(samples.exported_trips(spark, d), f"{base}/export")
    layers.clean_file(spark, f"{base}/export", f"{base}/clean")
    numbers = {"fare_amount", "rating"}
    kinds = [f"{c} {'double' if c in numbers else 'string'}" for c in (*TRIP_COLUMNS, "data_quality")]
    rows = spark.read.schema(", ".join(kinds)).json(f"{base}/clean")
    return rows.withColumns({c: F.col(c).cast("double") for c in ("distance_km", "surge_multiplier")})


def _admission_dates(spark: SparkSession, d: str) -> DataFrame:
    rows = samples.admission_texts(spark, d)
    return rows.withColumn("date_of_admission", parse_date(F.col("date_of_admission")))


def _stream(spark: SparkSession, d: str) -> str:
    """Message bodies made from the events table, drained as a stream; the bronze table's path."""
    base = scratch_path(spark, "events")
    bodies = samples.event_bodies(samples.event_stream(spark, d))
    events.drain_events(bodies, f"{base}/bronze", f"{base}/checkpoint")
    return f"{base}/bronze"


_QUERIES: dict[str, Query] = {
    # Analytical queries over raw trips
    "sql_q01_status_revenue": _over_trips(q.status_revenue, "trip_status", "fare_amount"),
    "sql_q02_busy_drivers": _over_trips(
        q.busy_drivers, "trip_id", "driver_id", "driver_name", "trip_status", "fare_amount"
    ),
    "sql_q03_trips_per_day": _over_trips(q.trips_per_day, "request_time"),
    "sql_q04_clean_locations": _over_trips(q.clean_locations, "pickup_location"),
    "sql_q05_unrated": _over_trips(q.unrated, "trip_id", "driver_name", "trip_status", "rating"),
    "sql_q06_fare_band": _over_trips(q.fare_bands, "trip_id", "fare_amount"),
    "sql_q07_top3_per_driver": _over_trips(
        q.top_trips_per_driver, "trip_id", "driver_name", "trip_status", "fare_amount"
    ),
    "sql_q08_running_revenue": _over_trips(
        q.running_revenue, "trip_id", "request_time", "fare_amount"
    ),
    "sql_q09_high_rated": _over_trips(q.high_rated, "driver_id", "driver_name", "rating"),
    "sql_q10_payment_bands": _over_trips(
        q.payment_bands, "payment_type", "trip_status", "fare_amount"
    ),
    # The same over fares and ratings with more decimals
    "fine_status_revenue": lambda spark, d: q.status_revenue(
        samples.fine_trips(spark, d, "trip_status", "fare_amount")
    ),
    "fine_measure_totals": lambda spark, d: q.measure_totals(
        samples.fine_trips(spark, d, "trip_status", "tiny", "spread"), ["tiny", "spread"]
    ),
    "fine_running_revenue": lambda spark, d: q.running_revenue(
        samples.fine_trips(spark, d, "trip_id", "request_time", "fare_amount")
    ),
    "fine_high_rated": lambda spark, d: q.high_rated(
        samples.fine_trips(spark, d, "driver_id", "driver_name", "rating"), above="4.30003"
    ),
    # Trips: bronze, silver, gold
    "trips_bronze_summary": _over_bronze_trips(
        tr.bronze_summary, "driver_id", "pickup_city", "vehicle_type", "trip_status", "fare_amount"
    ),
    "silver_trips": _silver_trips,
    "trips_silver_summary": _over_silver_trips(
        tr.silver_summary, "driver_id", "driver_name", "pickup_city", "trip_status", "fare_amount"
    ),
    "location_padding": _location_padding,
    "fill_check": _fill_check,
    "clean_trips": _clean_trips,
    "clean_file_records": _clean_file,
    "time_reading": _over_bronze_trips(tr.time_reading, *TIME_COLUMNS),
    "cleaning_counts": _over_exported(tr.cleaning_counts),
    "normalised_columns": _over_exported(normalise_columns),
    **{
        f"gold_{name}": _over_silver_trips(build, *_TRIP_INPUTS[name])
        for name, build in tr.GOLD.items()
    },
    "gold_row_counts": _gold_row_counts,
    # Admissions: bronze, silver, gold
    "bronze_patients": lambda spark, d: adm.bronze_patients(samples.hospital_rows(spark, d)),
    "bronze_admissions": lambda spark, d: adm.bronze_admissions(samples.hospital_rows(spark, d)),
    "silver_patients": _patients,
    "silver_admissions": _stays,
    "admissions_with_patients": _joined,
    "admission_dates": _admission_dates,
    "catalog_insurance_analysis": _catalog_gold,
    **{f"gold_{name}": _gold_stays(name) for name in adm.GOLD},
    **{f"gold_{name}_brief": _brief(name) for name in adm.BRIEF},
    # Profiles and checks
    "profile_nulls": _over_bronze_trips(quality.profile_nulls),
    "profile_nulls_admissions": lambda spark, d: quality.profile_nulls(
        samples.hospital_rows(spark, d, keyed=False), blank_is_missing=False
    ),
    "profile_distinct": lambda spark, d: quality.profile_distinct(
        samples.admissions(spark, d, *_CATEGORIES), _CATEGORIES
    ),
    "profile_frequencies": _over_bronze_trips(
        lambda df: quality.profile_frequencies(df, _TRIP_FREQUENCIES, ["surge_multiplier"]),
        *_TRIP_FREQUENCIES,
    ),
    "profile_frequencies_admissions": lambda spark, d: quality.profile_frequencies(
        samples.admissions(spark, d, *_ADMISSION_FREQUENCIES), _ADMISSION_FREQUENCIES
    ),
    "silver_frequencies": _silver_frequencies,
    "profile_shape": _over_bronze_trips(lambda df: quality.profile_shape(df, "trips")),
    "profile_shape_admissions": _hospital_shape,
    "stay_stats": _over_stays(adm.stay_stats),
    "validate_row_counts": _validate_row_counts,
    "validate_trip_layers": _validate_trip_layers,
    # Streams
    "landing_trips": _landing_trips,
    "landing_late": _landing_late,
    "landing_reload": _landing_reload,
    "line_breaks": _line_breaks,
    "versioned_rebuild": _versioned_rebuild,
    "event_files": _event_files,
    "stream_trip_events": lambda spark, d: events.read_events(spark, _stream(spark, d)),
    "stream_quarantine": lambda spark, d: events.read_quarantine(spark, _stream(spark, d)),
}


def _registered(query: Query) -> Query:
    return lambda spark, sf_dir: plain(query(spark, sf_dir))


def queries() -> dict[str, Query]:
    return {name: _registered(query) for name, query in _QUERIES.items()}


def run_queries(
    spark: SparkSession, sf_dir: str, names: Iterable[str] | None = None
) -> dict[str, DataFrame]:
    """One frame per named query, all of them by default."""
    known = queries()
    return {name: known[name](spark, sf_dir) for name in (names or known)}
