"""Trips: bronze summary, silver cleaning, gold tables.

Silver and gold functions take a frame and add nothing that the caller does not read: each works
on any projection of its input that keeps the columns it names, and Catalyst prunes the rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreline.functions.bands import band
from oreline.functions.exact import Sums, rate_pct
from oreline.functions.parse import parse_number, parse_timestamp
from oreline.functions.text import is_blank
from oreline.operators.aggregates import (
    aliased,
    count_where,
    flag_total,
    in_order,
    pivot_counts,
    tally_where,
)
from oreline.operators.fills import fill_constants, fill_mean
from oreline.operators.quality import any_missing, flag, unread_counts
from oreline.operators.reshape import drop_empty_rows, normalise_columns
from oreline.schemas import (
    DRIVER_COLUMNS,
    FARE_BANDS,
    FARE_TOP_BAND,
    LOCATION_COLUMNS,
    MEASURE_PLACES,
    MISSING_PAYMENT,
    MISSING_RATING,
    MONEY_PLACES,
    NAIRA_PER_DOLLAR,
    TIME_COLUMNS,
)

NUMBER_COLUMNS = ("fare_amount", "rating")
FILLS = {"payment_type": MISSING_PAYMENT, "rating": MISSING_RATING}


def _completed() -> Column:
    return F.col("trip_status") == "completed"


def _cancelled() -> Column:
    return F.col("trip_status") == "cancelled"


def fare_band(fare: Column) -> Column:
    return band(fare, FARE_BANDS, FARE_TOP_BAND)


# Bronze


def bronze_summary(bronze: DataFrame) -> DataFrame:
    """One row of totals over the raw trips."""
    return bronze.agg(
        F.count("*").alias("total_trips"),
        F.count_distinct("driver_id").alias("unique_drivers"),
        F.count_distinct("pickup_city").alias("cities_covered"),
        F.count_distinct("vehicle_type").alias("vehicle_types"),
        flag_total(_completed()).alias("completed_trips"),
        flag_total(_cancelled()).alias("cancelled_trips"),
        flag_total(is_blank(F.col("driver_id"))).alias("missing_driver_rows"),
        flag_total(F.col("fare_amount").isNull()).alias("missing_fare_rows"),
    )


# Silver


def trim_locations(df: DataFrame) -> DataFrame:
    places = [c for c in LOCATION_COLUMNS if c in df.columns]
    return df.withColumns({c: F.trim(c) for c in places}) if places else df


def fill_missing(df: DataFrame, fares: DataFrame | None = None) -> DataFrame:
    """Payment and rating by constants, fare by the mean fare to the cent.

    ``fares`` may name a cheaper frame with the same fares, where ``df`` is costly to derive.
    """
    constants = {c: v for c, v in FILLS.items() if c in df.columns}
    filled = fill_constants(df, constants) if constants else df
    return fill_mean(filled, "fare_amount", MONEY_PLACES, digits=2, known_in=fares)


def parse_times(df: DataFrame) -> DataFrame:
    """Text times parsed; unreadable ones become NULL. Typed columns pass through."""
    text = {name for name, kind in df.dtypes if kind == "string"}
    times = {c: parse_timestamp(F.col(c)) for c in TIME_COLUMNS if c in text}
    return df.withColumns(times) if times else df


def silver_trips(
    bronze: DataFrame,
    naira_per_dollar: float = NAIRA_PER_DOLLAR,
    fares: DataFrame | None = None,
) -> DataFrame:
    """All bronze rows, cleaned, with fare band, dollar fare and a completeness flag."""
    clean = parse_times(fill_missing(trim_locations(bronze), fares))
    derived = {
        "fare_category": fare_band(F.col("fare_amount")),
        "fare_in_usd": F.round(F.col("fare_amount") / F.lit(naira_per_dollar), 2),
    }
    if set(DRIVER_COLUMNS) <= set(bronze.columns):
        derived["data_quality"] = flag(any_missing(DRIVER_COLUMNS), "incomplete")
    return clean.withColumns(derived)


def silver_summary(silver: DataFrame) -> DataFrame:
    """One row of totals over the cleaned trips."""
    band_is, sums = F.col("fare_category").eqNullSafe, Sums()
    fare = sums.of(F.col("fare_amount"), MONEY_PLACES)
    dollars = sums.of(F.col("fare_in_usd"), MONEY_PLACES)
    return sums.over(silver).agg(
        F.count("*").alias("total_rows"),
        F.count_distinct("driver_id").alias("unique_drivers"),
        F.count_distinct("pickup_city").alias("cities"),
        tally_where(_completed()).alias("completed_trips"),
        tally_where(_cancelled()).alias("cancelled_trips"),
        tally_where(F.col("data_quality") == "incomplete").alias("incomplete_records"),
        tally_where(band_is("budget")).alias("budget_trips"),
        tally_where(band_is("standard")).alias("standard_trips"),
        tally_where(band_is("premium")).alias("premium_trips"),
        fare.mean(2).alias("avg_fare_ngn"),
        dollars.mean(2).alias("avg_fare_usd"),
    )


def read_numbers(df: DataFrame) -> DataFrame:
    """Fare and rating as numbers where they came as text; anything else becomes NULL."""
    text = {name for name, kind in df.dtypes if kind == "string"}
    return df.withColumns({c: parse_number(F.col(c)) for c in NUMBER_COLUMNS if c in text})


def clean_trips(exported: DataFrame, fares: DataFrame | None = None) -> DataFrame:
    """An export made fit for use: names, empty rows, numbers, fills and a completeness flag.

    ``fares`` may name a cheaper frame with the same fares, under the same headings.
    """
    rows = normalise_columns(exported)
    filled = fill_constants(read_numbers(drop_empty_rows(rows)), FILLS)
    # Empty rows hold no fare: the mean over all rows is the same, and reads one column.
    all_fares = read_numbers(rows if fares is None else normalise_columns(fares))
    meant = fill_mean(filled, "fare_amount", MONEY_PLACES, known_in=all_fares)
    missing = any_missing(DRIVER_COLUMNS, blank_is_missing=False)
    return meant.withColumn("data_quality", flag(missing, "incomplete"))


def cleaning_counts(exported: DataFrame) -> DataFrame:
    """Rows before and after cleaning, rows dropped and rows flagged, in one pass."""
    rows = normalise_columns(exported)
    kept = F.coalesce(*[F.col(c).cast("string") for c in rows.columns]).isNotNull()
    incomplete = kept & any_missing(DRIVER_COLUMNS, blank_is_missing=False)
    return rows.agg(
        F.count("*").alias("rows_before"),
        count_where(kept).alias("rows_after"),
        count_where(~kept).alias("rows_dropped"),
        count_where(incomplete).alias("incomplete_rows"),
    )


def time_reading(bronze: DataFrame) -> DataFrame:
    """Per time column: text values given, and those that cannot be read as a time."""
    text = {name for name, kind in bronze.dtypes if kind == "string"}
    return unread_counts(bronze, {c: parse_timestamp for c in TIME_COLUMNS if c in text})


# Gold


def _rated() -> Column:
    """Given ratings: 0.0 marks a missing one."""
    return F.when(F.col("rating") > 0, F.col("rating"))


def _completed_fare() -> Column:
    return F.when(_completed(), F.col("fare_amount"))


def driver_performance(silver: DataFrame, ordered: bool = True) -> DataFrame:
    """Per driver and vehicle, complete records only; revenue over all statuses."""
    cancelled, sums = tally_where(_cancelled()), Sums()
    fare = sums.of(F.col("fare_amount"), MONEY_PLACES)
    dollars = sums.of(F.col("fare_in_usd"), MONEY_PLACES)
    measures = {
        "total_trips": F.count("trip_id"),
        "completed_trips": tally_where(_completed()),
        "cancelled_trips": cancelled,
        "cancellation_rate_pct": rate_pct(cancelled, F.count("*")),
        "total_revenue_ngn": fare.sum(),
        "total_revenue_usd": dollars.sum(),
        "avg_fare_ngn": fare.mean(2),
        "avg_rating": sums.of(_rated(), MEASURE_PLACES).mean(2),
    }
    return (
        sums.over(silver.where(F.col("data_quality") == "ok"))
        .groupBy("driver_id", "driver_name", "vehicle_type")
        .agg(*aliased(measures))
        .transform(in_order, ordered, F.desc("total_revenue_ngn"), "driver_id", "driver_name", "vehicle_type")
    )


def city_summary(silver: DataFrame, ordered: bool = True) -> DataFrame:
    """Per pickup city; revenue of completed trips only."""
    sums = Sums()
    fare = sums.of(_completed_fare(), MONEY_PLACES)
    measures = {
        "total_trips": F.count("trip_id"),
        "completed_trips": tally_where(_completed()),
        "total_revenue_ngn": fare.sum(),
        "avg_fare_ngn": fare.mean(2),
        "avg_rating": sums.of(_rated(), MEASURE_PLACES).mean(2),
        "active_drivers": F.count_distinct("driver_id"),
    }
    return (
        sums.over(silver)
        .groupBy(F.col("pickup_city").alias("city"))
        .agg(*aliased(measures))
        .transform(in_order, ordered, F.desc("total_revenue_ngn"), "city")
    )


def daily_trends(silver: DataFrame, ordered: bool = True) -> DataFrame:
    """Per day of request; revenue of completed trips only."""
    sums = Sums()
    fare = sums.of(_completed_fare(), MONEY_PLACES)
    measures = {
        "total_trips": F.count("trip_id"),
        "completed_trips": tally_where(_completed()),
        "cancelled_trips": tally_where(_cancelled()),
        "daily_revenue_ngn": fare.sum(),
        "avg_fare_ngn": fare.mean(2),
        "avg_surge": sums.of(F.col("surge_multiplier"), MEASURE_PLACES).mean(2),
    }
    return (
        sums.over(silver)
        .groupBy(F.to_date("request_time").alias("trip_date"))
        .agg(*aliased(measures))
        .transform(in_order, ordered, "trip_date")
    )


def payment_breakdown(silver: DataFrame, ordered: bool = True) -> DataFrame:
    """Completed trips per payment type, split by fare band."""
    bands = {"budget": "budget_trips", "standard": "standard_trips", "premium": "premium_trips"}
    sums = Sums()
    fare = sums.of(F.col("fare_amount"), MONEY_PLACES)
    return (
        sums.over(silver.where(_completed()))
        .groupBy("payment_type")
        .agg(
            F.count("trip_id").alias("total_trips"),
            *pivot_counts(F.col("fare_category"), bands),
            fare.sum().alias("total_revenue_ngn"),
            fare.mean(2).alias("avg_fare_ngn"),
        )
        .transform(in_order, ordered, F.desc("total_revenue_ngn"), "payment_type")
    )


def vehicle_performance(silver: DataFrame, ordered: bool = True) -> DataFrame:
    """Per vehicle type, all statuses."""
    sums = Sums()
    fare = sums.of(F.col("fare_amount"), MONEY_PLACES)
    measures = {
        "total_trips": F.count("trip_id"),
        "completed_trips": tally_where(_completed()),
        "avg_distance_km": sums.of(F.col("distance_km"), MEASURE_PLACES).mean(2),
        "avg_fare_ngn": fare.mean(2),
        "total_revenue_ngn": fare.sum(),
        "avg_rating": sums.of(_rated(), MEASURE_PLACES).mean(2),
        "avg_surge": sums.of(F.col("surge_multiplier"), MEASURE_PLACES).mean(2),
    }
    return (
        sums.over(silver)
        .groupBy("vehicle_type")
        .agg(*aliased(measures))
        .transform(in_order, ordered, F.desc("total_revenue_ngn"), "vehicle_type")
    )


GOLD = {
    "driver_performance": driver_performance,
    "city_summary": city_summary,
    "daily_trends": daily_trends,
    "payment_breakdown": payment_breakdown,
    "vehicle_performance": vehicle_performance,
}


def gold_tables(silver: DataFrame) -> dict[str, DataFrame]:
    """The gold tables as they are stored: not sorted."""
    return {name: build(silver, ordered=False) for name, build in GOLD.items()}


def gold_keys(silver: DataFrame) -> dict[str, DataFrame]:
    """The distinct keys of each gold table: as many as it must have rows."""
    sound = silver.where(F.col("data_quality") == "ok")
    return {
        "driver_performance": sound.select("driver_id", "driver_name", "vehicle_type").distinct(),
        "city_summary": silver.select("pickup_city").distinct(),
        "daily_trends": silver.select(F.to_date("request_time").alias("trip_date")).distinct(),
        "payment_breakdown": silver.where(_completed()).select("payment_type").distinct(),
        "vehicle_performance": silver.select("vehicle_type").distinct(),
    }
