"""Ten analytical queries over raw trips, before any cleaning.

Those with a row per trip take ``ordered``: a global sort of all trips is for reading the result,
not for storing it, so switch it off before a write.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreline.functions.exact import Sums
from oreline.functions.text import upper_trim
from oreline.operators.aggregates import count_where, distinct_values
from oreline.operators.windows import running_total, top_k_per_group
from oreline.plans.trips import fare_band
from oreline.schemas import (
    BUSY_DRIVER_TRIPS,
    HIGH_RATING,
    MEASURE_PLACES,
    MONEY_PLACES,
    TOP_TRIPS_PER_DRIVER,
)


def status_revenue(trips: DataFrame) -> DataFrame:
    """Q1: trips, revenue and mean fare per status."""
    sums = Sums()
    fare = sums.of(F.col("fare_amount"), MONEY_PLACES)
    return (
        sums.over(trips)
        .groupBy("trip_status")
        .agg(
            F.count("*").alias("total_trips"),
            fare.sum().alias("total_revenue"),
            fare.mean(2).alias("average_fare"),
        )
        .orderBy(F.desc("total_trips"), F.asc_nulls_first("trip_status"))
    )


def measure_totals(trips: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sum and mean per status of measures of any size, equal in any order of addition."""
    sums = Sums()
    measures = {c: sums.of(F.col(c), MONEY_PLACES) for c in columns}
    figures = [
        figure
        for c, m in measures.items()
        for figure in (m.sum().alias(f"{c}_sum"), m.mean_unrounded().alias(f"{c}_mean"))
    ]
    return sums.over(trips).groupBy("trip_status").agg(*figures).orderBy("trip_status")


def busy_drivers(trips: DataFrame, more_than: int = BUSY_DRIVER_TRIPS) -> DataFrame:
    """Q2: drivers with more than ``more_than`` completed trips."""
    sums = Sums()
    fare = sums.of(F.col("fare_amount"), MONEY_PLACES)
    return (
        sums.over(trips.where(F.col("trip_status") == "completed"))
        .groupBy("driver_id", "driver_name")
        .agg(
            F.count("trip_id").alias("total_trips"),
            fare.sum().alias("total_revenue"),
        )
        .where(F.col("total_trips") > more_than)
    )


def trips_per_day(trips: DataFrame) -> DataFrame:
    """Q3: trips per day of request."""
    return (
        trips.groupBy(F.to_date("request_time").alias("trip_date"))
        .agg(F.count("*").alias("trip_count"))
        .orderBy(F.asc_nulls_last("trip_date"))
    )


def clean_locations(trips: DataFrame) -> DataFrame:
    """Q4: distinct pickup locations, trimmed, upper case."""
    name = "cleaned_pickup_location"
    given = trips.where(F.col("pickup_location").isNotNull())
    return distinct_values(given, upper_trim(F.col("pickup_location")), name).orderBy(name)


def unrated(trips: DataFrame, ordered: bool = True) -> DataFrame:
    """Q5: trips without a rating."""
    found = trips.where(F.col("rating").isNull()).select("trip_id", "driver_name", "trip_status")
    return found.orderBy("trip_id") if ordered else found


def fare_bands(trips: DataFrame, ordered: bool = True) -> DataFrame:
    """Q6: fare band of each trip; a missing fare falls in the top band."""
    fare = F.col("fare_amount")
    banded = trips.select("trip_id", fare, fare_band(fare).alias("fare_category"))
    return banded.orderBy("trip_id") if ordered else banded


def top_trips_per_driver(trips: DataFrame, k: int = TOP_TRIPS_PER_DRIVER) -> DataFrame:
    """Q7: the ``k`` dearest completed trips of each driver name, ties by trip."""
    done = trips.where(F.col("trip_status") == "completed").select(
        "driver_name", "trip_id", "fare_amount"
    )
    order = [F.desc_nulls_last("fare_amount"), F.asc("trip_id")]
    ranked = top_k_per_group(done, ["driver_name"], order, k, "fare_rank")
    return ranked.orderBy(F.asc_nulls_last("driver_name"), "fare_rank")


def running_revenue(trips: DataFrame, ordered: bool = True) -> DataFrame:
    """Q8: revenue so far at each trip's request time."""
    rows = trips.select("trip_id", "request_time", "fare_amount")
    total = running_total(rows, "request_time", "fare_amount", "cumulative_revenue", MONEY_PLACES)
    # The trip breaks ties, so that a hot time is spread over sort partitions.
    return total.orderBy(F.asc_nulls_last("request_time"), "trip_id") if ordered else total


def high_rated(trips: DataFrame, above: str = HIGH_RATING) -> DataFrame:
    """Q9: drivers whose mean rating is above a mark, compared as decimals; equal means by driver."""
    mark, sums = Decimal(above), Sums()
    rating = sums.of(F.col("rating"), MEASURE_PLACES)
    count = F.count("rating").cast("decimal(20,0)")
    stats = (
        sums.over(trips.where(F.col("rating").isNotNull()))
        .groupBy("driver_id", "driver_name")
        .agg(
            F.coalesce(
                rating.totals().decimal() > count * F.lit(mark),
                rating.mean_unrounded() > float(mark),
            ).alias("_above"),
            rating.mean_unrounded().alias("average_rating"),
            F.count("*").alias("total_trips"),
        )
    )
    return (
        stats.where("_above")
        .orderBy(F.desc("average_rating"), F.asc_nulls_first("driver_id"), "driver_name")
        .select("driver_name", "average_rating", "total_trips")
    )


def payment_bands(trips: DataFrame) -> DataFrame:
    """Q10: completed trips per payment type and fare band; a missing fare is in no band."""
    fare = F.col("fare_amount")
    return (
        trips.where(F.col("trip_status") == "completed")
        .groupBy("payment_type")
        .agg(
            count_where(fare < 1000).alias("budget_trips"),
            count_where(fare.between(1000, 2000)).alias("standard_trips"),
            count_where(fare > 2000).alias("premium_trips"),
        )
        .orderBy(F.asc_nulls_last("payment_type"))
    )
