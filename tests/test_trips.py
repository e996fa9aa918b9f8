from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from helpers import column, plan, rows

from oreline.plans import trip_queries as q
from oreline.plans import trips as tr
from oreline.schemas import TRIP_COLUMNS, TRIP_TEXT_SCHEMA
from oreline.sources import samples


def trip(n, **changes):
    base = dict(
        trip_id=f"T{n}", driver_id="D1", driver_name="Ann", rider_id="R1", pickup_city="Abuja",
        pickup_location=" Garki ", dropoff_city="Abuja", dropoff_location="Wuse 2",
        request_time="2024-02-26 07:00:00", pickup_time="bad", dropoff_time="", distance_km=7.5,
        fare_amount=1500.0, surge_multiplier=1.2, payment_type="cash", trip_status="completed",
        rating=4.5, vehicle_type="suv",
    )
    return tuple({**base, **changes}[c] for c in TRIP_COLUMNS)


@pytest.fixture
def bronze(spark):
    return spark.createDataFrame(
        [
            trip(1, fare_amount=999.99),
            trip(2, fare_amount=2000.0, trip_status="cancelled", rating=None),
            trip(3, fare_amount=None, payment_type=None, driver_id=""),
            trip(4, fare_amount=2000.01, driver_name=None, vehicle_type="bike"),
            trip(5, driver_id="D2", driver_name="Bob", trip_status="cancelled", rating=None,
                 request_time="2024-02-27 23:59:59"),
        ],
        TRIP_TEXT_SCHEMA,
    )


@pytest.fixture
def silver(bronze):
    return tr.silver_trips(bronze)


def test_silver_columns_and_rows(bronze, silver):
    added = ["fare_category", "fare_in_usd", "data_quality"]
    assert silver.columns == TRIP_COLUMNS + added
    assert silver.count() == bronze.count()
    assert dict(silver.dtypes)["request_time"] == "timestamp"


def test_silver_values(silver):
    got = {r.trip_id: r for r in silver.collect()}
    # (999.99 + 2000 + 2000.01 + 1500) / 4, and 1625 / 1500 = 1.08333
    assert (got["T3"].fare_amount, got["T3"].fare_in_usd) == (1625.0, 1.08)
    assert got["T3"].payment_type == "unknown"
    assert (got["T2"].rating, got["T1"].rating) == (0.0, 4.5)
    assert [got[f"T{i}"].fare_category for i in range(1, 6)] == [
        "budget", "standard", "standard", "premium", "standard",
    ]
    assert [got[f"T{i}"].data_quality for i in range(1, 6)] == [
        "ok", "ok", "incomplete", "incomplete", "ok",
    ]
    assert got["T1"].pickup_location == "Garki"
    assert got["T1"].request_time == dt.datetime(2024, 2, 26, 7)
    assert (got["T1"].pickup_time, got["T1"].dropoff_time) == (None, None)


def test_silver_without_any_fare(bronze):
    none = tr.silver_trips(bronze.withColumn("fare_amount", bronze.fare_amount * None))
    assert set(column(none, "fare_amount")) == {None}
    assert set(column(none, "fare_category")) == {"premium"}


def test_exchange_rate_is_a_parameter(bronze):
    got = tr.silver_trips(bronze, naira_per_dollar=1000)
    assert column(got.where("trip_id = 'T2'"), "fare_in_usd") == [2.0]


def test_bronze_summary(bronze):
    assert rows(tr.bronze_summary(bronze)) == [(5, 3, 1, 2, 3, 2, 1, 1)]
    assert rows(tr.bronze_summary(bronze.limit(0))) == [(0, 0, 0, 0, None, None, None, None)]


def test_silver_summary(silver):
    # usd fares .67 1.33 1.08 1.33 1.0
    assert rows(tr.silver_summary(silver)) == [(5, 3, 1, 3, 2, 2, 1, 3, 1, 1625.0, 1.08)]
    empty = rows(tr.silver_summary(silver.limit(0)))[0]
    assert empty[:3] == (0, 0, 0) and set(empty[3:]) == {None}


def test_driver_performance(silver):
    got = rows(tr.driver_performance(silver))
    assert got == [
        ("D1", "Ann", "suv", 2, 1, 1, Decimal("50.0"), 2999.99, 2.0, 1500.0, 4.5),
        ("D2", "Bob", "suv", 1, None, 1, Decimal("100.0"), 1500.0, 1.0, 1500.0, None),
    ]


def test_no_cancellation_leaves_rate_empty(bronze):
    done = tr.silver_trips(bronze.where("trip_status = 'completed'"))
    got = tr.driver_performance(done).first()
    assert (got.cancelled_trips, got.cancellation_rate_pct) == (None, None)


def test_city_summary(silver):
    assert rows(tr.city_summary(silver)) == [("Abuja", 5, 3, 4625.0, 1541.67, 4.5, 3)]


def test_daily_trends(silver):
    day = dt.date(2024, 2, 26)
    assert rows(tr.daily_trends(silver)) == [
        (day, 4, 3, 1, 4625.0, 1541.67, 1.2),
        (day + dt.timedelta(days=1), 1, None, 1, None, None, 1.2),
    ]


def test_payment_breakdown(silver):
    assert rows(tr.payment_breakdown(silver)) == [
        ("cash", 2, 1, 0, 1, 3000.0, 1500.0),
        ("unknown", 1, 0, 1, 0, 1625.0, 1625.0),
    ]


def test_vehicle_performance(silver):
    assert rows(tr.vehicle_performance(silver)) == [
        ("suv", 4, 2, 7.5, 1531.25, 6124.99, 4.5, 1.2),
        ("bike", 1, 1, 7.5, 2000.01, 2000.01, 4.5, 1.2),
    ]


def test_clean_trips(spark):
    titles = ", ".join(f"` {c.replace('_', ' ').title()}` string" for c in TRIP_COLUMNS)

    def text(*values):
        return tuple(None if v is None else str(v) for v in values)

    df = spark.createDataFrame(
        [
            text(*trip(1, fare_amount="10.0", rating="x")),
            text(*trip(2, fare_amount="n/a", rating=None, driver_id=None)),
            text(*trip(3, fare_amount="20.01", payment_type=None, driver_id="")),
            text(*trip(4, fare_amount="20.01")),
            (None,) * len(TRIP_COLUMNS),
        ],
        titles,
    )
    got = {r.trip_id: r for r in tr.clean_trips(df).collect()}
    assert sorted(got) == ["T1", "T2", "T3", "T4"]
    assert got["T2"].fare_amount == 5002 / 300
    assert (got["T1"].rating, got["T2"].rating, got["T3"].rating) == (0.0, 0.0, 4.5)
    assert got["T3"].payment_type == "unknown"
    assert [got[f"T{i}"].data_quality for i in (1, 2, 3, 4)] == ["ok", "incomplete", "ok", "ok"]
    assert rows(tr.cleaning_counts(df)) == [(5, 4, 1, 1)]


def test_band_queries_differ_on_missing_fares(bronze):
    assert dict(rows(q.fare_bands(bronze).select("trip_id", "fare_category")))["T3"] == "premium"
    assert rows(q.payment_bands(bronze)) == [("cash", 1, 0, 1), (None, 0, 0, 0)]


def test_busy_and_high_rated_are_strict(bronze):
    assert column(q.busy_drivers(bronze, 0), "total_trips") == [1, 1, 1]
    assert column(q.busy_drivers(bronze, 1), "total_trips") == []
    assert column(q.high_rated(bronze, "4.5"), "driver_name") == []
    assert sorted(column(q.high_rated(bronze, "4.49"), "driver_name"), key=str) == [
        "Ann", "Ann", None,
    ]


def test_high_rated_mean_is_exact(spark):
    # 0.1 * 3 summed as doubles is above 0.3
    columns = "driver_id int, driver_name string, rating double"
    df = spark.createDataFrame([(1, "a", 0.1)] * 3, columns)
    assert q.high_rated(df, "0.1").count() == 0


def test_high_rated_at_the_mark(spark):
    columns = "driver_id int, driver_name string, rating double"
    df = spark.createDataFrame([(1, "a", 4.30015), (2, "b", 4.3), (3, "c", 4.30004)], columns)
    assert column(q.high_rated(df, "4.30019"), "driver_name") == []
    assert column(q.high_rated(df, "4.3"), "driver_name") == ["a", "c"]
    assert column(q.high_rated(df, "4.30004"), "driver_name") == ["a"]


def test_samples_join_only_what_is_read(spark, sf_dir):
    narrow = samples.bronze_trips(spark, sf_dir, "trip_id", "payment_type", "fare_amount")
    assert "Join" not in plan(narrow)
    assert plan(samples.trips(spark, sf_dir, "driver_name")).count("Join") == 1
    assert samples.bronze_trips(spark, sf_dir).columns == TRIP_COLUMNS


def test_row_level_queries_need_not_sort(bronze):
    trips = tr.parse_times(bronze)
    for build in (q.unrated, q.fare_bands, q.running_revenue):
        ordered, stored = build(trips), build(trips, ordered=False)
        assert "rangepartitioning" in plan(ordered)
        assert "rangepartitioning" not in plan(stored)
        assert sorted(rows(ordered), key=str) == sorted(rows(stored), key=str)
