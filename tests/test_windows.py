from __future__ import annotations

import datetime as dt
import random

import pytest
from helpers import column, plan, rows
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from oreline.operators.windows import _slot, running_total, top_k_per_group


def at(day, minute):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=day, minutes=minute)


def brute(data):
    """Running cents by definition: all rows not later than this one, NULL time last."""
    out = []
    for key, when, fare in data:
        upto = [
            f for _, t, f in data
            if f is not None and (when is None or (t is not None and t <= when))
        ]
        out.append((key, when, fare, sum(round(f * 100) for f in upto) / 100 if upto else None))
    return out


CASES = {
    "ties": [(1, at(0, 5), 1.1), (2, at(0, 5), 2.2), (3, at(0, 9), 3.3), (4, at(2, 0), 4.4)],
    "null time": [(1, None, 1.0), (2, at(0, 1), 2.0), (3, None, 4.0)],
    "null fare first": [(1, at(0, 1), None), (2, at(0, 2), 2.0), (3, at(1, 0), None)],
    "nothing known": [(1, at(0, 1), None), (2, at(3, 2), None)],
    "one bucket": [(i, at(0, i % 4), i / 100) for i in range(20)],
    "empty": [],
}


@pytest.mark.parametrize("name", CASES)
def test_running_total_small(spark, name):
    data = CASES[name]
    df = spark.createDataFrame(data, "id int, t timestamp, fare double")
    got = rows(running_total(df, "t", "fare", "total", 2))
    assert sorted(got, key=lambda r: r[0]) == brute(data)


def test_running_total_random_and_hot(spark):
    rng = random.Random(11)
    hot = [(i, at(3, 7), rng.randint(0, 500) / 100) for i in range(150)]
    rest = [
        (150 + i, rng.choice([None, at(rng.randrange(40), rng.randrange(1380))]),
         rng.choice([None, rng.randint(0, 9_000) / 100]))
        for i in range(300)
    ]
    df = spark.createDataFrame(hot + rest, "id int, t timestamp, fare double")
    got = rows(running_total(df, "t", "fare", "total", 2))
    assert sorted(got, key=lambda r: r[0]) == brute(hot + rest)


def test_running_total_equals_one_global_window(spark):
    df = spark.range(5000).select(
        "id",
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 7919 % 300_000).alias("t"),
        (F.col("id") % 997 / 4).alias("fare"),
    )
    whole = F.sum("fare").over(W.orderBy("t"))
    expected = df.withColumn("total", whole)
    got = running_total(df, "t", "fare", "total", 2)
    assert expected.exceptAll(got).count() == 0 == got.exceptAll(expected).count()


def test_running_total_of_microseconds_on_one_day(spark):
    """All rows within ten seconds: a task gets one slot of the times, never the day's."""
    df = spark.range(4000).select(
        "id",
        F.timestamp_micros(F.lit(1_700_000_000_000_000) + F.col("id") * 7919 % 10_000_000).alias("t"),
        (F.col("id") % 97 / 8).alias("fare"),
    )
    expected = df.withColumn("total", F.sum("fare").over(W.orderBy("t")))
    got = running_total(df, "t", "fare", "total", 2)
    assert expected.exceptAll(got).count() == 0 == got.exceptAll(expected).count()
    said = plan(got)
    windows = [w.split("]")[0] for w in said.split("windowspecdefinition(")[1:]]
    # Rows within their slot; one row per slot without a key.
    assert windows and all("_slot" in w.split(",")[0] for w in windows)


@pytest.mark.parametrize("slots", [2, 16])
def test_running_total_of_hot_times(spark, slots):
    """Hot times are read at the end of their slot; their rows are in no window."""
    hot = [(i, at(3, 7), i % 7 / 4) for i in range(400)] + [(400 + i, None, 0.5) for i in range(300)]
    rest = [(700 + i, at(i % 9, i), 1.25 if i % 5 else None) for i in range(300)]
    df = spark.createDataFrame(hot + rest, "id int, t timestamp, fare double").repartition(4)
    got = rows(running_total(df, "t", "fare", "total", 2, slots=slots))
    assert sorted(got, key=lambda r: r[0]) == brute(sorted(hot + rest))


def test_slots_are_even(spark):
    df = spark.range(20_000).select(
        F.timestamp_micros(F.col("id") * F.col("id")).alias("t"), F.lit(1.0).alias("fare")
    )
    marks = df.agg(F.percentile_approx(F.unix_micros("t"), [k / 16 for k in range(1, 16)])).first()[0]
    sizes = column(df.groupBy(_slot(F.unix_micros("t"), marks).alias("s")).count(), "count")
    assert len(sizes) == 16 and max(sizes) < 2 * 20_000 / 16


def test_running_total_goes_on_after_a_huge_value(spark):
    data = [(1, at(0, 1), 1.25), (2, at(0, 2), 1e17), (3, at(1, 0), 2.5)]
    df = spark.createDataFrame(data, "id int, t timestamp, fare double")
    got = {r.id: r.total for r in running_total(df, "t", "fare", "total", 2).collect()}
    assert got == {1: 1.25, 2: 1e17 + 1.25, 3: 1e17 + 1.25 + 2.5}


def test_top_k(spark):
    data = [
        ("a", 1, 5.0), ("a", 2, 5.0), ("a", 3, None), ("a", 4, 9.0), ("b", 5, None), (None, 6, 1.0),
    ]
    df = spark.createDataFrame(data, "g string, id int, x double")
    order = [F.desc_nulls_last("x"), F.asc("id")]
    got = rows(top_k_per_group(df, ["g"], order, 3, "rank"))
    assert sorted(got, key=str) == sorted(
        [("a", 4, 9.0, 1), ("a", 1, 5.0, 2), ("a", 2, 5.0, 3), ("b", 5, None, 1),
         (None, 6, 1.0, 1)], key=str,
    )


def test_top_k_cuts_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS g", "id", "rand(1) AS x")
    said = plan(top_k_per_group(df, ["g"], [F.desc("x"), F.asc("id")], 3, "rank"))
    assert said.count("WindowGroupLimit") == 2
    # Printed below the exchange, so run before it.
    assert said.rindex("WindowGroupLimit") > said.index("Exchange")
