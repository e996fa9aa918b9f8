from __future__ import annotations

import pytest
from helpers import column, plan, rows
from pyspark.sql import functions as F

from oreline.operators.aggregates import (
    count_where,
    distinct_values,
    flag_total,
    frequencies,
    pivot_counts,
    tally_where,
    top_rows,
)
from oreline.operators.fills import fill_constants, fill_mean
from oreline.operators.joins import attach
from oreline.operators.reshape import (
    drop_empty_rows,
    normalise_columns,
    rename_select,
    with_content_id,
    with_row_id,
)


def test_three_conditional_counts(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "k string, v int")
    two = F.col("v") == 2
    three = [count_where(two), tally_where(two), flag_total(two)]
    assert rows(df.groupBy("k").agg(*three).orderBy("k")) == [("a", 1, 1, 1), ("b", 0, None, 0)]
    assert rows(df.limit(0).agg(*three)) == [(0, None, None)]


def test_pivot_counts(spark):
    df = spark.createDataFrame([("x",), ("y",), ("x",), (None,)], "v string")
    named = {"x": "xs", "y": "ys", "z": "zs"}
    assert rows(df.agg(*pivot_counts(F.col("v"), named))) == [(2, 1, 0)]


def test_frequencies(spark):
    df = spark.createDataFrame([("x",), ("y",), ("x",), (None,)], "v string")
    assert rows(frequencies(df, "v")) == [("x", 2), ("y", 1), (None, 1)]


def test_top_rows_breaks_ties_by_key(spark):
    df = spark.createDataFrame([("c", 1), ("a", 1), ("b", 2), ("d", 1)], "k string, n int")
    got = top_rows(df, 2, F.desc("n"), F.asc("k"))
    assert column(got, "k") == ["b", "a"]
    assert "TakeOrderedAndProject" in plan(got)


def test_distinct_values(spark):
    df = spark.createDataFrame([(" a",), ("A ",), ("b",)], "v string")
    assert sorted(column(distinct_values(df, F.upper(F.trim("v")), "u"), "u")) == ["A", "B"]


@pytest.mark.parametrize(
    "given, expected",
    [
        ([1.0, 2.0, 2.0, None], [1.0, 2.0, 2.0, 1.67]),
        ([None, None], [None, None]),
        ([1.0, 2.0], [1.0, 2.0]),
        ([], []),
        ([float("nan"), 3.0], [3.0, 3.0]),
    ],
)
def test_fill_mean_rounded(spark, given, expected):
    df = spark.createDataFrame([(v,) for v in given], "x double")
    filled = fill_mean(df, "x", 2, digits=2)
    assert column(filled, "x") == expected
    assert "Join" not in plan(filled)


def test_fill_mean_unrounded(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (2.0,), (None,)], "x double")
    assert column(fill_mean(df, "x", 2), "x")[3] == 5 / 3


def test_fill_constants(spark):
    df = spark.createDataFrame([(None, None), ("cash", float("nan"))], "p string, r double")
    assert rows(fill_constants(df, {"p": "unknown", "r": 0.0})) == [("unknown", 0.0), ("cash", 0.0)]


def test_rename_select(spark):
    df = spark.createDataFrame([(1, "A+", 2)], "`Blood Type` int, `x.y` string, z int")
    got = rename_select(df, {"Blood Type": "blood_type", "x.y": "xy"}, keep=["z"])
    assert got.columns == ["z", "blood_type", "xy"]


def test_normalise_columns(spark):
    df = spark.createDataFrame([(1, 2)], "` Trip ID ` int, `Fare Amount` int")
    assert normalise_columns(df).columns == ["trip_id", "fare_amount"]
    clash = spark.createDataFrame([(1, 2)], "` Trip ID` int, `trip id` int")
    with pytest.raises(ValueError, match="trip_id"):
        normalise_columns(clash)


def test_drop_empty_rows(spark):
    df = spark.createDataFrame([(None, None), (1, None), (None, "")], "a int, b string")
    assert sorted(rows(drop_empty_rows(df)), key=str) == [(1, None), (None, "")]


def test_row_id_is_unique(spark):
    df = with_row_id(spark.range(1000).repartition(7), "key")
    assert df.select("key").distinct().count() == 1000
    assert df.columns[0] == "key"


@pytest.mark.parametrize("copies_per_task", [1, 3, 1_000_000])
def test_content_id_numbers_copies(spark, copies_per_task):
    data = [("a", 1)] * 10 + [("a", None)] * 2 + [(None, 1)] + [("b", 2)] * 3
    df = spark.createDataFrame(data, "x string, y int")
    first = with_content_id(df, "key", copies_per_task)
    again = with_content_id(df.repartition(3), "key", copies_per_task)
    assert sorted(rows(first), key=str) == sorted(rows(again), key=str)
    assert first.select("key").distinct().count() == len(data)
    assert sorted(rows(first.drop("key")), key=str) == sorted(data, key=str)


def test_attach_keeps_rows_and_one_key(spark):
    facts = spark.createDataFrame([(1, "p"), (2, "q"), (3, "r"), (3, "s")], "id int, a string")
    details = spark.createDataFrame([(1, "x"), (3, "z"), (9, "w")], "id int, b string")
    got = attach(facts, details, "id")
    assert got.columns == ["id", "a", "b"]
    assert sorted(rows(got), key=str) == [(1, "p", "x"), (2, "q", None), (3, "r", "z"), (3, "s", "z")]
