from __future__ import annotations

import pytest
from helpers import column, plan, rows

from oreline.operators import quality as q

TRIPS = [
    ("D1", "Ann", 1.0), (None, "Bob", None), ("", "Cid", 2.0), (" ", None, 3.0), ("D2", "", None),
]


@pytest.fixture
def trips(spark):
    return spark.createDataFrame(TRIPS, "driver_id string, driver_name string, fare double")


def test_flags(trips):
    names = ["driver_id", "driver_name"]
    strict = trips.select(q.flag(q.any_missing(names), "incomplete").alias("f"))
    assert column(strict, "f") == ["ok", "incomplete", "incomplete", "incomplete", "incomplete"]
    loose = trips.select(q.flag(q.any_missing(names, blank_is_missing=False), "bad").alias("f"))
    assert column(loose, "f") == ["ok", "bad", "ok", "bad", "ok"]


def test_profile_nulls(trips):
    got = sorted((c, n, float(p)) for c, n, p in rows(q.profile_nulls(trips)))
    assert got == [("driver_id", 2, 40.0), ("driver_name", 2, 40.0), ("fare", 2, 40.0)]
    got = sorted(rows(q.profile_nulls(trips, blank_is_missing=False).select("column", "nulls")))
    assert got == [("driver_id", 1), ("driver_name", 1), ("fare", 2)]


def test_profile_nulls_lists_only_columns_with_gaps(spark):
    df = spark.createDataFrame([(1, None)], "`a b` int, c string")
    assert column(q.profile_nulls(df), "column") == ["c"]
    assert rows(q.profile_nulls(df.limit(0))) == []


def test_profile_distinct(spark, trips):
    got = dict(rows(q.profile_distinct(trips, ["driver_id", "fare"])))
    assert got == {"driver_id": 4, "fare": 3}
    assert dict(rows(q.profile_distinct(trips.limit(0), ["fare"]))) == {"fare": 0}


def test_profile_frequencies(spark):
    df = spark.createDataFrame(
        [("x", 1.5, "u"), ("y", 1.0, None), ("x", 1.5, "u"), ("x", 1.2, "v")],
        "s string, surge double, `a b` string",
    )
    got = rows(q.profile_frequencies(df, ["s", "surge", "a b"], by_value=["surge"]))
    assert got == [
        ("a b", "u", 2), ("a b", "v", 1), ("a b", None, 1), ("s", "x", 3), ("s", "y", 1),
        ("surge", "1.0", 1), ("surge", "1.2", 1), ("surge", "1.5", 2),
    ]


def test_profile_frequencies_reads_once(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/orders.parquet")
    said = plan(q.profile_frequencies(df, ["o_orderstatus", "o_orderpriority"]))
    assert said.count("FileScan") == 1


def test_profile_shape(trips):
    types = "driver_id string, driver_name string, fare double"
    assert rows(q.profile_shape(trips, "t")) == [("t", 5, 3, types)]


def test_padded_counts(spark):
    df = spark.createDataFrame([(" a", "b"), ("c", None), ("d ", "e")], "x string, y string")
    assert rows(q.padded_counts(df, ["x", "y"])) == [("x", 2), ("y", 0)]


def test_null_counts(trips):
    assert rows(q.null_counts(trips, {"no_fare": "fare"})) == [(2,)]


def test_row_counts(spark):
    got = dict(rows(q.row_counts({"a": spark.range(3), "b": spark.range(0)})))
    assert got == {"a": 3, "b": 0}


def test_contract(spark):
    tables = {"bronze": spark.range(5), "silver": spark.range(5), "gold": spark.range(2)}
    good = q.row_count_contract(tables, {"bronze": 5, "silver": tables["bronze"], "gold": 2})
    assert [r["actual"] for r in q.enforce_contract(good)] == [5, 5, 2]
    bad = q.row_count_contract(tables, {"bronze": 5, "silver": 4, "gold": tables["bronze"]})
    with pytest.raises(q.ContractBroken, match="silver: 5 rows, not 4; gold: 2 rows, not 5"):
        q.enforce_contract(bad)


def test_contract_types(spark):
    checked = q.row_count_contract({"a": spark.range(1)}, {"a": 1})
    assert checked.dtypes == [
        ("table_name", "string"), ("expected", "bigint"), ("actual", "bigint"), ("ok", "boolean"),
    ]


def test_numbers_in_value_order(spark):
    df = spark.createDataFrame([(10.0,), (2.0,), (1.5,), (None,)], "x double")
    got = q.profile_frequencies(df, ["x"], ["x"])
    assert [r.value for r in got.collect()] == ["1.5", "2.0", "10.0", None]
