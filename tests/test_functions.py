from __future__ import annotations

import datetime as dt
import hashlib
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from helpers import column, rows
from pyspark.sql import functions as F

from oreline import schemas as S
from oreline.functions.bands import band
from oreline.functions.exact import (
    Sums,
    avg_exact,
    avg_whole,
    mean_exact,
    rate_pct,
    sum_exact,
    units,
)
from oreline.functions.parse import parse_date, parse_number, parse_timestamp
from oreline.functions.text import WHITE_SPACE, is_blank, is_padded, pseudonym, upper_trim


def test_fare_band_edges(spark):
    df = spark.createDataFrame([(999.99,), (1000.0,), (2000.0,), (2000.01,), (None,)], "x double")
    got = column(df.select(band(F.col("x"), S.FARE_BANDS, S.FARE_TOP_BAND).alias("b")), "b")
    assert got == ["budget", "standard", "standard", "premium", "premium"]


def test_age_band_edges(spark):
    df = spark.createDataFrame([(a,) for a in (17, 18, 35, 36, 60, 61, None)], "x int")
    got = column(df.select(band(F.col("x"), S.AGE_BANDS, S.AGE_TOP_BAND).alias("b")), "b")
    young, adult, senior = "Young Adult (18-35)", "Adult (36-60)", "Senior (61+)"
    assert got == ["Paediatric (0-17)", young, young, adult, adult, senior, senior]


def test_band_without_steps(spark):
    assert column(spark.range(1).select(band(F.col("id"), [], "all").alias("b")), "b") == ["all"]


def test_sum_is_exact_in_any_order(spark):
    cents = [random.Random(3).randint(-10_000, 500_000) for _ in range(20_000)]
    df = spark.createDataFrame([(c / 100,) for c in cents], "x double")
    expected = (sum(cents) / 100, len(cents))
    for parts in (1, 3, 7):
        spread = df.repartition(parts)
        assert rows(spread.agg(sum_exact(F.col("x"), 2), F.count("*"))) == [expected]


def test_avg_rounds_half_away_from_zero(spark):
    cases = {"a": [0.01, 0.02], "b": [-0.01, -0.02], "c": [1.0, 2.0, 2.0], "d": [None, None]}
    data = [(k, v) for k, vs in cases.items() for v in vs]
    df = spark.createDataFrame(data, "k string, x double")
    got = dict(rows(df.groupBy("k").agg(avg_exact(F.col("x"), 2, 2))))
    assert got == {"a": 0.02, "b": -0.02, "c": 1.67, "d": None}


def test_avg_against_decimal_arithmetic(spark):
    rng = random.Random(5)
    data = [(rng.randrange(300), rng.randint(0, 10_000)) for _ in range(3_000)]
    df = spark.createDataFrame([(g, c / 100) for g, c in data], "g int, x double")
    got = dict(rows(df.groupBy("g").agg(avg_exact(F.col("x"), 2, 2))))
    for g in {g for g, _ in data}:
        cents = [c for h, c in data if h == g]
        mean = Decimal(sum(cents)) / 100 / len(cents)
        assert got[g] == float(mean.quantize(Decimal("0.01"), ROUND_HALF_UP))


def test_means_of_nothing_are_null(spark):
    df = spark.createDataFrame([], "x double, n int")
    x = F.col("x")
    whole = avg_whole(F.col("n"), 1)
    got = rows(df.agg(sum_exact(x, 2), avg_exact(x, 2, 2), mean_exact(x, 2), whole))
    assert got == [(None, None, None, None)]


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(float("nan"),), (2.5,), (None,)], "x double")
    assert rows(df.agg(sum_exact(F.col("x"), 2), mean_exact(F.col("x"), 2))) == [(2.5, 2.5)]
    assert column(df.select(units(F.col("x"), 2).alias("u")), "u") == [None, 250, None]


def test_sums_round_the_result_only(spark):
    df = spark.createDataFrame([(0.004,)] * 1000 + [(-0.0000001,)] * 10, "x double")
    x = F.col("x")
    got = rows(df.agg(sum_exact(x, 2), avg_exact(x, 2, 3), mean_exact(x, 2)))
    assert got == [(3.999999, 0.004, 3.999999 / 1010)]


def test_huge_and_infinite_values_stop_no_job(spark):
    for values in ([9.0e16] * 4, [1.0e17, 1.5], [float("inf"), 2.0], [-1e300, 1.0]):
        df = spark.createDataFrame([(v,) for v in values], "x double")
        x, total = F.col("x"), sum(values)
        got = rows(df.agg(sum_exact(x, 2), avg_exact(x, 2, 2), mean_exact(x, 2)))
        assert got == [(total, total / len(values), total / len(values))]


def test_small_values_are_not_lost(spark):
    x = F.col("x")
    for value, n in ((4e-11, 1000), (3e-15, 500), (1.25e-17, 64)):
        df = spark.range(n).select(F.lit(value).alias("x")).repartition(5)
        total = float(Decimal(repr(value)) * n)
        assert rows(df.agg(sum_exact(x, 2), mean_exact(x, 2))) == [(total, total / n)]


def test_mixed_sizes_do_not_depend_on_order(spark):
    rng = random.Random(7)
    values = [rng.choice([1e13, 3.25, 0.1, 7e-12, -1e12, 12.34567, 8589934592.5]) for _ in range(4000)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    exact_sum = sum(Decimal(repr(v)) for v in values)
    for parts in (1, 4, 9):
        got = rows(df.repartition(parts).agg(sum_exact(F.col("x"), 2)))[0][0]
        assert got == pytest.approx(float(exact_sum), rel=1e-15)
        first = got if parts == 1 else first
        assert got == first


def test_measures_declared_before_the_aggregate(spark):
    data = [("a", 1.5, 2.0), ("a", 2.25, None), ("b", None, 1e17), ("b", None, 4e-11), ("c", 0.1, 0.2)]
    df = spark.createDataFrame(data, "k string, x double, y double")
    sums = Sums()
    x, y = sums.of(F.col("x"), 2), sums.of(F.col("x") + F.col("y"), 2)
    z = sums.of(F.col("y"), 2)
    got = rows(
        sums.over(df).groupBy("k").agg(x.sum(), x.mean(2), y.sum(), z.sum(), z.mean_unrounded())
    )
    assert sorted(got) == [
        ("a", 3.75, 1.88, 3.5, 2.0, 2.0),
        ("b", None, None, None, 1e17, 5e16),
        ("c", 0.1, 0.1, 0.3, 0.2, 0.2),
    ]


def test_sum_beyond_64_bits_goes_on(spark):
    df = spark.range(20_000).select(F.lit(9.9e12).alias("x"))
    assert rows(df.agg(sum_exact(F.col("x"), 2)))[0][0] == pytest.approx(1.98e17)


def test_units_of_negative_and_noisy_values(spark):
    values = [-2008.49, 0.1 + 0.2, 1129.46 - 200, 4.35, -0.005]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = column(df.select(units(F.col("x"), 2).alias("u")), "u")
    assert got[:4] == [-200849, 30, 92946, 435]
    huge = spark.createDataFrame([(1e17,), (float("inf"),)], "x double")
    assert column(huge.select(units(F.col("x"), 2).alias("u")), "u") == [None, None]


def test_rate_type_and_rounding(spark):
    df = spark.range(16).agg(rate_pct(F.count_if(F.col("id") < 1), F.count("*")).alias("r"))
    assert df.schema["r"].dataType.simpleString() == "decimal(26,1)"
    assert rows(df) == [(Decimal("6.3"),)]


def test_parse_timestamp(spark):
    texts = ["2024-02-26 07:00:00", "bad", "", None, "2024-02-30 07:00:00", "2024-02-26"]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    got = column(df.select(parse_timestamp(F.col("x")).alias("t")), "t")
    assert got == [dt.datetime(2024, 2, 26, 7), None, None, None, None, None]


def test_parse_date(spark):
    df = spark.createDataFrame([("2024-02-26",), ("26/02/2024",), ("",), (None,)], "x string")
    got = column(df.select(parse_date(F.col("x")).alias("d")), "d")
    assert got == [dt.date(2024, 2, 26), None, None, None]


def test_parse_number(spark):
    texts = ["12.50", " 7 ", "-3", "1e3", ".5", "5.", "n/a", "", None, "1d", "0x1p3", "1,000", "1e400"]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    got = column(df.select(parse_number(F.col("x")).alias("n")), "n")
    assert got == [12.5, 7.0, -3.0, 1000.0, 0.5, 5.0] + [None] * 7


def test_white_space_is_complete():
    assert sorted(WHITE_SPACE) == [c for c in map(chr, range(0x110000)) if c.isspace()]


def test_pseudonym(spark):
    names = ["  Bobby JacksOn ", "\tX ", None, "", "ÉLODIE  Ünal", " 李 雷　", "\x1cZoë"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = column(df.select(pseudonym(F.col("n")).alias("p")), "p")
    expected = [
        None if n is None else hashlib.sha256(n.strip().lower().encode()).hexdigest()[:16]
        for n in names
    ]
    assert got == expected
    assert got[:2] == ["4ccafce9615dbc9f", "2d711642b726b044"]


def test_text_rules(spark):
    df = spark.createDataFrame([(" a ",), ("",), (None,), ("b",)], "x string")
    x = F.col("x")
    got = rows(df.select(upper_trim(x), is_blank(x), is_padded(x)))
    assert got == [("A", False, True), ("", True, False), (None, True, None), ("B", False, False)]
