from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from helpers import column, plan, rows
from pyspark.sql import functions as F

from oreline.plans import admissions as adm
from oreline.schemas import HOSPITAL_SCHEMA

DAY = dt.date(2024, 1, 10)


def source(name, age, billed, out=3, **changes):
    base = {
        "Name": name, "Age": age, "Gender": " female", "Blood Type": "a+ ",
        "Medical Condition": " asthma", "Date of Admission": DAY, "Doctor": "Dr A",
        "Hospital": "H1", "Insurance Provider": "I1", "Billing Amount": billed,
        "Room Number": 101, "Admission Type": "Emergency",
        "Discharge Date": None if out is None else DAY + dt.timedelta(days=out),
        "Medication": "Aspirin", "Test Results": "Abnormal",
    }
    return tuple({**base, **changes}.values())


@pytest.fixture
def keyed(spark):
    df = spark.createDataFrame(
        [
            source(" Ann Lee", 17, 4999.996),
            source(None, None, None, Hospital="H2"),
            source("Bob", 60, 5000.0, out=-1, Hospital="H2", Doctor="Dr B"),
            source("Cy", 61, 20000.0, out=0, **{"Test Results": "normal "}),
            source("Di", 36, -1.0, out=None, **{"Admission Type": "Urgent"}),
            source("Ed", 18, 19999.99, Doctor="Dr C", **{"Medical Condition": "Flu"}),
        ],
        HOSPITAL_SCHEMA,
    )
    return df.selectExpr("monotonically_increasing_id() AS admission_id", "*").persist()


@pytest.fixture
def stays(keyed):
    return adm.silver_admissions(adm.bronze_admissions(keyed))


@pytest.fixture
def patients(keyed):
    return adm.silver_patients(adm.bronze_patients(keyed))


def by_bill(df, name):
    return [r[name] for r in sorted(df.collect(), key=lambda r: r.billing_amount or -9)]


def test_split_shares_the_key(keyed):
    patients, stays = adm.bronze_patients(keyed), adm.bronze_admissions(keyed)
    assert patients.columns == ["admission_id", "patient_name", "age", "gender", "blood_type"]
    assert stays.columns == [
        "admission_id", "medical_condition", "date_of_admission", "doctor", "hospital",
        "insurance_provider", "billing_amount", "room_number", "admission_type",
        "discharge_date", "medication", "test_results",
    ]
    assert sorted(column(patients, "admission_id")) == sorted(column(stays, "admission_id"))


def test_silver_patients(patients):
    assert patients.columns == [
        "admission_id", "patient_id", "age", "age_group", "gender", "blood_type",
    ]
    got = {r.age: r for r in patients.collect()}
    assert [got[a].age_group for a in (17, 18, 36, 60, 61, None)] == [
        "Paediatric (0-17)", "Young Adult (18-35)", "Adult (36-60)", "Adult (36-60)",
        "Senior (61+)", "Senior (61+)",
    ]
    assert got[None].patient_id is None and len(got[17].patient_id) == 16
    assert (got[17].gender, got[17].blood_type) == ("FEMALE", "A+")


def test_silver_admissions(stays):
    # in order of billing: NULL, -1.0, 4999.996, 5000, 19999.99, 20000
    assert by_bill(stays, "billing_amount") == [None, -1.0, 5000.0, 5000.0, 19999.99, 20000.0]
    assert by_bill(stays, "billing_category")[0] == "high"
    assert sorted(by_bill(stays, "billing_category")[2:4]) == ["low", "mid"]
    assert by_bill(stays, "billing_category")[4:] == ["mid", "high"]
    assert by_bill(stays, "data_quality")[:2] == ["investigate", "investigate"]
    assert sorted(by_bill(stays, "data_quality")[2:4]) == ["investigate", "ok"]
    assert by_bill(stays, "data_quality")[4:] == ["ok", "ok"]
    assert by_bill(stays, "length_of_stay_days")[4:] == [3, 0]
    assert by_bill(stays, "length_of_stay_days")[1] is None
    assert set(column(stays, "test_results")) == {"ABNORMAL", "NORMAL"}


def test_band_after_round(keyed):
    stays = adm.silver_admissions(adm.bronze_admissions(keyed), band_after_round=True)
    assert by_bill(stays, "billing_category")[2:4] == ["mid", "mid"]


def test_text_dates_are_parsed(spark, keyed):
    text = adm.bronze_admissions(keyed).withColumn(
        "date_of_admission", F.col("date_of_admission").cast("string")
    )
    got = adm.silver_admissions(text)
    assert dict(got.dtypes)["date_of_admission"] == "date"
    assert set(column(got, "date_of_admission")) == {DAY}


def test_stay_stats(stays):
    assert rows(adm.stay_stats(stays)) == [(-1, 3, 8 / 5)]


def test_left_join_keeps_every_stay(spark, stays, patients):
    some = patients.where("age > 20")
    joined = adm.with_patients(stays, some)
    assert joined.count() == stays.count()
    assert joined.columns.count("admission_id") == 1
    assert column(joined, "age_group").count(None) == 3
    assert "patient_name" not in joined.columns


def test_admission_summary(stays):
    got = {(r[0], r[1]): r[2:] for r in rows(adm.admission_summary(stays))}
    assert got[("ASTHMA", "EMERGENCY")] == (4, 1.3, -1, 3, 10000.0, 3, Decimal("75.0"))
    assert got[("ASTHMA", "URGENT")] == (1, None, None, None, -1.0, 1, Decimal("100.0"))


def test_hospital_revenue(stays):
    assert rows(adm.hospital_revenue(stays)) == [
        ("H1", 4, 44998.99, 11249.75, 1, 1, 2, 2.0, 2),
        ("H2", 2, 5000.0, 5000.0, 1, 1, 0, 1.0, 1),
    ]
    assert column(adm.hospital_revenue(stays, rows=1), "hospital") == ["H1"]


def test_doctor_performance_breaks_ties_by_name(stays):
    got = adm.doctor_performance(stays)
    assert column(got, "doctor") == ["Dr A", "Dr B", "Dr C"]
    assert rows(got)[0] == ("Dr A", 4, 1, 8333.0, 24999.0, 2.0, 1, 3, 0)
    assert column(adm.doctor_performance(stays, rows=2), "doctor") == ["Dr A", "Dr B"]


def test_disease_trends(stays, patients):
    got = rows(adm.disease_trends(adm.with_patients(stays, patients)))
    assert [r[0] for r in got] == sorted(r[0] for r in got)
    seniors = {(r[0], r[1]): r[2:] for r in got}[("ASTHMA", "Senior (61+)")]
    assert seniors == (2, 1.5, 20000.0, 2, Decimal("100.0"), 1)


def test_insurance_analysis(stays):
    assert rows(adm.insurance_analysis(stays)) == [
        ("I1", 6, 49998.99, 9999.8, 2, Decimal("33.3"), 2, 1.6)
    ]


def test_gold_joins_patients_only_where_they_are_read(stays, patients):
    gold = adm.gold_tables(stays, patients)
    joins = {name: "Join" in plan(df) for name, df in gold.items()}
    assert joins.pop("disease_trends") is True
    assert set(joins.values()) == {False}


def test_brief_tables(stays, patients):
    gold = adm.gold_tables(stays, patients)
    brief = {name: adm.brief(name, df) for name, df in gold.items()}
    assert brief["admission_summary"].columns == [
        "medical_condition", "admission_type", "total_admissions", "avg_length_of_stay",
        "avg_billing_amount", "abnormal_rate_pct",
    ]
    assert brief["hospital_revenue"].count() == 2
    assert all(set(df.columns) for df in brief.values())
