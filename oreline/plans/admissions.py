"""Admissions: bronze split, silver patients and stays, gold tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreline.functions.bands import band
from oreline.functions.exact import Exact, Sums, avg_whole, mean_exact, rate_pct
from oreline.functions.parse import parse_date
from oreline.functions.text import pseudonym, upper_trim
from oreline.operators.aggregates import (
    aliased,
    count_where,
    in_order,
    pivot_counts,
    top_rows,
)
from oreline.operators.joins import attach
from oreline.operators.quality import flag
from oreline.operators.reshape import rename_select
from oreline.schemas import (
    AGE_BANDS,
    AGE_TOP_BAND,
    BILLING_BANDS,
    BILLING_TOP_BAND,
    HOSPITAL_TO_ADMISSIONS,
    HOSPITAL_TO_PATIENTS,
    MONEY_PLACES,
    REPORT_ROWS,
)

KEY = "admission_id"
DATE_COLUMNS = ("date_of_admission", "discharge_date")


# Bronze


def bronze_patients(keyed: DataFrame) -> DataFrame:
    """Who was admitted, from the keyed source rows."""
    return rename_select(keyed, HOSPITAL_TO_PATIENTS, keep=[KEY])


def bronze_admissions(keyed: DataFrame) -> DataFrame:
    """What happened, from the same keyed source rows."""
    return rename_select(keyed, HOSPITAL_TO_ADMISSIONS, keep=[KEY])


# Silver


def silver_patients(bronze: DataFrame) -> DataFrame:
    """Patients without their name: a pseudonym instead, and an age group."""
    return bronze.select(
        KEY,
        pseudonym(F.col("patient_name")).alias("patient_id"),
        "age",
        band(F.col("age"), AGE_BANDS, AGE_TOP_BAND).alias("age_group"),
        upper_trim(F.col("gender")).alias("gender"),
        upper_trim(F.col("blood_type")).alias("blood_type"),
    )


def silver_admissions(bronze: DataFrame, band_after_round: bool = False) -> DataFrame:
    """Stays with typed dates, length of stay, billing band and a plausibility flag.

    The billing band is taken from the amount as billed, or from the rounded one if
    ``band_after_round``.
    """
    text = {name for name, kind in bronze.dtypes if kind == "string"}
    dates = {c: parse_date(F.col(c)) for c in DATE_COLUMNS if c in text}
    billed = F.col("billing_amount")
    rounded = F.round(billed, 2)
    stay = F.col("length_of_stay_days")
    dated = bronze.withColumns(dates) if dates else bronze
    typed = dated.withColumns(
        {
            "length_of_stay_days": F.datediff("discharge_date", "date_of_admission"),
            "admission_type": upper_trim(F.col("admission_type")),
            "medical_condition": upper_trim(F.col("medical_condition")),
            "test_results": upper_trim(F.col("test_results")),
            "billing_category": band(
                rounded if band_after_round else billed, BILLING_BANDS, BILLING_TOP_BAND
            ),
            "billing_amount": rounded,
        }
    )
    odd = stay.isNull() | (stay < 0) | billed.isNull()
    return typed.withColumn("data_quality", flag(odd, "investigate"))


def stay_stats(silver: DataFrame) -> DataFrame:
    """Shortest, longest and mean stay."""
    stay = F.col("length_of_stay_days")
    return silver.agg(
        F.min(stay).alias("min_stay_days"),
        F.max(stay).alias("max_stay_days"),
        mean_exact(stay.cast("double"), 0).alias("mean_stay_days"),
    )


def with_patients(admissions: DataFrame, patients: DataFrame) -> DataFrame:
    """Every stay with its patient, where there is one."""
    return attach(admissions, patients, KEY)


# Gold
#
# A stay has one patient at most, so joining patients changes no row count. Only the table that
# groups by age reads a patient column; the others are built from the stays alone and need no join.


def _stay_mean() -> Column:
    return avg_whole(F.col("length_of_stay_days"), 1)


def _billing(sums: Sums) -> Exact:
    return sums.of(F.col("billing_amount"), MONEY_PLACES)


def _result_is(value: str) -> Column:
    return F.col("test_results") == value


def admission_summary(admissions: DataFrame, ordered: bool = True) -> DataFrame:
    """Per condition and kind of admission."""
    stay = F.col("length_of_stay_days")
    abnormal, sums = count_where(_result_is("ABNORMAL")), Sums()
    measures = {
        "total_admissions": F.count("*"),
        "avg_length_of_stay_days": _stay_mean(),
        "min_stay_days": F.min(stay),
        "max_stay_days": F.max(stay),
        "avg_billing_amount": _billing(sums).mean(2),
        "abnormal_results_count": abnormal,
        "abnormal_rate_pct": rate_pct(abnormal, F.count("*")),
    }
    return (
        sums.over(admissions)
        .groupBy("medical_condition", "admission_type")
        .agg(*aliased(measures))
        .transform(in_order, ordered, F.desc("total_admissions"), "medical_condition", "admission_type")
    )


def hospital_revenue(admissions: DataFrame, rows: int = REPORT_ROWS) -> DataFrame:
    """The hospitals that billed most."""
    bands = {"high": "high_billing_cases", "mid": "mid_billing_cases", "low": "low_billing_cases"}
    sums = Sums()
    billed = _billing(sums)
    summed = sums.over(admissions).groupBy("hospital").agg(
        F.count("*").alias("total_admissions"),
        billed.sum().alias("total_revenue"),
        billed.mean(2).alias("avg_billing_amount"),
        *pivot_counts(F.col("billing_category"), bands),
        _stay_mean().alias("avg_length_of_stay"),
        F.count_distinct("medical_condition").alias("conditions_treated"),
    )
    return top_rows(summed, rows, F.desc("total_revenue"), F.asc("hospital"))


def doctor_performance(admissions: DataFrame, rows: int = REPORT_ROWS) -> DataFrame:
    """The doctors with most patients."""
    results = {
        "NORMAL": "normal_results",
        "ABNORMAL": "abnormal_results",
        "INCONCLUSIVE": "inconclusive_results",
    }
    sums = Sums()
    billed = _billing(sums)
    summed = sums.over(admissions).groupBy("doctor").agg(
        F.count("*").alias("total_patients"),
        F.count_distinct("medical_condition").alias("conditions_treated"),
        billed.mean(2).alias("avg_billing_amount"),
        billed.sum().alias("total_revenue_generated"),
        _stay_mean().alias("avg_length_of_stay"),
        *pivot_counts(F.col("test_results"), results),
    )
    return top_rows(summed, rows, F.desc("total_patients"), F.asc("doctor"))


def disease_trends(joined: DataFrame, ordered: bool = True) -> DataFrame:
    """Per condition and age group, from stays with their patients."""
    emergency, sums = count_where(F.col("admission_type") == "EMERGENCY"), Sums()
    measures = {
        "total_cases": F.count("*"),
        "avg_stay_days": _stay_mean(),
        "avg_billing": _billing(sums).mean(2),
        "emergency_admissions": emergency,
        "emergency_rate_pct": rate_pct(emergency, F.count("*")),
        "abnormal_tests": count_where(_result_is("ABNORMAL")),
    }
    return (
        sums.over(joined)
        .groupBy("medical_condition", "age_group")
        .agg(*aliased(measures))
        .transform(in_order, ordered, "medical_condition", F.desc("total_cases"), "age_group")
    )


def insurance_analysis(admissions: DataFrame, ordered: bool = True) -> DataFrame:
    """Per insurer."""
    high, sums = count_where(F.col("billing_category") == "high"), Sums()
    billed = _billing(sums)
    measures = {
        "total_claims": F.count("*"),
        "total_billed": billed.sum(),
        "avg_claim_amount": billed.mean(2),
        "high_cost_claims": high,
        "high_cost_rate_pct": rate_pct(high, F.count("*")),
        "conditions_covered": F.count_distinct("medical_condition"),
        "avg_covered_stay_days": _stay_mean(),
    }
    return (
        sums.over(admissions)
        .groupBy("insurance_provider")
        .agg(*aliased(measures))
        .transform(in_order, ordered, F.desc("total_billed"), "insurance_provider")
    )


# The scheduled job's shorter tables: the wide ones without some columns, one of them renamed.
BRIEF = {
    "admission_summary": {
        "medical_condition": "medical_condition",
        "admission_type": "admission_type",
        "total_admissions": "total_admissions",
        "avg_length_of_stay_days": "avg_length_of_stay",
        "avg_billing_amount": "avg_billing_amount",
        "abnormal_rate_pct": "abnormal_rate_pct",
    },
    "hospital_revenue": {
        "hospital": "hospital",
        "total_admissions": "total_admissions",
        "total_revenue": "total_revenue",
        "avg_billing_amount": "avg_billing_amount",
        "avg_length_of_stay": "avg_length_of_stay",
    },
    "doctor_performance": {
        "doctor": "doctor",
        "total_patients": "total_patients",
        "conditions_treated": "conditions_treated",
        "avg_billing_amount": "avg_billing_amount",
        "total_revenue_generated": "total_revenue_generated",
    },
    "disease_trends": {
        "medical_condition": "medical_condition",
        "age_group": "age_group",
        "total_cases": "total_cases",
        "avg_stay_days": "avg_stay_days",
        "avg_billing": "avg_billing",
        "emergency_rate_pct": "emergency_rate_pct",
    },
    "insurance_analysis": {
        "insurance_provider": "insurance_provider",
        "total_claims": "total_claims",
        "total_billed": "total_billed",
        "avg_claim_amount": "avg_claim_amount",
        "high_cost_rate_pct": "high_cost_rate_pct",
    },
}


def brief(table: str, wide: DataFrame) -> DataFrame:
    return rename_select(wide, BRIEF[table])


GOLD = {
    "admission_summary": admission_summary,
    "hospital_revenue": hospital_revenue,
    "doctor_performance": doctor_performance,
    "disease_trends": disease_trends,
    "insurance_analysis": insurance_analysis,
}


def gold_tables(admissions: DataFrame, patients: DataFrame) -> dict[str, DataFrame]:
    """The gold tables as they are stored: not sorted, but for the reports of the top rows."""
    joined = with_patients(admissions, patients.select(KEY, "age_group"))
    return {
        "admission_summary": admission_summary(admissions, ordered=False),
        "hospital_revenue": hospital_revenue(admissions),
        "doctor_performance": doctor_performance(admissions),
        "disease_trends": disease_trends(joined, ordered=False),
        "insurance_analysis": insurance_analysis(admissions, ordered=False),
    }


def disease_keys(admissions: DataFrame, patients: DataFrame) -> DataFrame:
    """The distinct keys of ``disease_trends``."""
    joined = with_patients(admissions.select(KEY, "medical_condition"), patients.select(KEY, "age_group"))
    return joined.select("medical_condition", "age_group").distinct()
