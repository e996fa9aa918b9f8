"""Every registered query against its SQL, and what its plan may hold."""

from __future__ import annotations

import sys

import oracle_check
import pytest
from helpers import plan

import __spark_entry__ as entry
from oreline.plans import oracle, registry

RUNS_JOBS = {
    "validate_row_counts", "validate_trip_layers", "landing_trips", "landing_late",
    "stream_trip_events", "stream_quarantine", "gold_row_counts", "catalog_insurance_analysis",
    "clean_file_records", "landing_reload", "line_breaks", "versioned_rebuild", "event_files",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    return oracle_check.connect(sf_dir)


def test_each_query_has_its_sql():
    assert set(registry.queries()) == set(oracle.oracle_sql())
    assert set(registry.queries()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", registry.queries())
def test_query_equals_sql(spark, duck, sf_dir, name):
    assert oracle_check.compare(spark, duck, name, sf_dir) == ""


@pytest.mark.parametrize("name", [n for n in registry.queries() if n not in RUNS_JOBS])
def test_plan_scales(spark, sf_dir, name):
    said = plan(entry.queries()[name](spark, sf_dir))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "CollectLimit"):
        assert bad not in said
    if name not in ("sql_q08_running_revenue", "fine_running_revenue"):
        # No window over a whole table: each is partitioned by a key.
        assert "Window [" not in said or "Exchange SinglePartition" not in said


def test_running_total_takes_one_row_per_bucket_to_one_task(spark, sf_dir):
    said = plan(entry.queries()["sql_q08_running_revenue"](spark, sf_dir))
    single = said.split("Exchange SinglePartition")[1]
    # What goes to the one task is the per-bucket sum, not the rows.
    assert single.index("HashAggregate(keys=[_slot") < single.index("FileScan")


@pytest.mark.parametrize("lost", ["ahocorasick", "oreline.llm.registry", "corpus_pipeline"])
def test_queries_without_the_training_data_operators(monkeypatch, lost):
    for name in [n for n in sys.modules if n.startswith("oreline.llm") or n == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, lost, None)
    with pytest.warns(UserWarning, match="left out"):
        known = entry.queries()
    assert set(registry.queries()) <= set(known) and "pipeline" not in known
    with pytest.warns(UserWarning, match="left out"):
        assert set(entry.oracle_sql()) <= set(known)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "payment_type" and df.count() == 6


def test_run_queries(spark, sf_dir):
    got = registry.run_queries(spark, sf_dir, ["sql_q01_status_revenue", "stay_stats"])
    assert list(got) == ["sql_q01_status_revenue", "stay_stats"]
    assert got["sql_q01_status_revenue"].count() == 2


@pytest.mark.parametrize(
    "name, lookups", [("silver_trips", 2), ("clean_trips", 2), ("gold_payment_breakdown", 0)]
)
def test_the_mean_reads_the_fare_alone(spark, sf_dir, name, lookups):
    said = plan(entry.queries()[name](spark, sf_dir))
    scans = [part.split("]")[0] for part in said.split("FileScan parquet [")[1:]]
    columns = [[c.split("#")[0] for c in scan.split(",")] for scan in scans]
    assert ["o_orderkey", "o_totalprice"] in columns
    # The lookups of the rows themselves, and none for the mean.
    assert said.count("Join [") == lookups
