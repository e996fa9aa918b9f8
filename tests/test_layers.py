from __future__ import annotations

import json
from pathlib import Path

import pytest
from helpers import column, plan, rows

from oreline.operators.quality import ContractBroken
from oreline.plans import layers
from oreline.plans import trips as tr
from oreline.schemas import HOSPITAL_SCHEMA, TRIP_COLUMNS
from oreline.session import NoSharedFolder, scratch_path, shuffle_tasks
from oreline.sources import readers, samples, sinks


@pytest.fixture
def hospital(spark, sf_dir, folder):
    source = f"{folder}/source"
    written = sinks.write_csv(samples.hospital_rows(spark, sf_dir, keyed=False), source)
    return source, written


def test_csv_round_trip(spark, sf_dir, hospital):
    source, written = hospital
    back = readers.read_csv(spark, source, HOSPITAL_SCHEMA, keep_corrupt=False)
    given = samples.hospital_rows(spark, sf_dir, keyed=False)
    assert written == back.count() == given.count()
    assert back.exceptAll(given).count() == 0 == given.exceptAll(back).count()


def test_broken_lines_are_kept(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\n1,x\nfour,y\n,\n")
    plain = readers.read_csv(spark, str(tmp_path / "x.csv"), "a int, b string", keep_corrupt=False)
    assert rows(plain) == [(1, "x"), (None, "y"), (None, None)]
    kept = readers.read_csv(spark, str(tmp_path / "x.csv"), "a int, b string")
    assert column(kept, "_corrupt_record") == [None, "four,y", None]


def test_columns_are_read_by_name(spark, tmp_path):
    (tmp_path / "x.csv").write_text("b,a\nx,1\n")
    read = readers.read_csv(spark, str(tmp_path / "x.csv"), "a int, b string", keep_corrupt=False)
    assert rows(read) == [(1, "x")]
    with pytest.raises(readers.HeaderMismatch, match="expected"):
        readers.read_csv(spark, str(tmp_path / "x.csv"), "a int, c string")
    (tmp_path / "y.csv").write_text("a,b\n2,y\n")
    paths = [str(tmp_path / "x.csv"), str(tmp_path / "y.csv")]
    both, expected = readers.read_csv_files(spark, paths, "a int, b string", keep_corrupt=False)
    assert sorted(rows(both)) == [(1, "x"), (2, "y")] and expected == 2
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_csv(spark, paths, "a int, b string").collect()


@pytest.mark.parametrize("stable_ids", [False, True])
def test_admissions_end_to_end(spark, hospital, folder, stable_ids):
    source, written = hospital
    cfg = layers.LayerConfig(source, f"{folder}/lake", stable_ids=stable_ids)
    counts = layers.run_admissions(spark, cfg)
    assert {counts[f"{layer}/{t}"] for layer in ("bronze", "silver") for t in (
        "patients", "admissions")} == {written}
    assert counts["gold/hospital_revenue"] == counts["gold/doctor_performance"] == 20
    for table, count in counts.items():
        stored = readers.read_path(spark, cfg.path(table))
        assert stored.count() == count
        if not table.startswith("bronze"):
            assert "patient_name" not in stored.columns
    patients = readers.read_path(spark, cfg.path("bronze/patients"))
    stays = readers.read_path(spark, cfg.path("bronze/admissions"))
    assert patients.join(stays, "admission_id").count() == written
    trends = readers.read_path(spark, cfg.path("gold/disease_trends"))
    assert trends.where("age_group IS NULL").count() == 0


def test_the_scheduled_jobs_form(spark, hospital, folder):
    source, written = hospital
    cfg = layers.LayerConfig(source, f"{folder}/lake", band_after_round=True, brief_gold=True)
    assert layers.run_admissions(spark, cfg)["silver/admissions"] == written
    summary = readers.read_path(spark, cfg.path("gold/admission_summary"))
    assert summary.columns == [
        "medical_condition", "admission_type", "total_admissions", "avg_length_of_stay",
        "avg_billing_amount", "abnormal_rate_pct",
    ]
    assert summary.selectExpr("sum(total_admissions)").first()[0] == written


def test_both_tables_share_each_rows_key(spark, hospital, folder):
    source, _ = hospital
    cfg = layers.LayerConfig(source, f"{folder}/lake")
    layers.admissions_bronze(spark, cfg)
    patients = readers.read_path(spark, cfg.path("bronze/patients"))
    stays = readers.read_path(spark, cfg.path("bronze/admissions"))
    wide = readers.read_csv(spark, source, HOSPITAL_SCHEMA).selectExpr("Name", "Doctor", "Hospital")
    again = patients.join(stays, "admission_id").selectExpr(
        "patient_name", "doctor", "hospital"
    )
    assert wide.exceptAll(again).count() == 0


def test_no_copy_of_names_outside_the_lake(spark, hospital, folder, tmp_path):
    source, _ = hospital
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.rglob("*"))
    layers.run_admissions(spark, layers.LayerConfig(source, f"{folder}/lake"))
    assert set(shared.rglob("*")) == before


def test_a_lost_bronze_row_is_seen(spark, hospital, folder):
    source, written = hospital
    cfg = layers.LayerConfig(source, f"{folder}/lake")
    layers.run_admissions(spark, cfg)
    checks = layers.admissions_checks(spark, cfg)
    assert checks.count() == 9 and checks.where("not ok").count() == 0
    stays = readers.read_path(spark, cfg.path("bronze/admissions")).collect()
    short = spark.createDataFrame(stays[1:])
    sinks.write_path(short, cfg.path("bronze/admissions"))
    broken = {r.table_name for r in layers.admissions_checks(spark, cfg).where("not ok").collect()}
    assert broken == {"bronze/admissions", "silver/admissions"}


def test_failed_expectation_stops_the_run(spark, hospital, folder):
    source, _ = hospital
    cfg = layers.LayerConfig(source, f"{folder}/lake", expected={"gold/insurance_analysis": 3})
    with pytest.raises(ContractBroken, match="gold/insurance_analysis"):
        layers.run_admissions(spark, cfg)


def test_trips_append_then_rebuild(spark, sf_dir, folder):
    landing = f"{folder}/landing"
    batch = samples.bronze_trips(spark, sf_dir)
    first = sinks.write_csv(batch.where("trip_status = 'completed'"), landing, mode="append")
    cfg = layers.LayerConfig(landing, f"{folder}/lake")
    counts = layers.run_trips(spark, cfg)
    assert counts["bronze/trips"] == counts["silver/trips"] == first
    assert layers.run_trips(spark, cfg)["bronze/trips"] == first
    second = sinks.write_csv(batch.where("trip_status <> 'completed'"), landing, mode="append")
    counts = layers.run_trips(spark, cfg)
    assert counts["bronze/trips"] == counts["silver/trips"] == first + second == batch.count()
    assert counts["gold/payment_breakdown"] == 6
    whole = readers.read_path(spark, cfg.path("silver/trips"))
    day = readers.read_path(spark, cfg.path("gold/daily_trends"))
    assert day.selectExpr("sum(total_trips)").first()[0] == whole.count()


def test_trips_reload_overwrites(spark, sf_dir, folder):
    cfg = layers.LayerConfig(f"{folder}/in", f"{folder}/lake")
    n = sinks.write_csv(samples.bronze_trips(spark, sf_dir), cfg.source)
    assert layers.trips_reload(spark, cfg) == layers.trips_reload(spark, cfg) == {"bronze/trips": n}
    assert readers.read_path(spark, cfg.path("bronze/trips")).count() == n


def test_json_records_keep_nulls(spark, sf_dir, folder):
    clean = tr.clean_trips(samples.exported_trips(spark, sf_dir))
    written = sinks.write_json_records(clean, f"{folder}/json")
    assert written == clean.count()
    lines = [
        json.loads(line) for f in Path(folder, "json").glob("*.json") for line in f.open()
    ]
    assert len(lines) == written
    assert {tuple(line) for line in lines} == {tuple(clean.columns)}
    assert any(line["driver_id"] is None for line in lines)


def test_clean_file_counts(spark, sf_dir, folder):
    sinks.write_csv(samples.exported_trips(spark, sf_dir), f"{folder}/export")
    counts = layers.clean_file(spark, f"{folder}/export", f"{folder}/clean").first()
    assert counts.rows_before == counts.rows_after + counts.rows_dropped > counts.rows_after
    assert spark.read.json(f"{folder}/clean").count() == counts.rows_after


def test_catalog_tables_and_views(spark, sf_dir):
    bronze = samples.bronze_trips(spark, sf_dir)
    for _ in range(2):
        assert sinks.write_table(bronze, "bronze_trips") == bronze.count()
    stored = readers.read_table(spark, "bronze_trips")
    assert stored.count() == bronze.count()
    silver = sinks.register_view(tr.silver_trips(stored), "silver")
    assert spark.sql("SELECT count(*) FROM silver").first()[0] == silver.count()
    spark.sql("DROP TABLE bronze_trips")


def test_tables_bucketed_alike_join_without_a_shuffle(spark):
    left, right = spark.range(1000).selectExpr("id", "id % 7 AS a"), spark.range(1000)
    for name, df in {"stays_b": left, "patients_b": right}.items():
        sinks.write_table(df, name, bucket_by=["id"], buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("stays_b").join(spark.table("patients_b"), "id", "left")
        assert "Exchange" not in plan(joined)
        assert joined.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("stays_b", "patients_b"):
            spark.sql(f"DROP TABLE {name}")


def test_append_path(spark, folder):
    assert sinks.append_path(spark.range(3), f"{folder}/t") == 3
    assert sinks.append_path(spark.range(2), f"{folder}/t") == 2
    assert readers.read_path(spark, f"{folder}/t").count() == 5


def test_scratch_lies_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert one.startswith(shared) and one != two


def test_shuffle_tasks_follow_the_data():
    assert shuffle_tasks(0) == 200
    assert shuffle_tasks(1024**4) == 4096
    assert shuffle_tasks(100 * 1024**4) == 409_600


TRIP_HEADER = ",".join(TRIP_COLUMNS)
TRIP_LINE = (
    "T{},D1,Ann,R1,Abuja,Garki,Abuja,Yaba,2024-02-26 07:00:00,,,7.5,{},1.2,cash,completed,4.5,suv"
)


def test_corrupt_lines_stay_in_bronze(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    lines = [TRIP_HEADER, TRIP_LINE.format(1, "1200.5"), TRIP_LINE.format(2, "n/a")]
    (landing / "a.csv").write_text("\n".join(lines) + "\n")
    cfg = layers.LayerConfig(str(landing), f"{tmp_path}/lake", keep_corrupt=True, max_files=1)
    assert layers.run_trips(spark, cfg)["silver/trips"] == 2
    bronze = readers.read_path(spark, cfg.path("bronze/trips"))
    assert set(column(bronze, "_corrupt_record")) == {None, TRIP_LINE.format(2, "n/a")}
    silver = readers.read_path(spark, cfg.path("silver/trips"))
    assert "_corrupt_record" not in silver.columns
    assert column(silver, "fare_amount") == [1200.5, 1200.5]


def test_corrupt_admissions_are_kept_apart(spark, tmp_path):
    header = ",".join(part.split("`")[1] for part in HOSPITAL_SCHEMA.split(", "))
    good = "Ann,30,Female,A+,Flu,2024-01-01,Dr A,H1,I1,100.5,101,Urgent,2024-01-03,Aspirin,Normal"
    bad = good.replace("100.5", "lots").replace("Ann", "Bob")
    (tmp_path / "x.csv").write_text("\n".join([header, good, bad]) + "\n")
    cfg = layers.LayerConfig(f"{tmp_path}/x.csv", f"{tmp_path}/lake", keep_corrupt=True)
    counts = layers.run_admissions(spark, cfg)
    assert (counts["bronze/patients"], counts["bronze/corrupt"]) == (2, 1)
    corrupt = readers.read_path(spark, cfg.path("bronze/corrupt"))
    assert column(corrupt, "_corrupt_record") == [bad]


def test_parallel_writes_keep_the_callers_job_group(spark, folder):
    sc = spark.sparkContext
    sc.setJobGroup("layer-writes", "two tables")
    try:
        frames = {"a": spark.range(3), "b": spark.range(4)}
        assert sinks.write_all(frames, folder) == {"a": 3, "b": 4}
        assert len(sc.statusTracker().getJobIdsForGroup("layer-writes")) >= 2
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert sinks.write_all({}, folder) == {}


@pytest.mark.parametrize("catalog", [False, True])
def test_a_rebuild_that_dies_leaves_the_old_table(spark, folder, catalog):
    good, bad = spark.range(5), spark.range(9).selectExpr("raise_error('lost') AS id")
    write = sinks.publish_table if catalog else sinks.write_path
    place = "kept_whole" if catalog else f"{folder}/t"
    read = spark.table if catalog else (lambda path: readers.read_path(spark, path))
    assert write(good, place) == 5
    for n in (3, 4, 6):
        before = read(place)
        with pytest.raises(Exception, match="lost"):
            write(bad.union(spark.range(1)), place)
        assert read(place).count() == before.count()
        # A table may be made from itself.
        assert write(before.limit(1).select("id").union(spark.range(n - 1)), place) == n
        assert read(place).count() == n
    if catalog:
        tables = [r.tableName for r in spark.sql("SHOW TABLES LIKE 'kept_whole*'").collect()]
        assert len(tables) <= 4
        spark.sql("DROP VIEW kept_whole")
        for name in set(tables) - {"kept_whole"}:
            spark.sql(f"DROP TABLE {name}")
    else:
        assert len(list(Path(place).glob("_v-*"))) <= 3


def test_a_plain_table_becomes_a_versioned_one(spark, folder):
    sinks.write_plain(spark.range(4), f"{folder}/t")
    assert readers.read_path(spark, f"{folder}/t").count() == 4
    assert sinks.write_path(spark.range(2), f"{folder}/t") == 2
    assert sinks.append_path(spark.range(1), f"{folder}/t") == 1
    assert readers.read_path(spark, f"{folder}/t").count() == 3
    spark.sql("CREATE TABLE once_plain USING parquet AS SELECT * FROM range(3)")
    assert sinks.publish_table(spark.range(2), "once_plain") == 2
    assert spark.table("once_plain").count() == 2


def test_line_breaks_in_quoted_fields(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text('a,b\n1,"x\ny"\n2,"p ""q"",\n\n r"\n3,z\n')
    (tmp_path / "in" / "b c.csv").write_text('a,b\n4,"plain, with ""quotes"""\nfive,y\n')
    read = readers.read_csv(spark, str(tmp_path / "in"), "a int, b string")
    assert sorted(rows(read.where("a is not null").select("a", "b"))) == [
        (1, "x\ny"), (2, 'p "q",\n\n r'), (3, "z"), (4, 'plain, with "quotes"'),
    ]
    assert column(read.where("a is null"), "_corrupt_record") == ["five,y"]
    assert readers.count_csv(spark, str(tmp_path / "in"), "a int, b string") == 5
    assert readers.count_csv(spark, str(tmp_path / "in" / "b c.csv"), "a int, b string") == 2


def test_archived_runs_are_checked(spark, sf_dir, folder):
    cfg = layers.LayerConfig(f"{folder}/in", f"{folder}/lake", archive=f"{folder}/done")
    batch = samples.bronze_trips(spark, sf_dir)
    n = sinks.write_csv(batch.where("trip_id % 2 = 0"), cfg.source, mode="append")
    assert layers.run_trips(spark, cfg)["bronze/trips"] == n
    n += sinks.write_csv(batch.where("trip_id % 2 = 1"), cfg.source, mode="append")
    assert layers.run_trips(spark, cfg)["bronze/trips"] == n
    assert layers.trips_reload(spark, cfg) == {"bronze/trips": n}
    checks = layers.trips_checks(spark, cfg)
    assert checks.where("table_name = 'bronze/trips' and ok").count() == 1
    one = next(Path(cfg.path("bronze/trips")).glob("batch=landed-*"))
    for part in one.glob("*"):
        part.unlink()
    with pytest.raises(ContractBroken, match="bronze/trips"):
        layers.trips_silver(spark, cfg)
        layers.enforce_contract(layers.trips_checks(spark, cfg))


def test_scratch_needs_a_shared_folder(spark):
    class Elsewhere:
        """A session on a cluster, without a shared folder."""

        def __init__(self, warehouse):
            self.conf = {"spark.sql.warehouse.dir": warehouse}
            self.sparkContext = self
            self.master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    with pytest.raises(NoSharedFolder):
        scratch_path(Elsewhere("file:/tmp/warehouse"), "x")
    with pytest.raises(NoSharedFolder):
        scratch_path(Elsewhere("/tmp/warehouse"), "x")
    assert scratch_path(Elsewhere("hdfs://lake/warehouse"), "x").startswith("hdfs://lake/warehouse/")
