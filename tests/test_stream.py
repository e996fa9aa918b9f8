from __future__ import annotations

import datetime as dt
import json
import os
from pathlib import Path

import pytest
from helpers import column, rows

from oreline.schemas import TRIP_TEXT_SCHEMA
from oreline.streaming import events as ev
from oreline.streaming import landing
from oreline.streaming.landing import append_batch, append_new_files, reload_files


def event(n: int, **changes) -> str:
    body = {
        "event_id": f"EVT{n % 3}", "event_type": "trip_started", "trip_id": f"T{n}",
        "driver_id": "D101", "rider_id": "R201", "city": "Abuja", "fare_amount": 500.25 + n,
        "timestamp": f"2024-02-26T07:00:{n:02d}.000123",
    }
    return json.dumps({**body, **changes})


def drop(folder: Path, name: str, lines: list[str]) -> None:
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def bodies_of(spark, lines):
    return spark.createDataFrame([(line,) for line in lines], "value string")


def test_parse_good_and_bad(spark):
    bad = [
        "not json", '{"event_id": "E1"', '{"event_id": "E1"} tail', "5", "null", "[]",
        f"[{event(1)}]", f"{event(1)},{event(2)}", f"{event(1)}]", "{'event_id': 'E1'}",
        event(1, fare_amount="dear"),
    ]
    lines = [event(1), "", "  ", None, f" {event(2)}\t", *bad]
    parsed = ev.parse_events(bodies_of(spark, lines))
    good = parsed.where(f"state = '{ev.PARSED}'")
    assert column(good, "trip_id") == ["T1", "T2"]
    assert column(good, "fare_amount") == [501.25, 502.25]
    assert column(good, "event_ts")[0] == dt.datetime(2024, 2, 26, 7, 0, 1, 123)
    assert column(good, "raw_body") == [event(1), f" {event(2)}\t"]
    quarantined = parsed.where(f"state = '{ev.QUARANTINED}'")
    assert column(quarantined, "raw_body") == bad
    assert set(column(quarantined, "trip_id")) == {None}


def test_missing_field_and_bad_time_are_null(spark):
    bare = '{"event_id": "E1", "extra": [1]}'
    lines = [bare, event(1, timestamp="soon"), event(2, fare_amount=None)]
    parsed = ev.parse_events(bodies_of(spark, lines))
    # Fields that are not known stay in the body.
    assert column(parsed, "raw_body") == lines
    assert set(column(parsed, "state")) == {ev.PARSED}
    assert column(parsed, "event_ts")[:2] == [None, None]
    assert column(parsed, "timestamp")[:2] == [None, "soon"]
    assert column(parsed, "fare_amount") == [None, 501.25, None]


def test_only_iso_times_are_read(spark):
    texts = [
        "2024-02-26T07:00:01", "2024-02-26 07:00:01.5", "2024-02-26T07:00:01Z",
        "2024-02-26T08:00:01+01:00", "12:30:00", "2024", "2024-02-26", "2024-02-30T00:00:00",
        "2024-02-26T07:00", "today", "",
    ]
    parsed = ev.parse_events(bodies_of(spark, [event(1, timestamp=t) for t in texts]))
    second = dt.datetime(2024, 2, 26, 7, 0, 1)
    half = second.replace(microsecond=500_000)
    assert column(parsed, "event_ts") == [second, half, second, second, *[None] * 7]


def test_two_drops_with_a_restart_between(spark, tmp_path):
    source, table, marks = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "marks")

    def drain():
        ev.drain_events(ev.text_source(spark, str(source), max_files=1), table, marks)

    drop(source, "a.txt", [event(1), "oops", "", event(2)])
    drop(source, "b.txt", [event(3)])
    drain()
    assert sorted(column(ev.read_events(spark, table), "trip_id")) == ["T1", "T2", "T3"]
    drain()
    assert ev.read_events(spark, table).count() == 3
    drop(source, "c.txt", [event(4), event(1), "{"])
    drain()
    # event_id repeats by design, so nothing is dropped as a duplicate.
    assert sorted(column(ev.read_events(spark, table), "trip_id")) == ["T1", "T1", "T2", "T3", "T4"]
    assert sorted(column(ev.read_quarantine(spark, table), "raw_body")) == ["oops", "{"]


def age(path: Path, days: int) -> None:
    then = path.stat().st_mtime - days * 86_400
    os.utime(path, (then, then))


def test_old_event_files_are_taken_in(spark, tmp_path):
    source, table, marks = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "marks")
    drop(source, "a.txt", [event(1)])
    ev.drain_events(ev.text_source(spark, str(source)), table, marks)
    drop(source, "b.txt", [event(2)])
    age(source / "b.txt", 30)
    ev.drain_events(ev.text_source(spark, str(source)), table, marks)
    assert sorted(column(ev.read_events(spark, table, raw=True), "trip_id")) == ["T1", "T2"]


def trip_line(n: int) -> str:
    return (
        f"T{n},D101,Ann,R1,Abuja, Garki ,Abuja,Wuse 2,2024-02-26 07:00:0{n},2024-02-26 07:05:00,,"
        f"7.5,{1000 + n}.5,1.2,cash,cancelled,,suv"
    )


HEADER = TRIP_TEXT_SCHEMA.replace(" string", "").replace(" double", "").replace(", ", ",")


def test_landing_files_are_appended_once(spark, tmp_path):
    landing, table = tmp_path / "landing", str(tmp_path / "bronze")

    def take_in(**options):
        append_new_files(spark, str(landing), TRIP_TEXT_SCHEMA, table, **options)
        return spark.read.parquet(table)

    drop(landing, "one.csv", [HEADER, trip_line(1), trip_line(2)])
    assert sorted(column(take_in(), "trip_id")) == ["T1", "T2"]
    assert take_in().count() == 2
    drop(landing, "two.csv", [HEADER, trip_line(3)])
    stored = take_in()
    assert sorted(column(stored, "trip_id")) == ["T1", "T2", "T3"]
    row = stored.where("trip_id = 'T3'").first()
    assert (row.pickup_location, row.dropoff_time, row.rating, row.fare_amount) == (
        " Garki ", None, None, 1003.5,
    )
    assert rows(stored.selectExpr("count(distinct trip_id)", "count(*)")) == [(3, 3)]
    # A file a month older than the newest one.
    drop(landing, "late.csv", [HEADER, trip_line(4)])
    age(landing / "late.csv", 30)
    assert take_in().count() == 4
    # Columns in another order, beside a file in the usual one.
    names, fields = HEADER.split(","), trip_line(5).split(",")
    drop(landing, "turned.csv", [",".join(names[::-1]), ",".join(fields[::-1])])
    drop(landing, "usual.csv", [HEADER, trip_line(6)])
    both = take_in().where("trip_id IN ('T5', 'T6')").drop("trip_id", "fare_amount", "batch")
    assert both.where("pickup_city = 'Abuja' AND vehicle_type = 'suv'").count() == 2
    # Rows of another job, and the same ones again.
    for _ in range(2):
        assert append_batch(stored.where("trip_id = 'T1'").drop("batch"), table, "again") == 1
    assert spark.read.parquet(table).count() == 7


def test_a_wrong_header_fails(spark, tmp_path):
    landing, table = tmp_path / "landing", str(tmp_path / "bronze")
    drop(landing, "one.csv", [HEADER.replace("rating", "stars"), trip_line(1)])
    with pytest.raises(Exception, match="stars"):
        append_new_files(spark, str(landing), TRIP_TEXT_SCHEMA, table)
    (landing / "one.csv").write_text("\n".join([HEADER, trip_line(1)]) + "\n")
    append_new_files(spark, str(landing), TRIP_TEXT_SCHEMA, table)
    assert spark.read.parquet(table).count() == 1


def test_reload_then_new_files(spark, tmp_path):
    landing, table = tmp_path / "landing", str(tmp_path / "bronze")
    place = (spark, str(landing), TRIP_TEXT_SCHEMA, table)
    drop(landing, "one.csv", [HEADER, trip_line(1)])
    append_new_files(*place)
    reload_files(*place)
    assert spark.read.parquet(table).count() == 1
    drop(landing, "two.csv", [HEADER, trip_line(2)])
    append_new_files(*place)
    assert sorted(column(spark.read.parquet(table), "trip_id")) == ["T1", "T2"]


@pytest.mark.parametrize("dies", ["before", "after"])
def test_a_run_that_died_is_made_good(spark, tmp_path, monkeypatch, dies):
    """Whether it died while writing its batch, or between that and the entry in the ledger."""
    land, table = tmp_path / "landing", str(tmp_path / "bronze")
    place = (spark, str(land), TRIP_TEXT_SCHEMA, table)
    drop(land, "one.csv", [HEADER, trip_line(1)])
    append_new_files(*place)
    drop(land, "two.csv", [HEADER, trip_line(2)])

    def fail(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(landing, "_enter" if dies == "after" else "_put", fail)
        with pytest.raises(RuntimeError, match="lost"):
            append_new_files(*place)
    drop(land, "three.csv", [HEADER, trip_line(3)])
    assert append_new_files(*place) == {"batches": 1, "files": 2, "rows": 2}
    assert sorted(column(spark.read.parquet(table), "trip_id")) == ["T1", "T2", "T3"]
    assert landing.batch_counts(spark, table).where("NOT ok").count() == 0


def test_files_are_archived(spark, tmp_path):
    land, table = tmp_path / "landing", str(tmp_path / "bronze")
    taken = tmp_path / "taken" / "x"
    for n in (1, 2, 3):
        drop(land, f"{n}.csv", [HEADER, trip_line(n)])
        append_new_files(spark, str(land), TRIP_TEXT_SCHEMA, table, archive=str(taken))
    assert spark.read.parquet(table).count() == 3
    assert len(list(land.glob("*.csv"))) < 3
    assert len(list(taken.rglob("*.csv"))) == 3


def test_an_archived_reload_keeps_all_rows(spark, tmp_path):
    land, table = tmp_path / "landing", str(tmp_path / "bronze")
    place, taken = (spark, str(land), TRIP_TEXT_SCHEMA, table), str(tmp_path / "taken")
    for n in range(4):
        lines = [trip_line(10 * n + k).replace("07:00:0", "07:00:") for k in range(10)]
        drop(land, f"{n}.csv", [HEADER, *lines])
        append_new_files(*place, archive=taken if n < 3 else None)
    ours = spark.read.parquet(table).where("trip_id = 'T1'").drop("batch")
    append_batch(ours, table, "other-job")
    ours.write.parquet(f"{table}/batch=no-ledger")
    assert len(list(land.glob("*.csv"))) == 1
    drop(land, "late.csv", [HEADER, trip_line(99)])
    for _ in range(2):
        reload_files(*place, archive=taken)
        stored = spark.read.parquet(table)
        assert stored.count() == 40 + 1 + 2
        assert stored.where("batch like 'landed-%'").select("trip_id").distinct().count() == 41
    counts = landing.batch_counts(spark, table)
    assert counts.count() == 7 and counts.where("NOT ok").count() == 0
    # Files that are nowhere any more: their rows stay.
    for gone in (tmp_path / "taken").rglob("1.csv"):
        gone.unlink()
    reload_files(*place, archive=taken)
    assert spark.read.parquet(table).count() == 43


def test_a_lost_batch_is_seen(spark, tmp_path):
    land, table = tmp_path / "landing", tmp_path / "bronze"
    for n in (1, 2):
        drop(land, f"{n}.csv", [HEADER, trip_line(n)])
        append_new_files(spark, str(land), TRIP_TEXT_SCHEMA, str(table), archive=f"{tmp_path}/x")
    lost = next(table.glob("batch=landed-*"))
    for part in lost.glob("*"):
        part.unlink()
    wrong = landing.batch_counts(spark, str(table)).where("NOT ok").collect()
    assert [(r.expected, r.stored) for r in wrong] == [(1, 0)]


def test_many_files_take_few_jobs(spark, tmp_path):
    land, table = tmp_path / "landing", str(tmp_path / "bronze")
    for n in range(300):
        turned = n % 3 == 0
        names, fields = HEADER.split(","), trip_line(n).replace("07:00:0", "07:00:").split(",")
        step = -1 if turned else 1
        drop(land, f"{n}.csv", [",".join(names[::step]), ",".join(fields[::step])])
    group = "landing-jobs"
    spark.sparkContext.setJobGroup(group, "many files")
    try:
        assert append_new_files(spark, str(land), TRIP_TEXT_SCHEMA, table)["files"] == 300
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) < 40
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert spark.read.parquet(table).select("trip_id").distinct().count() == 300


def test_line_breaks_in_quotes_land_whole(spark, tmp_path):
    land, table = tmp_path / "landing", str(tmp_path / "bronze")
    drop(land, "plain.csv", [HEADER, trip_line(1), trip_line(2)])
    drop(land, "odd name %41.csv", [HEADER, trip_line(3).replace("Ann", '"An\nna"'), trip_line(4)])
    drop(land, "empty.csv", [""])
    append_new_files(spark, str(land), TRIP_TEXT_SCHEMA, table)
    stored = spark.read.parquet(table)
    assert sorted(column(stored, "trip_id")) == ["T1", "T2", "T3", "T4"]
    assert stored.where("trip_id = 'T3'").first().driver_name == "An\nna"
    assert landing.batch_counts(spark, table).where("NOT ok").count() == 0


def test_event_files_without_a_checkpoint(spark, tmp_path):
    source, table = tmp_path / "in", str(tmp_path / "out")
    drop(source, "a.txt", [event(1), "oops", "", event(2)])
    assert ev.append_event_files(spark, str(source), table)["files"] == 1
    drop(source, "b.txt", [event(3)])
    age(source / "b.txt", 400)
    assert ev.append_event_files(spark, str(source), table)["files"] == 1
    assert ev.append_event_files(spark, str(source), table)["files"] == 0
    assert sorted(column(ev.read_events(spark, table), "trip_id")) == ["T1", "T2", "T3"]
    assert column(ev.read_quarantine(spark, table), "raw_body") == ["oops"]


def test_events_of_other_jobs_are_seen(spark, tmp_path):
    source, table, marks = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "marks")
    drop(source, "a.txt", [event(1)])
    ev.drain_events(ev.text_source(spark, str(source)), table, marks)
    other = ev.parse_events(bodies_of(spark, [event(7), "bad"]))
    other.write.partitionBy("state").parquet(f"{table}/batch=other")
    drop(source, "b.txt", [event(2)])
    ev.drain_events(ev.text_source(spark, str(source)), table, marks)
    assert sorted(column(ev.read_events(spark, table), "trip_id")) == ["T1", "T2", "T7"]
    assert column(ev.read_quarantine(spark, table), "raw_body") == ["bad"]
