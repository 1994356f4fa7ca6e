"""Deliveries in any order, in a store whose untouched days keep their files."""

import json
import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest

from stoplines.operators.merge import merge_changes, merge_facts
from stoplines.plans import ingest
from stoplines.plans.ingest import FACT_COLUMNS, run_ingest
from stoplines.sources import tables
from tests.conftest import CHANGED, PLANNED, STATIONS, Snapshot, stop, timetable, write_archive

ALEX = "Berlin Alexanderplatz"
WEEKS = {
    # the plan of stop 5 comes in both weeks; that of stop 6 only in the second, its change in the first
    "250902_250903": (
        [*PLANNED, ("250903_0900/k_timetable.xml", timetable(ALEX, stop("5-2509030900-1", "S 5", ar="pt=2509030900")))],
        [*CHANGED, ("250903_0900/9.xml", timetable(
            ALEX, stop("6-2509041000-1", ar="ct=2509041001", dp="cs=c"), stop("5-2509030900-1", ar="ct=2509030902")))],
    ),
    "250904_250905": (
        [
            ("250904_1000/a_timetable.xml", timetable(
                ALEX, stop("6-2509041000-1", "S 5", ar="pt=2509041000"), stop("5-2509030900-1", "RE 9", ar="pt=2509030911"))),
            # the day of this one is in no archive
            ("250907_1000/b_timetable.xml", timetable(ALEX, stop("8-2509071000-1", "RE 9", ar="pt=2509071000"))),
        ],
        [("250904_1000/1.xml", timetable(
            ALEX, stop("6-2509041000-1", dp="ct=2509041007"), stop("5-2509030900-1", ar="ct=2509030908 cs=p")))],
    ),
    "250906_250907": (
        [("250906_1000/a_timetable.xml", timetable(ALEX, stop("7-2509061000-1", "S 5", ar="pt=2509061000")))],
        [("250906_1000/1.xml", timetable(ALEX, stop("8-2509071000-1", ar="ct=2509071003")))],
    ),
}


def deliver(spark, folder, weeks, name, **more):
    path = folder / name
    for week in weeks:
        write_archive(path / "timetables" / f"{week}.tar.gz", WEEKS[week][0])
        write_archive(path / "changes" / f"{week}.tar.gz", WEEKS[week][1])
    (path / "stations.json").write_text(json.dumps(STATIONS, ensure_ascii=False))
    run_ingest(spark, f"{path}/stations.json", f"{path}/timetables", f"{path}/changes", f"{path}/out", **more)
    return Snapshot(spark, f"{path}/out")


def facts(snapshot, table):
    """The facts with the pair that a profile number stands for: numbers follow the order of deliveries."""
    rows = table.join(snapshot.dim_train_profiles, "profile_id")
    columns = [c for c in FACT_COLUMNS if c != "profile_id"]
    return sorted((tuple(r) for r in rows.select("train_number", "train_type", *columns).collect()), key=repr)


@pytest.fixture(scope="module")
def once(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("once")
    snapshot = deliver(spark, folder, WEEKS, "all")
    return facts(snapshot, snapshot.fact_train_stops)


def test_one_delivery(once):
    found = {row[2]: row for row in once}
    columns = ["train_number", "train_type", *[c for c in FACT_COLUMNS if c != "profile_id"]]
    five, six, eight = (dict(zip(columns, found[s], strict=True)) for s in ("5-2509030900-1", "6-2509041000-1", "8-2509071000-1"))
    assert (five["planned_arrival"].minute, five["arrival_delay_minutes"], five["train_type"]) == (0, 8, "S")
    assert (six["arrival_delay_minutes"], six["actual_departure"].minute, six["is_cancelled"]) == (1, 7, True)
    assert eight["arrival_delay_minutes"] == 3


@pytest.mark.parametrize("order", [[2, 1, 0], [1, 0, 2]])
def test_deliveries_in_any_order_into_a_store(spark, tmp_path, once, order):
    weeks = list(WEEKS)
    store, previous = str(tmp_path / "store"), {}
    for i in order:
        snapshot = deliver(spark, tmp_path, [weeks[i]], f"d{i}", store=store, **previous)
        previous = {"previous": snapshot.folder}
    kept = Snapshot(spark, store)
    assert facts(snapshot, kept.fact_train_stops) == once
    assert snapshot.orphan_stops.count() == 0
    # layers hold the events of all deliveries
    assert kept.planned_events.count() == 17 and kept.changed_events.count() == 9 + 3 + 2 + 1


def test_deliveries_in_any_order_as_snapshots(spark, tmp_path, once):
    weeks = list(WEEKS)
    first = deliver(spark, tmp_path, weeks[1:], "late")
    # the stop without a plan is not lost
    assert [r.stop_id for r in first.pending_changes.collect()] == []
    second = deliver(spark, tmp_path, weeks[:1], "early", previous=first.folder)
    assert facts(second, second.fact_train_stops) == once
    # a change of a stop that no delivery has a plan of goes on waiting
    assert [r.stop_id for r in second.pending_changes.collect()] == ["99-2509021500-1"]


def test_tasks_of_a_delivery_grow_with_its_stops(spark, tmp_path, once, monkeypatch):
    """The first plans and the changes are dealt over as many tasks as their rows need."""
    monkeypatch.setattr(tables, "ROWS_PER_TASK", 1)
    tasks = []
    for name in ("keep_first", "change_state"):
        original = getattr(ingest, name)
        monkeypatch.setattr(ingest, name, lambda *given, f=original: tasks.append(given[-1]) or f(*given))
    snapshot = deliver(spark, tmp_path, WEEKS, "all")
    stored = [spark.read.parquet(f"{snapshot.folder}/staging/{name}") for name in ("planned_stops", "changed_docs")]
    wanted = [stored[0].filter("stop_id IS NOT NULL").count(), stored[1].count()]
    assert tasks == [max(n, spark.sparkContext.defaultParallelism) for n in wanted] and max(wanted) == max(tasks)
    assert facts(snapshot, snapshot.fact_train_stops) == once


def test_untouched_days_keep_their_files(spark, tmp_path):
    store = str(tmp_path / "store")
    first = deliver(spark, tmp_path, list(WEEKS)[:1], "first", store=store)

    def files(day):
        folder = Path(store) / "fact_train_stops" / f"date_id=2025-09-{day:02d}"
        return {(p.name, p.stat().st_mtime_ns) for p in folder.glob("part-*.parquet")}

    before = {day: files(day) for day in (2, 3)}
    assert before[2] and before[3]
    deliver(spark, tmp_path, list(WEEKS)[1:2], "second", store=store, previous=first.folder)
    # stop 5, of the third, has a new time; nothing of the second has changed
    assert files(2) == before[2]
    assert files(3) != before[3] and files(4)


def test_a_day_whose_stops_all_moved_is_removed(spark, tmp_path):
    """An earlier archive plans the only stop of a day for another day."""
    store, previous = str(tmp_path / "store"), {}
    for i, (week, day) in enumerate((("250910_250911", "250911"), ("250908_250909", "250908"))):
        path = tmp_path / str(i)
        write_archive(path / "timetables" / f"{week}.tar.gz", [
            (f"{day}_0900/a_timetable.xml", timetable(ALEX, stop("1-1", "S 1", ar=f"pt={day}0900")))])
        write_archive(path / "changes" / f"{week}.tar.gz", [(f"{day}_0900/1.xml", timetable(ALEX, stop("1-1", ar=f"ct={day}0905")))])
        (path / "stations.json").write_text(json.dumps(STATIONS, ensure_ascii=False))
        run_ingest(spark, f"{path}/stations.json", f"{path}/timetables", f"{path}/changes", f"{path}/out", store=store, **previous)
        previous = {"previous": f"{path}/out"}
    (row,) = spark.read.parquet(f"{store}/fact_train_stops").collect()
    assert (row.date_id.day, row.planned_arrival.day, row.actual_arrival.day, row.arrival_delay_minutes) == (8, 8, 11, 3 * 1440 + 5)
    assert not (Path(store) / "fact_train_stops" / "date_id=2025-09-11").exists()


BASE = datetime(2025, 9, 2)
POSITION = "struct<archive:string,seq:bigint,pos:int>"
CHANGE = "struct<archive:string,seq:bigint,pos:int,time:timestamp_ntz>"


def test_states_merge_in_any_grouping(spark):
    rng = random.Random(4)

    def state():
        def change():
            return None if rng.random() < 0.3 else (rng.choice("ab"), rng.randrange(3), rng.randrange(3), BASE + timedelta(minutes=rng.randrange(9)))

        rows = [(key, change(), change(), rng.random() < 0.2) for key in "pqrstuvw" if rng.random() < 0.7]
        return spark.createDataFrame(rows, f"stop_id string, arrival {CHANGE}, departure {CHANGE}, cancelled boolean")

    def rows(df):
        return sorted((tuple(r) for r in df.collect()), key=repr)

    a, b, c = state(), state(), state()
    left = merge_changes(merge_changes(a, b), c)
    assert rows(left) == rows(merge_changes(a, merge_changes(c, b))) and left.columns == a.columns
    assert rows(merge_changes(a, a)) == rows(a)


def test_merged_facts_keep_the_first_plan_and_the_last_time(spark):
    plan = f"stop_id string, station_eva long, profile_id int, date_id date, train_line string, planned_arrival timestamp_ntz, planned_departure timestamp_ntz, planned_from {POSITION}"

    def plans(*rows):
        return spark.createDataFrame([(s, 1, 1, BASE.date(), None, BASE + timedelta(minutes=m), None, p) for s, m, p in rows], plan)

    def changes(*rows):
        schema = f"stop_id string, arrival {CHANGE}, departure {CHANGE}, cancelled boolean"
        return spark.createDataFrame([(s, (*p, BASE + timedelta(minutes=m)), None, c) for s, m, p, c in rows], schema)

    first = merge_facts(None, plans(("x", 0, ("b", 1, 0)), ("y", 0, ("b", 1, 1))), changes(("x", 30, ("b", 0, 0), True), ("z", 1, ("b", 0, 1), False)))
    late = merge_facts(first, plans(("x", 10, ("a", 0, 0)), ("y", 10, ("c", 0, 0))), changes(("x", 20, ("a", 9, 9), False), ("y", 3, ("a", 0, 0), False)))
    found = {r.stop_id: (r.planned_arrival.minute, r.actual_arrival.minute, r.arrival_delay_minutes, r.is_cancelled) for r in late.collect()}
    assert found == {"x": (10, 30, 20, True), "y": (0, 3, 3, False)}
