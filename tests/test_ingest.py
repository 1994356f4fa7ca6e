"""The whole job on the small delivery, and the queries on its result."""

from datetime import date, datetime

import pytest

from stoplines.operators import delays, geo, graph, quality, stations
from stoplines.plans.ingest import run_ingest
from tests.conftest import Snapshot, stop, timetable, write_archive


def at(text):
    return datetime.strptime(f"2025-{text}", "%Y-%m-%d %H:%M")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_dimensions(small):
    names = {r.station_eva: r.station_name for r in small.dim_stations.collect()}
    assert names == {1001: "hauptbahnhof", 1002: "alexanderplatz", 1003: "spandau", 1004: "südkreuz"}
    assert [r.name for r in small.dropped_stations.collect()] == ["Ohne Haupt"]
    assert rows(small.dim_time) == [
        (date(2025, 9, 2), 2025, 9, 2, "Tuesday"),
        (date(2025, 9, 3), 2025, 9, 3, "Wednesday"),
    ]
    assert rows(small.dim_train_profiles) == [(1, "12", "RE"), (2, "7", "RB"), (3, "73768", "S")]


def test_fact_table(small):
    facts = {r.stop_id: r for r in small.fact_train_stops.collect()}
    assert len(facts) == 10

    def changes(stop_id):
        r = facts[stop_id]
        return (
            r.actual_arrival, r.actual_departure,
            r.arrival_delay_minutes, r.departure_delay_minutes, r.is_cancelled,
        )

    assert facts["34-2509021705-2"].planned_arrival == at("09-02 17:20")
    assert changes("-12-2509021500-1") == (at("09-02 14:55"), None, None, 0, False)
    assert changes("-12-2509021500-2") == (at("09-02 15:17"), at("09-02 15:20"), 7, 9, False)
    assert changes("-12-2509021500-3") == (at("09-02 15:31"), None, 1, 0, True)
    assert changes("34-2509021705-1") == (None, at("09-02 17:00"), 0, -5, False)
    assert changes("56-2509022355-1") == (None, at("09-03 00:03"), 0, 8, False)
    untouched = ["34-2509021705-2", "78-2509020730-1", "79-2509030859-1", "80-2509020900-1", "81-2509020700-1"]
    assert {changes(s) for s in untouched} == {(None, None, 0, 0, False)}
    assert facts["79-2509030859-1"].date_id == date(2025, 9, 3)
    assert small.corrupt_documents.count() == small.orphan_stops.count() == 0


def test_event_layers(small):
    assert small.planned_events.count() == 12
    changed = small.changed_events
    assert changed.count() == 9
    assert changed.columns[-1] == "date"
    undated = changed.filter("date is null").collect()
    assert [(r.cancellation_status, r.changed_time) for r in undated] == [("c", None)]


def test_station_queries(small):
    dims = small.dim_stations
    found = stations.station_lookup(dims, "Berlin Hauptbahnhof").collect()
    assert [(r.station_eva, float(r.latitude), float(r.longitude)) for r in found] == [(1001, 52.525, 13.369)]
    assert stations.station_lookup(dims, "Nowhere").count() == 0
    assert geo.nearest(dims, 52.516266, 13.377775).first().station_name == "hauptbahnhof"


@pytest.mark.parametrize(
    ("hour", "expected"), [(15, 1), (17, 0)]
)
def test_cancellations(small, hour, expected):
    assert delays.count_cancelled(small.fact_train_stops, "2025-09-02", hour).first().cancelled == expected


@pytest.mark.parametrize(
    ("name", "expected"),
    [("Berlin Alexanderplatz", 19 / 3), ("Berlin Hauptbahnhof", 0.0), ("Berlin-Spandau", None)],
)
def test_mean_delay(small, name, expected):
    result = delays.mean_delay(small.fact_train_stops, small.dim_stations, name).first().avg_delay
    assert result == (None if expected is None else pytest.approx(expected))


def test_daily_delay(small):
    layers = small.planned_events, small.changed_events
    daily = delays.daily_delay(*layers, "Berlin Alexanderplatz")
    assert rows(daily) == [(date(2025, 9, 2), 4.0)]
    assert delays.overall_delay(daily).first().avg_delay == 4.0
    wide = delays.daily_delay(*layers, "Berlin Alexanderplatz", same_day=False)
    assert rows(wide) == [(date(2025, 9, 2), pytest.approx(4.8))]


def test_peak_departures(small):
    result = delays.peak_departures(small.planned_events).collect()
    assert [tuple(r) for r in result] == [
        ("Berlin Alexanderplatz", None, 1.0),
        ("Berlin Hauptbahnhof", 1.5, None),
    ]


def test_graph(small):
    edges = graph.route_edges(graph.trip_stops(small.planned_events))
    directed = rows(edges)
    assert len(directed) == 5
    assert sorted(s for s, d in directed if s == d) == ["BERLIN ALEXANDERPLATZ", "BERLIN SÜDKREUZ"]
    full = graph.undirected(edges)
    assert full.count() == 8
    path = graph.shortest_path(full, "BERLIN HAUPTBAHNHOF", "BERLIN SÜDKREUZ").collect()
    assert [tuple(r) for r in path] == [
        (2, ["BERLIN HAUPTBAHNHOF", "BERLIN ALEXANDERPLATZ", "BERLIN SÜDKREUZ"])
    ]


def test_quality(small):
    per_date = quality.rows_per_date(small.changed_events, time="changed_time")
    assert rows(per_date.filter("date is not null")) == [
        (date(2025, 9, 2), 7, 0), (date(2025, 9, 3), 1, 0),
    ]
    assert tuple(quality.summary(per_date).first()) == (9, 3, 1)
    assert tuple(quality.summary(per_date.limit(0)).first()) == (0, 0, 0)


def test_next_delivery_builds_on_a_snapshot(spark, small, delivery, tmp_path):
    write_archive(tmp_path / "timetables" / "250904_250904.tar.gz", [
        ("250904_1000/x_timetable.xml", timetable(
            "Berlin Alexanderplaz",
            stop("90-2509041000-1", "ICE 1", dp="pt=2509041000"),
            stop("-12-2509021500-2", "S 73768", ar="pt=2509041111"),
        )),
        ("250905_1000/y_timetable.xml", timetable(
            "Berlin Alexanderplatz", stop("91-2509051000-1", "RE 12", dp="pt=2509051000"))),
        ("250904_1100/alexanderplatz_timetable.xml", timetable(
            None, stop("92-2509041100-1", dp="pt=2509041100"))),
        ("250904_1200/z_timetable.xml", '<timetable station="x"><s id="93"><tl c='),
    ])
    write_archive(tmp_path / "changes" / "250904_250904.tar.gz", [
        ("250904_1000/1.xml", timetable("x", stop("-12-2509021500-2", dp="ct=2509021530"))),
        ("250904_1000/2.xml", timetable("x", stop("90-2509041000-1", dp="ct=2509041003"))),
    ])
    out = str(tmp_path / "snapshot")
    run_ingest(
        spark, f"{delivery}/stations.json", f"{tmp_path}/timetables", f"{tmp_path}/changes", out,
        previous=small.folder,
    )
    later = Snapshot(spark, out)
    assert later.dim_stations.count() == 4
    assert [r[0].day for r in rows(later.dim_time)] == [2, 3, 4]
    profiles = {tuple(r)[1:]: r.profile_id for r in later.dim_train_profiles.collect()}
    assert profiles == {
        ("12", "RE"): 1, ("7", "RB"): 2, ("73768", "S"): 3, (None, None): 4, ("1", "ICE"): 5,
    }
    facts = {r.stop_id: r for r in later.fact_train_stops.collect()}
    assert len(facts) == 12
    old = facts["-12-2509021500-2"]
    assert (old.planned_arrival, old.arrival_delay_minutes) == (at("09-02 15:10"), 7)
    assert (old.actual_departure, old.departure_delay_minutes) == (at("09-02 15:30"), 19)
    assert (facts["90-2509041000-1"].station_eva, facts["90-2509041000-1"].departure_delay_minutes) == (1002, 3)
    assert (facts["92-2509041100-1"].station_eva, facts["92-2509041100-1"].profile_id) == (1002, 4)
    assert [r.stop_id for r in later.orphan_stops.collect()] == ["91-2509051000-1"]
    assert [r.member for r in later.corrupt_documents.collect()] == ["250904_1200/z_timetable.xml"]
