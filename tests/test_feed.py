"""Reading archives and documents: edge cases."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from stoplines.functions.text import normalize_name, station_text, trip_id
from stoplines.functions.times import feed_text, feed_time, minutes_between
from stoplines.operators.dims import date_dim, station_dim
from stoplines.operators.merge import fold_changes, keep_first
from stoplines.sources.archives import archive_ranges, path_metadata, read_archives
from stoplines.sources.feed import (
    changed_events,
    corrupt_documents,
    parse_documents,
    planned_events,
    planned_stops,
    stop_changes,
)
from stoplines.sources.stations import read_stations
from tests.conftest import stop, timetable, write_archive


def docs(spark, *texts):
    raw = [("250902_250903.tar.gz", i, f"250902_1500/f{i}_timetable.xml", t, None) for i, t in enumerate(texts)]
    schema = "archive string, seq long, member string, xml string, error string"
    return parse_documents(spark.createDataFrame(raw, schema))


def test_malformed_document_is_set_apart(spark):
    parsed = docs(spark, timetable("x", stop("1", "S 1")), '<timetable><s id="2"><ar pt=', timetable("y", stop("3")))
    assert {r.stop_id for r in planned_stops(parsed).collect()} == {"1", "3"}
    assert [r.seq for r in corrupt_documents(parsed).collect()] == [1]


def test_empty_timetable_has_no_rows(spark):
    parsed = docs(spark, '<timetable station="x"/>')
    assert planned_stops(parsed).count() == planned_events(parsed).count() == corrupt_documents(parsed).count() == 0


def test_missing_label(spark):
    parsed = docs(spark, timetable("x", stop("a-1", dp="pt=2509021500")))
    row = planned_stops(parsed).first()
    assert (row.train_type, row.train_number) == (None, None)
    event = planned_events(parsed).first()
    assert (event.event_type, event.category, event.number, event.owner) == ("departure", "", "", "")


def test_owner_keeps_leading_zero_and_attributes_keep_spaces(spark):
    parsed = docs(spark, timetable(" x ", stop("1", "S 1", ar="pt=2509021500")))
    event = planned_events(parsed).first()
    assert (event.owner, event.station, event.line) == ("08", " x ", None)


@pytest.mark.parametrize("text", ["25090215", "2513011200", "2502300000", "2509022460", "", "abcdefghij", None])
def test_bad_time_is_null(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(feed_time(F.col("t"))).first()[0] is None


def test_times_ignore_clock_changes(spark):
    df = spark.createDataFrame([("2503300230", "2510260130", "2510260330")], "gap string, a string, b string")
    row = df.select(
        feed_time(F.col("gap")).alias("gap"),
        minutes_between(feed_time(F.col("a")), feed_time(F.col("b"))).alias("minutes"),
        (F.unix_timestamp(feed_time(F.col("b"))) - F.unix_timestamp(feed_time(F.col("a")))).alias("seconds"),
    ).first()
    assert tuple(row) == (datetime(2025, 3, 30, 2, 30), 120, 7200)


@pytest.mark.parametrize(("start", "end"), [("2503300130", "2503300230"), ("2503300200", "2503300300")])
def test_minutes_in_the_hour_that_is_skipped(spark, start, end):
    df = spark.createDataFrame([(start, end)], "a string, b string")
    minutes = minutes_between(feed_time(F.col("a")), feed_time(F.col("b")))
    assert df.select(minutes).first()[0] == 60


@pytest.mark.parametrize(("text", "year"), [("9901020304", 2099), ("6801020304", 2068), ("0001020304", 2000)])
def test_years_are_of_this_century(spark, text, year):
    df = spark.createDataFrame([(text,)], "t string")
    row = df.select(feed_time(F.col("t")).alias("time"), feed_text(feed_time(F.col("t"))).alias("text")).first()
    assert tuple(row) == (datetime(year, 1, 2, 3, 4), text)


def test_order_across_archives(spark):
    """The archive comes first, then the document, then the place in it, whatever arrives first."""
    schema = "archive string, seq long, member string, xml string, error string"

    def change(archive, seq, minute):
        return (archive, seq, "x/y", timetable("x", stop("1", ar=f"ct=25090215{minute}")), None)

    late, early = change("b.tar.gz", 0, 20), change("a.tar.gz", 7, 30)
    for order in ([late, early], [early, late]):
        docs = parse_documents(spark.createDataFrame(order, schema))
        assert fold_changes(stop_changes(docs)).first().new_arrival == datetime(2025, 9, 2, 15, 20)
        first = keep_first(stop_changes(docs), ["stop_id"], ["archive", "seq", "pos"]).first()
        assert first.new_arrival == datetime(2025, 9, 2, 15, 30)


def test_day_first_order(spark):
    df = spark.createDataFrame([("0209251730",)], "t string")
    assert df.select(feed_time(F.col("t"), "DDMMYY")).first()[0] == datetime(2025, 9, 2, 17, 30)


def test_nested_stop_is_no_row(spark):
    parsed = docs(spark, timetable("x", '<s id="1"><conn><s id="2"/></conn><dp pt="2509021500"/></s>'))
    assert [r.stop_id for r in planned_stops(parsed).collect()] == ["1"]


@pytest.mark.parametrize(
    ("arrival", "departure", "line"),
    [('<ar l=""/>', '<dp l="5"/>', "5"), ('<ar l="3"/>', '<dp l="5"/>', "3"), ("", '<dp l=""/>', None), ("", "", None)],
)
def test_line_fallback(spark, arrival, departure, line):
    parsed = docs(spark, timetable("x", f'<s id="1">{arrival}{departure}</s>'))
    assert planned_stops(parsed).first().train_line == line


def test_useful_changes_only(spark):
    parsed = docs(spark, timetable(
        "x", stop("1", ar="cs=c"), stop("2", dp="cs=p"), stop("3", dp="ct=2509021500"), stop("4"),
    ))
    assert {(r.stop_id, r.cancelled) for r in stop_changes(parsed).collect()} == {("1", True), ("3", False)}


def test_change_defaults(spark):
    parsed = docs(spark, timetable("x", '<s id="1"><ar clt="2509021400"/><dp/></s>'))
    first, second = changed_events(parsed).orderBy("event_type").collect()
    assert first.cancellation_time == datetime(2025, 9, 2, 14)
    assert (second.line, second.cancellation_status, second.planned_platform, second.changed_path) == ("",) * 4


def test_path_metadata(spark):
    raw = spark.createDataFrame(
        [("week_250228_250301_x.tar.gz", "250228_2300/Berlin-Spandau_timetable.xml"), ("odd.tar.gz", "loose.xml")],
        "archive string, member string",
    )
    known, odd = path_metadata(raw).collect()
    assert (known.range_start, known.range_end) == (date(2025, 2, 28), date(2025, 3, 1))
    assert (known.snapshot_date, known.file_station) == (date(2025, 2, 28), "Berlin-Spandau")
    assert (odd.range_start, odd.snapshot_date) == (None, None)


@pytest.mark.parametrize("spread", [True, False, None])
def test_archives_in_member_order(spark, tmp_path, spread):
    names = [f"250902_{i:04d}/s{i}_timetable.xml" for i in range(20)]
    write_archive(tmp_path / "a_250902_250903.tar.gz", [(n, timetable(n)) for n in names] + [("x/readme", "-")])
    write_archive(tmp_path / "b_250904_250905.tar.gz", [("250904_0000/t_timetable.xml", b"\xff\xfe")])
    (tmp_path / "other.txt").write_text("ignored")
    (tmp_path / "c_250906_250906.tar.gz").write_bytes((tmp_path / "a_250902_250903.tar.gz").read_bytes()[:200])
    found = read_archives(spark, str(tmp_path), spread).orderBy("archive", "seq").collect()
    assert [r.member for r in found if r.archive.startswith("a_")] == names
    assert [r.seq for r in found if r.archive.startswith("a_")] == list(range(20))
    bad = {r.archive[0]: r for r in found if r.error}
    assert set(bad) == {"b", "c"}
    assert bad["c"].xml is None


def test_archive_ranges_and_days(spark, tmp_path):
    for name in ("250228_250301", "250301_250302", "250301_250301"):
        write_archive(tmp_path / f"{name}.tar.gz", [])
    days = date_dim(archive_ranges(spark, str(tmp_path)))
    assert sorted((r.date_id, r.day_of_week) for r in days.collect()) == [
        (date(2025, 2, 28), "Friday"), (date(2025, 3, 1), "Saturday"), (date(2025, 3, 2), "Sunday"),
    ]


def test_station_list_last_wins(spark, tmp_path):
    (tmp_path / "s.json").write_text(
        '{"result": [{"name": "Old", "evaNumbers": [{"number": 1, "isMain": true}]},'
        ' {"name": "New-Berlin", "evaNumbers": [{"number": 1, "isMain": true,'
        ' "geographicCoordinates": {"coordinates": [13.5, 52.5]}}]}, {"name": "None", "evaNumbers": []}]}'
    )
    (row,) = station_dim(read_stations(spark, str(tmp_path / "s.json"))).collect()
    assert (row.station_name, float(row.latitude), float(row.longitude)) == ("new", 52.5, 13.5)


@pytest.mark.parametrize(
    ("name", "expected"),
    [
        ("  Berlin-Südkreuz (S) ", "südkreuz  s"),
        ("S+U Berlin Hbf", "s u  hbf"),
        ("bberlinerlin", "berlin"),
        ("a_b", "a_b"),
        ("Berlin", ""),
    ],
)
def test_normalize_name(spark, name, expected):
    df = spark.createDataFrame([(name,)], "n string")
    assert df.select(normalize_name(F.col("n"))).first()[0] == expected


def test_graph_texts(spark):
    df = spark.createDataFrame([("-12-2509021500-13", " Berlin Süd ")], "sid string, station string")
    row = df.select(trip_id(F.col("sid")), station_text(F.col("station"))).first()
    assert tuple(row) == ("-12-2509021500", "BERLIN SÜD")
