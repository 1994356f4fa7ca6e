"""Nothing is lost without being listed; odd input of the station list and of paths."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stoplines.operators import dims, graph
from stoplines.plans.ingest import run_ingest
from stoplines.plans.table_feed import documents, feed_rows, planned_xml
from stoplines.sources.archives import stream_uri
from stoplines.sources.stations import read_stations
from stoplines.storage import drop_scratch, materialize, scratch_root
from tests.conftest import STATIONS, Snapshot, stop, timetable, write_archive

TABLES = "/root/testdata/sf0.001"


def test_every_left_out_row_is_listed(spark, tmp_path):
    odd = {"result": [*STATIONS["result"], {
        "name": "Weit Weg",
        "evaNumbers": [{"number": 7, "isMain": True, "geographicCoordinates": {"coordinates": [1000.0, 52.0]}}],
    }]}
    (tmp_path / "stations.json").write_text(json.dumps(odd, ensure_ascii=False))
    good = stop("1-2509020700-1", "S 1", dp="pt=2509020700")
    write_archive(tmp_path / "timetables" / "250902_250902.tar.gz", [
        ("250902_0700/a_timetable.xml", timetable("Berlin Alexanderplatz", good, '<s><dp pt="2509020701"/></s>')),
        ("250902_0700/_timetable.xml", timetable(None, stop("2-2509020700-1", dp="pt=2509020700"))),
        ("250902_0700/yorckstra_e__gro_g_rschenstra_e__timetable.xml", timetable(None, stop("3-2509020700-1", dp="pt=2509020700"))),
        ("250903_0700/a_timetable.xml", timetable("Berlin Alexanderplatz", stop("4-2509030700-1", dp="pt=2509030700"))),
        ("250902_0800/b_timetable.xml", "<timetable"),
    ])
    write_archive(tmp_path / "changes" / "250902_250902.tar.gz", [("250902_0700/1.xml", timetable("x"))])
    out = str(tmp_path / "out")
    run_ingest(spark, f"{tmp_path}/stations.json", f"{tmp_path}/timetables", f"{tmp_path}/changes", out)
    found = Snapshot(spark, out)
    assert [r.stop_id for r in found.fact_train_stops.collect()] == ["1-2509020700-1"]
    assert found.stops_without_id.count() == 1
    assert [r.member for r in found.unresolved_documents.collect()] == ["250902_0700/_timetable.xml"]
    assert [(r.stop_id, r.station_eva) for r in found.orphan_stations.collect()] == [("3-2509020700-1", 8089051)]
    assert [r.stop_id for r in found.orphan_stops.collect()] == ["4-2509030700-1"]
    assert found.corrupt_documents.count() == 1
    assert {(r.name, r.reason) for r in found.dropped_stations.collect()} == {
        ("Ohne Haupt", "no main number"), ("Weit Weg", "wrong coordinate"),
    }
    far = found.dim_stations.filter("station_eva = 7").first()
    assert far.longitude is None and float(far.latitude) == 52.0


def test_cut_off_station_list_is_an_error(spark, tmp_path):
    (tmp_path / "s.json").write_text(json.dumps(STATIONS)[:-40])
    with pytest.raises(Exception, match="(?i)malformed|failfast|parse"):
        read_stations(spark, f"{tmp_path}/s.json").collect()


def test_later_station_file_wins(spark, tmp_path):
    for name, city in (("a", "Alt"), ("b", "Neu")):
        number = {"number": 5, "isMain": True}
        (tmp_path / f"{name}.json").write_text(json.dumps({"result": [{"name": city, "evaNumbers": [number]}]}))
    found = dims.station_dim(read_stations(spark, str(tmp_path))).collect()
    assert [r.station_name for r in found] == ["neu"]


def test_start_and_end_are_written_like_nodes(spark):
    edges = spark.createDataFrame([("A", "B"), ("B", "C")], "src string, dst string")
    assert graph.shortest_path(edges, " a", "c ").first().path == ["A", "B", "C"]


@pytest.mark.parametrize(("path", "uri"), [
    ("/data/a b.tar.gz", "/data/a b.tar.gz"),
    ("file:/data/a.tar.gz", "/data/a.tar.gz"),
    ("file:///data/a.tar.gz", "/data/a.tar.gz"),
    ("s3a://bucket/x/a b.tar.gz", "s3://bucket/x/a%20b.tar.gz"),
    ("s3://bucket/a.tar.gz", "s3://bucket/a.tar.gz"),
    ("wasbs://box@account.example/a.tar.gz", "abfss://box@account.example/a.tar.gz"),
    ("dbfs:/a.tar.gz", None),
    ("hdfs://host/a.tar.gz", None),
])
def test_archive_paths(path, uri):
    assert stream_uri(path) == uri


def test_archives_through_spark_alone(spark, tmp_path, monkeypatch):
    from stoplines.sources import archives

    write_archive(tmp_path / "250902_250902.tar.gz", [("250902_0700/a_timetable.xml", "<a/>"), ("250902_0700/b_timetable.xml", "<b/>")])
    streamed = archives.read_archives(spark, str(tmp_path)).orderBy("seq").collect()
    monkeypatch.setattr(archives, "stream_uri", lambda path: None)
    assert archives.read_archives(spark, str(tmp_path)).orderBy("seq").collect() == streamed


@pytest.mark.skipif(not Path(TABLES).is_dir(), reason="needs the generated tables")
def test_archive_names_depend_on_their_own_rows_only(spark):
    rows = feed_rows(spark, TABLES)
    part = rows.where("l_orderkey % 3 = 0")
    names = {r[0] for r in part.select("archive").distinct().collect()}
    assert names <= {r[0] for r in rows.select("archive").distinct().collect()}
    same = part.select("l_orderkey", "archive").join(rows.select("l_orderkey", F.col("archive").alias("other")), "l_orderkey")
    assert same.where("archive <> other").count() == 0
    assert documents(rows, planned_xml()).where(F.regexp_count("text", F.lit("<s ")) > 1000).count() == 0


def test_scratch_can_be_dropped(spark):
    stored = materialize(spark.range(3), "gone")
    assert stored.count() == 3 and scratch_root(spark).startswith("file:")
    # Other tests of this session read their own tables, so only one is removed here.
    path = Path(stored.inputFiles()[0].removeprefix("file://")).parent
    assert str(path).startswith(scratch_root(spark).removeprefix("file:"))
    assert callable(drop_scratch)
