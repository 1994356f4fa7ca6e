"""What the planner makes of the operators."""

import itertools
import re
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as app
from stoplines.operators import delays, graph, merge, stations
from stoplines.plans import table_feed
from stoplines.plans.ingest import FACT_SCHEMA, Rooms, archive_names, change_state, rooms_for, with_position
from stoplines.sources.archives import read_archives
from stoplines.sources.feed import one_per_document, parse_documents, planned_stops, stop_by_stop, stop_changes
from stoplines.sources import tables
from stoplines.sources.tables import read_table, write_by_day
from stoplines.storage import materialize

FOLDER = app.SMOKE_DIR
STOPS = pa.schema({**dict.fromkeys(table_feed.DOCUMENT[:-1], pa.string()), "cut": pa.bool_(), "xml": pa.string()})


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def layers(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("layers")
    planned = "sid string, station string, event_type string, planned_time timestamp_ntz, date date"
    changed = planned.replace("planned_time", "changed_time").replace(
        ", date date", ", cancellation_status string, date date"
    )
    for name, schema in (("planned", planned), ("changed", changed)):
        spark.createDataFrame([], schema).write.parquet(f"{folder}/{name}")
    return [spark.read.parquet(f"{folder}/{name}") for name in ("planned", "changed")]


# these start at the archive reader, which is Python
READERS = {"archive_members", "planned_stops", "stop_changes", "planned_events", "changed_events"}


@pytest.mark.parametrize("name", sorted(app.QUERIES))
def test_no_python_and_no_cross_join(spark, name):
    text = physical(app.queries()[name](spark, FOLDER))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert name in READERS or "Python" not in text and "MapInPandas" not in text


def test_documents_are_parsed_once(spark):
    text = physical(app.queries()["planned_events"](spark, FOLDER))
    assert text.count("from_xml(") == 1


def test_documents_are_stored_stop_by_stop(spark, small, delivery):
    """A row with all stops of a document took memory by the number of documents in a file."""
    for kind, folder in (("planned", "timetables"), ("changed", "changes")):
        stored = getattr(small, f"staging/{kind}_docs")
        assert "array" not in stored.schema.simpleString()
        docs = parse_documents(read_archives(spark, f"{delivery}/{folder}"))
        assert stored.filter("s IS NOT NULL").count() == docs.agg(F.sum(F.size("stops"))).first()[0]
        assert one_per_document(stored).count() == docs.count()


def test_documents_without_stops_are_kept(spark):
    raw = [("a", seq, f"250902_0700/{seq}.xml", text, None) for seq, text in enumerate(
        ['<timetable station="A"/>', "<timetable><s", '<timetable station="B"><s id="1"/><s id="2"/></timetable>'])]
    docs = parse_documents(spark.createDataFrame(raw, "archive string, seq long, member string, xml string, error string"))
    rows = stop_by_stop(docs)
    assert {(r.seq, r.pos) for r in rows.collect()} == {(0, None), (1, None), (2, 0), (2, 1)}
    known = [c for c in docs.columns if c != "stops"]
    assert sorted(map(str, one_per_document(rows).collect())) == sorted(map(str, docs.select(*known).collect()))
    assert planned_stops(rows).count() == planned_stops(docs).count() == 2


def test_feed_shuffles_and_sorts_rows_not_text(spark, monkeypatch):
    rows = table_feed.feed_rows(spark, FOLDER)
    text = physical(table_feed.stops_in_order(rows, table_feed.planned_xml()))
    assert text.rindex("</s>") < text.index("Sort ") < text.index("Exchange")
    assert "collect_list" not in physical(table_feed.documents(rows, table_feed.planned_xml()))
    monkeypatch.setattr(table_feed, "STOPS_PER_TASK", 500)
    assert table_feed.stops_in_order(rows, table_feed.planned_xml()).rdd.getNumPartitions() == -(-rows.count() // 500)


def test_only_the_parts_of_the_feed_that_are_read_are_written(spark, monkeypatch):
    monkeypatch.setattr(table_feed, "_FEEDS", {})
    folder = Path(table_feed.table_feed(spark, FOLDER, parts=("stations",)).removeprefix("file:"))
    assert [path.name for path in folder.iterdir()] == ["stations"]
    assert table_feed.table_feed(spark, FOLDER).removeprefix("file:") == str(folder)
    assert sorted(path.name for path in folder.iterdir()) == sorted(table_feed.PARTS)


def test_archives_are_counted_once_for_both_parts_of_the_feed(spark, monkeypatch):
    monkeypatch.setattr(table_feed, "_FEEDS", {})
    stored = []
    monkeypatch.setattr(table_feed, "materialize", lambda df, label: stored.append(label) or materialize(df, label))
    table_feed.table_feed(spark, FOLDER)
    assert stored == ["archives"]


def test_documents_are_put_together_by_runs(monkeypatch):
    """As row by row, wherever a batch ends; the texts of a run are taken as one piece."""
    monkeypatch.setattr(table_feed, "STOPS_PER_DOCUMENT", 3)
    names = [("a", "s", "f", "t", False)] * 5 + [("a", "s", "f", "t", True)] + [("a", "ü", "f", "", False)] * 3 + [("b", "ü", "f", "", False)]
    stops = [(*name, text) for name, text in zip(names, ["x", "", "ß", None, "yy", "z", "1", "22", "3", "é"], strict=True)]
    expected = []
    for (archive, station, folder, title, cut), own in itertools.groupby(stops, key=lambda stop: stop[:5]):
        own = list(own)
        for part in range(-(-len(own) // 3)):
            texts = "".join(stop[5] or "" for stop in own[3 * part : 3 * part + 3])
            text = f'<timetable station="{title}">{texts}{"" if cut else "</timetable>"}'
            expected.append((archive, station, part, f"{folder}_{part:04d}/{station}_timetable.xml", text.encode()))
    columns = [*table_feed.DOCUMENT, "xml"]
    for size in (1, 2, 4, 10):
        batches = [
            pa.RecordBatch.from_pylist([dict(zip(columns, stop, strict=True)) for stop in stops[i : i + size]], STOPS) for i in range(0, 10, size)
        ]
        assert list(table_feed._put_together(iter(batches))) == expected


def test_a_stored_table_is_not_stored_again_by_days(spark, tmp_path, monkeypatch):
    """As when a delivery is merged into stored facts; a day of several files keeps all rows, each in one file."""
    day = F.date_add(F.lit("2025-09-01").cast("date"), (F.col("id") % 3).cast("int"))
    df = materialize(spark.range(3_000).withColumn("day", day), "rows")
    stored = []
    monkeypatch.setattr(tables, "materialize", lambda df, label: stored.append(label) or materialize(df, label))
    write_by_day(df, "day", str(tmp_path / "t"), rows_per_file=400, staged=True)
    assert stored == ["days"]
    assert sorted(read_table(spark, str(tmp_path / "t"), df.schema).collect()) == sorted(df.collect())
    assert {len(list(folder.glob("*.parquet"))) for folder in (tmp_path / "t").glob("day=*")} == {3}


def test_first_row_is_taken_before_the_shuffle(spark):
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet")
    text = physical(merge.keep_first(lines, ["l_orderkey"], ["l_shipdate"]))
    assert re.search(r"Final.*Exchange hashpartitioning\(l_orderkey.*Partial", text, re.S)


def test_first_row_is_taken_by_as_many_tasks_as_the_rows_need(spark):
    """A part of a stored table may have far more rows than a task can sort: they are dealt out before the first sort."""
    rows = spark.range(20_000).coalesce(1).select((F.col("id") % 7_000).alias("k"), "id", F.lit("x").alias("text"))
    rows = rows.withColumn("k", F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("k")))
    first = merge.keep_first(rows, ["k"], ["id"], 20)
    text = physical(first)
    assert re.search(r"Sort.*Exchange hashpartitioning\(k.*, 20\).*Sort.*Exchange hashpartitioning\(k.*_draw.*, 20\)", text, re.S)
    assert text.count("Exchange") == 2
    plain = merge.keep_first(rows, ["k"], ["id"])
    assert first.columns == plain.columns and sorted(first.collect()) == sorted(plain.collect())
    # The key with a third of the rows meets in no task whole.
    dealt = merge.dealt(rows, 20, ["k"]).filter("k = -1").groupBy(F.spark_partition_id()).count()
    assert max(r["count"] for r in dealt.collect()) < 20_000 / 6


def test_changes_are_folded_by_as_many_tasks_as_they_need(spark):
    time = F.lit("2025-09-02 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(mins=(F.col("id") % 90).cast("int"))
    changes = spark.range(5_000).coalesce(1).select(
        (F.col("id") % 900).cast("string").alias("stop_id"), time.alias("new_arrival"),
        F.when(F.col("id") % 2 == 0, time).alias("new_departure"), (F.col("id") % 5 == 0).alias("cancelled"),
        F.concat(F.lit("a"), F.col("id") % 3).alias("archive"), "id", F.lit(0).alias("pos"),
    ).withColumnRenamed("id", "seq")
    state = change_state(changes, archive_names(changes), 30)
    assert re.search(r"partial_max_by.*Exchange hashpartitioning\(_draw#\d+, 30\)", physical(state), re.S)
    assert sorted(state.collect(), key=repr) == sorted(change_state(changes, archive_names(changes)).collect(), key=repr)


def test_archives_are_dealt_evenly(spark, monkeypatch):
    """By the hash of their names several large archives would meet in one task."""
    monkeypatch.setattr(table_feed, "STOPS_PER_TASK", 500)
    rows = table_feed.feed_rows(spark, FOLDER)
    dealt = table_feed.stops_in_order(rows, table_feed.planned_xml())
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    archive = max(r["count"] for r in rows.groupBy("archive").count().collect())
    assert sum(sizes) == rows.count() and max(sizes) <= 500 + archive


def test_station_filter_reaches_both_scans(layers):
    text = physical(delays.daily_delay(*layers, "Berlin Alexanderplatz"))
    assert text.count("EqualTo(station,Berlin Alexanderplatz)") == 2


def test_delay_sides_are_aggregated_before_the_join(layers):
    # one shuffle per side for aggregate and join together, one for the result
    assert physical(delays.daily_delay(*layers)).count("Exchange hashpartitioning") == 3


def test_lookup_is_a_pushed_filter(spark, tmp_path):
    schema = "station_eva long, station_name string, latitude decimal(9,6), longitude decimal(9,6)"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/s")
    found = stations.station_lookup(spark.read.parquet(f"{tmp_path}/s"), "Berlin-Spandau")
    assert "EqualTo(station_name,spandau)" in physical(found)


def test_edges_read_their_input_once(spark):
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet")
    edges = graph.route_edges(
        lines, trip="l_orderkey", node="l_partkey", time="l_shipdate", ties=("l_linenumber",)
    )
    edges.collect()
    assert "ReusedExchange" in physical(edges) or physical(edges).count("FileScan") == 1


def test_peaks_are_counted_in_one_scan(spark):
    events = spark.read.parquet(f"{FOLDER}/events.parquet")
    peaks = delays.peak_departures(events, station="user_id", time="ts", departure="view")
    assert physical(peaks).count("FileScan") == 1
    assert "EqualTo(event_type,view)" in physical(peaks)
    assert "props" not in re.search(r"ReadSchema: \S+", physical(peaks)).group()


def test_station_keys_are_broadcast_only_if_few(spark, monkeypatch):
    dims = spark.createDataFrame([(i, "x") for i in range(5)], "station_eva long, station_name string")
    facts = spark.range(10).select(
        F.col("id").alias("station_eva"), F.lit(1).alias("arrival_delay_minutes"),
        F.lit(1).alias("departure_delay_minutes"), F.lit(False).alias("is_cancelled"),
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert "BroadcastHashJoin" in physical(delays.mean_delay(facts, dims, "x"))
        monkeypatch.setattr(delays, "BROADCAST_STATIONS", 3)
        assert "BroadcastHashJoin" not in physical(delays.mean_delay(facts, dims, "x"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_folding_by_one_number_hashes(spark, small):
    """As in the ingest job: a position is one number, which Spark aggregates without sorting."""
    docs = getattr(small, "staging/changed_docs")
    changes = with_position(stop_changes(docs), archive_names(docs))
    text = physical(merge.fold_changes(changes, order=("position",)))
    assert "SortAggregate" not in text and text.count("HashAggregate") >= 2
    text = physical(merge.fold_with_positions(changes))
    assert "SortAggregate" not in text and text.count("HashAggregate") >= 2


def test_positions_keep_the_order(spark):
    rows = [(a, s, p) for a in ("b_1", "a_2", "a_1") for s in (0, 7) for p in (3, 11)]
    df = spark.createDataFrame(rows, "archive string, seq long, pos int").withColumn("was", F.struct("archive", "seq", "pos"))
    found = with_position(df, df).orderBy("position").collect()
    assert [tuple(r.was) for r in found] == sorted(rows)


def test_positions_are_long_numbers_if_they_can(spark):
    """Decimal numbers of 38 digits take several times as long to fold."""
    rows = [(a, s, p) for a in ("b_1", "a_2", "a_1") for s in (0, 7) for p in (3, 11)]
    df = spark.createDataFrame(rows, "archive string, seq long, pos int").withColumn("was", F.struct("archive", "seq", "pos"))
    rooms = rooms_for(3, 7, 11)
    found = with_position(df, df, rooms).orderBy("position")
    assert found.schema["position"].dataType.simpleString() == "bigint"
    assert [tuple(r.was) for r in found.collect()] == sorted(rows)
    assert rooms_for(1 << 20, 1 << 30, 1 << 20) == Rooms() and rooms_for(1, None, None).type == "bigint"
    changes = df.select(
        F.col("pos").cast("string").alias("stop_id"), F.lit("2025-09-02 00:00:00").cast("timestamp_ntz").alias("new_arrival"),
        F.lit(None).cast("timestamp_ntz").alias("new_departure"), F.lit(False).alias("cancelled"), "archive", "seq", "pos",
    )
    long = change_state(changes, (archive_names(changes), rooms), 5)
    assert "decimal(38" not in physical(long)
    assert sorted(long.collect(), key=repr) == sorted(change_state(changes, archive_names(changes)).collect(), key=repr)


def test_facts_of_a_day_are_pruned(small):
    counted = delays.count_cancelled(small.fact_train_stops, "2025-09-02", 15)
    assert counted.first()[0] == 1
    assert re.search(r"PartitionFilters: \[isnotnull\(date_id.*2025-09-02", physical(counted))


def test_days_are_written_by_several_tasks(spark, tmp_path):
    days = spark.range(400).select(
        F.col("id").alias("n"), F.date_add(F.lit("2025-01-01").cast("date"), F.when(F.col("id") < 200, 0).otherwise(F.col("id")).cast("int")).alias("day")
    )
    write_by_day(days, "day", str(tmp_path / "t"), rows_per_file=50)
    files = [p for p in (tmp_path / "t").rglob("part-*.parquet")]
    assert len({p.name.split("-")[1] for p in files}) == 4
    # the hot day is split, and no row is lost
    assert len(list((tmp_path / "t" / "day=2025-01-01").glob("part-*.parquet"))) > 1
    assert spark.read.parquet(str(tmp_path / "t")).count() == 400


def test_tasks_that_write_days_grow_with_the_rows(spark, tmp_path, monkeypatch):
    """Few days with many rows, and one with a third of all: no task sorts more than its share and one file."""
    monkeypatch.setattr(tables, "ROWS_PER_TASK", 1_000)
    day = F.when(F.col("id") % 3 > 0, F.date_add(F.lit("2025-01-01").cast("date"), (F.col("id") % 7).cast("int")))
    write_by_day(spark.range(30_000).withColumn("day", day), "day", str(tmp_path / "t"), rows_per_file=500)
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert stored.count() == 30_000 and stored.filter("day IS NULL").count() == 10_000
    file = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    sizes = [r["count"] for r in stored.groupBy(F.split(file, "-")[1].alias("task")).count().collect()]
    assert len(sizes) > 20 and max(sizes) < 2_000


def test_rows_are_evaluated_once_and_clustered(spark, tmp_path):
    """A sink reads its input once; a reader of one station skips the row groups of others."""
    seen = spark.sparkContext.accumulator(0)
    rows = spark.range(60_000).select(
        F.concat(F.lit("s"), F.lpad((F.col("id") % 300).cast("string"), 3, "0")).alias("station"),
        F.col("id").cast("string").alias("sid"), F.lit("2025-09-02").cast("date").alias("day"),
    )

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    path = str(tmp_path / "t")
    write_by_day(
        rows.mapInArrow(count, rows.schema), "day", path, cluster=("station", "sid"), rows_per_file=30_000,
        **{"parquet.block.size": "32768", "parquet.page.size": "4096"},
    )
    assert seen.value == 60_000
    files = [p for p in (tmp_path / "t").rglob("part-*.parquet")]
    assert len(files) == 2
    for file in files:
        meta = pq.ParquetFile(file).metadata
        assert meta.num_row_groups > 3
        names = [r["station"] for r in spark.read.parquet(str(file)).select("station").collect()]
        assert names == sorted(names)
    read = spark.read.parquet(path).filter("station = 's007'")
    assert read.count() == 200
    text = spark.read.parquet(path).filter("station = 's007'").select("sid")
    text.collect()
    assert scanned(text) < 60_000 / 3


def scanned(df):
    """Rows that the scan of a query which has run gave to it."""
    found = []

    def walk(plan):
        metrics = plan.metrics()
        if plan.nodeName().startswith("Scan") and metrics.contains("numOutputRows"):
            found.append(metrics.apply("numOutputRows").value())
        if plan.nodeName() == "AdaptiveSparkPlan":
            walk(plan.executedPlan())
        children = plan.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return sum(found)


def test_known_layers_are_read_without_their_files(spark, tmp_path):
    """With a schema no footer is read before the query runs."""
    folder = tmp_path / "layer" / "date_id=2025-09-02"
    folder.mkdir(parents=True)
    (folder / "part-0.parquet").write_bytes(b"no parquet file")
    assert read_table(spark, str(tmp_path / "layer"), FACT_SCHEMA).columns[-1] == "date_id"
