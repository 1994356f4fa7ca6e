"""The ingest job: archives and station list in, star schema and event layers out.

    docs      <out>/staging/{planned,changed}_docs    every document parsed once, stop by stop
    dims      dim_stations, dim_time, dim_train_profiles
    facts     fact_train_stops                        one folder per snapshot day
    layers    planned_events, changed_events          one folder per day
    reports   corrupt_documents, unresolved_documents, stops_without_id, orphan_stops,
              orphan_stations, dropped_stations
    pending   pending_changes                         changes of stops that no plan is known of yet

A later delivery starts from the snapshot of an earlier one: existing stations are updated, existing days and
profiles stay. A fact has the positions of its plan and times, so that of two deliveries the plan read first and the time
read last count by the order of archives, whichever was delivered first. Stops that were left out for want of their
station or day, and changes without a stop, are tried again.

Dims and reports are written to a new snapshot folder each time. So are facts and layers, as a whole; or they are
kept in one `store` for all deliveries, where a delivery adds its rows to the layers and writes only those days of the facts
again in which a stop has changed.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stoplines.operators.dims import date_dim, profile_dim, station_dictionary, station_dim
from stoplines.operators.merge import (
    PLAN,
    fold_with_positions,
    insert_absent,
    keep_first,
    merge_changes,
    merge_facts,
    orphans,
    upsert,
)
from stoplines.operators.names import fuzzy_resolve, resolve_station, station_names
from stoplines.sources.archives import archive_ranges, read_archives
from stoplines.sources.feed import (
    changed_events,
    corrupt_documents,
    one_per_document,
    parse_documents,
    planned_events,
    planned_stops,
    stop_by_stop,
    stop_changes,
)
from stoplines.sources.stations import read_stations
from stoplines.sources.tables import ROWS_PER_TASK, drop_days, read_table, tasks_for, write_by_date, write_by_day, write_table
from stoplines.storage import exists, materialize

REPORTS = (
    "corrupt_documents", "unresolved_documents", "stops_without_id", "orphan_stops", "orphan_stations", "dropped_stations",
)
# Documents of an archive, and stops of a document, that a position has room for if nothing is known of them.
ROOM = 10**12

# Column order of the fact table, and the defaults of a stop without changes.
FACT_COLUMNS = [
    "stop_id",
    "station_eva",
    "profile_id",
    "date_id",
    "train_line",
    "planned_arrival",
    "actual_arrival",
    "planned_departure",
    "actual_departure",
    "arrival_delay_minutes",
    "departure_delay_minutes",
    "is_cancelled",
]
_POSITION = "struct<archive:string,seq:bigint,pos:int>"
FACT_SCHEMA = (
    "stop_id string, station_eva bigint, profile_id int, train_line string, planned_arrival timestamp_ntz, "
    "actual_arrival timestamp_ntz, planned_departure timestamp_ntz, actual_departure timestamp_ntz, "
    "arrival_delay_minutes int, departure_delay_minutes int, is_cancelled boolean, "
    f"planned_from {_POSITION}, arrival_from {_POSITION}, departure_from {_POSITION}, date_id date"
)
_CHANGE = "struct<archive:string,seq:bigint,pos:int,time:timestamp_ntz>"
STATE_SCHEMA = f"stop_id string, arrival {_CHANGE}, departure {_CHANGE}, cancelled boolean"


def archive_numbers(archives: DataFrame) -> DataFrame:
    """(archive, _number) The archives in their order."""
    # One row per file of the delivery.
    number = F.row_number().over(W.orderBy("archive")) - 1
    return archives.select("archive").distinct().withColumn("_number", number.cast("decimal(10,0)"))


@dataclass(frozen=True)
class Rooms:
    """How many documents of an archive and stops of a document a position has room for, and the type of the number."""

    seq: int = ROOM
    pos: int = ROOM
    type: str = "decimal(38,0)"

    def sql(self, number: int) -> str:
        return str(number) + ("BD" if self.type.startswith("decimal") else "L")


def rooms_for(archives: int, most_seq: int | None, most_pos: int | None) -> Rooms:
    """The least room, so that a position is a long number if it can; decimal numbers of its size take several times as long."""
    least = Rooms((most_seq or 0) + 1, (most_pos or 0) + 1, "bigint")
    return least if archives * least.seq * least.pos < 1 << 63 else Rooms()


def with_position(rows: DataFrame, archives: DataFrame, rooms: Rooms = Rooms()) -> DataFrame:
    """Replace archive, seq and pos by `position`, one number with the same order.

    Aggregations on a number hash, those on a struct sort. `archives` lists the archives.
    """
    number = F.col("_number").cast(rooms.type) if rooms.type == "bigint" else F.col("_number")
    place = (number * F.expr(rooms.sql(rooms.seq)) + F.col("seq")) * F.expr(rooms.sql(rooms.pos)) + F.col("pos")
    return (
        rows.join(archive_numbers(archives), "archive").withColumn("position", place.cast(rooms.type))
        .drop("archive", "seq", "pos", "_number")
    )


def change_state(changes: DataFrame, archives: DataFrame | tuple[DataFrame, Rooms], tasks: int | None = None) -> DataFrame:
    """The changes of a delivery as one row per stop, in a form that can be merged with that of other deliveries.

    Folded by numbers, which count archives within the delivery only; the few rows left get the archives' names. `archives`
    lists them, and may come with the room that a position needs. With
    `tasks` the changes are dealt over so many before a task folds its part of each stop.
    """
    archives, rooms = archives if isinstance(archives, tuple) else (archives, Rooms())
    numbered = with_position(changes, archives, rooms)
    state = fold_with_positions(numbered, tasks=tasks)
    numbers = archive_numbers(archives)
    document, archive = rooms.sql(rooms.pos), rooms.sql(rooms.seq * rooms.pos)
    for name in ("arrival", "departure"):
        position = f"new_{name}_position"
        named = numbers.select(F.col("archive").alias("_archive"), F.col("_number").cast("bigint").alias("_n"))
        at = F.struct(
            F.col("_archive").alias("archive"), F.expr(f"({position} % {archive}) div {document}").alias("seq"),
            F.expr(f"{position} % {document}").cast("int").alias("pos"), F.col(f"new_{name}").alias("time"),
        )
        state = state.withColumn("_n", F.expr(f"{position} div {archive}")).join(named, "_n", "left")
        state = state.withColumn(name, F.when(F.col(position).isNotNull(), at)).drop("_n", "_archive")
    return state.select("stop_id", "arrival", "departure", "cancelled")


def with_defaults(stops: DataFrame) -> DataFrame:
    """Planned stops before any change: no actual times, delays 0, not cancelled."""
    return stops.withColumns({
        "actual_arrival": F.lit(None).cast("timestamp_ntz"),
        "actual_departure": F.lit(None).cast("timestamp_ntz"),
        "arrival_delay_minutes": F.lit(0),
        "departure_delay_minutes": F.lit(0),
        "is_cancelled": F.lit(False),
    })


def with_profile_id(stops: DataFrame, profiles: DataFrame) -> DataFrame:
    """Replace train number and type by the id of the profile; missing values match too."""
    known = profiles.select(
        "profile_id", F.col("train_number").alias("_number"), F.col("train_type").alias("_type")
    )
    same = F.col("train_number").eqNullSafe(F.col("_number")) & F.col("train_type").eqNullSafe(
        F.col("_type")
    )
    return stops.join(known, same).drop("train_number", "train_type", "_number", "_type")


def archive_names(docs: DataFrame) -> DataFrame:
    return docs.select("archive").distinct()


def _same_days(days: list) -> Column:
    known = [day for day in days if day is not None]
    chosen = F.col("date_id").isin(known)
    return chosen | F.col("date_id").isNull() if None in days else chosen


def update_facts(facts: DataFrame, plans: DataFrame, changes: DataFrame, path: str) -> None:
    """Merge a delivery into the stored facts at `path`; days without a change keep their files.

    Of the stored facts, `stop_id` and the position of the plan are read to find the day of each stop that the delivery
    names, and whole rows only of the days that change. Rows of a large delivery, and those they meet, are dealt by stop over
    as many tasks as they need; a small one can be broadcast.
    """
    spark = facts.sparkSession
    delivered = plans.count() + changes.count()
    tasks = tasks_for(spark, delivered + facts.count()) if delivered > ROWS_PER_TASK else None

    def by_stop(rows: DataFrame) -> DataFrame:
        return rows.repartition(tasks, "stop_id") if tasks else rows

    named = by_stop(plans.select("stop_id").union(changes.select("stop_id")))
    stored = by_stop(facts.select("stop_id", "date_id", F.col("planned_from").alias("known_from")))
    known = materialize(stored.join(named, "stop_id", "left_semi"), "known-stops")
    # A plan counts if it is the first of its stop, or comes before the one that did.
    of_known = by_stop(known.select("stop_id", "known_from", F.col("date_id").alias("known_day")))
    earlier = by_stop(plans).join(of_known, "stop_id", "left").filter(
        F.col("known_from").isNull() | (F.col("planned_from") < F.col("known_from"))
    )
    earlier = materialize(earlier, "earlier-plans")
    moved = earlier.filter(F.col("known_from").isNotNull()).select(F.col("known_day").alias("date_id"))
    altered = by_stop(known).join(by_stop(changes.select("stop_id")), "stop_id", "left_semi").select("date_id")
    # Days of the calendar: few, however many stops there are.
    days = [row[0] for row in earlier.select("date_id").union(moved).union(altered).distinct().collect()]
    if not days:
        return
    merged = merge_facts(facts.filter(_same_days(days)), earlier.drop("known_from", "known_day"), changes, tasks=tasks)
    merged = materialize(merged.select(*facts.columns), "merged-facts")
    write_by_day(merged, "date_id", path, cluster=("station_eva", "stop_id"), only_days=True, staged=True)
    left = {row[0] for row in merged.select("date_id").distinct().collect()}
    drop_days(spark, path, "date_id", [day for day in days if day not in left])


def run_ingest(
    spark: SparkSession,
    stations_json: str,
    timetables: str,
    timetable_changes: str,
    out: str,
    previous: str | None = None,
    store: str | None = None,
) -> None:
    """Read one delivery and write the snapshot `out`, on top of the snapshot `previous` if given.

    With `store`, facts and layers are not part of the snapshot but kept there, for all deliveries.
    """
    shared = store or out

    def store_as(df: DataFrame, name: str) -> DataFrame:
        write_table(df, f"{out}/{name}")
        return read_table(spark, f"{out}/{name}", df.schema)

    def before(name: str, schema: str | None = None) -> DataFrame | None:
        return read_table(spark, f"{previous}/{name}", schema) if previous else None

    listed = read_stations(spark, stations_json)
    stations = station_dim(listed)
    if previous:
        news = stations.withColumn("_order", F.lit(0))
        stations = upsert(before("dim_stations"), news, ["station_eva"], ["_order"])
    stations = store_as(stations, "dim_stations")
    main = F.try_element_at(F.filter("evaNumbers", lambda e: e["isMain"]), F.lit(1))
    point = main["geographicCoordinates"]["coordinates"]
    wrong = F.exists(point, lambda x: x.isNotNull() & x.try_cast("decimal(9,6)").isNull())
    reason = F.when(main["number"].isNull(), "no main number").when(wrong, "wrong coordinate")
    store_as(
        listed.select("file", "pos", "name", reason.alias("reason")).filter("reason IS NOT NULL"), "dropped_stations"
    )

    days = date_dim(archive_ranges(spark, timetables))
    if previous:
        days = insert_absent(before("dim_time"), days, ["date_id"], ["date_id"])
    days = store_as(days, "dim_time")

    # Text is read and parsed once per delivery; everything below scans Parquet.
    def parsed(folder: str, name: str) -> DataFrame:
        return store_as(stop_by_stop(parse_documents(read_archives(spark, folder))), f"staging/{name}")

    # A job that ends leaves cores idle, which the other one uses.
    with ThreadPoolExecutor(2) as pool:
        reading = [pool.submit(parsed, timetables, "planned_docs"), pool.submit(parsed, timetable_changes, "changed_docs")]
        planned, changed = (done.result() for done in reading)
    store_as(
        corrupt_documents(one_per_document(planned))
        .withColumn("source", F.lit("planned"))
        .unionByName(corrupt_documents(one_per_document(changed)).withColumn("source", F.lit("changed"))),
        "corrupt_documents",
    )

    def store_planned_layer() -> None:
        write_by_date(planned_events(planned), "planned_time", f"{shared}/planned_events", bool(store), ("station", "sid"))

    def store_changed_layer() -> None:
        write_by_date(changed_events(changed), "changed_time", f"{shared}/changed_events", bool(store), ("station", "sid"))

    def store_facts() -> None:
        # Stored, so that the planner knows how small the resolved names are.
        resolved = store_as(
            fuzzy_resolve(station_names(one_per_document(planned)), station_dictionary(stations)), "staging/station_names"
        )
        located = resolve_station(planned, resolved, keep=True)
        unknown = F.col("station_eva").isNull()
        store_as(
            one_per_document(located).filter(unknown & F.col("corrupt").isNull()).select("archive", "seq", "member", "station", "file_station"),
            "unresolved_documents",
        )
        # Parsed times and stops are stored once: profiles, reports and facts all read them.
        rows = planned_stops(located.filter(~unknown)).withColumn("planned_from", F.struct("archive", "seq", "pos"))
        rows = store_as(rows.drop("station", "file_station", "archive", "seq", "pos"), "staging/planned_stops")
        named = F.col("stop_id").isNotNull()
        store_as(rows.filter(~named), "stops_without_id")
        rows = rows.filter(named)
        if previous:
            rows = rows.unionByName(before("orphan_stops")).unionByName(before("orphan_stations"))
        # An alias may stand for a station that the list lacks.
        lost = store_as(orphans(rows, stations, "station_eva"), "orphan_stations")
        missing = lost.select("station_eva").distinct()
        stops = rows.join(missing, "station_eva", "left_anti")

        profiles = store_as(profile_dim(stops, before("dim_train_profiles")), "dim_train_profiles")

        store_as(orphans(stops, days, "date_id"), "orphan_stops")
        day = days.select(F.col("date_id").alias("_day"))
        dated = stops.join(day, F.col("date_id") == F.col("_day"), "left").filter(
            F.col("_day").isNotNull() | F.col("date_id").isNull()
        )
        first = keep_first(dated, ["stop_id"], ["planned_from"], tasks_for(spark, rows.count()))
        plans = with_profile_id(first, profiles).select("stop_id", *PLAN)
        read = changed.agg(F.count("*").alias("rows"), F.max("seq").alias("seq"), F.max("pos").alias("pos")).first()
        archives = materialize(archive_names(changed), "archives")
        rooms = rooms_for(archives.count(), read["seq"], read["pos"])
        state = change_state(stop_changes(changed), (archives, rooms), tasks_for(spark, read["rows"]))
        if previous:
            state = merge_changes(before("pending_changes", STATE_SCHEMA), state)
        state = store_as(state, "staging/change_state")

        path = f"{shared}/fact_train_stops"
        if store and exists(spark, path):
            update_facts(read_table(spark, path, FACT_SCHEMA), store_as(plans, "staging/plans"), state, path)
        else:
            old = before("fact_train_stops", FACT_SCHEMA) if previous and not store else None
            facts = merge_facts(old, plans, state).select(*FACT_COLUMNS, "planned_from", "arrival_from", "departure_from")
            write_by_day(facts, "date_id", path, cluster=("station_eva", "stop_id"))
        facts = read_table(spark, path, FACT_SCHEMA)
        tasks = tasks_for(spark, state.count() + facts.count())
        known = facts.select("stop_id").repartition(tasks, "stop_id")
        store_as(state.repartition(tasks, "stop_id").join(known, "stop_id", "left_anti"), "pending_changes")

    # These do not depend on each other: jobs of one use the cores that another leaves idle.
    parts = [store_planned_layer, store_changed_layer, store_facts]
    with ThreadPoolExecutor(len(parts)) as pool:
        for done in [pool.submit(part) for part in parts]:
            done.result()
