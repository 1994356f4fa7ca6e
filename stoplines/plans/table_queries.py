"""The operators applied to the given tables, as named queries."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stoplines.functions.text import clean_text, normalize_name
from stoplines.functions.times import feed_text, feed_time
from stoplines.operators import delays, dims, geo, graph, merge, names, quality, stations
from stoplines.plans import network
from stoplines.plans.ingest import FACT_COLUMNS, REPORTS, run_ingest, with_defaults
from stoplines.plans.table_feed import table_feed, tables_version
from stoplines.sources.archives import path_metadata, read_archives
from stoplines.sources.feed import (
    changed_events,
    layer_schema,
    parse_documents,
    planned_events,
    planned_stops,
    stop_changes,
    unpivot_events,
)
from stoplines.sources.stations import read_stations
from stoplines.sources.tables import read_table, write_by_date
from stoplines.storage import materialize, scratch_dir

# Parameters of the queries.
PRIORITY = "1-URGENT"
CANCEL_DATE, CANCEL_HOUR = "2024-01-27", 7
POINT = (4500.0, 12.0)
LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey"]
LINE_KEY = ["l_orderkey", "l_linenumber"]


class Tables:
    """The given tables of one folder, as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return read_table(self.spark, f"{self.folder}/{name}.parquet")


# Delays


def daily_delay(t: Tables) -> DataFrame:
    planned = t.orders.select(
        F.col("o_orderkey").alias("sid"), F.col("o_orderpriority").alias("station"),
        F.col("o_orderdate").alias("planned_time"),
    )
    changed = t.lineitem.select(
        F.col("l_orderkey").alias("sid"), F.col("l_shipdate").alias("changed_time"),
        F.when(F.col("l_returnflag") == "R", "c").otherwise("p").alias("cancellation_status"),
    )
    daily = delays.daily_delay(planned, changed, station=PRIORITY, keys=("sid",), same_day=False)
    return daily.select("date", F.round("avg_delay", 6).alias("avg_delay"))


def same_day_delay(t: Tables) -> DataFrame:
    """Many rows on both sides of a key: each event type is a station, each user a stop."""
    layer = t.events.select(
        F.col("user_id").alias("sid"), F.col("ts"), "event_type", F.to_date("ts").alias("date")
    )
    planned = layer.filter(F.col("event_type") == "view").withColumnRenamed("ts", "planned_time")
    changed = layer.filter(F.col("event_type") != "view").select(
        "sid", "date", F.col("ts").alias("changed_time"),
        F.when(F.col("event_type") == "error", "c").otherwise("").alias("cancellation_status"),
    )
    daily = delays.daily_delay(planned, changed, keys=("sid",))
    return daily.select("date", F.round("avg_delay", 6).alias("avg_delay"))


def overall_delay(t: Tables) -> DataFrame:
    return delays.overall_delay(daily_delay(t)).select(F.round("avg_delay", 4).alias("avg_delay"))


def mean_delay(t: Tables) -> DataFrame:
    suppliers = t.supplier.select(
        F.col("s_suppkey").alias("station_eva"),
        normalize_name(F.concat(F.lit("nation "), F.col("s_nationkey"))).alias("station_name"),
    )
    stops = t.lineitem.select(
        F.col("l_suppkey").alias("station_eva"),
        F.col("l_discount").alias("arrival_delay_minutes"),
        F.col("l_tax").alias("departure_delay_minutes"),
        (F.col("l_returnflag") == "R").alias("is_cancelled"),
    )
    result = delays.mean_delay(stops, suppliers, "Nation 7")
    return result.select(F.round("avg_delay", 6).alias("avg_delay"))


def count_cancelled(t: Tables) -> DataFrame:
    stops = t.events.select(
        F.to_date("ts").alias("date_id"),
        F.col("ts").alias("planned_arrival"),
        (F.col("ts") + F.expr("INTERVAL 30 MINUTES")).alias("planned_departure"),
        (F.col("event_type") == "error").alias("is_cancelled"),
    )
    return delays.count_cancelled(stops, CANCEL_DATE, CANCEL_HOUR)


def peak_departures(t: Tables) -> DataFrame:
    result = delays.peak_departures(t.events, station="user_id", time="ts", departure="view")
    morning, evening = (F.round(F.col(f"`{name}`"), 6) for name in delays.PEAKS)
    return result.select(
        "user_id",
        morning.alias("morning_avg_departures"),
        evening.alias("evening_avg_departures"),
    )


# Stations


def _nation_stations(t: Tables) -> DataFrame:
    return t.nation.select(
        F.col("n_nationkey").cast("bigint").alias("station_eva"),
        normalize_name(F.col("n_name")).alias("station_name"),
        (F.col("n_nationkey") + 0.5).alias("latitude"),
        F.col("n_regionkey").cast("double").alias("longitude"),
    )


def station_lookup(t: Tables) -> DataFrame:
    return stations.station_lookup(_nation_stations(t), "  Berlin-NATION_7 ")


def nearest(t: Tables) -> DataFrame:
    found = geo.nearest(t.supplier, *POINT, key="s_suppkey", lat="s_acctbal", lon="s_nationkey")
    return found.select("s_suppkey", F.round("distance_metric", 4).alias("distance_metric"))


def nearest_batch(t: Tables) -> DataFrame:
    """The supplier nearest to each customer, by balance and nation."""
    found = geo.nearest_batch(
        t.customer, t.supplier, query_key="c_custkey", key="s_suppkey",
        lat="s_acctbal", lon="s_nationkey", query_lat="c_acctbal", query_lon="c_nationkey",
    )
    return found.withColumn("distance_metric", F.round("distance_metric", 4))


# Names


def normalized_names(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", normalize_name(F.col("text"), "the").alias("norm"))


def station_dictionary(t: Tables) -> DataFrame:
    parts = t.part.select(F.col("p_name").alias("station_name"), F.col("p_partkey").alias("station_eva"))
    return dims.station_dictionary(parts)


def fuzzy_resolve(t: Tables) -> DataFrame:
    """Every part name in a spelling of its own, against the right spellings."""
    messy = t.part.select(
        F.upper(F.translate("p_name", " e", "_3")).alias("name"),
    )
    resolved = names.fuzzy_resolve(messy, station_dictionary(t))
    return resolved.select("name", "match", "eva", F.round("score", 6).alias("score"))


def resolve_station(t: Tables) -> DataFrame:
    """Conversation turns as documents; the role is the station, some turns only have a file name."""
    docs = t.conversations.select(
        "conv_id", "turn",
        F.when(F.col("turn") % 2 == 0, F.col("role")).alias("station"),
        F.concat("role", F.lit("-file")).alias("file_station"),
    )
    roles = t.conversations.groupBy(F.col("role").alias("station_name")).agg(
        F.min("conv_id").alias("station_eva")
    )
    resolved = names.fuzzy_resolve(names.station_names(docs), dims.station_dictionary(roles, {}))
    return names.resolve_station(docs, materialize(resolved, "names")).select("conv_id", "turn", "station_eva")


# Keyed tables


def keep_first(t: Tables) -> DataFrame:
    return merge.keep_first(t.lineitem, LINE_KEY, LINE_ORDER)


def _target_and_new(t: Tables) -> tuple[DataFrame, DataFrame]:
    new = F.col("l_returnflag") == "N"
    return t.lineitem.filter(~new), t.lineitem.filter(new)


def insert_absent(t: Tables) -> DataFrame:
    return merge.insert_absent(*_target_and_new(t), LINE_KEY, LINE_ORDER)


def upsert(t: Tables) -> DataFrame:
    return merge.upsert(*_target_and_new(t), LINE_KEY, LINE_ORDER)


def fold_changes(t: Tables) -> DataFrame:
    minutes = F.make_dt_interval(mins=F.floor("value").cast("int"))
    changes = t.events.select(
        F.col("user_id").alias("stop_id"),
        "event_id",
        F.when(F.col("event_type") == "purchase", F.col("ts") + minutes).alias("new_arrival"),
        F.when(F.col("event_type") == "click", F.col("ts") + minutes).alias("new_departure"),
        ((F.col("event_type") == "error") & (F.col("value") > 100)).alias("cancelled"),
    )
    return merge.fold_changes(changes, order=("event_id",))


def apply_changes(t: Tables) -> DataFrame:
    """Customers as stops; a third lacks a planned arrival, and some are cancelled before."""
    start = F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")
    planned = t.customer.select(
        F.col("c_custkey").alias("stop_id"),
        F.when(F.col("c_nationkey") % 3 != 0, start).alias("planned_arrival"),
        (start + F.expr("INTERVAL 90 SECONDS")).alias("planned_departure"),
        "c_mktsegment",
    )
    stops = with_defaults(planned).withColumn("is_cancelled", F.col("c_mktsegment") == "MACHINERY")
    return merge.apply_changes(stops, fold_changes(t)).drop("c_mktsegment")


def orphans(t: Tables) -> DataFrame:
    customers = t.customer.select("c_custkey", "c_nationkey")
    return merge.orphans(customers, t.events, {"c_custkey": "user_id"})


def date_dim(t: Tables) -> DataFrame:
    ranges = t.orders.groupBy("o_custkey").agg(
        F.to_date(F.min("o_orderdate")).alias("range_start"),
        F.to_date(F.max("o_orderdate")).alias("range_end"),
    )
    return dims.date_dim(ranges)


def profile_dim(t: Tables) -> DataFrame:
    return dims.profile_dim(
        t.part.select(F.col("p_brand").alias("train_number"), F.col("p_type").alias("train_type"))
    )


def profile_dim_next(t: Tables) -> DataFrame:
    """Profiles of two deliveries: ids of the first stay."""
    parts = t.part.select(
        F.col("p_brand").alias("train_number"), F.col("p_type").alias("train_type"), "p_size"
    )
    first = dims.profile_dim(parts.filter(F.col("p_size") > 45))
    return dims.profile_dim(parts, first)


# Graph


def route_edges(t: Tables) -> DataFrame:
    return graph.route_edges(
        t.lineitem, trip="l_orderkey", node="l_partkey", time="l_shipdate",
        ties=("l_linenumber", "l_partkey", "l_suppkey"),
    )


def station_graph(t: Tables) -> DataFrame:
    return graph.undirected(route_edges(t))


def shortest_path(t: Tables) -> DataFrame:
    """From the part with the smallest number to the one with the largest."""
    ends = t.lineitem.agg(F.min("l_partkey").alias("low"), F.max("l_partkey").alias("high")).first()
    found = graph.shortest_path(station_graph(t), ends["low"], ends["high"], both_ways=True)
    return found.select("hops", F.array_join("path", " -> ").alias("path"))


# Layers and feed


def quality_profile(t: Tables) -> DataFrame:
    layer = t.events.select(
        F.to_date("ts").alias("date"), F.when(F.col("event_type") != "error", F.col("ts")).alias("time")
    )
    return quality.rows_per_date(layer, time="time")


def quality_summary(t: Tables) -> DataFrame:
    return quality.summary(quality_profile(t))


def partitioned_roundtrip(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "by-date")
    write_by_date(t.events, "ts", path)
    return read_table(t.spark, path)


def unpivot(t: Tables) -> DataFrame:
    lines = t.lineitem.withColumn("left", F.when(F.col("l_returnflag") != "N", F.col("l_shipdate")))
    return unpivot_events(
        lines,
        ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"],
        {"time": F.col("l_shipdate"), "amount": F.col("l_quantity")},
        {"time": F.col("left"), "amount": F.col("l_extendedprice")},
        present="time",
    )


def parsed_times(t: Tables) -> DataFrame:
    """Order dates as feed text in both field orders, and damaged, read back."""
    day_first = feed_text(F.col("o_orderdate"), "DDMMYY")
    year_first = feed_text(F.col("o_orderdate"))
    return t.orders.select(
        "o_orderkey",
        feed_time(year_first).alias("year_first"),
        feed_time(day_first, "DDMMYY").alias("day_first"),
        feed_time(day_first).alias("misread"),
        feed_time(F.left(year_first, F.lit(8))).alias("cut_off"),
    )


def _raw(t: Tables, kind: str) -> DataFrame:
    return read_archives(t.spark, f"{table_feed(t.spark, t.folder, parts=(kind,))}/{kind}")


def _docs(t: Tables, kind: str) -> DataFrame:
    return parse_documents(_raw(t, kind))


def archive_members(t: Tables) -> DataFrame:
    members = path_metadata(_raw(t, "timetables"))
    return members.select(
        "archive", "seq", "member", "range_start", "range_end", "snapshot_date", "file_station",
        F.regexp_count("xml", F.lit("<s ")).alias("n_stops"),
    )


def planned_stop_rows(t: Tables) -> DataFrame:
    return planned_stops(_docs(t, "timetables")).select(
        "stop_id", "train_type", "train_number", "train_line", "date_id",
        "planned_arrival", "planned_departure", "station",
    )


def stop_change_rows(t: Tables) -> DataFrame:
    return stop_changes(_docs(t, "timetable_changes")).select(
        "stop_id", "new_arrival", "new_departure", "cancelled"
    )


def planned_event_rows(t: Tables) -> DataFrame:
    return planned_events(_docs(t, "timetables"))


def changed_event_rows(t: Tables) -> DataFrame:
    return changed_events(_docs(t, "timetable_changes"))


def station_dim(t: Tables) -> DataFrame:
    listed = read_stations(t.spark, f"{table_feed(t.spark, t.folder, parts=('stations',))}/stations")
    found = dims.station_dim(listed)
    return found.withColumns({c: F.col(c).cast("double") for c in ("latitude", "longitude")})


_SNAPSHOTS: dict[tuple, str] = {}
# Archives whose names have a month of an even, and of an odd number.
EVEN_MONTHS, ODD_MONTHS = "part*_??[01][02468]??_*", "part*_??[01][13579]??_*"


def _built(t: Tables, kind: str, build: Callable[[str], None]) -> str:
    """The folder that a run of the ingest job wrote; it runs once per session for the same tables."""
    known = (*tables_version(t.spark, t.folder), kind)
    if known not in _SNAPSHOTS:
        out = scratch_dir(t.spark, kind)
        build(out)
        _SNAPSHOTS[known] = out
    return _SNAPSHOTS[known]


def _snapshot(t: Tables, name: str, faults: bool = False, schema: T.StructType | None = None) -> DataFrame:
    """A table of the star schema built from the whole feed."""

    def build(out: str) -> None:
        feed = table_feed(t.spark, t.folder, faults)
        run_ingest(t.spark, f"{feed}/stations", f"{feed}/timetables", f"{feed}/timetable_changes", out)

    return read_table(t.spark, f"{_built(t, f'snapshot-{faults}', build)}/{name}", schema)


def _two_deliveries(t: Tables, name: str) -> DataFrame:
    """A table of the store that two deliveries left: the later months of each pair of months first, and changes before their plans."""

    def build(out: str) -> None:
        feed = table_feed(t.spark, t.folder)

        def deliver(number: int, months: str, changed: str, **more: str) -> None:
            run_ingest(
                t.spark, f"{feed}/stations", f"{feed}/timetables/{months}", f"{feed}/timetable_changes/{changed}",
                f"{out}/deliveries/{number}", store=f"{out}/store", **more,
            )

        deliver(1, EVEN_MONTHS, ODD_MONTHS)
        deliver(2, ODD_MONTHS, EVEN_MONTHS, previous=f"{out}/deliveries/1")

    return read_table(t.spark, f"{_built(t, 'deliveries', build)}/{name}")


def ingest_facts(t: Tables) -> DataFrame:
    return _snapshot(t, "fact_train_stops").select(*FACT_COLUMNS)


def ingest_cancelled(t: Tables) -> DataFrame:
    """Cancelled stops of a day and hour, from the facts of that day only."""
    return delays.count_cancelled(_snapshot(t, "fact_train_stops"), "2006-03-01", 4)


def ingest_reports(t: Tables) -> DataFrame:
    """Rows of each report of the ingest job on a feed that has a share of each fault."""
    counts = [
        _snapshot(t, name, faults=True).agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("report"), "n_rows")
        for name in sorted(REPORTS)
    ]
    return reduce(DataFrame.union, counts)


def ingest_two_deliveries(t: Tables) -> DataFrame:
    """The facts after two deliveries in the wrong order: those of the whole feed. Profile numbers follow the order, so pairs are shown."""
    profiles = _two_deliveries(t, "deliveries/2/dim_train_profiles")
    facts = _two_deliveries(t, "store/fact_train_stops").join(profiles, "profile_id")
    return facts.select("train_number", "train_type", *[c for c in FACT_COLUMNS if c != "profile_id"])


def _network(t: Tables) -> DataFrame:
    def build(out: str) -> None:
        network.add_days(_snapshot(t, "planned_events", schema=layer_schema("planned")), out)

    return network.network(t.spark, _built(t, "network", build))


def station_network(t: Tables) -> DataFrame:
    """Stations that follow each other in the trips of the planned layer, and how often."""
    return _network(t)


def station_path(t: Tables) -> DataFrame:
    """The path through the rare ways of the network, those taken no more often than the mean, from the first station to the last."""
    ways = materialize(_network(t), "ways")
    mean, low, high = ways.agg(F.avg("times"), F.min("src"), F.max("src")).first()
    rare = graph.undirected(ways.filter((F.col("times") <= mean) & (F.col("src") != F.col("dst"))))
    found = graph.shortest_path(rare, low, high, both_ways=True)
    return found.select("hops", F.array_join("path", " -> ").alias("path"))


def ingest_days(t: Tables) -> DataFrame:
    return _snapshot(t, "dim_time")


def ingest_profiles(t: Tables) -> DataFrame:
    return _snapshot(t, "dim_train_profiles")


def ingest_daily_delay(t: Tables) -> DataFrame:
    """Mean daily delay of one station, on the event layers of the ingest job."""
    planned, changed = (
        _snapshot(t, f"{kind}_events", schema=layer_schema(kind)) for kind in ("planned", "changed")
    )
    daily = delays.daily_delay(planned, changed, "Berlin NATION_8", same_day=False)
    return daily.select("date", F.round("avg_delay", 6).alias("avg_delay"))


QUERIES: dict[str, Callable[[Tables], DataFrame]] = {
    "overall_delay": overall_delay,
    "daily_delay": daily_delay,
    "same_day_delay": same_day_delay,
    "mean_delay": mean_delay,
    "count_cancelled": count_cancelled,
    "peak_departures": peak_departures,
    "station_lookup": station_lookup,
    "nearest": nearest,
    "nearest_batch": nearest_batch,
    "normalize_name": normalized_names,
    "station_dictionary": station_dictionary,
    "fuzzy_resolve": fuzzy_resolve,
    "resolve_station": resolve_station,
    "keep_first": keep_first,
    "insert_absent": insert_absent,
    "upsert": upsert,
    "fold_changes": fold_changes,
    "apply_changes": apply_changes,
    "orphans": orphans,
    "date_dim": date_dim,
    "profile_dim": profile_dim,
    "profile_dim_next": profile_dim_next,
    "route_edges": route_edges,
    "station_graph": station_graph,
    "shortest_path": shortest_path,
    "quality_profile": quality_profile,
    "quality_summary": quality_summary,
    "partitioned_roundtrip": partitioned_roundtrip,
    "unpivot_events": unpivot,
    "feed_time": parsed_times,
    "archive_members": archive_members,
    "planned_stops": planned_stop_rows,
    "stop_changes": stop_change_rows,
    "planned_events": planned_event_rows,
    "changed_events": changed_event_rows,
    "station_dim": station_dim,
    "ingest_facts": ingest_facts,
    "ingest_cancelled": ingest_cancelled,
    "ingest_reports": ingest_reports,
    "ingest_two_deliveries": ingest_two_deliveries,
    "station_network": station_network,
    "station_path": station_path,
    "ingest_days": ingest_days,
    "ingest_profiles": ingest_profiles,
    "ingest_daily_delay": ingest_daily_delay,
}
