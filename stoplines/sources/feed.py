"""Feed documents: parsing, and the flat rows derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stoplines.functions.text import non_empty
from stoplines.functions.times import feed_time
from stoplines.sources.archives import path_metadata

CORRUPT = "_corrupt_record"

_EVENT = (
    "STRUCT<_l STRING, _pt STRING, _ct STRING, _cs STRING, _clt STRING, "
    "_pp STRING, _ppth STRING, _cpth STRING>"
)
DOCUMENT_XML = (
    "_station STRING, "
    "s ARRAY<STRUCT<_id STRING, tl STRUCT<_c STRING, _n STRING, _o STRING>, "
    f"ar {_EVENT}, dp {_EVENT}>>, "
    f"{CORRUPT} STRING"
)

# Status of a cancelled event and the names of the two event kinds.
CANCELLED = "c"
EVENT_KINDS = {"ar": "arrival", "dp": "departure"}

PLANNED_EVENT_SCHEMA = T.StructType([
    T.StructField("sid", T.StringType()),
    T.StructField("station", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("number", T.StringType()),
    T.StructField("owner", T.StringType()),
    T.StructField("line", T.StringType()),
    T.StructField("planned_time", T.TimestampNTZType()),
    T.StructField("planned_platform", T.StringType()),
    T.StructField("planned_path", T.StringType()),
])
CHANGED_EVENT_SCHEMA = T.StructType([
    T.StructField("sid", T.StringType()),
    T.StructField("station", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("line", T.StringType()),
    T.StructField("changed_time", T.TimestampNTZType()),
    T.StructField("cancellation_time", T.TimestampNTZType()),
    T.StructField("cancellation_status", T.StringType()),
    T.StructField("planned_platform", T.StringType()),
    T.StructField("changed_path", T.StringType()),
])


def layer_schema(kind: str) -> T.StructType:
    """The columns of the stored layer of planned or changed events."""
    events = {"planned": PLANNED_EVENT_SCHEMA, "changed": CHANGED_EVENT_SCHEMA}[kind]
    return T.StructType([*events.fields, T.StructField("date", T.DateType())])


def parse_documents(raw: DataFrame) -> DataFrame:
    """One row per document: path metadata, station, array of stops, and what is wrong with it.

    Unreadable XML gives NULL stops and its text in `corrupt`; other documents are unaffected.
    """
    options = {
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT,
        "ignoreSurroundingSpaces": "false",
    }
    parsed = path_metadata(raw).withColumn("doc", F.from_xml("xml", DOCUMENT_XML, options))
    return parsed.select(
        "archive",
        "seq",
        "member",
        "range_start",
        "range_end",
        "snapshot_date",
        "file_station",
        F.col("doc._station").alias("station"),
        F.col("doc.s").alias("stops"),
        F.coalesce(F.col(f"doc.{CORRUPT}"), F.col("error")).alias("corrupt"),
    )


def corrupt_documents(docs: DataFrame) -> DataFrame:
    return docs.filter(F.col("corrupt").isNotNull()).select("archive", "seq", "member", "corrupt")


def stop_by_stop(docs: DataFrame) -> DataFrame:
    """Parsed documents with one row per stop, `pos` and `s` in place of `stops`; one row with neither if a document has no stop.

    In this form documents are stored: Spark reads Parquet some thousand rows at a time, whatever their length, so that
    rows with all stops of a document would take memory by the number of documents in a file.
    """
    # For a plain posexplode the planner adds filters on the array and moves them below the
    # parsing, which would then run once more per filter.
    return docs.select(*[c for c in docs.columns if c != "stops"], F.posexplode_outer("stops").alias("pos", "s"))


def one_per_document(rows: DataFrame) -> DataFrame:
    """The rows of `stop_by_stop` with what is known of each document, without its stops."""
    return rows.filter(F.coalesce("pos", F.lit(0)) == 0).drop("pos", "s")


def _each_stop(docs: DataFrame, *columns: str) -> DataFrame:
    """`columns`, `pos` and `s` of every stop of documents, in either form."""
    rows = stop_by_stop(docs.select(*columns, "stops")) if "stops" in docs.columns else docs.select(*columns, "pos", "s")
    return rows.filter(F.col("s").isNotNull())


def planned_stops(docs: DataFrame) -> DataFrame:
    """One row per planned stop. A stop without a trip label has NULL type and number."""
    known = [c for c in docs.columns if c == "station_eva"]
    stops = _each_stop(docs, "archive", "seq", "snapshot_date", "station", "file_station", *known)
    return stops.select(
        F.col("s._id").alias("stop_id"),
        F.col("s.tl._c").alias("train_type"),
        F.col("s.tl._n").alias("train_number"),
        F.coalesce(non_empty(F.col("s.ar._l")), non_empty(F.col("s.dp._l"))).alias("train_line"),
        F.col("snapshot_date").alias("date_id"),
        feed_time(F.col("s.ar._pt")).alias("planned_arrival"),
        feed_time(F.col("s.dp._pt")).alias("planned_departure"),
        *[c for c in stops.columns if c not in ("s", "snapshot_date")],
    )


def stop_changes(docs: DataFrame) -> DataFrame:
    """One row per changed stop that has a new time or a cancellation."""
    stops = _each_stop(docs, "archive", "seq")

    def flagged(kind: str) -> Column:
        return F.coalesce(F.col(f"s.{kind}._cs") == CANCELLED, F.lit(False))

    rows = stops.select(
        F.col("s._id").alias("stop_id"),
        feed_time(F.col("s.ar._ct")).alias("new_arrival"),
        feed_time(F.col("s.dp._ct")).alias("new_departure"),
        (flagged("ar") | flagged("dp")).alias("cancelled"),
        "archive",
        "seq",
        "pos",
    )
    return rows.filter(
        F.col("new_arrival").isNotNull() | F.col("new_departure").isNotNull() | F.col("cancelled")
    )


def unpivot_events(df: DataFrame, keep: list, arrival: dict, departure: dict, present: str) -> DataFrame:
    """Turn each row into its arrival row and its departure row.

    `arrival` and `departure` map the same output names to columns; a side is left out
    where its `present` column is NULL.
    """
    sides = F.array(*[
        F.struct(F.lit(kind).alias("event_type"), *[c.alias(n) for n, c in side.items()])
        for kind, side in zip(EVENT_KINDS.values(), (arrival, departure), strict=True)
    ])
    rows = df.select(*keep, F.inline(sides))
    return rows.filter(F.col(present).isNotNull())


def _events(docs: DataFrame, keep: list, fields) -> DataFrame:
    stops = _each_stop(docs, "station")
    sides = [
        {"present": F.when(F.col(f"s.{kind}").isNotNull(), True), **fields(f"s.{kind}")}
        for kind in EVENT_KINDS
    ]
    return unpivot_events(stops, keep, *sides, present="present")


def planned_events(docs: DataFrame) -> DataFrame:
    """Zero to two rows per planned stop: its arrival, then its departure."""
    label = [
        F.coalesce(F.col(f"s.tl.{tag}"), F.lit("")).alias(name)
        for tag, name in (("_c", "category"), ("_n", "number"), ("_o", "owner"))
    ]
    rows = _events(
        docs,
        [F.col("s._id").alias("sid"), "station", *label],
        lambda e: {
            "line": F.col(f"{e}._l"),
            "planned_time": feed_time(F.col(f"{e}._pt")),
            "planned_platform": F.col(f"{e}._pp"),
            "planned_path": F.col(f"{e}._ppth"),
        },
    )
    return rows.select(*PLANNED_EVENT_SCHEMA.fieldNames())


def changed_events(docs: DataFrame) -> DataFrame:
    """Zero to two rows per changed stop; absent texts are empty."""

    def text(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(""))

    rows = _events(
        docs,
        [F.col("s._id").alias("sid"), "station"],
        lambda e: {
            "line": text(f"{e}._l"),
            "changed_time": feed_time(F.col(f"{e}._ct")),
            "cancellation_time": feed_time(F.col(f"{e}._clt")),
            "cancellation_status": text(f"{e}._cs"),
            "planned_platform": text(f"{e}._pp"),
            "changed_path": text(f"{e}._cpth"),
        },
    )
    return rows.select(*CHANGED_EVENT_SCHEMA.fieldNames())
