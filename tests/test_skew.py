"""One key with a third of all rows: results stay whole and no pairs are built."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from stoplines.operators import delays, graph, merge

ROWS = 600_000


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows has key 0; times spread over one day."""
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id"))
    start = F.lit("2025-09-02 00:00:00").cast("timestamp_ntz")
    return spark.range(ROWS).select(
        key.alias("sid"),
        (start + F.make_dt_interval(mins=(F.col("id") % 1440).cast("int"))).alias("time"),
        F.lit(date(2025, 9, 2)).alias("date"),
        "id",
    )


def test_delay_of_a_hot_key(hot):
    planned = hot.withColumnRenamed("time", "planned_time")
    changed = hot.select(
        "sid", "date", (F.col("time") + F.expr("INTERVAL 0 MINUTES")).alias("changed_time"),
        F.lit("p").alias("cancellation_status"),
    )
    # 200,000 x 200,000 pairs of the hot key, whose differences cancel out, and 400,000 zeros
    daily = delays.daily_delay(planned, changed, keys=("sid",)).collect()
    assert [tuple(r) for r in daily] == [(date(2025, 9, 2), 0.0)]
    later = changed.withColumn(
        "changed_time", F.col("changed_time") + F.make_dt_interval(mins=F.when(F.col("sid") == 0, 9).otherwise(0))
    )
    hot_pairs, others = (ROWS // 3) ** 2, ROWS - ROWS // 3
    (row,) = delays.daily_delay(planned, later, keys=("sid",), same_day=False).collect()
    assert row.avg_delay == pytest.approx(9 * hot_pairs / (hot_pairs + others))


def test_keep_first_of_a_hot_key(hot):
    first = merge.keep_first(hot, ["sid"], ["id"])
    assert first.count() == ROWS - ROWS // 3 + 1
    assert first.filter("sid = 0").first().id == 0


def test_edges_of_a_hot_trip(spark, hot):
    stops = hot.select(
        F.col("sid").alias("trip"), F.col("time").alias("planned_time"),
        (F.hour("time") % 7).cast("string").alias("node"),
        F.lit("arrival").alias("event_type"), (F.col("id") % 100).cast("string").alias("sid"),
    )
    edges = graph.route_edges(stops.filter("trip = 0"))
    found = {(r.src, r.dst) for r in edges.collect()}
    # hour after hour, each hour following itself
    assert found == {(str(h % 7), str(h % 7)) for h in range(24)} | {
        (str(h % 7), str((h + 1) % 7)) for h in range(23)
    }


def test_a_trip_without_times_is_spread(spark, hot):
    """One trip of NULL times, and one with a row in each of very many moments, over several ranges of rows."""
    stops = hot.select(
        F.when(F.col("id") % 2 == 0, "untimed").otherwise("long").alias("trip"),
        F.when(F.col("id") % 2 == 1, F.lit("2025-09-02 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("id").cast("int")))
        .alias("planned_time"),
        (F.col("id") % 7).cast("string").alias("node"), F.lit("arrival").alias("event_type"),
        F.lpad(F.col("id").cast("string"), 8, "0").alias("sid"),
    )
    stored = []
    original = graph.materialize
    graph.materialize = lambda df, label: stored.append(original(df, label)) or stored[-1]
    try:
        edges = graph.consecutive_stops(stops, ranges=8)
    finally:
        graph.materialize = original
    sizes = {(r._trip, r._range): r["count"] for r in stored[0].groupBy("_trip", "_range").count().collect()}
    for trip in ("untimed", "long"):
        own = [n for (name, _), n in sizes.items() if name == trip]
        assert len(own) >= 4 and max(own) < ROWS / 4 and sum(own) == ROWS // 2
    assert edges.agg(F.sum("times")).first()[0] == ROWS - 2
    # every second id: the node two further on, in both trips
    assert {(r.src, r.dst) for r in edges.select("src", "dst").distinct().collect()} == {(str(n), str((n + 2) % 7)) for n in range(7)}


def test_hot_keys_are_split_where_nothing_is_broadcast(spark, hot):
    """The skew join finds the hot side of the anti-joins in front of it."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "300KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200KB",
    }
    rows = hot.select("sid", "id", (F.col("id") * 7).alias("x"))
    few = spark.range(1, 5).select(F.col("id").alias("sid"), F.col("id"), F.lit(1).cast("long").alias("x"))
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        for result, expected in (
            (merge.orphans(rows, few, "sid"), ROWS - 3),
            (merge.upsert(rows, few, ["sid"], ["id"]), ROWS + 1),
        ):
            # ids 1, 2 and 4 are keys of their own
            assert result.count() == expected
            result.collect()
            assert "skew=true" in result._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in settings:
            spark.conf.unset(name)
