"""Keyed operators: the result does not depend on the order of the input rows."""

import random
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from stoplines.operators.dims import dense_number, profile_dim
from stoplines.operators.merge import (
    apply_changes,
    fold_changes,
    fold_with_positions,
    insert_absent,
    keep_first,
    keep_last,
    merge_facts,
    orphans,
    upsert,
)

SLOW = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
BASE = datetime(2025, 9, 2)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@SLOW
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 20)), min_size=1, max_size=30, unique=True))
def test_keep_first_and_last(spark, pairs):
    df = spark.createDataFrame(random.sample(pairs, len(pairs)), "k int, o int")
    keys = {k for k, _ in pairs}
    assert rows(keep_first(df, ["k"], ["o"])) == sorted((k, min(o for q, o in pairs if q == k)) for k in keys)
    assert rows(keep_last(df, ["k"], ["o"])) == sorted((k, max(o for q, o in pairs if q == k)) for k in keys)


def test_insert_absent_and_upsert(spark):
    target = spark.createDataFrame([(1, "old", 0), (2, "old", 0)], "k int, v string, o int")
    new = spark.createDataFrame([(2, "b", 2), (2, "a", 1), (3, "d", 2), (3, "c", 1)], "k int, v string, o int")
    assert rows(insert_absent(target, new, ["k"], ["o"])) == [(1, "old", 0), (2, "old", 0), (3, "c", 1)]
    assert rows(upsert(target, new, ["k"], ["o"])) == [(1, "old", 0), (2, "b", 2), (3, "d", 2)]


change = st.tuples(
    st.sampled_from("xyz"), st.none() | st.integers(0, 90), st.none() | st.integers(0, 90), st.booleans()
)


@SLOW
@given(st.lists(change, min_size=1, max_size=25))
def test_fold_equals_updates_in_order(spark, changes):
    def moment(minutes):
        return None if minutes is None else BASE + timedelta(minutes=minutes)

    data = [
        ("arch%d" % (i // 10), i // 3, i % 3, k, moment(a), moment(d), c)
        for i, (k, a, d, c) in enumerate(changes)
    ]
    schema = (
        "archive string, seq long, pos int, stop_id string, "
        "new_arrival timestamp_ntz, new_departure timestamp_ntz, cancelled boolean"
    )
    expected = {}
    for _, _, _, k, a, d, c in data:
        old = expected.get(k, (None, None, False))
        expected[k] = (a or old[0], d or old[1], c or old[2])
    folded = fold_changes(spark.createDataFrame(random.sample(data, len(data)), schema))
    assert rows(folded) == sorted(((k, *v) for k, v in expected.items()), key=repr)


@pytest.mark.parametrize(
    ("planned", "new", "old", "expected"),
    [
        (BASE, BASE + timedelta(minutes=7), 0, 7),
        (BASE, BASE - timedelta(minutes=5), 0, -5),
        (None, BASE, 3, None),
        (BASE, None, 3, 3),
        (BASE, BASE + timedelta(seconds=150), 0, 3),
        (BASE, BASE - timedelta(seconds=150), 0, -3),
    ],
)
def test_delay_rules(spark, planned, new, old, expected):
    stops = spark.createDataFrame(
        [("a", planned, None, None, None, old, 0, False)],
        "stop_id string, planned_arrival timestamp_ntz, actual_arrival timestamp_ntz, "
        "planned_departure timestamp_ntz, actual_departure timestamp_ntz, "
        "arrival_delay_minutes int, departure_delay_minutes int, is_cancelled boolean",
    )
    folded = spark.createDataFrame(
        [("a", new, None, False), ("unknown", BASE, BASE, True)],
        "stop_id string, new_arrival timestamp_ntz, new_departure timestamp_ntz, cancelled boolean",
    )
    (row,) = apply_changes(stops, folded).collect()
    assert (row.arrival_delay_minutes, row.actual_arrival, row.is_cancelled) == (expected, new, False)


def test_orphans_skip_missing_keys(spark):
    fact = spark.createDataFrame([(1,), (2,), (None,)], "f int")
    dim = spark.createDataFrame([(1,)], "d int")
    assert rows(orphans(fact, dim, {"f": "d"})) == [(2,)]


@pytest.mark.parametrize("count", [0, 1, 3, 500])
def test_dense_number_is_dense_and_ordered(spark, count):
    values = [(f"{i:04d}",) for i in range(count)]
    df = spark.createDataFrame(random.sample(values, count), "v string").repartition(7)
    numbered = dense_number(df, ["v"], "n", 11).select("v", "n")
    assert rows(numbered) == [(f"{i:04d}", 11 + i) for i in range(count)]


def test_profiles_keep_their_ids(spark):
    existing = spark.createDataFrame([(7, "2", "S"), (3, None, "X")], "profile_id int, train_number string, train_type string")
    stops = spark.createDataFrame(
        [("2", "S"), ("1", None), ("1", None), (None, "X"), (None, None)], "train_number string, train_type string"
    )
    assert rows(profile_dim(stops, existing)) == sorted(
        [(3, None, "X"), (7, "2", "S"), (8, None, None), (9, "1", None)], key=repr
    )


def stop_changes(spark, n=3000):
    """Changes of some stops, one of them with a third of all, and times that are not known."""
    time = F.when(F.col("id") % 3 != 1, F.lit(BASE).cast("timestamp_ntz") + F.make_dt_interval(mins=(F.col("id") * 37 % 500).cast("int")))
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).cast("string").alias("stop_id"), time.alias("new_arrival"),
        F.when(F.col("id") % 7 == 0, time).alias("new_departure"), (F.col("id") % 11 == 0).alias("cancelled"),
        (F.col("id") * 7919 % n).cast("decimal(38,0)").alias("position"),
    )


def test_folding_is_dealt_to_its_end(spark):
    changes = stop_changes(spark)
    folded = fold_with_positions(changes, tasks=9)
    assert rows(folded) == rows(fold_with_positions(changes))
    # Adaptive execution, which goes by bytes, doesn't put the tasks together again.
    assert folded.rdd.getNumPartitions() == 9


def test_facts_are_merged_in_as_many_tasks_as_told(spark):
    plan = (
        "stop_id string, station_eva long, profile_id int, date_id date, train_line string, planned_arrival timestamp_ntz, "
        "planned_departure timestamp_ntz, planned_from struct<archive:string,seq:bigint,pos:int>"
    )
    time = "struct<archive:string,seq:bigint,pos:int,time:timestamp_ntz>"
    def plans(archive, keys):
        return spark.createDataFrame([(str(k), k, 1, None, "1", BASE, BASE, (archive, k, 0)) for k in keys], plan)
    def changes(archive, keys):
        late = BASE + timedelta(minutes=len(archive))
        return spark.createDataFrame(
            [(str(k), (archive, k, 0, late), None, k % 3 == 0) for k in keys], f"stop_id string, arrival {time}, departure {time}, cancelled boolean"
        )
    first = merge_facts(None, plans("a", range(40)), changes("b", range(0, 60, 2)))
    second = plans("c", range(20, 80)), changes("aa", range(0, 90, 3))
    merged = merge_facts(first, *second, tasks=9)
    assert rows(merged) == rows(merge_facts(first, *second)) and merged.rdd.getNumPartitions() == 9
