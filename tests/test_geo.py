"""The nearest point of many queries against a plain scan of all points."""

import random

import pytest

from stoplines.operators import geo

POINTS = "station_eva long, latitude double, longitude double"
QUERIES = "q long, latitude double, longitude double"


def scan(queries, points):
    known = [(lat, lon, key) for key, lat, lon in points if lat is not None and lon is not None]
    best = {}
    for q, y, x in queries:
        distances = [((y - a) * (y - a) + (x - b) * (x - b), k) for a, b, k in known] if y is not None else []
        best[q] = min(distances)[1] if distances else None
    return best


@pytest.mark.parametrize("fanout", [2, 5, 256])
@pytest.mark.parametrize("spread", [0.001, 1.0, 100.0])
def test_nearest_batch(spark, monkeypatch, fanout, spread):
    monkeypatch.setattr(geo, "FANOUT", fanout)
    rng = random.Random(fanout)
    # a third of the points in one spot, another group on a line, the rest anywhere
    points = [(i, 52.5, 13.4) for i in range(20)]
    points += [(20 + i, 52.5 + spread * rng.random(), 13.0) for i in range(20)]
    points += [(40 + i, 52 + spread * rng.random(), 13 + spread * rng.gauss(0, 1)) for i in range(20)]
    points += [(98, None, 13.0), (99, 52.0, None)]
    queries = [(i, 52 + spread * rng.random(), 13 + spread * rng.gauss(0, 1)) for i in range(40)]
    queries += [(40 + i, 52.5, 13.4) for i in range(20)] + [(60, None, 1.0)]
    rng.shuffle(points)
    found = geo.nearest_batch(
        spark.createDataFrame(queries, QUERIES), spark.createDataFrame(points, POINTS), "q"
    ).collect()
    assert {r.q: r.station_eva for r in found} == scan(queries, points)
    assert len(found) == len(queries)


def test_points_are_measured_row_by_row(spark):
    """Functions of arrays are interpreted entry by entry: the points of a tile are no longer measured by them."""
    points = spark.createDataFrame([(i, 52 + i / 7, 13.0) for i in range(200)], POINTS)
    found = geo.nearest_batch(spark.createDataFrame([(1, 53.0, 2.0), (None, 60.0, 2.0), (2, 70.0, 1.0)], QUERIES), points, "q")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "lambdafunction" not in plan and "Generate explode(entries" in plan
    assert {r.q: r.station_eva for r in found.collect()} == {1: 7, None: 56, 2: 126}


def test_equally_near_points(spark):
    """Four points at the same distance of all queries: the smallest key, whatever its tile."""
    points = spark.createDataFrame([(9, 1.0, 0.0), (4, -1.0, 0.0), (7, 0.0, 1.0), (5, 0.0, -1.0)], POINTS)
    queries = spark.createDataFrame([(q, 0.0, 0.0) for q in range(3)], QUERIES)
    assert {tuple(r) for r in geo.nearest_batch(queries, points, "q").collect()} == {(q, 4, 1.0) for q in range(3)}


def test_no_points(spark):
    found = geo.nearest_batch(
        spark.createDataFrame([(1, 1.0, 2.0)], QUERIES), spark.createDataFrame([], POINTS), "q"
    ).collect()
    assert [tuple(r) for r in found] == [(1, None, None)]


def test_nearest_skips_unknown_and_breaks_ties(spark):
    points = spark.createDataFrame([(5, 1.0, 1.0), (3, -1.0, 1.0), (1, None, 1.0), (2, 0.0, None)], POINTS)
    assert geo.nearest(points, 0.0, 1.0).first().station_eva == 3
    assert geo.nearest(points.limit(0), 0.0, 1.0).count() == 0
