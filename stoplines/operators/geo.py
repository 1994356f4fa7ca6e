"""Nearest station, by squared distance in degrees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stoplines.operators.dims import dense_number
from stoplines.storage import materialize

# Points per tile, and tiles per tile of the next level.
FANOUT = 64
# Bits per axis of the order in which points are put into tiles.
ORDER_BITS = 16

_BOX = ("south", "north", "west", "east")


def _square(x: Column) -> Column:
    return x * x


def nearest(
    points: DataFrame,
    latitude: float,
    longitude: float,
    key: str = "station_eva",
    lat: str = "latitude",
    lon: str = "longitude",
) -> DataFrame:
    """The point with the smallest squared distance; ties by key, no row if there is none."""
    distance = _square(F.col(lat).cast("double") - latitude) + _square(
        F.col(lon).cast("double") - longitude
    )
    known = points.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull())
    return (
        known.withColumn("distance_metric", distance)
        .orderBy(F.col("distance_metric").asc_nulls_last(), key)
        .limit(1)
    )


def _interleave(x: Column, y: Column) -> Column:
    """The bits of x and y in turn: cells close in this order are close in the plane."""
    code = F.lit(0).cast("bigint")
    for bit in range(ORDER_BITS):
        for offset, axis in enumerate((x, y)):
            taken = F.shiftright(axis, bit).bitwiseAND(F.lit(1))
            code = code.bitwiseOR(F.shiftleft(taken, 2 * bit + offset))
    return code


def _located(df: DataFrame, key: str, lat: str, lon: str) -> DataFrame:
    located = df.select(
        F.col(key).alias("key"),
        F.col(lat).cast("double").alias("lat"),
        F.col(lon).cast("double").alias("lon"),
    )
    return located.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull())


def _grouped(rows: DataFrame, position: str, box: dict[str, Column], entry: Column) -> DataFrame:
    node = F.floor(F.col(position) / FANOUT).alias("_node")
    tiles = rows.groupBy(node).agg(
        *[c.alias(name) for name, c in box.items()], F.collect_list(entry).alias("entries")
    )
    return materialize(tiles.withColumnRenamed("_node", "node"), "tiles")


def _tiles(points: DataFrame) -> list[DataFrame]:
    """Tables (node, box, entries): tiles of points, tiles of tiles, and so on up to a single one.

    Points of the same place count once. They are numbered in interleaved order and cut by
    number, so a tile has at most FANOUT entries however dense the points lie. Without any
    point there are no tables.
    """
    limits = points.agg(
        F.min("lat").alias("south"), F.max("lat").alias("north"),
        F.min("lon").alias("west"), F.max("lon").alias("east"),
    ).first()
    if limits["south"] is None:
        return []
    # Both axes have the same scale, so tiles are compact in the distance that counts.
    span = max(limits["north"] - limits["south"], limits["east"] - limits["west"])

    def cell(value: str, low: float) -> Column:
        return F.floor((F.col(value) - low) / span * ((1 << ORDER_BITS) - 1))

    code = _interleave(cell("lat", limits["south"]), cell("lon", limits["west"])) if span else F.lit(0)
    places = points.groupBy("lat", "lon").agg(F.min("key").alias("key")).withColumn("code", code)
    numbered = dense_number(places, ["code", "lat", "lon"], "place", 0)
    levels = [
        _grouped(
            numbered,
            "place",
            {"south": F.min("lat"), "north": F.max("lat"), "west": F.min("lon"), "east": F.max("lon")},
            F.struct("lat", "lon", "key"),
        )
    ]
    while levels[-1].count() > 1:
        levels.append(
            _grouped(
                levels[-1],
                "node",
                {name: (F.min if name in ("south", "west") else F.max)(name) for name in _BOX},
                F.struct("node", *_BOX),
            )
        )
    return levels


def _outside(value: Column, low: Column, high: Column) -> Column:
    """How far a value is outside of an interval."""
    return F.greatest(low - value, value - high, F.lit(0.0))


def _across(value: Column, low: Column, high: Column) -> Column:
    """Squared distance of a value to the far end of an interval."""
    return F.greatest(_square(value - low), _square(high - value))


def nearest_batch(
    queries: DataFrame,
    points: DataFrame,
    query_key: str,
    key: str = "station_eva",
    lat: str = "latitude",
    lon: str = "longitude",
    query_lat: str = "latitude",
    query_lon: str = "longitude",
) -> DataFrame:
    """(query_key, key, distance_metric) The nearest point of every query; NULL if there is none.

    The points form a tree of tiles. Queries go down level by level, an equi-join on the tile
    number each. At every level a query keeps the tiles that can hold its nearest point: those
    not farther away than the far side of the best tile. A row that is joined, shuffled or stored is a
    (query, tile) pair, never a (query, point) pair, and the tiles of a level are unique, so a place that many
    queries share is split by the skew join or meets a broadcast level.
    """
    tiles = _tiles(_located(points, key, lat, lon))
    id_type = points.schema[key].dataType
    nothing = F.lit(None).cast(id_type).alias(key), F.lit(None).cast("double").alias("distance_metric")
    if not tiles:
        return queries.select(query_key, *nothing)
    todo = _located(queries, query_key, query_lat, query_lon).select(
        F.col("key").alias("query"), "lat", "lon",
        # all start at tile 0; as a plain constant it would make the first join a cross join
        F.when(F.col("lat").isNotNull(), F.lit(0)).cast("bigint").alias("node"),
        F.lit(float("inf")).alias("bound"),
    )
    # Spread by query before the costly part.
    spread = int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    todo = todo.repartition(spread, "query")
    y, x = F.col("lat"), F.col("lon")

    # Functions of arrays are interpreted entry by entry, so only the bound is taken that way; all else is done on
    # rows, one per entry, that exist within a task only.
    def far(tile: Column) -> Column:
        return _across(y, tile["south"], tile["north"]) + _across(x, tile["west"], tile["east"])

    for level in reversed(tiles[1:]):
        met = todo.join(level.select("node", "entries"), "node")
        bounded = met.withColumn("bound", F.least("bound", F.array_min(F.transform("entries", far))))
        tile = F.col("tile")
        near = _square(_outside(y, tile["south"], tile["north"])) + _square(_outside(x, tile["west"], tile["east"]))
        entries = bounded.select("query", "lat", "lon", "bound", F.explode("entries").alias("tile"))
        todo = entries.filter(near <= F.col("bound")).select("query", "lat", "lon", "bound", tile["node"].alias("node"))
    # Stored, since it is read twice: for the least distance of each query, a number that is
    # aggregated by hashing, and for the points that lie at this distance.
    visits = materialize(todo.select("query", "lat", "lon", "node"), "visits")

    def measured(rows: DataFrame, *keep: str) -> DataFrame:
        met = rows.join(tiles[0].select("node", "entries"), "node")
        points = met.select("query", "lat", "lon", *keep, F.explode("entries").alias("p"))
        distance = _square(y - F.col("p.lat")) + _square(x - F.col("p.lon"))
        return points.select("query", *keep, distance.alias("distance"), F.col("p.key").alias("key"))

    least = measured(visits).groupBy(F.col("query").alias("_query")).agg(F.min("distance").alias("least"))
    known = visits.join(least, F.col("query").eqNullSafe(F.col("_query")))
    best = (
        measured(known, "least")
        .filter(F.col("distance") == F.col("least"))
        .groupBy("query")
        .agg(F.min(F.struct("distance", "key")).alias("closest"))
    )
    found = best.select(
        F.col("query").alias(query_key),
        F.col("closest.key").alias(key),
        F.col("closest.distance").alias("distance_metric"),
    )
    unlocated = queries.filter(F.col(query_lat).isNull() | F.col(query_lon).isNull())
    return found.unionByName(unlocated.select(query_key, *nothing))
