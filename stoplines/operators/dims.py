"""Dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stoplines.functions.text import clean_text, normalize_name
from stoplines.operators.merge import keep_last
from stoplines.storage import materialize

# Fixed value: spellings that no similarity would resolve, and their station number.
ALIASES = {"yorckstra_e__gro_g_rschenstra_e_": 8089051}


def station_dim(raw: DataFrame) -> DataFrame:
    """One row per main station number; the last one in the list (by file, then place) wins.

    Stations without a main number are dropped. Coordinates come as (longitude, latitude); one
    that is no coordinate is NULL.
    """
    main = F.try_element_at(F.filter("evaNumbers", lambda e: e["isMain"]), F.lit(1))
    order = [c for c in ("file", "pos") if c in raw.columns]
    point = F.col("main.geographicCoordinates.coordinates")
    rows = raw.withColumn("main", main).select(
        F.col("main.number").alias("station_eva"),
        normalize_name(F.col("name")).alias("station_name"),
        F.try_element_at(point, F.lit(2)).try_cast("decimal(9,6)").alias("latitude"),
        F.try_element_at(point, F.lit(1)).try_cast("decimal(9,6)").alias("longitude"),
        *order,
    )
    known = rows.filter(F.col("station_eva").isNotNull())
    return keep_last(known, ["station_eva"], order).drop(*order)


def date_dim(ranges: DataFrame, start: str = "range_start", end: str = "range_end") -> DataFrame:
    """One row per day covered by any of the ranges.

    Of the ranges with the same start only the longest is expanded, so the work before
    `distinct` depends on the length of the calendar, not on the number of ranges.
    """
    longest = ranges.groupBy(start).agg(F.max(end).alias(end)).filter(F.col(start) <= F.col(end))
    day = F.col("date_id")
    return (
        longest.select(F.explode(F.sequence(F.col(start), F.col(end))).alias("date_id"))
        .distinct()
        .select(
            day,
            F.year(day).alias("year"),
            F.month(day).alias("month"),
            F.day(day).alias("day"),
            F.date_format(day, "EEEE").alias("day_of_week"),
        )
    )


def dense_number(df: DataFrame, order: list[str], name: str, start: int = 1) -> DataFrame:
    """Number the rows start, start + 1, ... in the given order, without a single-task sort.

    Rows are range-partitioned and stored with their range number. Each range is numbered
    on its own, from the number of rows in the ranges before it. The ranges come from
    sampling, hence the stored copy: both uses must see the same cut.
    """
    columns = [F.col(c).asc_nulls_first() for c in order]
    cut = materialize(
        df.repartitionByRange(*columns).withColumn("_range", F.spark_partition_id()), "ranges"
    )
    # one row per range, so this window is as small as the number of partitions
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        cut.groupBy("_range")
        .agg(F.count("*").alias("_rows"))
        .select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    )
    within = F.row_number().over(W.partitionBy("_range").orderBy(*columns))
    return (
        cut.withColumn("_within", within)
        .join(offsets, "_range")
        .withColumn(name, F.col("_within") + F.col("_before") + F.lit(start - 1).cast("bigint"))
        .drop("_range", "_within", "_before")
    )


def profile_dim(
    stops: DataFrame,
    existing: DataFrame | None = None,
    key: tuple[str, str] = ("train_number", "train_type"),
) -> DataFrame:
    """(profile_id, number, type), one row per pair; missing numbers and types are values too.

    Existing ids stay. New pairs are numbered after them, in (number, type) order.
    """
    key = list(key)
    pairs = stops.select(*key).distinct()
    if existing is None:
        numbered = dense_number(pairs, key, "profile_id")
        return numbered.select(F.col("profile_id").cast("int"), *key)
    known = existing.select(*[F.col(k).alias(f"_{k}") for k in key])
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key]
    new = pairs.join(known, same, "left_anti")
    last = existing.agg(F.coalesce(F.max("profile_id"), F.lit(0)).alias("last")).first()["last"]
    numbered = dense_number(new, key, "profile_id", last + 1)
    return existing.select("profile_id", *key).unionByName(
        numbered.select(F.col("profile_id").cast("int"), *key)
    )


def station_dictionary(
    stations: DataFrame,
    aliases: dict[str, int] | None = None,
    name: str = "station_name",
    eva: str = "station_eva",
) -> DataFrame:
    """(name, eva) with unique names; an alias wins over a station of the same name."""
    aliases = ALIASES if aliases is None else aliases
    names = (
        stations.groupBy(clean_text(F.col(name)).alias("name"))
        .agg(F.min(eva).alias("eva"))
        .filter(F.col("name").isNotNull())
    )
    if not aliases:
        return names
    rows = [(alias, number) for alias, number in aliases.items()]
    extra = stations.sparkSession.createDataFrame(rows, "name string, eva bigint")
    extra = extra.withColumn("name", clean_text(F.col("name")))
    return names.join(extra, "name", "left_anti").unionByName(extra)
