"""Keyed table operators: keep-first, insert, upsert, change folding, orphan check.

Spark tables have no keys of their own, so each operator makes its result unique. All of
them reduce the rows of a key before the shuffle, so a key with many copies never
reaches one task whole.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stoplines.functions.times import minutes_between
from stoplines.storage import materialize

# Numbers drawn for rows to be dealt by, for each task.
DRAWS_PER_TASK = 32


def dealt(df: DataFrame, tasks: int, key: list[str] | None = None) -> DataFrame:
    """The rows dealt over `tasks`, at random; with `key` by it and a column `_draw`, so that copies of a key may meet.

    A part of a stored table has rows by its bytes, which are far more than a task can hold if they compress well.
    """
    if key is None:
        return df.withColumn("_draw", F.rand(0)).repartition(tasks, "_draw").drop("_draw")
    return df.withColumn("_draw", F.floor(F.rand(0) * tasks)).repartition(tasks, *key, "_draw")


def _pick(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    # row_number() = 1 is planned as a group limit on both sides of the shuffle:
    # each task sends at most one row per key.
    rank = F.row_number().over(W.partitionBy(*key).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def keep_first(df: DataFrame, key: list[str], order: list[str], tasks: int | None = None) -> DataFrame:
    """The first row of each key in the given order.

    With `tasks` the rows are dealt over so many before a task reduces its part of each key, and what is left of each key
    meets in one of as many; else a task sorts a part of the table as it is read.
    """
    columns = [F.col(c).asc_nulls_first() for c in order]
    if tasks:
        df = _pick(dealt(df, tasks, key), [*key, "_draw"], columns).drop("_draw").repartition(tasks, *key)
    return _pick(df, key, columns)


def keep_last(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The last row of each key in the given order."""
    return _pick(df, key, [F.col(c).desc_nulls_last() for c in order])


def insert_absent(target: DataFrame, new: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Target rows, and the first new row of each key that the target lacks.

    The new rows are stored, since they are used twice and their size decides the joins: a
    small delivery is broadcast and the target is not shuffled at all.
    """
    first = materialize(keep_first(new, key, order).select(*target.columns), "new-rows")
    present = target.select(*key).join(first.select(*key), key, "left_semi").distinct()
    return target.unionByName(first.join(present, key, "left_anti"))


def upsert(target: DataFrame, new: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The last new row of each key, and the target rows of all other keys.

    The new rows are stored, as in `insert_absent`.
    """
    last = materialize(keep_last(new, key, order).select(*target.columns), "new-rows")
    return target.join(last.select(*key), key, "left_anti").unionByName(last)


def fold_changes(
    changes: DataFrame,
    key: str = "stop_id",
    order: tuple[str, ...] = ("archive", "seq", "pos"),
    arrival: str = "new_arrival",
    departure: str = "new_departure",
    cancelled: str = "cancelled",
) -> DataFrame:
    """All changes of a key as one: latest known arrival and departure, cancelled if ever cancelled."""
    position = F.col(order[0]) if len(order) == 1 else F.struct(*order)

    def latest(name: str) -> Column:
        # a NULL position is ignored by max_by, so rows without a value do not count
        return F.max_by(name, F.when(F.col(name).isNotNull(), position)).alias(name)

    return changes.groupBy(key).agg(
        latest(arrival), latest(departure), F.bool_or(cancelled).alias(cancelled)
    )


def fold_with_positions(
    changes: DataFrame,
    key: str = "stop_id",
    position: str = "position",
    arrival: str = "new_arrival",
    departure: str = "new_departure",
    cancelled: str = "cancelled",
    tasks: int | None = None,
) -> DataFrame:
    """As `fold_changes` by one number, with the position of each latest value as `<name>_position`.

    With `tasks` the changes are dealt over so many, each of which folds its part of a key, and what is left of each key meets
    in one of as many.
    """

    def folded(rows: DataFrame, keys: list[str], position_of: Callable[[str], str]) -> DataFrame:
        def at(name: str) -> Column:
            return F.when(F.col(name).isNotNull(), F.col(position_of(name)))

        times = [
            column for name in (arrival, departure)
            for column in (F.max_by(name, at(name)).alias(name), F.max(at(name)).alias(f"{name}_position"))
        ]
        return rows.groupBy(*keys).agg(*times, F.bool_or(cancelled).alias(cancelled))

    if not tasks:
        return folded(changes, [key], lambda _: position)
    # Many draws a task, so that tasks get about as many rows each.
    draw = F.floor(F.rand(0) * (tasks * DRAWS_PER_TASK)).cast("int")
    parts = folded(changes.withColumn("_draw", draw).repartition(tasks, "_draw"), [key, "_draw"], lambda _: position).drop("_draw")
    return folded(parts.repartition(tasks, key), [key], lambda name: f"{name}_position")


def merge_changes(old: DataFrame, new: DataFrame, key: str = "stop_id") -> DataFrame:
    """Two states of changes as one: of each time the later one, cancelled if ever cancelled.

    A state has one row per key: `arrival` and `departure`, each a struct of the position and the time of the latest known
    value or NULL, and `cancelled`. Structs are compared field by field, so the result does not depend on
    which state is the old one, and states can be merged in any order and grouping.
    """
    joined = old.alias("o").join(new.alias("n"), key, "full")
    times = {name: F.greatest(f"o.{name}", f"n.{name}") for name in ("arrival", "departure")}
    ever = F.coalesce("o.cancelled", F.lit(False)) | F.coalesce("n.cancelled", F.lit(False))
    return joined.select(key, *[value.alias(name) for name, value in times.items()], ever.alias("cancelled"))


PLAN = ("station_eva", "profile_id", "date_id", "train_line", "planned_arrival", "planned_departure", "planned_from")


def merge_facts(
    facts: DataFrame | None, plans: DataFrame, changes: DataFrame, key: str = "stop_id", tasks: int | None = None
) -> DataFrame:
    """Facts with the plans and changes of a delivery; each input has one row per key.

    A fact has the state of its stop: `planned_from`, the position of its plan, and `arrival_from` and `departure_from`, those
    of its actual times. The plan with the smallest position stays, and the time with the greatest. A delay is that of the
    latest time against the plan, 0 without a time, NULL without a planned time. A cancellation is never taken back. Changes
    of other stops are ignored. Deliveries can thus be merged in any order.

    With `tasks` the rows of each input are dealt by key over so many.
    """
    if tasks:
        plans, changes = plans.repartition(tasks, key), changes.repartition(tasks, key)
        facts = facts if facts is None else facts.repartition(tasks, key)
    position = plans.schema["planned_from"].dataType.simpleString()
    no_time = F.lit(None).cast("timestamp_ntz")
    if facts is None:
        rows = plans.select(key, *PLAN).withColumns({
            "actual_arrival": no_time, "actual_departure": no_time,
            "arrival_from": F.lit(None).cast(position), "departure_from": F.lit(None).cast(position),
            "is_cancelled": F.lit(False),
        })
    else:
        joined = facts.alias("o").join(plans.select(key, *PLAN).alias("n"), key, "full")
        first = F.col("o.planned_from").isNull() | (F.col("n.planned_from") < F.col("o.planned_from"))
        state = ("actual_arrival", "actual_departure", "arrival_from", "departure_from")
        rows = joined.select(
            key, *[F.when(first, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in PLAN],
            *[F.col(f"o.{c}").alias(c) for c in state],
            F.coalesce("o.is_cancelled", F.lit(False)).alias("is_cancelled"),
        )
        # The key of either side is a new column, by which rows don't lie any more.
        rows = rows.repartition(tasks, key) if tasks else rows
    parts = ("archive", "seq", "pos")
    for name in ("arrival", "departure"):
        own = F.struct(*[F.col(f"{name}_from.{c}").alias(c) for c in parts], F.col(f"actual_{name}").alias("time"))
        rows = rows.withColumn(f"own_{name}", F.when(F.col(f"{name}_from").isNotNull(), own))
    merged = rows.join(changes.select(key, "arrival", "departure", "cancelled"), key, "left")
    for name in ("arrival", "departure"):
        latest = F.greatest(f"own_{name}", name)
        merged = merged.withColumn(name, latest)
        minutes = minutes_between(F.col(f"planned_{name}"), F.col(f"{name}.time"))
        merged = merged.withColumns({
            f"actual_{name}": F.col(f"{name}.time"),
            f"{name}_from": F.when(F.col(name).isNotNull(), F.struct(*[F.col(f"{name}.{c}").alias(c) for c in parts])),
            f"{name}_delay_minutes": F.when(F.col(f"{name}.time").isNotNull(), minutes).otherwise(F.lit(0)),
        })
    ever = F.col("is_cancelled") | F.coalesce("cancelled", F.lit(False))
    return merged.withColumn("is_cancelled", ever).drop("own_arrival", "own_departure", "arrival", "departure", "cancelled")


def apply_changes(
    stops: DataFrame,
    folded: DataFrame,
    key: str = "stop_id",
    arrival: str = "new_arrival",
    departure: str = "new_departure",
    cancelled: str = "cancelled",
) -> DataFrame:
    """Merge folded changes into the fact rows; changes of unknown stops are ignored.

    A delay is set only where a new actual time exists; it is NULL if the planned time is
    missing. A cancellation is never taken back.
    """
    joined = stops.join(folded, key, "left")

    def delay(new: str, planned: str, old: str) -> Column:
        minutes = minutes_between(F.col(planned), F.col(new))
        return F.when(F.col(new).isNotNull(), minutes).otherwise(F.col(old))

    merged = joined.withColumns({
        "actual_arrival": F.coalesce(arrival, "actual_arrival"),
        "actual_departure": F.coalesce(departure, "actual_departure"),
        "arrival_delay_minutes": delay(arrival, "planned_arrival", "arrival_delay_minutes"),
        "departure_delay_minutes": delay(departure, "planned_departure", "departure_delay_minutes"),
        "is_cancelled": F.when(F.col(cancelled), F.lit(True)).otherwise(F.col("is_cancelled")),
    })
    return merged.select(*stops.columns)


def orphans(fact: DataFrame, dim: DataFrame, key: dict[str, str] | str) -> DataFrame:
    """Fact rows whose key is set but not in the dimension.

    `key` is a common column name, or maps fact columns to dimension columns. The distinct
    keys are stored: few are broadcast, and with many a hot fact key is split by the skew
    join, which needs both sides to come straight from a shuffle.
    """
    pairs = {key: key} if isinstance(key, str) else key
    keys = dim.select(*[F.col(d).alias(f"_dim_{d}") for d in pairs.values()]).distinct()
    keys = materialize(keys, "keys")
    match = [F.col(f) == F.col(f"_dim_{d}") for f, d in pairs.items()]
    known = reduce(Column.__and__, [F.col(f).isNotNull() for f in pairs])
    return fact.filter(known).join(keys, match, "left_anti")
