"""Data-quality profile of an event layer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rows_per_date(events: DataFrame, date: str = "date", time: str = "planned_time") -> DataFrame:
    """(date, n_rows, n_missing) Rows and rows without a time; an unknown date is a date too."""
    missing = F.count(F.when(F.col(time).isNull(), 1))
    return events.groupBy(F.col(date).alias("date")).agg(
        F.count("*").alias("n_rows"), missing.alias("n_missing")
    )


def summary(per_date: DataFrame) -> DataFrame:
    """(n_rows, n_dates, n_missing) of the whole layer, from its `rows_per_date`."""
    return per_date.agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
        F.count("*").alias("n_dates"),
        F.coalesce(F.sum("n_missing"), F.lit(0)).alias("n_missing"),
    )
