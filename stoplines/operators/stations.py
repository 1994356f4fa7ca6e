"""Station lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stoplines.functions.text import normalize_name


def station_lookup(stations: DataFrame, name: str) -> DataFrame:
    """Number and coordinates of every station of that name, in any spelling of case and signs."""
    wanted = normalize_name(F.lit(name))
    return stations.filter(F.col("station_name") == wanted).select(
        "station_eva", "latitude", "longitude"
    )

