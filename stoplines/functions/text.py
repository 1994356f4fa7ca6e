"""Text clean-up of station names and stop ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a non-word character, the word dropped from names,
# and the stop index at the end of a stop id.
NON_WORD = r"[^\p{L}\p{N}_]"
DROPPED_WORD = "berlin"
STOP_INDEX = r"-[0-9]+$"


def clean_text(text: Column) -> Column:
    """Non-word characters become spaces; trimmed, lower case."""
    return F.lower(F.trim(F.regexp_replace(text, NON_WORD, " ")))


def normalize_name(name: Column, drop: str = DROPPED_WORD) -> Column:
    """Cleaned text with every occurrence of `drop` deleted. Inner double spaces stay."""
    return F.trim(F.replace(clean_text(name), F.lit(drop), F.lit("")))


def non_empty(text: Column) -> Column:
    """NULL for an empty text."""
    return F.nullif(text, F.lit(""))


def trip_id(stop_id: Column) -> Column:
    """The stop id without its stop index: shared by all stops of one trip."""
    return F.regexp_replace(stop_id, STOP_INDEX, "")


def station_text(station: Column) -> Column:
    """Station name as used for graph nodes."""
    return F.upper(F.trim(station))
