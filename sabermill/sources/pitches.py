"""Pitch-level files to raw pitch rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from sabermill.functions.coerce import calendar_day, measured
from sabermill.schemas import PITCH_KEY, raw_schema

# Fixed value: the one source column that is stored under another name.
SOURCE_NAMES = {"batter_name": "player_name"}
REQUIRED = ["batter", "pitcher", "game_date"]
STORED = ["id", "loaded_at"]


def pitch_schema() -> T.StructType:
    """The raw columns that come from the files."""
    return T.StructType([f for f in raw_schema("statcast") if f.name not in STORED])


def map_columns(frame: DataFrame) -> DataFrame:
    """The 57 known columns: absent ones as NULL, unknown ones dropped."""
    columns = []
    for field in pitch_schema():
        source = SOURCE_NAMES.get(field.name, field.name)
        present = source in frame.columns
        value = F.col(source) if present else F.lit(None).cast(field.dataType)
        columns.append(value.alias(field.name))
    return frame.select(*columns)


def coerce(frame: DataFrame) -> DataFrame:
    """Typed values: NaN and unreadable numbers are NULL, dates lose their time of day."""
    source = {f.name: f.dataType for f in frame.schema}
    columns = []
    for field in pitch_schema():
        value = F.col(field.name)
        if isinstance(field.dataType, T.DateType):
            value = calendar_day(value)
        elif isinstance(field.dataType, T.StringType):
            value = value.cast("string")
        else:
            value = measured(value, source[field.name], field.dataType)
        columns.append(value.alias(field.name))
    return frame.select(*columns)


def pitch_rows(frame: DataFrame) -> DataFrame:
    """Landed pitches as raw rows, without those that miss a batter, a pitcher or a date.

    ``id`` hashes the natural key and batter, pitcher and day; rows are merged by the natural
    key itself, never by ``id``.
    """
    complete = coerce(map_columns(frame)).dropna(subset=REQUIRED)
    return complete.select(
        F.xxhash64(*PITCH_KEY, *REQUIRED).alias("id"),
        "*",
        F.current_timestamp().alias("loaded_at"),
    )
