"""Columns by name, and event times as epoch milliseconds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNIT_MS = {"minute": 60_000, "hour": 3_600_000, "day": 86_400_000}


def column(name: str) -> Column:
    """A top-level column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def event_time_ms(df: DataFrame, name: str) -> Column:
    """Milliseconds since the epoch from a timestamp column; a bigint column already holds them.

    A timestamp without time zone is read in the session time zone. Microseconds are cut off.
    """
    kind = df.schema[name].dataType
    if isinstance(kind, T.LongType):
        return column(name)
    if isinstance(kind, T.TimestampType):
        return F.unix_millis(column(name))
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_millis(column(name).cast("timestamp"))
    raise ValueError(f"time column '{name}' has type {kind.simpleString()}; need timestamp or bigint")


def floor_to(value: Column, width: int) -> Column:
    """The multiple of ``width`` at or below ``value``; also right for times before the epoch."""
    return value - F.pmod(value, F.lit(width).cast("bigint"))
