"""Which column is the key, which the event time, and which make up the value."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from pulsetrail.config import ReplayConfig
from pulsetrail.fixed_values import KEY_COLUMNS, TIME_COLUMNS

TIME_TYPES = (T.TimestampType, T.TimestampNTZType, T.LongType)


@dataclass(frozen=True)
class Roles:
    key: str
    time: str | None = None


def detect_key(df: DataFrame) -> str:
    """The best known key column, else the first column. Names are compared with their case."""
    return next((name for name in KEY_COLUMNS if name in df.columns), df.columns[0])


def detect_time(df: DataFrame) -> str:
    """The best known time column, whatever its type, else the first timestamp or bigint column."""
    by_name = [name for name in TIME_COLUMNS if name in df.columns]
    by_type = [f.name for f in df.schema.fields if isinstance(f.dataType, TIME_TYPES)]
    for name in by_name + by_type:
        return name
    raise ValueError(f"no time column found; available columns: {', '.join(df.columns)}")


def resolve_roles(df: DataFrame, config: ReplayConfig) -> Roles:
    """Roles by setting or by detection; the time column only matters when the replay is paced."""
    key = _existing(df, "key", config.key_column or detect_key(df))
    if config.max_speed:
        return Roles(key)
    return Roles(key, _existing(df, "time", config.time_column or detect_time(df)))


def value_columns(df: DataFrame, roles: Roles, config: ReplayConfig) -> list[str]:
    """Columns of the value in table order; names to exclude that do not exist are ignored."""
    left_out = set(config.exclude_columns)
    if not config.key_in_value:
        left_out.add(roles.key)
    if roles.time and not config.keeps_time_in_value:
        left_out.add(roles.time)
    return [name for name in df.columns if name not in left_out]


def schema_name(config: ReplayConfig) -> str:
    """Name of the value schema: as set, else the table name without its database, plus ``.value``."""
    return config.schema_name or f"{config.source_table.split('.')[-1]}.value"


def _existing(df: DataFrame, role: str, name: str) -> str:
    if name not in df.columns:
        raise ValueError(f"{role} column '{name}' not found; available columns: {', '.join(df.columns)}")
    return name
