"""Rows to messages: ``key``, ``value`` and, for a paced replay, ``event_time_ms``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsetrail.config import ReplayConfig
from pulsetrail.functions.encoders import Encoder, choose_encoder
from pulsetrail.functions.columns import column, event_time_ms
from pulsetrail.operators.roles import Roles, resolve_roles, value_columns

NULL_KEY = "null_key"
NULL_EVENT_TIME = "null_event_time"


def envelope(df: DataFrame, config: ReplayConfig, encoder: Encoder | None = None) -> DataFrame:
    """One message per row.

    Key, value and time come from the same row in a single projection, so nothing is joined or
    shuffled and a value can not end up under another row's key.
    """
    return df.select(*message_columns(df, config, encoder))


def message_columns(df: DataFrame, config: ReplayConfig, encoder: Encoder | None = None) -> list[Column]:
    """The columns of ``envelope``, to be selected from ``df`` or from ``df`` with more columns."""
    config.validate()
    roles = resolve_roles(df, config)
    value = _value(df, value_columns(df, roles, config), config, encoder)
    columns = [_key(roles, config).alias("key"), value.alias("value")]
    if roles.time:
        columns.append(event_time_ms(df, roles.time).alias("event_time_ms"))
    return columns


def split_rejects(df: DataFrame, config: ReplayConfig) -> tuple[DataFrame, DataFrame]:
    """(rows that can be sent, rows that can not with the ``reason`` why)."""
    roles = resolve_roles(df, config)
    reason = F.lit(None).cast("string")
    if roles.time:
        reason = F.when(column(roles.time).isNull(), NULL_EVENT_TIME)
    if config.key_literal is None:
        reason = F.when(column(roles.key).isNull(), NULL_KEY).otherwise(reason)
    marked = df.withColumn("reason", reason)
    return marked.filter("reason IS NULL").drop("reason"), marked.filter("reason IS NOT NULL")


def _key(roles: Roles, config: ReplayConfig) -> Column:
    source = column(roles.key) if config.key_literal is None else F.lit(config.key_literal)
    if config.key_format.lower() == "string":
        return source.cast("string")
    encode = choose_encoder(config.key_format, schema=config.key_schema, descriptor=config.key_descriptor)
    return encode([source.alias(roles.key)])


def _value(df: DataFrame, names: list[str], config: ReplayConfig, encoder: Encoder | None) -> Column:
    if encoder is None:
        if config.value_format.lower() == "binary" and config.payload_column not in df.columns:
            raise ValueError(
                f"binary values need the column '{config.payload_column}'; "
                f"available columns: {', '.join(df.columns)}"
            )
        encoder = choose_encoder(
            config.value_format,
            schema=config.value_schema,
            descriptor=config.value_descriptor,
            payload=config.payload_column,
        )
    if not names:
        raise ValueError("no column is left for the value")
    if config.value_format.lower() in ("avro", "protobuf"):
        return encoder(plain_columns(df, names))
    return encoder([column(name) for name in names])


def plain_columns(df: DataFrame, names: list[str]) -> list[Column]:
    """Columns in the types a message schema knows: numbers, booleans, text and bytes as they are, timestamps
    as milliseconds, everything else as text (nested values as JSON)."""

    def plain(name: str) -> Column:
        kind = df.schema[name].dataType
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            return event_time_ms(df, name).alias(name)
        if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
            return F.to_json(column(name)).alias(name)
        known = (T.StringType, T.BinaryType, T.BooleanType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)
        return column(name) if isinstance(kind, known) else column(name).cast("string").alias(name)

    return [plain(name) for name in names]
