"""Encoders turn a list of columns into one binary column.

An encoder is any function ``(list[Column]) -> Column``; a caller may pass their own. Without the
connector package that Avro or Protobuf needs, Spark refuses the query when it is built and names the
package.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulsetrail.functions.columns import column

Encoder = Callable[[list[Column]], Column]


def json_encoder(columns: list[Column]) -> Column:
    """The columns as one JSON object; arrays, structs, maps and decimals included, nulls left out."""
    return F.to_json(F.struct(*columns)).cast("binary")


def binary_encoder(name: str) -> Encoder:
    """One column passed through as bytes."""
    return lambda _columns: column(name).cast("binary")


def avro_encoder(schema: str) -> Encoder:
    """The columns as one Avro record under ``schema``; needs the spark-avro connector."""

    def encode(columns: list[Column]) -> Column:
        from pyspark.sql.avro.functions import to_avro

        return to_avro(F.struct(*columns), schema)

    return encode


def protobuf_encoder(message: str, descriptor: str) -> Encoder:
    """The columns as one Protobuf message; needs the spark-protobuf connector and a descriptor file."""

    def encode(columns: list[Column]) -> Column:
        from pyspark.sql.protobuf.functions import to_protobuf

        return to_protobuf(F.struct(*columns), message, descFilePath=descriptor)

    return encode


def choose_encoder(
    name: str, *, schema: str | None, descriptor: str | None, payload: str | None = None
) -> Encoder:
    """The encoder for a format name; upper and lower case are the same."""
    kind = name.lower()
    if kind == "json":
        return json_encoder
    if kind == "binary" and payload:
        return binary_encoder(payload)
    if kind == "avro" and schema:
        return avro_encoder(schema)
    if kind == "protobuf" and schema and descriptor:
        return protobuf_encoder(schema, descriptor)
    raise ValueError(f"format '{name}' is unknown or lacks its schema")

