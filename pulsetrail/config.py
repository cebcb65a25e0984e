"""Settings of a replay job and of the place it delivers to."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pulsetrail.fixed_values import EXCLUDED_COLUMNS

VALUE_FORMATS = ("json", "binary", "avro", "protobuf")
KEY_FORMATS = ("string", "json", "avro", "protobuf")
DEFAULT_SLICE_MS = 1000


@dataclass(frozen=True)
class Sink:
    """Where messages go: any Spark batch writer.

    ``path`` is for file formats; Kafka takes its servers and topic (and any ``kafka.*`` producer
    setting such as batch size, linger, compression or acks) from ``options``. ``only`` is a condition on key
    and value that messages must meet to be sent there. With ``numbered`` each message carries its number and event
    time (columns ``seq`` and ``event_time_ms``, in Kafka headers of that name), nothing that was sent before is
    replaced, and ``read_once`` drops what was sent again.
    """

    format: str = "parquet"
    path: str | None = None
    mode: str = "append"
    options: Mapping[str, str] = field(default_factory=dict)
    only: str | None = None
    numbered: bool = False

    def under(self, *parts: str) -> Sink:
        """The same sink one or more folders further down; only for sinks with a path. A ``numbered`` one gets a
        folder for this write alone, as writes that go on at once can not share one."""
        if self.path is None:
            return self
        if self.numbered:
            return replace(self, path=f"{self.path.rstrip('/')}/send-{uuid.uuid4().hex}")
        return replace(self, path="/".join([self.path.rstrip("/"), *parts]), mode="overwrite")


@dataclass(frozen=True)
class ReplayConfig:
    """One replay of one day of a table.

    ``equal`` narrows further columns of the table, such as the fab, to one value each.
    ``batch_size`` rows make a batch of ``replay_batches``; a paced write goes by slices that take about
    ``slice_ms`` each. Schemas are the Avro schema text or the Protobuf message name, descriptors the path of
    a Protobuf descriptor file.
    ``time_in_value`` and ``key_in_value`` say whether the value repeats the time and key columns.
    ``time_in_value=None`` follows the mode: kept at full speed, left out when paced (where the time
    travels as ``event_time_ms``).
    """

    source_table: str = ""
    target_date: str = ""
    date_column: str = "dt"
    equal: Mapping[str, str] = field(default_factory=dict)
    speed: float = 1.0
    batch_size: int = 10_000
    max_speed: bool = False
    slice_ms: int = DEFAULT_SLICE_MS
    value_format: str = "json"
    value_schema: str | None = None
    value_descriptor: str | None = None
    payload_column: str = "payload"
    schema_name: str | None = None
    key_column: str | None = None
    key_literal: str | None = None
    key_format: str = "string"
    key_schema: str | None = None
    key_descriptor: str | None = None
    time_column: str | None = None
    exclude_columns: tuple[str, ...] = EXCLUDED_COLUMNS
    time_in_value: bool | None = None
    key_in_value: bool = False

    @property
    def keeps_time_in_value(self) -> bool:
        return self.max_speed if self.time_in_value is None else self.time_in_value

    def validate(self) -> ReplayConfig:
        """Return the settings unchanged, or raise ``ValueError`` naming the wrong one."""
        if not self.speed > 0:
            raise ValueError(f"speed must be above 0, got {self.speed}")
        if self.batch_size <= 0:
            raise ValueError(f"batch_size must be above 0, got {self.batch_size}")
        if self.slice_ms <= 0:
            raise ValueError(f"slice_ms must be above 0, got {self.slice_ms}")
        _check_format("value", self.value_format, VALUE_FORMATS, self.value_schema, self.value_descriptor)
        _check_format("key", self.key_format, KEY_FORMATS, self.key_schema, self.key_descriptor)
        return self


def _check_format(
    part: str, chosen: str, known: tuple[str, ...], schema: str | None, descriptor: str | None
) -> None:
    name = chosen.lower()
    if name not in known:
        raise ValueError(f"unknown {part}_format '{chosen}', use one of: {', '.join(known)}")
    if name == "avro" and not schema:
        raise ValueError(f"{part}_format avro needs {part}_schema, the Avro schema text")
    if name == "protobuf" and not (schema and descriptor):
        raise ValueError(
            f"{part}_format protobuf needs {part}_schema, the message name, "
            f"and {part}_descriptor, the descriptor file"
        )
