"""A whole replay from its settings: read the day, make messages, deliver them."""

from __future__ import annotations

import json
import time as wall
import uuid
from collections.abc import Callable
from dataclasses import asdict, replace

from pyspark.sql import DataFrame, SparkSession

from pulsetrail.config import ReplayConfig, Sink
from pulsetrail.functions.columns import column
from pulsetrail.operators.envelope import envelope, split_rejects
from pulsetrail.operators.messages import check_sink, prepare_chunks, write_messages, write_paced, write_to
from pulsetrail.operators.roles import resolve_roles, schema_name
from pulsetrail.sources.chunk_files import ChunkFiles
from pulsetrail.sources.tables import load_day, lookup_schema
from pulsetrail.workspace import move, new_path, path_exists, read_text, remove, write_text

# What staged chunks were made from, in a file that readers of tables pass over.
SETTINGS = "_replay_settings.json"


def run_replay(
    spark: SparkSession,
    config: ReplayConfig,
    sink: Sink,
    *,
    schemas: DataFrame | None = None,
    rejects: Sink | None = None,
    chunks_path: str | None = None,
    unit: str = "hour",
    log_path: str | None = None,
    clock: Callable[[], float] = wall.monotonic,
    sleep: Callable[[float], None] = wall.sleep,
) -> None:
    """Replay one day of ``config.source_table`` to ``sink``, at full speed or paced.

    Avro and Protobuf values without a ``value_schema`` take theirs from the table ``schemas`` (artifact,
    content) by ``schema_name``. With ``rejects``, rows without a key or, when paced, without an event time
    go there with the reason; without it, keys may be NULL and a missing event time is an error. Paced
    messages are staged at ``chunks_path`` first; finished chunks of the same settings found there are used
    again, and together with ``log_path`` a replay that broke off goes on where it was, also at another
    speed.
    """
    if schemas is not None and config.value_schema is None and config.value_format.lower() in ("avro", "protobuf"):
        config = replace(config, value_schema=lookup_schema(schemas, schema_name(config)))
    config.validate()
    check_sink(spark, sink)
    day = load_day(spark, config.source_table, config.target_date, config.date_column, config.equal)
    if rejects is not None:
        good, rejected = split_rejects(day, config)
        write_to(rejected, rejects)
    else:
        good = day
        _check_times(good, config)
    if config.max_speed:
        write_messages(envelope(good, config), sink)
        return
    own = None if chunks_path else new_path(spark, "chunks")
    chunks = _staged(spark, good, chunks_path or own, config, unit)
    write_paced(
        chunks,
        sink,
        speed=config.speed,
        slice_ms=config.slice_ms,
        log_path=log_path,
        clock=clock,
        sleep=sleep,
    )
    if own:
        remove(spark, own)


def _staged(spark: SparkSession, day: DataFrame, path: str, config: ReplayConfig, unit: str) -> ChunkFiles:
    """The chunks at ``path``, staged first unless they are there; those of another day or other settings are
    refused. Staging goes to a folder beside and is renamed when whole, so a failed one is never in the way."""
    left_out = ("speed", "slice_ms", "batch_size")
    settings = {k: v for k, v in asdict(config).items() if k not in left_out} | {"unit": unit}
    schema = envelope(day, config).schema.add("chunk", "long")
    text = json.dumps(settings, sort_keys=True, default=str)
    if path_exists(spark, f"{path}/{SETTINGS}"):
        if read_text(spark, f"{path}/{SETTINGS}") != text:
            raise ValueError(f"the chunks at {path} are of another table, date or other settings")
        return ChunkFiles(spark, path, schema)
    if path_exists(spark, f"{path}/_SUCCESS"):
        raise ValueError(f"the chunks at {path} do not tell their table, date and settings")
    beside = f"{path.rstrip('/')}.staging-{uuid.uuid4().hex}"
    prepare_chunks(day, beside, config, unit)
    write_text(spark, f"{beside}/{SETTINGS}", text)
    if path_exists(spark, path):
        # What an interrupted write left; it holds neither its end mark nor its settings.
        move(spark, path, f"{path.rstrip('/')}.left-{uuid.uuid4().hex}")
    move(spark, beside, path)
    return ChunkFiles(spark, path, schema)


def _check_times(day: DataFrame, config: ReplayConfig) -> None:
    """No row may be left behind unnoticed: without an event time it has no place in a paced replay."""
    time = resolve_roles(day, config).time
    if time and not day.filter(column(time).isNull()).isEmpty():
        raise ValueError(f"rows without '{time}' can not be paced; give a sink for rejects")
