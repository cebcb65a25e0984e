"""Reading one day of a table, staged chunks, delivered messages and schema texts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsetrail.sources.chunk_files import ChunkFiles


# What a numbered message carries beside key and value.
NUMBERS = {"seq": "string", "event_time_ms": "bigint"}


def load_day(
    spark: SparkSession,
    table: str,
    date: str,
    date_column: str = "dt",
    equal: Mapping[str, str] | None = None,
) -> DataFrame:
    """Rows of one date of a catalog table; ``equal`` narrows further columns, such as the fab.

    On partition columns these conditions select the folders to read.
    """
    return _on_day(spark.table(table), date, date_column, equal)


def load_path(
    spark: SparkSession,
    format: str,
    path: str,
    date: str | None = None,
    date_column: str = "dt",
    equal: Mapping[str, str] | None = None,
) -> DataFrame:
    """The same from files (ORC, Parquet, CSV, JSON); without a date, all of them."""
    files = spark.read.format(format).load(path)
    return files if date is None else _on_day(files, date, date_column, equal)


def load_chunks(spark: SparkSession, path: str, from_ms: int | None = None, to_ms: int | None = None) -> DataFrame:
    """Staged messages with from_ms <= event_time_ms < to_ms, from the files that can hold some; without
    limits, all of them."""
    return ChunkFiles(spark, path).between(from_ms, to_ms)


def between(chunks: DataFrame, from_ms: int | None, to_ms: int | None) -> DataFrame:
    """The same from messages of any origin; row groups of files sorted by time are skipped."""
    time = F.col("event_time_ms")
    if from_ms is not None:
        chunks = chunks.filter(time >= from_ms)
    if to_ms is not None:
        chunks = chunks.filter(time < to_ms)
    return chunks


def read_delivered(
    spark: SparkSession, format: str, path: str | None = None, options: Mapping[str, str] | None = None
) -> DataFrame:
    """Delivered messages read back; for Kafka all of a topic from its start, as one batch."""
    reader = spark.read.format(format)
    if format == "kafka":
        reader = reader.option("startingOffsets", "earliest")
    reader = reader.options(**(options or {}))
    rows = reader.load(path) if path else reader.load()
    return rows.select("key", "value")


def read_once(
    spark: SparkSession,
    format: str,
    path: str | None = None,
    options: Mapping[str, str] | None = None,
    *,
    delay: str | None = None,
) -> DataFrame:
    """Messages of a ``numbered`` sink, each once however often it was sent: key, value, seq, event_time_ms.

    Without a ``delay`` all that is there, as one batch. With one it is a stream: numbers are remembered for that
    much event time, and a repeat that comes later still is older than the watermark and dropped for it. The delay
    has to cover how far slices overtake each other, or first copies would be late too.
    """
    reader = (spark.readStream if delay else spark.read).format(format)
    if format == "kafka":
        reader = reader.option("startingOffsets", "earliest").option("includeHeaders", True)
    else:
        # Each write has a folder of its own.
        reader = reader.option("recursiveFileLookup", True)
        reader = reader.schema(f"key string, value binary, {', '.join(f'{c} {kind}' for c, kind in NUMBERS.items())}")
    reader = reader.options(**(options or {}))
    rows = reader.load(path) if path else reader.load()
    if format == "kafka":
        rows = rows.select("key", "value", *[_header(c).cast(kind).alias(c) for c, kind in NUMBERS.items()])
    if not delay:
        return rows.dropDuplicates(["seq"])
    timed = rows.withColumn("_pt_at", F.timestamp_millis("event_time_ms")).withWatermark("_pt_at", delay)
    return timed.dropDuplicatesWithinWatermark(["seq"]).drop("_pt_at")


def lookup_schema(schemas: DataFrame, artifact: str) -> str:
    """Text of one value schema from a table (artifact, content); an artifact that is unknown, or there
    with several contents, is an error."""
    found = schemas.filter(F.col("artifact") == artifact).select("content").distinct().limit(2).collect()
    if not found:
        raise ValueError(f"no schema named '{artifact}'")
    if len(found) > 1:
        raise ValueError(f"several schemas named '{artifact}'")
    return found[0]["content"]


def _header(name: str) -> Column:
    """The text of a Kafka header."""
    return F.filter("headers", lambda header: header["key"] == name)[0]["value"].cast("string")


def _on_day(df: DataFrame, date: str, date_column: str, equal: Mapping[str, str] | None) -> DataFrame:
    day = df.filter(F.col(date_column) == date)
    for name, value in (equal or {}).items():
        day = day.filter(F.col(name) == value)
    return day
