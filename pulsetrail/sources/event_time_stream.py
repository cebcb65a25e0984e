"""Staged messages as a stream whose offsets are event times.

``spark.readStream.format("event_time_chunks").schema(...).option("path", ...)`` reads the files that
``prepare_chunks`` has written, in the order of event time whatever order they were written in. An offset is a
time ``ms``, and a micro-batch holds the messages from one offset up to the next, so batches never overlap and
a batch that runs again holds the same messages. Options:

==========  ===============================================================================================
path        the staged messages
span_ms     a micro-batch takes in at most so much event time
speed       event time let in per time passed since the start; without it, as fast as batches are done
checkpoint  the query's checkpoint, to go on from the last batch planned there
==========  ===============================================================================================

Tasks read a file each, only row groups in question, as Arrow batches. A stretch without messages is an empty
micro-batch. Messages without an event time are not part of the stream.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.dataset
from pyarrow import fs
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from pulsetrail.sources.chunk_files import INDEX, TimeSpans, parse_index


class EventTimeChunks(DataSource):
    @classmethod
    def name(cls) -> str:
        return "event_time_chunks"

    def schema(self) -> str:
        return "key string, value binary, event_time_ms bigint"

    def streamReader(self, schema: T.StructType) -> EventTimeReader:
        return EventTimeReader(dict(self.options), schema.names)


class Stretch(InputPartition):
    """Messages of one file from ``low`` up to but without ``high``."""

    def __init__(self, path: str, low: int, high: int):
        self.path, self.low, self.high = path, low, high


class EventTimeReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str], columns: list[str]):
        self.path, self.columns = options["path"].rstrip("/"), columns
        self.span = int(options["span_ms"])
        self.speed = float(options["speed"]) if options.get("speed") else None
        if self.span <= 0 or (self.speed is not None and not self.speed > 0):
            raise ValueError("span_ms and speed must be above 0")
        system, place = _resolve(self.path)
        with system.open_input_stream(f"{place}/{INDEX}") as file:
            self.files = TimeSpans(parse_index(file.read().decode()))
        self.first = self.files.first_ms or 0
        self.end = self.first if self.files.last_ms is None else self.files.last_ms + 1
        # Up to where batches have been planned; each one ends beyond it.
        self.planned = max(self.first, _last_planned(options.get("checkpoint")) or self.first)
        self.started: tuple[float, int] | None = None

    def initialOffset(self) -> dict:
        return {"ms": self.first}

    def latestOffset(self) -> dict:
        upto = min(self.planned + self.span, self.end)
        if self.speed is not None:
            if self.started is None:
                self.started = (time.monotonic(), self.planned)
            at, ms = self.started
            upto = min(upto, ms + int((time.monotonic() - at) * 1000 * self.speed))
        return {"ms": max(upto, self.planned)}

    def partitions(self, start: dict, end: dict) -> list[Stretch]:
        self.planned = max(self.planned, end["ms"])
        return [
            Stretch(f"{self.path}/{s.name}", start["ms"], end["ms"])
            for s in self.files.overlapping(start["ms"], end["ms"])
        ]

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        system, place = _resolve(partition.path)
        at = pyarrow.dataset.field("event_time_ms")
        rows = pyarrow.dataset.dataset(place, filesystem=system, format="parquet")
        wanted = (at >= partition.low) & (at < partition.high)
        for batch in rows.to_batches(columns=self.columns, filter=wanted):
            if batch.num_rows:
                yield batch


def _last_planned(checkpoint: str | None) -> int | None:
    """The end of the last batch in the offset log of a query."""
    if not checkpoint:
        return None
    system, place = _resolve(checkpoint.rstrip("/"))
    found = system.get_file_info(fs.FileSelector(f"{place}/offsets", allow_not_found=True))
    numbers = [int(f.base_name) for f in found if f.base_name.isdigit()]
    if not numbers:
        return None
    with system.open_input_stream(f"{place}/offsets/{max(numbers)}") as file:
        return json.loads(file.read().decode().splitlines()[-1])["ms"]


def _resolve(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path in it of a path as Spark writes it."""
    if "://" not in path:
        return fs.LocalFileSystem(), path.removeprefix("file:")
    return fs.FileSystem.from_uri(path)
