"""Which files of staged messages hold a stretch of event time.

Staged files are cut from one order by time, so each holds a short stretch, and a list of (first, last, rows)
per file says which ones to open. The list is written beside the files once; it is as long as Spark's own list
of them and held by the driver like that one.
"""

from __future__ import annotations

import json
from bisect import bisect_left
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsetrail.workspace import path_exists, read_text, write_text

# Readers of tables pass over names that begin like this.
INDEX = "_files.json"


@dataclass(frozen=True)
class FileSpan:
    """One file: first and last event time, NULL without any, and rows with and without a time."""

    name: str
    first_ms: int | None
    last_ms: int | None
    rows: int
    untimed: int


def index_files(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Write the list of the files at ``path``, from their times alone."""
    rows = spark.read.schema(schema).parquet(path)
    name = F.element_at(F.split("_metadata.file_name", "/"), -1)
    spans = rows.groupBy(name.alias("name")).agg(
        F.min("event_time_ms").alias("first_ms"),
        F.max("event_time_ms").alias("last_ms"),
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("event_time_ms").isNull()).alias("untimed"),
    )
    write_text(spark, f"{path.rstrip('/')}/{INDEX}", "\n".join(json.dumps(r.asDict()) for r in spans.collect()))


def parse_index(text: str) -> list[FileSpan]:
    return [FileSpan(**json.loads(line)) for line in text.splitlines()]


class ChunkFiles:
    """Staged messages at ``path`` with the list of their files."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        if not path_exists(spark, f"{self.path}/{INDEX}"):
            raise ValueError(f"{path} has no list of its files; index_files makes one")
        spans = parse_index(read_text(spark, f"{self.path}/{INDEX}"))
        self.schema = schema or spark.read.parquet(self.path).schema
        self.untimed = sum(s.untimed for s in spans)
        self.spans = TimeSpans(spans)

    def frame(self) -> DataFrame:
        """All messages."""
        return self.spark.read.schema(self.schema).parquet(self.path)

    def between(self, from_ms: int | None, to_ms: int | None, *, numbered: bool = False) -> DataFrame:
        """Messages with from_ms <= event_time_ms < to_ms, reading only files that can hold some; without limits,
        all messages. ``numbered`` adds ``seq``, which no other message has and a message always has: its file
        and its place there."""
        found = self.spans.overlapping(from_ms, to_ms)
        if from_ms is None and to_ms is None:
            rows = self.frame()
        elif not found:
            rows = self.frame().limit(0)
        else:
            rows = self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{s.name}" for s in found])
        if numbered:
            rows = rows.select("*", F.concat_ws(":", "_metadata.file_name", "_metadata.row_index").alias("seq"))
        time = F.col("event_time_ms")
        if from_ms is not None:
            rows = rows.filter(time >= from_ms)
        return rows if to_ms is None else rows.filter(time < to_ms)


class TimeSpans:
    """Spans in order of their start; the ones that overlap a stretch are found by bisection."""

    def __init__(self, spans: list[FileSpan]):
        self.spans = sorted((s for s in spans if s.first_ms is not None), key=lambda s: (s.first_ms, s.last_ms, s.name))
        self.starts = [s.first_ms for s in self.spans]
        # Where one span ends late, the search has to begin no later than it.
        self.ends = list(accumulate((s.last_ms for s in self.spans), max))

    @property
    def first_ms(self) -> int | None:
        return self.starts[0] if self.starts else None

    @property
    def last_ms(self) -> int | None:
        return self.ends[-1] if self.ends else None

    def overlapping(self, from_ms: int | None, to_ms: int | None) -> list[FileSpan]:
        low = 0 if from_ms is None else bisect_left(self.ends, from_ms)
        high = len(self.spans) if to_ms is None else bisect_left(self.starts, to_ms)
        return [s for s in self.spans[low:high] if from_ms is None or s.last_ms >= from_ms]
