"""Writing messages: at once, in staged chunks, or paced slice by slice."""

from __future__ import annotations

import json
import time as wall
import uuid
from collections.abc import Callable
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from threading import Lock

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsetrail.config import ReplayConfig, Sink
from pulsetrail.functions.columns import UNIT_MS, event_time_ms, floor_to
from pulsetrail.operators.envelope import message_columns
from pulsetrail.operators.ordering import range_sorted
from pulsetrail.operators.roles import resolve_roles
from pulsetrail.operators.schedule import Coverage, replay_slices
from pulsetrail.sources.chunk_files import ChunkFiles, index_files
from pulsetrail.sources.tables import NUMBERS, between
from pulsetrail.workspace import path_exists, remove, write_text

# Of a slice that was sent: its stretch of event time, which is what it is known by, the rows its write counted,
# when it was due after the start, and how much later its write began.
DELIVERY_LOG = "from_ms bigint, to_ms bigint, rows bigint, due_ms bigint, late_ms bigint"
# A range of a staged day takes about so many bytes of its table.
RANGE_BYTES = 256 << 20
# So many notes of a delivery log are put together in one file.
NOTES = 500
# So many slices may be on their way at once, so that a slow one does not hold up the next.
UNDER_WAY = 4


def write_messages(df: DataFrame, sink: Sink) -> None:
    """Send all messages in one distributed write, in no particular order and without a shuffle."""
    write_to(_sendable(df, sink), sink)


def send_measured(df: DataFrame, sink: Sink) -> int:
    """The same; returns the rows written, counted by the write itself."""
    seen = Observation()
    write_to(_sendable(df, sink).observe(seen, F.count(F.lit(1)).alias("rows")), sink)
    return seen.get["rows"]


def _sendable(df: DataFrame, sink: Sink) -> DataFrame:
    key = F.col("key")
    if df.schema["key"].dataType != T.BinaryType():
        key = key.cast("string").alias("key")
    more = []
    if sink.numbered and sink.format == "kafka":
        texts = [F.struct(F.lit(c).alias("key"), F.col(c).cast("string").cast("binary").alias("value")) for c in NUMBERS]
        more = [F.array(*texts).alias("headers")]
    elif sink.numbered:
        more = [F.col(c) for c in NUMBERS]
    rows = df.select(key, F.col("value").cast("binary").alias("value"), *more)
    return rows.filter(sink.only) if sink.only else rows


def write_to(df: DataFrame, sink: Sink) -> None:
    """Write any DataFrame to a sink."""
    writer = df.write.format(sink.format).mode(sink.mode).options(**sink.options)
    writer.save(sink.path) if sink.path else writer.save()


def prepare_chunks(
    df: DataFrame,
    path: str,
    config: ReplayConfig,
    unit: str = "hour",
    *,
    unique_key: bool = False,
    ranges: int | None = None,
) -> DataFrame:
    """Write the messages of a paced replay once as Parquet for any number of replays, and return the
    table read back. ``chunk`` is the ``unit`` of event time a message is in.

    Rows are put in order of time, then key, and turned into messages after the shuffle. Files are ranges of the
    order of about equal size, as many as ``ranges`` or else one for each ``RANGE_BYTES`` of the table but no
    fewer than shuffle partitions: a busy hour is spread over several files, quiet ones share one. A list of the
    files and their times is written beside them (``ChunkFiles``). Pass ``unique_key=True`` when time and key
    together never repeat. Rows without an event time are kept in a chunk of their own (NULL), which no stretch
    of time takes in; ``split_rejects`` sorts them out beforehand.
    """
    roles = resolve_roles(df, config)
    if roles.time is None:
        raise ValueError("chunks need an event time; max_speed has to be off")
    spark = df.sparkSession
    at = event_time_ms(df, roles.time)
    timed = df.withColumns({"_pt_at": at, "_pt_chunk": floor_to(at, UNIT_MS[unit])})
    ranges = ranges or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-input_bytes(df) // RANGE_BYTES))
    placed = range_sorted(timed, ["_pt_at", roles.key], unique=unique_key, ranges=ranges)
    messages = placed.select(*message_columns(df, config), F.col("_pt_chunk").alias("chunk"))
    messages.write.parquet(path)
    index_files(spark, path, messages.schema)
    return spark.read.schema(messages.schema).parquet(path)


def input_bytes(df: DataFrame) -> int:
    """Bytes that Spark expects ``df`` to have; the size of its files when nothing better is known."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def chunk_manifest(df: DataFrame) -> DataFrame:
    """Staged messages per chunk: how many, first and last event time."""
    return df.groupBy("chunk").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("event_time_ms").alias("first_ms"),
        F.max("event_time_ms").alias("last_ms"),
    )


def write_paced(
    chunks: DataFrame | ChunkFiles,
    sink: Sink,
    *,
    speed: float,
    slice_ms: int,
    log_path: str | None = None,
    at_once: int = UNDER_WAY,
    clock: Callable[[], float] = wall.monotonic,
    sleep: Callable[[float], None] = wall.sleep,
) -> int:
    """Send staged chunks in the rhythm of their event times; returns the number of slices sent.

    The driver only sees the slice table, in order and a partition at a time. It waits until a slice is
    due, measured from the first one so that delays do not add up, and starts one distributed write that
    reads no more than that slice; up to ``at_once`` of them run together, and none waits behind these. Of
    ``ChunkFiles`` a slice opens only the files it overlaps.

    With a ``log_path`` each sent slice is noted there by its stretch of event time, with the rows its write
    counted and how late the write began. A later call sends what no note covers, at whatever speed or length of
    slices it goes; notes and slices are walked through once. A slice that failed midway is
    sent again: a sink with a path holds a folder per stretch and replaces it, a Kafka topic may receive
    its messages twice, which ``numbered`` sinks and ``read_once`` make good. Messages without an event time have no place in the rhythm and are refused.
    """
    if not speed > 0 or slice_ms <= 0:
        raise ValueError(f"speed and slice_ms must be above 0, got {speed} and {slice_ms}")
    files = chunks if isinstance(chunks, ChunkFiles) else None
    if sink.numbered and not files:
        raise ValueError("numbers come from staged files; give them as ChunkFiles")
    rows = files.frame() if files else chunks
    log = DeliveryLog(rows.sparkSession, log_path) if log_path else None
    covered = Coverage(log.delivered() if log else [])
    started = first_due = None
    under_way: set[Future] = set()
    sent = 0

    def deliver(start: int, stop: int, due: int) -> None:
        late_ms = round((clock() - started) * 1000) - (due - first_due)
        messages = files.between(start, stop, numbered=sink.numbered) if files else between(rows, start, stop)
        written = send_measured(messages, sink.under(f"from_ms={start}"))
        if log:
            log.add({"from_ms": start, "to_ms": stop, "rows": written, "due_ms": due, "late_ms": late_ms})

    with ThreadPoolExecutor(at_once) as pool:
        # A slice without a number comes first.
        for one in replay_slices(rows, speed, slice_ms).orderBy("slice_id").toLocalIterator():
            if one["slice_id"] is None:
                raise ValueError(f"{one['rows']} messages have no event time; split_rejects sorts them out")
            for start, stop in covered.missing(one["from_ms"], one["to_ms"]):
                if files and not files.spans.overlapping(start, stop):
                    continue
                due = one["due_ms"] + round((start - one["from_ms"]) / speed)
                if started is None:
                    started, first_due = clock(), due
                under_way = _room(under_way, at_once)
                delay = (due - first_due) / 1000 - (clock() - started)
                if delay > 0:
                    sleep(delay)
                under_way.add(pool.submit(deliver, start, stop, due))
                sent += 1
    for last in under_way:
        last.result()
    return sent


def _room(under_way: set[Future], at_once: int) -> set[Future]:
    """The slices still on their way, once there are fewer than ``at_once``; the error of one that failed."""
    ended = {f for f in under_way if f.done()}
    if len(under_way) - len(ended) >= at_once:
        ended = wait(under_way, return_when=FIRST_COMPLETED).done
    for one in ended:
        one.result()
    return under_way - ended


class DeliveryLog:
    """Notes of sent slices as small JSON files, written without a Spark job; several make one file."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.loose: list[tuple[str, str]] = []
        self.lock = Lock()

    def delivered(self) -> list[tuple[int, int]]:
        """The stretches noted; as many as slices, so they follow the length of the day."""
        return [(r.from_ms, r.to_ms) for r in read_log(self.spark, self.path).select("from_ms", "to_ms").distinct().collect()]

    def add(self, note: dict) -> None:
        with self.lock:
            line = json.dumps(note)
            name = f"{self.path}/note-{uuid.uuid4().hex}.json"
            write_text(self.spark, name, line)
            self.loose.append((name, line))
            if len(self.loose) >= NOTES:
                write_text(self.spark, f"{self.path}/notes-{uuid.uuid4().hex}.json", "\n".join(x for _, x in self.loose))
                for name, _ in self.loose:
                    remove(self.spark, name)
                self.loose.clear()


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The slices a paced write has noted; none when there is no log yet."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], DELIVERY_LOG)
    # A note can be there twice when a write ended while notes were put together.
    return spark.read.schema(DELIVERY_LOG).json(path).distinct()


def check_sink(spark: SparkSession, sink: Sink) -> None:
    """Fail before any work is done when Spark does not know the sink's format."""
    try:
        spark.read.format(sink.format).load()
    except PySparkException as error:
        # Any other complaint, such as a missing path, comes from a format that is there.
        if "Failed to find data source" in str(error):
            raise RuntimeError(f"the connector for '{sink.format}' is not on the class path") from error
