"""Replay of staged chunks as a stream of micro-batches."""

from __future__ import annotations

import re
import time as wall

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from pulsetrail.config import Sink
from pulsetrail.operators.messages import write_messages
from pulsetrail.sources.chunk_files import ChunkFiles
from pulsetrail.sources.event_time_stream import EventTimeChunks


def stream_replay(
    spark: SparkSession,
    chunks_path: str,
    sink: Sink,
    checkpoint: str,
    *,
    files_per_trigger: int = 1,
    every: str | None = None,
) -> StreamingQuery:
    """Deliver staged chunks file by file and remember in ``checkpoint`` what is done.

    Without ``every`` it delivers what is there and stops; with an interval such as "10 seconds" it starts
    a micro-batch at that rhythm. A restart goes on where the last run ended. A sink with a path holds a
    folder per micro-batch and replaces it, so a repeated one leaves no copies; Kafka may receive them.
    Files come in the order of their writing, not of event time; ``stream_by_time`` goes by that.
    """

    def deliver(messages: DataFrame, epoch: int) -> None:
        write_messages(messages, sink.under(f"epoch={epoch}"))

    schema = spark.read.parquet(chunks_path).schema
    chunks = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(chunks_path)
    writer = chunks.writeStream.foreachBatch(deliver).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def stream_by_time(
    spark: SparkSession,
    chunks_path: str,
    sink: Sink,
    checkpoint: str,
    *,
    span_ms: int,
    speed: float | None = None,
) -> StreamingQuery:
    """Deliver what ``prepare_chunks`` has staged as micro-batches in the order of event time.

    A micro-batch holds the messages of at most ``span_ms`` of event time, and with a ``speed`` none begins before
    its time has come: event time is let in ``speed`` times as fast as time passes. The checkpoint holds event
    times as offsets. A restart goes on after the last batch and repeats one that was not finished with the same
    messages; a sink with a path holds a folder per micro-batch (``epoch``) and replaces it, Kafka may receive
    copies. Messages without an event time are refused. ``run_to_end`` waits for the last one.
    """
    staged = ChunkFiles(spark, chunks_path)
    if staged.untimed:
        raise ValueError(f"{staged.untimed} messages have no event time; split_rejects sorts them out")
    spark.dataSource.register(EventTimeChunks)
    options = {"path": chunks_path, "span_ms": str(span_ms), "checkpoint": checkpoint}
    if speed is not None:
        options["speed"] = str(speed)
    messages = spark.readStream.format("event_time_chunks").options(**options).load()

    def deliver(batch: DataFrame, epoch: int) -> None:
        write_messages(batch, sink.under(f"epoch={epoch}"))

    return messages.writeStream.foreachBatch(deliver).option("checkpointLocation", checkpoint).start()


def run_to_end(query: StreamingQuery, chunks: ChunkFiles, poll_s: float = 0.2) -> None:
    """Wait until a ``stream_by_time`` has delivered the last message, then stop it."""
    end = None if chunks.spans.last_ms is None else chunks.spans.last_ms + 1
    try:
        while end is not None and query.exception() is None and _reached(query) < end:
            wall.sleep(poll_s)
        if query.exception() is not None:
            raise query.exception()
    finally:
        query.stop()


def _reached(query: StreamingQuery) -> float:
    """The event time up to which batches are done."""
    last = query.lastProgress
    # The offset is shown as text whose only number is the time.
    shown = re.search(r"-?\d+", str(last["sources"][0]["endOffset"])) if last else None
    return int(shown[0]) if shown else float("-inf")
