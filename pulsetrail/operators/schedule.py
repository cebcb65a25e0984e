"""When each row, batch or slice of an ordered day is due.

Rows without an event time have no place in a schedule. They stay in every result, with NULL for what
depends on the time: as rows of the schedule, as one batch and one slice without a number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsetrail.fixed_values import MAX_PAUSE_S, MIN_PAUSE_S
from pulsetrail.functions.columns import UNIT_MS
from pulsetrail.operators.ordering import running_totals

# Running totals of one row per millisecond go by the hour, those of batches by this many batches.
BATCH_BLOCK = 100_000
# A run of batches that begin and end within one millisecond is unrolled in strides of this many.
STRIDE = 4096


def replay_schedule(df: DataFrame, speed: float, time: str = "event_time_ms") -> DataFrame:
    """``df`` with ``due_ms``, the time after the start of the replay at which the row is due.

    It is measured from the first event of the whole table, so gaps keep their length at every scale
    and errors do not add up. One pass plus a minimum; no sort.
    """
    first = df.agg(F.min(time)).scalar()
    return df.withColumn("due_ms", F.floor((F.col(time) - first) / F.lit(float(speed))))


def replay_batches(df: DataFrame, batch_size: int, speed: float, time: str = "event_time_ms") -> DataFrame:
    """The ordered rows cut into batches of ``batch_size``: size, first and last event time, pause after.

    Columns: batch_id (from 0), rows, first_ms, last_ms, pause_s. The pause is the time from the last
    event of the previous batch to that of this one, divided by ``speed``, in whole seconds within the
    fixed limits.

    Which rows share a millisecond does not matter for any of these, so only a count per millisecond is
    shuffled and ranked. However many rows fall on one millisecond, they are a single row until it is cut
    into batches, which is spread over tasks.
    """
    counts = df.groupBy(F.col(time).alias("ms")).agg(F.count(F.lit(1)).alias("n"))
    none = F.lit(None).cast("bigint")
    untimed = counts.filter("ms IS NULL").select(
        none.alias("batch_id"),
        F.col("n").alias("rows"),
        *[none.alias(name) for name in ("first_ms", "last_ms", "pause_s")],
    )
    ranked = running_totals(counts.filter("ms IS NOT NULL"), "ms", {"n": "upto"}, UNIT_MS["hour"])

    size = F.lit(int(batch_size)).cast("bigint")
    spans = ranked.select(
        "ms",
        "upto",
        (F.col("upto") - F.col("n")).alias("start"),
        _div(F.col("upto") - F.col("n"), size).alias("from_batch"),
        _div(F.col("upto") - 1, size).alias("to_batch"),
    )
    strides = spans.withColumn("stride", F.explode(F.sequence("from_batch", "to_batch", F.lit(STRIDE).cast("bigint"))))
    strides = strides.repartition("stride")
    stride_end = F.least(F.col("stride") + (STRIDE - 1), F.col("to_batch"))
    pieces = strides.withColumn("batch_id", F.explode(F.sequence(F.col("stride"), stride_end)))

    # Each piece counts for its batch; the one that fills a batch also tells the next batch its time.
    end = (F.col("batch_id") + 1) * size
    own = F.struct(
        F.col("batch_id"),
        (F.least(end, "upto") - F.greatest(F.col("batch_id") * size, F.col("start"))).alias("rows"),
        F.col("ms").alias("ms"),
        F.lit(None).cast("bigint").alias("previous_ms"),
    )
    for_next = F.struct(
        (F.col("batch_id") + 1).alias("batch_id"),
        F.lit(0).cast("bigint").alias("rows"),
        F.lit(None).cast("bigint").alias("ms"),
        F.col("ms").alias("previous_ms"),
    )
    parts = F.when(F.col("upto") >= end, F.array(own, for_next)).otherwise(F.array(own))
    batches = (
        pieces.select(F.inline(parts))
        .groupBy("batch_id")
        .agg(
            F.sum("rows").alias("rows"),
            F.min("ms").alias("first_ms"),
            F.max("ms").alias("last_ms"),
            F.max("previous_ms").alias("previous_ms"),
        )
        .filter("rows > 0")
    )
    gap_ms = F.col("last_ms") - F.coalesce("previous_ms", "first_ms")
    timed = batches.select("batch_id", "rows", "first_ms", "last_ms", _pause(gap_ms, speed).alias("pause_s"))
    return timed.unionByName(untimed)


def replay_progress(batches: DataFrame) -> DataFrame:
    """Planned progress after each batch and its pause: rows sent, percent, seconds, rows per second.

    The percentage is of all rows; those without a time are never sent and show as a batch of their own.
    """
    every = batches.agg(F.sum("rows")).scalar()
    timed = batches.filter("batch_id IS NOT NULL")
    run = running_totals(timed, "batch_id", {"rows": "sent", "pause_s": "elapsed_s"}, BATCH_BLOCK)
    progress = run.select(
        "batch_id",
        "rows",
        "sent",
        (F.col("sent") * 100.0 / every).alias("percent"),
        "elapsed_s",
        F.when(F.col("elapsed_s") > 0, F.col("sent") / F.col("elapsed_s")).alias("rows_per_s"),
    )
    untimed = batches.filter("batch_id IS NULL").select("batch_id", "rows")
    return progress.unionByName(untimed, allowMissingColumns=True)


def replay_slices(df: DataFrame, speed: float, slice_ms: int, time: str = "event_time_ms") -> DataFrame:
    """Stretches of event time that take about ``slice_ms`` to replay; empty ones are left out.

    Columns: slice_id, from_ms (inclusive), to_ms (exclusive), rows, due_ms. A slice is sent by one
    Spark job, so their number follows the length of the day and not its rows.
    """
    span = event_span_ms(speed, slice_ms)
    first = df.agg(F.min(time)).scalar()
    counted = (
        df.select(_div(F.col(time) - first, F.lit(span).cast("bigint")).alias("slice_id"))
        .groupBy("slice_id")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    from_ms = first + F.col("slice_id") * span
    return counted.select(
        "slice_id",
        from_ms.alias("from_ms"),
        (from_ms + span).alias("to_ms"),
        "rows",
        F.floor(F.col("slice_id") * span / F.lit(float(speed))).alias("due_ms"),
    )


def event_span_ms(speed: float, slice_ms: int) -> int:
    """Event time covered by one slice."""
    return max(1, round(slice_ms * speed))


def pending_slices(slices: DataFrame, delivered: DataFrame) -> DataFrame:
    """Slices whose stretch of time the delivery log (from_ms, to_ms) does not hold yet.

    Numbers of slices mean nothing across logs, as they depend on speed and length.
    """
    return slices.join(delivered.select("from_ms", "to_ms").distinct(), ["from_ms", "to_ms"], "left_anti").select(*slices.columns)


class Coverage:
    """Stretches of time that are done, to be asked for what is missing in ascending order.

    They are sorted and put together once, and looked at from where the last question ended.
    """

    def __init__(self, done: Sequence[tuple[int, int]]):
        self.done: list[tuple[int, int]] = []
        for start, stop in sorted(done):
            if self.done and start <= self.done[-1][1]:
                start, stop = self.done[-1][0], max(stop, self.done.pop()[1])
            self.done.append((start, stop))
        self.at = 0

    def missing(self, start: int, stop: int) -> list[tuple[int, int]]:
        """What of the stretch from ``start`` to ``stop`` is not done; it begins no earlier than the last one asked for."""
        while self.at < len(self.done) and self.done[self.at][1] <= start:
            self.at += 1
        out, after = [], self.at
        while after < len(self.done) and self.done[after][0] < stop:
            a, b = self.done[after]
            if a > start:
                out.append((start, a))
            start = b
            after += 1
        return [*out, (start, stop)] if start < stop else out


def _pause(gap_ms: Column, speed: float) -> Column:
    seconds = (gap_ms / F.lit(float(speed)) / F.lit(1000.0)).cast("bigint")
    return F.greatest(F.least(seconds, F.lit(MAX_PAUSE_S).cast("bigint")), F.lit(MIN_PAUSE_S).cast("bigint"))


def _div(dividend: Column, divisor: Column) -> Column:
    return F.call_function("div", dividend, divisor)
