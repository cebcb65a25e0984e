"""What was sent against what arrived, and how a paced write went."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsetrail.operators.ordering import running_totals

# Running totals of notes go by this many milliseconds of the write.
LOG_BLOCK = 3_600_000


def reconcile(sent: DataFrame, delivered: DataFrame, key: str = "key") -> DataFrame:
    """Per key the rows sent, the rows delivered and how many are ``missing`` (below 0: delivered twice).

    Both sides go through one aggregation that combines before its shuffle, so a key that holds much of
    the data costs one row per task.
    """
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    both = sent.select(key, one.alias("sent"), none.alias("delivered")).unionByName(
        delivered.select(key, none.alias("sent"), one.alias("delivered"))
    )
    totals = both.groupBy(key).agg(F.sum("sent").alias("sent"), F.sum("delivered").alias("delivered"))
    return totals.withColumn("missing", F.col("sent") - F.col("delivered"))


def delivery_progress(log: DataFrame, total: int | None = None) -> DataFrame:
    """How far a paced write was after each slice, from its log: rows, sent, percent (of ``total`` rows, or of
    those in the log), elapsed_s since the first start and rows per second."""
    notes = log.select("from_ms", "rows", "due_ms", "late_ms")
    first = notes.agg(F.min(F.col("due_ms") + F.col("late_ms"))).scalar()
    # A stretch of event time is in the log once, so its start puts the notes in order.
    run = running_totals(notes, "from_ms", {"rows": "sent"}, LOG_BLOCK)
    every = F.col("sent_total") if total is None else F.lit(total)
    elapsed = (F.col("due_ms") + F.col("late_ms") - first) / 1000
    return run.select(
        "from_ms",
        "rows",
        "sent",
        (F.col("sent") * 100.0 / every).alias("percent"),
        elapsed.alias("elapsed_s"),
        F.when(elapsed > 0, F.col("sent") / elapsed).alias("rows_per_s"),
    )


def delivery_report(log: DataFrame) -> DataFrame:
    """One row about a paced write from its log: slices, rows, seconds from the first to the last start,
    rows per second, and the longest delay of a start. Time between two runs does not count.
    """
    started = F.col("due_ms") + F.col("late_ms")
    seconds = (F.max(started) - F.min(started)) / 1000
    return log.agg(
        F.count(F.lit(1)).alias("slices"),
        F.sum("rows").alias("rows"),
        seconds.alias("seconds"),
        F.when(seconds > 0, F.sum("rows") / seconds).alias("rows_per_s"),
        F.max("late_ms").alias("latest_ms"),
    )
