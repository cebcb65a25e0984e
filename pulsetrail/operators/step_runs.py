"""Runs of one step on one machine, and which steps were merged from several runs.

A machine's samples in order of (time, step) fall into runs: as long as the step stays the same, a sample belongs to
the run of the one before. A summary has one row per machine and step however often the machine came back to it;
``step_merge_yn`` is 'Y' where that row merges more than one run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsetrail.functions.columns import column
from pulsetrail.operators import segments
from pulsetrail.operators.ordering import range_sorted
from pulsetrail.workspace import stage

MACHINE = ("eqp_id", "module_name")


def step_runs(trace: DataFrame, machine: Sequence[str] = MACHINE, *, step: str = "step_id", time: str = "ts") -> DataFrame:
    """One row per run: the machine's columns, the step, first_us, last_us and samples.

    Samples are put in one order by ranges, however much of them one machine has. A range tells its runs; its first
    and its last one may go on in the neighbouring ranges, and these two per range are put together in one task.
    NULL is a step like any other; samples without a time come first. Equal samples are samples of their own.
    """
    by = [*machine, step]
    us = F.unix_micros(column(time).cast("timestamp")).alias("_us")
    samples = trace.select(*[column(c).cast("string").alias(c) for c in by], us)
    in_order = range_sorted(samples, [*machine, "_us", step], unique=False)
    kinds = ", ".join(f"`{c}` string" for c in by)
    runs = stage(in_order.mapInArrow(segments.runs(by), f"{kinds}, {segments.RUNS}"), "step-runs")

    border = runs.filter("first_in_range OR last_in_range")
    order = Window.orderBy("part", "piece")
    same = F.lag("last_in_range").over(order) & F.col("first_in_range")
    for c in by:
        same = same & F.lag(c).over(order).eqNullSafe(F.col(c))
    linked = border.withColumn("_new", F.when(F.coalesce(same, F.lit(False)), 0).otherwise(1))
    joined = (
        linked.withColumn("_run", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*by, "_run")
        .agg(F.min("first_us").alias("first_us"), F.max("last_us").alias("last_us"), F.sum("samples").alias("samples"))
    )
    inner = runs.filter("NOT (first_in_range OR last_in_range)")
    columns = [*by, "first_us", "last_us", "samples"]
    return inner.select(*columns).unionByName(joined.select(*columns))


def step_merges(runs: DataFrame, machine: Sequence[str] = MACHINE, *, step: str = "step_id") -> DataFrame:
    """One row per machine and step of ``step_runs``: how many runs and samples, and step_merge_yn."""
    merged = runs.groupBy(*machine, step).agg(F.count(F.lit(1)).alias("runs"), F.sum("samples").alias("samples"))
    return merged.withColumn("step_merge_yn", F.when(F.col("runs") > 1, "Y").otherwise("N"))
