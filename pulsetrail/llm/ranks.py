"""Places of rows within groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsetrail.operators.ordering import staged_in_order
from pulsetrail.workspace import stage


def ranked(df: DataFrame, by: Sequence[str], order: Sequence[str], label: str) -> DataFrame:
    """``df`` with ``place``, the row's number from 0 in its group ``by`` in the given order.

    Rows are written once in order of group and ``order`` and counted per written range, so a group of
    any size is spread over tasks; a window only sees a row per group and range. The columns ``by`` hold
    no NULL.
    """
    rows = staged_in_order(df, [*by, *order], unique=False, label=label)
    # The rows of a group lie together in each written range.
    parts = rows.groupBy(*by, "_pt_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_pt_place").alias("_first"))
    earlier = Window.partitionBy(*by).orderBy("_pt_part").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")
    starts = stage(parts.select(*by, "_pt_part", start.alias("_start")), f"{label}-starts")
    placed = rows.join(starts, [*by, "_pt_part"]).withColumn("place", F.col("_start") + F.col("_pt_place"))
    return placed.drop("_pt_part", "_pt_place", "_start")
