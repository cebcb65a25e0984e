"""Global order, rank and running totals without putting all rows into one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsetrail.functions.columns import column, floor_to
from pulsetrail.workspace import stage

# monotonically_increasing_id() puts the row's place within its partition into the lower 33 bits.
PLACE_BITS = 33


def range_sorted(df: DataFrame, order: Sequence[str], *, unique: bool, ranges: int | None = None) -> DataFrame:
    """``df`` range-partitioned and sorted by ``order``.

    Equal sort keys always share a range, so copies could pile up in one. Unless ``order`` is ``unique``,
    two more sort keys tell such rows apart: a hash of the row, and for full copies a number given in
    sorted order within the input partition, so that a task that runs again numbers them the same way.
    Sort keys should be short, as a sample of them goes through the driver. With a number of ``ranges``
    small ones are not merged.
    """
    keys = list(order)
    if not unique:
        df = tell_apart(df, order)
        keys += ["_pt_row", "_pt_copy"]
    split = df.repartitionByRange(ranges, *keys) if ranges else df.repartitionByRange(*keys)
    return split.sortWithinPartitions(*keys).drop("_pt_row", "_pt_copy")


def tell_apart(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """``df`` with the two further sort keys ``_pt_row`` and ``_pt_copy``."""
    row = F.xxhash64(*[column(name) for name, kind in df.dtypes if "map<" not in kind])
    in_order = df.withColumn("_pt_row", row).sortWithinPartitions(*order, "_pt_row")
    return in_order.withColumn("_pt_copy", F.monotonically_increasing_id())


def staged_in_order(
    df: DataFrame, order: Sequence[str], *, unique: bool, label: str, ranges: int | None = None
) -> DataFrame:
    """``df`` written out in global order, with the number of its range (``_pt_part``) and the place in it
    (``_pt_place``, from 0).

    The range limits come from a sample and would differ if they were drawn twice; the written table
    makes sure that counting the ranges and reading them back sees the same ones.
    """
    rows = range_sorted(df, order, unique=unique, ranges=ranges)
    return (
        stage(rows.withColumn("_pt_at", F.monotonically_increasing_id()), label)
        .withColumn("_pt_part", F.shiftright("_pt_at", PLACE_BITS))
        .withColumn("_pt_place", F.col("_pt_at").bitwiseAND((1 << PLACE_BITS) - 1))
        .drop("_pt_at")
    )


def global_rank(
    df: DataFrame,
    order: str = "event_time_ms",
    tiebreak: Sequence[str] = ("key",),
    *,
    unique: bool = False,
    ranges: int | None = None,
) -> DataFrame:
    """``df`` with ``rank``, the row's number from 1 in the order of ``order`` and ``tiebreak``.

    Rows that agree in these columns are ranked by a hash of the row. Pass ``unique=True`` when no two do;
    it saves a local sort. Without a number of ``ranges`` there are as many as shuffle partitions.
    """
    rows = staged_in_order(df, [order, *tiebreak], unique=unique, label="rank", ranges=ranges)
    # One row per written range, so its size is bounded by their number and not by the data.
    sizes = rows.groupBy("_pt_part").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.orderBy("_pt_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_pt_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_pt_start"))
    return (
        rows.join(F.broadcast(starts), "_pt_part")
        .withColumn("rank", F.col("_pt_start") + F.col("_pt_place") + 1)
        .drop("_pt_part", "_pt_place", "_pt_start")
    )


def running_totals(df: DataFrame, order: str, totals: Mapping[str, str], width: int) -> DataFrame:
    """``df`` with running sums over the whole table, up to and including the row.

    ``order`` is a bigint column without repeats, so a block of ``width`` consecutive numbers holds at
    most ``width`` rows: each block is summed by one task, and only the block totals, one row per block,
    are added up in a single task. ``totals`` maps a value column to the name of its running sum; the sum
    over all rows comes along under that name with ``_total``.
    """
    blocked = df.withColumn("_pt_block", floor_to(F.col(order), width))
    sums = blocked.groupBy("_pt_block").agg(*[F.sum(v).alias(f"_pt_sum_{v}") for v in totals])
    every = Window.partitionBy()
    earlier = Window.orderBy("_pt_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        "_pt_block",
        *[F.coalesce(F.sum(f"_pt_sum_{v}").over(earlier), F.lit(0)).alias(f"_pt_start_{v}") for v in totals],
        *[F.sum(f"_pt_sum_{v}").over(every).alias(f"{out}_total") for v, out in totals.items()],
    )
    so_far = Window.partitionBy("_pt_block").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    inner = {out: F.sum(v).over(so_far) for v, out in totals.items()}
    outer = {out: F.col(out) + F.col(f"_pt_start_{v}") for v, out in totals.items()}
    # Every block has a start. As a left join it puts no condition on the rows, so that both sides keep
    # the same plan for ``df`` and Spark runs it once.
    joined = blocked.withColumns(inner).join(starts, "_pt_block", "left").withColumns(outer)
    return joined.drop("_pt_block", *[f"_pt_start_{v}" for v in totals])
