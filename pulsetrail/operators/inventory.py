"""What a table holds: counts per group, totals, latest date, a few rows to look at."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsetrail.workspace import stage

# Only scans of the second kind of sources take aggregates.
AGGREGATES_IN_SCAN = {
    "spark.sql.sources.useV1SourceList": "",
    "spark.sql.parquet.aggregatePushdown": "true",
    "spark.sql.orc.aggregatePushdown": "true",
}


def inventory(df: DataFrame, by: str | Sequence[str], count_name: str = "cnt") -> DataFrame:
    """Rows per combination of the ``by`` columns, in their order."""
    names = [by] if isinstance(by, str) else list(by)
    return df.groupBy(*names).agg(F.count(F.lit(1)).alias(count_name)).orderBy(*names)


def day_profile(df: DataFrame, distinct: Sequence[str]) -> DataFrame:
    """One row: all rows as ``total`` and the number of distinct values per named column."""
    counts = [F.countDistinct(name).alias(f"distinct_{name}") for name in distinct]
    return df.agg(F.count(F.lit(1)).alias("total"), *counts)


def latest_date(df: DataFrame, date_column: str = "dt") -> DataFrame:
    """The latest date as one row."""
    return df.agg(F.max(date_column).alias(date_column))


def inventory_of_files(
    spark: SparkSession, format: str, path: str, by: Sequence[str], count_name: str = "cnt"
) -> DataFrame:
    """Rows per combination of partition columns ``by`` of Parquet or ORC files, from their footers alone.

    With all partition columns in ``by`` the aggregation is pushed into the scan, so no row is read; with fewer, rows
    are counted, still without reading any other column. The small result is written and read back, as the
    settings for it hold only while it runs.
    """
    with _aggregates_in_scan(spark):
        return stage(spark.read.format(format).load(path).groupBy(*by).agg(F.count(F.lit(1)).alias(count_name)), "inventory")


def latest_of_files(spark: SparkSession, format: str, path: str, column: str = "dt") -> DataFrame:
    """The largest value of a partition or plain column as one row, likewise from footers alone."""
    with _aggregates_in_scan(spark):
        return stage(spark.read.format(format).load(path).agg(F.max(column).alias(column)), "latest")


@contextmanager
def _aggregates_in_scan(spark: SparkSession) -> Iterator[None]:
    before = {name: spark.conf.get(name) for name in AGGREGATES_IN_SCAN}
    try:
        for name, value in AGGREGATES_IN_SCAN.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def preview(df: DataFrame, n: int, by: str | Sequence[str]) -> DataFrame:
    """The first ``n`` rows in the order of ``by``."""
    return df.orderBy(*([by] if isinstance(by, str) else by)).limit(n)


def param_count(df: DataFrame) -> DataFrame:
    """Rows of a trace table with the number of parameters, their names and values."""
    return df.select("lot_id", "eqp_id", "ts", F.size("param_name").alias("param_count"), "param_name", "param_value")
