"""The given tables in the shape the replay and trace operators work on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsetrail.fixed_values import TRACE_COLUMNS


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events_with_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` with its date partition column ``dt``."""
    events = read_table(spark, sf_dir, "events")
    return events.withColumn("dt", F.date_format("ts", "yyyy-MM-dd"))


# What stands for each text column of a trace, in words that every SQL engine reads alike.
TRACE_TEXTS = {
    "eqp_id": "l_suppkey % 6",
    "module_name": "l_linestatus",
    "lot_cd": "l_partkey",
    "lot_id": "l_orderkey",
    "slot_id": "l_linenumber",
    "product_id": "l_partkey % 50",
    "oper_id": "l_linestatus",
    "oper_desc": "l_linestatus || ' line'",
    "recipe_id": "l_partkey % 12",
    "ppid": "l_suppkey % 9",
    "step_id": "l_returnflag",
    "step_name": "l_returnflag || ' step'",
    "batch_id": "l_orderkey % 64",
    "batch_type": "CASE WHEN l_discount > 0.05 THEN 'reduced' ELSE 'full' END",
    "zone": "l_linenumber % 2",
    "org_wf_id": "l_orderkey",
    "alias_lot_id": "l_orderkey * 10 + l_linenumber",
    "fdc_lot_cd": "l_partkey",
    "fab": "l_partkey % 4",
}
# The arrays, one element per parameter; open lines have all four, others all but the last.
TRACE_ELEMENTS = {
    "param_name": ("'quantity'", "'price'", "'discount'", "'tax'"),
    "param_alias": ("'units'", "'amount'", "'rebate'", "'duty'"),
    "param_svid": ("'q'", "'p'", "'d'", "'t'"),
    # A tax of zero is a text that is no number.
    "param_value": ("l_quantity", "l_extendedprice", "l_discount", "CASE WHEN l_tax = 0 THEN 'none' ELSE CAST(l_tax AS STRING) END"),
    "target": ("25", "50000", "'0.05'", "'0.04'"),
    "lsl": ("1", "900", "0", "0"),
    "lcl": ("5", "5000", "'0.01'", "'0.01'"),
    "ucl": ("45", "90000", "'0.09'", "'0.07'"),
    "usl": ("50", "105000", "'0.1'", "'0.08'"),
}


def trace_columns(array: str) -> dict[str, str]:
    """SQL for every trace column but its times, with ``array`` as the function that makes an array."""

    def text(expression: str) -> str:
        return f"CAST({expression} AS STRING)"

    def elements(items: tuple[str, ...]) -> str:
        every, fewer = ([text(i) for i in items[:n]] for n in (4, 3))
        return f"CASE WHEN l_linestatus = 'O' THEN {array}({', '.join(every)}) ELSE {array}({', '.join(fewer)}) END"

    return {
        **{name: text(e) for name, e in TRACE_TEXTS.items()},
        **{name: elements(items) for name, items in TRACE_ELEMENTS.items()},
        "spec_model_name": f"{array}({text('l_partkey % 30')})",
    }


def trace_of_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as equipment traces: one sample per line, three or four parameters each.

    The time is the ship date and a second of that day by the order; ``spec_model_name`` has one element only.
    """
    lines = read_table(spark, sf_dir, "lineitem")
    day = F.col("l_shipdate").cast("timestamp")
    ts = F.timestamp_seconds(F.unix_seconds(day) + F.col("l_orderkey") % 86400)
    times = {"ts": ts, "start_dtts": day, "create_dtts": ts, "dt": F.date_format("l_shipdate", "yyyy-MM-dd")}
    columns = {name: F.expr(e) for name, e in trace_columns("array").items()} | times
    return lines.select(*[columns[name].alias(name) for name in TRACE_COLUMNS])
