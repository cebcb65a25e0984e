"""Rows to messages."""

import json
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from pulsetrail.config import ReplayConfig
from pulsetrail.operators.envelope import envelope, split_rejects


def pressure_only(columns):
    """An encoder of the caller's own: one column out of those handed over."""
    assert len(columns) == 2
    return F.concat(columns[1].cast("string"), F.lit(" hPa")).cast("binary")


def test_own_encoder_gets_all_but_key_and_time(spark):
    readings = spark.createDataFrame(
        [(17, 86_400_250, "north", 1013), (4, -5, None, 998)], "station int, measured bigint, side string, pressure int"
    )
    timed = ReplayConfig(key_column="station", time_column="measured")
    messages = envelope(readings, timed, pressure_only)
    assert messages.columns == ["key", "value", "event_time_ms"]
    assert sorted(map(tuple, messages.collect())) == [("17", b"1013 hPa", 86_400_250), ("4", b"998 hPa", -5)]


def test_full_speed_messages_have_no_time(spark):
    readings = spark.createDataFrame([("s9", "south", 1001)], "eqp_id string, side string, pressure int")
    messages = envelope(readings, ReplayConfig(max_speed=True), pressure_only)
    assert messages.columns == ["key", "value"] and messages.first()["key"] == "s9"


def test_milliseconds_are_kept(spark):
    df = spark.createDataFrame([("k", datetime(2024, 1, 1, 0, 0, 0, 877_999), 1)], "lot_id string, ts timestamp, x int")
    assert envelope(df, ReplayConfig()).first()["event_time_ms"] == 1_704_067_200_877
    wall_clock = df.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    assert envelope(wall_clock, ReplayConfig()).first()["event_time_ms"] == 1_704_067_200_877


def test_times_of_other_types_are_refused(spark):
    df = spark.createDataFrame([("k", "2024-01-01", 1)], "lot_id string, ts string, x int")
    with pytest.raises(ValueError, match="time column 'ts' has type string"):
        envelope(df, ReplayConfig())


def test_json_holds_every_type(spark):
    df = spark.range(1).select(
        F.lit("k").alias("lot_id"),
        F.array(F.lit("a"), F.lit(None)).alias("list"),
        F.struct(F.lit(1).alias("n"), F.lit("x").alias("s")).alias("nested"),
        F.create_map(F.lit("m"), F.lit(2)).alias("map"),
        F.lit(Decimal("1.50")).alias("amount"),
        F.lit("2024-01-01").cast("date").alias("day"),
        F.lit(b"ab").alias("bytes"),
        F.lit(None).cast("string").alias("nothing"),
        F.lit(3).alias("dotted.name"),
    )
    value = json.loads(envelope(df, ReplayConfig(max_speed=True)).first()["value"])
    assert value == {
        "list": ["a", None],
        "nested": {"n": 1, "s": "x"},
        "map": {"m": 2},
        "amount": 1.5,
        "day": "2024-01-01",
        "bytes": "YWI=",
        "dotted.name": 3,
    }


def test_key_forms(spark):
    df = spark.createDataFrame([(7, "a")], "lot_id int, x string")

    def key(**settings):
        return bytes(envelope(df, ReplayConfig(max_speed=True, **settings)).first()["key"])

    assert envelope(df, ReplayConfig(max_speed=True)).first()["key"] == "7"
    assert envelope(df, ReplayConfig(max_speed=True, key_literal="test-key")).first()["key"] == "test-key"
    assert key(key_format="json") == b'{"lot_id":7}'


def test_payload_as_it_is(spark):
    df = spark.createDataFrame([("k", '{"a": 1}', "b")], "event_key string, payload string, other string")
    config = ReplayConfig(max_speed=True, value_format="binary")
    assert bytes(envelope(df, config).first()["value"]) == b'{"a": 1}'
    with pytest.raises(ValueError, match="column 'payload'"):
        envelope(df.drop("payload"), config)


def test_nothing_left_for_the_value(spark):
    with pytest.raises(ValueError, match="no column is left"):
        envelope(spark.createDataFrame([("k",)], "lot_id string"), ReplayConfig(max_speed=True))


def test_connector_formats_name_what_is_missing(spark, tmp_path):
    df = spark.createDataFrame([("k", "a")], "lot_id string, x string")
    schema = '{"type":"record","name":"E","fields":[{"name":"x","type":"string"}]}'
    with pytest.raises(AnalysisException, match="spark-avro"):
        envelope(df, ReplayConfig(max_speed=True, value_format="avro", value_schema=schema))
    descriptor = tmp_path / "event.desc"
    descriptor.write_bytes(b"")
    settings = {"value_format": "protobuf", "value_schema": "E", "value_descriptor": str(descriptor)}
    with pytest.raises(AnalysisException, match="(?i)protobuf"):
        envelope(df, ReplayConfig(max_speed=True, **settings))


def test_values_stay_with_their_keys(spark):
    """Also where the partitioning is uneven and shuffled."""
    df = spark.range(5000).select(F.col("id").alias("lot_id"), (F.col("id") * 3).alias("x")).repartition(7).distinct()
    parsed = envelope(df, ReplayConfig(max_speed=True)).select(
        F.col("key").cast("bigint").alias("k"), F.get_json_object(F.col("value").cast("string"), "$.x").cast("bigint").alias("x")
    )
    assert parsed.filter("x <> k * 3").count() == 0
    assert parsed.count() == 5000


def test_envelope_is_one_scan_without_shuffle(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plan = envelope(df, ReplayConfig(key_column="event_id"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert "Exchange" not in plan and "Join" not in plan


def test_rejects(spark):
    rows = [("a", 1, "x"), (None, 2, "x"), ("b", None, "x"), (None, None, "x")]
    df = spark.createDataFrame(rows, "event_key string, event_time bigint, data string")
    good, rejected = split_rejects(df, ReplayConfig())
    assert [tuple(r) for r in good.collect()] == [("a", 1, "x")]
    reasons = sorted((r["event_key"] or "-", r["event_time"] or 0, r["reason"]) for r in rejected.collect())
    assert reasons == [("-", 0, "null_key"), ("-", 2, "null_key"), ("b", 0, "null_event_time")]
    good, rejected = split_rejects(df, ReplayConfig(max_speed=True))
    assert (good.count(), rejected.count()) == (2, 2)
    good, rejected = split_rejects(df, ReplayConfig(max_speed=True, key_literal="k"))
    assert (good.count(), rejected.count()) == (4, 0)
