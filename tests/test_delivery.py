"""Sources, sinks, staged chunks, paced and streamed delivery, and the whole replay."""

import json
import time as wall
from dataclasses import replace
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from pulsetrail import workspace
from pulsetrail.config import ReplayConfig, Sink
from pulsetrail.operators import content, messages
from pulsetrail.operators.content import digests, reconcile_content
from pulsetrail.operators.delivery import delivery_progress, delivery_report, reconcile
from pulsetrail.operators.envelope import envelope, plain_columns, split_rejects
from pulsetrail.operators.messages import (
    chunk_manifest,
    check_sink,
    prepare_chunks,
    read_log,
    write_messages,
    write_paced,
    write_to,
)
from pulsetrail.operators.retry import RetryPolicy, retry_rejects
from pulsetrail.operators.schedule import replay_slices
from pulsetrail.plans.replay import run_replay
from pulsetrail.sources.chunk_files import ChunkFiles
from pulsetrail.sources.event_time_stream import EventTimeReader
from pulsetrail.sources.tables import load_chunks, load_day, load_path, lookup_schema, read_delivered, read_once
from pulsetrail.streaming import stream_replay as stream_module
from pulsetrail.streaming.stream_replay import run_to_end, stream_by_time, stream_replay

HOUR = 3_600_000
CONFIG = ReplayConfig(source_table="db.events")
BASE = datetime(2024, 1, 1)


class Clock:
    """Time that passes while sleeping, and a little with every look."""

    def __init__(self):
        self.now, self.naps = 0.0, []

    def __call__(self):
        self.now += 0.001
        return self.now

    def sleep(self, seconds):
        self.naps.append(seconds)
        self.now += seconds


def events(spark, n=600):
    """A third of the rows in one hour under one key, the rest over ten hours."""
    s = F.col("id")
    ms = F.when(s % 3 == 0, 4 * HOUR + s).otherwise(s * 60_000)
    return spark.range(n).select(
        F.when(s % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), s.cast("string"))).alias("event_key"),
        (ms + 1_704_067_200_000).alias("event_time"),
        s.alias("n"),
        F.lit("2024-01-01").alias("dt"),
    )


def contents(df):
    return sorted((r["key"] or "", bytes(r["value"])) for r in df.select("key", "value").collect())


# --- sources ----------------------------------------------------------------------------------------


def test_day_of_a_partitioned_table_reads_its_folder_only(spark):
    rows = spark.range(30).select(
        "id", F.concat(F.lit("2024-01-0"), (F.col("id") % 3 + 1).cast("string")).alias("dt"), (F.col("id") % 2).cast("string").alias("fab")
    )
    rows.write.partitionBy("dt", "fab").format("orc").mode("overwrite").saveAsTable("day_table")
    day = load_day(spark, "day_table", "2024-01-02")
    assert day.count() == 10
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "DataFilters: []" in plan
    assert load_day(spark, "day_table", "2024-01-02", equal={"fab": "1"}).count() == 5
    assert load_day(spark, "day_table", "2023-01-01").count() == 0


def test_files_as_source(spark, tmp_path):
    events(spark).write.partitionBy("dt").orc(str(tmp_path / "orc"))
    assert load_path(spark, "orc", str(tmp_path / "orc"), "2024-01-01").count() == 600
    assert load_path(spark, "orc", str(tmp_path / "orc"), "2024-01-02").count() == 0
    assert load_path(spark, "orc", str(tmp_path / "orc")).count() == 600


def test_csv_of_one_day(spark, tmp_path):
    write_to(events(spark), Sink("csv", str(tmp_path / "csv"), "overwrite", {"header": "true"}))
    back = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert back.columns == ["event_key", "event_time", "n", "dt"] and back.count() == 600


def test_schema_lookup(spark):
    schemas = spark.createDataFrame([("events.value", "{}"), ("trace.value", "[]")], "artifact string, content string")
    assert lookup_schema(schemas, "trace.value") == "[]"
    with pytest.raises(ValueError, match="no schema named 'other.value'"):
        lookup_schema(schemas, "other.value")
    twice = schemas.unionByName(spark.createDataFrame([("trace.value", "other")], schemas.schema))
    with pytest.raises(ValueError, match="several schemas named 'trace.value'"):
        lookup_schema(twice, "trace.value")


# --- writing ----------------------------------------------------------------------------------------


def test_written_messages_come_back(spark, tmp_path):
    messages = envelope(events(spark), CONFIG)
    write_messages(messages, Sink("parquet", str(tmp_path / "topic")))
    delivered = read_delivered(spark, "parquet", str(tmp_path / "topic"))
    assert dict(delivered.dtypes) == {"key": "string", "value": "binary"}
    assert contents(delivered) == contents(messages)
    assert reconcile(messages, delivered).filter("missing <> 0").count() == 0


def test_binary_keys_stay_binary(spark, tmp_path):
    write_messages(envelope(events(spark), ReplayConfig(key_format="json")), Sink("parquet", str(tmp_path / "topic")))
    assert dict(spark.read.parquet(str(tmp_path / "topic")).dtypes)["key"] == "binary"


def test_unknown_sink_is_refused_at_once(spark):
    with pytest.raises(RuntimeError, match="connector for 'kafka'"):
        check_sink(spark, Sink("kafka", options={"kafka.bootstrap.servers": "x:9092", "topic": "t"}))
    check_sink(spark, Sink("parquet", "/nowhere"))
    check_sink(spark, Sink("json", "/nowhere"))
    check_sink(spark, Sink("noop"))


def test_reconcile_counts_lost_repeated_and_null_keys(spark):
    sent = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "key string")
    delivered = spark.createDataFrame([("a",), ("b",), ("b",), ("c",), (None,)], "key string")
    rows = {r["key"]: (r["sent"], r["delivered"], r["missing"]) for r in reconcile(sent, delivered).collect()}
    assert rows == {"a": (2, 1, 1), "b": (1, 2, -1), "c": (0, 1, -1), None: (1, 1, 0)}


# --- chunks -----------------------------------------------------------------------------------------


@pytest.mark.parametrize("unique_key", [True, False])
def test_chunks(spark, tmp_path, unique_key):
    path = str(tmp_path / "chunks")
    staged = prepare_chunks(events(spark), path, CONFIG, unique_key=unique_key)
    messages = envelope(events(spark), CONFIG)
    assert contents(staged) == contents(messages)
    assert staged.filter("event_time_ms < chunk OR event_time_ms >= chunk + 3600000").count() == 0
    manifest = {r["chunk"]: tuple(r)[1:] for r in chunk_manifest(staged).collect()}
    by_hour = messages.groupBy((F.col("event_time_ms") - F.col("event_time_ms") % HOUR).alias("c")).agg(
        F.count("*").alias("n"), F.min("event_time_ms").alias("a"), F.max("event_time_ms").alias("z")
    )
    assert manifest == {r["c"]: (r["n"], r["a"], r["z"]) for r in by_hour.collect()}
    files = staged.select(F.input_file_name().alias("f"), "event_time_ms").collect()
    seen = {}
    for row in files:
        assert seen.get(row["f"], 0) <= row["event_time_ms"]
        seen[row["f"]] = row["event_time_ms"]


def test_busy_hour_is_spread_over_files(spark, tmp_path):
    same = spark.range(4000).select(
        F.lit("hot").alias("event_key"), F.lit(1_704_067_200_000).alias("event_time"), F.lit(1).alias("n")
    )
    staged = prepare_chunks(same, str(tmp_path / "chunks"), CONFIG)
    sizes = [r["count"] for r in staged.groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 4000 and len(sizes) >= 6 and max(sizes) < 1500


def test_a_stretch_opens_its_files_only(spark, tmp_path):
    path = str(tmp_path / "chunks")
    prepare_chunks(events(spark), path, CONFIG)
    start, files = 1_704_067_200_000, ChunkFiles(spark, path)
    spans = files.spans.spans
    assert sum(s.rows for s in spans) == 600 and len(spans) == 8 and max(s.rows for s in spans) < 150
    assert all(a.last_ms <= b.first_ms for a, b in zip(spans, spans[1:]))
    part = load_chunks(spark, path, start + HOUR + 5, start + 2 * HOUR + 5)
    opened = {f.rsplit("/", 1)[-1] for f in part.inputFiles()}
    assert opened == {s.name for s in spans if s.last_ms >= start + HOUR + 5 and s.first_ms < start + 2 * HOUR + 5}
    assert len(opened) < 8
    assert "PushedFilters: [IsNotNull(event_time_ms)" in part._jdf.queryExecution().executedPlan().toString()
    times = [r["event_time_ms"] for r in load_chunks(spark, path).collect()]
    assert part.count() == sum(start + HOUR + 5 <= t < start + 2 * HOUR + 5 for t in times) > 0
    assert load_chunks(spark, path, to_ms=start).count() == load_chunks(spark, path, start + 24 * HOUR).count() == 0
    with pytest.raises(ValueError, match="no list of its files"):
        ChunkFiles(spark, str(tmp_path / "other"))


def test_quiet_hours_share_a_file(spark, tmp_path):
    sparse = spark.range(720).select(
        F.lit("k").alias("event_key"), (F.col("id") * HOUR).alias("event_time"), F.lit(1).alias("n")
    )
    staged = prepare_chunks(sparse, str(tmp_path / "chunks"), CONFIG)
    assert len(staged.inputFiles()) == 8 and chunk_manifest(staged).count() == 720


def test_rows_without_a_time_have_their_own_chunk(spark, tmp_path):
    path = str(tmp_path / "chunks")
    df = events(spark).withColumn("event_time", F.when(F.col("n") % 4 != 0, F.col("event_time")))
    staged = prepare_chunks(df, path, CONFIG)
    assert staged.count() == 600
    lost = chunk_manifest(staged).filter("chunk IS NULL").first()
    assert (lost["rows"], lost["first_ms"]) == (150, None)
    assert load_chunks(spark, path, 0).count() == 450


def test_chunks_need_a_time(spark, tmp_path):
    with pytest.raises(ValueError, match="max_speed has to be off"):
        prepare_chunks(events(spark), str(tmp_path / "chunks"), ReplayConfig(max_speed=True))


# --- pacing -----------------------------------------------------------------------------------------


def test_paced_write_keeps_the_rhythm(spark, tmp_path):
    staged = prepare_chunks(events(spark), str(tmp_path / "chunks"), CONFIG)
    clock, log = Clock(), str(tmp_path / "log")
    sink = Sink("parquet", str(tmp_path / "topic"))
    sent = write_paced(staged, sink, speed=HOUR / 1000, slice_ms=1000, log_path=log, at_once=1, clock=clock, sleep=clock.sleep)
    assert sent == len(clock.naps) + 1 == replay_slices(staged, HOUR / 1000, 1000).count()
    assert contents(read_delivered(spark, "parquet", sink.path)) == contents(staged)
    notes = read_log(spark, log).orderBy("from_ms").collect()
    assert sum(r["rows"] for r in notes) == 600
    # A slice never starts early and lateness does not add up.
    assert all(0 <= r["late_ms"] <= 50 for r in notes)
    report = delivery_report(read_log(spark, log)).first()
    assert (report["slices"], report["rows"]) == (sent, 600)
    starts = [r["due_ms"] + r["late_ms"] for r in notes]
    assert report["seconds"] == (starts[-1] - starts[0]) / 1000
    assert report["rows_per_s"] == pytest.approx(600 / report["seconds"])
    assert report["latest_ms"] == max(r["late_ms"] for r in notes)


def test_rows_of_the_log_are_those_that_were_written(spark, tmp_path):
    path, log = str(tmp_path / "chunks"), str(tmp_path / "log")
    prepare_chunks(events(spark), path, CONFIG)
    clock, sink = Clock(), Sink("parquet", str(tmp_path / "topic"), only="key <> 'hot'")
    options = {"speed": HOUR / 1000, "slice_ms": 1000, "clock": clock, "sleep": clock.sleep}
    write_paced(ChunkFiles(spark, path), sink, log_path=log, **options)
    notes = {r["from_ms"]: r["rows"] for r in read_log(spark, log).collect()}
    planned = {r["from_ms"]: r["rows"] for r in replay_slices(load_chunks(spark, path), HOUR / 1000, 1000).collect()}
    assert notes.keys() == planned.keys() and sum(planned.values()) == 600
    assert sum(notes.values()) == read_delivered(spark, "parquet", sink.path).count() == 400
    assert sorted(planned[k] - notes[k] for k in planned)[-2:] == [0, 200]


def test_a_slice_behind_slow_ones_is_noted_as_late(spark, tmp_path, monkeypatch):
    staged = prepare_chunks(events(spark), str(tmp_path / "chunks"), CONFIG)
    monkeypatch.setattr(messages, "send_measured", lambda rows, sink: wall.sleep(0.6) or 1)
    log = str(tmp_path / "log")
    # Ten slices, all due within a tenth of a second, of which four go at once.
    write_paced(staged, Sink("noop"), speed=HOUR * 100, slice_ms=1 / 100, log_path=log)
    late = [r["late_ms"] for r in read_log(spark, log).orderBy("from_ms").collect()]
    assert len(late) == 10 and all(x < 550 for x in late[:4])
    assert all(500 < x < 1150 for x in late[4:8]) and all(1050 < x for x in late[8:])


def test_paced_write_goes_on_after_a_failure(spark, tmp_path):
    staged = prepare_chunks(events(spark), str(tmp_path / "chunks"), CONFIG)
    clock, log, sink = Clock(), str(tmp_path / "log"), Sink("parquet", str(tmp_path / "topic"))
    options = {"speed": HOUR / 1000, "slice_ms": 1000, "log_path": log, "clock": clock}

    def fail_on_third(seconds):
        clock.sleep(seconds)
        if len(clock.naps) == 3:
            raise ConnectionError

    with pytest.raises(ConnectionError):
        write_paced(staged, sink, sleep=fail_on_third, **options)
    assert read_log(spark, log).count() == 3
    rest = write_paced(staged, sink, sleep=clock.sleep, **options)
    assert rest == replay_slices(staged, HOUR / 1000, 1000).count() - 3
    assert contents(read_delivered(spark, "parquet", sink.path)) == contents(staged)
    assert write_paced(staged, sink, sleep=clock.sleep, **options) == 0


@pytest.mark.parametrize("speed, slice_ms", [(2 * HOUR / 1000, 1000), (HOUR / 1000, 700), (HOUR / 3000, 1000)])
def test_paced_write_goes_on_at_another_speed(spark, tmp_path, speed, slice_ms):
    staged = prepare_chunks(events(spark), str(tmp_path / "chunks"), CONFIG)
    clock, log, sink = Clock(), str(tmp_path / "log"), Sink("parquet", str(tmp_path / "topic"))

    def fail_on_fourth(seconds):
        clock.sleep(seconds)
        if len(clock.naps) == 4:
            raise ConnectionError

    with pytest.raises(ConnectionError):
        write_paced(staged, sink, speed=HOUR / 1000, slice_ms=1000, log_path=log, clock=clock, sleep=fail_on_fourth)
    write_paced(staged, sink, speed=speed, slice_ms=slice_ms, log_path=log, clock=clock, sleep=clock.sleep)
    assert contents(read_delivered(spark, "parquet", sink.path)) == contents(staged)
    progress = delivery_progress(read_log(spark, log), 600).orderBy("from_ms").collect()
    assert progress[-1]["sent"] == 600 and progress[-1]["percent"] == 100.0


def test_notes_are_put_together(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(messages, "NOTES", 4)
    staged = prepare_chunks(events(spark), str(tmp_path / "chunks"), CONFIG)
    clock, log = Clock(), tmp_path / "log"
    sent = write_paced(staged, Sink("noop"), speed=HOUR / 1000, slice_ms=1000, log_path=str(log), clock=clock, sleep=clock.sleep)
    assert read_log(spark, str(log)).count() == sent
    assert len(list(log.glob("note*.json"))) < sent


def test_failed_slice_is_an_error_and_not_noted(spark, tmp_path):
    staged = prepare_chunks(events(spark), str(tmp_path / "chunks"), CONFIG)
    clock, log = Clock(), str(tmp_path / "log")
    with pytest.raises(Exception, match="no_such_format"):
        write_paced(staged, Sink("no_such_format"), speed=HOUR / 1000, slice_ms=1000, log_path=log, clock=clock, sleep=clock.sleep)
    assert read_log(spark, log).count() == 0


def test_messages_without_a_time_are_refused(spark, tmp_path):
    df = events(spark).withColumn("event_time", F.when(F.col("n") % 4 != 0, F.col("event_time")))
    staged = prepare_chunks(df, str(tmp_path / "chunks"), CONFIG)
    clock = Clock()
    with pytest.raises(ValueError, match="150 messages have no event time"):
        write_paced(staged, Sink("noop"), speed=HOUR / 1000, slice_ms=1000, clock=clock, sleep=clock.sleep)


def test_stream_delivers_once_and_goes_on(spark, tmp_path):
    chunks, topic, checkpoint = (str(tmp_path / x) for x in ("chunks", "topic", "checkpoint"))
    early, late = events(spark).filter("n < 300"), events(spark).filter("n >= 300")
    prepare_chunks(early, chunks, CONFIG)
    sink = Sink("parquet", topic)
    stream_replay(spark, chunks, sink, checkpoint, files_per_trigger=5).awaitTermination()
    assert contents(read_delivered(spark, "parquet", topic)) == contents(envelope(early, CONFIG))
    more = prepare_chunks(late, str(tmp_path / "more"), CONFIG)
    more.write.mode("append").parquet(chunks)
    stream_replay(spark, chunks, sink, checkpoint, files_per_trigger=50).awaitTermination()
    assert contents(read_delivered(spark, "parquet", topic)) == contents(envelope(events(spark), CONFIG))


# --- stream by event time ---------------------------------------------------------------------------


def epochs(spark, topic, staged):
    """(first time, last time, rows) of each micro-batch, by its number."""
    times = staged.select("key", "value", "event_time_ms").distinct()
    rows = spark.read.parquet(topic).join(times, ["key", "value"]).groupBy("epoch")
    found = rows.agg(F.min("event_time_ms").alias("a"), F.max("event_time_ms").alias("b"), F.count("*").alias("n"))
    return {r["epoch"]: (r["a"], r["b"], r["n"]) for r in found.collect()}


def test_micro_batches_follow_event_time(spark, tmp_path):
    chunks, topic, checkpoint = (str(tmp_path / x) for x in ("chunks", "topic", "checkpoint"))
    # Files in an order of writing that is not that of time.
    staged = prepare_chunks(events(spark).orderBy(F.col("n").desc()), chunks, CONFIG)
    query = stream_by_time(spark, chunks, Sink("parquet", topic), checkpoint, span_ms=HOUR)
    run_to_end(query, ChunkFiles(spark, chunks))
    assert contents(read_delivered(spark, "parquet", topic)) == contents(staged)
    first = min(r["event_time_ms"] for r in staged.collect())
    found = epochs(spark, topic, staged)
    assert len(found) == 10
    assert all(first + e * HOUR <= a <= b < first + (e + 1) * HOUR for e, (a, b, _) in found.items())


def test_stream_by_time_goes_on_and_repeats_nothing(spark, tmp_path, monkeypatch):
    chunks, topic, checkpoint = (str(tmp_path / x) for x in ("chunks", "topic", "checkpoint"))
    staged, sink, sent = prepare_chunks(events(spark), chunks, CONFIG), Sink("parquet", topic), []

    def fails_once(rows, to):
        sent.append(to.path)
        write_messages(rows, to)
        if len(sent) == 4:
            raise ConnectionError("after writing the fourth")

    monkeypatch.setattr(stream_module, "write_messages", fails_once)
    with pytest.raises(Exception, match="after writing the fourth"):
        run_to_end(stream_by_time(spark, chunks, sink, checkpoint, span_ms=HOUR), ChunkFiles(spark, chunks))
    # Another span from here on; the batch that failed is repeated as it was.
    run_to_end(stream_by_time(spark, chunks, sink, checkpoint, span_ms=2 * HOUR), ChunkFiles(spark, chunks))
    assert sent[3] == sent[4]
    assert contents(read_delivered(spark, "parquet", topic)) == contents(staged)
    spans = [x for _, x in sorted(epochs(spark, topic, staged).items())]
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_event_time_is_let_in_by_speed(tmp_path):
    spans = [{"name": "f", "first_ms": 1000, "last_ms": 9_999, "rows": 2, "untimed": 0}]
    (tmp_path / "_files.json").write_text("\n".join(map(json.dumps, spans)))

    def reader(**options):
        return EventTimeReader({"path": str(tmp_path), "span_ms": "4000", **options}, ["key"])

    fast = reader()
    assert fast.initialOffset() == {"ms": 1000}
    assert fast.latestOffset() == fast.latestOffset() == {"ms": 5000}
    assert [(p.low, p.high) for p in fast.partitions({"ms": 1000}, {"ms": 5000})] == [(1000, 5000)]
    assert fast.latestOffset() == {"ms": 9000}
    fast.partitions({"ms": 5000}, {"ms": 9000})
    assert fast.latestOffset() == {"ms": 10_000}
    paced = reader(speed="2000")
    assert paced.latestOffset()["ms"] < 1500
    wall.sleep(0.5)
    assert 2000 <= paced.latestOffset()["ms"] <= 5000
    for wrong in ({"span_ms": "0"}, {"speed": "-1"}):
        with pytest.raises(ValueError):
            reader(**wrong)


def test_stream_by_time_needs_times(spark, tmp_path):
    df = events(spark).withColumn("event_time", F.when(F.col("n") % 4 != 0, F.col("event_time")))
    prepare_chunks(df, str(tmp_path / "chunks"), CONFIG)
    with pytest.raises(ValueError, match="150 messages have no event time"):
        stream_by_time(spark, str(tmp_path / "chunks"), Sink("noop"), str(tmp_path / "checkpoint"), span_ms=HOUR)


# --- retries and repeats ----------------------------------------------------------------------------


def letters_of(rows):
    return {r["row"]["n"]: (r["reason"], r["tries"], r["state"]) for r in rows.collect()}


def test_rejects_are_tried_until_they_pass_or_are_dead(spark, tmp_path):
    rows = [(None, 5, 1), (None, 6, 2), ("k", None, 3), (None, None, 4)]
    _, rejected = split_rejects(spark.createDataFrame(rows, "event_key string, event_time bigint, n int"), CONFIG)
    sink, naps, rounds = Sink("parquet", str(tmp_path / "topic")), [], []

    def mend(df, number):
        rounds.append(number)
        key = F.when((F.col("n") == 1) | ((F.col("n") == 4) & F.lit(number == 2)), F.lit("mended"))
        return df.withColumns({"event_key": F.coalesce("event_key", key), "event_time": F.coalesce("event_time", F.when(F.col("n") == 4, 9))})

    path = str(tmp_path / "letters")
    options = {"policy": RetryPolicy(3, 10, 2), "sleep": naps.append}
    want = {1: (None, 1, "delivered"), 2: ("null_key", 3, "dead"), 3: ("null_event_time", 3, "dead"), 4: (None, 2, "delivered")}
    assert letters_of(retry_rejects(spark, rejected, mend, CONFIG, sink, path, **options)) == want
    assert naps == [10, 20, 40] and rounds == [1, 2, 3]
    assert sorted(r["key"] for r in read_delivered(spark, "parquet", sink.path).collect()) == ["mended", "mended"]
    # All is settled, so another call does nothing.
    assert letters_of(retry_rejects(spark, rejected, mend, CONFIG, sink, path, **options)) == want and len(rounds) == 3


def test_a_round_that_broke_off_is_repeated_and_sends_once(spark, tmp_path):
    rows = [(None, 5, i) for i in range(20)]
    _, rejected = split_rejects(spark.createDataFrame(rows, "event_key string, event_time bigint, n int"), CONFIG)
    sink, path, fail = Sink("parquet", str(tmp_path / "topic")), str(tmp_path / "letters"), [True]

    def mend(df, number):
        return df.withColumn("event_key", F.when(F.col("n") % 3 >= 3 - number, F.lit("k")))

    def nap(seconds):
        if fail and seconds > 60:
            fail.clear()
            raise ConnectionError

    with pytest.raises(ConnectionError):
        retry_rejects(spark, rejected, mend, CONFIG, sink, path, sleep=nap)
    found = letters_of(retry_rejects(spark, rejected, mend, CONFIG, sink, path, sleep=nap))
    assert {s for _, _, s in found.values()} == {"delivered"} and len(found) == 20
    assert read_delivered(spark, "parquet", sink.path).count() == 20


def test_messages_sent_twice_are_read_once(spark, tmp_path):
    chunks, topic, out = (str(tmp_path / x) for x in ("chunks", "topic", "out"))
    copies = events(spark).unionByName(events(spark))
    staged = prepare_chunks(copies, chunks, CONFIG)
    clock, sink = Clock(), Sink("parquet", topic, numbered=True)
    for _ in range(2):
        write_paced(ChunkFiles(spark, chunks), sink, speed=HOUR / 1000, slice_ms=1000, clock=clock, sleep=clock.sleep)
    assert spark.read.option("recursiveFileLookup", True).parquet(topic).count() == 2400
    # Equal messages that were sent on their own stay; only repeats of one and the same go.
    assert contents(read_once(spark, "parquet", topic)) == contents(staged)
    once = read_once(spark, "parquet", topic, delay="1 hour")
    writer = once.writeStream.option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True)
    writer.format("parquet").start(out).awaitTermination()
    assert contents(spark.read.parquet(out)) == contents(staged)
    with pytest.raises(ValueError, match="ChunkFiles"):
        write_paced(staged, sink, speed=1.0, slice_ms=1000)


def test_numbers_travel_as_headers_in_kafka(spark, tmp_path):
    prepare_chunks(events(spark), str(tmp_path / "chunks"), CONFIG)
    rows = ChunkFiles(spark, str(tmp_path / "chunks")).between(None, None, numbered=True)
    row = messages._sendable(rows, Sink("kafka", numbered=True)).first()
    assert [h["key"] for h in row["headers"]] == ["seq", "event_time_ms"] and b".parquet:" in row["headers"][0]["value"]
    assert rows.select("seq").distinct().count() == 600


# --- content ----------------------------------------------------------------------------------------


def found_in(sent, delivered, **options):
    rows = reconcile_content(sent, delivered, **options).collect()
    text = [tuple(None if x is None else bytes(x).decode() for x in (r["key"], r["value"])) for r in rows]
    return {t: (r["sent"], r["delivered"], r["finding"]) for t, r in zip(text, rows)}


def test_every_difference_is_named(spark):
    sent = [(f"k{i}", f"v{i}") for i in range(500)] + [("a", "1"), ("a", "1"), ("b", "2"), ("c", "3"), ("d", "4"), (None, None), ("h", "5")]
    got = [(f"k{i}", f"v{i}") for i in range(500)] + [("a", "1"), ("b", "2!"), ("e", "3"), ("d", "4"), ("d", "4"), (None, "x"), ("n", "9")]
    sent, got = (spark.createDataFrame(rows, "key string, value string") for rows in (sent, got))
    want = {
        ("a", "1"): (2, 1, "missing"),
        ("b", "2"): (1, 0, "changed"),
        ("b", "2!"): (0, 1, "changed"),
        ("c", "3"): (1, 0, "moved"),
        ("e", "3"): (0, 1, "moved"),
        ("d", "4"): (1, 2, "repeated"),
        (None, None): (1, 0, "changed"),
        (None, "x"): (0, 1, "changed"),
        ("h", "5"): (1, 0, "missing"),
        ("n", "9"): (0, 1, "unexpected"),
    }
    assert found_in(sent, got) == found_in(sent, got, levels=(1,)) == want


def test_swapped_values_and_stretches(spark):
    rows = [("a", "1", 0), ("b", "2", 0), ("c", "3", 7)]
    sent = spark.createDataFrame(rows, "key string, value string, chunk bigint")
    got = spark.createDataFrame([("a", "2", 0), ("b", "1", 0), ("c", "3", 7)], sent.schema)
    assert {f for *_, f in found_in(sent, got, stretch="chunk").values()} == {"moved"}
    assert len(found_in(sent, got, stretch="chunk")) == 4
    assert found_in(sent, sent.repartition(3), stretch="chunk") == {}


def test_equal_content_takes_one_aggregation(spark, monkeypatch):
    df = events(spark).select(F.col("event_key").alias("key"), F.col("n").cast("string").alias("value"))
    staged = []
    monkeypatch.setattr(content, "stage", lambda frame, label: staged.append(label) or workspace.stage(frame, label))
    result = reconcile_content(df, df.repartition(5))
    assert staged == ["cells-0", "differences"] and result.count() == 0
    assert reconcile_content(df.limit(0), df.limit(0)).count() == 0


def test_digests_do_not_depend_on_order(spark):
    df = events(spark).select(F.col("event_key").alias("key"), F.col("n").cast("string").alias("value"))
    by_key = [{r["key"]: tuple(r)[1:] for r in digests(x, ["key"]).collect()} for x in (df, df.repartition(7))]
    assert by_key[0] == by_key[1] and by_key[0]["hot"][0] == 200


# --- whole replay -----------------------------------------------------------------------------------


def day_table(spark, name):
    rows = events(spark).unionByName(events(spark).withColumn("dt", F.lit("2024-01-02")))
    bad = rows.limit(1).withColumn("event_key", F.lit(None).cast("string")).withColumn("dt", F.lit("2024-01-01"))
    rows.unionByName(bad).write.partitionBy("dt").mode("overwrite").saveAsTable(name)


def test_replay_at_full_speed(spark, tmp_path):
    day_table(spark, "replay_fast")
    config = ReplayConfig(source_table="replay_fast", target_date="2024-01-01", max_speed=True)
    sink, rejects = Sink("parquet", str(tmp_path / "topic")), Sink("json", str(tmp_path / "rejects"))
    run_replay(spark, config, sink, rejects=rejects)
    delivered = read_delivered(spark, "parquet", sink.path)
    assert contents(delivered) == contents(envelope(events(spark), config))
    assert [r["reason"] for r in spark.read.json(rejects.path).collect()] == ["null_key"]


def test_no_row_is_left_behind_without_a_sink_for_rejects(spark, tmp_path):
    day_table(spark, "replay_all")
    config = ReplayConfig(source_table="replay_all", target_date="2024-01-01", max_speed=True)
    run_replay(spark, config, Sink("parquet", str(tmp_path / "topic")))
    delivered = read_delivered(spark, "parquet", str(tmp_path / "topic"))
    assert (delivered.count(), delivered.filter("key IS NULL").count()) == (601, 1)
    untimed = events(spark).withColumn("event_time", F.when(F.col("n") != 5, F.col("event_time")))
    untimed.write.partitionBy("dt").mode("overwrite").saveAsTable("replay_untimed")
    config = ReplayConfig(source_table="replay_untimed", target_date="2024-01-01", speed=HOUR / 1000)
    with pytest.raises(ValueError, match="rows without 'event_time'"):
        run_replay(spark, config, Sink("parquet", str(tmp_path / "paced")))
    clock, rejects = Clock(), Sink("json", str(tmp_path / "rejects"))
    run_replay(spark, config, Sink("parquet", str(tmp_path / "paced")), rejects=rejects, clock=clock, sleep=clock.sleep)
    assert read_delivered(spark, "parquet", str(tmp_path / "paced")).count() == 599
    assert [r["reason"] for r in spark.read.json(rejects.path).collect()] == ["null_event_time"]


def test_paced_replay_uses_its_chunks_again(spark, tmp_path):
    day_table(spark, "replay_paced")
    config = ReplayConfig(source_table="replay_paced", target_date="2024-01-01", speed=HOUR / 1000)
    chunks = str(tmp_path / "chunks")
    for turn in ("first", "second"):
        clock, sink = Clock(), Sink("parquet", str(tmp_path / turn))
        run_replay(spark, config, sink, chunks_path=chunks, unit="minute", clock=clock, sleep=clock.sleep)
        assert read_delivered(spark, "parquet", sink.path).count() == 601


def test_chunks_of_another_day_or_settings_are_refused(spark, tmp_path):
    day_table(spark, "replay_other")
    config = ReplayConfig(source_table="replay_other", target_date="2024-01-01", speed=HOUR / 1000)
    chunks, clock = str(tmp_path / "chunks"), Clock()
    run_replay(spark, config, Sink("noop"), chunks_path=chunks, clock=clock, sleep=clock.sleep)
    for other in (replace(config, target_date="2024-01-02"), replace(config, key_column="n"), replace(config, equal={"n": "1"})):
        with pytest.raises(ValueError, match="another table, date or other settings"):
            run_replay(spark, other, Sink("noop"), chunks_path=chunks, clock=clock, sleep=clock.sleep)
    run_replay(spark, replace(config, speed=HOUR / 500), Sink("noop"), chunks_path=chunks, clock=clock, sleep=clock.sleep)


def test_half_written_chunks_are_not_in_the_way(spark, tmp_path):
    day_table(spark, "replay_half")
    config = ReplayConfig(source_table="replay_half", target_date="2024-01-01", speed=HOUR / 1000)
    (tmp_path / "chunks" / "chunk=0").mkdir(parents=True)
    (tmp_path / "chunks" / "chunk=0" / "part-0.parquet").write_bytes(b"half")
    clock, sink = Clock(), Sink("parquet", str(tmp_path / "topic"))
    run_replay(spark, config, sink, chunks_path=str(tmp_path / "chunks"), clock=clock, sleep=clock.sleep)
    assert read_delivered(spark, "parquet", sink.path).count() == 601


def test_one_fab_of_a_day(spark, tmp_path):
    events(spark).withColumn("fab", (F.col("n") % 2).cast("string")).write.partitionBy("dt", "fab").mode("overwrite").saveAsTable("replay_fab")
    config = ReplayConfig(source_table="replay_fab", target_date="2024-01-01", max_speed=True, equal={"fab": "1"})
    run_replay(spark, config, Sink("parquet", str(tmp_path / "topic")))
    assert read_delivered(spark, "parquet", str(tmp_path / "topic")).count() == 300


def test_own_chunks_are_removed(spark, tmp_path):
    day_table(spark, "replay_own")
    config = ReplayConfig(source_table="replay_own", target_date="2024-01-01", speed=HOUR / 1000)
    clock = Clock()
    before = set(Path(workspace.work_folder(spark).removeprefix("file:")).glob("chunks-*"))
    run_replay(spark, config, Sink("noop"), clock=clock, sleep=clock.sleep)
    assert set(Path(workspace.work_folder(spark).removeprefix("file:")).glob("chunks-*")) <= before


def test_connector_columns(spark):
    df = spark.sql("SELECT timestamp'2024-01-01 00:00:00.5Z' t, 1 i, 2.5BD d, date'2024-01-02' day, array(1, 2) a, 'x' s, true b")
    row = df.select(plain_columns(df, df.columns)).first()
    assert tuple(row) == (1_704_067_200_500, 1, "2.5", "2024-01-02", "[1,2]", "x", True)


def test_avro_replay_looks_its_schema_up(spark, tmp_path):
    day_table(spark, "replay_avro")
    config = ReplayConfig(source_table="replay_avro", target_date="2024-01-01", max_speed=True, value_format="avro")
    sink = Sink("parquet", str(tmp_path / "topic"))
    schema = '{"type":"record","name":"E","fields":[{"name":"event_time","type":"long"},{"name":"n","type":"long"}]}'
    with pytest.raises(ValueError, match="value_schema"):
        run_replay(spark, config, sink)
    with pytest.raises(ValueError, match="no schema named 'replay_avro.value'"):
        run_replay(spark, config, sink, schemas=spark.createDataFrame([], "artifact string, content string"))
    found = spark.createDataFrame([("replay_avro.value", schema)], "artifact string, content string")
    with pytest.raises(AnalysisException, match="spark-avro"):  # the connector is not installed here
        run_replay(spark, config, sink, schemas=found)


def test_empty_day_writes_nothing(spark, tmp_path):
    day_table(spark, "replay_empty")
    config = ReplayConfig(source_table="replay_empty", target_date="1999-01-01")
    run_replay(spark, config, Sink("parquet", str(tmp_path / "topic")))
    assert not (tmp_path / "topic").exists()


# --- work folder ------------------------------------------------------------------------------------


def test_staged_tables_go_to_the_checkpoint_folder(spark):
    folder = workspace.work_folder(spark)
    root = (
        spark.conf.get("spark.checkpoint.dir", None)
        or spark.sparkContext.getCheckpointDir()
        or spark.conf.get("spark.sql.warehouse.dir")
    )
    assert folder.startswith(root.rstrip("/"))
    staged = workspace.stage(spark.range(3), "test")
    assert staged.count() == 3
    assert all(f.startswith("file:") and folder.split("file:")[-1] in f for f in staged.inputFiles())


def test_times_used_here():
    assert (BASE - datetime(1970, 1, 1)) / timedelta(milliseconds=1) == 1_704_067_200_000
