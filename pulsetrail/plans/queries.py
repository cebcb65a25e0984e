"""Every operator as a query over the given tables; ``oracle`` has the same in plain SQL."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsetrail.config import ReplayConfig, Sink
from pulsetrail.fixed_values import PARAM_COLUMNS, PLAIN_NUMBER, SUMMARY_GROUP
from pulsetrail.functions.columns import event_time_ms
from pulsetrail.functions.digits import joined_digits
from pulsetrail.operators.content import reconcile_content
from pulsetrail.operators.delivery import delivery_progress, reconcile
from pulsetrail.operators.envelope import envelope, split_rejects
from pulsetrail.operators.inventory import (
    day_profile,
    inventory,
    inventory_of_files,
    latest_date,
    latest_of_files,
    param_count,
    preview,
)
from pulsetrail.operators.messages import (
    chunk_manifest,
    prepare_chunks,
    read_log,
    write_messages,
    write_paced,
    write_to,
)
from pulsetrail.operators.ordering import global_rank
from pulsetrail.operators.retry import retry_rejects
from pulsetrail.operators.schedule import (
    pending_slices,
    replay_batches,
    replay_progress,
    replay_schedule,
    replay_slices,
)
from pulsetrail.operators.step_runs import step_merges, step_runs
from pulsetrail.operators.summary import pack_summary, summarize_params
from pulsetrail.operators.trace import flatten_trace
from pulsetrail.plans.replay import run_replay
from pulsetrail.sources.chunk_files import ChunkFiles
from pulsetrail.sources.samples import events_with_date, trace_of_lineitem
from pulsetrail.sources.tables import load_chunks, load_day, load_path, read_delivered, read_once
from pulsetrail.streaming.stream_replay import run_to_end, stream_by_time, stream_replay
from pulsetrail.workspace import new_path

Query = Callable[[SparkSession, str], DataFrame]

# Parameters shared with the SQL.
BATCH_SIZE = 10
SPEED = 60.0
FAST = 6000.0
TRACE_BATCH = 100
TRACE_SPEED = 20_000.0
DAY = "2024-01-15"
SPLIT_MS = 1_705_276_800_000  # 2024-01-15 00:00:00
SLICE_SPEED = 86_400.0
SLICE_MS = 1000
DAY_MS = 86_400_000
# Significant digits that do not depend on the order in which an engine adds up.
DIGITS = 9
CUT = 0.41421356
STATION = ("eqp_id", "module_name", "step_id", "fab")

MAX_SPEED = ReplayConfig(source_table="db.events", key_column="event_id", max_speed=True)
TIMED = ReplayConfig(source_table="db.events", key_column="event_id")


def all_queries() -> dict[str, Query]:
    return {
        "load_day": _load_day,
        "load_day_orc": _load_day_orc,
        "chunk_scan": _chunk_scan,
        "csv_export": _csv_export,
        "envelope_json": lambda spark, sf: _readable(envelope(events_with_date(spark, sf), TIMED)),
        "envelope_max_speed": lambda spark, sf: _readable(envelope(events_with_date(spark, sf), MAX_SPEED)),
        "envelope_binary": _envelope_binary,
        "envelope_trace": lambda spark, sf: _readable(
            envelope(trace_of_lineitem(spark, sf), ReplayConfig(source_table="db.trace", max_speed=True))
        ),
        "envelope_trace_timed": lambda spark, sf: _readable(
            envelope(trace_of_lineitem(spark, sf), ReplayConfig(source_table="db.trace", key_column="eqp_id"))
        ),
        "envelope_key_json": _envelope_key_json,
        "envelope_key_literal": _envelope_key_literal,
        "event_time_ms": _event_time_ms,
        "rejects": _rejects,
        "rejects_retried": _rejects_retried,
        "max_speed_messages": _max_speed_messages,
        "paced_messages": _paced_messages,
        "paced_resume": _paced_resume,
        "delivery_progress": _delivery_progress,
        "delivered_once": _delivered_once,
        "replay_day": _replay_day,
        "stream_replay": _stream_replay,
        "stream_by_time": _stream_by_time,
        "reconcile_content": _reconcile_content,
        "prepare_chunks": lambda spark, sf: _readable(_chunks(spark, sf)),
        "chunks_of_copies": _chunks_of_copies,
        "chunk_manifest": lambda spark, sf: chunk_manifest(_chunks(spark, sf)),
        "reconcile": _reconcile,
        "global_rank": _global_rank,
        "global_rank_copies": _global_rank_copies,
        "replay_schedule": lambda spark, sf: replay_schedule(_event_times(spark, sf), SPEED),
        "replay_schedule_holes": lambda spark, sf: replay_schedule(_holes(spark, sf), SPEED),
        "replay_batches_holes": lambda spark, sf: replay_batches(_holes(spark, sf), BATCH_SIZE, SPEED),
        "replay_slices_holes": lambda spark, sf: replay_slices(_holes(spark, sf), SLICE_SPEED, SLICE_MS),
        "replay_batches": lambda spark, sf: replay_batches(_event_times(spark, sf), BATCH_SIZE, SPEED),
        "replay_batches_fast": lambda spark, sf: replay_batches(_event_times(spark, sf), BATCH_SIZE, FAST),
        "replay_batches_trace": _replay_batches_trace,
        "replay_progress": lambda spark, sf: _rounded(
            replay_progress(replay_batches(_event_times(spark, sf), BATCH_SIZE, SPEED)), ["percent", "rows_per_s"]
        ),
        "replay_slices": lambda spark, sf: replay_slices(_event_times(spark, sf), SLICE_SPEED, SLICE_MS),
        "pending_slices": _pending_slices,
        "day_profile": lambda spark, sf: day_profile(trace_of_lineitem(spark, sf), ["dt", "lot_id"]),
        "event_profile": lambda spark, sf: day_profile(events_with_date(spark, sf), ["dt", "event_type"]),
        "count_by_date": lambda spark, sf: inventory(events_with_date(spark, sf), "dt"),
        "count_by_date_type": lambda spark, sf: inventory(events_with_date(spark, sf), ["dt", "event_type"]),
        "count_by_lot": lambda spark, sf: inventory(trace_of_lineitem(spark, sf), "lot_id"),
        "count_by_date_fab": lambda spark, sf: inventory(trace_of_lineitem(spark, sf), ["dt", "fab"]),
        "count_by_lot_eqp": lambda spark, sf: inventory(trace_of_lineitem(spark, sf), ["lot_id", "eqp_id"]),
        "count_by_date_files": lambda spark, sf: _date_as_text(
            inventory_of_files(spark, "parquet", _events_by_date(spark, sf, "parquet"), ["dt"])
        ),
        "latest_date_files": lambda spark, sf: _date_as_text(latest_of_files(spark, "orc", _events_by_date(spark, sf, "orc"))),
        "latest_date": lambda spark, sf: latest_date(events_with_date(spark, sf)),
        "preview": lambda spark, sf: _text_times(preview(events_with_date(spark, sf), 10, "event_id")),
        "param_count": lambda spark, sf: _text_times(_text_arrays(param_count(trace_of_lineitem(spark, sf)))),
        "trace_flatten": _trace_flatten,
        "param_summary": _station_summary,
        "param_integral": lambda spark, sf: _station_summary(spark, sf, statistics=["integral_val"]).select(
            *STATION, *PARAM_COLUMNS, "integral_val"
        ),
        "step_runs": lambda spark, sf: step_runs(trace_of_lineitem(spark, sf)),
        "step_merges": lambda spark, sf: step_merges(step_runs(trace_of_lineitem(spark, sf))),
        "summary_packed": _summary_packed,
        "summary_by_lot": _summary_by_lot,
    }


# --- sources ------------------------------------------------------------------------------------


def _load_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text_times(load_day(spark, _events_table(spark, sf_dir), DAY))


def _events_table(spark: SparkSession, sf_dir: str) -> str:
    """``events`` as a catalog table partitioned by date; its name."""
    name = f"pulsetrail_events_{uuid4().hex}"
    events = events_with_date(spark, sf_dir)
    events.repartitionByRange("dt", "event_id").write.partitionBy("dt").format("parquet").saveAsTable(name)
    return name


def _events_by_date(spark: SparkSession, sf_dir: str, format: str) -> str:
    """``events`` as files in a folder per date; their path."""
    path = new_path(spark, f"events-{format}")
    events = events_with_date(spark, sf_dir)
    in_order = events.repartitionByRange("dt", "event_id").sortWithinPartitions("dt")
    in_order.write.partitionBy("dt").format(format).save(path)
    return path


def _date_as_text(df: DataFrame) -> DataFrame:
    return df.withColumn("dt", F.col("dt").cast("string"))


def _load_day_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _events_by_date(spark, sf_dir, "orc")
    return _text_times(load_path(spark, "orc", path, DAY)).withColumn("dt", F.col("dt").cast("string"))


def _chunk_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "chunks")
    prepare_chunks(events_with_date(spark, sf_dir), path, TIMED, unique_key=True)
    return _readable(load_chunks(spark, path, to_ms=SPLIT_MS).unionByName(load_chunks(spark, path, SPLIT_MS)))


def _csv_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "events-csv")
    events = _text_times(events_with_date(spark, sf_dir))
    write_to(events, Sink("csv", path, options={"header": "true"}))
    return spark.read.schema(events.schema).option("header", True).csv(path)


# --- messages -----------------------------------------------------------------------------------


def _envelope_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = ReplayConfig(
        source_table="db.events", key_column="event_id", max_speed=True, value_format="binary", payload_column="props"
    )
    return _readable(envelope(events_with_date(spark, sf_dir), config))


def _envelope_key_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = ReplayConfig(source_table="db.events", key_column="user_id", time_in_value=True, key_format="json")
    return _readable(envelope(events_with_date(spark, sf_dir), config))


def _envelope_key_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = ReplayConfig(
        source_table="db.events", key_column="event_id", key_literal="test-key", key_in_value=True, exclude_columns=("dt", "ts")
    )
    return _readable(envelope(events_with_date(spark, sf_dir), config))


def _event_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = events_with_date(spark, sf_dir)
    return events.select("event_id", event_time_ms(events, "ts").alias("event_time_ms"))


def _event_time_ms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_times(spark, sf_dir)


def _with_holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of which errors have no key and signups no time."""
    return events_with_date(spark, sf_dir).withColumns(
        {
            "event_key": F.when(F.col("event_type") != "error", F.col("event_id")),
            "ts": F.when(F.col("event_type") != "signup", F.col("ts")),
        }
    )


def _rejects_retried(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys come in the second round for even numbers, times in the first for multiples of three; the rest is dead.
    Each row with what became of it, and how often its message arrived."""
    config, path = ReplayConfig(source_table="db.events", key_in_value=True), new_path(spark, "retried")
    _, rejected = split_rejects(_with_holes(spark, sf_dir), config)

    def mend(rows: DataFrame, number: int) -> DataFrame:
        day = F.lit("2024-02-01").cast("timestamp_ntz")
        key = F.when((F.col("event_id") % 2 == 0) & F.lit(number == 2), F.col("event_id"))
        return rows.withColumns(
            {
                "event_key": F.coalesce("event_key", key),
                "ts": F.coalesce("ts", F.when(F.col("event_id") % 3 == 0, day)),
            }
        )

    letters = retry_rejects(spark, rejected, mend, config, Sink("parquet", path), new_path(spark, "letters"), sleep=lambda seconds: None)
    number = F.get_json_object(F.col("value").cast("string"), "$.event_id").cast("bigint")
    arrived = spark.read.parquet(path).select(number.alias("event_id")).groupBy("event_id").agg(F.count(F.lit(1)).alias("arrived"))
    return (
        letters.select("row.event_id", "reason", "tries", "state")
        .join(arrived, "event_id", "left")
        .withColumn("arrived", F.coalesce("arrived", F.lit(0)))
    )


def _rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, rejected = split_rejects(_with_holes(spark, sf_dir), ReplayConfig(source_table="db.events"))
    return good.withColumn("reason", F.lit("sent")).unionByName(rejected).select("event_id", "event_key", "reason")


def _max_speed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "topic")
    write_messages(envelope(events_with_date(spark, sf_dir), MAX_SPEED), Sink("parquet", path))
    return _readable(read_delivered(spark, "parquet", path))


def _paced_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, now = new_path(spark, "paced"), [0.0]

    def sleep(seconds: float) -> None:
        now[0] += seconds

    # One slice per day of events and a clock that jumps ahead.
    write_paced(
        _chunks(spark, sf_dir, "day"),
        Sink("parquet", path),
        speed=SLICE_SPEED,
        slice_ms=SLICE_MS,
        clock=lambda: now[0],
        sleep=sleep,
    )
    delivered = spark.read.parquet(path)
    return _readable(delivered.select("key", "value", F.col("from_ms").cast("bigint").alias("from_ms")))


class _Broken(Exception):
    """Ends a paced write in the middle."""


def _resumed(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """A paced write of all events that breaks off after four days and goes on at another speed and length of
    slices: where it wrote, and its log."""
    path, log, now = new_path(spark, "resumed"), new_path(spark, "log"), [0.0, 0]

    def sleep(seconds: float) -> None:
        now[0] += seconds
        now[1] += 1
        if now[1] == 4:
            raise _Broken

    chunks = _chunks(spark, sf_dir, "day")

    def write(speed: float, slice_ms: int) -> None:
        write_paced(
            chunks, Sink("parquet", path), speed=speed, slice_ms=slice_ms, log_path=log, clock=lambda: now[0], sleep=sleep
        )

    try:
        write(SLICE_SPEED, SLICE_MS)
    except _Broken:
        write(3 * SLICE_SPEED, 2 * SLICE_MS)
    return path, log


def _paced_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _readable(spark.read.parquet(_resumed(spark, sf_dir)[0]).select("key", "value"))


def _delivery_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, log, now = new_path(spark, "paced"), new_path(spark, "log"), [0.0]

    def sleep(seconds: float) -> None:
        now[0] += seconds

    # One after another, as only then the clock that jumps ahead tells when each began.
    write_paced(
        _chunks(spark, sf_dir, "day"),
        Sink("parquet", path),
        speed=SLICE_SPEED,
        slice_ms=SLICE_MS,
        log_path=log,
        at_once=1,
        clock=lambda: now[0],
        sleep=sleep,
    )
    return _rounded(delivery_progress(read_log(spark, log)), ["percent", "elapsed_s", "rows_per_s"])


def _delivered_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A paced write that appends, breaks off after four days, has lost its log and sends all again; read as a stream."""
    staged, topic, out, now = new_path(spark, "chunks"), new_path(spark, "topic"), new_path(spark, "once"), [0.0, 0]
    prepare_chunks(events_with_date(spark, sf_dir), staged, TIMED, unique_key=True)
    sink = Sink("parquet", topic, numbered=True)

    def sleep(seconds: float) -> None:
        now[0] += seconds
        now[1] += 1
        if now[1] == 4:
            raise _Broken

    def write() -> None:
        write_paced(ChunkFiles(spark, staged), sink, speed=SLICE_SPEED, slice_ms=SLICE_MS, clock=lambda: now[0], sleep=sleep)

    try:
        write()
    except _Broken:
        write()
    once = read_once(spark, "parquet", topic, delay="1 day").select("key", "value", "event_time_ms")
    stream = once.writeStream.option("checkpointLocation", new_path(spark, "once-checkpoint")).trigger(availableNow=True)
    stream.format("parquet").start(out).awaitTermination()
    return _readable(spark.read.schema(once.schema).parquet(out))


def _replay_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "topic")
    config = ReplayConfig(
        source_table=_events_table(spark, sf_dir), target_date=DAY, key_column="event_id", max_speed=True
    )
    run_replay(spark, config, Sink("parquet", path))
    return _readable(read_delivered(spark, "parquet", path))


def _stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks, path = new_path(spark, "chunks"), new_path(spark, "streamed")
    prepare_chunks(events_with_date(spark, sf_dir), chunks, TIMED, "day", unique_key=True)
    query = stream_replay(
        spark, chunks, Sink("parquet", path), new_path(spark, "stream-checkpoint"), files_per_trigger=20
    )
    query.awaitTermination()
    return _readable(read_delivered(spark, "parquet", path))


def _stream_by_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Micro-batches of a day of event time: number, first and last event time, rows."""
    chunks, path = new_path(spark, "chunks"), new_path(spark, "streamed")
    prepare_chunks(events_with_date(spark, sf_dir), chunks, TIMED, unique_key=True)
    query = stream_by_time(spark, chunks, Sink("parquet", path), new_path(spark, "stream-checkpoint"), span_ms=DAY_MS)
    run_to_end(query, ChunkFiles(spark, chunks))
    times = _event_times(spark, sf_dir).select(F.col("event_id").cast("string").alias("key"), "event_time_ms")
    return (
        spark.read.parquet(path)
        .join(times, "key")
        .groupBy("epoch")
        .agg(F.min("event_time_ms").alias("first_ms"), F.max("event_time_ms").alias("last_ms"), F.count(F.lit(1)).alias("rows"))
    )


def _chunks(spark: SparkSession, sf_dir: str, unit: str = "hour") -> DataFrame:
    events = events_with_date(spark, sf_dir)
    return prepare_chunks(events, new_path(spark, "chunks"), TIMED, unit, unique_key=True)


def _chunks_of_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event twice, and ordered by user and time only, so that keys repeat."""
    events = events_with_date(spark, sf_dir)
    config = ReplayConfig(source_table="db.events", key_column="user_id")
    return _readable(prepare_chunks(events.unionByName(events), new_path(spark, "chunks"), config, "day"))


def _reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = ReplayConfig(source_table="db.events", key_column="user_id", max_speed=True)
    sent = events_with_date(spark, sf_dir)
    # Errors get lost on the way, clicks arrive twice.
    arrived = sent.filter("event_type <> 'error'").unionByName(sent.filter("event_type = 'click'"))
    path = new_path(spark, "topic")
    write_messages(envelope(arrived, config), Sink("parquet", path))
    return reconcile(envelope(sent, config), read_delivered(spark, "parquet", path))


def _reconcile_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors get lost on the way, some clicks arrive twice, some purchases with another value, some signups under
    another key."""
    sent = envelope(events_with_date(spark, sf_dir), TIMED).drop("event_time_ms")
    kinds = events_with_date(spark, sf_dir).select(F.col("event_id").cast("string").alias("key"), "event_id", "event_type")
    kind, number = F.col("event_type"), F.col("event_id")
    changed = F.when((kind == "purchase") & (number % 7 == 0), F.concat(F.col("value").cast("string"), F.lit("!")).cast("binary"))
    moved = F.when((kind == "signup") & (number % 3 == 0), F.concat("key", F.lit("x")))
    arrived = (
        sent.join(kinds, "key")
        .filter(kind != "error")
        .withColumn("_copies", F.when((kind == "click") & (number % 5 == 0), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
        .select(F.coalesce(moved, "key").alias("key"), F.coalesce(changed, "value").alias("value"), F.explode("_copies").alias("_copy"))
    )
    path = new_path(spark, "topic")
    write_messages(arrived, Sink("parquet", path))
    return _readable(reconcile_content(sent, read_delivered(spark, "parquet", path)))


# --- schedule -----------------------------------------------------------------------------------


def _global_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return global_rank(_event_times(spark, sf_dir), "event_time_ms", ["event_id"], unique=True)


def _global_rank_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event time cut to the day and there twice: ranks of rows that are alike may be swapped."""
    days = _event_times(spark, sf_dir).select((F.col("event_time_ms") - F.col("event_time_ms") % DAY_MS).alias("day_ms"))
    return global_rank(days.unionByName(days), "day_ms", [])


def _holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of which errors have no time."""
    events = events_with_date(spark, sf_dir)
    at = F.when(F.col("event_type") != "error", event_time_ms(events, "ts"))
    return events.select("event_id", at.alias("event_time_ms"))


def _replay_batches_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    trace = trace_of_lineitem(spark, sf_dir)
    return replay_batches(trace.select(event_time_ms(trace, "ts").alias("event_time_ms")), TRACE_BATCH, TRACE_SPEED)


def _pending_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    slices = replay_slices(_event_times(spark, sf_dir), SLICE_SPEED, SLICE_MS)
    # As if the slices of at least average size had been sent.
    return pending_slices(slices, slices.filter(F.col("rows") >= slices.agg(F.avg("rows")).scalar()))


# --- traces -------------------------------------------------------------------------------------


def _trace_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values as they are in the trace; numbers among them also as numbers, for engines write them differently."""
    flat = _text_times(flatten_trace(trace_of_lineitem(spark, sf_dir)))
    number = F.when(F.col("param_value").rlike(PLAIN_NUMBER), F.col("param_value")).try_cast("double")
    text = F.when(number.isNull(), F.col("param_value"))
    return flat.withColumns({"param_number": number, "param_value": text})


def _param_rows(trace: DataFrame) -> DataFrame:
    return flatten_trace(trace, [*PARAM_COLUMNS, "param_value"])


def _station_summary(spark: SparkSession, sf_dir: str, **settings) -> DataFrame:
    return _readable_stats(summarize_params(_param_rows(trace_of_lineitem(spark, sf_dir)), STATION, **settings))


def _summary_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = summarize_params(_param_rows(trace_of_lineitem(spark, sf_dir)), STATION)
    return _text_arrays(_text_times(pack_summary(stats, STATION)))


def _summary_by_lot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full declared grouping."""
    stats = summarize_params(flatten_trace(trace_of_lineitem(spark, sf_dir), [*PARAM_COLUMNS, "param_value"]))
    return _text_arrays(_text_times(pack_summary(stats, SUMMARY_GROUP)))


# --- forms that compare across engines ----------------------------------------------------------


def _readable(messages: DataFrame) -> DataFrame:
    """Keys and values as text."""
    return messages.withColumns({name: F.col(name).cast("string") for name in ("key", "value")})


def _rounded(df: DataFrame, names: list[str]) -> DataFrame:
    """Doubles cut to the digits that do not depend on the order in which they were added up."""
    return df.withColumns({n: F.when(F.col(n).isNotNull(), _digits(F.col(n)).cast("double")) for n in names})


def _digits(x: Column) -> Column:
    """``DIGITS`` significant digits as text, cut at a place between them on which no short decimal lies."""
    shift = F.lit(DIGITS - 1) - F.floor(F.log10(F.abs(x)))
    scaled = F.when(shift < 0, x / F.pow(F.lit(10.0), -shift)).otherwise(x * F.pow(F.lit(10.0), shift))
    text = F.concat(F.floor(scaled + CUT).cast("string"), F.lit("e"), (-shift).cast("string"))
    return F.when(x == 0, "0e0").otherwise(text)


def _readable_stats(stats: DataFrame) -> DataFrame:
    doubles = [name for name, kind in stats.dtypes if kind == "double"]
    return _text_times(_rounded(stats, doubles))


def _text_times(df: DataFrame) -> DataFrame:
    """Timestamps as epoch milliseconds."""
    times = [name for name, kind in df.dtypes if kind.startswith("timestamp")]
    return df.withColumns({name: F.unix_millis(F.col(name).cast("timestamp")) for name in times})


def _text_arrays(df: DataFrame) -> DataFrame:
    """Arrays as one text, elements between bars, NULL as a minus; doubles cut as by ``_rounded``, then as ``_digits``.

    There are many doubles, and the expressions for all columns make a method too long for the JVM to compile.
    """
    doubles = F.arrow_udf(joined_digits(DIGITS, CUT), "string")

    def text(name: str, kind: str) -> Column:
        if "double" in kind:
            return doubles(F.col(name))
        plain = F.unix_millis if "timestamp" in kind else lambda x: x
        return F.array_join(F.transform(name, lambda x: F.coalesce(plain(x).cast("string"), F.lit("-"))), "|")

    return df.withColumns({name: text(name, kind) for name, kind in df.dtypes if kind.startswith("array")})
