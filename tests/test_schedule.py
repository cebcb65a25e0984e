"""Rank, batches, progress and slices against plain Python, with hot milliseconds and full copies."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulsetrail.operators import schedule
from pulsetrail.operators.ordering import global_rank, range_sorted, running_totals, tell_apart
from pulsetrail.operators.schedule import (
    Coverage,
    pending_slices,
    replay_batches,
    replay_progress,
    replay_schedule,
    replay_slices,
)

HOUR = 3_600_000


def skewed_times(n, seed=3):
    """A third of all rows on one millisecond, the rest over two days, some before the epoch."""
    rng = random.Random(seed)
    hot = [5 * HOUR + 17] * (n // 3)
    rest = [rng.randrange(-HOUR, 48 * HOUR) for _ in range(n - len(hot))]
    times = hot + rest
    rng.shuffle(times)
    return times


def frame(spark, times):
    return spark.createDataFrame([(t, f"k{i}") for i, t in enumerate(times)], "event_time_ms bigint, key string")


def python_batches(times, size, speed):
    ordered, previous, out = sorted(times), None, []
    for b, at in enumerate(range(0, len(ordered), size)):
        part = ordered[at : at + size]
        previous = part[0] if previous is None else previous
        pause = int((part[-1] - previous) / speed / 1000.0)
        out.append((b, len(part), part[0], part[-1], max(0, min(pause, 60))))
        previous = part[-1]
    return out


@pytest.mark.parametrize("size, speed", [(1, 1.0), (7, 1.0), (100, 60.0), (10_000, 0.5)])
def test_batches(spark, size, speed):
    times = skewed_times(2000)
    result = replay_batches(frame(spark, times), size, speed).orderBy("batch_id").collect()
    assert [tuple(r) for r in result] == python_batches(times, size, speed)


def test_batches_unrolled_in_short_strides(spark, monkeypatch):
    monkeypatch.setattr(schedule, "STRIDE", 8)
    times = skewed_times(2000)
    result = replay_batches(frame(spark, times), 3, 1.0).orderBy("batch_id").collect()
    assert [tuple(r) for r in result] == python_batches(times, 3, 1.0)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-3 * HOUR, 3 * HOUR), max_size=60), st.integers(1, 20), st.sampled_from([0.5, 1.0, 90.0]))
def test_batches_of_any_times(spark, times, size, speed):
    result = replay_batches(frame(spark, times), size, speed).orderBy("batch_id").collect()
    assert [tuple(r) for r in result] == python_batches(times, size, speed)


def test_rows_without_time_stay_in_sight(spark):
    df = spark.createDataFrame([(1,), (None,), (3,), (None,)], "event_time_ms bigint")
    batches = replay_batches(df, 10, 1.0)
    assert {tuple(r)[:3] for r in batches.collect()} == {(0, 2, 1), (None, 2, None)}
    assert sorted((r["due_ms"] for r in replay_schedule(df, 1.0).collect()), key=str) == [0, 2, None, None]
    slices = {r["slice_id"]: r["rows"] for r in replay_slices(df, 1.0, 1000).collect()}
    assert slices == {0: 2, None: 2}
    progress = {r["batch_id"]: (r["rows"], r["sent"], r["percent"]) for r in replay_progress(batches).collect()}
    assert progress == {0: (2, 2, 50.0), None: (2, None, None)}


def test_what_is_not_covered():
    def missing(start, stop, done):
        return Coverage(done).missing(start, stop)

    assert missing(0, 10, []) == [(0, 10)]
    assert missing(0, 10, [(2, 4), (3, 6), (8, 20)]) == [(0, 2), (6, 8)]
    assert missing(0, 10, [(-5, 10)]) == missing(0, 10, [(0, 5), (5, 10)]) == []
    assert missing(0, 10, [(10, 20), (-3, 0)]) == [(0, 10)]


@given(st.lists(st.tuples(st.integers(0, 60), st.integers(1, 20)), max_size=12), st.integers(1, 9))
def test_coverage_is_walked_through_once(stretches, width):
    done = [(a, a + n) for a, n in stretches]
    covered = Coverage(done)
    open_ = [ms for start in range(0, 90, width) for a, b in covered.missing(start, start + width) for ms in range(a, b)]
    last = range(0, 90, width)[-1] + width
    assert open_ == [ms for ms in range(last) if not any(a <= ms < b for a, b in done)]


def test_a_hot_millisecond_is_cut_in_several_tasks(spark):
    df = spark.range(200_000).select(F.lit(5).cast("bigint").alias("event_time_ms"))
    plan = replay_batches(df, 2, 1.0)._jdf.queryExecution().executedPlan().toString()
    first = plan.index("Generate explode(sequence(stride")
    assert "Exchange hashpartitioning(stride" in plan[first : plan.index("Generate explode", first + 1)]
    assert replay_batches(df, 2, 1.0).agg(F.count("*"), F.sum("rows")).first()[:] == (100_000, 200_000)


def test_empty_day(spark):
    empty = frame(spark, [(0, "")][:0])
    assert replay_batches(empty, 10, 1.0).count() == 0
    assert replay_schedule(empty, 1.0).count() == 0
    assert replay_slices(empty, 1.0, 1000).count() == 0
    assert global_rank(empty).count() == 0
    assert replay_progress(replay_batches(empty, 10, 1.0)).count() == 0


def test_progress(spark):
    times = skewed_times(1000)
    batches = replay_batches(frame(spark, times), 7, 60.0)
    rows = replay_progress(batches).orderBy("batch_id").collect()
    sent = elapsed = 0
    for row, (b, n, _, _, pause) in zip(rows, python_batches(times, 7, 60.0), strict=True):
        sent, elapsed = sent + n, elapsed + pause
        assert (row["batch_id"], row["sent"], row["elapsed_s"]) == (b, sent, elapsed)
        assert row["percent"] == pytest.approx(100 * sent / 1000)
        assert row["rows_per_s"] == (pytest.approx(sent / elapsed) if elapsed else None)


def test_running_totals_across_blocks(spark):
    values = {i: (i * 37) % 11 for i in range(-50, 300, 3)}
    df = spark.createDataFrame(list(values.items()), "id bigint, v bigint")
    result = running_totals(df, "id", {"v": "upto"}, 16).orderBy("id").collect()
    total = 0
    for row in result:
        total += values[row["id"]]
        assert row["upto"] == total
        assert row["upto_total"] == sum(values.values())


def test_schedule_keeps_gaps(spark):
    df = frame(spark, [1000, 1500, 61_000, 1000])
    due = replay_schedule(df, 2.0).orderBy("due_ms").collect()
    assert [r["due_ms"] for r in due] == [0, 0, 250, 30_000]


def test_rank_with_unique_tiebreak(spark):
    times = skewed_times(3000)
    result = global_rank(frame(spark, times).repartition(5), unique=True).collect()
    expected = sorted((t, f"k{i}") for i, t in enumerate(times))
    assert [(r["event_time_ms"], r["key"]) for r in sorted(result, key=lambda r: r["rank"])] == expected
    assert sorted(r["rank"] for r in result) == list(range(1, 3001))


def test_rank_with_full_copies(spark):
    rows = [(5, "a", "x")] * 700 + [(i, "b", "y") for i in range(900)] + [(5, "a", "z")] * 400
    df = spark.createDataFrame(rows, "event_time_ms bigint, key string, value string").repartition(6)
    result = sorted(global_rank(df).collect(), key=lambda r: r["rank"])
    assert [r["rank"] for r in result] == list(range(1, 2001))
    assert sorted(tuple(r)[:3] for r in result) == sorted(rows)
    order = [(r["event_time_ms"], r["key"]) for r in result]
    assert order == sorted(order)


def test_copies_are_spread_over_ranges(spark):
    """One group of copies holds nearly all rows; the ranges still come out alike."""
    df = spark.range(20_000).select(F.when(F.col("id") < 18_000, 5).otherwise(F.col("id")).alias("t")).repartition(4)
    parts = range_sorted(df, ["t"], unique=False, ranges=8).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in parts) == 20_000
    assert max(r["count"] for r in parts) < 6_000


def test_copies_are_numbered_alike_when_a_task_runs_again(spark):
    """A partition with the same rows in another order gives every row the same sort keys."""
    rows = [(5, "a", "x")] * 40 + [(i % 7, "b", str(i % 3)) for i in range(100)]
    again = rows[::-1]
    keys = [
        sorted(map(tuple, tell_apart(spark.createDataFrame(r, "t int, key string, `v.w` string").coalesce(1), ["t"]).collect()))
        for r in (rows, again)
    ]
    assert keys[0] == keys[1] and len({k[-1] for k in keys[0]}) == 140


def test_rank_has_no_single_task_over_rows(spark):
    df = spark.range(100).select(F.col("id").alias("event_time_ms"), F.col("id").cast("string").alias("key"))
    plan = global_rank(df, unique=True)._jdf.queryExecution().executedPlan().toString()
    # The one single-partition step adds up the sizes of the written ranges.
    assert plan.count("Exchange SinglePartition") == 1
    assert "row_number" not in plan


def test_slices_cover_all_rows(spark):
    times = skewed_times(2000)
    slices = replay_slices(frame(spark, times), 3600.0, 1000).orderBy("slice_id").collect()
    first = min(times)
    for row in slices:
        assert row["rows"] == sum(row["from_ms"] <= t < row["to_ms"] for t in times) > 0
        assert row["due_ms"] == (row["from_ms"] - first) // 3600
    assert sum(r["rows"] for r in slices) == 2000


def test_pending_slices(spark):
    slices = replay_slices(frame(spark, [0, 1000, 2000, 3000]), 1.0, 1000)
    delivered = spark.createDataFrame([(0, 1000), (2000, 3000), (2000, 3000), (3000, 3500)], "from_ms bigint, to_ms bigint")
    assert sorted(r["slice_id"] for r in pending_slices(slices, delivered).collect()) == [1, 3]


def test_batches_count_once_and_never_gather_rows(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    times = df.select(F.unix_millis(F.col("ts").cast("timestamp")).alias("event_time_ms"))
    batches = replay_batches(times, 10, 1.0)
    batches.collect()
    plan = batches._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    # The table is read once, and the only single-partition step is the one over the sums per hour.
    assert plan.count("FileScan") == 1 and "ReusedExchange" in plan
    assert plan.count("Exchange SinglePartition") == 1
    assert "ReadSchema: struct<ts:timestamp_ntz>" in plan
