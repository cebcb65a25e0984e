"""The queries of ``queries`` in plain SQL over the same tables, for another engine to check them."""

from __future__ import annotations

from pulsetrail.fixed_values import (
    MAX_PAUSE_S,
    PARAM_COLUMNS,
    PLAIN_NUMBER,
    SUMMARY_ARRAYS,
    SUMMARY_GROUP,
    SUMMARY_PERCENTILES,
    TRACE_ARRAYS,
    TRACE_COLUMNS,
)
from pulsetrail.plans.queries import (
    BATCH_SIZE,
    CUT,
    DAY,
    DIGITS,
    FAST,
    SLICE_MS,
    SLICE_SPEED,
    SPEED,
    STATION,
    TRACE_BATCH,
    TRACE_SPEED,
)
from pulsetrail.sources.samples import trace_columns

EVENTS = "SELECT *, epoch_us(ts) // 1000 AS ms, strftime(ts, '%Y-%m-%d') AS dt FROM events"
JSON_TIME = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%g')"
TIMED_VALUE = "to_json({'user_id': user_id, 'event_type': event_type, 'value': value, 'props': props})"
FULL_VALUE = (
    f"to_json({{'ts': {JSON_TIME}, 'user_id': user_id, 'event_type': event_type, 'value': value, 'props': props}})"
)
COPY_VALUE = "to_json({'event_id': event_id, 'event_type': event_type, 'value': value, 'props': props})"
HOLES = f"SELECT event_id, CASE WHEN event_type <> 'error' THEN ms END AS ms FROM ({EVENTS})"
HOUR, DAY_MS = 3_600_000, 86_400_000


def all_sql() -> dict[str, str]:
    day = f"WITH e AS ({EVENTS}) SELECT event_id, ms AS ts, user_id, event_type, value, props, dt FROM e WHERE dt = '{DAY}'"
    timed = f"WITH e AS ({EVENTS}) SELECT event_id::VARCHAR AS key, {TIMED_VALUE}::VARCHAR AS value, ms AS event_time_ms"
    full = f"WITH e AS ({EVENTS}) SELECT event_id::VARCHAR AS key, {FULL_VALUE}::VARCHAR AS value FROM e"
    hourly = f"{timed}, ms // {HOUR} * {HOUR} AS chunk FROM e"
    slices = _slices()
    station = ", ".join((*STATION, *PARAM_COLUMNS))
    return {
        "load_day": day,
        "load_day_orc": day,
        "chunk_scan": hourly,
        "csv_export": f"SELECT event_id, ms AS ts, user_id, event_type, value, props, dt FROM ({EVENTS})",
        "envelope_json": f"{timed} FROM e",
        "envelope_max_speed": full,
        "envelope_binary": "SELECT event_id::VARCHAR AS key, props AS value FROM events",
        "envelope_trace": _envelope_trace("lot_id", ("lot_id", "dt", "fab"), ""),
        "envelope_trace_timed": _envelope_trace(
            "eqp_id", ("eqp_id", "ts", "dt", "fab"), ", epoch_us(ts) // 1000 AS event_time_ms"
        ),
        "envelope_key_json": f"""
            WITH e AS ({EVENTS})
            SELECT to_json({{'user_id': user_id}})::VARCHAR AS key,
                   to_json({{'event_id': event_id, 'ts': {JSON_TIME}, 'event_type': event_type, 'value': value,
                             'props': props}})::VARCHAR AS value,
                   ms AS event_time_ms
            FROM e""",
        "envelope_key_literal": f"""
            WITH e AS ({EVENTS})
            SELECT 'test-key' AS key,
                   to_json({{'event_id': event_id, 'user_id': user_id, 'event_type': event_type, 'value': value,
                             'props': props}})::VARCHAR AS value,
                   ms AS event_time_ms
            FROM e""",
        "event_time_ms": f"SELECT event_id, ms AS event_time_ms FROM ({EVENTS})",
        "rejects": """
            SELECT event_id, CASE WHEN event_type <> 'error' THEN event_id END AS event_key,
                   CASE event_type WHEN 'error' THEN 'null_key' WHEN 'signup' THEN 'null_event_time'
                                   ELSE 'sent' END AS reason
            FROM events""",
        "rejects_retried": """
            SELECT event_id, CASE WHEN ok THEN NULL WHEN event_type = 'error' THEN 'null_key' ELSE 'null_event_time' END AS reason,
                   CASE WHEN event_type = 'signup' AND ok THEN 1 WHEN ok THEN 2 ELSE 3 END::INTEGER AS tries,
                   CASE WHEN ok THEN 'delivered' ELSE 'dead' END AS state, ok::BIGINT AS arrived
            FROM (SELECT event_id, event_type, CASE event_type WHEN 'error' THEN event_id % 2 = 0 ELSE event_id % 3 = 0 END AS ok
                  FROM events WHERE event_type IN ('error', 'signup'))""",
        "max_speed_messages": full,
        "paced_messages": f"""
            WITH e AS ({EVENTS})
            SELECT event_id::VARCHAR AS key, {TIMED_VALUE}::VARCHAR AS value,
                   (SELECT min(ms) FROM e) + (ms - (SELECT min(ms) FROM e)) // {DAY_MS} * {DAY_MS} AS from_ms
            FROM e""",
        "paced_resume": f"SELECT key, value FROM ({timed} FROM e)",
        "delivery_progress": f"""
            WITH s AS ({slices}),
                 r AS (SELECT from_ms, rows, (sum(rows) OVER w)::BIGINT AS sent, sum(rows) OVER () AS total,
                              (due_ms - min(due_ms) OVER ())::DOUBLE / 1000 AS elapsed
                       FROM s WINDOW w AS (ORDER BY from_ms))
            SELECT from_ms, rows, sent, {_rounded("percent", "sent * 100.0::DOUBLE / total")},
                   {_rounded("elapsed_s", "elapsed")},
                   {_rounded("rows_per_s", "CASE WHEN elapsed > 0 THEN sent / elapsed END")}
            FROM r""",
        "delivered_once": f"{timed} FROM e",
        "count_by_date_files": f"SELECT dt, count(*) AS cnt FROM ({EVENTS}) GROUP BY 1",
        "latest_date_files": f"SELECT max(dt) AS dt FROM ({EVENTS})",
        "replay_day": f"{full} WHERE dt = '{DAY}'",
        "stream_replay": f"SELECT key, value FROM ({timed} FROM e)",
        "stream_by_time": f"""
            WITH e AS ({EVENTS}), s AS (SELECT (ms - (SELECT min(ms) FROM e)) // {DAY_MS} AS epoch, ms FROM e)
            SELECT epoch::INTEGER AS epoch, min(ms) AS first_ms, max(ms) AS last_ms, count(*) AS rows FROM s GROUP BY 1""",
        "reconcile_content": f"""
            WITH e AS ({EVENTS}), m AS (SELECT event_id, event_type, {TIMED_VALUE}::VARCHAR AS value FROM e)
            SELECT event_id::VARCHAR AS key, value, 1::BIGINT AS sent, 0::BIGINT AS delivered, 'missing' AS finding
            FROM m WHERE event_type = 'error'
            UNION ALL SELECT event_id::VARCHAR, value, 1, 2, 'repeated' FROM m WHERE event_type = 'click' AND event_id % 5 = 0
            UNION ALL SELECT event_id::VARCHAR, value || '!', 0, 1, 'changed' FROM m WHERE event_type = 'purchase' AND event_id % 7 = 0
            UNION ALL SELECT event_id::VARCHAR, value, 1, 0, 'changed' FROM m WHERE event_type = 'purchase' AND event_id % 7 = 0
            UNION ALL SELECT event_id::VARCHAR || 'x', value, 0, 1, 'moved' FROM m WHERE event_type = 'signup' AND event_id % 3 = 0
            UNION ALL SELECT event_id::VARCHAR, value, 1, 0, 'moved' FROM m WHERE event_type = 'signup' AND event_id % 3 = 0""",
        "prepare_chunks": hourly,
        "chunks_of_copies": f"""
            WITH e AS ({EVENTS} UNION ALL {EVENTS})
            SELECT user_id::VARCHAR AS key, {COPY_VALUE}::VARCHAR AS value, ms AS event_time_ms,
                   ms // {DAY_MS} * {DAY_MS} AS chunk
            FROM e""",
        "chunk_manifest": f"""
            SELECT ms // {HOUR} * {HOUR} AS chunk, count(*) AS rows, min(ms) AS first_ms, max(ms) AS last_ms
            FROM ({EVENTS}) GROUP BY 1""",
        "reconcile": """
            WITH s AS (SELECT user_id, count(*) AS n FROM events GROUP BY 1),
                 d AS (SELECT user_id, sum(CASE WHEN event_type = 'click' THEN 2 ELSE 1 END) AS n
                       FROM events WHERE event_type <> 'error' GROUP BY 1)
            SELECT s.user_id::VARCHAR AS key, s.n AS sent, coalesce(d.n, 0)::BIGINT AS delivered,
                   (s.n - coalesce(d.n, 0))::BIGINT AS missing
            FROM s LEFT JOIN d USING (user_id)""",
        "global_rank": f"""
            SELECT event_id, ms AS event_time_ms, row_number() OVER (ORDER BY ms, event_id) AS rank
            FROM ({EVENTS})""",
        "global_rank_copies": f"""
            SELECT day_ms, row_number() OVER (ORDER BY day_ms) AS rank
            FROM (SELECT ms // {DAY_MS} * {DAY_MS} AS day_ms FROM ({EVENTS} UNION ALL {EVENTS}))""",
        "replay_schedule_holes": f"""
            WITH e AS ({HOLES})
            SELECT event_id, ms AS event_time_ms,
                   floor((ms - (SELECT min(ms) FROM e)) / {SPEED})::BIGINT AS due_ms
            FROM e""",
        "replay_batches_holes": f"""
            {_batches(f"SELECT ms FROM ({HOLES}) WHERE ms IS NOT NULL", BATCH_SIZE, SPEED)}
            UNION ALL SELECT NULL, n, NULL, NULL, NULL
            FROM (SELECT count(*) AS n FROM ({HOLES}) WHERE ms IS NULL) WHERE n > 0""",
        "replay_slices_holes": _slices(HOLES),
        "replay_schedule": f"""
            WITH e AS ({EVENTS})
            SELECT event_id, ms AS event_time_ms,
                   floor((ms - (SELECT min(ms) FROM e)) / {SPEED})::BIGINT AS due_ms
            FROM e""",
        "replay_batches": _batches(EVENTS, BATCH_SIZE, SPEED),
        "replay_batches_fast": _batches(EVENTS, BATCH_SIZE, FAST),
        "replay_batches_trace": _batches(
            f"SELECT epoch_us(ts) // 1000 AS ms FROM ({_trace()})", TRACE_BATCH, TRACE_SPEED
        ),
        "replay_progress": f"""
            WITH b AS ({_batches(EVENTS, BATCH_SIZE, SPEED)}),
                 r AS (SELECT batch_id, rows, (sum(rows) OVER w)::BIGINT AS sent,
                              (sum(pause_s) OVER w)::BIGINT AS elapsed_s, sum(rows) OVER () AS total
                       FROM b WINDOW w AS (ORDER BY batch_id))
            SELECT batch_id, rows, sent, {_rounded("percent", "sent * 100.0::DOUBLE / total")}, elapsed_s,
                   {_rounded("rows_per_s", "CASE WHEN elapsed_s > 0 THEN sent::DOUBLE / elapsed_s END")}
            FROM r""",
        "replay_slices": slices,
        "pending_slices": f"WITH s AS ({slices}) SELECT * FROM s WHERE rows < (SELECT avg(rows) FROM s)",
        "day_profile": f"""
            SELECT count(*) AS total, count(DISTINCT dt) AS distinct_dt, count(DISTINCT lot_id) AS distinct_lot_id
            FROM ({_trace()})""",
        "event_profile": f"""
            SELECT count(*) AS total, count(DISTINCT dt) AS distinct_dt, count(DISTINCT event_type) AS distinct_event_type
            FROM ({EVENTS})""",
        "count_by_date": f"SELECT dt, count(*) AS cnt FROM ({EVENTS}) GROUP BY 1",
        "count_by_date_type": f"SELECT dt, event_type, count(*) AS cnt FROM ({EVENTS}) GROUP BY 1, 2",
        "count_by_lot": f"SELECT lot_id, count(*) AS cnt FROM ({_trace()}) GROUP BY 1",
        "count_by_date_fab": f"SELECT dt, fab, count(*) AS cnt FROM ({_trace()}) GROUP BY 1, 2",
        "count_by_lot_eqp": f"SELECT lot_id, eqp_id, count(*) AS cnt FROM ({_trace()}) GROUP BY 1, 2",
        "latest_date": f"SELECT max(dt) AS dt FROM ({EVENTS})",
        "preview": f"""
            SELECT event_id, ms AS ts, user_id, event_type, value, props, dt FROM ({EVENTS}) ORDER BY event_id LIMIT 10""",
        "param_count": f"""
            SELECT lot_id, eqp_id, epoch_us(ts) // 1000 AS ts, len(param_name)::INTEGER AS param_count,
                   array_to_string(param_name, '|') AS param_name, array_to_string(param_value, '|') AS param_value
            FROM ({_trace()})""",
        "trace_flatten": _flatten(),
        "param_summary": _summary(_trace(), STATION),
        "param_integral": f"SELECT {station}, integral_val FROM ({_summary(_trace(), STATION)})",
        "step_runs": _step_runs(),
        "step_merges": f"""
            SELECT eqp_id, module_name, step_id, count(*) AS runs, sum(samples)::BIGINT AS samples,
                   CASE WHEN count(*) > 1 THEN 'Y' ELSE 'N' END AS step_merge_yn
            FROM ({_step_runs()}) GROUP BY ALL""",
        "summary_packed": _packed(_summary(_trace(), STATION), STATION),
        "summary_by_lot": _packed(_summary(_trace(), SUMMARY_GROUP), SUMMARY_GROUP),
    }


# --- schedule -----------------------------------------------------------------------------------


def _batches(times: str, size: int, speed: float) -> str:
    return f"""
        WITH ranked AS (SELECT ms, (row_number() OVER (ORDER BY ms) - 1) // {size} AS batch_id FROM ({times})),
             b AS (SELECT batch_id, count(*) AS rows, min(ms) AS first_ms, max(ms) AS last_ms
                   FROM ranked GROUP BY 1),
             g AS (SELECT *, last_ms - coalesce(lag(last_ms) OVER (ORDER BY batch_id), first_ms) AS gap FROM b)
        SELECT batch_id, rows, first_ms, last_ms,
               greatest(least(trunc(gap / {speed} / 1000.0)::BIGINT, {MAX_PAUSE_S}), 0)::BIGINT AS pause_s
        FROM g"""


def _slices(events: str = EVENTS) -> str:
    span = round(SLICE_MS * SLICE_SPEED)
    return f"""
        WITH e AS ({events}), base AS (SELECT min(ms) AS first FROM e),
             s AS (SELECT (ms - first) // {span} AS slice_id, first, count(*) AS rows FROM e, base GROUP BY 1, 2)
        SELECT slice_id, first + slice_id * {span} AS from_ms, first + (slice_id + 1) * {span} AS to_ms, rows,
               floor(slice_id * {span} / {SLICE_SPEED})::BIGINT AS due_ms
        FROM s"""


# --- traces -------------------------------------------------------------------------------------


def _trace() -> str:
    ts = "(l_shipdate + to_seconds(l_orderkey % 86400))"
    times = {"ts": ts, "start_dtts": "l_shipdate::TIMESTAMP", "create_dtts": ts, "dt": "strftime(l_shipdate, '%Y-%m-%d')"}
    columns = trace_columns("list_value") | times
    return f"SELECT {', '.join(f'{columns[name]} AS {name}' for name in TRACE_COLUMNS)} FROM lineitem"


def _step_runs() -> str:
    return f"""
        WITH s AS (SELECT eqp_id, module_name, step_id, epoch_us(ts) AS us,
                          row_number() OVER w - row_number() OVER (PARTITION BY eqp_id, module_name, step_id ORDER BY ts) AS island
                   FROM ({_trace()}) WINDOW w AS (PARTITION BY eqp_id, module_name ORDER BY ts, step_id))
        SELECT eqp_id, module_name, step_id, min(us) AS first_us, max(us) AS last_us, count(*) AS samples
        FROM s GROUP BY eqp_id, module_name, step_id, island"""


def _envelope_trace(key: str, left_out: tuple[str, ...], more: str) -> str:
    times = ("ts", "start_dtts", "create_dtts")
    fields = [
        f"'{c}': " + (f"strftime({c}, '%Y-%m-%dT%H:%M:%S.%gZ')" if c in times else c)
        for c in TRACE_COLUMNS
        if c not in left_out
    ]
    return f"SELECT {key} AS key, to_json({{{', '.join(fields)}}})::VARCHAR AS value{more} FROM ({_trace()})"


def _flatten() -> str:
    times = ("ts", "start_dtts", "create_dtts")
    columns = []
    for c in TRACE_COLUMNS:
        if c in times:
            columns.append(f"epoch_us({c}) // 1000 AS {c}")
        elif c == "param_value":
            number = _number("param_value[i]")
            columns.append(f"CASE WHEN ({number}) IS NULL THEN param_value[i] END AS param_value, {number} AS param_number")
        elif c in TRACE_ARRAYS:
            columns.append(f"{c}[i] AS {c}")
        else:
            columns.append(c)
    return f"""
        SELECT {", ".join(columns)}, (i - 1)::INTEGER AS param_pos
        FROM (SELECT *, unnest(range(1, len(param_name) + 1)) AS i FROM ({_trace()}))"""


def _number(text: str) -> str:
    return f"CASE WHEN regexp_matches(trim({text}), '{PLAIN_NUMBER}') THEN try_cast(trim({text}) AS DOUBLE) END"


def _summary(trace: str, group: tuple[str, ...]) -> str:
    keys = ", ".join((*group, *PARAM_COLUMNS))
    percentiles = ", ".join(_rounded(name, f"quantile_cont(v, {p})") for name, p in SUMMARY_PERCENTILES)
    slope = "regr_slope(v, (us - (SELECT min(us) FROM flat)) / 1e6)"
    return f"""
        WITH flat AS (
                 SELECT {", ".join(group)}, epoch_us(ts) AS us,
                        {", ".join(f"{c}[i] AS {c}" for c in PARAM_COLUMNS)},
                        {_number("param_value[i]")} AS v
                 FROM (SELECT *, unnest(range(1, len(param_name) + 1)) AS i FROM ({trace}))),
             steps AS (
                 SELECT *, (v + lag(v) OVER w) / 2 * ((us - lag(us) OVER w) / 1e6) AS area
                 FROM flat
                 WINDOW w AS (PARTITION BY {keys}, v IS NULL ORDER BY us, v))
        SELECT {keys}, {_rounded("max_val", "max(v)")}, {_rounded("min_val", "min(v)")},
               {_rounded("mean_val", "avg(v)")}, {_rounded("stddev_val", "stddev_samp(v)")},
               {_rounded("range_val", "max(v) - min(v)")}, {percentiles},
               {_rounded("integral_val", "CASE WHEN count(v) > 0 THEN coalesce(sum(area), 0) END")},
               {_rounded("slope_val", f"CASE WHEN NOT isnan({slope}) THEN {slope} END")},
               count(v) AS count_val, {_rounded("sumsq_val", "sum(v * v)")},
               min(us) // 1000 AS start_time, max(us) // 1000 AS end_time
        FROM steps GROUP BY {keys}"""


def _packed(summary: str, group: tuple[str, ...]) -> str:
    texts = []
    for name in SUMMARY_ARRAYS:
        plain = name in PARAM_COLUMNS or name in ("count_val", "start_time")
        shown = f"coalesce({name}::VARCHAR, '-')" if plain else f"coalesce({_digits(name)}, '-')"
        texts.append(f"string_agg({shown}, '|' ORDER BY param_name, param_svid) AS {name}")
    return f"""
        SELECT {", ".join(group)}, max(end_time) AS end_time, {", ".join(texts)}
        FROM ({summary}) GROUP BY {", ".join(group)}"""


def _rounded(name: str, expression: str) -> str:
    """The value cut to the digits that the queries keep, under its name."""
    return f"{_digits(expression)}::DOUBLE AS {name}"


def _digits(expression: str) -> str:
    x = f"({expression})::DOUBLE"
    return f"""(SELECT CASE WHEN x = 0 THEN '0e0' WHEN x IS NOT NULL THEN
        floor(CASE WHEN k < 0 THEN x / pow(10.0::DOUBLE, -k) ELSE x * pow(10.0::DOUBLE, k) END + {CUT}::DOUBLE)::BIGINT
          || 'e' || (-k) END
        FROM (SELECT x, ({DIGITS - 1} - floor(log10(abs(nullif(x, 0)))))::BIGINT AS k FROM (SELECT {x} AS x)))"""
