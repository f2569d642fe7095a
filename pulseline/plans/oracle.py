"""DuckDB SQL oracles, one per registered query (same column names and types).

They restate each query's meaning directly in SQL over the raw driver
tables: the heartbeat mapping, the fault classes (by the event's ``k``), the
replay copy, keep-first dedup, validation messages, Murmur2 — nothing is
shared with the Spark implementation except the fixed values.
"""

from __future__ import annotations

from pulseline.functions.murmur import MURMUR_M, MURMUR_SEED
from pulseline.plans.fixtures import BATCH_FROM, COUNTER_TICK, OUTAGE, ROUND, SECOND_OUTAGE, STORED_BEFORE, TIE_SHIFT

MS, RATE, RATIO = ROUND["ms"], ROUND["rate"], ROUND["ratio"]

# ---------------------------------------------------------------- building blocks
H = """h AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, event_id AS arrival_seq,
    'session-' || CAST(user_id AS VARCHAR) AS session_id,
    'client-' || CAST(user_id AS VARCHAR) AS client_id,
    'content-' || CAST(event_id % 5 AS VARCHAR) AS content_id,
    epoch_us(ts) // 1000 AS timestamp_ms,
    CAST(date_trunc('milliseconds', ts) AS TIMESTAMP) AS ts,
    value AS video_start_time_ms,
    event_type = 'error' AS playback_failed,
    CAST(json_extract_string(props, '$.k') AS DOUBLE) AS rebuffer_duration_ms,
    CASE WHEN event_type = 'signup' THEN CAST(0.0 AS DOUBLE) ELSE value * 1000 END AS playback_duration_ms,
    CASE WHEN event_id % 7 = 0 THEN NULL ELSE '5.' || CAST(event_id % 4 AS VARCHAR) END AS player_version,
    'os-' || CAST(event_id % 6 AS VARCHAR) AS os,
    'cdn-' || CAST(event_id % 3 AS VARCHAR) AS cdn,
    CAST(json_extract_string(props, '$.k') AS INTEGER) AS fault_key
  FROM events)"""



def moment(percent: int) -> str:
    """The whole second after ``percent`` of the events' time span."""
    low, high = "min(epoch_us(ts) // 1000000)", "max(epoch_us(ts) // 1000000)"
    return f"(SELECT make_timestamp(CAST(({low} + ({high} - {low}) * {percent} // 100) * 1000000 AS BIGINT)) FROM events)"


def within(percents: tuple[int, int]) -> str:
    return f"ts >= {moment(percents[0])} AND ts < {moment(percents[1])}"


HB_COLS = ("event_id, session_id, client_id, content_id, ts, video_start_time_ms, "
           "playback_failed, rebuffer_duration_ms, playback_duration_ms, player_version, os, cdn")
DEDUP_COLS = "arrival_seq, timestamp_ms, " + HB_COLS
# the replay copy: offsets after all first ones, refreshed start time
COPY_COLS = ("arrival_seq + 1 + (SELECT max(event_id) FROM events) AS arrival_seq, timestamp_ms, event_id, session_id, "
             "client_id, content_id, ts, video_start_time_ms + 1.0 AS video_start_time_ms, "
             "playback_failed, rebuffer_duration_ms, playback_duration_ms, player_version, os, cdn")

REJECT_KEYS = "(0, 1, 2, 3, 6, 7, 8, 9)"
REJECTED = f"""rj AS (
  SELECT arrival_seq AS request_id, ts AS received_at,
    CASE fault_key WHEN 8 THEN '' WHEN 9 THEN NULL ELSE event_id END AS event_id,
    CASE WHEN fault_key IN (6, 9) THEN 'deserialization-failure'
         WHEN fault_key = 3 THEN 'storage-bounds-violation'
         ELSE 'validation-failure' END AS reason,
    CASE fault_key
      WHEN 0 THEN 'sessionId: must not be blank'
      WHEN 1 THEN 'timestampMs: must be greater than 0'
      WHEN 2 THEN 'clientId: must not be blank'
      WHEN 3 THEN 'content_id: longer than 128'
      WHEN 6 THEN 'videoStartTimeMs: type mismatch'
      WHEN 7 THEN 'sessionId: must not be blank'
      WHEN 8 THEN 'eventId: must not be blank; timestampMs: must be greater than 0'
      WHEN 9 THEN 'malformed JSON' END AS violations
  FROM h WHERE fault_key IN {REJECT_KEYS})"""

# topic records: every event twice (second delivery later, refreshed VST)
T = f"""t AS (
  SELECT {DEDUP_COLS}, fault_key FROM h
  UNION ALL
  SELECT {COPY_COLS}, fault_key FROM h)"""

# decoded topic rows: truncated / null payloads fail, empty payload = all defaults
TD = """td AS (
  SELECT arrival_seq AS "offset",
    CASE WHEN fault_key = 12 THEN CAST(0 AS BIGINT) ELSE timestamp_ms END AS timestamp_ms,
    CASE WHEN fault_key = 12 THEN '' ELSE event_id END AS event_id,
    CASE WHEN fault_key = 12 THEN '' ELSE session_id END AS session_id,
    CASE WHEN fault_key = 12 THEN '' ELSE client_id END AS client_id,
    CASE WHEN fault_key = 12 THEN '' ELSE content_id END AS content_id,
    CASE WHEN fault_key = 12 THEN TIMESTAMP '1970-01-01 00:00:00' ELSE ts END AS ts,
    CASE WHEN fault_key = 12 THEN CAST(0.0 AS DOUBLE) ELSE video_start_time_ms END AS video_start_time_ms,
    CASE WHEN fault_key = 12 THEN false ELSE playback_failed END AS playback_failed,
    CASE WHEN fault_key = 12 THEN CAST(0.0 AS DOUBLE) ELSE rebuffer_duration_ms END AS rebuffer_duration_ms,
    CASE WHEN fault_key = 12 THEN CAST(0.0 AS DOUBLE) ELSE playback_duration_ms END AS playback_duration_ms,
    CASE WHEN fault_key = 12 THEN '' ELSE coalesce(player_version, '') END AS player_version,
    CASE WHEN fault_key = 12 THEN '' ELSE os END AS os,
    CASE WHEN fault_key = 12 THEN '' ELSE cdn END AS cdn
  FROM t WHERE fault_key NOT IN (4, 11))"""


def _kpi_select(keys: str) -> str:
    lead = f"{keys}, " if keys else ""
    return (f"SELECT {lead}min(ts) AS window_start, max(ts) AS window_end, "
            f"round(avg(video_start_time_ms), {MS}) AS avg_vst_ms, "
            f"round(CAST(count(*) FILTER (WHERE playback_failed) AS DOUBLE) / CAST(count(*) AS DOUBLE), {RATE}) AS pfr, "
            "round(CASE WHEN sum(playback_duration_ms) > 0 "
            "THEN sum(rebuffer_duration_ms) / sum(playback_duration_ms) "
            f"ELSE CAST(0 AS DOUBLE) END, {RATIO}) AS rebuffering_ratio, "
            "count(*) AS event_count")


def _mul(x: str) -> str:
    # DuckDB binds + tighter than << and &: every shift is parenthesised
    return (f"(((({x}) & 65535) * {MURMUR_M}) + "
            f"(((((({x}) >> 16) & 65535) * {MURMUR_M}) & 65535) << 16)) & 4294967295")


def _murmur_ctes(src: str) -> str:
    """CTEs ending in ``hs(session_id, murmur2_hash)`` for the distinct sessions of ``src``."""
    mix = "xor(h, k)"
    return f"""s AS (SELECT DISTINCT session_id FROM {src}),
  bt AS (SELECT session_id, octet_length(encode(session_id)) AS n,
           list_transform(range(octet_length(encode(session_id))),
             lambda i: ('0x' || substr(hex(encode(session_id)), 2 * i + 1, 2))::BIGINT) AS b
         FROM s),
  bl AS (SELECT session_id, n, b,
           list_transform(range(n // 4),
             lambda j: b[4 * j + 1] | (b[4 * j + 2] << 8) | (b[4 * j + 3] << 16) | (b[4 * j + 4] << 24)) AS k0
         FROM bt),
  k1 AS (SELECT session_id, n, b, list_transform(k0, lambda k: {_mul('k')}) AS kk FROM bl),
  k2 AS (SELECT session_id, n, b, list_transform(kk, lambda k: xor(k, k >> 24)) AS kk FROM k1),
  k3 AS (SELECT session_id, n, b, list_transform(kk, lambda k: {_mul('k')}) AS kk FROM k2),
  m0 AS (SELECT session_id, n, b,
           list_reduce(kk, lambda h, k: xor({_mul('h')}, k), xor(CAST({MURMUR_SEED} AS BIGINT), n)) AS h
         FROM k3),
  m1 AS (SELECT session_id, n, h,
           xor(xor(CASE WHEN n % 4 >= 3 THEN b[(n // 4) * 4 + 3] << 16 ELSE 0 END,
                   CASE WHEN n % 4 >= 2 THEN b[(n // 4) * 4 + 2] << 8 ELSE 0 END),
               CASE WHEN n % 4 >= 1 THEN b[(n // 4) * 4 + 1] ELSE 0 END) AS tl
         FROM m0),
  m2 AS (SELECT session_id, CASE WHEN n % 4 >= 1 THEN {_mul('xor(h, tl)')} ELSE h END AS h FROM m1),
  m3 AS (SELECT session_id, xor(h, h >> 13) AS h FROM m2),
  m4 AS (SELECT session_id, {_mul('h')} AS h FROM m3),
  m5 AS (SELECT session_id, xor(h, h >> 15) AS h FROM m4),
  hs AS (SELECT session_id,
           CAST(CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END AS INTEGER) AS murmur2_hash
         FROM m5)"""


def _floor15(ts: str = "ts") -> str:
    return f"(date_trunc('minute', {ts}) + to_seconds((second({ts}) // 15) * 15))"


# ---------------------------------------------------------------- oracles
ORACLE: dict[str, str] = {}

ORACLE["session_kpis"] = f"WITH {H} {_kpi_select('session_id')} FROM h GROUP BY session_id"

ORACLE["global_kpis"] = f"WITH {H} {_kpi_select('')} FROM h"

ORACLE["headline_kpis"] = (f"WITH {H}, k AS ({_kpi_select('session_id')} FROM h GROUP BY session_id) "
                           "SELECT * FROM k ORDER BY window_end DESC, session_id DESC LIMIT 1")

ORACLE["kpi_timeseries"] = f"""WITH {H}
SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
  round(avg(video_start_time_ms), {MS}) AS avg_vst_ms,
  round(CAST(count(*) FILTER (WHERE playback_failed) AS DOUBLE) / CAST(count(*) AS DOUBLE), {RATE}) AS pfr,
  round(CASE WHEN sum(playback_duration_ms) > 0 THEN sum(rebuffer_duration_ms) / sum(playback_duration_ms)
        ELSE CAST(0 AS DOUBLE) END, {RATIO}) AS rebuffering_ratio,
  count(*) AS event_count
FROM h GROUP BY 1, 2"""

ORACLE["dedup_events"] = f"""WITH {H},
  hd AS (SELECT {DEDUP_COLS} FROM h UNION ALL SELECT {COPY_COLS} FROM h)
SELECT {DEDUP_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY arrival_seq) AS rn FROM hd) x
WHERE rn = 1"""

ORACLE["append_new_events"] = f"""WITH {H},
  b0 AS (SELECT * FROM h WHERE ts >= {moment(BATCH_FROM)}),
  b AS (SELECT {DEDUP_COLS} FROM b0 UNION ALL SELECT {COPY_COLS} FROM b0),
  f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY arrival_seq) AS rn
                       FROM b) x WHERE rn = 1)
SELECT {DEDUP_COLS} FROM f
WHERE NOT EXISTS (SELECT 1 FROM h s WHERE s.ts < {moment(STORED_BEFORE)} AND s.event_id = f.event_id)"""

ORACLE["exists_by_event_id"] = f"""WITH {H}
SELECT event_id, arrival_seq,
  EXISTS (SELECT 1 FROM h s WHERE s.ts < {moment(STORED_BEFORE)} AND s.event_id = h.event_id) AS "exists"
FROM h"""

ORACLE["events_by_id"] = f"WITH {H} SELECT {HB_COLS} FROM h WHERE fault_key IN {REJECT_KEYS}"

ORACLE["validate_accept"] = f"""WITH {H}
SELECT arrival_seq AS request_id, timestamp_ms, event_id, session_id, client_id, content_id, ts,
  video_start_time_ms, playback_failed, rebuffer_duration_ms, playback_duration_ms,
  CASE WHEN fault_key = 10 THEN NULL ELSE player_version END AS player_version, os, cdn
FROM h WHERE fault_key NOT IN {REJECT_KEYS}"""

ORACLE["validate_reject"] = f"WITH {H}, {REJECTED} SELECT request_id, event_id, reason, violations FROM rj"

ORACLE["decode_roundtrip"] = f'WITH {H}, {T}, {TD} SELECT "offset", timestamp_ms, {HB_COLS} FROM td'

ORACLE["dead_letters_by_reason"] = f"""WITH {H}, {T}, {REJECTED}
SELECT reason, count(*) AS dead_letters FROM (
  SELECT 'deserialization-failure' AS reason FROM t WHERE fault_key IN (4, 11)
  UNION ALL SELECT reason FROM rj) x
GROUP BY reason"""

ORACLE["ingest_summary"] = f"""WITH {H}, {T}, {TD}
SELECT (SELECT count(*) FROM t) AS consumed,
  (SELECT count(*) FROM td) AS ok,
  (SELECT count(*) FROM t WHERE fault_key IN (4, 11)) AS dead_lettered,
  (SELECT count(DISTINCT event_id) FROM td) AS stored_new,
  (SELECT count(*) FROM td) - (SELECT count(DISTINCT event_id) FROM td) AS duplicates"""

ORACLE["session_partition_id"] = f"""WITH {H}, {_murmur_ctes('h')}
SELECT session_id, murmur2_hash,
  CAST(abs(CAST(murmur2_hash AS BIGINT)) % 12 AS INTEGER) AS partition_12,
  CAST(abs(CAST(murmur2_hash AS BIGINT)) % 24 AS INTEGER) AS partition_24
FROM hs"""

ORACLE["partition_load"] = f"""WITH {H}, {_murmur_ctes('h')},
  per AS (SELECT session_id, count(*) AS events FROM h GROUP BY session_id)
SELECT CAST(abs(CAST(hs.murmur2_hash AS BIGINT)) % 24 AS INTEGER) AS partition_id,
  count(*) AS sessions, CAST(sum(per.events) AS BIGINT) AS events
FROM per JOIN hs USING (session_id) GROUP BY 1"""

ORACLE["ingestion_rate"] = f"""WITH {H}
SELECT date_trunc('minute', ts) AS window_start, date_trunc('minute', ts) + INTERVAL 1 MINUTE AS window_end,
  count(*) AS events, round(CAST(count(*) AS DOUBLE) / 60.0, {RATE}) AS events_per_s
FROM h GROUP BY 1, 2"""

ORACLE["ingestion_rate_sliding"] = f"""WITH {H},
  w AS (SELECT {_floor15()} - to_seconds(unnest([0, 15, 30, 45])) AS ws FROM h)
SELECT ws AS window_start, ws + INTERVAL 1 MINUTE AS window_end,
  count(*) AS events, round(CAST(count(*) AS DOUBLE) / 60.0, {RATE}) AS events_per_s
FROM w GROUP BY ws"""

ORACLE["throughput_compare"] = f"""WITH {H},
  u AS (SELECT ts, true AS ing FROM h WHERE fault_key NOT IN {REJECT_KEYS}
        UNION ALL SELECT ts, false FROM h
        UNION ALL SELECT ts, false FROM h)
SELECT date_trunc('minute', ts) AS window_start, date_trunc('minute', ts) + INTERVAL 1 MINUTE AS window_end,
  count(*) FILTER (WHERE ing) AS ingested, count(*) FILTER (WHERE NOT ing) AS consumed,
  round(CAST(count(*) FILTER (WHERE ing) AS DOUBLE) / 60.0, {RATE}) AS ingested_per_s,
  round(CAST(count(*) FILTER (WHERE NOT ing) AS DOUBLE) / 60.0, {RATE}) AS consumed_per_s
FROM u GROUP BY 1, 2"""

LOG = """lg AS (SELECT arrival_seq AS request_id, ts AS received_at,
  CAST(round(video_start_time_ms * 1000000) AS BIGINT) AS latency_ns, playback_failed AS error FROM h)"""

ORACLE["latency_report"] = f"""WITH {H}, {LOG}
SELECT date_trunc('minute', received_at) AS window_start,
  date_trunc('minute', received_at) + INTERVAL 1 MINUTE AS window_end,
  count(*) AS requests,
  round(sum(latency_ns / 1e9) / count(*) * 1000.0, {MS}) AS avg_latency_ms,
  round(max(latency_ns / 1e9) * 1000.0, {MS}) AS max_latency_ms
FROM lg GROUP BY 1, 2"""

ORACLE["sla_breaches"] = f"""WITH {H}, {LOG}
SELECT request_id, received_at, latency_ns // 1000000 AS latency_ms FROM lg
WHERE latency_ns // 1000000 > 5"""

ORACLE["sla_report"] = f"""WITH {H}, {LOG},
  a AS (SELECT date_trunc('day', received_at) AS period_start, count(*) AS requests,
          count(*) FILTER (WHERE NOT error) AS ok, count(*) FILTER (WHERE error) AS errors,
          quantile_cont(latency_ns / 1e6, 0.99) AS p99
        FROM lg GROUP BY 1)
SELECT period_start, period_start + INTERVAL 1 DAY AS period_end, requests, ok, errors,
  round(CAST(errors AS DOUBLE) / CAST(requests AS DOUBLE), {RATE}) AS error_rate,
  round(p99, {MS}) AS p99_latency_ms,
  round(CAST(requests AS DOUBLE) / 86400.0, {RATE}) AS sent_per_s,
  round(CAST(ok AS DOUBLE) / 86400.0, {RATE}) AS ok_per_s,
  p99 < 200.0 AS p99_pass,
  CAST(errors AS DOUBLE) / CAST(requests AS DOUBLE) < 0.01 AS error_rate_pass
FROM a"""

ORACLE["overflow_alerts"] = f"""WITH {H}, {REJECTED}
SELECT date_trunc('day', received_at) AS window_start,
  date_trunc('day', received_at) + INTERVAL 1 DAY AS window_end, count(*) AS rejected
FROM rj GROUP BY 1, 2 HAVING count(*) > 25"""

ORACLE["publish_summary"] = f"""WITH {H}
SELECT count(*) FILTER (WHERE fault_key NOT IN {REJECT_KEYS}) AS accepted,
  count(*) FILTER (WHERE fault_key IN {REJECT_KEYS}) AS rejected,
  count(*) FILTER (WHERE {within(OUTAGE)}) AS replayed,
  count(*) FILTER (WHERE fault_key NOT IN {REJECT_KEYS})
   + count(*) FILTER (WHERE {within(OUTAGE)}) AS published
FROM h"""

BACKLOG = f"""bk AS (SELECT * FROM h WHERE {within(OUTAGE)})"""

ORACLE["backlog_slice"] = f"WITH {H}, {BACKLOG} SELECT {DEDUP_COLS} FROM bk ORDER BY arrival_seq LIMIT 500"

ORACLE["backlog_report"] = f"""WITH {H}, {BACKLOG}, {_murmur_ctes('h')}
SELECT CAST(abs(CAST(hs.murmur2_hash AS BIGINT)) % 24 AS INTEGER) AS partition_id, bk.session_id,
  count(*) AS buffered, min(arrival_seq) AS first_seq, max(arrival_seq) AS last_seq, min(ts) AS oldest
FROM bk JOIN hs USING (session_id) GROUP BY 1, 2"""

# ---------------------------------------------------------------- streaming runs
# first arrival per event id among decoded topic rows
TDF = """tdf AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY "offset") AS rn FROM td) x WHERE rn = 1)"""

ORACLE["stream_ingest_events"] = f"WITH {H}, {T}, {TD}, {TDF} SELECT {HB_COLS} FROM tdf"

ORACLE["stream_ingest_kpis"] = f"WITH {H}, {T}, {TD} {_kpi_select('session_id')} FROM td GROUP BY session_id"

ORACLE["stream_dead_letters"] = f"""WITH {H}, {T}
SELECT 'deserialization-failure' AS reason, count(*) AS dead_letters FROM t WHERE fault_key IN (4, 11)"""

ORACLE["stream_validated_letters"] = f"""WITH {H}, {T}
SELECT CASE WHEN fault_key = 12 THEN 'validation-failure' ELSE 'deserialization-failure' END AS reason,
  count(*) AS dead_letters
FROM t WHERE fault_key IN (4, 11, 12) GROUP BY 1"""

# one delivery whose store failed for class 13; letters within 7 days of the newest
LETTERS = """d AS (SELECT *, fault_key = 13 AS sound FROM h WHERE fault_key IN (4, 11, 13)),
  kept AS (SELECT * FROM d WHERE ts >= (SELECT max(ts) FROM d) - INTERVAL 7 DAY)"""

ORACLE["replay_dead_letters"] = f"""WITH {H}, {LETTERS}
SELECT CASE WHEN sound THEN 'processing-failure' ELSE 'deserialization-failure' END AS reason,
  count(*) AS retained, count(*) FILTER (WHERE sound) AS recovered,
  count(*) FILTER (WHERE NOT sound) AS still_failing
FROM kept GROUP BY sound"""

ORACLE["recovered_events"] = f"""WITH {H}, {T}, {TD}, {LETTERS},
  one AS (SELECT td.* FROM td JOIN h ON td."offset" = h.arrival_seq AND h.fault_key <> 13),
  live AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY "offset") AS rn FROM one) x
           WHERE rn = 1)
SELECT {HB_COLS}, false AS recovered FROM live
UNION ALL
SELECT event_id, session_id, client_id, content_id, ts, video_start_time_ms, playback_failed,
  rebuffer_duration_ms, playback_duration_ms, coalesce(player_version, '') AS player_version, os, cdn,
  true AS recovered
FROM kept WHERE sound"""

ORACLE["stream_window_kpis"] = f"""WITH {H}
{_kpi_select('session_id').replace('min(ts) AS window_start, max(ts) AS window_end',
  "date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end")}
FROM h GROUP BY session_id, date_trunc('day', ts)"""

ORACLE["stream_session_windows"] = f"""WITH {H},
  g AS (SELECT *, CASE WHEN ts <= lag(ts) OVER s + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS opens
        FROM h WINDOW s AS (PARTITION BY session_id ORDER BY ts)),
  w AS (SELECT *, sum(opens) OVER (PARTITION BY session_id ORDER BY ts) AS n FROM g)
{_kpi_select('session_id').replace('max(ts) AS window_end', 'max(ts) + INTERVAL 6 HOUR AS window_end')
                          .replace(f"END, {RATIO})", f"END + {TIE_SHIFT!r}, {RATIO})")}
FROM w GROUP BY session_id, n"""

ORACLE["replay_backlog"] = f"""WITH {H}
SELECT event_id, session_id, client_id, content_id, ts, video_start_time_ms, playback_failed,
  rebuffer_duration_ms, playback_duration_ms, coalesce(player_version, '') AS player_version, os, cdn,
  {within(OUTAGE)} AS replayed
FROM h"""

STORED_ONCE = """SELECT event_id, session_id, client_id, content_id, ts, video_start_time_ms, playback_failed,
  rebuffer_duration_ms, playback_duration_ms, coalesce(player_version, '') AS player_version, os, cdn,
  CASE {cases} ELSE 'live' END AS source_id FROM h"""

ORACLE["replay_then_live"] = f"WITH {H} " + STORED_ONCE.format(
    cases=f"WHEN {within(OUTAGE)} THEN 'replay-outage'")

ORACLE["replay_two_backlogs"] = f"WITH {H} " + STORED_ONCE.format(
    cases=f"WHEN {within(OUTAGE)} THEN 'replay-first' "
          f"WHEN {within(SECOND_OUTAGE)} THEN 'replay-second'")

ORACLE["publish_topic"] = f"""WITH {H}, {_murmur_ctes('h')},
  acc AS (SELECT * FROM h WHERE fault_key NOT IN {REJECT_KEYS})
SELECT acc.session_id AS key, CAST(abs(CAST(hs.murmur2_hash AS BIGINT)) % 24 AS INTEGER) AS partition,
  arrival_seq AS "offset", timestamp_ms, event_id, acc.session_id, client_id, content_id, ts,
  video_start_time_ms, playback_failed, rebuffer_duration_ms, playback_duration_ms,
  CASE WHEN fault_key = 10 THEN '' ELSE coalesce(player_version, '') END AS player_version, os, cdn
FROM acc JOIN hs USING (session_id)"""

ORACLE["session_kpis_accepted"] = f"WITH {H}, {T}, {TD}, {TDF} {_kpi_select('session_id')} FROM tdf GROUP BY session_id"

ORACLE["stream_dedup_events"] = ORACLE["stream_ingest_events"]

ORACLE["json_files"] = ORACLE["validate_accept"].replace("SELECT arrival_seq AS request_id, timestamp_ms", "SELECT timestamp_ms")

ORACLE["session_order"] = f"""WITH {H}, {_murmur_ctes('h')}
SELECT CAST(abs(CAST(hs.murmur2_hash AS BIGINT)) % 24 AS INTEGER) AS partition_id,
  h.session_id, event_id, ts, arrival_seq FROM h JOIN hs USING (session_id)"""

ORACLE["stream_late_windows"] = ORACLE["stream_window_kpis"]

ORACLE["bounded_ingest"] = f"""WITH {H}, {_murmur_ctes('h')}
SELECT h.session_id AS key, CAST(abs(CAST(hs.murmur2_hash AS BIGINT)) % 24 AS INTEGER) AS partition,
  arrival_seq AS "offset", true AS within_bound FROM h JOIN hs USING (session_id)"""

ORACLE["indexed_lookup"] = ORACLE["exists_by_event_id"]

ORACLE["empty_batches"] = f"""WITH {H}
SELECT 'events' AS written, CAST(1 AS BIGINT) AS batch_id, count(*) AS rows FROM h
UNION ALL SELECT 'session_metrics', 1, count(DISTINCT session_id) FROM h"""

_NEWER = ", ".join(f"CASE WHEN ts >= {moment(STORED_BEFORE)} THEN {c} END AS {c}" for c in ("player_version", "os", "cdn"))

ORACLE["widened_events"] = f"""WITH {H}
SELECT event_id, session_id, client_id, content_id, ts, video_start_time_ms, playback_failed,
  rebuffer_duration_ms, playback_duration_ms, {_NEWER} FROM h"""

ORACLE["save_one_event"] = f"""WITH {H}
SELECT {HB_COLS} FROM h WHERE ts < {moment(STORED_BEFORE)}
UNION SELECT {HB_COLS} FROM h WHERE arrival_seq = (SELECT max(event_id) FROM events)"""

ORACLE["stream_latency_quantiles"] = f"""WITH {H},
  l AS (SELECT date_trunc('day', ts) AS period_start, CAST(round(video_start_time_ms * 1000000) AS BIGINT) AS v FROM h),
  b AS (SELECT period_start, (v >> greatest(length(bin(v)) - 8, 0)) << greatest(length(bin(v)) - 8, 0) AS low FROM l),
  r AS (SELECT *, row_number() OVER (PARTITION BY period_start ORDER BY low) AS rn,
    count(*) OVER (PARTITION BY period_start) AS requests FROM b)
SELECT period_start, requests, min(low) FILTER (WHERE rn * 100 >= requests * 50) AS p50_ns,
  min(low) FILTER (WHERE rn * 100 >= requests * 95) AS p95_ns, min(low) FILTER (WHERE rn * 100 >= requests * 99) AS p99_ns
FROM r GROUP BY 1, 2"""

ORACLE["batch_ledger"] = f"""WITH {H}, {T}
SELECT count(*) AS consumed, count(*) FILTER (WHERE fault_key NOT IN (4, 11)) AS ok,
  count(*) FILTER (WHERE fault_key IN (4, 11)) AS dead_lettered FROM t"""

ORACLE["throughput_series"] = f"""WITH {H},
  u AS (SELECT ts, true AS ing FROM h WHERE fault_key NOT IN {REJECT_KEYS}
        UNION ALL SELECT ts, false FROM h
        UNION ALL SELECT ts, false FROM h),
  w AS (SELECT {_floor15()} - to_seconds(unnest([0, 15, 30, 45])) AS ws, ing FROM u),
  g AS (SELECT unnest(generate_series((SELECT min(ws) FROM w), (SELECT max(ws) FROM w), INTERVAL 15 SECOND)) AS ws),
  a AS (SELECT ws, count(*) FILTER (WHERE ing) AS i, count(*) FILTER (WHERE NOT ing) AS c FROM w GROUP BY ws)
SELECT g.ws AS window_start, g.ws + INTERVAL 1 MINUTE AS window_end,
  coalesce(i, 0) AS ingested, coalesce(c, 0) AS consumed,
  round(CAST(coalesce(i, 0) AS DOUBLE) / 60.0, {RATE}) AS ingested_per_s,
  round(CAST(coalesce(c, 0) AS DOUBLE) / 60.0, {RATE}) AS consumed_per_s
FROM g LEFT JOIN a USING (ws)"""

ORACLE["kpi_series"] = f"""WITH {H},
  k AS (SELECT date_trunc('minute', ts) AS m, avg(video_start_time_ms) AS vst,
          CAST(count(*) FILTER (WHERE playback_failed) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS pfr,
          CASE WHEN sum(playback_duration_ms) > 0 THEN sum(rebuffer_duration_ms) / sum(playback_duration_ms)
               ELSE CAST(0 AS DOUBLE) END + {TIE_SHIFT!r} AS rr
        FROM h GROUP BY 1),
  g AS (SELECT unnest(generate_series((SELECT min(m) FROM k), (SELECT max(m) FROM k), INTERVAL 1 MINUTE)) AS m)
SELECT m AS step_start,
  round(last_value(vst IGNORE NULLS) OVER upto, {MS}) AS avg_vst_ms,
  round(last_value(k.pfr IGNORE NULLS) OVER upto, {RATE}) AS pfr,
  round(last_value(rr IGNORE NULLS) OVER upto, {RATIO}) AS rebuffering_ratio,
  vst IS NOT NULL AS fresh
FROM g LEFT JOIN k USING (m) WINDOW upto AS (ORDER BY m ROWS UNBOUNDED PRECEDING)"""

ORACLE["counter_increase"] = f"""WITH {H},
  s AS (SELECT cdn, ts, max(((timestamp_ms // 1000 + CAST(substr(cdn, 5) AS BIGINT) * 18000) % 86400) // {COUNTER_TICK}) AS v
        FROM h GROUP BY cdn, ts),
  d AS (SELECT *, lag(v) OVER (PARTITION BY cdn ORDER BY ts) AS p FROM s)
SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
  CAST(sum(CASE WHEN p IS NULL THEN 0 WHEN v < p THEN v ELSE v - p END) AS BIGINT) AS increase,
  count(*) FILTER (WHERE v < p) AS resets, count(*) AS samples
FROM d GROUP BY 1, 2"""

ORACLE["compacted_events"] = ORACLE["stream_ingest_events"]

ORACLE["compacted_kpis"] = ORACLE["stream_ingest_kpis"]

ORACLE["expired_letters"] = f"""WITH {H}, {T}, d AS (SELECT * FROM t WHERE fault_key IN (4, 11))
SELECT 'deserialization-failure' AS reason, ts AS ingest_ts, fault_key = 11 AS without_payload
FROM d WHERE ts >= (SELECT max(ts) FROM d) - INTERVAL 7 DAY"""
