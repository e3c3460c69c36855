"""The same results as plain SQL over the same tables, for the comparison run."""

# An event as the message reader sees it: times cut to milliseconds.
EVENTS = """
e AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS device_id, CAST(user_id % 7 AS INTEGER) AS device_type_id,
         ts, date_trunc('millisecond', ts) AS ms, value AS temperature,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS humidity
  FROM events),
x AS (
  SELECT e.*, coalesce(r_name, 'unknown_device_type') AS device_type
  FROM e LEFT JOIN region ON device_type_id = r_regionkey)"""

MESSAGE = """concat('{"device_id":"', device_id, '","device_type_id":', device_type_id, ',"event_time":"',
  strftime(ts, '%Y-%m-%dT%H:%M:%S'), CASE WHEN microsecond(ts) % 1000000 = 0 THEN '' ELSE strftime(ts, '.%f') END,
  '+00:00","temperature":', CAST(temperature AS VARCHAR), ',"humidity":', CAST(humidity AS VARCHAR), '}')"""

# The readings added up as integer counts of 2^-60, so the sum is rounded once, not at each addition.
MEAN = """(CAST(CAST(sum(CAST(temperature * 1152921504606846976.0 AS HUGEINT)) AS VARCHAR) AS DOUBLE)
  / 1152921504606846976.0 / count(*))"""

# A compensated sum in floating point: of the few readings of a minute it is the exact one, rounded.
COMPENSATED_MEAN = "(fsum(temperature) / count(*))"

DAMAGED = f"""
m AS (SELECT event_id, {MESSAGE} AS value FROM e),
d AS (
  SELECT event_id, CASE event_id % 16
    WHEN 1 THEN left(value, length(value) - 1)
    WHEN 2 THEN regexp_replace(value, '"temperature":[^,]*,', '')
    WHEN 3 THEN regexp_replace(value, '"event_time":"[^"]*"', '"event_time":1704067200')
    WHEN 4 THEN regexp_replace(value, '"device_type_id":([0-9]+)', '"device_type_id":"\\1.0"')
    WHEN 5 THEN regexp_replace(value, '"humidity":[^}}]*', '"humidity":null')
    WHEN 6 THEN value || ' x'
    WHEN 7 THEN '[' || value || ']'
    WHEN 8 THEN regexp_replace(value, '"temperature":([^,]*)', '"temperature":"\\1d"')
    WHEN 9 THEN regexp_replace(value, '"device_id":"[^"]*",', '')
    WHEN 10 THEN regexp_replace(value, '"device_type_id":[0-9]+', '"device_type_id":3000000000')
    WHEN 11 THEN regexp_replace(value, '"event_time":"[^"]*"', '"event_time":"yesterday"')
    ELSE value END AS value,
  CASE event_id % 16
    WHEN 1 THEN 'malformed_json'
    WHEN 2 THEN 'missing_temperature'
    WHEN 3 THEN 'bad_event_time'
    WHEN 4 THEN 'bad_device_type_id'
    WHEN 5 THEN 'bad_humidity'
    WHEN 6 THEN 'malformed_json'
    WHEN 7 THEN 'not_an_object'
    WHEN 8 THEN 'bad_temperature'
    WHEN 9 THEN 'missing_device_id'
    WHEN 10 THEN 'bad_device_type_id'
    WHEN 11 THEN 'bad_event_time' END AS reason
  FROM m)"""

QUARANTINE = f"WITH {EVENTS}, {DAMAGED} SELECT value, reason FROM d WHERE reason IS NOT NULL"


def _stats(unit: str, device_type: str = "device_type", rows: str = "x", having: str = "") -> str:
    start = f"date_trunc('{unit}', ms)"
    return f"""
SELECT strftime({start}, '%H:%M') AS window_start,
       strftime({start} + INTERVAL 1 {unit}, '%H:%M') AS window_end,
       {device_type} AS device_type,
       CAST(format('{{:.2f}}', {MEAN}) AS DOUBLE) AS avg_temperature,
       CAST(format('{{:.2f}}', median(humidity)) AS DOUBLE) AS median_humidity
FROM {rows} GROUP BY {start}, {device_type} {having}"""


def _closed_by(newest: str) -> str:
    return f"date_trunc('minute', ms) + INTERVAL 1 minute + INTERVAL 5 second <= ({newest})"


_STREAMED = f"WITH {EVENTS} " + _stats("minute", having="HAVING " + _closed_by("SELECT max(ms) FROM e"))

_LATE = (
    f"WITH {EVENTS}, arrived AS (SELECT * FROM x WHERE event_id % 5 <> 0 OR NOT ("
    + _closed_by("SELECT max(ms) FROM e WHERE event_id % 5 <> 0")
    + ")) "
    + _stats("minute", rows="arrived", having="HAVING " + _closed_by("SELECT max(ms) FROM e"))
)


# The second arrival finds the watermark that the first has left. A time that could be read is kept of a rejected message too.
_ARRIVED = """passed AS (
  SELECT max(ms) - INTERVAL 5 second AS mark FROM e JOIN d USING (event_id) WHERE reason IS NULL AND event_id % 5 <> 0),
arrived AS (
  SELECT e.*, CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END AS batch,
         CASE WHEN reason IN ('malformed_json', 'not_an_object', 'bad_event_time') THEN NULL ELSE ms END AS seen,
         reason IS NULL AND event_id % 5 = 0 AND date_trunc('minute', ms) + INTERVAL 1 minute <= mark AS closed,
         CASE WHEN reason IS NOT NULL THEN 'rejected' WHEN closed THEN 'late' ELSE 'accepted' END AS outcome,
         CASE WHEN closed THEN epoch_ms(mark) - epoch_ms(ms) END AS late_by_ms
  FROM e JOIN d USING (event_id), passed)"""


def _millis(start: str, unit: str) -> str:
    return f"epoch_ms({start}) AS window_start, epoch_ms({start} + INTERVAL 1 {unit}) AS window_end"


_LOOKUP = f"WITH {EVENTS} SELECT device_type, epoch_ms(ms) AS event_time_ms, temperature, humidity FROM x"
_PER_TYPE = f"WITH {EVENTS} SELECT device_type, count(*) AS events FROM x GROUP BY device_type"
_MINUTES = f"WITH {EVENTS} " + _stats("minute")
_HOURS = f"WITH {EVENTS} " + _stats("hour")

ORACLES: dict[str, str] = {
    "publish_events": f"WITH {EVENTS} SELECT device_id AS key, {MESSAGE} AS value FROM e",
    "decode_values": f"WITH {EVENTS} SELECT {MESSAGE} AS value FROM e",
    "parse_events": f"""WITH {EVENTS}
SELECT device_id, device_type_id, epoch_ms(ms) AS event_time_ms, temperature, humidity FROM e""",
    "drop_malformed": f"""WITH {EVENTS}, {DAMAGED}
SELECT coalesce(reason, 'accepted') AS outcome, count(*) AS messages FROM d GROUP BY 1""",
    "quarantine_messages": QUARANTINE,
    "quarantine_stream": QUARANTINE,
    "coerced_fields": f"""WITH {EVENTS}
SELECT event_id, device_id,
       CAST(CASE event_id % 5 WHEN 2 THEN 1 WHEN 4 THEN 10 + device_type_id ELSE device_type_id END AS INTEGER)
         AS device_type_id,
       CASE event_id % 5 WHEN 1 THEN 1.0
         WHEN 2 THEN CAST(CAST(temperature AS VARCHAR) || 'e1' AS DOUBLE)
         WHEN 3 THEN CAST(CAST(temperature AS VARCHAR) || 'e2' AS DOUBLE)
         ELSE temperature END AS temperature,
       CAST(NULL AS VARCHAR) AS reject_reason
FROM e""",
    "event_time_formats": f"""WITH {EVENTS}
SELECT event_id,
  CASE event_id % 6
    WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')
    WHEN 1 THEN strftime(ts + INTERVAL 1230 minute, '%Y-%m-%d %H:%M:%S.%g+20:30')
    WHEN 2 THEN strftime(ts, '%Y-%m-%d_%H:%M:%S')
    WHEN 3 THEN strftime(ts, '%Y-%m-%dT%H:%M+00:00')
    WHEN 4 THEN strftime(ts, '%Y-%m-%dT%H')
    ELSE strftime(ts, '%Y-%m-%d') END AS text,
  epoch_ms(CASE event_id % 6
    WHEN 0 THEN ms
    WHEN 1 THEN ms
    WHEN 2 THEN date_trunc('second', ts)
    WHEN 3 THEN date_trunc('minute', ts)
    WHEN 4 THEN date_trunc('hour', ts)
    ELSE CAST(date_trunc('day', ts) AS TIMESTAMP) END) AS event_time_ms
FROM e""",
    "lookup_join": _LOOKUP,
    "lookup_join_shuffled": _LOOKUP,
    "unknown_bucket": _PER_TYPE,
    "dictionary_roundtrip": "SELECT CAST(r_regionkey AS INTEGER) AS id, r_name AS type_name FROM region",
    "dictionary_snapshot": _PER_TYPE,
    "shared_type_name": f"WITH {EVENTS} "
    + _stats("hour", device_type="(CASE WHEN device_type_id <= 1 THEN 'SHARED' ELSE device_type END)"),
    "tumbling_avg": f"""WITH {EVENTS}
SELECT {_millis("date_trunc('minute', ts)", "minute")}, device_type, count(*) AS events,
       {COMPENSATED_MEAN} AS avg_temperature
FROM x GROUP BY date_trunc('minute', ts), device_type""",
    # The largest magnitude of a group decides, as an integer; the next one only whether a half is rounded up or down.
    "mean_of_all_magnitudes": f"""WITH {EVENTS},
c AS (
  SELECT date_trunc('day', ts) AS d, device_type, event_id % 9 AS m, count(*) AS n,
         sum(CAST(temperature * 1152921504606846976.0 * CASE WHEN event_id % 2 = 0 THEN 1 ELSE -1 END AS HUGEINT)) AS s
  FROM x GROUP BY ALL),
t AS (SELECT *, sum(n) OVER (PARTITION BY d, device_type) AS events FROM c),
o AS (SELECT *, row_number() OVER (PARTITION BY d, device_type ORDER BY s = 0, m DESC) AS place FROM t),
p AS (
  SELECT d, device_type, max(events) AS events, max(s) FILTER (place = 1) AS top, max(m) FILTER (place = 1) AS m,
         coalesce(max(sign(s)) FILTER (place = 2), 0) AS below
  FROM o GROUP BY d, device_type)
SELECT epoch_ms(CAST(d AS TIMESTAMP)) AS window_start, device_type, CAST(events AS BIGINT) AS events,
       CAST(CAST(4 * top + CAST(below AS HUGEINT) AS VARCHAR) AS DOUBLE) / 4 / 1152921504606846976.0
         * pow(2, 100 * m - 400) / events AS avg_temperature
FROM p""",
    "tumbling_median": f"""WITH {EVENTS}
SELECT {_millis("date_trunc('hour', ts)", "hour")}, device_type, count(*) AS events,
       median(humidity) AS median_humidity
FROM x GROUP BY date_trunc('hour', ts), device_type""",
    "median_large_groups": f"""WITH {EVENTS},
w AS (SELECT *, epoch_ms(ms) // 2592000000 * 2592000000 AS window_start FROM x)
SELECT window_start, window_start + 2592000000 AS window_end, device_type, count(*) AS events,
       median(temperature) AS median_humidity
FROM w GROUP BY window_start, device_type""",
    "window_labels": f"""WITH {EVENTS}
SELECT epoch_ms(date_trunc('minute', ts)) AS window_start_ms,
       strftime(date_trunc('minute', ts), '%H:%M') AS window_start,
       strftime(date_trunc('minute', ts) + INTERVAL 1 minute, '%H:%M') AS window_end,
       count(*) AS events
FROM e GROUP BY date_trunc('minute', ts)""",
    "round2_values": "SELECT event_id, CAST(format('{:.2f}', value / 8) AS DOUBLE) AS rounded FROM events",
    "window_stats_minute": _MINUTES,
    "window_stats_hour": _HOURS,
    "sql_projection": _HOURS,
    "read_aggregates": _MINUTES,
    "round_robin_partitions": "SELECT CAST(4 AS BIGINT) AS partitions, count(*) AS messages, true AS even FROM events",
    "window_stats_stream": _STREAMED,
    "late_rows_dropped": _LATE,
    "restart_no_duplicates": _STREAMED,
    "stream_delivery_report": f"""WITH {EVENTS}, {DAMAGED},
good AS (SELECT x.* FROM x JOIN d USING (event_id) WHERE reason IS NULL),
closed AS ({_stats("minute", rows="good", having="HAVING " + _closed_by("SELECT max(ms) FROM good"))})
SELECT CAST(count(*) AS BIGINT) AS input_rows, count(reason) AS rejected,
       CAST(0 AS BIGINT) AS late_groups_dropped, (SELECT count(*) FROM closed) AS rows_written FROM d""",
    "window_logic_stream": _STREAMED,
    "windows_left_open": f"""WITH {EVENTS},
passed AS (SELECT epoch_ms(max(ms)) - 259200000 AS mark FROM e),
w AS (SELECT *, epoch_ms(date_trunc('hour', ts)) AS window_start FROM x)
SELECT window_start, window_start + 3600000 AS window_end, device_type, count(*) AS events,
       count(DISTINCT humidity) AS state_rows, max(mark) - window_start AS age_ms,
       window_start + 3600000 - max(mark) AS waits_ms
FROM w, passed WHERE window_start + 3600000 > mark GROUP BY window_start, device_type""",
    "late_events": f"""WITH {EVENTS}, {DAMAGED}, {_ARRIVED}
SELECT device_id, epoch_ms(ms) AS event_time_ms, temperature, batch, late_by_ms FROM arrived WHERE outcome = 'late'""",
    "batch_receipts": f"""WITH {EVENTS}, {DAMAGED}, {_ARRIVED}
SELECT batch, outcome, count(*) AS rows, count(*) AS readable,
       epoch_ms(min(seen)) AS oldest_ms, epoch_ms(max(seen)) AS newest_ms
FROM arrived GROUP BY batch, outcome""",
    "dictionary_refresh": f"""WITH {EVENTS}
SELECT CAST(event_id % 2 AS INTEGER) AS batch, event_id % 2 + 1 AS version,
       CASE WHEN event_id % 2 = 1 THEN lower(device_type) ELSE device_type END AS device_type, count(*) AS events
FROM x GROUP BY ALL""",
    "dictionary_problems": """WITH d AS (
  SELECT CAST(CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 7 = 0 THEN event_id - 1 ELSE event_id END AS INTEGER) AS id,
         CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 17 = 0 THEN repeat('n', 101) ELSE repeat('n', 100) END AS type_name
  FROM events)
SELECT id, 'null id' AS problem, count(*) AS rows FROM d WHERE id IS NULL GROUP BY id HAVING count(*) > 0
UNION ALL SELECT id, 'repeated id', count(*) FROM d WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1
UNION ALL SELECT id, 'null name', count(*) FROM d WHERE type_name IS NULL GROUP BY id
UNION ALL SELECT id, 'name over 100 characters', count(*) FROM d WHERE length(type_name) > 100 GROUP BY id""",
    "archived_ranges": f"""WITH {EVENTS},
m AS (SELECT event_id % 4 AS p, event_id // 4 AS o, strlen({MESSAGE}) AS size, max(event_id) OVER () AS last FROM e),
s AS (SELECT *, CASE WHEN p = 2 OR o < last // (8 + 4 * p) THEN 'before' ELSE 'after' END AS side FROM m)
SELECT side, CAST(p AS INTEGER) AS partition, count(*) AS messages, min(o) AS first_offset, max(o) AS last_offset,
       CAST(sum(size) AS BIGINT) AS value_bytes
FROM s GROUP BY side, p""",
}
