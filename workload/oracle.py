"""The expected result of every query, in SQL over the same tables.

The fields of a message come straight from the source columns; no SQL here
parses a line.
"""

from __future__ import annotations

from workload import shapes

# The reasons that the rendered lines can have.
REASONS = {
    1: "'<' expected at start of message",
    2: "priority cannot be empty",
    3: "can't decode priority",
    4: "priority not terminated",
    7: "cannot process log without date",
    8: "cannot decode timestamp",
    9: "hostname not found",
    10: "process name not found",
    11: "pid not found",
    12: "can't decode pid",
    13: "msgid not found",
    14: "close ] not found",
    15: "tag not followed by seperation marker",
    16: "out of column range",
}

PARTS = """
parts AS (
  SELECT *, (event_id * 7) % 192 AS pri, concat('host', user_id) AS host,
    (event_id // 6) % 6 AS k,
    strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso,
    strftime(ts - INTERVAL 7 HOURS, '%Y-%m-%dT%H:%M:%S') AS iso7,
    strftime(ts, '%f') AS us,
    concat(strftime(ts, '%b'), ' ', lpad(CAST(day(ts) AS VARCHAR), 2, ' ')) AS mon,
    strftime(ts, '%H:%M:%S') AS hms,
    CAST((event_id * 7) % 192 // 8 AS INTEGER) AS fac,
    CAST((event_id * 7) % 192 % 8 AS INTEGER) AS sev,
    CAST(event_id AS INTEGER) AS eid,
    date_trunc('millisecond', ts) AS ts_ms,
    date_trunc('second', ts) AS ts_s
  FROM events)
"""

MIXED = """
CASE event_id % 6
 WHEN 0 THEN concat('<',pri,'>1 ',iso,'.',us,'Z ',host,' ',event_type,' ',event_id,' ID',event_id%50,' - ',props)
 WHEN 1 THEN concat('<',pri,'>1 ',iso7,'.',us,'-07:00 ',host,' ',event_type,' - - [meta@32473 id="',event_id,'"] ',props)
 WHEN 2 THEN concat('<',pri,'>',iso,'.',substr(us,1,3),'Z ',host,' ',event_type,'[',event_id,']: ',props)
 WHEN 3 THEN concat('<',pri,'>',mon,' ',hms,' UTC 2024 ',host,' ',event_type,': ',props)
 WHEN 4 THEN concat('<',pri,'>',mon,' ',hms,' ',host,' ',event_type,' ',props)
 ELSE CASE k WHEN 0 THEN concat('no priority ',props) WHEN 1 THEN concat('<>',props) WHEN 2 THEN concat('<x>',props)
  WHEN 3 THEN concat('<13>1 - ',host,' app 1 - - ',props) WHEN 4 THEN concat('<13>not-a-date ',host,' app: ',props)
  ELSE concat('<13>',iso,'Z ',host,' app[x]: ',props) END END
"""

MIXED_CODE = """
CASE WHEN event_id % 6 = 5 THEN CASE k WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3
  WHEN 3 THEN 7 WHEN 4 THEN 8 ELSE 12 END END
"""

MIXED_MESSAGE = """
  CASE event_id % 6 WHEN 0 THEN ts WHEN 1 THEN ts WHEN 2 THEN ts_ms ELSE ts_s END AS date,
  fac AS facility, sev AS severity, host AS hostname, event_type AS process,
  CASE event_id % 6 WHEN 2 THEN eid ELSE 0 END AS pid,
  CASE event_id % 6 WHEN 1 THEN concat('[meta@32473 id="', event_id, '"] ', props) ELSE props END AS data
"""

# Messages of the mixed lines, with the key of their event.
MESSAGES = f"""
WITH {PARTS},
messages AS (SELECT event_id, {MIXED_MESSAGE} FROM parts WHERE event_id % 6 <> 5)
"""

COLUMNS = "date, facility, severity, hostname, process, pid, data"


def _reason(code: str) -> str:
    whens = " ".join(
        "WHEN {} THEN '{}'".format(n, text.replace("'", "''")) for n, text in REASONS.items()
    )
    return f"CASE {code} {whens} END"


def _expected(rows: dict[str, str]) -> str:
    """One SELECT per shape: 'date; host; process; pid; data' in SQL."""
    selects = []
    for name, fields in rows.items():
        date, host, process, pid, data = fields.split(";")
        selects.append(
            f"SELECT event_id, '{name}' AS shape, {date} AS date, fac AS facility, "
            f"sev AS severity, {host} AS hostname, {process} AS process, "
            f"CAST({pid} AS INTEGER) AS pid, {data} AS data, "
            "CAST(NULL AS INTEGER) AS error_code FROM parts"
        )
    return f"WITH {PARTS} " + " UNION ALL ".join(selects)


NEW_FAMILY = _expected(
    {
        "utc": "ts;host;event_type;0;props",
        "offset": "ts;host;event_type;0;concat('[meta@32473 id=\"', event_id, '\"] ', props)",
        "compact": "ts;host;event_type;0;props",
        "bare": "ts_s;host;event_type;0;'-'",
        "empty_words": "ts_ms;'';'';0;props",
    }
)

OLD_FAMILY = _expected(
    {
        "iso": "ts_ms;host;event_type;eid;props",
        "zone_year": "ts_s;host;event_type;0;props",
        "short": "ts_s;host;event_type;0;props",
        "weekday": "ts_s;host;event_type;eid;props",
        "no_host": "ts_s;concat(event_type, ':');split_part(props, ':', 1);0;"
        "substr(props, strpos(props, ':') + 2)",
    }
)

_PRECISION = {"iso_9": "ts", "iso_6": "ts", "iso_3": "ts_ms"}

STAMPS = f"WITH {PARTS} " + " UNION ALL ".join(
    f"SELECT event_id, '{name}' AS shape, {_PRECISION.get(name[:5], 'ts_s')} AS date, "
    "CAST(NULL AS INTEGER) AS error_code FROM parts"
    for name in shapes.STAMPS
)

ZONES = f"WITH {PARTS} " + " UNION ALL ".join(
    f"SELECT event_id, '{zone}' AS shape, ts_s + INTERVAL '{minutes}' MINUTE AS date, "
    "CAST(NULL AS INTEGER) AS error_code FROM parts"
    for zone, minutes in (("UTC", 0), ("CST", 360), ("EET", -120))
)

YEARS = " UNION ALL ".join(
    f"""
    SELECT o_orderkey, {year} AS ref_year, '{shape}' AS shape,
      CAST(make_date({year}, month(o_orderdate), 1) AS TIMESTAMP)
        + to_days(CAST(day(o_orderdate) - 1 AS INTEGER)) + INTERVAL '01:02:03' HOUR TO SECOND AS date,
      CAST(NULL AS INTEGER) AS error_code
    FROM orders"""
    for year in (2023, 2028) for shape in ("short", "zero")
).replace("INTERVAL '01:02:03' HOUR TO SECOND", "INTERVAL 3723 SECOND")

BROKEN = f"WITH {PARTS} " + " UNION ALL ".join(
    f"SELECT event_id, '{name}' AS shape, {code} AS error_code, {_reason(str(code))} AS error_reason, "
    f"{sql} AS raw FROM parts"
    for name, (code, sql) in shapes.BROKEN.items()
)

MIXED_LINES = f"WITH {PARTS}, lines AS (SELECT event_id, {MIXED_CODE} AS code, {MIXED} AS line FROM parts)"

# The chain of the routing queries.
ROUTED = f"""{MESSAGES},
renamed AS (
  SELECT *, CASE WHEN process = 'error' THEN hostname
                 ELSE replace(hostname, 'host', 'node') END AS shown,
    CASE WHEN process = 'error' THEN 'audit'
         WHEN severity <= 1 AND process = 'click' THEN 'urgent'
         WHEN facility = 0 THEN 'kernel' ELSE 'syslog' END AS route
  FROM messages)
"""

AUDIT = """
  SELECT date, shown AS hostname, upper(data) AS data FROM renamed WHERE route = 'audit'
  UNION ALL
  SELECT date, shown, data FROM renamed WHERE route = 'kernel'
"""

SENDERS = """
WITH senders AS (
  SELECT event_id, user_id, event_type,
    CASE WHEN event_type = 'error' THEN concat('other-', user_id)
         ELSE concat('log-zone-', user_id) END AS cn
  FROM events)
"""


def _spelled(bytes_: str) -> str:
    """Escaped form of a blob, one byte after the other."""
    named = {"07": "a", "08": "b", "09": "t", "0A": "n", "0B": "v", "0C": "f", "0D": "r"}
    whens = " ".join(f"WHEN h = '{h}' THEN '\\{c}'" for h, c in named.items())
    return f"""array_to_string(list_transform(regexp_extract_all(hex({bytes_}), '..'),
      lambda h: CASE {whens} WHEN h = '5C' THEN '\\\\'
        WHEN h BETWEEN '20' AND '7E' THEN chr(CAST(concat('0x', h) AS INTEGER))
        ELSE concat('\\x', h) END), '')"""


FILES = """
hours AS (
  SELECT date_trunc('hour', ts) AS hour, min(ts) AS start_ts, count(*) AS logs
  FROM events GROUP BY 1),
files AS (
  SELECT concat(lower(lpad(to_hex(epoch_us(start_ts)), 16, '0')), '.',
                lower(lpad(to_hex(logs), 8, '0')), '.log') AS file_name, start_ts, logs
  FROM hours)
"""

BATCH = f"""WITH {FILES},
summed AS (SELECT file_name, logs, CAST(sum(logs) OVER (ORDER BY file_name) AS BIGINT) AS logs_upto FROM files)
SELECT file_name, logs, logs_upto FROM summed WHERE logs_upto - logs < 750
"""


def _chunks(arrivals: str, idle: str, cap: int) -> str:
    return f"""WITH arrivals AS ({arrivals}),
gaps AS (
  SELECT *, coalesce(ts - lag(ts) OVER w > INTERVAL '{idle}', true) AS opens
  FROM arrivals WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
sessions AS (
  SELECT *, sum(CASE WHEN opens THEN 1 ELSE 0 END) OVER
    (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session FROM gaps),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, session ORDER BY ts, event_id) - 1 AS pos,
    min(ts) OVER (PARTITION BY user_id, session) AS session_start FROM sessions),
chunks AS (
  SELECT event_id, ts, user_id, session_start, pos // {cap} AS part, pos % {cap} AS line_no
  FROM numbered)
"""


ARRIVALS = "SELECT event_id, ts, user_id FROM events"
HOT_ARRIVALS = """SELECT event_id, ts,
  CAST(CASE WHEN event_id % 3 = 0 THEN 7 ELSE user_id END AS BIGINT) AS user_id FROM events"""
CHUNKS = _chunks(ARRIVALS, "6 hours", 3)

# Stamps one after the other: recursion over the rows of a key.
def _stamps(partition: str) -> str:
    key = "user_id" if partition else "0"
    return f"""WITH RECURSIVE arrivals AS ({HOT_ARRIVALS}),
numbered AS (
  SELECT event_id, {key} AS key, epoch_us(date_trunc('hour', ts)) AS now,
    row_number() OVER ({partition} ORDER BY date_trunc('hour', ts), event_id) AS n
  FROM arrivals),
stamps AS (
  SELECT event_id, key, n, now AS unique_us FROM numbered WHERE n = 1
  UNION ALL
  SELECT r.event_id, r.key, r.n, greatest(r.now, s.unique_us + 1)
  FROM stamps s JOIN numbered r ON r.key = s.key AND r.n = s.n + 1)
SELECT event_id, unique_us FROM stamps
"""


def _batch_stamps() -> str:
    """One pass over all events: by third of the time, then hour, then number."""
    return f"""WITH RECURSIVE arrivals AS ({HOT_ARRIVALS}),
span AS (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi FROM arrivals),
numbered AS (
  SELECT event_id, epoch_us(date_trunc('hour', ts)) AS now,
    row_number() OVER (ORDER BY CASE WHEN epoch_us(ts) < lo + (hi - lo + 3) // 3 THEN 0
      WHEN epoch_us(ts) < lo + (hi - lo + 3) * 2 // 3 THEN 1 ELSE 2 END,
      date_trunc('hour', ts), event_id) AS n
  FROM arrivals, span),
stamps AS (
  SELECT event_id, n, now AS unique_us FROM numbered WHERE n = 1
  UNION ALL
  SELECT r.event_id, r.n, greatest(r.now, s.unique_us + 1)
  FROM stamps s JOIN numbered r ON r.n = s.n + 1)
SELECT event_id, unique_us FROM stamps
"""


# Files of the spool: chunks of an event type, six hours of silence, 500 lines.
SPOOL = """
typed AS (SELECT event_id, ts, event_type FROM events),
opened AS (
  SELECT *, coalesce(ts - lag(ts) OVER (PARTITION BY event_type ORDER BY ts, event_id)
    > INTERVAL '6 hours', true) AS opens FROM typed),
in_session AS (
  SELECT *, sum(CASE WHEN opens THEN 1 ELSE 0 END) OVER
    (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session FROM opened),
placed AS (
  SELECT *, (row_number() OVER (PARTITION BY event_type, session ORDER BY ts, event_id) - 1) // 500
    AS part FROM in_session),
spooled AS (
  SELECT event_id, concat(
      lower(lpad(to_hex(epoch_us(min(ts) OVER c)), 16, '0')), '.',
      lower(lpad(to_hex(count(*) OVER c), 8, '0')), '.log') AS file_name
  FROM placed WINDOW c AS (PARTITION BY event_type, session, part))
"""

ERROR_ROWS = f"""{MIXED_LINES}
SELECT TIMESTAMP '2024-06-01 12:00:00' AS date, line AS data FROM lines WHERE code IS NOT NULL"""

MESSAGE_ROWS = f"{MESSAGES} SELECT {COLUMNS} FROM messages"

ORACLE = {
    "parse_syslog": f"""WITH {PARTS}
SELECT event_id, CASE WHEN event_id % 6 <> 5 THEN m.date END AS date,
  CASE WHEN event_id % 6 <> 5 THEN facility END AS facility,
  CASE WHEN event_id % 6 <> 5 THEN severity END AS severity,
  CASE WHEN event_id % 6 <> 5 THEN hostname END AS hostname,
  CASE WHEN event_id % 6 <> 5 THEN process END AS process,
  CASE WHEN event_id % 6 <> 5 THEN pid END AS pid,
  CASE WHEN event_id % 6 <> 5 THEN data END AS data,
  error_code
FROM (SELECT event_id, {MIXED_MESSAGE}, {MIXED_CODE} AS error_code FROM parts) m""",
    "parse_rfc5424": NEW_FAMILY,
    "parse_rfc5424_procid": f"""WITH {PARTS}
SELECT event_id, eid AS pid, CAST(NULL AS INTEGER) AS error_code FROM parts""",
    "parse_rfc3164": OLD_FAMILY,
    "parse_timestamps": STAMPS,
    "zone_offsets": ZONES,
    "complete_year": YEARS,
    "parse_errors": BROKEN,
    "error_report": f"""{MIXED_LINES}
SELECT code AS error_code, {_reason('code')} AS error_reason, count(*) AS lines
FROM lines WHERE code IS NOT NULL GROUP BY code""",
    "error_report_days": f"""{MIXED_LINES},
messages AS (SELECT event_id, {MIXED_MESSAGE} FROM parts WHERE event_id % 6 <> 5),
days AS (
  SELECT CAST(date AS DATE) AS day, count(*) AS lines, 0::BIGINT AS errors, count(DISTINCT hostname) AS senders
  FROM messages GROUP BY 1),
wrong AS (SELECT {_reason('code')} AS reason, count(*) AS n FROM lines WHERE code IS NOT NULL GROUP BY 1)
SELECT *, CAST(NULL AS VARCHAR) AS reason, CAST(NULL AS BIGINT) AS n FROM days
UNION ALL
SELECT DATE '2024-06-01', sum(n) OVER ()::BIGINT, sum(n) OVER ()::BIGINT, 0, reason, n FROM wrong""",
    "error_lines": f"""{MIXED_LINES}
SELECT code AS error_code, {_reason('code')} AS error_reason, line AS raw
FROM lines WHERE code IS NOT NULL""",
    "split_errors": ERROR_ROWS,
    "split_messages": MESSAGE_ROWS,
    "route_first_match": f"""{ROUTED}
SELECT event_id, shown AS hostname, route FROM renamed
UNION ALL SELECT event_id, CAST(NULL AS VARCHAR), 'errors' FROM parts WHERE event_id % 6 = 5""",
    "processor_audit": f"{ROUTED} {AUDIT}",
    "processor_urgent": f"""{ROUTED}
SELECT date, facility, shown AS hostname FROM renamed WHERE route = 'urgent'""",
    "processor_catch_all": f"""{ROUTED}
SELECT date, facility, severity, shown AS hostname, process, pid, data
FROM renamed WHERE route = 'syslog'""",
    "processor_tables": f"""{ROUTED}
SELECT CASE route WHEN 'kernel' THEN 'audit' ELSE route END AS "table", count(*) AS n,
  min(date) AS first, max(date) AS last FROM renamed GROUP BY 1""",
    "rule_filter": f"""{SENDERS}
SELECT event_id, cn FROM senders
WHERE event_type <> 'error' AND user_id <> 75 AND user_id NOT BETWEEN 10 AND 19""",
    "rule_action": f"""{SENDERS}
SELECT event_id, CASE WHEN event_type <> 'error' AND (user_id = 75 OR user_id BETWEEN 10 AND 19)
  THEN 'reject' ELSE 'accept' END AS action FROM senders""",
    "rule_table": f"""{SENDERS},
rules AS (
  SELECT p_partkey AS number, CASE WHEN p_size % 2 = 0 THEN 'accept' ELSE 'reject' END AS action,
    CASE p_partkey % 6 WHEN 0 THEN concat('log-zone-', zone) WHEN 1 THEN concat('log-zone-', zone, '_')
      WHEN 2 THEN concat('%-', zone) WHEN 3 THEN concat('other-', zone, '%')
      WHEN 4 THEN concat('_og-zone-', zone) ELSE concat('log-%', zone) END AS pattern
  FROM (SELECT *, p_partkey * 7 % 1201 AS zone FROM part)),
best AS (
  SELECT cn, arg_min(action, number) AS action
  FROM (SELECT DISTINCT cn FROM senders) JOIN rules ON cn LIKE pattern GROUP BY cn)
SELECT event_id, cn, coalesce(action, 'reject') AS action FROM senders LEFT JOIN best USING (cn)""",
    "escape_lines": f"SELECT doc_id, {_spelled('encode(text)')} AS line FROM documents",
    "escape_bytes": f"""SELECT page_id, concat('\\x88', {_spelled('encode(html)')}) AS line
FROM pages""",
    "escape_roundtrip": "SELECT doc_id, replace(text, ' ', '\\') AS text FROM documents",
    "unescape_bytes": "SELECT doc_id, concat('88', hex(encode(text))) AS bytes FROM documents",
    "unescape_invalid": " UNION ALL ".join(
        f"SELECT doc_id, '{name}' AS ending, concat({_spelled('encode(text)')}, '{tail}') AS line, false AS valid "
        "FROM documents"
        for name, tail in shapes.BAD_ESCAPES.items()
    ),
    "spool_manifest": f"WITH {FILES} SELECT file_name, start_ts, logs FROM files",
    "next_batch": BATCH,
    "next_batch_sliced": BATCH,
    "chunk_messages": f"{CHUNKS} SELECT * FROM chunks",
    "chunk_hot_sender": f"{_chunks(HOT_ARRIVALS, '30 minutes', 50)} SELECT * FROM chunks",
    "chunk_ties": f"""{_chunks(HOT_ARRIVALS.replace('event_id, ts,', "event_id, date_trunc('day', ts) AS ts,"), '6 hours', 50)}
SELECT user_id, CAST(session_start AS TIMESTAMP) AS session_start, part, count(*) AS n FROM chunks GROUP BY ALL""",
    "chunk_manifest": f"""{CHUNKS},
made AS (
  SELECT user_id, session_start, part, min(ts) AS start_ts, count(*) AS logs
  FROM chunks GROUP BY ALL)
SELECT *, epoch_us(start_ts) AS start_us, concat(
  lower(lpad(to_hex(epoch_us(start_ts)), 16, '0')), '.',
  lower(lpad(to_hex(logs), 8, '0')), '.log') AS file_name FROM made""",
    "unique_micros": _stamps("PARTITION BY user_id"),
    "unique_micros_global": _stamps(""),
    "unique_micros_batches": _batch_stamps(),
    "spool_roundtrip": f"""{MIXED_LINES}, {SPOOL}
SELECT file_name, line FROM lines JOIN spooled USING (event_id)""",
    "spool_documents": """SELECT CAST(doc_id AS INTEGER) AS pid, text AS data,
  CAST(NULL AS INTEGER) AS error_code FROM documents""",
    "spool_audit": f"""WITH {SPOOL}
SELECT concat(substr(file_name, 1, 17), lower(lpad(to_hex(declared), 8, '0')), '.log') AS file_name,
  declared, actual, actual - declared AS difference
FROM (SELECT file_name, count(*) AS actual, count(*) + [0, 1, -1][count(*) % 3 + 1] AS declared
  FROM spooled GROUP BY file_name)
UNION ALL SELECT '0000000000000001.00000003.log', 3, 0, -3""",
    "spool_audit_folders": f"""WITH {SPOOL}
SELECT file_name, count(*) AS declared, count(*) AS actual, 0::BIGINT AS difference FROM spooled GROUP BY file_name
UNION ALL SELECT '0000000000000001.00000003.log', 3, 0, -3""",
    "write_shared_errors": f"""{MIXED_LINES},
messages AS (SELECT event_id, {MIXED_MESSAGE} FROM parts WHERE event_id % 6 <> 5)
SELECT TIMESTAMP '2024-06-01 12:00:00' AS date, line AS data FROM lines WHERE code IS NOT NULL
UNION ALL SELECT date, data FROM messages WHERE process = 'error'""",
    "write_without_catch_all": f"""{MESSAGES}
SELECT 'errors' AS "table", count(*) AS n FROM events WHERE event_id % 6 = 5
UNION ALL SELECT 'failed', count(*) FROM messages WHERE process = 'error'
UNION ALL SELECT 'syslog', count(*) FROM messages WHERE process <> 'error'""",
    "intake_replay_changed": f"""{MESSAGES}
SELECT 'errors' AS "table", count(*) AS n FROM events WHERE event_id % 6 = 5
UNION ALL SELECT 'audit', 0
UNION ALL SELECT 'urgent', count(*) FROM messages WHERE severity = 0
UNION ALL SELECT 'syslog', count(*) FROM messages WHERE severity <> 0""",
    "intake_batch": MESSAGE_ROWS,
    "write_database": MESSAGE_ROWS,
    "intake_dispatch": ERROR_ROWS,
    "intake_gated": f"SELECT *, 'None 0 None' AS batches FROM ({ERROR_ROWS})",
    "stream_gated": f"SELECT *, '0 1 1 2' AS batches FROM ({ERROR_ROWS})",
    "daily_files": f"""{MESSAGES}
SELECT CAST(date AS DATE) AS date_day, count(*) AS n, min(date) AS first, max(date) AS last
FROM messages GROUP BY 1""",
    "compact_day": f"SELECT *, true AS few_files, true AS same_before FROM ({MESSAGE_ROWS})",
    "intake_replay": f"""{ROUTED},
stored AS (
  SELECT 'errors' AS "table", TIMESTAMP '2024-06-01 12:00:00' AS date
  FROM parts WHERE event_id % 6 = 5
  UNION ALL
  SELECT CASE route WHEN 'kernel' THEN 'audit' ELSE route END, date FROM renamed)
SELECT "table", count(*) AS n, count(DISTINCT date) AS dates FROM stored GROUP BY 1""",
    "daily_layout": f"""{MESSAGES}
SELECT CAST(date AS DATE) AS date_day, count(*) AS n, min(date) AS first, max(date) AS last,
  CAST(sum(pid) AS BIGINT) AS pids FROM messages GROUP BY 1""",
    "ingest_stream": MESSAGE_ROWS,
    "chunk_stream": f"{CHUNKS} SELECT * FROM chunks",
    "chunk_stream_timers": f"""{CHUNKS},
made AS (
  SELECT user_id, session_start, part, count(*) AS logs, min(ts) AS first_ts, max(ts) AS last_ts
  FROM chunks GROUP BY ALL),
ended AS (
  SELECT *, session_start < max(session_start) OVER (PARTITION BY user_id)
      OR (epoch_us(max(last_ts) OVER (PARTITION BY user_id, session_start)) + 21600000000) // 1000 + 1
        <= epoch_us(max(last_ts) OVER ()) // 1000 AS over FROM made)
SELECT user_id, session_start, part, logs, first_ts, last_ts,
  CASE WHEN logs = 3 THEN 'size' ELSE 'time' END AS closed_by
FROM ended WHERE logs = 3 OR over""",
}
