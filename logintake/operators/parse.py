"""Parse syslog lines of both families into columns.

Each step finds the position of the next delimiter, and the fields are cut out
at the end. Every step is one projection; together they run as one narrow stage
without a shuffle, a regex over a whole line, or Python.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logintake.functions.timestamps import HEAD_CHARS, PARTS, PARTS_KEPT, STAMP, date_steps

# Reasons by code. Codes 5 and 6 are declared but never given;
# 16 is our own, for numbers the integer columns cannot hold.
REASONS = {
    1: "'<' expected at start of message",
    2: "priority cannot be empty",
    3: "can't decode priority",
    4: "priority not terminated",
    5: "expect protocol version",
    6: "wrong protocol version",
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

MESSAGE_COLUMNS = ["date", "facility", "severity", "hostname", "process", "pid", "data"]

Steps = tuple[dict[str, str], ...]


def _integer(text: str) -> str:
    """64-bit value of a decimal number, null for anything else. The cast alone
    would also take white space around the number."""
    return f"""CASE WHEN substring({text}, 1, 1) BETWEEN '+' AND '9'
                     AND substring({text}, -1, 1) BETWEEN '0' AND '9'
               THEN try_cast({text} AS bigint) END"""


def _between(line: str, start: str, end: str) -> str:
    """Text from ``start`` up to, but without, ``end``."""
    return f"substring({line}, {start}, {end} - ({start}))"


# Priority, family, and the timestamp as text. ``__gt`` is null without a
# priority and 0 if it has no end.
HEAD: Steps = (
    # String functions step over characters, and may lose the way in bytes that
    # are no UTF-8. Such a line is read with one character per byte.
    {"__bytewise": "NOT is_valid_utf8(__raw)"},
    {
        "__line": """CASE WHEN __bytewise THEN decode(cast(__raw AS binary), 'ISO-8859-1')
                     ELSE __raw END"""
    },
    {"__gt": "CASE WHEN startswith(__line, '<') THEN position('>', __line) END"},
    {
        "__digits": _between("__line", "2", "__gt"),
        "__new": """substring(__line, __gt + 1, 1) BETWEEN '0' AND '9'
                    AND substring(__line, __gt + 2, 1) = ' '
                    AND substring(__line, __gt + 3, 1) <> ''""",
    },
    {
        "__priority": _integer("__digits"),
        "__start": "__gt + CASE WHEN __new THEN 3 ELSE 1 END",
        "__iso_only": "__new",
    },
    {
        "__head": f"""CASE WHEN __priority IS NOT NULL
                      THEN substring(__line, __start, {HEAD_CHARS}) END"""
    },
    *STAMP,
)

AFTER_DATE: Steps = (
    {
        "__rest": """CASE WHEN __date IS NOT NULL
                     THEN substr(__line, __start + length(__stamp) + 1) END""",
        "__nil_date": "__new AND substring(__line, __start, 1) = '-'",
    },
)


def _found(position: str) -> str:
    return f"CASE WHEN {position} > 0 THEN {position} END"


# Delimiters behind the timestamp. A null position ends the chain.
BODY: Steps = (
    {"__space": "instr(__rest, ' ')"},
    {"__host_end": _found("__space")},
    {"__space": "position(' ', __rest, __host_end + 1)"},
    {"__app_end": _found("__space")},
    {
        "__tag": f"""CASE WHEN __new THEN NULL
            WHEN __app_end IS NOT NULL THEN {_between("__rest", "__host_end + 1", "__app_end")}
            ELSE substr(__rest, __host_end + 1) END""",
        "__space": "CASE WHEN __new THEN position(' ', __rest, __app_end + 1) END",
    },
    {
        "__procid_end": _found("__space"),
        "__bracket": "instr(__tag, '[')",
        "__colon": "instr(__tag, ':')",
    },
    {
        "__tag_end": f"""__host_end + least({_found("__bracket")}, {_found("__colon")},
                                            __app_end - __host_end)""",
        "__space": "position(' ', __rest, __procid_end + 1)",
    },
    {
        "__msgid_end": _found("__space"),
        "__opened": "substring(__rest, __tag_end, 1) = '['",
        "__process_end": "CASE WHEN __new THEN __app_end ELSE __tag_end END",
    },
    {"__close": "CASE WHEN __opened THEN position(']', __rest, __tag_end + 1) END"},
    {"__pid_end": _found("__close")},
    {
        "__after_pid": "CASE WHEN __opened THEN __pid_end + 1 ELSE __tag_end END",
        "__pid_text": f"""CASE
            WHEN __new THEN {_between("__rest", "__app_end + 1", "__procid_end")}
            WHEN __opened THEN {_between("__rest", "__tag_end + 1", "__pid_end")} END""",
    },
    {
        "__after_tag": """__after_pid
            + CASE WHEN substring(__rest, __after_pid, 1) = ':' THEN 1 ELSE 0 END""",
        "__number": _integer("__pid_text"),
    },
    {
        "__body": """CASE
            WHEN __new THEN __msgid_end
              + CASE WHEN substring(__rest, __msgid_end + 1, 2) = '- ' THEN 3 ELSE 1 END
            WHEN substring(__rest, __after_tag, 1) = ' ' THEN __after_tag + 1 END""",
        "__facility": "try_cast(shiftright(__priority, 3) AS int)",
        "__pid": """try_cast(coalesce(
            CASE WHEN NOT __new OR __store_procid THEN __number END, 0) AS int)""",
        "__bad_pid": """__pid_text IS NOT NULL AND __number IS NULL
            AND NOT (__new AND startswith(__pid_text, '-'))""",
    },
    # The first failure in reading order decides.
    {
        "__code": """CASE
            WHEN __gt IS NULL THEN 1
            WHEN __gt = 0 THEN 4
            WHEN __gt = 2 THEN 2
            WHEN __priority IS NULL THEN 3
            WHEN __nil_date THEN 7
            WHEN __date IS NULL THEN 8
            WHEN __host_end IS NULL THEN 9
            WHEN __app_end IS NULL AND (__new OR __tag = '') THEN 10
            WHEN __new AND __procid_end IS NULL THEN 11
            WHEN __process_end IS NULL THEN 15
            WHEN __opened AND __pid_end IS NULL THEN 14
            WHEN __bad_pid THEN 12
            WHEN __new AND __msgid_end IS NULL THEN 13
            WHEN __body IS NULL THEN 15
            WHEN __facility IS NULL OR __pid IS NULL THEN 16 END"""
    },
)


def _good(value: str) -> str:
    return f"CASE WHEN __code IS NULL THEN {value} END"


def _text(value: str) -> str:
    return _good(
        f"""CASE WHEN __bytewise THEN cast(encode({value}, 'ISO-8859-1') AS string)
            ELSE {value} END"""
    )


_REASON = " ".join(
    'WHEN {} THEN "{}"'.format(code, reason) for code, reason in REASONS.items()
)

FIELDS = {
    "date": _good("__date"),
    "facility": _good("__facility"),
    "severity": _good("cast(__priority & 7 AS int)"),
    "hostname": _text(_between("__rest", "1", "__host_end")),
    "process": _text(_between("__rest", "__host_end + 1", "__process_end")),
    "pid": _good("__pid"),
    "data": _text("substr(__rest, __body)"),
    "error_code": "__code",
    "error_reason": f"CASE __code {_REASON} END",
    "raw": "__raw",
}


def _take(df: DataFrame, steps: Steps) -> DataFrame:
    for step in steps:
        df = df.withColumns({name: F.expr(sql) for name, sql in step.items()})
    return df


def _settle(df: DataFrame, kept: list[Column], *names: str) -> DataFrame:
    """Keep ``names`` of the steps so far, and let each row compute them once.

    A generator over one struct is the identity, but the optimizer pushes no
    filter on its output below it. Without it, a filter on the error code would
    be spelled out in terms of the line, over and over at each step. It also ends
    a generated method, and methods of more than 8000 bytes are never compiled.
    """
    return df.select(*kept, F.expr(f"inline(array(struct({', '.join(names)})))"))


def _reference_year(ref_time) -> Column:
    if ref_time is None:
        ref_time = F.current_timestamp()
    elif isinstance(ref_time, (str, dt.date)):
        ref_time = F.lit(ref_time).cast("timestamp")
    return F.year(ref_time)


def parse_syslog(
    df: DataFrame,
    col: str = "line",
    ref_time: Column | dt.datetime | str | None = None,
    store_procid: bool = False,
    zone_offsets: dict[str, int] | None = None,
) -> DataFrame:
    """Add the seven message columns, ``error_code``, ``error_reason`` and ``raw``.

    ``error_code`` is null for a decoded line; the message columns are null for
    the others. ``ref_time`` (a value or a column) completes stamps without a
    year; by default the time of the query. ``store_procid`` keeps the number in
    the PROCID field of the newer family, which otherwise is only checked.
    ``zone_offsets`` maps zone names to minutes east of UTC. The input columns
    other than ``col`` are kept.
    """
    taken = set(FIELDS) & {c for c in df.columns if c != col}
    if taken:
        raise ValueError(f"rename the input columns {sorted(taken)}")
    columns = [F.col(f"`{c}`") for c in df.columns if c != col]
    out = df.select(
        *columns,
        F.col(f"`{col}`").cast("string").alias("__raw"),
        _reference_year(ref_time).alias("__ref_year"),
    )
    kept = [*columns, F.col("__raw"), F.col("__bytewise")]
    out = _take(out, HEAD)
    head = ["__gt", "__priority", "__new", "__start"]
    before = [*kept, F.col("__line"), F.col("__ref_year")]
    out = _settle(out, before, *head, "__stamp")
    out = _take(out, PARTS)
    out = _settle(out, [*before, *map(F.col, head)], *PARTS_KEPT)
    out = _take(out, (*date_steps(zone_offsets), *AFTER_DATE))
    out = _settle(
        out, [*kept, *map(F.col, head[:3])], "__nil_date", "__date", "__rest"
    )
    out = _take(out.withColumn("__store_procid", F.lit(store_procid)), BODY)
    out = _settle(
        out, [*kept, *map(F.col, ("__priority", "__date", "__rest"))],
        "__host_end", "__process_end", "__body", "__facility", "__pid", "__code",
    )
    return out.select(*columns, *[F.expr(sql).alias(name) for name, sql in FIELDS.items()])
