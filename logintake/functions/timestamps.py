"""Timestamps in front of a log message, as SQL expressions.

A stamp counts only if a space follows it and its total length is one of the
accepted layouts, so the patterns below fix shape and length together. ``STAMP``
cuts the stamp out of the head of a line, ``PARTS`` takes it apart, and
``date_steps`` turns the parts into a date. All three are steps: each maps names
of new columns to SQL over the columns before.
"""

from __future__ import annotations

# The longest accepted stamp and the space after it.
HEAD_CHARS = 36

# Month and weekday names, in any letter case.
MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec"
WEEKDAYS = "sun mon tue wed thu fri sat"

_MONTH = "(?i:" + MONTHS.replace(" ", "|") + ")"
_WEEKDAY = "(?i:" + WEEKDAYS.replace(" ", "|") + ")"
_CLOCK = r"\d{1,2}:\d\d:\d\d(?:[.,]\d+)?"
_LEAP = r"(?:\d\d(?:0[48]|[2468][048]|[13579][26])|(?:[02468][048]|[13579][26])00)"

# Zone names: UTC, GMT with or without hours, signed hours up to 23, three
# capitals, four or five capitals ending in T, and three exceptions.
_HOURS = r"[+-]0*(?:1?\d|2[0-3])"
_ZONE = (
    rf"(?:GMT(?:{_HOURS})?|{_HOURS}|ChST|MeST|WITA"
    r"|[A-Z]{3}|(?!UTC|GMT)[A-Z]{3,4}T)"
)

# The accepted layouts. ISO dates take 0, 3, 6 or 9 fraction
# digits, one more after a one-digit hour. The others have a total length.
_ISO = (
    r"^\d{4}-\d\d-\d\dT"
    r"(?:\d\d:\d\d:\d\d(?:[.,](?:\d{9}|\d{6}|\d{3}))?"
    r"|\d:\d\d:\d\d[.,](?:\d{10}|\d{7}|\d{4}))"
    r"(?:Z|[+-]\d\d:?\d\d)(?= )"
)


def _long(chars: int) -> str:
    return rf"(?<=^.{{{chars}}})"


_FULL_DAY = rf", +\d\d +{_MONTH} +\d{{4}} +{_CLOCK} +"
_SHORT_DAY = rf"{_MONTH} +\d{{1,2}} +{_CLOCK}"
# 29 February of a common year is no date in the longer of the two layouts that
# start alike; the shorter may take it.
_NO_DATE = rf"(?i:feb) +29 +\S+ +\S+ +(?!{_LEAP} )\d{{4}} "
_SPELLED = (
    rf"^(?:(?!{_NO_DATE}){_SHORT_DAY} +{_ZONE} +\d{{4}}{_long(24)}"
    rf"|{_SHORT_DAY}{_long(15)}"
    rf"|{_WEEKDAY}(?:{_FULL_DAY}(?:[+-]\d{{4}}{_long(31)}|{_ZONE}{_long(29)})"
    rf"| +{_SHORT_DAY} +\d{{4}}{_long(24)}))(?= )"
)

# The stamp at the start of ``__head``, or ''; ``__iso_only`` rules out the others.
STAMP = (
    {"__iso": f"regexp_extract(__head, r'{_ISO}', 0)"},
    {
        "__stamp": f"""CASE WHEN __iso <> '' OR __iso_only THEN __iso
                       ELSE regexp_extract(__head, r'{_SPELLED}', 0) END"""
    },
)


def _by_layout(iso: str, full: str, short: str, weekday: str, year: str) -> str:
    return f"""CASE __layout WHEN 'iso' THEN {iso} WHEN 'short' THEN {short}
               WHEN 'full' THEN {full} WHEN 'weekday' THEN {weekday} ELSE {year} END"""


def _word(at: int) -> str:
    return f"get(__words, {at})"


# From ``__stamp`` to the words it consists of. Spark itself reads most ISO
# stamps. It knows no comma, no one-digit hour and no offset beyond 18 hours, and
# does not complete year 0; what is left is taken apart.
PARTS = (
    {
        "__direct": """CASE WHEN substring(__stamp, 5, 1) = '-'
              AND substring(__stamp, 14, 1) = ':' AND substring(__stamp, 1, 4) <> '0000'
            THEN try_cast(__stamp AS timestamp) END"""
    },
    {"__left": "CASE WHEN __direct IS NULL THEN __stamp END"},
    {"__words": "CASE WHEN substring(__left, 5, 1) <> '-' THEN split(__left, ' +') END"},
    {
        # The two layouts of five words differ in what the second word is.
        "__layout": f"""CASE WHEN __words IS NULL THEN 'iso'
            WHEN size(__words) = 3 THEN 'short' WHEN size(__words) = 6 THEN 'full'
            WHEN substring({_word(1)}, 1, 1) BETWEEN '0' AND '9' THEN 'year'
            ELSE 'weekday' END"""
    },
    {
        "__year": _by_layout(
            "substring(__left, 1, 4)", _word(3), "'0000'", _word(4), _word(4)
        ),
        "__month": _by_layout("''", _word(2), _word(0), _word(1), _word(0)),
        "__mday": _by_layout("''", _word(1), _word(1), _word(2), _word(1)),
        "__time": _by_layout(
            f"substring(__left, 12, {HEAD_CHARS})", _word(4), _word(2), _word(3), _word(2)
        ),
        "__zone": _by_layout(
            """CASE WHEN endswith(__left, 'Z') THEN 'Z'
               WHEN substring(__left, -3, 1) = ':' THEN substring(__left, -6, 6)
               ELSE substring(__left, -5, 5) END""",
            _word(5), "NULL", "NULL", _word(3),
        ),
    },
)

# What ``date_steps`` reads of the columns so far.
PARTS_KEPT = (
    "__stamp", "__direct", "__left", "__layout", "__year", "__month", "__mday", "__time", "__zone",
)


def date_steps(zone_offsets: dict[str, int] | None = None) -> tuple[dict[str, str], ...]:
    """Steps from the parts to ``__date``, null if there is no such date.

    A stamp without a year, or of year 0, gets ``__ref_year``. Its day has to
    exist in a leap year; 29 February of a common year turns into 1 March. Zone
    names count as UTC unless ``zone_offsets`` gives their minutes east of it.
    Digits behind the microsecond are cut off.
    """
    zone_offsets = zone_offsets or {}
    if not all(name.isalnum() for name in zone_offsets):
        raise ValueError("zone names consist of letters and digits")
    named = " ".join(
        f"WHEN __zone = '{name}' THEN {int(east)}" for name, east in zone_offsets.items()
    )
    return (
        {
            "__month_day": f"""CASE __layout WHEN 'iso' THEN substring(__left, 6, 5)
                ELSE concat(lpad(cast((instr('{MONTHS}', lower(__month)) + 3) div 4 AS string), 2, '0'),
                            '-', lpad(__mday, 2, '0')) END""",
            "__clock": """CASE WHEN substring(__time, 2, 1) = ':' THEN concat('0', __time)
                ELSE __time END""",
            "__offset": f"""CASE
                WHEN length(__zone) IN (5, 6) AND substring(__zone, 1, 1) IN ('+', '-') THEN
                  CASE WHEN substring(__zone, 2, 2) <= '24' AND substring(__zone, -2, 2) <= '60'
                    THEN (cast(substring(__zone, 2, 2) AS int) * 60
                          + cast(substring(__zone, -2, 2) AS int))
                         * CASE WHEN startswith(__zone, '-') THEN -1 ELSE 1 END END
                {named} ELSE 0 END""",
        },
        {
            "__day": """CASE WHEN __year <> '0000' THEN concat(__year, '-', __month_day)
                WHEN __month_day = '02-29'
                  AND (__ref_year % 4 <> 0 OR __ref_year % 100 = 0 AND __ref_year % 400 <> 0)
                  THEN concat(lpad(cast(__ref_year AS string), 4, '0'), '-03-01')
                ELSE concat(lpad(cast(__ref_year AS string), 4, '0'), '-', __month_day) END""",
            # Hour to second and the mark take nine characters; the zone of an
            # ISO stamp follows the fraction.
            "__digits": """length(__clock) - 9
                - CASE __layout WHEN 'iso' THEN length(__zone) ELSE 0 END""",
            "__seconds": """CASE WHEN substring(__clock, 1, 2) < '24'
                  AND substring(__clock, 4, 2) < '60' AND substring(__clock, 7, 2) < '60'
                THEN try_cast(substring(__clock, 1, 2) AS int) * 3600
                   + try_cast(substring(__clock, 4, 2) AS int) * 60
                   + try_cast(substring(__clock, 7, 2) AS int) END""",
        },
        {
            "__date": """CASE WHEN __direct IS NOT NULL THEN __direct
                WHEN __left <> '' THEN timestamp_micros(
                (cast(unix_date(try_cast(__day AS date)) AS bigint) * 86400
                 + __seconds - __offset * 60) * 1000000
                + CASE WHEN __digits > 0 THEN try_cast(
                    rpad(substring(__clock, 10, least(__digits, 6)), 6, '0') AS int)
                  ELSE 0 END) END"""
        },
    )
