"""What a line means, spelled out with Python regexes, to test the parser against."""

from __future__ import annotations

import datetime as dt
import re

MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
DAYS = {"mon", "tue", "wed", "thu", "fri", "sat", "sun"}
NUMBER = re.compile(r"[+-]?[0-9]+\Z")

CLOCK = r"(?P<h>\d\d?):(?P<m>\d\d):(?P<s>\d\d)(?:[.,](?P<f>\d+))?"
ZONE = (
    r"(?P<z>UTC|GMT(?:[+-]\d+)?|[+-]\d+|ChST|MeST|WITA|[A-Z]{3}|"
    r"(?!UTC|GMT)[A-Z]{3}T|(?!UTC|GMT)[A-Z]{4}T)"
)
ISO = r"(?P<Y>\d{4})-(?P<M>\d\d)-(?P<D>\d\d)T" + CLOCK
MONTH_DAY = r"(?P<b>[A-Za-z]{3}) +(?P<D>\d\d?) +" + CLOCK
LONG_DAY = r"(?P<w>[A-Za-z]{3}), +(?P<D>\d\d) +(?P<b>[A-Za-z]{3}) +(?P<Y>\d{4}) +" + CLOCK + " +"

# Length to the shapes of that length, longest first.
ISO_SHAPES = (
    [(n, ISO + r"(?P<o>[+-]\d\d:\d\d)") for n in (35, 32, 29, 25)]
    + [(n, ISO + r"(?P<o>[+-]\d{4})") for n in (34, 31, 28, 24)]
    + [(n, ISO + "Z") for n in (30, 27, 24, 20)]
)
ALL_SHAPES = ISO_SHAPES + [
    (31, LONG_DAY + r"(?P<o>[+-]\d{4})"),
    (29, LONG_DAY + ZONE),
    (24, MONTH_DAY + " +" + ZONE + r" +(?P<Y>\d{4})"),
    (24, r"(?P<w>[A-Za-z]{3}) +" + MONTH_DAY + r" +(?P<Y>\d{4})"),
    (15, MONTH_DAY),
]


def read_stamp(text: str, shapes, year: int):
    """(date, length) of the stamp at the start of ``text``, or None."""
    for length, shape in sorted(shapes, key=lambda s: -s[0]):
        if len(text) <= length or text[length] != " ":
            continue
        m = re.fullmatch(shape, text[:length])
        if not m:
            continue
        g = m.groupdict()
        if g.get("w") and g["w"].lower() not in DAYS:
            continue
        if g.get("z") and re.search(r"[+-]", g["z"]) and int(re.sub(r"\D", "", g["z"])) > 23:
            continue
        if g.get("b") and g["b"].lower() not in MONTHS:
            continue
        month = MONTHS.index(g["b"].lower()) + 1 if g.get("b") else int(g["M"])
        named = int(g.get("Y") or 0)
        clock = int(g["h"]), int(g["m"]), int(g["s"])
        micros = int(((g["f"] or "") + "000000")[:6])
        try:
            # A leap year judges the day of a stamp without a year.
            dt.datetime(named or 2000, month, int(g["D"]), *clock)
        except ValueError:
            continue
        start = dt.datetime(named or year, month, 1, *clock, micros)
        date = start + dt.timedelta(days=int(g["D"]) - 1)
        if g.get("o"):
            hours, minutes = int(g["o"][1:3]), int(g["o"][-2:])
            if hours > 24 or minutes > 60:
                continue
            east = dt.timedelta(hours=hours, minutes=minutes)
            date += east if g["o"][0] == "-" else -east
        return date, length
    return None


def number(text: str):
    if not NUMBER.match(text) or not -(2**63) <= int(text) < 2**63:
        return None
    return int(text)


def fits(n: int) -> bool:
    return -(2**31) <= n < 2**31


def meaning(line: str, year: int):
    """The error code, or (date, facility, severity, hostname, process, pid, data)."""
    if line[:1] != "<":
        return 1
    inside, closed, rest = line[1:].partition(">")
    if not closed:
        return 4
    if not inside:
        return 2
    priority = number(inside)
    if priority is None:
        return 3
    new = re.match(r"[0-9] .", rest, re.S) is not None
    if new:
        rest = rest[2:]
        if rest.startswith("-"):
            return 7
    stamp = read_stamp(rest, ISO_SHAPES if new else ALL_SHAPES, year)
    if not stamp:
        return 8
    rest = rest[stamp[1] + 1:]
    words = rest.split(" ", 4 if new else 1)
    if len(words) < 2:
        return 9
    host, pid = words[0], 0
    if new:
        if len(words) < 3:
            return 10
        if len(words) < 4:
            return 11
        if not words[2].startswith("-") and number(words[2]) is None:
            return 12
        if len(words) < 5:
            return 13
        process, data = words[1], words[4]
        data = data[2:] if data.startswith("- ") else data
    else:
        rest = words[1]
        if not rest:
            return 10
        m = re.match(r"([^\[ :]*)([\[ :])", rest)
        if not m:
            return 15
        process, rest = m.group(1), rest[m.end(1):]
        if m.group(2) == "[":
            inside, closed, rest = rest[1:].partition("]")
            if not closed:
                return 14
            pid = number(inside)
            if pid is None:
                return 12
        m = re.match(":? ", rest)
        if not m:
            return 15
        data = rest[m.end():]
    if not (fits(priority >> 3) and fits(pid)):
        return 16
    return stamp[0], priority >> 3, priority & 7, host, process, pid, data
