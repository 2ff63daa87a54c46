import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from logintake.operators.parse import MESSAGE_COLUMNS, REASONS, parse_syslog
from model import meaning

# Lines of every kind; the first two families follow examples of RFC 5424 and RFC 3164, some shortened or altered.
GOOD = [
    "<34>1 2003-10-11T22:14:15.003Z mymachine.example.com su - ID47 - 'su root' failed for lonvick",
    "<165>1 2003-08-24T05:14:15.000003-07:00 192.0.2.1 myproc 8710 - - %% It's time",
    '<165>1 2003-10-11T22:14:15.003Z host.example.com evntslog - ID47 [ex@32473 iut="3"] An event',
    "<34>Oct 11 22:14:15 mymachine su: 'su root' failed for lonvick on /dev/pts/8",
    "<13>Feb  5 17:32:18 10.0.0.99 Use the BFG!",
    "<165>Aug 24 05:34:00 CST 1987 mymachine myproc[10]: %% Mix=OK # %%",
    "<7>2021-03-04T05:06:07Z gate ntpd ",
    "<0>2021-03-04T05:06:07,123456789+0530 gate ntpd[31]: ",
    "<191>Mon, 15 Jan 2024 01:02:03 -0700 h app[+5]: text",
    "<191>Mon, 15 Jan 2024 01:02:03 GMT h app: text",
    "<1>mon JAN 15 01:02:03 2024 h app[5] text\nwith a second line",
    "<999>9 2024-02-29T23:59:59Z   -5 - - ",
    "<-1>1 2024-01-01T1:02:03.1234Z h a - - -",
    "<13>Feb 29 12:00:00 ABC 2023 app: year is a word here",
    "<13>0000-02-29T12:00:00+02:00 h app: year zero",
    "<13>Sep  9 09:09:09 cron: no host in front",
    "<13>Jun 5 12:00:00 CEST 2024 h é[7]: ünïcode 中",
    "<13>Jan 5 2:00:00.5 h app: a fraction in a short stamp",
]


def parsed(spark, lines, **options):
    df = spark.createDataFrame(list(enumerate(lines)), "n int, line string")
    out = parse_syslog(df, **options).withColumn("date", F.col("date").cast("timestamp_ntz"))
    return [r for r in out.orderBy("n").collect()]


def check(spark, lines, year):
    for line, row in zip(lines, parsed(spark, lines, ref_time=dt.datetime(year, 7, 1))):
        want = meaning(line, year)
        got = row.error_code or tuple(row[c] for c in MESSAGE_COLUMNS)
        assert got == want, line
        assert row.raw == line
        assert row.error_reason == REASONS.get(row.error_code)


def test_good_lines(spark):
    check(spark, GOOD, 2023)
    assert all(isinstance(meaning(line, 2023), tuple) for line in GOOD)


def test_fields(spark):
    row = parsed(spark, GOOD[1:2])[0]
    assert [row[c] for c in MESSAGE_COLUMNS] == [
        dt.datetime(2003, 8, 24, 12, 14, 15, 3), 20, 5, "192.0.2.1", "myproc", 0, "%% It's time",
    ]


def test_every_prefix_of_every_line(spark):
    """Each line breaks off after each character, and so in every possible way."""
    check(spark, sorted({line[:n] for line in GOOD for n in range(len(line))}), 2024)


def test_damaged_lines(spark):
    pick = random.Random(42)
    lines = []
    for _ in range(6000):
        line = pick.choice(GOOD)
        for _ in range(pick.randint(1, 3)):
            at = pick.randrange(len(line) + 1) if pick.random() < 0.2 else pick.randrange(45)
            what = pick.choice(["", " ", "-", ":", "[", "]", "<", ">", "0", "9", "Z", "x", "."])
            line = line[:at] + what + line[at + pick.randint(0, 1):]
        lines.append(line)
    codes = {c for c in (meaning(line, 2023) for line in lines) if isinstance(c, int)}
    assert codes >= {1, 2, 3, 4, 7, 8, 10, 12, 15}
    check(spark, lines, 2023)


STAMPS = [
    "2024-01-31T00:00:00{}Z", "2024-01-31T00:00:00{}+01:30", "2024-12-31T23:59:59{}-2460",
    "2024-1-31T00:00:00{}Z", "2023-02-29T00:00:00{}Z", "2024-01-31T00:60:00{}Z",
    "2024-01-31T00:00:60{}Z", "2024-01-31T7:00:00{}Z", "2024-01-31t00:00:00{}Z",
    "2024-01-31T00:00:00{}+2501", "2024-01-31T00:00:00{}+0061", "2024-01-00T00:00:00{}Z",
    "Mon, 15 Jan 2024 01:02:03{} +0000", "Xxx, 15 Jan 2024 01:02:03{} +0000",
    "Mon, 15 Jan 2024 1:02:03{} CEST", "Mon, 5 Jan 2024 01:02:03{} UTC",
    "Jan 15 01:02:03{} GMT 2024", "Jan  5 1:02:03{} GMT+3 2024", "Jan 5 01:02:03{} UTCT 2024",
    "Jan 15 01:02:03{} +05 2024", "Jan 15 01:02:03{} +24 2024", "Jan 15 01:02:03{} abc 2024",
    "Jan  5 1:02:03{} WITA 2024", "Jan  5 1:02:03{} ChST 2024", "Jan  5 1:02:03{} ABCD 2024",
    "Feb 29 01:02:03{} UTC 2024", "Feb 29 01:02:03{} UTC 1900", "Feb 30 01:02:03{}",
    "Wed Feb 28 01:02:03{} 2024", "Wed Feb  8 1:02:03{} 2024", "Feb 29 01:02:03{}",
    "Jan 015 1:02:03{}", "Jan   5 1:02:03{}", "Abc 15 01:02:03{}", "JAN 15 24:02:03{}",
]


@pytest.mark.parametrize("head", ["<13>", "<13>1 "])
def test_timestamps(spark, head):
    fractions = [""] + ["." + "1234567890"[:n] for n in range(1, 11)] + [",5", ",500", "."]
    check(
        spark,
        [f"{head}{stamp.format(f)} host app: x" for stamp in STAMPS for f in fractions],
        2023,
    )


def test_options(spark):
    assert parsed(spark, GOOD[1:2], store_procid=True)[0].pid == 8710
    assert parsed(spark, GOOD[0:1], store_procid=True)[0].pid == 0
    row = parsed(spark, [GOOD[5]], zone_offsets={"CST": -360})[0]
    assert row.date == dt.datetime(1987, 8, 24, 11, 34)
    df = spark.createDataFrame([(GOOD[3], dt.date(1999, 1, 1))], "line string, seen date")
    row = parse_syslog(df, ref_time=F.col("seen")).first()
    assert row.date.year == 1999 and row.seen == dt.date(1999, 1, 1)


def test_null_and_other_columns(spark):
    df = spark.createDataFrame([(None, 1)], "`a b` string, `x.y` int")
    row = parse_syslog(df, "a b").first()
    assert (row.error_code, row.raw, row["x.y"]) == (1, None, 1)


def test_columns_are_not_overwritten(spark):
    with pytest.raises(ValueError):
        parse_syslog(spark.createDataFrame([("x", 1)], "line string, pid int"))


def test_bytes_that_are_no_text(spark):
    lines = [
        b"<13>2024-01-01T00:00:00Z h\xe9 app[5]: d\xe9j\xe0 vu",
        b"<13>1 2024-01-01T00:00:00Z h\xc3 a\xe9 1 - - \xff\xfe",
    ]
    df = spark.createDataFrame([(b,) for b in lines], "line binary")
    fields = [F.col(c).cast("binary").alias(c) for c in ("hostname", "process", "data", "raw")]
    got = [tuple(bytes(v) for v in r) for r in parse_syslog(df).select(*fields).collect()]
    assert got == [
        (b"h\xe9", b"app", b"d\xe9j\xe0 vu", lines[0]),
        (b"h\xc3", b"a\xe9", b"\xff\xfe", lines[1]),
    ]


def test_long_lines_keep_their_text(spark):
    text = "word [:] " * 200_000
    row = parsed(spark, ["<13>2024-01-01T00:00:00Z h app[1]: " + text])[0]
    assert row.data == text
