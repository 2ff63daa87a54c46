"""Versioned tables, compaction, and stamps from batch to batch."""

import datetime as dt

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from logintake.operators.clock import unique_micros
from logintake.operators.route import Processor
from logintake.plans import intake as plan
from logintake.plans.stamps import StampBlocks
from logintake.plans.versions import Conflict, VersionedTable, bins, compact, read_versioned, vacuum, versioned_writer
from test_jobs import REF, message, now

DAY = dt.date(2024, 1, 3)


def take(spark, root, numbers, batch, chain=None):
    lines = spark.createDataFrame([(message(n),) for n in numbers] + [("bad",)], "value string").coalesce(2)
    plan.intake(lines, root, chain, ref_time=REF, ingest_time=now(), batch_id=batch, keep="cache", writer=versioned_writer)


def pids(spark, root, table="syslog", **options) -> list[int]:
    return sorted(r.pid for r in read_versioned(spark, root, table, **options).collect())


def test_batches_and_versions(spark, tmp_path):
    root = str(tmp_path)
    take(spark, root, range(30), 0)
    take(spark, root, range(30, 60), 1)
    take(spark, root, range(100, 110), 1)
    found = VersionedTable(spark, f"{root}/syslog")
    assert found.versions() == [1, 2, 3]
    assert pids(spark, root) == [*range(30), *range(100, 110)]
    assert pids(spark, root, version=2) == list(range(60)) and pids(spark, root, version=1) == list(range(30))
    # A day opens the files of that day.
    assert pids(spark, root, day=DAY) == [2] + [n for n in range(100, 110) if n % 28 == 2]
    assert all("date_day=2024-01-03" in f for f in found.files(day=DAY))
    assert read_versioned(spark, root, "errors").count() == 2
    # Without a number rows are added; another chain empties tables it has not got.
    take(spark, root, [200], None)
    take(spark, root, [7, 8], 2, [Processor("odd", F.col("pid") == 7)])
    assert pids(spark, root, "odd") == [7] and 200 in pids(spark, root) and 8 in pids(spark, root)
    take(spark, root, [7, 8], 2)
    assert pids(spark, root, "odd") == [] and pids(spark, root)[5:9] == [5, 6, 7, 7]


def test_compaction(spark, tmp_path):
    root = str(tmp_path)
    for batch in range(3):
        take(spark, root, range(28 * batch, 28 * batch + 28), batch)
    found = VersionedTable(spark, f"{root}/syslog")
    before, version = read_versioned(spark, root, "syslog"), found.latest()
    assert compact(spark, root, "syslog", [DAY]) == version + 1
    assert len(found.files(day=DAY)) == 1 and len(found.files()) == 27 * 3 + 1
    assert compact(spark, root, "syslog", [DAY]) is None
    size = found.live().filter(F.col("day") != F.lit(DAY)).first().bytes
    assert compact(spark, root, "syslog", target_bytes=2 * size, hot_rows=1) == version + 2
    assert {r["count"] for r in found.live().groupBy("day").count().collect()} <= {1, 2}
    assert pids(spark, root) == list(range(84)) == sorted(r.pid for r in before.collect())
    assert pids(spark, root, version=version) == list(range(84))
    # Rows of several batches are in one file: none of them can be replaced any more.
    with pytest.raises(ValueError, match="compacted"):
        take(spark, root, [1], 1)
    take(spark, root, [500], 3)
    assert pids(spark, root)[-1] == 500
    # The files of older versions go, those of the last stay.
    assert vacuum(spark, root, "syslog", before=dt.datetime(2020, 1, 1)) == 0
    assert vacuum(spark, root, "syslog") == 28 * 3
    assert pids(spark, root) == [*range(84), 500] and found.versions() == [version + 3]


def test_tasks_of_many_days(spark, tmp_path, monkeypatch):
    """Tasks follow the bytes and not the days; a file is of one bin, its rows by time."""
    root, seen, plain = str(tmp_path), [], type(spark.range(0)).repartitionById
    lines = [(f"<13>1 {dt.date(2024, 1, 1) + dt.timedelta(n % 60)}T{n % 24:02d}:00:00Z h p {n} - - text",) for n in range(600)]
    for batch in range(3):
        some = spark.createDataFrame(lines[200 * batch : 200 * batch + 200], "value string").coalesce(2)
        plan.intake(some, root, ref_time=REF, ingest_time=now(), batch_id=batch, keep="cache", writer=versioned_writer,
                    store_procid=True)
    found = VersionedTable(spark, f"{root}/syslog")
    small = {r.file: (r.day, r.bytes) for r in found.live().collect()}
    target = max(size for _, size in small.values()) * 3 // 2
    want = {}
    for name, (day, size) in sorted(small.items()):
        before = want.setdefault(day, [])
        before.append((sum(s for _, s in before), size))
    bins_of = {day: len({at // target for at, _ in files}) for day, files in want.items()}

    def count(df, number, *columns):
        seen.append(number)
        return plain(df, number, *columns)

    monkeypatch.setattr(type(spark.range(0)), "repartitionById", count)
    assert compact(spark, root, "syslog", target_bytes=target, hot_rows=2)
    # Two for each core, and not one for each of 120 bins.
    assert seen == [min(sum(bins_of.values()), 2 * spark.sparkContext.defaultParallelism)]
    files = found.live().collect()
    assert {d: sum(f.day == d for f in files) for d in bins_of} == bins_of
    for f in files:
        dates = pq.ParquetFile(f"{root}/syslog/data/{f.file}").read(["date"]).column("date").to_pylist()
        assert dates == sorted(dates) and {d.date() for d in dates} == {f.day}
    assert pids(spark, root) == list(range(600))


def test_changes_at_the_same_time(spark, tmp_path):
    """A batch that comes in between stays; files that are gone meanwhile are a conflict."""
    root = str(tmp_path)
    take(spark, root, range(28), 0)
    found = VersionedTable(spark, f"{root}/syslog")
    seen = found.live(1).filter(F.col("day") == F.lit(DAY))
    take(spark, root, range(28, 56), 1)
    assert found.change(gone=seen) == 3
    assert pids(spark, root) == [n for n in range(56) if n != 2]
    with pytest.raises(Conflict):
        found.change(gone=seen)
    assert found.versions() == [1, 2, 3]


@pytest.mark.parametrize("hot_rows", [None, 4])
def test_bins(spark, hot_rows):
    rows = [(f"f{i:03d}", dt.date(2024, 1, 1 + i % 2), (i * 37) % 100 + 1) for i in range(60)]
    got = bins(spark.createDataFrame(rows, "file string, day date, bytes long"), 150, hot_rows).collect()
    where = {r.file: r.bin for r in got}
    for day in {r[1] for r in rows}:
        at = 0
        for name, _, size in sorted(r for r in rows if r[1] == day):
            assert where[name] == at // 150
            at += size


def by_hand(rows, last=None):
    """event_id to stamp, row by row; ``last`` by key."""
    last, out = dict(last or {}), {}
    for key, us, n in sorted(rows, key=lambda r: (r[1], r[2])):
        last[key] = max(us, last.get(key, us - 1) + 1)
        out[n] = last[key]
    return out, last


@pytest.mark.parametrize("keyed", [True, False])
@pytest.mark.parametrize("hot_rows", [None, 7])
def test_stamps_from_batch_to_batch(spark, tmp_path, keyed, hot_rows):
    blocks = StampBlocks(spark, str(tmp_path / f"s{keyed}{hot_rows}"), "k" if keyed else None)
    batches = [[(n % 3 + 4 * (b == 2), (n // 5) * (b != 1), 100 * b + n) for n in range(40)] for b in range(3)] + [[]]
    last: dict = {}
    for number, rows in enumerate(batches):
        own = [(k if keyed else 0, us, n) for k, us, n in rows]
        want, after = by_hand(own, last)
        df = spark.createDataFrame(rows, "k long, us long, n long").withColumn("ts", F.timestamp_micros("us"))
        for _ in range(2):
            got = blocks.stamp(df, number, "ts", "n", hot_rows=hot_rows)
            assert {r.n: r.unique_us for r in got.collect()} == want
        last = after
    with pytest.raises(ValueError):
        blocks.stamp(df, 9, "ts", "n")


def test_stamps_behind_a_number(spark):
    df = spark.range(5).select("id", F.timestamp_micros(F.col("id") * 10).alias("ts"))
    got = [r.unique_us for r in unique_micros(df, "ts", after=25).orderBy("id").collect()]
    assert got == [26, 27, 28, 30, 40]
