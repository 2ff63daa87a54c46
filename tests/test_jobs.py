"""Spool folders, tables and streams, on files."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from logintake.functions.codec import unescape
from logintake.operators.route import Processor, Processors
from logintake.plans import intake as plan
from logintake.plans.dispatch import dispatch
from logintake.plans.tables import jdbc_writer, parquet_writer, read_table, write_tables
from logintake.sources.containers import ContainerReader, manifest
from logintake.sources.spool import CONTAINERS, list_spool, read_spool, stream_spool, write_spool
from logintake.streaming.chunks import chunk_stream
from logintake.streaming.intake import ingest_stream, trigger
from workload.render import mixed_lines

REF = "2024-06-01 00:00:00"


def now():
    return F.lit("2024-06-01 12:00:00").cast("timestamp")


def spool_file(folder, start, lines, declared=None, end="\n"):
    name = f"{start:016x}.{len(lines) if declared is None else declared:08x}.log"
    (folder / name).write_bytes(b"".join(line.encode() + end.encode() for line in lines))
    return name


def message(n, text="text"):
    return f"<13>2024-01-{1 + n % 28:02d}T00:00:00Z host{n} app[{n}]: {text}"


def test_plain_folder(spark, tmp_path):
    first = spool_file(tmp_path, 1, ["a\rb", "c", ""], end="\r\n")
    second = spool_file(tmp_path, 2, ["only"], declared=3)
    empty = spool_file(tmp_path, 4, [], declared=3)
    spool_file(tmp_path, 3, ["x"]), (tmp_path / ".0.1.log").write_text("y\n")
    (tmp_path / "zz.1.log").write_text("z\n"), (tmp_path / "notes.txt").write_text("z\n")
    lines = read_spool(spark, str(tmp_path))
    got = [r.value for r in lines.filter(F.col("file_name") == first).collect()]
    assert got == ["a\rb", "c", ""]
    files = {r.file_name: (r.logs, r.bytes) for r in list_spool(spark, str(tmp_path)).collect()}
    assert files[first] == (3, 10) and files[second] == (3, 5) and files[empty] == (3, 0)
    assert len(files) == 4


def test_written_folder(spark, tmp_path, events):
    path = str(tmp_path / "spool")
    rows = events.select("event_id", "ts", "event_type", F.concat("props", F.lit("\n\té\\")).alias("m"))
    write_spool(rows, path, "event_type", "ts", "m", "event_id", dt.timedelta(days=1), 40, hot_rows=60)
    read = read_spool(spark, path, CONTAINERS)
    assert read.filter(read.value.rlike(r"[^ -~]")).count() == 0
    back = read.select(unescape("value").alias("m"))
    assert back.exceptAll(rows.select("m")).isEmpty() and back.count() == rows.count()
    files = list_spool(spark, path, CONTAINERS)
    counts = {r.file_name: r["count"] for r in read.groupBy("file_name").count().collect()}
    assert {r.file_name: r.logs for r in files.collect()} == counts
    assert max(counts.values()) == 40
    # No folder and no file per chunk.
    assert len(os.listdir(f"{path}/data")) <= spark.sparkContext.defaultParallelism < len(counts)


def test_lines_of_a_written_file_are_in_order(spark, tmp_path):
    path = str(tmp_path / "spool")
    rows = spark.range(500).select(
        F.lit("s").alias("k"), F.timestamp_micros(500 - F.col("id")).alias("ts"),
        F.format_string("%04d", 500 - F.col("id")).alias("m"),
    )
    write_spool(rows, path, "k", "ts", "m", max_logs=100)
    found = manifest(spark, path).collect()
    assert len(found) == 5
    for r in found:
        lines = ContainerReader(path, r.container).find(r.file_name).decode().split()
        assert lines == sorted(lines) and len(lines) == 100 == r.lines


def test_two_writes_into_one_folder(spark, tmp_path):
    """Senders of the same microsecond, written twice: no name is given again."""
    path = str(tmp_path / "spool")
    rows = spark.range(60).select(
        F.concat(F.lit("s"), F.col("id") % 20).alias("k"), F.timestamp_micros(F.lit(5)).alias("ts"), F.col("id").cast("string").alias("m")
    )
    for mode in ("append", "append"):
        write_spool(rows, path, "k", "ts", "m", mode=mode)
    names = [r.file_name for r in list_spool(spark, path, CONTAINERS).collect()]
    assert len(names) == len(set(names)) == 40
    assert read_spool(spark, path, CONTAINERS).count() == 120
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        write_spool(rows, path, "k", "ts", "m")


def test_tables_are_replaced_by_a_repeated_batch(spark, tmp_path):
    root = str(tmp_path)
    lines = spark.createDataFrame([(message(n),) for n in range(30)] + [("bad",)], "value string")
    for number in (0, 1, 1):
        plan.intake(lines, root, ref_time=REF, ingest_time=now(), batch_id=number)
    assert read_table(spark, root, "syslog").count() == 60
    assert read_table(spark, root, "errors").count() == 2
    days = {d for d in os.listdir(f"{root}/syslog/batch_id=1") if d.startswith("date_day=")}
    assert len(days) == 28


def test_empty_tables_can_be_read(spark, tmp_path):
    lines = spark.createDataFrame([(message(1),)], "value string")
    root = str(tmp_path)
    for batch in (None, 1):
        plan.intake(lines, root, ref_time=REF, batch_id=batch)
        assert read_table(spark, root, "errors").columns == ["date", "data"]
        assert read_table(spark, root, "errors").count() == 0
    with pytest.raises(ValueError):
        write_tables(plan.parse_lines(lines), parquet_writer(root), keep="memory")


@pytest.mark.parametrize("keep", ["table", "cache", "none"])
def test_a_table_may_share_the_quarantine(spark, tmp_path, keep):
    lines = spark.createDataFrame([(message(1),), (message(2),), ("bad",)], "value string")
    picked = Processor("one", F.col("pid") == 1, lambda d: d.select("date", "pid"), table="errors")
    parsed = plan.parse_lines(lines, ref_time=REF)
    write_tables(parsed, parquet_writer(str(tmp_path)), [picked], now(), keep=keep)
    got = {(r.data, r.pid) for r in read_table(spark, str(tmp_path), "errors").collect()}
    assert got == {("bad", None), (None, 1)}
    assert [r.pid for r in read_table(spark, str(tmp_path), "syslog").collect()] == [2]


def test_another_chain_leaves_no_stale_rows(spark, tmp_path):
    lines = spark.createDataFrame([(message(1),), (message(2),)], "value string")
    root, mine = str(tmp_path), Processor("mine", F.col("pid") == 1)
    for chain, want in (([mine], (1, 1)), (None, (0, 2)), ([mine], (1, 1))):
        for batch in (1, 1):
            plan.intake(lines, root, chain, ref_time=REF, batch_id=batch)
        assert tuple(read_table(spark, root, t).count() for t in ("mine", "syslog")) == want
    # Another batch keeps its own.
    plan.intake(lines, root, [mine], ref_time=REF, batch_id=2)
    plan.intake(lines, root, None, ref_time=REF, batch_id=1)
    assert tuple(read_table(spark, root, t).count() for t in ("mine", "syslog")) == (1, 3)


def test_batch_intake_to_another_writer(spark, tmp_path):
    taken = {}

    def writer(root, batch):
        def write(df, table):
            taken[root, batch, table] = df.count()

        return write

    lines = spark.createDataFrame([(message(1),), ("bad",)], "value string")
    plan.intake(lines, "db", ref_time=REF, batch_id=7, writer=writer)
    assert taken == {("db", 7, "errors"): 1, ("db", 7, "syslog"): 1}


def test_database_writer_needs_a_driver(spark):
    rows = spark.createDataFrame([(1,)], "pid int")
    with pytest.raises(Exception, match="(?i)driver"):
        jdbc_writer("jdbc:nothing:x", batchsize="10000")(rows, "syslog")


def test_dispatch_takes_each_file_once(spark, tmp_path):
    spool, root = tmp_path / "spool", str(tmp_path / "tables")
    spool.mkdir()
    for n in range(3):
        spool_file(spool, 10 * n + 10, [message(10 * n + i) for i in range(10)])
    run = lambda **kw: dispatch(spark, str(spool), root, min_logs=25, ref_time=REF, **kw)
    table = lambda: sorted(r.pid for r in read_table(spark, root, "syslog").collect())
    assert run() == 0 and table() == list(range(30))
    assert run() is None
    # A file that sorts before the ones taken is not forgotten.
    spool_file(spool, 5, [message(100), "bad"])
    assert run() == 1 and table() == [*range(30), 100]
    assert run() is None and read_table(spark, root, "errors").count() == 1


def test_dispatch_forgets_what_is_long_taken(spark, tmp_path):
    """The state holds the latest files only, whatever was before; a file that comes late is
    taken, though its name is the smallest."""
    spool, root = tmp_path / "spool", str(tmp_path / "tables")
    spool.mkdir()
    now_s = 1_700_000_000
    for n in range(6):
        name = spool_file(spool, 100 + n, [message(n)])
        os.utime(spool / name, (now_s + 1000 * n,) * 2)
        number = dispatch(spark, str(spool), root, min_logs=1, ref_time=REF, slack=dt.timedelta(seconds=1500))
        assert number == n
        state = spark.read.parquet(f"{root}/_mark")
        assert state.filter("file_name IS NOT NULL").count() <= 2
        assert os.listdir(f"{root}/_mark") == [f"batch_id={n}"] and not [d for d in os.listdir(f"{root}/_files") if d.startswith("batch")]
    late = spool_file(spool, 1, [message(50)])
    os.utime(spool / late, (now_s + 4800,) * 2)
    run = lambda: dispatch(spark, str(spool), root, min_logs=1, ref_time=REF, slack=dt.timedelta(seconds=1500))
    assert run() == 6 and run() is None
    assert sorted(r.pid for r in read_table(spark, root, "syslog").collect()) == [*range(6), 50]


def test_dispatch_waits_for_lines(spark, tmp_path):
    spool, root = tmp_path / "spool", str(tmp_path / "tables")
    spool.mkdir()
    spool_file(spool, 1, [message(1)])
    run = lambda s: dispatch(
        spark, str(spool), root, min_logs=25, waited=dt.timedelta(seconds=s), ref_time=REF
    )
    assert run(3) is None
    assert run(10) == 0
    assert run(20) is None
    # Few lines wait again; with more of them no time has to pass.
    spool_file(spool, 2, [message(n) for n in range(24)])
    assert run(3) is None
    spool_file(spool, 3, [message(1)])
    assert run(3) == 1


def test_broken_dispatch_is_taken_up(spark, tmp_path, monkeypatch):
    from logintake.streaming import intake as streaming

    spool, root = tmp_path / "spool", str(tmp_path / "tables")
    spool.mkdir()
    spool_file(spool, 5, [message(1), "bad"])
    whole = streaming.write_tables

    def breaks(*args, **options):
        whole(*args, **options)
        raise RuntimeError("lost")

    monkeypatch.setattr(streaming, "write_tables", breaks)
    with pytest.raises(Exception, match="lost"):
        dispatch(spark, str(spool), root, min_logs=1, ref_time=REF)
    monkeypatch.setattr(streaming, "write_tables", whole)
    spool_file(spool, 1, [message(2)])
    assert dispatch(spark, str(spool), root, min_logs=1, ref_time=REF) == 1
    assert read_table(spark, root, "syslog").count() == 2
    assert read_table(spark, root, "errors").count() == 1
    assert dispatch(spark, str(spool), root, min_logs=1, ref_time=REF) is None


def start_ingest(spark, tmp_path, **options):
    lines = stream_spool(spark, str(tmp_path / "spool"), max_files=2)
    query = ingest_stream(
        lines, str(tmp_path / "tables"), str(tmp_path / "check"), max_wait=None,
        ref_time=REF, ingest_time=now(), **options,
    )
    query.awaitTermination()
    return query


def test_stream_equals_batch_and_goes_on(spark, tmp_path):
    spool, root = tmp_path / "spool", str(tmp_path / "tables")
    spool.mkdir()
    rows = mixed_lines(spark, "/root/testdata/sf0.001").orderBy("event_id").collect()
    for n in range(0, 500, 100):
        spool_file(spool, n, [r.line for r in rows[n:n + 100]])
    chain = Processors(Processor("click", F.col("process") == "click")).with_catch_all()
    query = start_ingest(spark, tmp_path, chain=chain)
    # Three batches, each with its numbers.
    seen = [p.observedMetrics["intake"] for p in query.recentProgress if p.numInputRows]
    assert [m.lines for m in seen] == [200, 200, 100]
    assert sum(m.errors for m in seen) == sum(r.event_id % 6 == 5 for r in rows[:500])
    for n in range(500, 1000, 100):
        spool_file(spool, n, [r.line for r in rows[n:n + 100]])
    start_ingest(spark, tmp_path, chain=chain)
    start_ingest(spark, tmp_path, chain=chain)

    batch = str(tmp_path / "batch")
    plan.intake(read_spool(spark, str(spool)), batch, chain, REF, now())
    for table in ("errors", "click", "syslog"):
        ours, theirs = read_table(spark, root, table), read_table(spark, batch, table)
        theirs = theirs.select(*ours.columns)
        assert ours.count() == theirs.count() > 0
        assert ours.exceptAll(theirs).isEmpty()


def test_repeated_micro_batch_leaves_no_copy(spark, tmp_path):
    """The last micro-batch runs again when its commit is lost."""
    spool, root = tmp_path / "spool", str(tmp_path / "tables")
    spool.mkdir()
    for n in range(4):
        spool_file(spool, n, [message(10 * n + i) for i in range(10)] + ["bad"])
    start_ingest(spark, tmp_path)
    commits = tmp_path / "check" / "commits"
    os.remove(commits / "1")
    if (commits / ".1.crc").exists():
        os.remove(commits / ".1.crc")
    start_ingest(spark, tmp_path)
    assert sorted(r.pid for r in read_table(spark, root, "syslog").collect()) == list(range(40))
    assert read_table(spark, root, "errors").count() == 4


def test_times_of_a_micro_batch(spark, tmp_path):
    """Without a time given, errors of one micro-batch have one, and the year is now."""
    (tmp_path / "spool").mkdir()
    spool_file(tmp_path / "spool", 1, ["bad", "<13>Jan 15 00:00:00 h app: x", "worse"])
    root, before = str(tmp_path / "tables"), dt.datetime.now()
    lines = stream_spool(spark, str(tmp_path / "spool"))
    ingest_stream(lines, root, str(tmp_path / "check"), max_wait=None).awaitTermination()
    times = {r.date for r in read_table(spark, root, "errors").collect()}
    assert len(times) == 1
    assert before - dt.timedelta(days=1) < times.pop() < before + dt.timedelta(days=1)
    assert abs(read_table(spark, root, "syslog").first().date.year - before.year) <= 1


def test_trigger():
    assert trigger(None) == {"availableNow": True}
    assert trigger(dt.timedelta(seconds=10)) == {"processingTime": "10000 milliseconds"}


def test_closed_sessions_leave_the_state(spark, tmp_path):
    """Five senders a day, each day others: the state stays level, late messages are counted."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "k long, ts timestamp, n long"
    for day in range(4):
        start = dt.datetime(2024, 1, 1 + day)
        rows = [(10 * day + i, start, i) for i in range(5)]
        if day == 3:
            rows.append((0, start - dt.timedelta(days=2), 9))
        spark.createDataFrame(rows, schema).write.mode("append").parquet(source)
        chunk_stream(
            spark.readStream.schema(schema).parquet(source), out, str(tmp_path / "check"), "k", "ts", "n",
            max_wait=None,
        ).awaitTermination()
    read = lambda name: spark.read.parquet(f"{out}/{name}").groupBy("batch_id")
    assert [r["count"] for r in read("open").count().orderBy("batch_id").collect()] == [5, 5, 5, 5]
    late = read("clock").agg(F.sum("late").alias("late")).orderBy("batch_id")
    assert [r.late for r in late.collect()] == [0, 0, 0, 1]
    assert spark.read.parquet(f"{out}/chunks").count() == 21


@pytest.mark.parametrize("hot_rows", [None, 20])
def test_chunk_stream(spark, tmp_path, events, hot_rows):
    from test_ordered import chunks_by_hand

    rows = events.select("event_id", "ts", "user_id")
    for start, end in ((1, 10), (10, 11), (11, 32)):
        part = rows.filter(F.dayofmonth("ts").between(start, end - 1))
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1)
    idle = dt.timedelta(hours=20)
    chunk_stream(
        stream.parquet(str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "check"),
        "user_id", "ts", "event_id", idle, 3, max_wait=None, hot_rows=hot_rows,
    ).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out" / "chunks"))
    assert got.select("batch_id").distinct().count() == 3
    assert {
        r.event_id: (r.session_start, r.part, r.line_no) for r in got.collect()
    } == chunks_by_hand(rows.collect(), idle, 3)


def test_run_as_a_job(spark, tmp_path):
    from logintake.plans.run import main

    (tmp_path / "spool").mkdir()
    spool_file(tmp_path / "spool", 1, [message(n) for n in range(5)])
    places = ["--spool", str(tmp_path / "spool"), "--tables"]
    assert main(["batch", *places, str(tmp_path / "a"), "--max-wait", "0"]) == 0
    assert main(["batch", *places, str(tmp_path / "a"), "--max-wait", "0"]) is None
    main(["once", *places, str(tmp_path / "b"), "--checkpoint", str(tmp_path / "c")])
    for root in ("a", "b"):
        assert read_table(spark, str(tmp_path / root), "syslog").count() == 5
    with pytest.raises(SystemExit):
        main(["stream", *places, str(tmp_path / "b")])
