"""Containers, listings and the gated stream, on files."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from logintake.sources.containers import (
    ContainerReader, ContainerWriter, manifest, read_containers, rebuild_manifest, stream_containers,
    vacuum, write_containers,
)
from logintake.sources.files import list_files
from logintake.sources.gated import BatchLog, GatedReader, declared, stream_gated
from logintake.sources.spool import CONTAINERS, FOLDERS, list_spool, read_spool

LINES = "file_name string, line_no int, value string"


@pytest.mark.parametrize("block_bytes", [1, 40, 1 << 18])
def test_one_container(tmp_path, block_bytes):
    draw = random.Random(1)
    chunks = {f"{n:03d}\té": bytes(draw.choice(b"ab\n\t") for _ in range(draw.randint(0, 50))) for n in range(60)}
    writer = ContainerWriter(str(tmp_path), block_bytes)
    for name in sorted(chunks):
        writer.add(name, chunks[name])
    writer.close()
    reader = ContainerReader(str(tmp_path), writer.name)
    assert dict(reader.names()) == chunks and reader.chunks == 60
    for name in draw.sample(sorted(chunks), 60):
        assert reader.find(name) == chunks[name]
    assert reader.find("") is None and reader.find("zzz") is None and reader.find("000") is None
    (tmp_path / "data" / "x.spool").write_bytes(b"no container at all, but long enough")
    with pytest.raises(ValueError):
        ContainerReader(str(tmp_path), "x.spool")


def chunk_rows(n: int = 40) -> list[tuple]:
    draw = random.Random(2)
    rows = [(f"{i:016x}.{i % 5:08x}.log", k, draw.choice(["", "a b", "\r", "é", "x" * 300])) for i in range(n) for k in range(i % 5)]
    return rows + [(f"{i:016x}.{0:08x}.log", 0, None) for i in range(0, n, 5)]


def test_write_and_read(spark, tmp_path):
    rows, path = chunk_rows(), str(tmp_path / "spool")
    lines = spark.createDataFrame(rows, LINES).repartition(3, "file_name")
    # Several containers in a task, several blocks in a container.
    write_containers(lines, path, container_bytes=900, block_bytes=200)
    assert len(os.listdir(f"{path}/data")) > 6
    want = sorted((n, v) for n, _, v in rows if v is not None)
    assert sorted((r.file_name, r.value) for r in read_containers(spark, path).collect()) == want
    # One carriage return belongs to the line end.
    bare = sorted((n, v.removesuffix("\r")) for n, v in want)
    assert sorted((r.file_name, r.value) for r in read_spool(spark, path, CONTAINERS).collect()) == bare
    names = {r[0] for r in rows}
    assert {r.file_name for r in list_spool(spark, path, CONTAINERS).collect()} == names
    assert {r.file_name: r.lines for r in manifest(spark, path).collect()} == {n: sum(w[0] == n for w in want) for n in names}
    some = read_containers(spark, path, F.col("file_name") < f"{9:016x}", spark.createDataFrame([(sorted(names)[3],), ("none",)], "file_name string"))
    assert {r.file_name for r in some.collect()} == {sorted(names)[3]}
    assert sorted(map(tuple, rebuild_manifest(spark, path).collect())) == sorted(map(tuple, manifest(spark, path).collect()))


def test_bytes_that_are_no_utf8(spark, tmp_path):
    path = str(tmp_path / "spool")
    lines = spark.range(3).select(F.lit("1.3.log").alias("file_name"), F.col("id").alias("line_no"), F.unhex(F.lit("8861FF")).alias("value"))
    write_containers(lines.coalesce(1), path)
    got = read_containers(spark, path).select(F.hex(F.col("value").cast("binary")).alias("h")).collect()
    assert [r.h for r in got] == ["8861FF"] * 3


def test_lost_attempts_are_not_read_and_go(spark, tmp_path):
    path = str(tmp_path / "spool")
    write_containers(spark.createDataFrame([("1.1.log", 0, "x")], LINES).coalesce(1), path)
    lost = ContainerWriter(path)
    lost.add("2.1.log", b"lost\n")
    lost.close()
    assert read_containers(spark, path).count() == 1 and rebuild_manifest(spark, path).count() == 2
    later = dt.datetime.now() + dt.timedelta(days=1)
    assert vacuum(spark, path, dt.datetime(2020, 1, 1)) == 0 and vacuum(spark, path, later) == 1
    assert read_containers(spark, path).count() == 1 and len(os.listdir(f"{path}/data")) == 1


def test_empty_write_and_null_names(spark, tmp_path):
    path = str(tmp_path / "a")
    write_containers(spark.createDataFrame([], LINES), path)
    assert read_containers(spark, path).count() == 0
    with pytest.raises(Exception, match="without name"):
        write_containers(spark.createDataFrame([(None, 0, "x")], LINES), str(tmp_path / "b"))


def test_stream_follows_the_manifest(spark, tmp_path):
    path, out = str(tmp_path / "spool"), str(tmp_path / "out")
    for n in range(3):
        write_containers(spark.createDataFrame([(f"{n}.1.log", 0, f"line {n}")], LINES).coalesce(1), path, "append")
        stream_containers(spark, path, 1).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(
            availableNow=True).start(out).awaitTermination()
        assert spark.read.parquet(out).count() == n + 1


def test_listing(spark, tmp_path):
    assert list_files(spark, str(tmp_path / "none")).count() == 0
    for n in range(30):
        (tmp_path / f"a{n % 4}" / f"b{n % 3}").mkdir(parents=True, exist_ok=True)
        (tmp_path / f"a{n % 4}" / f"b{n % 3}" / f"f{n}").write_bytes(b"x" * n)
    (tmp_path / "top").write_bytes(b"")
    got = {r.path: r.bytes for r in list_files(spark, str(tmp_path)).collect()}
    assert got == {**{f"a{n % 4}/b{n % 3}/f{n}": n for n in range(30)}, "top": 0}
    assert list_files(spark, str(tmp_path)).filter("modified IS NULL").count() == 0


def test_folders_are_listed_with_their_empty_files(spark, tmp_path):
    path = str(tmp_path)
    spark.createDataFrame([("a", "1.1.log"), ("b", "x.1.log"), ("c", "4%:.2.log")], "value string, spool_file string").write.mode(
        "append").partitionBy("spool_file").text(path)
    spark.createDataFrame([], "value string").coalesce(1).write.text(f"{path}/spool_file=2.3.log")
    got = {r.file_name: (r.logs, r.bytes) for r in list_spool(spark, path, FOLDERS).collect()}
    assert got == {"1.1.log": (1, 2), "2.3.log": (3, 0)}
    assert read_spool(spark, path, FOLDERS, F.col("file_name") == "1.1.log").collect()[0].value == "a"


def test_declared():
    assert declared("00ff.0a.log") == 10 and declared("0.00.log") == 0
    assert {declared(n) for n in (".1.1.log", "1.log", "z.1.log", "1.z.log", "1.1.txt", "")} == {None}


def spool_file(folder, start: int, lines: list[str], at: float | None = None) -> str:
    name = f"{start:016x}.{len(lines):08x}.log"
    (folder / name).write_bytes(b"".join(line.encode() + b"\n" for line in lines))
    if at is not None:
        os.utime(folder / name, (at, at))
    return name


def gate(tmp_path, **options) -> GatedReader:
    return GatedReader({"path": str(tmp_path / "spool"), "state": str(tmp_path / "state"), "minlogs": "5", "maxwait": "1e9", **options})


def names_of(reader, start: int, end: int) -> list[str]:
    return [n for p in reader.partitions({"batch": start}, {"batch": end}) for n in p.value]


def test_the_gate(tmp_path):
    spool = tmp_path / "spool"
    spool.mkdir()
    reader = gate(tmp_path)
    assert reader.initialOffset() == reader.latestOffset() == {"batch": 0}
    first = spool_file(spool, 10, ["a"] * 4)
    (spool / ".b.1.log").write_text("x\n"), (spool / "notes.txt").write_text("x\n")
    assert reader.latestOffset() == {"batch": 0}
    second = spool_file(spool, 20, ["b"])
    assert reader.latestOffset() == {"batch": 1} == reader.latestOffset()
    assert names_of(reader, 0, 1) == [first, second]
    # Another process knows what has been taken; a late file with a small name waits.
    reader = gate(tmp_path)
    late = spool_file(spool, 1, ["c"])
    assert reader.latestOffset() == {"batch": 1}
    assert gate(tmp_path, maxwait="0").latestOffset() == {"batch": 2}
    assert names_of(reader, 1, 2) == [late] and names_of(reader, 0, 2) == [first, second, late] and names_of(reader, 2, 2) == []
    got = [v.as_py() for n in names_of(reader, 0, 1) for b in reader.spool.lines(n) for v in b.column(1)]
    assert got == [b"a"] * 4 + [b"b"]


def test_what_is_long_taken_is_forgotten(tmp_path):
    spool, start = tmp_path / "spool", 1_700_000_000
    spool.mkdir()
    reader = gate(tmp_path, minlogs="1", slack="1500")
    for n in range(8):
        spool_file(spool, 100 + n, ["x"], start + 1000 * n)
        assert reader.latestOffset() == {"batch": n + 1}
        assert len(reader.log.read(n + 1)["recent"]) <= 2
    reader.commit({"batch": 200})
    assert reader.log.numbers() == []


def test_no_more_files_than_asked_for(tmp_path):
    """Those left over are not lost, though they are older than the mark would be."""
    spool, start = tmp_path / "spool", 1_700_000_000
    spool.mkdir()
    names = [spool_file(spool, 100 + n, ["x"] * 3, start - 10_000 * n) for n in range(5)]
    reader = gate(tmp_path, maxfiles="2", slack="1")
    assert [reader.latestOffset()["batch"] for _ in range(3)] == [1, 2, 2]
    assert gate(tmp_path, maxwait="0").latestOffset()["batch"] == 3
    assert names_of(reader, 0, 3) == names


def test_stream_is_exact_over_restarts(spark, tmp_path):
    spool, out = tmp_path / "spool", str(tmp_path / "out")
    spool.mkdir()
    taken = []
    for n in range(4):
        spool_file(spool, 100 - n, [f"{n}-{i}" for i in range(3 + n)])
        query = stream_gated(spark, str(spool), str(tmp_path / "state"), 7, dt.timedelta(days=1)).writeStream.format("parquet").option(
            "checkpointLocation", str(tmp_path / "c")).trigger(processingTime="100 milliseconds").start(out)
        query.processAllAvailable()
        query.stop()
        taken.append(spark.read.schema("value string").parquet(out).count() if os.path.isdir(out) else 0)
    # 3; 3 + 4 = 7 lines; 5 more; 5 + 6 = 11.
    assert taken == [0, 7, 7, 18]
    got = sorted(r.value for r in spark.read.parquet(out).collect())
    assert got == sorted(f"{n}-{i}" for n in range(4) for i in range(3 + n)) and BatchLog(str(tmp_path / "state")).numbers() == [1, 2]
    with pytest.raises(ValueError):
        stream_gated(spark, str(spool), str(tmp_path / "state"), layout=FOLDERS)
