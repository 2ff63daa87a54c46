"""Tables as database files: staged by tasks, published by the commit."""

import datetime as dt
import os
import sqlite3

import pytest
from pyspark.sql import functions as F

from logintake.operators.route import Processor
from logintake.plans import intake as plan
from logintake.plans.databases import DatabaseTables, batches, database_writer, read_database, vacuum_database
from test_jobs import REF, message, now

UTC = dt.timezone.utc
COLUMNS = "n long, small byte, flag boolean, part double, day date, at timestamp, text string, raw binary, `a \"b\"` int"
ROWS = [
    (1, -3, True, 0.5, dt.date(1969, 12, 31), dt.datetime(2024, 2, 29, 23, 59, 59, 123456, UTC), "é\0x", b"\0\xff", 7),
    (2**63 - 1, 127, False, -1e300, dt.date(9999, 12, 31), dt.datetime(1950, 1, 1, tzinfo=UTC), "", b"", -1),
    (-(2**63), None, None, None, None, None, None, None, None),
    (-(2**63), None, None, None, None, None, None, None, None),
]


def take(spark, root, numbers, batch, chain=None, writer=database_writer):
    lines = spark.createDataFrame([(message(n),) for n in numbers] + [("bad",)], "value string").coalesce(2)
    plan.intake(lines, root, chain, ref_time=REF, ingest_time=now(), batch_id=batch, keep="cache", writer=writer)


def pids(spark, root, table="syslog") -> list[int]:
    return sorted(r.pid for r in read_database(spark, root, table).collect())


def test_values_come_back(spark, tmp_path):
    rows = spark.createDataFrame(ROWS, COLUMNS).repartition(3)
    DatabaseTables(str(tmp_path))(rows, "ta\"ble")
    back = read_database(spark, str(tmp_path), "ta\"ble")
    assert back.schema == rows.schema
    assert sorted(map(repr, back.collect())) == sorted(map(repr, rows.collect()))


def test_bytes_that_are_no_text_and_nan(spark, tmp_path):
    rows = spark.sql("SELECT CAST(X'61FF62' AS STRING) AS text, CAST('NaN' AS DOUBLE) AS part")
    DatabaseTables(str(tmp_path))(rows, "t")
    got = read_database(spark, str(tmp_path), "t").select(F.hex(F.col("text").cast("binary")), "part").first()
    assert tuple(got) == ("61FF62", None)


def test_files_are_databases_of_bounded_size(spark, tmp_path):
    rows = spark.range(5000).select("id", F.repeat(F.lit("x"), 100).alias("text"))
    DatabaseTables(str(tmp_path), file_bytes=50_000)(rows.coalesce(1), "t")
    ((told,),) = batches(f"{tmp_path}/t").values()
    folder, files, count = told
    assert count == 5000 and files > 5
    found = []
    for name in sorted(os.listdir(tmp_path / "t" / "data" / folder)):
        assert os.path.getsize(tmp_path / "t" / "data" / folder / name) < 200_000
        with sqlite3.connect(tmp_path / "t" / "data" / folder / name) as held:
            found += [n for (n,) in held.execute("SELECT id FROM t")]
    assert found == list(range(5000))


def test_batches_replace_themselves(spark, tmp_path):
    root = str(tmp_path)
    take(spark, root, range(30), 0)
    take(spark, root, range(30, 60), 1)
    assert pids(spark, root) == list(range(60))
    take(spark, root, range(100, 110), 1)
    assert pids(spark, root) == [*range(30), *range(100, 110)]
    assert read_database(spark, root, "errors").count() == 2
    # Another chain empties the tables that it has not got.
    take(spark, root, range(5), 2, [Processor("low", F.col("pid") < 3)])
    take(spark, root, range(5), 2)
    assert pids(spark, root, "low") == []
    assert pids(spark, root) == sorted([*range(30), *range(100, 110), *range(5)])
    assert vacuum_database(root, "syslog") > 0 and vacuum_database(root, "syslog") == 0
    assert pids(spark, root) == sorted([*range(30), *range(100, 110), *range(5)])
    # Without a number rows are added.
    take(spark, root, range(3), None)
    take(spark, root, range(3), None)
    assert len(pids(spark, root)) == 51


def test_a_failed_task_publishes_nothing(spark, tmp_path):
    root = str(tmp_path)
    rows = spark.range(100).withColumn("v", F.lit(1))
    DatabaseTables(root, 1)(rows, "t")
    # One task fails after others have staged their files.
    broken = spark.range(0, 1000, 1, 8).withColumn(
        "v", F.when(F.col("id") == 999, F.raise_error(F.lit("lost"))).otherwise(F.lit(2)).cast("int")
    )
    with pytest.raises(Exception, match="lost"):
        DatabaseTables(root, 1)(broken, "t")
    back = read_database(spark, root, "t")
    assert (back.count(), back.agg(F.max("v")).first()[0]) == (100, 1)
    vacuum_database(root, "t")
    DatabaseTables(root, 1)(broken.filter("id < 999"), "t")
    assert read_database(spark, root, "t").count() == 999


def test_columns_of_batches_differ(spark, tmp_path):
    write = DatabaseTables(str(tmp_path))
    write(spark.sql("SELECT 1 AS a, 'x' AS b"), "t")
    write(spark.sql("SELECT 2 AS A, 0.5D AS c"), "t")
    got = read_database(spark, str(tmp_path), "t")
    assert got.columns == ["a", "b", "c"]
    assert sorted(map(tuple, got.collect())) == [(1, "x", None), (2, None, 0.5)]
    with pytest.raises(Exception, match="has been int"):
        write(spark.sql("SELECT 'z' AS a"), "t")


def test_no_rows_and_no_place(spark, tmp_path):
    root = str(tmp_path)
    DatabaseTables(root, 0)(spark.createDataFrame([], "date timestamp, n int"), "t")
    assert read_database(spark, root, "t").collect() == []
    assert read_database(spark, root, "t").columns == ["date", "n"]
    with pytest.raises(Exception, match="no place"):
        DatabaseTables(root, 0)(spark.createDataFrame([([1],)], "n array<int>"), "u")
