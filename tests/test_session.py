from types import SimpleNamespace

import pytest

from logintake.session import shared_folder, written
from workload.render import spread


def session(master, setting=None, checkpoint=None):
    places = [checkpoint]
    context = SimpleNamespace(
        master=master, getCheckpointDir=lambda: places[-1], setCheckpointDir=places.append
    )
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda name, default: setting or default), sparkContext=context
    )


def test_the_cluster_names_the_folder():
    assert shared_folder(session("yarn", "hdfs:/c/")).startswith("hdfs:/c/logintake-")
    assert shared_folder(session("local[2]", "/c")).startswith("/c/logintake-")
    assert shared_folder(session("yarn", None, "hdfs:/d")).startswith("hdfs:/d/logintake-")


def test_only_a_local_session_gets_a_temporary_folder():
    with pytest.raises(ValueError):
        shared_folder(session("yarn"))
    assert "/logintake-" in shared_folder(session("local[2]"))


def test_written_rows_keep_their_schema(spark):
    df = spark.sql("SELECT 1 AS n, timestamp_ntz '2024-01-01 00:00:00' AS t, 'x' AS `a b`, 'r' AS r")
    assert written(df).schema.simpleString() == df.schema.simpleString()
    parts = written(df, partition_by="r")
    assert parts.select(*[f"`{c}`" for c in df.columns]).collect() == df.collect()


def test_few_parts_are_spread_and_many_left_alone(spark):
    cores = spark.sparkContext.defaultParallelism
    assert spread(spark.range(100, numPartitions=1)).rdd.getNumPartitions() == cores
    many = spark.range(100, numPartitions=cores + 1)
    assert spread(many) is many
