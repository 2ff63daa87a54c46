"""Rows of given tables, dealt out over the cores."""

import re

from pyspark.sql import functions as F

from workload.render import in_shapes, spread


def test_one_row_group_in_many_parts_is_spread(spark, tmp_path):
    """A file of many parts whose rows all lie in one."""
    path = str(tmp_path / "t")
    spark.range(200_000).coalesce(1).write.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        df = spark.read.parquet(path)
        assert df.rdd.getNumPartitions() >= cores
        held = [r["count"] for r in spread(df).groupBy(F.spark_partition_id()).count().collect()]
        assert sum(held) == 200_000 and max(held) * cores <= 2 * 200_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_many_shapes_are_rendered_by_compiled_methods(spark):
    """Methods of more than 8000 bytes are never compiled."""
    shapes = {f"s{n}": f"concat('<', id, '>', text, ' {n} ', text, ' ', id, ' app[', id, ']: ', text)" for n in range(60)}
    df = in_shapes(spark.range(50).selectExpr("id", "concat('x', id) AS text"), shapes, "id")
    assert {(r.id, r.shape, r.line) for r in df.collect()} == {
        (i, f"s{n}", f"<{i}>x{i} {n} x{i} {i} app[{i}]: x{i}") for i in range(50) for n in range(60)
    }
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = spark._jvm.org.apache.spark.sql.execution.debug.__getattr__("package$").__getattr__("MODULE$").codegenString(
            df._jdf.queryExecution().executedPlan()
        )
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) <= 8000
