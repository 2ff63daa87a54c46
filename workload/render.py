"""Render log lines from the rows of a table (Spark side).

Every renderer works on all rows. Where a query needs several shapes of a line,
each row is rendered in every shape and exploded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores, if a given file leaves them in the hands of a few.

    A file may come in many parts and yet have all its rows in one or two of them, as a
    row group is read whole. So it is rows that count, which the footers tell.
    """
    if df.isStreaming:
        return df
    cores, parts = df.sparkSession.sparkContext.defaultParallelism, df.rdd.getNumPartitions()
    held = df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n"))
    rows, most = held.agg(F.sum("n"), F.max("n")).first()
    if parts >= cores and (most or 0) * cores <= 2 * (rows or 0):
        return df
    return df.repartition(max(cores, parts))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def with_parts(events: DataFrame) -> DataFrame:
    """Events with the pieces a log line is put together from."""
    return events.selectExpr(
        "*",
        "(event_id * 7) % 192 AS pri",
        "concat('host', user_id) AS host",
        "(event_id div 6) % 6 AS k",
        "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\") AS iso",
        "date_format(ts - interval 7 hours, \"yyyy-MM-dd'T'HH:mm:ss\") AS iso7",
        "date_format(ts, 'SSSSSS') AS us",
        "concat(date_format(ts, 'MMM'), ' ', lpad(cast(day(ts) AS string), 2, ' ')) AS mon",
        "date_format(ts, 'HH:mm:ss') AS hms",
        "date_format(ts, 'EEE') AS dow",
        "date_format(ts, 'dd') AS day2",
        "date_format(ts - interval 7 hours, 'EEE') AS dow7",
        "date_format(ts - interval 7 hours, 'dd') AS day7",
        "date_format(ts - interval 7 hours, 'MMM') AS mon7",
        "date_format(ts - interval 7 hours, 'HH:mm:ss') AS hms7",
        "date_format(ts - interval 7 hours, 'yyyy') AS year7",
    )


# One shape of line per event: five well-formed ones, and one in six broken.
MIXED = """
CASE event_id % 6
 WHEN 0 THEN concat('<',pri,'>1 ',iso,'.',us,'Z ',host,' ',event_type,' ',event_id,' ID',event_id%50,' - ',props)
 WHEN 1 THEN concat('<',pri,'>1 ',iso7,'.',us,'-07:00 ',host,' ',event_type,' - - [meta@32473 id="',event_id,'"] ',props)
 WHEN 2 THEN concat('<',pri,'>',iso,'.',substr(us,1,3),'Z ',host,' ',event_type,'[',event_id,']: ',props)
 WHEN 3 THEN concat('<',pri,'>',mon,' ',hms,' UTC 2024 ',host,' ',event_type,': ',props)
 WHEN 4 THEN concat('<',pri,'>',mon,' ',hms,' ',host,' ',event_type,' ',props)
 ELSE CASE k WHEN 0 THEN concat('no priority ',props) WHEN 1 THEN concat('<>',props) WHEN 2 THEN concat('<x>',props)
  WHEN 3 THEN concat('<13>1 - ',host,' app 1 - - ',props) WHEN 4 THEN concat('<13>not-a-date ',host,' app: ',props)
  ELSE concat('<13>',iso,'Z ',host,' app[x]: ',props) END END
"""


def mixed_lines(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    parts = with_parts(table(spark, sf_dir, "events"))
    return parts.select("event_id", *keep, F.expr(MIXED).alias("line"))


# Shapes rendered by one generated method: one of more than 8000 bytes is never compiled.
SHAPES_AT_ONCE = 8


def in_shapes(parts: DataFrame, shapes: dict[str, str], *keep: str) -> DataFrame:
    """Each row once per shape; ``shapes`` maps a name to a SQL expression."""
    made: list[Column] = [
        F.struct(F.lit(name).alias("shape"), F.expr(sql).alias("line"))
        for name, sql in shapes.items()
    ]
    groups = []
    for at in range(0, len(made), SHAPES_AT_ONCE):
        # A generator of one row ends a generated method, as in the parser.
        groups.append(f"_made_{at}")
        some = F.struct(F.array(*made[at : at + SHAPES_AT_ONCE]).alias(groups[-1]))
        parts = parts.select("*", F.inline(F.array(some)))
    return parts.select(*keep, F.explode(F.concat(*groups)).alias("made")).select(*keep, "made.*")
