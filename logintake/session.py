"""Session settings, and the folder shared by all executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Stamps without a zone are UTC; AQE sizes and splits the shuffles.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(app: str = "logintake", master: str | None = None, **settings) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """A new folder under the one the cluster names in spark.checkpoint.dir.

    Only a local session without that setting gets a temporary folder.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="logintake-"))
        root = context.getCheckpointDir()
    return f"{root.rstrip('/')}/logintake-{uuid.uuid4().hex}"


def written(df: DataFrame, partition_by: str | None = None) -> DataFrame:
    """The rows as a written table: computed once, safe from lost executors."""
    spark = df.sparkSession
    path = shared_folder(spark)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
