"""Batch intake: spool folder to tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logintake.functions.codec import unescape
from logintake.operators.parse import parse_syslog
from logintake.operators.route import Processor, Processors
from logintake.plans.tables import Writer, parquet_writer, write_tables


def parse_lines(
    lines: DataFrame, col: str = "value", ref_time: Column | dt.datetime | str | None = None,
    **options,
) -> DataFrame:
    """Undo the escapes of stored lines and parse them."""
    return parse_syslog(
        lines.withColumn(col, unescape(F.col(col))), col, ref_time=ref_time, **options
    )


def intake(
    lines: DataFrame,
    root: str,
    chain: Processors | list[Processor] | None = None,
    ref_time: Column | dt.datetime | str | None = None,
    ingest_time: Column | None = None,
    batch_id: str | int | None = None,
    col: str = "value",
    keep: str = "table",
    writer: Callable[[str, str | int | None], Writer] = parquet_writer,
    **options,
) -> None:
    """Stored lines to tables: Parquet under ``root``, or what ``writer`` makes of the root
    and the number of the batch, as ``lambda root, batch: jdbc_writer(url)``."""
    parsed = parse_lines(lines.select(col), col, ref_time, **options)
    write_tables(parsed, writer(root, batch_id), chain, ingest_time, keep)
