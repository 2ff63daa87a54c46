"""Compare a Spark result with a DuckDB result, in any order of the rows."""

from __future__ import annotations

import collections
import glob
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _kind(type_name: str) -> str:
    """One name for the same type in both engines."""
    name = type_name.lower()
    return {
        "bigint": "int64", "int": "int32", "integer": "int32", "varchar": "string",
        "timestamp_ntz": "timestamp", "decimal(38,0)": "hugeint",
    }.get(name, name)


def differences(spark_df, con, sql: str) -> list[str]:
    """Empty if both results are the same; else what differs first."""
    relation = con.sql(sql)
    ours = {f.name: _kind(f.dataType.simpleString()) for f in spark_df.schema.fields}
    theirs = {n: _kind(str(t)) for n, t in zip(relation.columns, relation.types)}
    if ours != theirs:
        return [f"schema {ours} against {theirs}"]
    names = sorted(ours)
    left = collections.Counter(
        tuple(row[n] for n in names) for row in spark_df.select(*names).collect()
    )
    columns = ", ".join(f'"{n}"' for n in names)
    right = collections.Counter(con.execute(f"SELECT {columns} FROM ({sql})").fetchall())
    if left == right:
        return []
    return [
        f"{sum(left.values())} rows against {sum(right.values())}",
        f"only Spark: {list((left - right).items())[:3]}",
        f"only DuckDB: {list((right - left).items())[:3]}",
    ]
