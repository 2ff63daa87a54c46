"""Tables as files of an embedded database (SQLite), written in two phases.

Each task of a write stages database files of bounded size in a folder of its own; none is
part of the table yet. When all tasks are done, the commit publishes them: the folders of a
batch are told by one small list, made visible by one rename. So a reader sees a batch
whole or not at all, a task that failed or ran twice leaves nothing but staged files
(``vacuum``), and a batch that is repeated replaces its list and so its rows.

The files are ordinary databases with one table each: any SQLite program opens them. Whole
numbers and truth values are INTEGER, fractions REAL, strings TEXT, bytes BLOB, dates and
times TEXT (UTC, ``YYYY-MM-DD HH:MM:SS.ffffff``). A string that is no UTF-8 is kept as a
BLOB of its bytes and read back as it was; NaN becomes null, as in the database. Columns
that a batch does not have are null in its rows.
"""

from __future__ import annotations

import json
import sqlite3
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.pandas.types import to_arrow_schema

from logintake.plans.tables import DAY, Writer, by_day
from logintake.sources.files import filesystem

FORMAT = "database_files"
LISTS, STAGED, COLUMNS = "_batches", "data", "_columns.json"
# Bytes of rows, about, after which a task begins another file; rows handed on at a time.
FILE_BYTES = 64 << 20
ROWS = 10_000
KINDS = {
    T.ByteType: "INTEGER", T.ShortType: "INTEGER", T.IntegerType: "INTEGER", T.LongType: "INTEGER",
    T.BooleanType: "INTEGER", T.FloatType: "REAL", T.DoubleType: "REAL", T.StringType: "TEXT",
    T.BinaryType: "BLOB", T.DateType: "TEXT", T.TimestampType: "TEXT", T.TimestampNTZType: "TEXT",
}


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _publish(path: str, value) -> None:
    """A small file, all at once: whole or not there."""
    fs, target = filesystem(path)
    folder = target.rsplit("/", 1)[0]
    fs.create_dir(folder, recursive=True)
    draft = f"{folder}/draft-{uuid.uuid4().hex}"
    with fs.open_output_stream(draft) as sink:
        sink.write(json.dumps(value).encode())
    fs.move(draft, target)


def _told(path: str):
    fs, target = filesystem(path)
    with fs.open_input_stream(target) as source:
        return json.loads(source.read())


def _names(path: str) -> list[str]:
    from pyarrow import fs as kinds

    fs, base = filesystem(path)
    return sorted(f.base_name for f in fs.get_file_info(kinds.FileSelector(base, allow_not_found=True)))


def batches(path: str) -> dict[str, list]:
    """The list of each batch of a table: folder, files and rows of its tasks."""
    names = [n for n in _names(f"{path}/{LISTS}") if n.endswith(".json")]
    return {name[:-5]: _told(f"{path}/{LISTS}/{name}") for name in names}


def _stored(column: pa.Array) -> list:
    """Values as the database keeps them."""
    kind = column.type
    if pa.types.is_timestamp(kind):
        column = column.cast(pa.timestamp("us", kind.tz)).cast(pa.int64()).cast(pa.timestamp("us"))
        return column.cast(pa.string()).to_pylist()
    if pa.types.is_date(kind):
        return column.cast(pa.string()).to_pylist()
    if pa.types.is_string(kind) or pa.types.is_large_string(kind):
        return [v if v is None else _text(v) for v in column.cast(pa.binary()).to_pylist()]
    return column.to_pylist()


def _text(value: bytes) -> str | bytes:
    try:
        return value.decode()
    except UnicodeDecodeError:
        return value


def _loaded(values: tuple, kind: pa.DataType) -> pa.Array:
    """A column of Spark's from what the database gives; text comes as bytes."""
    if pa.types.is_string(kind):
        # No check of the bytes: a string may be no UTF-8.
        return pc.cast(pa.array(values, pa.binary()), options=pc.CastOptions(kind, allow_invalid_utf8=True))
    if pa.types.is_timestamp(kind):
        times = pa.array(values, pa.binary()).cast(pa.string()).cast(pa.timestamp("us"))
        return times.cast(pa.int64()).cast(kind)
    if pa.types.is_date(kind):
        return pa.array(values, pa.binary()).cast(pa.string()).cast(kind)
    if pa.types.is_boolean(kind):
        return pa.array([None if v is None else bool(v) for v in values], kind)
    return pa.array(values, kind)


@dataclass
class Staged(WriterCommitMessage):
    folder: str
    files: int
    rows: int


class DatabaseWriter(DataSourceArrowWriter):
    def __init__(self, schema: T.StructType, options: dict) -> None:
        self.path, self.table = options["path"], options["table"]
        self.batch = options.get("batch") or f"only-{uuid.uuid4().hex}"
        self.file_bytes = int(options.get("filebytes", FILE_BYTES))
        for field in schema.fields:
            if type(field.dataType) not in KINDS:
                raise ValueError(f"column {field.name} of type {field.dataType.simpleString()} has no place in a database file")
        self.columns = self._columns(schema).json()
        columns = ", ".join(f"{_quoted(f.name)} {KINDS[type(f.dataType)]}" for f in schema.fields)
        self.create = f"CREATE TABLE {_quoted(self.table)} ({columns})"
        self.insert = f"INSERT INTO {_quoted(self.table)} VALUES ({', '.join('?' * len(schema.fields))})"

    def _columns(self, schema: T.StructType) -> T.StructType:
        """The columns of the table, those of earlier batches first; all may be null."""
        known = {}
        if COLUMNS in _names(self.path):
            known = {f.name.lower(): f for f in T.StructType.fromJson(json.loads(_told(f"{self.path}/{COLUMNS}")))}
        for field in schema.fields:
            old = known.setdefault(field.name.lower(), T.StructField(field.name, field.dataType))
            if old.dataType != field.dataType:
                raise ValueError(f"column {field.name} has been {old.dataType.simpleString()} so far")
        return T.StructType(list(known.values()))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        """Stage the rows of a task; only this folder knows of them."""
        folder, files, rows = uuid.uuid4().hex, 0, 0
        fs, base = filesystem(f"{self.path}/{STAGED}/{folder}")
        held, size = None, 0
        for batch in iterator:
            # Pieces of a batch with long texts, so that a file stays near its bound.
            step = max(1, batch.num_rows * self.file_bytes // max(1, batch.nbytes))
            for at in range(0, batch.num_rows, step):
                some = batch.slice(at, step)
                if held is None:
                    held, size = sqlite3.connect(":memory:"), 0
                    held.execute(self.create)
                held.executemany(self.insert, zip(*map(_stored, some.columns)))
                rows += some.num_rows
                size += max(1, some.nbytes)
                if size >= self.file_bytes:
                    files = self._stage(fs, base, files, held)
                    held = None
        if held is not None:
            files = self._stage(fs, base, files, held)
        return Staged(folder, files, rows)

    @staticmethod
    def _stage(fs, base: str, files: int, held: sqlite3.Connection) -> int:
        held.commit()
        fs.create_dir(base, recursive=True)
        with fs.open_output_stream(f"{base}/{files:05d}.db") as sink:
            sink.write(held.serialize())
        held.close()
        return files + 1

    def commit(self, messages: list[Staged | None]) -> None:
        """Publish what all tasks staged, in place of an earlier attempt of the batch."""
        _publish(f"{self.path}/{COLUMNS}", self.columns)
        found = [[m.folder, m.files, m.rows] for m in messages if m is not None and m.files]
        _publish(f"{self.path}/{LISTS}/{self.batch}.json", found)

    def abort(self, messages: list[Staged | None]) -> None:
        """Remove what the tasks that were done had staged."""
        fs, base = filesystem(f"{self.path}/{STAGED}")
        for message in messages:
            if message is not None and message.files:
                fs.delete_dir(f"{base}/{message.folder}")


class DatabaseReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict) -> None:
        self.path, self.table = options["path"], options["table"]
        self.names, self.arrow = schema.names, to_arrow_schema(schema)

    def partitions(self) -> list[InputPartition]:
        """A task for each file."""
        return [
            InputPartition(f"{folder}/{i:05d}.db")
            for told in batches(self.path).values() for folder, files, _ in told for i in range(files)
        ] or [InputPartition(None)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if partition.value is None:
            return
        fs, base = filesystem(f"{self.path}/{STAGED}")
        with fs.open_input_stream(f"{base}/{partition.value}") as source:
            content = source.read()
        held = sqlite3.connect(":memory:")
        held.deserialize(content)
        held.text_factory = bytes
        # Asked for first: a quoted name that is no column is a text to the database.
        there = {r[1].decode().lower() for r in held.execute(f"PRAGMA table_info({_quoted(self.table)})")}
        columns = ", ".join(_quoted(n) if n.lower() in there else "NULL" for n in self.names)
        rows = held.execute(f"SELECT {columns} FROM {_quoted(self.table)} ORDER BY rowid")
        while some := rows.fetchmany(ROWS):
            arrays = [_loaded(values, field.type) for values, field in zip(zip(*some), self.arrow)]
            yield pa.RecordBatch.from_arrays(arrays, schema=self.arrow)
        held.close()


class DatabaseFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(_told(f"{self.options['path']}/{COLUMNS}")))

    def reader(self, schema: T.StructType) -> DatabaseReader:
        return DatabaseReader(schema, self.options)

    def writer(self, schema: T.StructType, overwrite: bool) -> DatabaseWriter:
        return DatabaseWriter(schema, self.options)


class DatabaseTables:
    """A ``Writer`` of tables as database files under ``root``.

    Without a batch id rows are added. With one, the batch replaces its earlier attempt,
    in tables that this attempt does not have too. Tables become visible one by one.
    """

    def __init__(self, root: str, batch_id: str | int | None = None, file_bytes: int = FILE_BYTES) -> None:
        self.root, self.batch_id, self.file_bytes = root, batch_id, file_bytes

    def begin(self, spark: SparkSession, tables: list[str]) -> None:
        """Empty the batch's part of all tables that this attempt does not write."""
        if self.batch_id is None:
            return
        for table in set(_names(self.root)) - set(tables):
            if f"{self.batch_id}.json" in _names(f"{self.root}/{table}/{LISTS}"):
                _publish(f"{self.root}/{table}/{LISTS}/{self.batch_id}.json", [])

    def __call__(self, df: DataFrame, table: str) -> None:
        df.sparkSession.dataSource.register(DatabaseFiles)
        if "date" in df.columns:
            df = by_day(df).drop(DAY)
        options = {"path": f"{self.root}/{table}", "table": table, "fileBytes": str(self.file_bytes)}
        if self.batch_id is not None:
            options["batch"] = str(self.batch_id)
        df.write.format(FORMAT).options(**options).mode("append").save()


def database_writer(root: str, batch_id: str | int | None = None) -> Writer:
    return DatabaseTables(root, batch_id)


def read_database(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The rows of all batches of a table."""
    spark.dataSource.register(DatabaseFiles)
    return spark.read.format(FORMAT).options(path=f"{root}/{table}", table=table).load()


def vacuum_database(root: str, table: str) -> int:
    """Remove staged folders that no list names, and tell how many: those of failed tasks
    and of replaced attempts. No writer or reader may be at work."""
    path = f"{root}/{table}"
    live = {folder for told in batches(path).values() for folder, _, _ in told}
    gone = [name for name in _names(f"{path}/{STAGED}") if name not in live]
    fs, base = filesystem(f"{path}/{STAGED}")
    for name in gone:
        fs.delete_dir(f"{base}/{name}")
    return len(gone)
