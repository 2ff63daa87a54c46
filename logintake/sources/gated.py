"""A spool as a stream whose next batch begins when enough lines wait, or long enough.

The streaming reader looks at the names of the files, which tell their lines. Its latest
offset moves only when the waiting files declare ``minLogs`` lines or when one of them has
waited for ``maxWait``. The offset is the number of the last planned batch. What a batch
consists of is written to a log before the offset moves, so a batch that is repeated, also
by another process, has the same files. The log of a batch also tells what has been taken,
by a mark: all files changed before it have been taken, and of later ones the names are
listed. So nothing grows with the batches that were, and a file that comes late is taken
whatever its name.
"""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from logintake.sources.containers import MANIFEST, NAME, ContainerReader
from logintake.sources.files import entries, filesystem
from logintake.sources.spool import CONTAINERS, FILES, bare

FORMAT = "gated_spool"
# Seconds by which a file may appear later than its time of change tells, logs kept of
# batches that are done, and declared lines of a task.
SLACK = 600
KEPT_LOGS = 100
TASK_LOGS = 100_000
LOG = "batch-"


def declared(name: str) -> int | None:
    """Lines that a spool file's name tells; None if it is no such name."""
    parts = name.split(".")
    if len(parts) != 3 or parts[2] != "log":
        return None
    try:
        int(parts[0], 16)
        return int(parts[1], 16)
    except ValueError:
        return None


class Spool:
    """What lies in the folder. A file of the manifest of containers counts as one file."""

    def __init__(self, path: str, layout: str) -> None:
        self.path, self.layout = path, layout
        self.folder = f"{path}/{MANIFEST}" if layout == CONTAINERS else path

    def files(self, since: int) -> Iterator[tuple[str, int]]:
        """Name and time in µs of the files changed at ``since`` or later."""
        for name, folder, _, at in entries(self.folder, ""):
            known = name.endswith(".parquet") if self.layout == CONTAINERS else declared(name) is not None
            if not folder and known and not name.startswith((".", "_")) and (at or 0) >= since:
                yield name, at or 0

    def chunks(self, name: str) -> list[tuple[str, str]]:
        """Name and container of the chunks that a file of the manifest tells."""
        import pyarrow.parquet as pq

        fs, base = filesystem(self.folder)
        rows = pq.read_table(f"{base}/{name}", columns=[NAME, "container"], filesystem=fs).to_pylist()
        return [(r["container"], r[NAME]) for r in rows]

    def logs(self, name: str) -> int:
        if self.layout == CONTAINERS:
            return sum(declared(chunk) or 0 for _, chunk in self.chunks(name))
        return declared(name) or 0

    def lines(self, name: str) -> Iterator[pa.RecordBatch]:
        fs, base = filesystem(self.folder)
        if self.layout != CONTAINERS:
            with fs.open_input_stream(f"{base}/{name}") as source:
                yield self._batch(name, source.read())
            return
        reader, opened = None, None
        for container, chunk in sorted(self.chunks(name)):
            if container != opened:
                if reader is not None:
                    reader.close()
                reader, opened = ContainerReader(self.path, container), container
            yield self._batch(chunk, reader.find(chunk) or b"")
        if reader is not None:
            reader.close()

    @staticmethod
    def _batch(name: str, payload: bytes) -> pa.RecordBatch:
        values = payload.split(b"\n")
        values = values[:-1] if not values[-1] else values
        return pa.RecordBatch.from_arrays(
            [pa.array([name] * len(values), pa.string()), pa.array(values, pa.binary())], [NAME, "value"]
        )


class BatchLog:
    """The planned batches, a small file each, and what has been taken by the last."""

    def __init__(self, path: str) -> None:
        self.fs, self.base = filesystem(path)
        self.fs.create_dir(self.base, recursive=True)

    def _path(self, number: int) -> str:
        return f"{self.base}/{LOG}{number:012d}.json"

    def numbers(self) -> list[int]:
        from pyarrow import fs as kinds

        names = [f.base_name for f in self.fs.get_file_info(kinds.FileSelector(self.base))]
        return sorted(int(n[len(LOG) : -5]) for n in names if n.startswith(LOG) and n.endswith(".json"))

    def read(self, number: int) -> dict:
        with self.fs.open_input_stream(self._path(number)) as source:
            return json.loads(source.read())

    def write(self, number: int, batch: dict) -> None:
        """All at once: a log is whole or not there."""
        draft = f"{self.base}/draft-{uuid.uuid4().hex}"
        with self.fs.open_output_stream(draft) as sink:
            sink.write(json.dumps(batch).encode())
        self.fs.move(draft, self._path(number))

    def forget(self, before: int) -> None:
        for number in self.numbers():
            if number < before:
                self.fs.delete_file(self._path(number))


class GatedReader(DataSourceStreamReader):
    def __init__(self, options: dict) -> None:
        self.spool = Spool(options["path"], options.get("layout", FILES))
        self.log = BatchLog(options["state"])
        self.min_logs = int(options.get("minlogs", 10_000))
        self.max_wait = float(options.get("maxwait", 10))
        self.max_files = int(options.get("maxfiles", 1 << 31))
        self.slack = int(float(options.get("slack", SLACK)) * 1_000_000)
        self.since: float | None = None
        self.sizes: dict[str, int] = {}

    def initialOffset(self) -> dict:
        return {"batch": 0}

    def latestOffset(self, *_) -> dict:
        numbers = self.log.numbers()
        number = numbers[-1] if numbers else 0
        taken = self.log.read(number) if number else {"mark": 0, "recent": {}}
        mark, recent = taken["mark"], taken["recent"]
        waiting = {n: at for n, at in self.spool.files(mark) if n not in recent}
        # A file is looked into once while it waits.
        self.sizes = {n: self.sizes[n] if n in self.sizes else self.spool.logs(n) for n in waiting}
        if not waiting:
            self.since = None
            return {"batch": number}
        now = time.monotonic()
        self.since = now if self.since is None else self.since
        if sum(self.sizes.values()) < self.min_logs and now - self.since < self.max_wait:
            return {"batch": number}
        some = sorted(waiting)[: self.max_files]
        left = [at for n, at in waiting.items() if n not in set(some)]
        both = {**recent, **{n: waiting[n] for n in some}}
        mark = min([max(mark, max(both.values()) - self.slack), *left])
        self.log.write(number + 1, {
            "files": [[n, self.sizes[n]] for n in some], "mark": mark,
            "recent": {n: at for n, at in both.items() if at >= mark},
        })
        self.since = None
        return {"batch": number + 1}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        out: list[list[str]] = []
        for number in range(start["batch"] + 1, end["batch"] + 1):
            held, size = [], 0
            for name, logs in self.log.read(number)["files"]:
                held.append(name)
                size += logs
                if size >= TASK_LOGS:
                    out.append(held)
                    held, size = [], 0
            if held:
                out.append(held)
        return [InputPartition(names) for names in out]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        for name in partition.value:
            yield from self.spool.lines(name)

    def commit(self, end: dict) -> None:
        self.log.forget(end["batch"] - KEPT_LOGS)


class GatedSpool(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return f"{NAME} string, value binary"

    def streamReader(self, schema) -> GatedReader:
        return GatedReader(self.options)


def stream_gated(
    spark: SparkSession,
    path: str,
    state: str,
    min_logs: int = 10_000,
    max_wait: dt.timedelta = dt.timedelta(seconds=10),
    layout: str = FILES,
    max_files: int | None = None,
    slack: dt.timedelta = dt.timedelta(seconds=SLACK),
) -> DataFrame:
    """The lines of a spool as a stream, ``file_name`` and ``value``, batch by batch.

    A batch begins when the waiting files declare ``min_logs`` lines or when one has
    waited for ``max_wait``; it takes all that wait, or the first ``max_files`` by name.
    ``state`` is a folder of the stream, as its checkpoint is, that keeps the log of batches.
    The names of waiting files pass through the driver, as a file stream's do. A file that
    appears more than ``slack`` after it was last changed may be missed.
    """
    if layout not in (FILES, CONTAINERS):
        raise ValueError(f"layout must be {FILES} or {CONTAINERS}, not {layout!r}")
    spark.dataSource.register(GatedSpool)
    reader = spark.readStream.format(FORMAT).options(
        path=path, state=state, minLogs=str(min_logs), maxWait=str(max_wait.total_seconds()),
        layout=layout, slack=str(slack.total_seconds()),
    )
    if max_files:
        reader = reader.option("maxFiles", str(max_files))
    return reader.load().select(NAME, bare(F.col("value").cast("string")).alias("value"))
