"""WARC archives with a two-level capture index.

Archives: each page is a gzip member of its own, so a record is read by its place alone.
Of pages with equal payloads one is a response, the others are revisits of it.

Index: captures are sorted by their URL key, host reversed, and dealt into parts. A part
is a file of compressed blocks of lines; its end holds the sparse directory, the first
key and the place of each block. The list of parts is the upper level. A look-up finds
parts and then blocks by binary search, reads only those blocks, finds the key in them by
binary search, and reads the records by their ranges.

Files of a task have names of their own, and only those named in the tables that Spark
commits (captures, parts) count; what a lost attempt has written is never read.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logintake.llm.tables import filesystem, new_name, nulls_last
from logintake.session import written

BLOCK_LINES = 512
ARCHIVE_BYTES = 1 << 30
DATE = "2024-01-01T00:00:00Z"
GZIP_LEVEL = 4

# Characters of a key in the list of parts, bytes read at once, and bytes of an archive
# that one task reads.
KEY_CHARS = 256
READ_BYTES = 4 << 20
STRETCH_BYTES = 64 << 20

CAPTURES, PARTS = "captures", "parts"
CAPTURE = "key string, page_id long, file string, offset long, length long"
PART = "part long, first string, last string, file string, at long, length long"
RECORD = (
    "page_id long, url string, record_type string, payload_bytes long, payload_digest string, "
    "refers_to long"
)
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def url_key(url: Column) -> Column:
    """The URL with its host reversed and in lower case, without scheme, user and port:
    ``org,example,www)/path?query``. A null URL has the empty key."""
    rest = F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    authority = F.regexp_extract(rest, r"^[^/?#]*", 0)
    host = F.lower(F.regexp_replace(authority, r"^.*@|:[0-9]*$", ""))
    path = F.substring(rest, F.length(authority) + 1, F.length(rest))
    path = F.when(path == "", "/").otherwise(path)
    reversed_host = F.array_join(F.reverse(F.split(host, "[.]")), ",")
    return F.coalesce(F.concat(reversed_host, F.lit(")"), path), F.lit(""))


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}:{digest}')}>"


def record(row: dict) -> bytes:
    """A response, or a revisit whose block is the header of the response it repeats."""
    digest, revisit = row["digest"], row["payload"] is None
    payload = b"" if revisit else row["payload"]
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {row['payload_bytes']}\r\n\r\n"
    ).encode()
    fields = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": record_id(row["page_id"], digest),
        "WARC-Date": DATE,
        "WARC-Target-URI": None if row["url"] is None else json.dumps(row["url"], ensure_ascii=False)[1:-1],
        "WARC-Payload-Digest": f"sha1:{digest}",
        "Page-ID": row["page_id"],
        "WARC-Profile": REVISIT if revisit else None,
        "WARC-Refers-To": record_id(row["refers_to"], digest) if revisit else None,
        "Refers-To-Page-ID": row["refers_to"] if revisit else None,
        "Content-Type": "application/http;msgtype=response",
        "Content-Length": len(http) + len(payload),
    }
    head = "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + http + payload + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")[1:]
    return dict(line.split(": ", 1) for line in lines)


def parsed(raw: bytes) -> dict:
    """What a record tells of its page. Payloads are checked against their digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = _fields(head)
    http, _, payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    size = int(_fields(http)["Content-Length"])
    if fields["WARC-Type"] == "response":
        own = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if own != digest or size != len(payload):
            raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    number = lambda name: int(fields[name]) if name in fields else None
    url = fields.get("WARC-Target-URI")
    return {
        "page_id": number("Page-ID"),
        "url": None if url is None else json.loads(f'"{url}"'),
        "record_type": fields["WARC-Type"],
        "payload_bytes": size,
        "payload_digest": digest,
        "refers_to": number("Refers-To-Page-ID"),
    }


def write_archives(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    least_bytes: int = 0,
) -> DataFrame:
    """Write all pages to archives in ``folder``, which all executors share, and return
    the captures ``key, page_id, file, offset, length``.

    Of equal payloads of at least ``least_bytes`` bytes the page with the largest id is
    the response and the others revisit it. Payloads are equal if their SHA-1 is, the digest
    that a revisit record names; two made to collide would count as one. A null id is smaller than all others; rows
    that repeat the largest id are all responses. A null payload is empty. No rows give
    no captures.
    """
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        url_key(F.col(url_col).cast("string")).alias("key"),
        F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumns({
        "sha1": F.sha1("payload"), "payload_bytes": F.octet_length("payload").cast("long"),
    })
    # Written, so that the join can split the copies of a frequent payload.
    largest = written(
        rows.groupBy("sha1").agg(F.max("page_id").alias("largest"))
    )
    revisit = (F.col("payload_bytes") >= least_bytes) & ~F.col("page_id").eqNullSafe(F.col("largest"))
    rows = rows.join(largest, "sha1").select(
        "key", "page_id", "url", "sha1", "payload_bytes",
        F.when(~revisit, F.col("payload")).alias("payload"),
        F.when(revisit, F.col("largest")).alias("refers_to"),
    )

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        fs, base = filesystem(folder)
        fs.create_dir(base, recursive=True)
        out, file, at = None, "", 0
        try:
            for batch in batches:
                captures = []
                for row in batch.to_pylist():
                    if out is None or at >= ARCHIVE_BYTES:
                        if out is not None:
                            out.close()
                        file, at = new_name(f"pages-{part:06d}", ".warc.gz"), 0
                        out = fs.open_output_stream(f"{base}/{file}", compression=None)
                    row["digest"] = base64.b32encode(bytes.fromhex(row["sha1"])).decode()
                    member = gzip.compress(record(row), GZIP_LEVEL, mtime=0)
                    out.write(member)
                    captures.append({
                        "key": row["key"], "page_id": row["page_id"], "file": file,
                        "offset": at, "length": len(member),
                    })
                    at += len(member)
                if captures:
                    yield pa.RecordBatch.from_pylist(captures, _schema(CAPTURE))
        finally:
            if out is not None:
                out.close()

    rows.mapInArrow(write, CAPTURE).write.parquet(f"{folder.rstrip('/')}/{CAPTURES}")
    return pages.sparkSession.read.schema(CAPTURE).parquet(f"{folder.rstrip('/')}/{CAPTURES}")


def _schema(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64()}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in ddl.split(", ")])


def write_index(captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Write the index of captures to ``folder`` and return its parts, one row per file:
    ``part, first, last`` (bounds of the keys), ``file``, and the directory's place."""
    order = ["key", *nulls_last("page_id"), "file", "offset"]
    ordered = captures.repartitionByRange(*order).sortWithinPartitions(*order)

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        fs, base = filesystem(folder)
        file = new_name(f"index-{part:06d}", ".gz")
        directory, held, at, last, out = [], [], 0, "", None

        def put(lines: list[list]) -> int:
            block = gzip.compress(
                "".join(json.dumps(line) + "\n" for line in lines).encode(), GZIP_LEVEL, mtime=0
            )
            out.write(block)
            directory.append([lines[0][0], at, len(block)])
            return len(block)

        try:
            for batch in batches:
                if out is None and batch.num_rows:
                    out = fs.open_output_stream(f"{base}/{file}", compression=None)
                held += [list(row.values()) for row in batch.to_pylist()]
                full = len(held) - len(held) % block_lines
                for lo in range(0, full, block_lines):
                    at += put(held[lo : lo + block_lines])
                last = held[-1][0] if held else last
                held = held[full:]
            if held:
                at += put(held)
            if out is not None:
                table = gzip.compress(json.dumps(directory).encode(), GZIP_LEVEL, mtime=0)
                out.write(table)
        finally:
            if out is not None:
                out.close()
        if directory:
            first = directory[0][0]
            yield pa.RecordBatch.from_pylist([{
                # A cut key bounds the part from outside.
                "part": part, "first": first[:KEY_CHARS],
                "last": last if len(last) <= KEY_CHARS else last[:KEY_CHARS] + "\U0010ffff",
                "file": file, "at": at, "length": len(table),
            }], _schema(PART))

    path = f"{folder.rstrip('/')}/{PARTS}"
    ordered.mapInArrow(write, PART).write.parquet(path)
    return captures.sparkSession.read.schema(PART).parquet(path)


class IndexPart:
    """A part of the index; ``source`` is an open file of pyarrow."""

    def __init__(self, source, at: int, length: int) -> None:
        self.source = source
        self.directory = json.loads(gzip.decompress(source.read_at(length, at)))
        self.firsts = [first for first, _, _ in self.directory]
        self.block_no, self.lines, self.keys = -1, [], []

    def block(self, i: int) -> None:
        if i != self.block_no:
            _, at, length = self.directory[i]
            text = gzip.decompress(self.source.read_at(length, at)).decode()
            self.lines = [json.loads(line) for line in text.split("\n")[:-1]]
            self.block_no, self.keys = i, [line[0] for line in self.lines]

    def find(self, key: str) -> Iterator[list]:
        """Captures of a key. They may go on over several blocks."""
        i = max(0, bisect.bisect_left(self.firsts, key) - 1)
        while i < len(self.firsts) and self.firsts[i] <= key:
            self.block(i)
            lo, hi = bisect.bisect_left(self.keys, key), bisect.bisect_right(self.keys, key)
            yield from self.lines[lo:hi]
            i += 1


def find_captures(spark: SparkSession, folder: str, keys: DataFrame) -> DataFrame:
    """Captures of the distinct keys of column ``key``: ``key, page_id, file, offset,
    length``. A key that the index has not got has none.

    The upper level goes to all tasks: a row of at most two cut keys per task that wrote
    the index, whatever the number of pages. A key with captures in many parts is looked
    up in each of them by another task.
    """
    parts = [tuple(r) for r in spark.read.schema(PART).parquet(
        f"{folder.rstrip('/')}/{PARTS}").orderBy("part").collect()]
    firsts, lasts = [p[1] for p in parts], [p[2] for p in parts]

    def route(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key in batch.column("key").to_pylist():
                for i in range(bisect.bisect_left(lasts, key), bisect.bisect_right(firsts, key)):
                    rows.append({"i": i, "key": key})
            if rows:
                yield pa.RecordBatch.from_pylist(rows, _schema("i long, key string"))

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = filesystem(folder)
        open_no, part, source = -1, None, None
        for batch in batches:
            rows = []
            for i, key in zip(batch.column("i").to_pylist(), batch.column("key").to_pylist()):
                if i != open_no:
                    if source is not None:
                        source.close()
                    _, _, _, file, at, length = parts[i]
                    source = fs.open_input_file(f"{base}/{file}")
                    open_no, part = i, IndexPart(source, at, length)
                for line in part.find(key):
                    rows.append(dict(zip(["key", "page_id", "file", "offset", "length"], line)))
                    if len(rows) == 1 << 13:
                        yield pa.RecordBatch.from_pylist(rows, _schema(CAPTURE))
                        rows = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, _schema(CAPTURE))
        if source is not None:
            source.close()

    keys = keys.select("key").distinct()
    routed = keys.mapInArrow(route, "i long, key string")
    routed = routed.repartition(max(1, len(parts)), "i").sortWithinPartitions("i", "key")
    return routed.mapInArrow(search, CAPTURE)


def read_records(captures: DataFrame, folder: str) -> DataFrame:
    """The records at the captures: ``page_id, url, record_type, payload_bytes,
    payload_digest, refers_to``. Neighbours in an archive are read together."""
    captures = written(captures.select("file", "offset", "length"))
    # By the bytes to read: rows of the index alone would all fit into one task.
    size = captures.agg(F.sum("length")).first()[0] or 0
    cores = captures.sparkSession.sparkContext.defaultParallelism
    near = captures.repartition(
        max(cores, -(-size // STRETCH_BYTES)), "file", F.expr(f"offset div {STRETCH_BYTES}")
    )

    def load(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = filesystem(folder)
        name, source = None, None
        for batch in batches:
            rows = [tuple(r.values()) for r in batch.to_pylist()]
            lo = 0
            while lo < len(rows):
                file, first, length = rows[lo]
                hi, stop = lo + 1, first + length
                while hi < len(rows) and rows[hi][0] == file and stop <= rows[hi][1] <= stop + (1 << 16) \
                        and rows[hi][1] + rows[hi][2] - first <= READ_BYTES:
                    stop = rows[hi][1] + rows[hi][2]
                    hi += 1
                if file != name:
                    if source is not None:
                        source.close()
                    name, source = file, fs.open_input_file(f"{base}/{file}")
                raw = memoryview(source.read_at(stop - first, first))
                out = []
                for _, at, size in rows[lo:hi]:
                    member = raw[at - first : at - first + size]
                    out.append(parsed(zlib.decompress(member, zlib.MAX_WBITS | 16)))
                yield pa.RecordBatch.from_pylist(out, _schema(RECORD))
                lo = hi
        if source is not None:
            source.close()

    return near.sortWithinPartitions("file", "offset").mapInArrow(load, RECORD)


def look_up(spark: SparkSession, folder: str, urls: DataFrame, url_col: str = "url") -> DataFrame:
    """Records of all pages at the distinct URLs of a column, one row per capture. A null
    URL finds the pages without URL."""
    keys = urls.select(url_key(F.col(url_col).cast("string")).alias("key"))
    return read_records(find_captures(spark, folder, keys), folder)
