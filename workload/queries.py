"""One query per operator, each over whole tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logintake.functions.codec import escape, escape_valid, unescape
from logintake.operators.chunk import chunk_manifest, chunk_messages, spool_name
from logintake.operators.clock import micros, unique_micros
from logintake.operators.manifest import next_batch, spool_audit, spool_manifest
from logintake.operators.parse import MESSAGE_COLUMNS, REASONS, parse_syslog
from logintake.operators.report import (
    day_sketches,
    error_lines,
    error_report,
    merge_sketches,
    read_sketches,
)
from logintake.operators.route import (
    Processor,
    Processors,
    error_rows,
    processor_tables,
    route_first_match,
    rule_action,
    rule_filter,
    valid_messages,
)
from logintake.operators.rules import table_actions
from logintake.plans.databases import database_writer, read_database
from logintake.plans.dispatch import dispatch
from logintake.plans.intake import intake, parse_lines
from logintake.plans.tables import by_day, parquet_writer, read_table, write_tables
from logintake.plans.stamps import StampBlocks
from logintake.plans.versions import VersionedTable, compact, read_versioned, versioned_writer
from logintake.session import shared_folder
from logintake.sources.containers import write_containers
from logintake.sources.gated import BatchLog, stream_gated
from logintake.sources.spool import (
    CONTAINERS,
    FOLDERS,
    list_spool,
    read_spool,
    stream_spool,
    write_spool,
)
from logintake.streaming.chunks import chunk_stream
from logintake.streaming.intake import ingest_stream
from logintake.streaming.timers import closed_chunks, rocksdb_state
from workload import shapes
from workload.render import in_shapes, mixed_lines, table, with_parts

REF_TIME = "2024-06-01 00:00:00"
INGEST_TIME = "2024-06-01 12:00:00"

GAP = dt.timedelta(hours=6)
CAP = 3
SPOOL_CAP = 500


def _naive(df: DataFrame, *columns: str) -> DataFrame:
    """Timestamps without zone, as the given tables have them."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns or ["date"]})


def _ingest_time() -> Column:
    return F.lit(INGEST_TIME).cast("timestamp")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def _mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_syslog(mixed_lines(spark, sf_dir), ref_time=REF_TIME)


def _in_shapes(spark, sf_dir, made) -> DataFrame:
    parts = with_parts(_events(spark, sf_dir))
    lines = in_shapes(parts, made, "event_id")
    return _naive(parse_syslog(lines, ref_time=REF_TIME))


# Parser


def parse_syslog_mixed(spark, sf_dir):
    return _naive(_mixed(spark, sf_dir)).drop("raw", "error_reason")


def parse_rfc5424(spark, sf_dir):
    return _in_shapes(spark, sf_dir, shapes.NEW_FAMILY).drop("raw", "error_reason")


def parse_rfc5424_procid(spark, sf_dir):
    parts = with_parts(_events(spark, sf_dir))
    lines = in_shapes(parts, {"utc": shapes.NEW_FAMILY["utc"]}, "event_id")
    parsed = parse_syslog(lines, store_procid=True)
    return parsed.select("event_id", "pid", "error_code")


def parse_rfc3164(spark, sf_dir):
    return _in_shapes(spark, sf_dir, shapes.OLD_FAMILY).drop("raw", "error_reason")


def parse_timestamps(spark, sf_dir):
    made = {
        name: f"concat('<13>',{stamp},' host app: x')" for name, stamp in shapes.STAMPS.items()
    }
    return _in_shapes(spark, sf_dir, made).select("event_id", "shape", "date", "error_code")


def zone_offsets(spark, sf_dir):
    parts = with_parts(_events(spark, sf_dir))
    lines = in_shapes(
        parts,
        {
            zone: f"concat('<13>',mon,' ',hms,' {zone} 2024 host app: ',props)"
            for zone in ("UTC", "CST", "EET")
        },
        "event_id",
    )
    parsed = parse_syslog(lines, zone_offsets={"CST": -360, "EET": 120})
    return _naive(parsed).select("event_id", "shape", "date", "error_code")


def complete_year(spark, sf_dir):
    """Order dates without their year, completed by a common and a leap year."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.explode(F.array(F.lit(2023), F.lit(2028))).alias("ref_year"),
        "o_orderdate",
    )
    short = (
        "concat('<13>', date_format(o_orderdate, 'MMM'), ' ', "
        "lpad(cast(day(o_orderdate) AS string), 2, ' '), ' 01:02:03 host app: x')"
    )
    zero = "concat('<13>0000-', date_format(o_orderdate, 'MM-dd'), 'T01:02:03Z host app: x')"
    lines = in_shapes(orders, {"short": short, "zero": zero}, "o_orderkey", "ref_year")
    parsed = parse_syslog(lines, ref_time=F.make_timestamp("ref_year", *[F.lit(1)] * 5))
    return _naive(parsed).select("o_orderkey", "ref_year", "shape", "date", "error_code")


def parse_errors(spark, sf_dir):
    made = {name: sql for name, (_, sql) in shapes.BROKEN.items()}
    parsed = _in_shapes(spark, sf_dir, made)
    return parsed.select("event_id", "shape", "error_code", "error_reason", "raw")


# Reports and routing


def error_counts(spark, sf_dir):
    return error_report(_mixed(spark, sf_dir))


def report_of_days(spark, sf_dir):
    """Sketches of three batches, kept as a table and merged by day; a row for each of the
    day's error reasons, and one without reason."""
    path, parsed = shared_folder(spark), _mixed(spark, sf_dir)
    day = F.lit(INGEST_TIME).cast("date")
    for n in range(3):
        some = parsed.filter(F.pmod(F.xxhash64("event_id"), F.lit(3)) == n)
        day_sketches(some, day).write.mode("append").parquet(path)
    merged = read_sketches(merge_sketches(spark.read.parquet(path)), top=len(REASONS))
    text = F.explode_outer("texts").alias("text")
    return merged.select("day", "lines", "errors", "senders", text).select(
        "day", "lines", "errors", "senders",
        F.col("text.item").alias("reason"), F.col("text.count").alias("n"),
    )


def error_listing(spark, sf_dir):
    return error_lines(_mixed(spark, sf_dir))


def split_errors(spark, sf_dir):
    return _naive(error_rows(_mixed(spark, sf_dir), _ingest_time()))


def split_messages(spark, sf_dir):
    return _naive(valid_messages(_mixed(spark, sf_dir)))


def _chain() -> Processors:
    """Three processors: one with columns of its own, one that also changes what
    it hands on, and one that shares the table of the first."""
    return Processors(
        Processor(
            "audit",
            F.col("process") == "error",
            lambda df: df.select("date", "hostname", F.upper("data").alias("data")),
        ),
        Processor(
            "urgent",
            (F.col("severity") <= 1) & (F.col("process") == "click"),
            lambda df: df.select("date", "facility", "hostname"),
            rewrite={"hostname": F.regexp_replace("hostname", "^host", "node")},
        ),
        Processor(
            "kernel",
            F.col("facility") == 0,
            lambda df: df.select("date", "hostname", "data"),
            table="audit",
        ),
    )


def route_messages(spark, sf_dir):
    routed = route_first_match(_mixed(spark, sf_dir), _chain().with_catch_all())
    return routed.select("event_id", "hostname", "route")


def _table(spark, sf_dir, name):
    chain = _chain().with_catch_all()
    messages = _mixed(spark, sf_dir).filter(F.col("error_code").isNull())
    return _naive(processor_tables(route_first_match(messages, chain), chain)[name])


def processor_audit(spark, sf_dir):
    return _table(spark, sf_dir, "audit")


def processor_urgent(spark, sf_dir):
    return _table(spark, sf_dir, "urgent")


def processor_catch_all(spark, sf_dir):
    return _table(spark, sf_dir, "syslog")


def processor_counts(spark, sf_dir):
    """Rows and time span of every table the chain writes."""
    chain = _chain().with_catch_all()
    tables = processor_tables(route_first_match(_mixed(spark, sf_dir), chain), chain)
    out = None
    for name, rows in tables.items():
        counts = rows.agg(
            F.count(F.lit(1)).alias("n"), F.min("date").alias("first"), F.max("date").alias("last")
        ).withColumn("table", F.lit(name))
        out = counts if out is None else out.unionByName(counts)
    return _naive(out, "first", "last")


RULES = [("log-zone-75", "reject"), ("log-zone-1?", "reject"), ("log-zone-*", "accept")]


def _senders(spark, sf_dir):
    return _events(spark, sf_dir).select(
        "event_id",
        F.when(F.col("event_type") == "error", F.concat(F.lit("other-"), "user_id"))
        .otherwise(F.concat(F.lit("log-zone-"), "user_id"))
        .alias("cn"),
    )


def accept_senders(spark, sf_dir):
    return rule_filter(_senders(spark, sf_dir), "cn", [*RULES, ("*", "reject")])


def sender_actions(spark, sf_dir):
    action = rule_action(F.col("cn"), RULES, default="accept")
    return _senders(spark, sf_dir).select("event_id", action.alias("action"))


def rules_by_part(spark, sf_dir):
    """A rule for each part, of six kinds, over all senders."""
    key, kind = F.col("p_partkey"), F.col("p_partkey") % 6
    zone = (key * 7 % 1201).cast("string")
    wildcard = (
        F.when(kind == 0, F.concat(F.lit("log-zone-"), zone))
        .when(kind == 1, F.concat(F.lit("log-zone-"), zone, F.lit("?")))
        .when(kind == 2, F.concat(F.lit("*-"), zone))
        .when(kind == 3, F.concat(F.lit("other-"), zone, F.lit("*")))
        .when(kind == 4, F.concat(F.lit("?og-zone-"), zone))
        .otherwise(F.concat(F.lit("log-*"), zone))
    )
    rules = table(spark, sf_dir, "part").select(
        key.alias("number"), wildcard.alias("wildcard"),
        F.when(F.col("p_size") % 2 == 0, "accept").otherwise("reject").alias("action"),
    )
    return table_actions(_senders(spark, sf_dir), "cn", rules)


# Codec


def escape_lines(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", escape(F.col("text")).alias("line"))


def escape_bytes(spark, sf_dir):
    """Pages as bytes, made invalid as text by a byte in front."""
    raw = F.concat(F.unhex(F.lit("88")), F.col("html").cast("binary"))
    return table(spark, sf_dir, "pages").select("page_id", escape(raw).alias("line"))


def escape_roundtrip(spark, sf_dir):
    text = F.replace("text", F.lit(" "), F.lit("\\"))
    docs = table(spark, sf_dir, "documents").select("doc_id", escape(text).alias("line"))
    return docs.select("doc_id", unescape(F.col("line")).alias("text"))


def unescape_bytes(spark, sf_dir):
    raw = F.concat(F.unhex(F.lit("88")), F.col("text").cast("binary"))
    docs = table(spark, sf_dir, "documents").select("doc_id", escape(raw).alias("line"))
    return docs.select("doc_id", F.hex(unescape(F.col("line")).cast("binary")).alias("bytes"))


def unescape_invalid(spark, sf_dir):
    """Each document, escaped, with each of the malformed endings."""
    ends = F.array(
        *[F.struct(F.lit(n).alias("ending"), F.lit(e).alias("tail"))
          for n, e in shapes.BAD_ESCAPES.items()]
    )
    # Escaped before the generator, so once for all endings.
    docs = table(spark, sf_dir, "documents").select("doc_id", escape("text").alias("escaped"))
    lines = docs.select("doc_id", "escaped", F.explode(ends).alias("end")).select(
        "doc_id", "end.ending", F.concat("escaped", "end.tail").alias("line")
    )
    return lines.select(
        "doc_id", "ending",
        unescape(F.col("line")).alias("line"), escape_valid(F.col("line")).alias("valid"),
    )


# Spool names, batches and chunks


def _file_names(spark, sf_dir):
    """A spool file per hour of events, and names that are none next to it."""
    hours = _events(spark, sf_dir).groupBy(F.date_trunc("hour", "ts").alias("hour")).agg(
        F.min("ts").alias("first_ts"), F.count(F.lit(1)).alias("n")
    )
    name = spool_name(micros(F.col("first_ts")), F.col("n"))
    bare = F.substring(name, 1, 25)
    return hours.select(
        F.explode(
            F.array(
                name,
                F.concat(F.lit("."), name),
                F.concat(F.lit("zz."), F.substring(name, 18, 12)),
                F.concat(bare, F.lit(".txt")),
                F.concat(bare, F.lit(".a.log")),
                F.concat(F.lit("1"), F.substring(name, 1, 16), F.lit("."), F.lit("1.log")),
            )
        ).alias("file_name")
    )


def manifest(spark, sf_dir):
    return _naive(spool_manifest(_file_names(spark, sf_dir)), "start_ts")


def batch_files(spark, sf_dir):
    files = spool_manifest(_file_names(spark, sf_dir))
    return next_batch(files, min_logs=750).select("file_name", "logs", "logs_upto")


def batch_files_in_slices(spark, sf_dir):
    files = spool_manifest(_file_names(spark, sf_dir))
    return next_batch(files, min_logs=750, hot_rows=50).select(
        "file_name", "logs", "logs_upto"
    )


def _arrivals(spark, sf_dir):
    return _events(spark, sf_dir).select("event_id", "ts", "user_id")


def chunks(spark, sf_dir):
    out = chunk_messages(_arrivals(spark, sf_dir), "user_id", "ts", "event_id", GAP, CAP)
    return _naive(out, "session_start")


def _hot_arrivals(spark, sf_dir):
    """One sender has every third event."""
    hot = F.when(F.col("event_id") % 3 == 0, F.lit(7)).otherwise(F.col("user_id"))
    return _arrivals(spark, sf_dir).withColumn("user_id", hot.cast("bigint"))


def chunks_of_hot_sender(spark, sf_dir):
    out = chunk_messages(
        _hot_arrivals(spark, sf_dir), "user_id", "ts", "event_id",
        dt.timedelta(minutes=30), 50, hot_rows=200,
    )
    return _naive(out, "session_start")


def chunk_files(spark, sf_dir):
    chunked = chunk_messages(_arrivals(spark, sf_dir), "user_id", "ts", "event_id", GAP, CAP)
    out = chunk_manifest(chunked, "user_id", "ts")
    return _naive(out, "session_start", "start_ts")


def _by_hour(spark, sf_dir):
    return _hot_arrivals(spark, sf_dir).withColumn("ts", F.date_trunc("hour", "ts"))


def unique_stamps(spark, sf_dir):
    out = unique_micros(_by_hour(spark, sf_dir), "ts", "user_id", "event_id", hot_rows=500)
    return out.select("event_id", "unique_us")


def unique_stamps_global(spark, sf_dir):
    out = unique_micros(_by_hour(spark, sf_dir), "ts", order="event_id", hot_rows=500)
    return out.select("event_id", "unique_us")


# Files, tables and streams


# Spools that are already there, by session and tables.
_SPOOLS: dict[tuple[str, str], str] = {}


def keep_spool(spark, sf_dir) -> None:
    """Write the spool of these tables now; queries of this session read that one."""
    _SPOOLS[spark.sparkContext.applicationId, sf_dir] = _spool(spark, sf_dir)


def _spool(spark, sf_dir) -> str:
    kept = _SPOOLS.get((spark.sparkContext.applicationId, sf_dir))
    if kept is not None:
        return kept
    path = shared_folder(spark)
    lines = mixed_lines(spark, sf_dir, "ts", "event_type")
    write_spool(lines, path, "event_type", "ts", "line", "event_id", GAP, SPOOL_CAP)
    return path


def spool_roundtrip(spark, sf_dir):
    """Lines in their file, numbered in the order of the sender."""
    read = read_spool(spark, _spool(spark, sf_dir), CONTAINERS)
    return read.select("file_name", unescape(F.col("value")).alias("line"))


def spool_documents(spark, sf_dir):
    """Whole documents as message text, newlines and all, through a spool."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "lang",
        F.timestamp_micros(F.col("doc_id") * 1000).alias("ts"),
        F.concat(
            F.lit("<13>2024-01-01T00:00:00Z host doc["), "doc_id", F.lit("]: "), "text"
        ).alias("line"),
    )
    path = shared_folder(spark)
    write_spool(docs, path, "lang", "ts", "line", "doc_id", max_logs=100)
    parsed = parse_lines(read_spool(spark, path, CONTAINERS))
    return parsed.select("pid", "data", "error_code")


def audit(spark, sf_dir):
    """Files that declare one line more, one less, or as many as they hold, by their size;
    and one without any line."""
    whole, path = _spool(spark, sf_dir), shared_folder(spark)
    size = F.conv(F.substring("file_name", 18, 8), 16, 10).cast("bigint")
    declared = size + F.element_at(F.array(F.lit(0), F.lit(1), F.lit(-1)), (size % 3 + 1).cast("int"))
    name = F.concat(
        F.substring("file_name", 1, 17), F.lower(F.lpad(F.hex(declared), 8, "0")), F.lit(".log")
    )
    lines = read_spool(spark, whole, CONTAINERS).select(name.alias("file_name"), F.lit(0).alias("line_no"), "value")
    empty = spark.createDataFrame(
        [("0000000000000001.00000003.log", 0, None)], "file_name string, line_no int, value string"
    )
    write_containers(lines.unionByName(empty).repartition("file_name"), path)
    return spool_audit(read_spool(spark, path, CONTAINERS), list_spool(spark, path, CONTAINERS))


def audit_folders(spark, sf_dir):
    """The same of a spool in which every file is a folder."""
    whole, path = _spool(spark, sf_dir), shared_folder(spark)
    lines = read_spool(spark, whole, CONTAINERS).select("value", F.col("file_name").alias("spool_file"))
    lines.write.partitionBy("spool_file").text(path)
    empty = spark.createDataFrame([], "value string").coalesce(1)
    empty.write.text(f"{path}/spool_file=0000000000000001.00000003.log")
    return spool_audit(read_spool(spark, path, FOLDERS), list_spool(spark, path, FOLDERS))


def intake_batch(spark, sf_dir):
    """Spool to tables in one batch; the table read back."""
    root = shared_folder(spark)
    lines = read_spool(spark, _spool(spark, sf_dir), CONTAINERS)
    intake(lines, root, ref_time=REF_TIME, ingest_time=_ingest_time())
    return _naive(read_table(spark, root, "syslog").select(*MESSAGE_COLUMNS))


def intake_dispatch(spark, sf_dir):
    """Spool to tables, some thousand lines at a time; the errors read back."""
    root = shared_folder(spark)
    spool = _spool(spark, sf_dir)
    size = spark.read.parquet(f"{sf_dir}/events.parquet").count() // 3 + 1
    while dispatch(
        spark, spool, root, min_logs=size, layout=CONTAINERS, ref_time=REF_TIME,
        ingest_time=_ingest_time(),
    ) is not None:
        pass
    return _naive(read_table(spark, root, "errors").select("date", "data"))


def intake_gated(spark, sf_dir):
    """Nothing is taken in while too few lines wait, and all of them once there are enough."""
    root, spool = shared_folder(spark), _spool(spark, sf_dir)
    size = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    common = dict(
        layout=CONTAINERS, ref_time=REF_TIME, ingest_time=_ingest_time(), waited=dt.timedelta(0)
    )
    first = dispatch(spark, spool, root, min_logs=size + 1, **common)
    second = dispatch(spark, spool, root, min_logs=size, **common)
    third = dispatch(spark, spool, root, min_logs=1, **common)
    return _naive(read_table(spark, root, "errors").select("date", "data")).withColumn(
        "batches", F.lit(f"{first} {second} {third}")
    )


def gated(spark, sf_dir):
    """A spool that grows by a quarter, a half and a quarter of the lines. A stream takes
    nothing of the first, then both, and the last only once it has waited long enough."""
    root, spool, state, checkpoint = (shared_folder(spark) for _ in range(4))
    lines = mixed_lines(spark, sf_dir, "ts", "event_type")
    size = lines.count()
    quarter = F.pmod(F.xxhash64("event_id"), F.lit(4))
    seen = []

    def grow(some) -> None:
        write_spool(
            lines.filter(quarter.isin(*some)), spool, "event_type", "ts", "line", "event_id", GAP, SPOOL_CAP,
            mode="append",
        )

    def start(max_wait: dt.timedelta):
        return ingest_stream(
            stream_gated(spark, spool, state, size // 2, max_wait, CONTAINERS), root, checkpoint,
            max_wait=dt.timedelta(milliseconds=200), ref_time=REF_TIME, ingest_time=_ingest_time(),
        )

    grow([0])
    query = start(dt.timedelta(days=1))
    for some in ([], [1, 2], [3]):
        if some:
            grow(some)
        query.processAllAvailable()
        seen.append(len(BatchLog(state).numbers()))
    query.stop()
    query = start(dt.timedelta(0))
    query.processAllAvailable()
    query.stop()
    seen.append(len(BatchLog(state).numbers()))
    return _naive(read_table(spark, root, "errors").select("date", "data")).withColumn(
        "batches", F.lit(" ".join(map(str, seen)))
    )


def intake_replay(spark, sf_dir):
    """The same batch twice; the second run replaces the first."""
    root = shared_folder(spark)
    for _ in range(2):
        write_tables(
            _mixed(spark, sf_dir), parquet_writer(root, 1), _chain().with_catch_all(),
            _ingest_time(), keep="cache",
        )
    tables = [
        read_table(spark, root, name).select(F.lit(name).alias("table"), "date")
        for name in ("errors", "audit", "urgent", "syslog")
    ]
    union = tables[0]
    for other in tables[1:]:
        union = union.unionByName(other)
    return union.groupBy("table").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("date").alias("dates")
    )


def _counted(spark, root: str, names: list[str]) -> DataFrame:
    """Rows of each table, those without any included."""
    tables = [read_table(spark, root, name).select(F.lit(name).alias("table")) for name in names]
    union = tables[0]
    for other in tables[1:]:
        union = union.unionByName(other)
    every = spark.createDataFrame([(name,) for name in names], "table string")
    counts = union.groupBy("table").agg(F.count(F.lit(1)).alias("n"))
    return every.join(counts, "table", "left").select("table", F.coalesce("n", F.lit(0)).alias("n"))


def write_shared_errors(spark, sf_dir):
    """A processor that writes to the errors table adds to the quarantine."""
    root = shared_folder(spark)
    failed = Processor(
        "failed", F.col("process") == "error", lambda df: df.select("date", "data"), table="errors"
    )
    write_tables(_mixed(spark, sf_dir), parquet_writer(root, 1), Processors(failed), _ingest_time())
    return _naive(read_table(spark, root, "errors").select("date", "data"))


def write_without_catch_all(spark, sf_dir):
    """A plain list as chain; what its processor leaves is in the catch-all's table."""
    root = shared_folder(spark)
    chain = [Processor("failed", F.col("process") == "error")]
    write_tables(_mixed(spark, sf_dir), parquet_writer(root, 1), chain, _ingest_time())
    return _counted(spark, root, ["errors", "failed", "syslog"])


def intake_replay_changed(spark, sf_dir):
    """The same batch again with another chain: tables of the first attempt are empty."""
    root = shared_folder(spark)
    for chain in (_chain(), Processors(Processor("urgent", F.col("severity") == 0))):
        write_tables(
            _mixed(spark, sf_dir), parquet_writer(root, 1), chain, _ingest_time(), keep="cache"
        )
    return _counted(spark, root, ["errors", "audit", "urgent", "syslog"])


def daily_layout(spark, sf_dir):
    path = shared_folder(spark)
    by_day(valid_messages(_mixed(spark, sf_dir))).write.partitionBy("date_day").parquet(path)
    stored = spark.read.parquet(path)
    return _naive(
        stored.groupBy("date_day").agg(
            F.count(F.lit(1)).alias("n"), F.min("date").alias("first"),
            F.max("date").alias("last"), F.sum("pid").alias("pids"),
        ),
        "first", "last",
    )


def _versioned(spark, sf_dir) -> str:
    """The lines in three batches, the last one twice, as versioned tables."""
    root = shared_folder(spark)
    lines = mixed_lines(spark, sf_dir)
    for number in (0, 1, 2, 2):
        some = lines.filter(F.pmod(F.xxhash64("event_id"), F.lit(3)) == number)
        intake(some, root, ref_time=REF_TIME, ingest_time=_ingest_time(), batch_id=number, col="line",
               keep="cache", writer=versioned_writer)
    return root


def databases(spark, sf_dir):
    """The lines in three batches, the last one twice, as database files that are read back."""
    root = shared_folder(spark)
    lines = mixed_lines(spark, sf_dir)
    for number in (0, 1, 2, 2):
        some = lines.filter(F.pmod(F.xxhash64("event_id"), F.lit(3)) == number)
        intake(some, root, ref_time=REF_TIME, ingest_time=_ingest_time(), batch_id=number, col="line",
               keep="cache", writer=database_writer)
    return _naive(read_database(spark, root, "syslog").select(*MESSAGE_COLUMNS))


def one_day(spark, sf_dir):
    """The rows of each day, read from the files of that day alone: their least and
    greatest day, and whether the list has files of one day only."""
    root = _versioned(spark, sf_dir)
    found = VersionedTable(spark, f"{root}/syslog")
    days = [r.day for r in found.live().select("day").distinct().collect()]
    out = None
    for day in days:
        rows = read_versioned(spark, root, "syslog", day=day).agg(
            F.lit(day).alias("date_day"), F.count(F.lit(1)).alias("n"),
            F.min("date").alias("first"), F.max("date").alias("last"),
        )
        out = rows if out is None else out.unionByName(rows)
    return _naive(out, "first", "last")


def compacted(spark, sf_dir):
    """All days put together to files of a size that gives each two or so. A reader that has
    begun before sees the version before; so does one that asks for it."""
    root = _versioned(spark, sf_dir)
    found = VersionedTable(spark, f"{root}/syslog")
    version, early = found.latest(), read_versioned(spark, root, "syslog")
    sizes = F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes")
    before = {r.day: r.bytes for r in found.live(version).groupBy("day").agg(*sizes).collect()}
    target = max(before.values()) // 2 + 1
    compact(spark, root, "syslog", target_bytes=target, hot_rows=3)
    after = {r.day: r.n for r in found.live().groupBy("day").agg(*sizes).collect()}
    whole = all(after[day] <= size // target + 1 for day, size in before.items())
    asked = read_versioned(spark, root, "syslog", version)
    same = early.count() == asked.count() and early.exceptAll(asked).isEmpty()
    return _naive(read_versioned(spark, root, "syslog").select(*MESSAGE_COLUMNS)).withColumns(
        {"few_files": F.lit(whole), "same_before": F.lit(same)}
    )


def stamps_of_batches(spark, sf_dir):
    """Batches by time, each taking its stamps behind those of the one before; the second
    is repeated."""
    events = _hot_arrivals(spark, sf_dir)
    at = micros(F.col("ts"))
    first, last = events.agg(F.min(at), F.max(at)).first()
    # An hour's events may lie on both sides of a bound; their stamps go on.
    hours = events.withColumn("hour", F.date_trunc("hour", "ts"))
    blocks = StampBlocks(spark, shared_folder(spark))
    out = {}
    for n in (0, 1, 1, 2):
        lo, hi = (first + (last - first + 3) * k // 3 for k in (n, n + 1))
        out[n] = blocks.stamp(hours.filter((at >= lo) & (at < hi)), n, "hour", "event_id", hot_rows=500)
    return out[0].unionByName(out[1]).unionByName(out[2]).select("event_id", "unique_us")


def ingest(spark, sf_dir):
    root, checkpoint = shared_folder(spark), shared_folder(spark)
    stream = stream_spool(spark, _spool(spark, sf_dir), CONTAINERS, max_files=2)
    ingest_stream(
        stream, root, checkpoint, max_wait=None, ref_time=REF_TIME, ingest_time=_ingest_time()
    ).awaitTermination()
    return _naive(read_table(spark, root, "syslog").select(*MESSAGE_COLUMNS))


def _in_stretches(arrivals, source: str):
    """Write events to a folder in four stretches of time, one after each step.

    The inner bounds come from the data; the first and the last stretch are open, and an
    event without a time is in the first.
    """
    at = micros(F.col("ts"))
    first, last = arrivals.agg(F.min(at), F.max(at)).first()
    span = ((last or 0) - (first or 0)) // 4 + 1
    stretch = F.coalesce(F.least(F.lit(3), F.greatest(F.lit(0), F.floor((at - (first or 0)) / span))), F.lit(0))
    for n in range(4):
        arrivals.filter(stretch == n).write.mode("append").parquet(source)
        yield n


def chunks_by_timers(spark, sf_dir):
    """The same stretches, each taken by a run of the stream; chunks as they are closed."""
    out, checkpoint, source = (shared_folder(spark) for _ in range(3))
    arrivals = _arrivals(spark, sf_dir)
    for _ in _in_stretches(arrivals, source):
        stream = spark.readStream.schema(arrivals.schema).parquet(source)
        with rocksdb_state(spark):
            closed_chunks(stream, "user_id", "ts", GAP, CAP).writeStream.format("parquet").option(
                "checkpointLocation", checkpoint
            ).trigger(availableNow=True).start(out).awaitTermination()
    return _naive(spark.read.parquet(out), "session_start", "first_ts", "last_ts")


def chunks_in_stream(spark, sf_dir):
    """Events that arrive in four stretches of time, each taken by a micro-batch."""
    root, checkpoint, source = (shared_folder(spark) for _ in range(3))
    arrivals = _arrivals(spark, sf_dir)
    for _ in _in_stretches(arrivals, source):
        stream = spark.readStream.schema(arrivals.schema).parquet(source)
        chunk_stream(
            stream, root, checkpoint, "user_id", "ts", "event_id", GAP, CAP, max_wait=None
        ).awaitTermination()
    return _naive(
        spark.read.option("basePath", f"{root}/chunks").parquet(f"{root}/chunks/*").drop("batch_id"),
        "session_start",
    )


def chunk_ties(spark, sf_dir):
    """A sender with a third of all events, which have no time but their day."""
    days = _hot_arrivals(spark, sf_dir).withColumn("ts", F.date_trunc("day", "ts"))
    out = chunk_messages(days, "user_id", "ts", max_idle=GAP, max_logs=50, hot_rows=100)
    sizes = out.groupBy("user_id", "session_start", "part").agg(F.count(F.lit(1)).alias("n"))
    return _naive(sizes, "session_start")


ALL = {
    "parse_syslog": parse_syslog_mixed,
    "parse_rfc5424": parse_rfc5424,
    "parse_rfc5424_procid": parse_rfc5424_procid,
    "parse_rfc3164": parse_rfc3164,
    "parse_timestamps": parse_timestamps,
    "zone_offsets": zone_offsets,
    "complete_year": complete_year,
    "parse_errors": parse_errors,
    "error_report": error_counts,
    "error_lines": error_listing,
    "error_report_days": report_of_days,
    "split_errors": split_errors,
    "split_messages": split_messages,
    "route_first_match": route_messages,
    "processor_audit": processor_audit,
    "processor_urgent": processor_urgent,
    "processor_catch_all": processor_catch_all,
    "processor_tables": processor_counts,
    "rule_filter": accept_senders,
    "rule_action": sender_actions,
    "rule_table": rules_by_part,
    "escape_lines": escape_lines,
    "escape_bytes": escape_bytes,
    "escape_roundtrip": escape_roundtrip,
    "unescape_bytes": unescape_bytes,
    "unescape_invalid": unescape_invalid,
    "spool_manifest": manifest,
    "next_batch": batch_files,
    "next_batch_sliced": batch_files_in_slices,
    "chunk_messages": chunks,
    "chunk_hot_sender": chunks_of_hot_sender,
    "chunk_ties": chunk_ties,
    "chunk_manifest": chunk_files,
    "unique_micros": unique_stamps,
    "unique_micros_global": unique_stamps_global,
    "unique_micros_batches": stamps_of_batches,
    "spool_roundtrip": spool_roundtrip,
    "spool_documents": spool_documents,
    "spool_audit": audit,
    "spool_audit_folders": audit_folders,
    "intake_batch": intake_batch,
    "intake_dispatch": intake_dispatch,
    "intake_gated": intake_gated,
    "stream_gated": gated,
    "intake_replay": intake_replay,
    "write_shared_errors": write_shared_errors,
    "write_without_catch_all": write_without_catch_all,
    "intake_replay_changed": intake_replay_changed,
    "daily_layout": daily_layout,
    "daily_files": one_day,
    "compact_day": compacted,
    "write_database": databases,
    "ingest_stream": ingest,
    "chunk_stream": chunks_in_stream,
    "chunk_stream_timers": chunks_by_timers,
}
