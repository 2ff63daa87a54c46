"""Intake as a job: ``spark-submit --py-files ... logintake/plans/run.py --help``.

Processors of one's own are registered in a job of one's own, which calls
``ingest_stream`` or ``dispatch`` with the chain.
"""

from __future__ import annotations

import argparse
import datetime as dt
import time

from logintake.plans.dispatch import dispatch
from logintake.session import get_session
from logintake.sources.spool import FILES, LAYOUTS, stream_spool
from logintake.streaming.intake import ingest_stream


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Spool folder to syslog and errors tables.")
    parser.add_argument("mode", choices=["stream", "once", "batch"],
                        help="run on; take what is there and stop; or one batch by line count")
    parser.add_argument("--spool", required=True, help="folder of spool files")
    parser.add_argument("--tables", required=True, help="folder of the tables")
    parser.add_argument("--checkpoint", help="folder of the stream's progress")
    parser.add_argument("--layout", choices=LAYOUTS, default=FILES, help="how the spool's files lie")
    parser.add_argument("--min-logs", type=int, default=10_000)
    parser.add_argument("--max-wait", type=float, default=10, help="seconds")
    parser.add_argument("--max-files", type=int, default=1000, help="files of a micro-batch")
    parser.add_argument("--clean-source", choices=["off", "delete", "archive"], default="off",
                        help="what becomes of files that have been read")
    parser.add_argument("--archive", help="folder for them")
    parser.add_argument("--store-procid", action="store_true")
    arguments = parser.parse_args(argv)
    if arguments.mode != "batch" and not arguments.checkpoint:
        parser.error("a stream needs --checkpoint")
    return arguments


def main(argv: list[str] | None = None) -> int | None:
    """Run the job; a batch returns its number, or None if nothing was waiting."""
    a = _arguments(argv)
    spark = get_session("log intake")
    max_wait = dt.timedelta(seconds=a.max_wait)
    options = {"store_procid": a.store_procid}
    clean = {"clean_source": a.clean_source, "archive": a.archive}
    if a.mode == "batch":
        started = time.monotonic()
        while True:
            waited = dt.timedelta(seconds=time.monotonic() - started)
            number = dispatch(
                spark, a.spool, a.tables, a.checkpoint, a.min_logs, max_wait, waited, a.layout,
                max_files=a.max_files, **clean, **options,
            )
            if number is not None or waited >= max_wait:
                return number
            time.sleep(min(1.0, a.max_wait))
    lines = stream_spool(spark, a.spool, a.layout, a.max_files, **clean)
    ingest_stream(
        lines, a.tables, a.checkpoint,
        max_wait=max_wait if a.mode == "stream" else None, **options,
    ).awaitTermination()
    return None


if __name__ == "__main__":
    main()
