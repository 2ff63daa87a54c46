"""Send parsed messages to tables: quarantine, processors, accept/reject rules."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logintake.operators.parse import MESSAGE_COLUMNS

ROUTE = "route"
ERRORS = "errors"


def valid_messages(parsed: DataFrame) -> DataFrame:
    """Decoded rows, in the columns of the message table."""
    return parsed.filter(F.col("error_code").isNull()).select(*MESSAGE_COLUMNS)


def error_rows(parsed: DataFrame, ingest_time: Column | None = None) -> DataFrame:
    """Rows for the errors table: time of processing and the line as received."""
    when = F.current_timestamp() if ingest_time is None else ingest_time
    undecoded = F.col("error_code").isNotNull()
    if ROUTE in parsed.columns:
        undecoded = F.col(ROUTE) == ERRORS
    return parsed.filter(undecoded).select(when.alias("date"), F.col("raw").alias("data"))


@dataclass(frozen=True)
class Processor:
    """Picks messages by ``predicate`` and writes ``projection`` of them to ``table``.

    ``rewrite`` changes columns of every message offered to this processor, so
    also for the processors after it. Both Columns may hold pandas UDFs. ``last`` marks the
    catch-all.
    """

    name: str
    predicate: Column
    projection: Callable[[DataFrame], DataFrame] | None = None
    table: str | None = None
    rewrite: dict[str, Column] = field(default_factory=dict)
    last: bool = False

    def rows(self, routed: DataFrame) -> DataFrame:
        picked = routed.filter(F.col(ROUTE) == self.name).drop(ROUTE)
        return self.projection(picked) if self.projection else picked

    @property
    def target(self) -> str:
        return self.table or self.name


def catch_all() -> Processor:
    """Takes every message that is left and stores its seven columns."""
    return Processor("syslog", F.lit(True), lambda df: df.select(*MESSAGE_COLUMNS), last=True)


class Processors:
    """An ordered chain. The first processor that picks a message gets it."""

    def __init__(self, *chain: Processor):
        self.chain: list[Processor] = []
        for processor in chain:
            self.register(processor)

    def register(self, processor: Processor) -> Processors:
        taken = {p.name for p in self.with_catch_all()} | {ERRORS}
        if processor.name in taken:
            raise ValueError(f"processor name {processor.name!r} is taken")
        self.chain.append(processor)
        return self

    def with_catch_all(self) -> list[Processor]:
        return [*self.chain, catch_all()]


def ending_in_catch_all(chain: Processors | list[Processor] | None) -> list[Processor]:
    """The chain as a list whose last processor takes what is left. Names that are taken,
    that of the catch-all included, are refused."""
    if not isinstance(chain, Processors):
        chain = Processors(*(p for p in chain or [] if not p.last))
    return chain.with_catch_all()


def route_first_match(messages: DataFrame, chain: list[Processor]) -> DataFrame:
    """Add ``route``, the name of the first processor that picks the row, or null.

    Rows with an error code are never offered to a processor; their route is
    the errors table.
    """
    undecoded = F.lit(False)
    if "error_code" in messages.columns:
        undecoded = F.col("error_code").isNotNull()
    out = messages.withColumn(ROUTE, F.when(undecoded, F.lit(ERRORS)))
    for processor in chain:
        offered = F.col(ROUTE).isNull()
        if processor.rewrite:
            out = out.withColumns(
                {
                    name: F.when(offered, new).otherwise(F.col(name))
                    for name, new in processor.rewrite.items()
                }
            )
        out = out.withColumn(
            ROUTE, F.when(offered & processor.predicate, processor.name).otherwise(F.col(ROUTE))
        )
    return out


def processor_tables(routed: DataFrame, chain: list[Processor]) -> dict[str, DataFrame]:
    """Rows by table; processors of the same table are put together."""
    tables: dict[str, DataFrame] = {}
    for processor in chain:
        rows = processor.rows(routed)
        known = tables.get(processor.target)
        tables[processor.target] = rows if known is None else known.unionByName(rows)
    return tables


ACCEPT, REJECT = "accept", "reject"


def _like(wildcard: str) -> str:
    """LIKE pattern of a wildcard with * and ?."""
    for plain in "\\%_":
        wildcard = wildcard.replace(plain, "\\" + plain)
    return wildcard.replace("*", "%").replace("?", "_")


def rule_action(col: Column, rules: list[tuple[str, str]], default: str = REJECT) -> Column:
    """Action of the first rule whose wildcard matches."""
    for _, action in rules:
        if action not in (ACCEPT, REJECT):
            raise ValueError(f"unknown action {action!r}, expected accept or reject")
    result = F.when(F.lit(False), F.lit(default))
    for wildcard, action in rules:
        result = result.when(col.like(_like(wildcard)), F.lit(action))
    return result.otherwise(F.lit(default))


def rule_filter(
    df: DataFrame, col: str, rules: list[tuple[str, str]], default: str = REJECT
) -> DataFrame:
    """Rows that the ordered (wildcard, action) rules accept."""
    return df.filter(rule_action(F.col(col), rules, default) == ACCEPT)
