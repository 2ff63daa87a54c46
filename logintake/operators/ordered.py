"""Running computations along an order, for keys of any size.

A window per key puts all rows of a key into one task. Here a key that holds
more than a fixed number of rows is cut into slices of its order first.
Windows then run per slice, and what a slice needs to know of the rows before
it (the carry) comes from one summary row per slice. Other keys are one slice.
Slices are no tasks: a task cuts as many as its share of the rows holds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from logintake.session import written

SLICE = "_slice"

# A key above this many rows is cut, and a slice has about as many.
SLICE_ROWS = 1_000_000

# Bytes of texts above which a key is cut, too, whatever its rows. So many are read by a task.
SLICE_BYTES = 64 << 20

# Slices there are at most; beyond it they grow with the rows. Their summaries pass
# through one task, and the carries are sent to all tasks.
MAX_SLICES = 100_000

# Hot keys are sent to all tasks up to this number; more are joined by a shuffle.
BROADCAST_KEYS = 100_000

# Tells rows of the same order apart, so that they can lie in several slices.
TIE = "_tie"

# Slice numbers of keys that were not cut, and of state from before the first row.
WHOLE, EARLIER = -1, -2

# Bits of a row's place within its task, as monotonically_increasing_id has them.
PLACES = (1 << 33) - 1


_OTHER = "_other_"


def _other(df: DataFrame, names: list[str]) -> DataFrame:
    """The frame with ``names`` prefixed, as right side of a self join."""
    return df.withColumnsRenamed({name: _OTHER + name for name in names})


def _same(names: list[str]) -> Column:
    condition = F.lit(True)
    for name in names:
        condition = condition & F.col(name).eqNullSafe(F.col(_OTHER + name))
    return condition


def _text_bytes(df: DataFrame) -> Column:
    """Bytes of a row's strings and binaries."""
    size = F.lit(0).cast("bigint")
    for field in df.schema.fields:
        if field.dataType.typeName() in ("string", "binary"):
            size = size + F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0))
    return size


def in_slices(
    df: DataFrame, keys: list[str], order: list[str], hot_rows: int | None = None
) -> tuple[DataFrame, bool]:
    """The rows with a slice number, and whether any key was cut.

    Slices ascend along ``order`` within a key; rows that are equal in it are
    dealt out by their number. ``hot_rows`` overrides the size above which a key
    is cut, which is also that of a slice, if that makes no more than MAX_SLICES.
    A key of long texts is cut by their bytes.
    """
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.sum(_text_bytes(df)).alias("_bytes"))
    limit = hot_rows or SLICE_ROWS
    large = (F.col("_n") > limit) | (F.col("_bytes") > SLICE_BYTES)
    whole = df.withColumn(SLICE, F.lit(WHOLE).cast("bigint"))
    if not sizes.agg(F.max(large)).first()[0]:
        return whole, False

    rows = sizes.agg(F.sum("_n")).first()[0]
    hot = written(sizes.filter(large))
    n_hot, n_cut, held = hot.agg(F.count(F.lit(1)), F.sum("_n"), F.sum("_bytes")).first()
    cut = df
    if keys:
        hot = _other(hot.select(*keys), keys)
        if n_hot <= BROADCAST_KEYS:
            hot = F.broadcast(hot)
        cut = df.join(hot, _same(keys), "left_semi")
        whole = whole.join(hot, _same(keys), "left_anti")
    parts = max(-(-rows // SLICE_ROWS), -(-held // SLICE_BYTES))
    slices = min(max(-(-rows // limit), parts), MAX_SLICES, n_cut)
    # Tasks follow the rows, however small a slice is.
    cores = df.sparkSession.sparkContext.defaultParallelism
    tasks = min(slices, max(cores, parts))
    cut = cut.withColumn(TIE, F.monotonically_increasing_id()).repartitionByRange(tasks, *keys, *order, TIE)
    cut = cut.sortWithinPartitions(*keys, *order, TIE).drop(TIE)
    # Range bounds are sampled, so the ranges have to be computed once only.
    place = F.monotonically_increasing_id().alias("_place")
    cut = written(cut.select("*", F.spark_partition_id().alias("_task"), place))
    # Rows before those of a task: one number for each.
    counts = cut.groupBy("_task").agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("_task", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_before"))
    number = f"(_before + (_place & {PLACES}L)) * {slices} div {n_cut}"
    cut = cut.join(F.broadcast(before), "_task").withColumn(SLICE, F.expr(number)).drop("_task", "_place", "_before")
    return (whole.unionByName(cut) if keys else cut), True


def carried(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    local: Callable[[DataFrame, WindowSpec], DataFrame],
    summary: dict[str, Column],
    carry: Callable[[DataFrame, WindowSpec], DataFrame],
    carry_columns: dict[str, str],
    hot_rows: int | None = None,
    earlier: DataFrame | None = None,
) -> DataFrame:
    """Rows with the columns of ``local`` and the carry into their slice.

    ``local`` works within a slice. ``summary`` aggregates a slice to one row;
    ``carry`` turns the summaries of a key, in order, into ``carry_columns``
    (name to type), null where nothing is carried. ``earlier`` gives summary
    rows of keys that had rows before these.
    """
    rows, cut = in_slices(df, keys, order, hot_rows)
    out = local(rows, Window.partitionBy(SLICE, *keys).orderBy(*order))
    if not cut and earlier is None:
        return out.withColumns(
            {c: F.lit(None).cast(t) for c, t in carry_columns.items()}
        ).drop(SLICE)

    counted = out if earlier is not None else out.filter(F.col(SLICE) != WHOLE)
    sums = counted.groupBy(SLICE, *keys).agg(
        *[column.alias(name) for name, column in summary.items()]
    )
    if earlier is not None:
        sums = sums.unionByName(earlier.withColumn(SLICE, F.lit(EARLIER).cast("bigint")))
    known = F.lit(False)
    for name in carry_columns:
        known = known | F.col(name).isNotNull()
    carries = carry(sums, Window.partitionBy(*keys).orderBy(SLICE))
    carries = carries.filter(known & (F.col(SLICE) != EARLIER))
    carries = _other(carries.select(SLICE, *keys, *carry_columns), [SLICE, *keys])
    if earlier is None:
        # A slice boundary lies inside one key at most: no more rows than slices.
        carries = F.broadcast(carries)
    joined = out.join(carries, _same([SLICE, *keys]), "left")
    return joined.drop(SLICE, *[_OTHER + name for name in [SLICE, *keys]])
