"""Preference formatting of chosen and rejected conversations.

Both conversations of a pair are turned into numbered turns. The longest common prefix of
turns is rendered once, as the prompt; what follows is rendered for each side as its
completion, with a mask that tells which characters are trained on.

The result has one row per rendered turn, and no step gathers a conversation: turns are
numbered by counting those before them in sorted ranges, compared by a join on (pair,
number), and the first difference is a minimum. So a conversation may hold any share of
all turns. Column expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logintake.session import written

# The template of a turn, and the role whose text is trained on.
OPEN, MIDDLE, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"
TRAINED = "assistant"


def numbered(turns: DataFrame, keys: list[str], order: list[str], number: str) -> DataFrame:
    """The rows with their place, from 0, among those of the same keys.

    Rows are dealt into sorted ranges, so the rows of one key may lie in many; each range
    counts its rows per key, and the counts of earlier ranges are added. The ranges are a
    written table: sampled bounds cannot move when a task is repeated.
    """
    ranged = turns.repartitionByRange(*keys, *order).withColumn("range", F.spark_partition_id())
    ranged = written(ranged)
    within = Window.partitionBy("range", *keys).orderBy(*order)
    local = ranged.withColumn("place", F.row_number().over(within))
    counts = ranged.groupBy("range", *keys).agg(F.count(F.lit(1)).alias("n"))
    # One row per range and key; a key has at most as many as there are ranges.
    before = Window.partitionBy(*keys).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    counts = written(counts.filter("before > 0"))
    joined = local.join(counts, ["range", *keys], "left")
    place = F.col("place") - 1 + F.coalesce(F.col("before"), F.lit(0))
    return joined.withColumn(number, place.cast("long")).drop("range", "place", "before")


def _turns(turns: DataFrame, pair_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    rows = turns.select(
        F.col(pair_col).cast("long").alias("pair_id"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    ).filter(F.col("pair_id").isNotNull())
    # A turn that is repeated as a whole is one turn.
    rows = rows.withColumns({"h1": F.xxhash64("role", "text"), "h2": F.xxhash64(F.lit(2), "role", "text")})
    return numbered(rows.distinct(), ["pair_id"], ["turn", "h1", "h2"], "number")


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), role, F.lit(MIDDLE), text, F.lit(CLOSE))


def preference_turns(
    chosen: DataFrame,
    rejected: DataFrame,
    pair_col: str = "pair_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    trained: str = TRAINED,
) -> DataFrame:
    """One row per rendered turn: ``pair_id, part, number, role, rendered, mask_start,
    mask_end``.

    ``part`` is "prompt" for the longest common prefix of turns, which is there once, and
    "chosen" or "rejected" for the turns after it. Turns are equal if role and text are.
    ``number`` counts the turns of a conversation from 0 in the order of ``turn``, a null
    first and equal ones by a hash of their content; a turn repeated as a whole counts
    once. Characters ``mask_start`` up to ``mask_end`` are trained on: text and end mark of
    the trained role in a completion. Elsewhere both are 0.

    A null role or text is empty. Turns without pair are in no conversation. A pair of
    which one side has no turns has no prompt, and a side that goes on where the other
    ends is a completion. No rows give no rows.
    """
    own = [_turns(t, pair_col, turn_col, role_col, text_col) for t in (chosen, rejected)]
    own = [written(t.drop("turn")) for t in own]
    keys = [t.select("pair_id", "number", F.struct("role", "text").alias("content")) for t in own]
    both = keys[0].withColumnRenamed("content", "one").join(
        keys[1].withColumnRenamed("content", "other"), ["pair_id", "number"], "full"
    )
    # The first number at which the sides differ or one has ended.
    differs = both.filter(~F.col("one").eqNullSafe(F.col("other")))
    prefix = written(differs.groupBy("pair_id").agg(F.min("number").alias("common")))
    parts = []
    for side, turns in zip(("chosen", "rejected"), own):
        # Two equal conversations differ nowhere: all of it is prompt.
        placed = turns.join(prefix, "pair_id", "left")
        in_prompt = F.col("common").isNull() | (F.col("number") < F.col("common"))
        placed = placed.withColumn("part", F.when(in_prompt, "prompt").otherwise(side))
        parts.append(placed.filter(F.col("part") != "prompt") if side == "rejected" else placed)
    learns = (F.col("part") != "prompt") & (F.col("role") == trained)
    head = F.length(F.concat(F.lit(OPEN), F.col("role"), F.lit(MIDDLE)))
    mark = F.length(F.lit(CLOSE.rstrip("\n")))
    return parts[0].unionByName(parts[1]).select(
        "pair_id", "part", "number", "role",
        rendered(F.col("role"), F.col("text")).alias("rendered"),
        F.when(learns, head).otherwise(0).cast("long").alias("mask_start"),
        F.when(learns, head + F.length("text") + mark).otherwise(0).cast("long").alias("mask_end"),
    )


def preference_pairs(turns: DataFrame) -> DataFrame:
    """One row per pair: ``pair_id, prompt, chosen, rejected`` and, for each completion, its
    trained spans ``(start, stop)`` in characters. For conversations that each fit into a
    task's memory, which this gathers; ``preference_turns`` gathers none."""
    each = turns.groupBy("pair_id", "part").agg(
        F.sort_array(F.collect_list(F.struct("number", "rendered", "mask_start", "mask_end"))).alias("all")
    )
    start = F.lit(0).cast("long")
    state = F.struct(start.alias("at"), F.array().cast("array<struct<start:long,stop:long>>").alias("spans"))
    spans = F.aggregate(
        "all", state,
        lambda s, t: F.struct(
            (s["at"] + F.length(t["rendered"])).alias("at"),
            F.when(
                t["mask_end"] > 0,
                F.concat(s["spans"], F.array(F.struct(
                    (s["at"] + t["mask_start"]).alias("start"), (s["at"] + t["mask_end"]).alias("stop")
                ))),
            ).otherwise(s["spans"]).alias("spans"),
        ),
        lambda s: s["spans"],
    )
    each = each.select("pair_id", "part", F.array_join(F.col("all.rendered"), "").alias("text"), spans.alias("spans"))

    def of(part: str, column: str) -> Column:
        return F.first(F.when(F.col("part") == part, F.col(column)), ignorenulls=True)

    return each.groupBy("pair_id").agg(
        *[F.coalesce(of(p, "text"), F.lit("")).alias(p) for p in ("prompt", "chosen", "rejected")],
        *[of(p, "spans").alias(f"{p}_spans") for p in ("chosen", "rejected")],
    )
