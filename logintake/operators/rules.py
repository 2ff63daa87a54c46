"""Accept/reject rules as a table, for more rules than an expression can hold.

A wildcard is split at its first and last * or ?: it begins with a literal text and ends
with one. Of rules with the same wildcard only the first counts. A rule is found by the
longer of its two texts, and by as much of the other as a power of two holds. So of each
distinct value those beginnings and ends are looked up that are as long as some rule's.
What is found is compared with the whole wildcard, and the rule with the smallest number
wins. A rule without any wildcard is its own beginning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logintake.operators.route import ACCEPT, REJECT
from logintake.session import written

def _part(length):
    """The largest power of two up to a length; 0 of nothing."""
    return F.when(length > 0, F.pow(F.lit(2), F.floor(F.log2(length))).cast("int")).otherwise(0)


def split_rules(rules: DataFrame, number: str = "number", wildcard: str = "wildcard", action: str = "action") -> DataFrame:
    """One row per wildcard, of its first rule: ``number, action``, the LIKE ``pattern``, the
    literal texts ``head`` and ``tail``, how much of them the rule is found by (``n_head``
    and ``n_tail``), the only ``size`` of a value that it matches (null with a *), and
    whether texts and size alone decide (``sure``)."""
    rule = F.col("wildcard")
    first = F.min(F.struct(F.col(number).cast("long").alias("number"), F.col(action).alias("action"))).alias("first")
    rules = rules.groupBy(F.col(wildcard).alias("wildcard")).agg(first)
    head = F.regexp_extract(rule, r"^[^*?]*", 0)
    # All of a rule without wildcards is its beginning.
    tail = F.when(head == rule, "").otherwise(F.regexp_extract(rule, r"[^*?]*\z", 0))
    pattern = F.translate(F.regexp_replace(rule, r"([\\%_])", r"\\$1"), "*?", "%_")
    begins, ends = F.length("head"), F.length("tail")
    return rules.select(
        "first.number", "first.action", pattern.alias("pattern"), head.alias("head"), tail.alias("tail"),
        F.when(~F.contains(rule, F.lit("*")), F.length(rule)).alias("size"),
        ((rule == head) | (rule == F.concat(head, F.lit("*"), tail))).alias("sure"),
    ).withColumns({
        "n_head": F.when(ends > begins, _part(begins)).otherwise(begins),
        "n_tail": F.when(ends > begins, ends).otherwise(_part(ends)),
    })


def table_actions(
    df: DataFrame, col: str, rules: DataFrame, default: str = REJECT, name: str = "action",
    rule_cols: tuple[str, str, str] = ("number", "wildcard", "action"),
) -> DataFrame:
    """Add the action of the rule with the smallest number whose wildcard matches ``col``.

    ``rules`` holds a number, a wildcard with * and ?, and accept or reject; a rule without
    number or wildcard is none, and of equal numbers the smaller wildcard wins. A null value
    matches nothing and gets ``default``, as one that no rule matches.

    Rules are matched with the distinct values. One that begins and ends with a wildcard has
    no text to be found by and is compared with all of them.
    """
    number, wildcard, action = rule_cols
    known = rules.filter(F.col(number).isNotNull() & F.col(wildcard).isNotNull())
    wrong = known.filter(F.col(action).isNull() | ~F.col(action).isin(ACCEPT, REJECT)).first()
    if wrong is not None:
        raise ValueError(f"unknown action {wrong[action]!r}, expected accept or reject")
    split = written(split_rules(known, number, wildcard, action))
    # Lengths of what rules are found by: as many as there are different ones, at most the
    # length of the longest rule times its logarithm, whatever the number of rules.
    sizes = split.select("n_head", "n_tail").distinct().collect()
    if not sizes:
        return df.withColumn(name, F.lit(default))
    values = written(df.select(F.col(col).alias("value")).filter(F.col(col).isNotNull()).distinct())
    lengths = F.explode(F.array(*[F.struct(F.lit(r.n_head).alias("n_head"), F.lit(r.n_tail).alias("n_tail")) for r in sizes]))
    value = F.col("value")
    looked = values.select("value", F.length("value").alias("length"), lengths.alias("n")).select("value", "length", "n.*")
    looked = looked.filter("n_head + n_tail <= length").withColumns(
        {"begin": F.left(value, F.col("n_head")), "end": F.right(value, F.col("n_tail"))}
    )
    own = split.withColumns(
        {"begin": F.left("head", F.col("n_head")), "end": F.right("tail", F.col("n_tail"))}
    )
    hit = looked.join(own, ["n_head", "n_tail", "begin", "end"])
    hit = hit.filter(F.expr("size = length OR size IS NULL AND length(head) + length(tail) <= length"))
    hit = hit.filter(value.startswith(F.col("head")) & value.endswith(F.col("tail")))
    hit = hit.filter(F.col("sure") | F.expr("value LIKE pattern"))
    first = F.min(F.struct("number", "pattern", "action"))
    best = written(hit.groupBy("value").agg(first.alias("rule")).select(
        F.col("value").alias("_value"), F.col("rule.action").alias("_action")
    ))
    # The rows on the left: a value that most of them have can then be split.
    out = df.join(best, F.col(col) == F.col("_value"), "left")
    return out.withColumn(name, F.coalesce("_action", F.lit(default))).drop("_value", "_action")


def table_filter(df: DataFrame, col: str, rules: DataFrame, default: str = REJECT) -> DataFrame:
    """Rows that a table of rules accepts."""
    out = table_actions(df, col, rules, default, "_rule_action")
    return out.filter(F.col("_rule_action") == ACCEPT).drop("_rule_action")
