"""Rules as a table against rules one after the other."""

import random
import re

import pytest
from pyspark.sql import functions as F

from logintake.operators.route import rule_action
from logintake.operators.rules import split_rules, table_actions, table_filter

RULES = "number long, wildcard string, action string"


def first_match(value: str | None, rules: list[tuple], default: str = "reject") -> str:
    for _, wildcard, action in sorted(r for r in rules if r[0] is not None and r[1] is not None):
        pattern = "".join({"*": ".*", "?": "."}.get(c, re.escape(c)) for c in wildcard)
        if value is not None and re.fullmatch(pattern, value, re.S):
            return action
    return default


def drawn(n: int, seed: int) -> list[tuple]:
    draw = random.Random(seed)
    part = lambda: "".join(draw.choice("ab%_\\é.") for _ in range(draw.randint(0, 3)))
    made = lambda: draw.choice(["", part()]) + draw.choice(["", "*", "?", "*?", "**"]) + draw.choice(["", part()]) + draw.choice(["", "*"])
    return [(i, made(), draw.choice(["accept", "reject"])) for i in draw.sample(range(10 * n), n)]


@pytest.mark.parametrize("n", [0, 1, 12, 300])
def test_rules(spark, n):
    draw = random.Random(n)
    values = ["".join(draw.choice("ab%_\\é.\n") for _ in range(draw.randint(0, 6))) for _ in range(300)] + [None, "", "*", "?"]
    rules = drawn(n, n) + [(None, "*", "accept"), (1, None, "accept")]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)] * 2, "cn string, number int")
    table = spark.createDataFrame(rules, RULES)
    got = table_actions(df, "cn", table, "accept", "act")
    assert got.columns == ["cn", "number", "act"] and got.count() == len(values) * 2
    assert {(r.number, r.act) for r in got.collect()} == {(i, first_match(v, rules, "accept")) for i, v in enumerate(values)}
    kept = {r.number for r in table_filter(df, "cn", table).collect()}
    assert kept == {i for i, v in enumerate(values) if first_match(v, rules) == "accept"}


def test_five_thousand_rules(spark):
    """As the plain expression decides, rule by rule."""
    draw = random.Random(5)
    rules = []
    for i in range(5000):
        k = draw.randint(0, 4000)
        kind = draw.choice([f"zone-{k}", f"zone-{k}?", f"zone-{k}*", f"*-{k}", f"?one-*{k}", f"zone-{k // 100}*{k % 10}"])
        rules.append((i, kind, draw.choice(["accept", "reject"])))
    df = spark.range(3000).select(F.concat(F.lit("zone-"), F.col("id") * 2).alias("cn"))
    got = {r.cn: r.action for r in table_actions(df, "cn", spark.createDataFrame(rules, RULES)).collect()}
    compiled = [(re.compile("".join({"*": ".*", "?": "."}.get(c, re.escape(c)) for c in w)), a) for _, w, a in rules]
    for cn, action in got.items():
        assert action == next((a for p, a in compiled if p.fullmatch(cn)), "reject"), cn
    # A few hundred of them also as the expression itself.
    some = rules[:200]
    plain = df.select("cn", rule_action(F.col("cn"), [r[1:] for r in some]).alias("action"))
    by_table = table_actions(df, "cn", spark.createDataFrame(some, RULES))
    assert plain.exceptAll(by_table).isEmpty() and by_table.count() == 3000


def test_unknown_action(spark):
    df, rules = spark.createDataFrame([("a",)], "cn string"), spark.createDataFrame([(1, "a", "keep")], RULES)
    with pytest.raises(ValueError, match="keep"):
        table_actions(df, "cn", rules)


def test_rules_are_found_by_both_their_texts(spark):
    """Rules that share their longer text, and such that come many times."""
    df = spark.range(400).select(F.concat(F.lit("zone-"), "id").alias("cn"))
    rules = spark.range(4000).select(
        (4000 - F.col("id")).alias("number"),
        F.concat(F.lit("zone-*"), F.col("id") % 500).alias("wildcard"),
        F.when(F.col("id") % 3 == 0, "accept").otherwise("reject").alias("action"),
    )
    split = split_rules(rules)
    assert split.count() == 500
    assert split.groupBy(F.left("head", F.col("n_head")), F.right("tail", F.col("n_tail"))).count().agg(F.max("count")).first()[0] <= 40
    rows = sorted(map(tuple, rules.collect()))
    got = {r.cn: r.action for r in table_actions(df, "cn", rules).collect()}
    ends = {}
    for _, wildcard, action in rows:
        ends.setdefault(wildcard[6:], action)
    for cn, action in got.items():
        number = {w: n for n, w, _ in reversed(rows)}
        mine = [w for w in ends if cn[5:].endswith(w)]
        assert action == (ends[min(mine, key=lambda w: number[f"zone-*{w}"])] if mine else "reject"), cn
