import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from logintake.operators.parse import MESSAGE_COLUMNS, parse_syslog
from logintake.operators.report import error_lines, error_report, observed
from logintake.operators.route import (
    Processor,
    Processors,
    catch_all,
    ending_in_catch_all,
    error_rows,
    processor_tables,
    route_first_match,
    rule_action,
    rule_filter,
    valid_messages,
)

LINES = [
    "<13>2024-01-01T00:00:00Z a sshd[1]: failed login",
    "<14>2024-01-01T00:00:01Z b cron: started",
    "<13>2024-01-01T00:00:02Z c sshd[2]: accepted",
    "no message",
    "<x>",
]


@pytest.fixture(scope="module")
def messages(spark):
    return parse_syslog(spark.createDataFrame([(line,) for line in LINES], "line string"))


def test_each_line_goes_to_one_side(messages):
    assert valid_messages(messages).columns == MESSAGE_COLUMNS
    assert valid_messages(messages).count() == 3
    at = dt.datetime(2024, 5, 5)
    errors = error_rows(messages, F.lit(at)).orderBy("data").collect()
    assert [tuple(r) for r in errors] == [(at, "<x>"), (at, "no message")]


def test_first_processor_wins_and_order_matters(messages):
    login = Processor("login", F.col("data").contains("login"))
    sshd = Processor("sshd", F.col("process") == "sshd")
    for chain, want in (
        ([login, sshd], {"login": 1, "sshd": 1, "syslog": 1, "errors": 2}),
        ([sshd, login], {"sshd": 2, "syslog": 1, "errors": 2}),
    ):
        routed = route_first_match(messages, Processors(*chain).with_catch_all())
        assert {r.route: r["count"] for r in routed.groupBy("route").count().collect()} == want


def test_every_chain_ends_in_the_catch_all(messages):
    sshd = Processor("sshd", F.col("process") == "sshd")
    for chain in ([sshd], [catch_all(), sshd], Processors(sshd)):
        assert [p.name for p in ending_in_catch_all(chain)] == ["sshd", "syslog"]
    assert [p.name for p in ending_in_catch_all(None)] == ["syslog"]
    chain = ending_in_catch_all([sshd])
    routed = route_first_match(valid_messages(messages), chain)
    assert [t.count() for t in processor_tables(routed, chain).values()] == [2, 1]


def test_rewrite_reaches_later_processors_only(messages):
    chain = Processors(
        Processor("first", F.col("hostname") == "a"),
        Processor("never", F.lit(False), rewrite={"hostname": F.upper("hostname")}),
        Processor("second", F.col("hostname") == "B"),
    ).with_catch_all()
    routed = route_first_match(messages, chain).filter("error_code IS NULL")
    got = {(r.hostname, r.route) for r in routed.collect()}
    assert got == {("a", "first"), ("B", "second"), ("C", "syslog")}


def test_python_code_in_a_processor(messages):
    @pandas_udf("boolean")
    def short(data: pd.Series) -> pd.Series:
        return data.str.len() < 9

    chain = Processors(Processor("short", short("data"))).with_catch_all()
    rows = processor_tables(route_first_match(messages, chain), chain)["short"]
    assert {r.data for r in rows.collect()} == {"started", "accepted"}


def test_processors_of_one_table_are_put_together(messages):
    chain = Processors(
        Processor("one", F.col("hostname") == "a", lambda d: d.select("data"), table="t"),
        Processor("two", F.col("hostname") == "b", lambda d: d.select("data"), table="t"),
    ).with_catch_all()
    tables = processor_tables(route_first_match(messages, chain), chain)
    assert list(tables) == ["t", "syslog"]
    assert tables["t"].count() == 2


@pytest.mark.parametrize("name", ["syslog", "errors", "mine"])
def test_names_are_unique(name):
    chain = Processors(Processor("mine", F.lit(True))) if name == "mine" else Processors()
    with pytest.raises(ValueError):
        chain.register(Processor(name, F.lit(True)))


def test_rules(spark):
    names = ["log-zone-75", "log-zone-7", "log-zone-", "other", "a%b", "axb", "a_c", "a\\c", "A", ""]
    df = spark.createDataFrame([(n,) for n in names] + [(None,)], "cn string")
    rules = [("log-zone-75", "reject"), ("log-zone-*", "accept"), ("a%?", "accept"), ("a\\*", "accept")]
    got = {r.cn for r in rule_filter(df, "cn", rules).collect()}
    assert got == {"log-zone-7", "log-zone-", "a%b", "a\\c"}
    assert rule_filter(df, "cn", rules, default="accept").count() == len(names)
    assert rule_filter(df, "cn", [("*", "accept")]).count() == len(names)
    assert rule_filter(df, "cn", []).count() == 0
    with pytest.raises(ValueError):
        rule_action(F.col("cn"), [("*", "allow")])


def test_reports(messages):
    report = {r.error_code: r.lines for r in error_report(messages).collect()}
    assert report == {1: 1, 3: 1}
    assert {(r.error_code, r.raw) for r in error_lines(messages).collect()} == {
        (1, "no message"), (3, "<x>"),
    }


def test_observed_numbers(spark, messages):
    from pyspark.sql import Observation

    seen = Observation("seen")
    observed(messages, seen, by_code=True).write.format("noop").mode("overwrite").save()
    numbers = seen.get
    assert (numbers["lines"], numbers["errors"], numbers["error_1"], numbers["error_8"]) == (5, 2, 1, 0)


def test_names_in_a_plain_list(spark):
    """A list is held to the same names as a chain; the catch-all is there once."""
    mine = Processor("mine", F.lit(False))
    names = lambda chain: [p.name for p in ending_in_catch_all(chain)]
    assert names(None) == names([]) == ["syslog"]
    assert names([mine]) == names(Processors(mine).with_catch_all()) == ["mine", "syslog"]
    for name in ("syslog", "errors", "mine"):
        with pytest.raises(ValueError, match="taken"):
            ending_in_catch_all([mine, Processor(name, F.lit(True))])
