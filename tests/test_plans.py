"""Physical plans: what is shuffled, pushed down, compiled and computed once."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from logintake.functions import timestamps as ts
from logintake.operators.chunk import chunk_messages
from logintake.operators.parse import parse_syslog
from logintake.operators.report import error_report
from logintake.operators.route import Processor, Processors, processor_tables, route_first_match
from logintake.plans.intake import parse_lines
from logintake.plans.tables import by_day
from logintake.sources.spool import list_spool, read_spool
from workload.render import mixed_lines


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def largest_method(df):
    stages = df._jdf.queryExecution().debug().codegenToSeq()
    return max(stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size()))


@pytest.fixture(scope="module")
def lines(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lines") / "lines")
    mixed_lines(spark, "/root/testdata/sf0.001", "user_id").write.parquet(path)
    return spark.read.parquet(path)


def test_parsing_is_one_narrow_compiled_stage(lines):
    parsed = parse_syslog(lines)
    text = plan(parsed)
    assert "Exchange" not in text and "Python" not in text
    assert all("*(1)" in row for row in text.splitlines()[:20])
    # The JVM compiles no method of more than 8000 bytes.
    assert largest_method(parsed) < 8000


def test_a_filter_on_the_error_code_does_not_repeat_the_parser(lines):
    text = plan(parse_syslog(lines).filter("error_code IS NULL").select("hostname", "data"))
    assert text.count("regexp_extract") == 2
    assert "Filter isnull(__code" in text


def test_filters_and_columns_reach_the_scan(lines):
    text = plan(parse_syslog(lines).filter("user_id = 3 AND error_code IS NULL").select("data"))
    assert "PushedFilters: [IsNotNull(user_id), EqualTo(user_id,3)]" in text
    assert "ReadSchema: struct<user_id:bigint,line:string>" in text


def test_escapes_do_not_repeat_either(lines):
    text = plan(parse_lines(lines, "line").filter("error_code IS NOT NULL").select("raw"))
    assert text.count("regexp_extract_all") <= 2


def test_routes_are_narrow(lines):
    chain = Processors(Processor("click", F.col("process") == "click")).with_catch_all()
    routed = route_first_match(parse_syslog(lines), chain)
    for table in processor_tables(routed, chain).values():
        assert "Exchange" not in plan(table)
        assert plan(table).count("regexp_extract") == 2


def test_counts_are_combined_before_the_shuffle(lines):
    text = plan(error_report(parse_syslog(lines)))
    assert text.index("partial_count") > text.index("Exchange hashpartitioning(error_code")


def test_chunks_of_ordinary_senders_take_one_shuffle(events):
    out = chunk_messages(
        events.select("user_id", "ts", "event_id"), "user_id", "ts", "event_id",
        dt.timedelta(hours=1), 10,
    )
    text = plan(out)
    assert text.count("Exchange") == 1 and text.count("Sort [") == 1
    assert "Exchange hashpartitioning(user_id" in text and "Python" not in text


def test_days_are_rebalanced(lines):
    text = plan(by_day(parse_syslog(lines).filter("error_code IS NULL")))
    assert "REBALANCE_PARTITIONS_BY_COL" in text


def test_spool_filters_select_files(spark, tmp_path):
    for n in range(3):
        (tmp_path / f"{n:016x}.00000001.log").write_text("x\n")
    lines = read_spool(spark, str(tmp_path)).filter(F.col("file_name") <= f"{0:016x}.00000001.log")
    lines.collect()
    scan = lines._jdf.queryExecution().executedPlan()
    assert "file_name" in scan.toString()
    metrics = lines.select(F.input_file_name()).distinct().count()
    assert metrics == 1
    text = plan(list_spool(spark, str(tmp_path)))
    assert "content" not in text.split("ReadSchema")[1]


def test_layouts_need_few_characters():
    assert ts.HEAD_CHARS == len("2024-12-31T23:59:58.123456789+01:00") + 1
