"""The physical plans, where a change in shape would be a change in cost."""

import re

import pytest
from conftest import message, messages_frame

from tidegauge.operators.median import weighted_median
from tidegauge.operators.parse import parse_events
from tidegauge.operators.windows import value_counts
from tidegauge.plans import event_table
from tidegauge.plans.sensor_stats import enriched_events
from tidegauge.session import written

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def counts_plan(spark, device_types, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("m") / "messages")
    messages_frame(spark, [message()] * 3).write.text(path)
    counts = value_counts(enriched_events(spark.read.text(path), device_types))
    return counts._jdf.queryExecution().executedPlan().toString()


def test_messages_are_parsed_once(counts_plan):
    # The second parse is the fallback for bare literals, inside the same expression.
    assert len(re.findall(r"parseJson", counts_plan)) == 2
    assert len(re.findall(r"Generate explode", counts_plan)) == 1
    assert "RLIKE" in counts_plan


def test_no_python_between_source_and_result(counts_plan):
    assert "Python" not in counts_plan and "Pandas" not in counts_plan and "Arrow" not in counts_plan


def test_events_are_shuffled_once_after_partial_aggregation(counts_plan):
    assert counts_plan.count("Exchange hashpartitioning") == 1
    assert counts_plan.count("BroadcastExchange") == 1
    shuffle = counts_plan.index("Exchange hashpartitioning")
    partial = counts_plan.index("partial_count")
    assert shuffle < partial  # deeper in the tree, so before the shuffle
    assert re.search(r"Exchange hashpartitioning\(window#\d+, device_type#\d+, humidity#\d+", counts_plan)


def test_median_of_sorted_groups_is_one_shuffle_and_one_sort(spark):
    counts = written(spark.sql("SELECT 'g' AS g, 1D AS v, 1L AS n"))
    plan = weighted_median(counts, ["g"], "v", "n")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert plan.count("Sort [") == 1


def test_only_needed_columns_are_read(spark):
    events = event_table.to_events(event_table.read_events(spark, FOLDER)).select("event_time", "temperature")
    plan = events._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<ts:timestamp_ntz,value:double>" in plan


def test_the_parse_is_compiled_by_the_jvm(spark):
    """No generated method reaches the 8000 bytes above which the JVM only interprets it."""
    generator = getattr(spark._jvm.org.apache.spark.sql.catalyst.expressions.codegen, "CodeGenerator$")
    stage = parse_events(spark.range(1).selectExpr("string(id) AS value"))._jdf.queryExecution().executedPlan()
    compiled = getattr(generator, "MODULE$").compile(stage.doCodeGen()._2())
    assert compiled._2().maxMethodCodeSize() < 8000


def test_large_groups_only_shuffle_their_middle_range(spark):
    counts = written(spark.sql("SELECT id % 2 AS g, CAST(id AS DOUBLE) AS v, 1L AS n FROM range(100)"))
    result = weighted_median(counts, ["g"], "v", "n", large_group=10, range_rows=10)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan
    # Leaving out the large groups, and picking their middle ranges before the only shuffle of rows.
    assert plan.count("BroadcastHashJoin") == 2
    rows_shuffled = re.search(r"Exchange hashpartitioning\(g#\d+L, _range#\d+, \d+\)", plan)
    assert rows_shuffled.start() < plan.index("_middle#", rows_shuffled.end())
