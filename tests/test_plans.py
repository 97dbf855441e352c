"""The physical plans that matter at scale."""

import __spark_entry__ as entry_point
import pytest
from bench import WRITING
from helpers import series

from candlewick.operators.features import add_features
from candlewick.operators.series import hot_symbols
from candlewick.plans import catalog

SF_DIR = "/root/testdata/sf0.001"


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def final_plan(frame):
    frame.collect()
    return plan(frame).split("== Initial Plan ==")[0]


def query_plan(spark, name):
    return plan(entry_point.queries()[name](spark, SF_DIR))


def test_one_shuffle_serves_both_window_features(spark):
    text = query_plan(spark, "transform_full")
    assert text.count("Exchange hashpartitioning") == 2  # the bars, then the series
    assert text.count("Window [") == 1


@pytest.mark.parametrize("name", ["lookback_sessions", "lookback_copies", "dedupe_latest"])
def test_ranks_are_limited_before_the_shuffle(spark, name):
    text = query_plan(spark, name)
    assert "Partial" in text and text.count("WindowGroupLimit") >= 2


def test_scans_read_only_needed_columns(spark):
    text = query_plan(spark, "distinct_symbols")
    assert "ReadSchema: struct<o_orderpriority:string>" in text


def test_preview_is_a_top_k(spark):
    assert "TakeOrderedAndProject" in query_plan(spark, "preview_rows")


def test_without_hot_symbols_only_the_plain_window_runs(spark):
    frame = add_features(series(spark, range(1, 30)))
    assert "Join" not in plan(frame)
    text = final_plan(frame)
    assert text.count("Window [") == 1
    assert "xxhash64" not in text
    assert hot_symbols(series(spark, [1, 2])).isEmpty()


def test_no_python_and_no_cross_join(spark):
    for name, query in catalog.queries().items():
        if name in WRITING:
            continue
        text = plan(query(spark, SF_DIR))
        for operator in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "Pandas"):
            assert operator not in text, name
