"""Plans that must keep their shape: no cartesian products, ranks limited before the shuffle."""

import os

import pytest

import __spark_entry__ as registered

SMALL = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the driver's tables")
@pytest.mark.parametrize("name", sorted(registered.queries()))
def test_no_query_pairs_rows_without_a_key(spark, name):
    plan = plan_of(registered.queries()[name](spark, SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the driver's tables")
@pytest.mark.parametrize("name", ["daily_last_wins", "newest_detail", "sample_per_group", "canonical_spelling"])
def test_kept_ranks_are_limited_before_the_shuffle(spark, name):
    plan = plan_of(registered.queries()[name](spark, SMALL))
    assert plan.count("WindowGroupLimit") >= 2


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the driver's tables")
def test_scans_read_only_what_they_need(spark):
    plan = plan_of(registered.queries()["daily_last_wins"](spark, SMALL))
    assert "props" not in plan and "value" not in plan.split("FileScan")[1].split("Batched")[0]
    funnel = plan_of(registered.queries()["funnel_events"](spark, SMALL))
    assert "description" not in funnel.replace("has_description", "").replace("with_description", "")
    assert funnel.count("FileScan") == 2
