"""Physical-plan properties that matter at scale."""

import pytest

import __spark_entry__ as ent
from labelloop.operators.dedup import last_per_key
from labelloop.plans import fixtures as fx


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_pruned_scan_reads_one_column(spark, sf_dir):
    plan = _plan(ent.queries()["a2_pruned_scan"](spark, sf_dir))
    assert "ReadSchema: struct<ts:timestamp_ntz>" in plan


def test_dedupe_is_a_partial_aggregate_not_a_window(spark, sf_dir):
    df = last_per_key(fx.pred_log(spark, sf_dir), ["location", "target_date"], ["logged_at", "event_id"])
    plan = _plan(df)
    assert "partial_max_by" in plan and "Window" not in plan


def test_per_group_top_k_limits_before_shuffle(spark, sf_dir):
    from labelloop.operators.neighbours import _compact
    points = fx.table(spark, sf_dir, "embeddings")
    assert "WindowGroupLimit" in _plan(_compact(points, "vec_id", "embedding", 3))


def test_cutoff_is_a_scalar_subquery(spark, sf_dir):
    plan = _plan(ent.queries()["c4_scalar_cutoff"](spark, sf_dir))
    assert "Subquery" in plan
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


@pytest.mark.parametrize("name", sorted(ent.oracle_sql()))
def test_no_cartesian_products(spark, sf_dir, name):
    plan = _plan(ent.queries()[name](spark, sf_dir))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
