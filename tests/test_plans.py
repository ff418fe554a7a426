"""Plan properties of every registered query (the scale rules, checked on the physical plan)."""

import pytest

from cairn.plans.queries import QUERIES
from frames import SF_SMALL

TOPK = ["frequency_topk", "composite_frequency_topk", "distinct_then_count_topk", "topk_multi_measure", "bottomk",
        "participation_topk"]
PUSHED = ["select_filter_eq", "filter_or_and", "filter_in_list", "filter_between_ne", "filter_contains_distinct",
          "category_counts", "welch_t"]


def _plan(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_or_nested_loop_joins(spark, name):
    plan = _plan(spark, name)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", TOPK)
def test_topk_is_take_ordered(spark, name):
    assert "TakeOrderedAndProject" in _plan(spark, name)


@pytest.mark.parametrize("name", PUSHED)
def test_filters_reach_the_scan(spark, name):
    plan = _plan(spark, name)
    assert "PushedFilters: [" in plan and "PushedFilters: []" not in plan


@pytest.mark.parametrize("name", ["dedupe_first", "dense_rank_within", "category_table_ranked", "append_with_lookup"])
def test_no_unreduced_window_over_input_rows(spark, name):
    plan = _plan(spark, name)
    if name in ("dedupe_first", "append_with_lookup"):
        # keep-first windows are limited per key on the map side before the shuffle
        assert "WindowGroupLimit" in plan and "Partial" in plan
    else:
        # ranks are joined back; no window sees the rows
        assert "Window" not in plan and "Join" in plan


def test_anova_scans_its_input_once_and_pushes_its_filter(spark):
    from cairn.operators.stats import group_summary

    # the result reads the kept group table only; the one scan is that table's
    plan = _plan(spark, "anova_subset")
    assert "parquet" not in plan and "ExistingRDD" in plan
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    once = group_summary(events.where("event_type IN ('view', 'click')"), "value", "event_type")
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "PushedFilters: [In(event_type" in plan


def test_anova_reads_a_replaced_file_anew(spark):
    from cairn.operators.stats import anova_oneway
    from cairn.session import scratch_path

    path = scratch_path(spark, "t-anova")
    write = lambda k: (spark.range(60).selectExpr("id % 3 AS g", f"double(id % 3) * {k} + double(id % 7) AS x")
                       .write.mode("overwrite").parquet(path))
    write(0)
    low = anova_oneway(spark.read.parquet(path), "x", "g").first().f
    write(100)
    spark.catalog.refreshByPath(path)
    assert anova_oneway(spark.read.parquet(path), "x", "g").first().f > 1000 * low


def test_small_group_means_do_not_shuffle_the_rows(spark):
    from cairn.operators.combine import broadcast_if_small, null_safe_join

    # the join of check_assumptions; its result is kept before the test's final plan
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    means = events.groupBy("event_type").agg({"value": "avg"})
    plan = null_safe_join(events, broadcast_if_small(means), ["event_type"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_no_query_leaves_a_cached_frame(spark):
    spark.catalog.clearCache()
    for name in ("anova_long", "lookup_enrich", "dense_rank_within", "category_table_ranked", "append_with_lookup",
                 "assumption_checks"):
        QUERIES[name](spark, SF_SMALL).collect()
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()
