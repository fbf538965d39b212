"""The executed plans keep the shape the design relies on.

Each query is collected, and the plan is read from that execution: the final
adaptive plan.
"""

import pytest

from cellflux import catalog
from conftest import SF_SMALL

QUERIES = catalog.queries()


def executed_plan(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "AdaptiveSparkPlan" not in plan or "isFinalPlan=true" in plan
    return plan


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_nested_loop_or_cartesian_join(spark, name):
    plan = executed_plan(spark, name)
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan, plan


def test_mass_join_is_a_broadcast_hash_join(spark):
    plan = executed_plan(spark, "count_to_mass")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_road_inventory_aggregates_partially_before_its_shuffle(spark):
    plan = executed_plan(spark, "road_inventory")
    assert "partial_sum" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint>" in plan


def test_nearest_index_needs_no_hash_shuffle(spark):
    plan = executed_plan(spark, "nearest_axis_index")
    assert "hashpartitioning" not in plan
    assert plan.count("BroadcastHashJoin") >= 8  # four lookups per axis


def test_point_in_polygon_sums_edges_before_it_shuffles(spark):
    plan = executed_plan(spark, "points_in_polygons")
    assert "REPARTITION_BY" not in plan and "partial_sum" in plan


@pytest.mark.parametrize("name", ["industry_overlay_area", "site_overlay_area", "site_cells"])
def test_polygon_clip_stays_in_the_jvm(spark, name):
    plan = executed_plan(spark, name)
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("name", ["sum_with_representative", "run_report"])
def test_no_sort_aggregate(spark, name):
    assert "SortAggregate" not in executed_plan(spark, name)


def test_newest_row_is_found_by_a_hash_aggregate(spark):
    plan = executed_plan(spark, "latest_reading")
    assert "max_by" not in plan and "partial_max" in plan and "LeftSemi" in plan


def test_merge_has_one_aggregate_on_the_field_keys(spark):
    plan = executed_plan(spark, "merge_region_into_field")
    assert "Union" in plan and "FullOuter" not in plan


def test_observation_filters_reach_the_scan(spark):
    plan = executed_plan(spark, "observation_window")
    assert "PushedFilters: [In(event_type, [click,view])" in plan


def test_route_cells_move_as_blocks(spark):
    plan = executed_plan(spark, "route_cells")
    assert "partial_bit_or" in plan
    assert not [x for x in plan.splitlines() if "hashpartitioning(" in x and "gid#" in x.split("hashpartitioning(")[1]]


@pytest.mark.parametrize("name", ["industry_overlay_area", "site_overlay_area"])
def test_polygon_cells_are_summed_where_the_polygon_is(spark, name):
    plan = executed_plan(spark, name)
    assert "hashpartitioning(ind_id" in plan
    assert not [x for x in plan.splitlines() if "hashpartitioning(ind_id" in x and "ix#" in x]


def test_polygons_are_dealt_over_tasks_before_their_cells(spark):
    lines = executed_plan(spark, "site_cells").split("== Initial Plan ==")[0].splitlines()
    dealt = next(i for i, x in enumerate(lines) if "hashpartitioning(rings" in x)
    cells = [i for i, x in enumerate(lines) if "Generate explode" in x]
    assert len(cells) == 3 and max(cells) < dealt  # printed from the last step to the first


def test_category_totals_are_not_read_from_written_cells(spark):
    assert "road-cells" not in executed_plan(spark, "category_share")
