"""What the physical plans must look like."""

import re

import pytest

from camlytics import plans
from camlytics.functions import boxes
from camlytics.operators import joins, stats
from camlytics.plans import parsing, views

QUERIES = plans.queries()
# Queries that write or stream have no single plan to look at.
DECLARATIVE = sorted(
    name for module in plans.MODULES[:3] for name in module.QUERIES
    if name not in {"json_documents", "track_lookup"}
)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", DECLARATIVE)
def test_no_cross_join_and_no_row_udf(spark, tiny, name):
    plan = plan_of(QUERIES[name](spark, tiny))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan
    assert plan.count("ArrowEvalPython") <= 1


@pytest.mark.parametrize("name, columns", [
    ("json_props_parse", {"event_id", "props"}),
    ("camera_class_counts", {"event_id", "event_type"}),
    ("cameras_seen", {"event_id"}),
    ("uptime", {"event_id", "ts"}),
    ("load_missing", {"l_orderkey", "o_orderkey", "o_custkey", "o_totalprice"}),
])
def test_scans_read_only_what_is_needed(spark, tiny, name, columns):
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan_of(QUERIES[name](spark, tiny)))
    assert {part.split(":")[0] for s in schemas for part in s.split(",")} == columns


@pytest.mark.parametrize("name", ["camera_class_counts", "tumbling_rates", "last_seen", "detections_by_class"])
def test_aggregates_are_combined_before_the_shuffle(spark, tiny, name):
    assert "partial_" in plan_of(QUERIES[name](spark, tiny))


@pytest.mark.parametrize("name", [
    "parse_detection_answer", "frame_summary", "alert_feed", "nms", "explode_detections",
])
def test_one_shuffle_per_frame_grouping(spark, tiny, name):
    assert plan_of(QUERIES[name](spark, tiny)).count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("name", [
    "confidence_filter_strict", "bbox_corner_to_center", "date_partitions", "message_keys", "error_rows",
])
def test_projections_do_not_shuffle(spark, tiny, name):
    assert "Exchange" not in plan_of(QUERIES[name](spark, tiny))


def test_filters_reach_the_scan(spark, tiny):
    rows = views.det(spark, tiny).where("event_id < 100")
    assert "PushedFilters: [IsNotNull(event_id), LessThan(event_id,100)]" in plan_of(rows)


def test_class_dimension_is_broadcast(spark, tiny):
    plan = plan_of(boxes.with_class_name(views.det(spark, tiny).drop("class_name")))
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_present_keys_are_distinct_before_the_join(spark, tiny):
    det = views.det(spark, tiny)
    plan = plan_of(joins.missing(stats.frame_counts(det).select("camera_id"), det, ["camera_id"]))
    assert plan.count("HashAggregate") >= 4


def test_one_json_parse_per_answer(spark, tiny):
    plan = plan_of(parsing.parse_detection_answer(spark, tiny))
    assert plan.count("from_json(StructField(metadata") <= 1


def test_latest_rows_are_found_by_hash(spark, tiny):
    """All rows go through hash aggregates; what sorts comes after the join with the winners."""
    plan = plan_of(QUERIES["latest_per_camera"](spark, tiny))
    assert "LeftSemi" in plan and "SortAggregate" not in plan[plan.index("LeftSemi"):]


def test_similarity_work_is_bounded():
    import tracemalloc

    import numpy as np

    from camlytics.operators import similarity

    keeper = similarity._Keeper(np.random.default_rng(0).normal(size=(8192, 8)), 5)
    tracemalloc.start()
    keeper.add(np.arange(4096), np.random.default_rng(1).normal(size=(4096, 8)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 128 << 20
