"""Plans that must not pair rows without an equality; sizes don't show that."""

import re

import pytest
from pyspark.sql import functions as F

from framewise.fixtures import table
from framewise.operators.scene import scene_visibility_matrix
from framewise.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["c3_source_completeness", "c4_remaining_tasks", "c5_purge_list", "c6_pose_pair_valid", "c7_classify_jobs", "e22_coverage", "e26_render_validation_report"])
def test_orders_meet_targets_by_key(spark, name):
    """Suppliers are not broadcast here. A product with a condition is one that a key should have stood for."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "256")
    try:
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, before)
    assert not re.search(r"CartesianProduct \S", plan)


def _most_rows(node) -> int:
    rows = node.metrics().get("numOutputRows")
    below = node.children()
    return max([rows.get().value() if rows.isDefined() else 0, *(_most_rows(below.apply(i)) for i in range(below.size()))])


def test_matches_meet_two_views(spark):
    """No step of the fixture makes more rows than there are pixels, where all pairs of views would be 625 times as many."""
    key = "spark.sql.adaptive.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        rows = table(spark, SF, "matches")
        assert rows.collect()
        assert _most_rows(rows._jdf.queryExecution().executedPlan()) <= table(spark, SF, "rgbd").count()
    finally:
        spark.conf.set(key, before)


def test_visibility_matrix_is_dealt(spark):
    """One map's targets are worked through by all tasks, with every pair once."""
    targets = spark.range(200).selectExpr("'m' as map_path", "string(id) as target").coalesce(1)
    actors = targets.selectExpr("map_path", "target as actor", "false as is_occluder")
    rows = scene_visibility_matrix(targets, actors)
    assert rows.select(F.spark_partition_id()).distinct().count() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert rows.distinct().count() == rows.count() == 200 * 200 * 2
