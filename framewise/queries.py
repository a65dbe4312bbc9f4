"""All registered queries of the capture operators, with their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from framewise import queries_audit, queries_io, queries_plan, queries_pose, queries_rgbd, queries_scene
from framewise.fixtures import oracle, table
from framewise.plans.flagship import remaining_by_map


def remaining_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda name: table(spark, sf_dir, name)
    passes, suffixes = queries_plan._passes(spark)
    return remaining_by_map(t("plan_rows"), t("maps"), t("targets"), t("files"), passes, suffixes)


_REMAINING = oracle("""
with ok as (select p.* from {plan_rows} p join {maps} m on m.map_path=p.map_path where p.split=m.split and p.source_scene=m.source_scene and p.expected_views=25
   and exists (select 1 from {targets} t where t.map_path=p.map_path and t.target_label=p.target_label)),
 q as (select distinct map_path, trajectory, printf('%s_%s_height_%03d_ang_%03d', string_split(map_path,'/')[-1], target_label, cast(trunc(height_m) as int), cast(trunc(yaw_deg) as int)) as prefix from ok),
 f as (select trajectory, prefix, suffix, pass_name, count(*) as n, count(distinct frame) as d, min(size) as s from {files} group by 1,2,3,4),
 g as (select trajectory, prefix, count(*) filter (n=25 and d=25 and s>0) as good from f group by 1,2)
select map_path, count(*) as sequences, count(*) filter (coalesce(good,0) < 4) as remaining from q left join g using (trajectory, prefix) group by 1""")

QUERIES = {"remaining_work": remaining_work} | queries_io.QUERIES | queries_plan.QUERIES | queries_pose.QUERIES | queries_rgbd.QUERIES | queries_audit.QUERIES | queries_scene.QUERIES
ORACLES = {"remaining_work": _REMAINING} | queries_io.ORACLES | queries_plan.ORACLES | queries_pose.ORACLES | queries_rgbd.ORACLES | queries_audit.ORACLES | queries_scene.ORACLES
