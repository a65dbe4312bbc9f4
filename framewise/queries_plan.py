"""Registered queries of the plan and completeness operators over the fixtures, with their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from framewise.fixtures import oracle, table
from framewise.operators import complete as C
from framewise.operators import plan as P

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = oracle(sql)
        return f

    return add


def _product(t):
    plan = t("plan_rows")
    one = lambda c, k: plan.select(c.alias(k)).distinct()
    return P.trajectory_product(one(F.col("trajectory"), "kind"), one(F.col("height_m") * 100, "height_cm"), one(F.col("yaw_deg"), "yaw_deg"))


def _t(spark, d):
    return lambda name: table(spark, d, name)


_PRODUCT = "select k.kind, h.height_cm, y.yaw_deg from (select distinct trajectory as kind from {plan_rows}) k cross join (select distinct height_m*100 as height_cm from {plan_rows}) h cross join (select distinct yaw_deg from {plan_rows}) y"
_NAME = "printf('%s_height_%03d_ang_%03d', kind, cast(trunc(height_cm/100) as int), cast(trunc(yaw_deg) as int))"


@query("b1_trajectory_product", f"with p as ({_PRODUCT}), n as (select *, {_NAME} as name from p) select *, count(*) over (partition by name) > 1 as collides from n")
def _(spark, d):
    return _product(_t(spark, d))


@query("b2_validate_plan", """with r as (select p.sequence_id, p.seq_no, concat_ws(',', case when m.map_path is null then 'unknown_map' end,
 case when m.map_path is not null and p.split is distinct from m.split then 'split' end, case when m.map_path is not null and p.source_scene is distinct from m.source_scene then 'source_scene' end,
 case when m.map_path is not null and t.target_label is null then 'unknown_target' end, case when p.expected_views is distinct from 25 then 'expected_views' end) as codes
 from {plan_rows} p left join {maps} m on p.map_path=m.map_path left join (select distinct map_path, target_label from {targets}) t on t.map_path=p.map_path and t.target_label=p.target_label)
 select * from r where codes <> ''""")
def _(spark, d):
    t = _t(spark, d)
    return P.validate_plan(t("plan_rows"), t("maps"), t("targets"))


@query("b3_unsupported_recipe", f"with q as ({_PRODUCT}), p as (select * from q where not (kind='rot_arc' and height_cm=12000)) select sequence_id, trajectory, height_m, yaw_deg from {{plan_rows}} r where not exists (select 1 from p where p.kind=r.trajectory and p.height_cm=r.height_m*100 and p.yaw_deg=r.yaw_deg)")
def _(spark, d):
    t = _t(spark, d)
    allowed = _product(t).filter("not (kind = 'rot_arc' and height_cm = 12000)")
    return P.unsupported_recipe(t("plan_rows"), allowed).select("sequence_id", "trajectory", "height_m", "yaw_deg")


@query("b4_duplicate_recipes", """with a as (select sequence_id, seq_no, row_number() over (partition by sequence_id order by seq_no) as i, min(seq_no) over (partition by sequence_id) as ki,
 row_number() over (partition by map_path,target_label,trajectory,height_m,yaw_deg order by seq_no) as r, min(seq_no) over (partition by map_path,target_label,trajectory,height_m,yaw_deg) as kr from {plan_rows})
 select sequence_id, seq_no, 'sequence_id' as rule, ki as keeper from a where i>1 union all select sequence_id, seq_no, 'recipe', kr from a where r>1""")
def _(spark, d):
    return P.duplicate_recipes(_t(spark, d)("plan_rows"))


@query("b5_select_plan", "select p.sequence_id, p.map_path, p.target_label from {plan_rows} p join {targets} t on p.map_path=t.map_path and p.target_label=t.target_label where t.target_id % 3 = 0")
def _(spark, d):
    t = _t(spark, d)
    return P.select_plan(t("plan_rows"), t("targets").filter("target_id % 3 = 0").select("map_path", "target_label"))[0].select("sequence_id", "map_path", "target_label")


@query("b5_missing_targets", "select map_path, target_label||'_b' as target_label from {targets} where target_id % 3=0 union all select map_path, target_label from {targets} t where not exists (select 1 from {plan_rows} p where p.map_path=t.map_path and p.target_label=t.target_label)")
def _(spark, d):
    """All targets are wanted, and some that there are not."""
    t = _t(spark, d)
    wanted = t("targets").select("map_path", "target_label")
    other = t("targets").filter("target_id % 3 = 0").select("map_path", F.concat("target_label", F.lit("_b")).alias("target_label"))
    return P.select_plan(t("plan_rows"), wanted.unionByName(other))[1]


@query("b6_task_limit", "select sequence_id, map_path, target_label, seq_no from (select *, row_number() over (partition by map_path, target_label order by seq_no) as rn from {plan_rows}) z where rn <= 20")
def _(spark, d):
    return P.task_limit(_t(spark, d)("plan_rows"), 20).select("sequence_id", "map_path", "target_label", "seq_no")


@query("b7_assign_shards", """with a as (select *, row_number() over (partition by map_path, target_label order by seq_no) - 1 as rn from {plan_rows}),
 b as (select *, printf('%s_%s_s%03d', string_split(map_path,'/')[-1], target_label, rn % 3) as job_id from a)
 select job_id, map_path, target_label, count(*) as tasks, string_agg(sequence_id, ',' order by rn) as sequence_ids from b group by 1,2,3""")
def _(spark, d):
    return P.assign_shards(_t(spark, d)("plan_rows"), 3)


@query("b7_job_tasks", """with a as (select *, row_number() over (partition by map_path, target_label order by seq_no) - 1 as rn from {plan_rows})
 select printf('%s_%s_s%03d', string_split(map_path,'/')[-1], target_label, rn % 3) as job_id, map_path, target_label, rn // 3 as place, sequence_id from a""")
def _(spark, d):
    return P.job_tasks(_t(spark, d)("plan_rows"), 3)


@query("b8_plan_summary", "with s as (select split, map_path, count(*) as sequences, count(distinct target_label) as targets from {plan_rows} group by grouping sets ((split),(map_path),())), j as (select min(split) as split, map_path, least(count(*),3) as n from {plan_rows} group by map_path, target_label), k as (select split, map_path, sum(n) as jobs from j group by grouping sets ((split),(map_path),())) select s.*, cast(coalesce(jobs,0) as bigint) as jobs from s left join k on k.split is not distinct from s.split and k.map_path is not distinct from s.map_path")
def _(spark, d):
    return P.plan_summary(_t(spark, d)("plan_rows"))


_PREFIX = "printf('%s_%s_height_%03d_ang_%03d', string_split(map_path,'/')[-1], target_label, cast(trunc(height_m) as int), cast(trunc(yaw_deg) as int))"


@query("b9_canonical_names", f"with n as (select *, {_PREFIX} as prefix from {{plan_rows}}) select sequence_id, prefix, trajectory||'/'||prefix||'_occ' as occ_directory, trajectory||'/'||prefix||'_GT' as gt_directory, 'Exported_FBX/'||trajectory||'/'||prefix||'.fbx' as fbx_path from n")
def _(spark, d):
    return P.canonical_names(_t(spark, d)("plan_rows"))


@query("b10_parse_names", r"""with n as (select case when seq_no % 50 = 0 then 'x'||prefix||'_' when seq_no % 31 = 0 then replace(prefix, '_Target_', '_Target_1000') when seq_no % 37 = 0 then prefix||'00000000000000000000' else prefix end as prefix from {sequences}), p as (select prefix, regexp_extract(prefix, '^(.+)_Target_([0-9]+)_height_([0-9]+)_ang_([0-9]+)$', ['m','t','h','y']) as g from n)
 select prefix, nullif(g.m,'') as map_name, try_cast(g.t as bigint) as target_number, try_cast(g.h as bigint) as height, try_cast(g.y as bigint) as yaw, g.m = '' or try_cast(g.y as bigint) is null as bad from p""")
def _(spark, d):
    """Names that don't fit, targets of six and seven digits, and yaws that no long holds are among them."""
    names = _t(spark, d)("sequences").select(F.expr("case when seq_no % 50 = 0 then concat('x', prefix, '_') when seq_no % 31 = 0 then replace(prefix, '_Target_', '_Target_1000') when seq_no % 37 = 0 then concat(prefix, '00000000000000000000') else prefix end").alias("prefix"))
    return P.parse_names(names)


@query("b11_exact_task_subset", f"with p as ({_PRODUCT}), r as (select distinct trajectory as kind, height_m*100 as height_cm, yaw_deg from {{plan_rows}} where seq_no % 7 = 0) select p.* from p join r using (kind, height_cm, yaw_deg)")
def _(spark, d):
    t = _t(spark, d)
    asked = t("plan_rows").filter("seq_no % 7 = 0").select(F.col("trajectory").alias("kind"), (F.col("height_m") * 100).alias("height_cm"), "yaw_deg").distinct()
    return P.exact_task_subset(_product(t).select("kind", "height_cm", "yaw_deg"), asked)[0]


@query("b12_target_shard_select", "select map_path, target_label, (row_number() over (partition by map_path order by target_label) - 1) % 3 as shard from {targets} where target_id % 4 <> 1")
def _(spark, d):
    t = _t(spark, d)
    return P.target_shard_select(t("targets"), t("targets").filter("target_id % 4 <> 1").select("map_path", "target_label"), 3)[0].withColumn("shard", F.col("shard").cast("long"))


@query("b13_job_row_rules", """with j as (select map_path||'#'||target_label as job_id, map_path, count(*) % 4 as shard_index, count(*) as n, count(distinct (trajectory, height_m, yaw_deg)) as nd, count(distinct source_scene) as td from {plan_rows} group by 1, 2)
 select job_id, concat_ws(',', case when nd < n then 'duplicate_task' end, case when td < n then 'duplicate_target' end, case when shard_index >= 3 then 'shard_index' end) as codes from j""")
def _(spark, d):
    rows = _t(spark, d)("plan_rows").withColumn("job_id", F.concat("map_path", F.lit("#"), "target_label"))
    jobs = rows.groupBy("job_id", "map_path").agg((F.count("*") % 4).alias("shard_index"))
    tasks = rows.select("job_id", F.col("trajectory").alias("kind"), F.col("height_m").alias("height"), F.col("yaw_deg").alias("yaw"))
    return P.job_row_rules(jobs, tasks, rows.select("job_id", F.col("source_scene").alias("target")), 3)


@query("b14_map_resolution", """with n as (select string_split(map_path,'/')[-1] as name from {maps} union all select source_scene from {maps}), p as (select distinct map_path as package from {maps} union select '/Game/Other/'||string_split(map_path,'/')[-1] from {maps} where map_id % 5 = 0),
 b as (select string_split(package,'/')[-1] as name, count(*) as n, min(package) as package from p group by 1)
 select name, coalesce(b.n, 0) as matches, case when b.n = 1 then b.package end as package, case when b.n is null then 'missing' when b.n > 1 then 'ambiguous' else 'ok' end as status from (select distinct name from n) n left join b using (name)""")
def _(spark, d):
    maps = _t(spark, d)("maps")
    short = F.element_at(F.split("map_path", "/"), -1)
    names = maps.select(short.alias("name")).union(maps.select("source_scene"))
    packages = maps.select(F.col("map_path").alias("package")).union(maps.filter("map_id % 5 = 0").select(F.concat(F.lit("/Game/Other/"), short)))
    return P.map_resolution(names, packages)


@query("b15_split_audit", """with m as (select source_scene, map_path, count(*) as n from {plan_rows} group by 1,2), r as (select source_scene, min(n) as least_per_map, max(n) as most_per_map from m group by 1),
 s as (select source_scene, count(distinct split) as splits, count(*) as sequences, count(distinct expected_views) as view_counts from {plan_rows} group by 1)
 select s.*, least_per_map, most_per_map, splits=1 and view_counts=1 and least_per_map=most_per_map as clean from s join r using (source_scene)""")
def _(spark, d):
    return P.split_audit(_t(spark, d)("plan_rows"))


@query("b16_trajectory_seed", """select sequence_id, cast(('0x'||substr(sha256('[42,"'||map_path||'","'||target_label||'",["'||trajectory||'",'||printf('%.1f',height_m)||','||printf('%.1f',yaw_deg)||']]'),1,16))::ubigint as decimal(20,0)) as seed from {plan_rows}""")
def _(spark, d):
    return P.trajectory_seed(_t(spark, d)("plan_rows"))


@query("b17_plan_fingerprint", """with h as (select map_path, sha256(concat_ws('|', sequence_id, map_path, split, target_label, cast(expected_views as varchar), trajectory, printf('%.1f',height_m), printf('%.1f',yaw_deg))) as h from {plan_rows})
 select map_path, sha256(concat_ws(':', count(*), sum(('0x'||substr(h,1,16))::ubigint), sum(('0x'||substr(h,17,16))::ubigint), sum(('0x'||substr(h,33,16))::ubigint), sum(('0x'||substr(h,49,16))::ubigint))) as fingerprint, count(*) as rows from h group by 1""")
def _(spark, d):
    return P.plan_fingerprint(_t(spark, d)("plan_rows"))


@query("b18_sequence_categories", """with p as (select map_path||'/'||trajectory||'/'||prefix as path, max((seq_no % 3<>0)::int) as s, max((seq_no % 4<>0)::int) as e from {sequences} group by 1) select case when path like '%/fix_line/%' then 'fix_line' when path like '%/plane_grid/%' then 'plane_grid' when path like '%/rot_arc/%' then 'rot_arc' else 'other' end as category, cast(sum(s) as bigint) as selected, cast(sum(e) as bigint) as exported, cast(sum(s*e) as bigint) as both from p where s+e>0 group by 1""")
def _(spark, d):
    """Every third sequence is not selected, every fourth not exported."""
    paths = _t(spark, d)("sequences").select(F.concat_ws("/", "map_path", "trajectory", "prefix").alias("path"), "seq_no")
    return P.sequence_categories(paths.filter("seq_no % 3 <> 0"), paths.filter("seq_no % 4 <> 0"), ["fix_line", "plane_grid", "rot_arc"])


@query("b19_trajectory_work_items", f"""with k as ({_PRODUCT}), p as (select kind, length(kind) * 10.0::double as span from (select distinct kind from k)), s as (select min(height_cm) as shell_low, max(height_cm) as shell_high from k)
 select t.map_path, t.target_label, k.kind, k.height_cm, k.yaw_deg, p.span, s.shell_low, s.shell_high, t.map_path||'/'||k.kind||'/'||printf('%s_%s_height_%03d_ang_%03d', string_split(map_path,'/')[-1], target_label, cast(trunc(height_cm/100) as int), cast(trunc(yaw_deg) as int)) as output_path
 from {{targets}} t cross join k join p on p.kind = k.kind cross join s""")
def _(spark, d):
    t = _t(spark, d)
    tasks = _product(t).select("kind", "height_cm", "yaw_deg")
    params = tasks.select("kind").distinct().withColumn("span", F.length("kind") * F.lit(10.0))
    return P.trajectory_work_items(t("targets").select("map_path", "target_label"), tasks, params)


# Completeness

_PASSES = "(select 'rgb' as pass_name union all select 'depth') p cross join (select 'occ' as suffix union all select 'GT') x"


def _passes(spark):
    return spark.createDataFrame([("rgb", "png"), ("depth", "exr")], "pass_name string, ext string"), spark.createDataFrame([("occ",), ("GT",)], "suffix string")


_COMPLETE = f"""e as (select trajectory, prefix, suffix, pass_name from (select distinct trajectory, prefix from {{sequences}}) q cross join {_PASSES}),
 f as (select trajectory, prefix, suffix, pass_name, count(*) as files, count(distinct frame) as frames_found, count(*) filter (size<=0) as empty from {{files}} group by 1,2,3,4),
 c as (select e.*, true as expected, coalesce(files,0) as files, coalesce(frames_found,0) as frames_found, coalesce(empty,0) as empty, cast(0 as bigint) as unexpected, coalesce(files=25 and frames_found=25 and empty=0, false) as complete from e left join f using (trajectory, prefix, suffix, pass_name))"""


def _completeness(spark, d):
    t = _t(spark, d)
    return C.frame_completeness(t("sequences"), t("files"), *_passes(spark))


@query("c1_expected_artifacts", f"select q.trajectory, q.prefix, x.suffix, p.pass_name, case when p.pass_name='rgb' then 'png' else 'exr' end as ext, cast(f as int) as frame, q.trajectory||'/'||q.prefix||'_'||x.suffix||'/'||p.pass_name||'/'||printf('%04d', cast(f as int))||'.'||case when p.pass_name='rgb' then 'png' else 'exr' end as rel_path from {{sequences}} q cross join {_PASSES} cross join unnest(range(0,25)) as u(f)")
def _(spark, d):
    passes, suffixes = _passes(spark)
    return C.expected_artifacts(_t(spark, d)("sequences"), passes, suffixes)


@query("c1_expected_single_frame", f"select q.trajectory, q.prefix, x.suffix, p.pass_name, cast(12 as int) as frame from {{sequences}} q cross join {_PASSES}")
def _(spark, d):
    passes, suffixes = _passes(spark)
    return C.expected_artifacts(_t(spark, d)("sequences"), passes, suffixes, single=12).select("trajectory", "prefix", "suffix", "pass_name", "frame")


@query("c2_frame_completeness", f"with {_COMPLETE} select * from c")
def _(spark, d):
    return _completeness(spark, d)


_SOURCES = "(select trajectory, prefix, case when seq_no % 31=0 then 0 when seq_no % 37=0 then 500 else 2000+seq_no end as size from {sequences} where seq_no % 41 <> 0)"


def _sources(spark, d):
    return _t(spark, d)("sequences").filter("seq_no % 41 <> 0").select("trajectory", "prefix", F.expr("case when seq_no % 31 = 0 then 0 when seq_no % 37 = 0 then 500 else 2000 + seq_no end as size"))


@query("c3_source_completeness", f"with r as (select q.trajectory, q.prefix, s.size, case when s.size is null then 'missing' when s.size=0 then 'empty' when s.size<1024 then 'short' end as reason from {{sequences}} q left join {_SOURCES} s on q.trajectory=s.trajectory and q.prefix=s.prefix) select * from r where reason is not null")
def _(spark, d):
    return C.source_completeness(_t(spark, d)("sequences"), _sources(spark, d))


@query("c4_remaining_tasks", f"""with {_COMPLETE}, b as (select distinct trajectory, prefix from c where not complete union select q.trajectory, q.prefix from {{sequences}} q left join {_SOURCES} s on q.trajectory=s.trajectory and q.prefix=s.prefix where coalesce(s.size,0)<1024)
 select map_path as job_id, seq_no, q.trajectory, q.prefix from {{sequences}} q join b on b.trajectory=q.trajectory and b.prefix=q.prefix""")
def _(spark, d):
    t = _t(spark, d)
    tasks = t("sequences").select(F.col("map_path").alias("job_id"), "seq_no", "trajectory", "prefix")
    return C.remaining_tasks(tasks, _completeness(spark, d), C.source_completeness(t("sequences"), _sources(spark, d)))


@query("c5_purge_list", f"with {_COMPLETE}, b as (select distinct trajectory, prefix from c where not complete) select rel_path, size from {{files}} f join b on b.trajectory=f.trajectory and b.prefix=f.prefix")
def _(spark, d):
    return C.purge_list(_t(spark, d)("files"), C.incomplete_sequences(_completeness(spark, d)))


@query("c6_pose_pair_valid", """with a as (select prefix, min(seq_no) as n from {sequences} group by prefix), r as (select prefix, case when n % 29=0 then 'missing' when n % 23=0 then 'differ' when n % 19=0 then 'source_changed' else 'ok' end as status from a) select * from r""")
def _(spark, d):
    one = _t(spark, d)("sequences").groupBy("prefix").agg(F.min("seq_no").alias("n"))
    poses = one.select("prefix", "n", F.explode(F.array(F.lit("GT"), F.lit("occ"))).alias("suffix")).filter("not (suffix = 'occ' and n % 29 = 0)")
    poses = poses.select("prefix", "suffix", F.expr("concat(prefix, if(n % 23 = 0, suffix, ''))").alias("content"), F.sha2("prefix", 256).alias("source_hash"))
    sources = one.select("prefix", F.sha2(F.expr("concat(prefix, if(n % 19 = 0, 'x', ''))"), 256).alias("hash"))
    return C.pose_pair_valid(poses, sources)


@query("c7_classify_jobs", f"""with {_COMPLETE}, s as (select q.target_label as job_id, bool_and(complete) as frames_ok, min(seq_no) as n from c join {{sequences}} q using (trajectory, prefix) group by 1)
 select job_id, case when not frames_ok then 'render' when n % 3 = 0 then 'camera' when n % 5 = 0 then 'render' else 'done' end as state from s""")
def _(spark, d):
    seqs = _t(spark, d)("sequences").select("trajectory", "prefix", "target_label", "seq_no")
    jobs = _completeness(spark, d).join(seqs, ["trajectory", "prefix"]).groupBy(F.col("target_label").alias("job_id")).agg(F.bool_and("complete").alias("frames_ok"), F.min("seq_no").alias("n"))
    return C.classify_jobs(jobs.select("job_id", "frames_ok", F.expr("n % 3 <> 0").alias("poses_ok"), F.lit(True).alias("marker"), F.expr("n % 5 <> 0").alias("fingerprint_ok"), F.lit(True).alias("inventory_ok")))


QUERIES["c7_classify_jobs_all"], ORACLES["c7_classify_jobs_all"] = QUERIES["c7_classify_jobs"], ORACLES["c7_classify_jobs"]


_JOB = "concat(map_path, '|', target_label, '|', cast({} as varchar(9)))"


@query("c8_output_inventory", f"""with j as (select trajectory, prefix, {_JOB.format("(row_number() over (partition by map_path, target_label order by seq_no) - 1) % 3")} as job_id from {{sequences}}),
 f as (select trajectory, prefix, suffix, size, case when drop_key % 97=5 then 'view.'||frame when drop_key % 89=7 then cast(frame as varchar) else printf('%04d', frame) end as stem, case when drop_key % 83=11 then 'txt' else 'img' end as kind from {{files}}),
 p as (select trajectory, prefix, suffix, count(*) as files, sum(size) as bytes, count(distinct stem) as views from f where kind='img' group by 1,2,3)
 select job_id, cast(sum(files) as bigint) as image_files, cast(sum(bytes) as bigint) as bytes, cast(sum(views) as bigint) as frame_views, string_agg(prefix||'_'||suffix, ',' order by prefix||'_'||suffix) as directories from p join j using (trajectory, prefix) group by 1""")
def _(spark, d):
    """Some stems are no numbers, some are numbers of fewer digits, some extensions are in capitals, some files are no images."""
    t = _t(spark, d)
    jobs = t("sequences").select("trajectory", "prefix", F.expr(_JOB.format("(row_number() over (partition by map_path, target_label order by seq_no) - 1) % 3").replace("varchar(9)", "string")).alias("job_id"))
    stem = "case when drop_key % 97 = 5 then concat('view.', frame) when drop_key % 89 = 7 then string(frame) else lpad(string(frame), 4, '0') end"
    ext = "if(drop_key % 83 = 11, 'txt', if(drop_key % 3 = 0, 'PNG', 'exr'))"
    got = C.output_inventory(t("files").withColumns({"stem": F.expr(stem), "ext": F.expr(ext)}), jobs)
    return got.withColumn("directories", F.array_join("directories", ","))


@query("c9_snapshot_diff", """with c as (select rel_path, size from {files} where drop_key % 10 = 3 or drop_key % 10 = 7) select case when rel_path like '%.png' then 'rgb' when rel_path like '%.exr' then 'depth' else 'other' end as kind, count(*) as files, cast(sum(size) as bigint) as bytes from c group by 1""")
def _(spark, d):
    f = _t(spark, d)("files").select("rel_path", "size", "drop_key", F.lit(1).alias("mtime_ns"))
    before = f.filter("drop_key % 10 <> 3").withColumn("mtime_ns", F.expr("if(drop_key % 10 = 7, 0, mtime_ns)"))
    return C.snapshot_diff(before, f.select("rel_path", "size", "mtime_ns"))


@query("c10_asset_integrity", "select path, case when doc_id % 89=0 then 'missing' when doc_id % 83=0 then 'unlisted' else 'changed' end as status from {assets} where doc_id % 89=0 or doc_id % 83=0 or doc_id % 97=0")
def _(spark, d):
    a = _t(spark, d)("assets")
    manifest = a.filter("doc_id % 83 <> 0 or doc_id % 89 = 0").select("path", F.sha2(F.expr("if(doc_id % 97 = 0, concat(text, 'x'), text)"), 256).alias("sha256"))
    return C.asset_integrity(manifest, a.filter("doc_id % 89 <> 0").select("path", F.sha2("text", 256).alias("sha256")))


@query("c11_tree_copy_verify", "select path, case when doc_id % 53=0 then 'only_left' when doc_id % 59=0 then 'only_right' else 'changed' end as change from {assets} where doc_id % 53=0 or doc_id % 59=0 or doc_id % 61=0")
def _(spark, d):
    a = _t(spark, d)("assets").withColumn("hash", F.sha2("text", 256))
    left = a.filter("doc_id % 59 <> 0 or doc_id % 53 = 0").select("path", "n", "hash")
    right = a.filter("doc_id % 53 <> 0").select("path", F.expr("if(doc_id % 61 = 0, n + 1, n) as n"), "hash")
    return C.tree_copy_verify(left, right, ["n", "hash"])


@query("c12_discover_sequences", "select trajectory, prefix from {sequences} where trajectory in ('rot_arc','rot_spiral') order by 1, 2 limit 500")
def _(spark, d):
    return C.discover_sequences(_t(spark, d)("sequences"), ["rot_arc", "rot_spiral"], 500)


@query("c13_manifest_pairs_check", """with p as (select trajectory, case when seq_no % 71=0 then '../'||prefix else prefix end as prefix, case when seq_no % 67=0 then '/other/' else '/root/' end||trajectory||'/'||prefix||'.fbx' as path from {sequences} union all select trajectory, prefix, '/root/'||trajectory||'/'||prefix||'.fbx' from {sequences} where seq_no % 73=0),
 r as (select *, concat_ws(',', case when count(*) over (partition by trajectory, prefix) > 1 then 'duplicate' end, case when prefix like '../%' then 'unsafe_name' end, case when trajectory = 'rand_shell' then 'unknown_trajectory' end, case when path <> '/root/'||trajectory||'/'||prefix||'.fbx' then 'path' end) as codes from p) select * from r where codes <> ''""")
def _(spark, d):
    s = _t(spark, d)("sequences")
    path = lambda root: F.concat(root, "trajectory", F.lit("/"), "prefix", F.lit(".fbx")).alias("path")
    pairs = s.select("trajectory", F.expr("if(seq_no % 71 = 0, concat('../', prefix), prefix) as prefix"), path(F.expr("if(seq_no % 67 = 0, '/other/', '/root/')")))
    pairs = pairs.unionByName(s.filter("seq_no % 73 = 0").select("trajectory", "prefix", path(F.lit("/root/"))))
    return C.manifest_pairs_check(pairs, ["fix_line", "plane_grid", "rot_arc", "rot_spiral"], "/root")


@query("c14_attempt_rollup", """with j as (select job_id, arg_max(returncode, attempt) as returncode, max(attempt) as attempts, count(*) filter (returncode<>0) as failures from {attempts} group by 1), k as (select *, returncode<>0 and attempts>=12 as exhausted from j),
 r as (select greatest(3, cast(ceil(count(*)/100.0) as bigint)) as budget, count(*) filter (exhausted) as exhausted_jobs from k) select k.*, r.*, exhausted_jobs >= budget as breach from k cross join r""")
def _(spark, d):
    return C.attempt_rollup(_t(spark, d)("attempts"), 12)


@query("c15_run_summary", """with p as (select distinct 'job_'||c_custkey as job_id from {customer}), t as (select *, event_id % 3=0 as resumed, 50+event_id % 7 as image_files, 40+event_id % 5 as fresh from {attempts}), a as (select job_id, arg_max(returncode, attempt) as rc, arg_max(resumed, attempt) as res, arg_max(image_files, attempt) as im, sum(wall_seconds) as wall, sum(case when not resumed then fresh end) as fresh from t group by 1), r as (select p.job_id, rc, res, im, wall, fresh from p left join a using (job_id))
 select count(*) filter (rc=0) as completed, count(*) filter (rc<>0) as failed, count(*) filter (rc is null) as unscheduled, count(*) filter (res) as resumed, cast(coalesce(sum(im),0) as bigint) as image_files, round(sum(wall),4) as wall_seconds, round(sum(fresh)/sum(wall),4) as image_files_per_second, count(*) filter (rc<>0)=0 and count(*) filter (rc is null)=0 as success from r""")
def _(spark, d):
    t = _t(spark, d)
    attempts = t("attempts").withColumns({"resumed": F.expr("event_id % 3 = 0"), "image_files": F.expr("50 + event_id % 7"), "rendered_image_files": F.expr("40 + event_id % 5")})
    return C.run_summary(t("customer").select(F.concat(F.lit("job_"), F.col("c_custkey").cast("string")).alias("job_id")), attempts)


_C16 = "job_id, attempt, returncode, attempt*7 % 13 + 1 as launched, case when event_id % 9=0 then null else attempt*5 % 17 end as remaining, 13 as tasks, 1000 + event_id % 500 as images"


@query("c16_credited_throughput", f"""with a as (select {_C16} from {{attempts}}), b as (select *, greatest(case when returncode=0 then launched when remaining is null then 0 else launched - remaining end, 0) as fresh from a)
 select job_id, cast(sum(fresh) as bigint) as rendered_tasks, cast(arg_max(images, attempt)*sum(fresh)//13 as bigint) as credited from b group by 1""")
def _(spark, d):
    return C.credited_throughput(_t(spark, d)("attempts").selectExpr("job_id", "attempt", "returncode", "attempt * 7 % 13 + 1 as launched", "if(event_id % 9 = 0, null, attempt * 5 % 17) as remaining", "13 as tasks", "1000 + event_id % 500 as images"))


@query("c17_storage_forecast", "select pass_name, count(*) as measured, case when pass_name='rgb' then 960000 else 480000 end as planned, round(avg(size),4) as mean_bytes, round(avg(size)*(case when pass_name='rgb' then 960000 else 480000 end),2) as bytes, round(avg(size)*(case when pass_name='rgb' then 960000 else 480000 end)*1.2,2) as with_reserve from {files} group by 1")
def _(spark, d):
    return C.storage_forecast(_t(spark, d)("files"), spark.createDataFrame([("rgb", 960000), ("depth", 480000)], "pass_name string, planned int"))


@query("c18_worker_outcome", """with l as (select user_id as worker, event_id as seq, case event_type when 'error' then 'failed' when 'purchase' then 'finished' when 'click' then 'cancelled' else 'progress' end as message, case when event_id % 3=0 then null else cast(event_id % 2 as int) end as returncode from {events}),
 w as (select worker, arg_max(message, seq) filter (message in ('finished','failed','cancelled')) as last, arg_max(returncode, seq) as rc, arg_max(returncode is null, seq) as rn from l group by 1)
 select worker, case when last='cancelled' then 'cancelled' when last='failed' then 'failed' when last='finished' and rc is null then 'unreaped' when last='finished' and rc<>0 then 'teardown_incomplete' when last='finished' then 'finished' else 'crash' end as outcome from (select worker, last, case when rn then null else rc end as rc from w)""")
def _(spark, d):
    log = _t(spark, d)("events").selectExpr("user_id as worker", "event_id as seq", "case event_type when 'error' then 'failed' when 'purchase' then 'finished' when 'click' then 'cancelled' else 'progress' end as message", "if(event_id % 3 = 0, null, cast(event_id % 2 as int)) as returncode")
    return C.worker_outcome(log)


QUERIES["c18_worker_outcome_all"], ORACLES["c18_worker_outcome_all"] = QUERIES["c18_worker_outcome"], ORACLES["c18_worker_outcome"]
