"""Registered queries of the telemetry, scene and streaming operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from framewise.fixtures import oracle, table
from framewise.operators import scene as G
from framewise.operators import telemetry as T
from framewise.sources.store import new_folder
from framewise.streaming import streams as S

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = oracle(sql)
        return f

    return add


_r = lambda c, n=4: (F.round(c, n) + 0.0).alias(c)
_WIN = "o as (select run_label, min(elapsed_seconds) as first_output, max(elapsed_seconds) as last_output from (select *, image_files > coalesce(lag(image_files) over (partition by run_label order by elapsed_seconds),0) as rose from {gpu_samples}) where rose group by 1)"


@query("f1_gpu_run_summary", f"with {_WIN} select run_label, round(avg(gpu_util_percent),4)+0.0 as mean_util, round(avg(gpu_util_percent) filter (elapsed_seconds between first_output and last_output),4)+0.0 as output_util, max(gpu_memory_mb) as peak_memory_mb, round(avg(power_w),4)+0.0 as mean_power_w, count(*) as samples from {{gpu_samples}} left join o using (run_label) group by 1")
def _(spark, d):
    return T.gpu_run_summary(table(spark, d, "gpu_samples")).select("run_label", _r("mean_util"), _r("output_util"), "peak_memory_mb", _r("mean_power_w"), "samples")


@query("f2_output_window", f"with {_WIN} select * from o")
def _(spark, d):
    return T.output_window(table(spark, d, "gpu_samples"))


@query("f3_throughput", "with r as (select run_label, max(elapsed_seconds)-min(elapsed_seconds) as wall, cast(max(image_files) as bigint) as images from {gpu_samples} group by 1) select run_label, images, round(images/wall,4)+0.0 as images_per_second, round(images/2/wall,4)+0.0 as frames_per_second, round(images*426000.0/1048576/wall,4)+0.0 as mib_per_second from r")
def _(spark, d):
    got = T.throughput(table(spark, d, "gpu_samples"), 426000.0)
    return got.select("run_label", "images", _r("images_per_second"), _r("frames_per_second"), _r("mib_per_second"))


_WHY = "case when process_type='G' and verified and framebuffer_mb between 0 and 128 and not coalesce(sm_util_percent>0, false) then null when process_type like '%C%' then 'compute_context' when sm_util_percent>0 then 'sm_activity' when framebuffer_mb>128 then 'framebuffer_allocation' else 'unverified_graphics_placement' end"
_F4 = f"with k as (select distinct run_label, pid from {{placement}} where gpu_index=0 and start_time % 2=0), s as (select p.run_label, p.event_id, p.pid, p.process_type, p.framebuffer_mb, p.sm_util_percent, k.pid is not null as verified from (select * from {{placement}} where gpu_index<>0) p left join k using (run_label, pid)) select * from (select run_label, event_id, pid, {_WHY} as reason from s) where reason is not null"


@query("f4_placement_violations", _F4.replace(" and start_time % 2=0", ""))
def _(spark, d):
    return T.placement_violations(table(spark, d, "placement"), 0).select("run_label", "event_id", "pid", "reason")


QUERIES["f4_placement_violations_all"], ORACLES["f4_placement_violations_all"] = QUERIES["f4_placement_violations"], ORACLES["f4_placement_violations"]


@query("f4_verified_pids", _F4)
def _(spark, d):
    """Nothing is on the target in the samples; processes of even start times are known from before."""
    rows = table(spark, d, "placement")
    before = rows.filter("gpu_index = 0 and start_time % 2 = 0").select("run_label", "pid").distinct()
    return T.placement_violations(rows.filter("gpu_index <> 0"), 0, verified=before).select("run_label", "event_id", "pid", "reason")


@query("f5_verified_history", "select run_label, pid, event_id, start_time = first_value(start_time) over (partition by run_label, pid order by event_id) as verified from {placement}")
def _(spark, d):
    return T.verified_history(table(spark, d, "placement"))


def _steps(spark, d):
    return table(spark, d, "events").select("event_id", F.concat(F.lit("step_"), F.col("user_id").cast("string")).alias("step_id"), F.col("ts").cast("timestamp").alias("ts"), F.get_json_object("props", "$.k").cast("int").alias("files_present"), F.col("value").alias("wall_seconds"), (F.col("event_type") != "error").alias("success"))


_STEPS = "s as (select event_id, 'step_'||user_id as step_id, ts, cast(json_extract_string(props,'$.k') as int) as files_present, value as wall_seconds, event_type<>'error' as success from {events})"


@query("f8_step_metrics", f"with {_STEPS} select step_id, round(sum(wall_seconds),4)+0.0 as wall_seconds, cast(sum(files_present) as bigint) as files_present, count(*)*100 as files_expected, bool_and(success) as success, count(*) as events from s group by 1")
def _(spark, d):
    return T.step_metrics(_steps(spark, d), 100).select("step_id", _r("wall_seconds"), "files_present", "files_expected", "success", "events")


@query("f9_capacity_sample_stats", "select run_label, count(*) as samples, max(gpu_memory_mb) as peak_mb, round(quantile_cont(gpu_memory_mb,0.5),4)+0.0 as median_mb, round(quantile_cont(gpu_util_percent,0.5),4)+0.0 as median_util, round(max(gpu_memory_mb)/143771,6)+0.0 as peak_share from {gpu_samples} where gpu_util_percent>=50 and gpu_memory_mb>=20000 group by 1")
def _(spark, d):
    got = T.capacity_sample_stats(table(spark, d, "gpu_samples"), 143771.0)
    return got.select("run_label", "samples", "peak_mb", _r("median_mb"), _r("median_util"), _r("peak_share", 6))


# Scene


@query("g1_occlusion_rates", """with h as (select ray_id, arg_min(struct_pack(a := actor_id, p := point_id), struct_pack(d := dist, r := hit_rank, a := actor_id, p := point_id)) as h from {ray_hits} where hit_rank > 1 group by 1),
 f as (select r.ray_id % 3 as camera_id, r.actor_id % 40 as actor_id, r.ray_id, r.point_id from {ray_hits} r where hit_rank = 1), j as (select f.camera_id, f.actor_id, case when h.h is null then 'visible' when h.h.a % 40 <> f.actor_id then 'inter' when abs(h.h.p - f.point_id) <= 5 then 'visible' else 'self' end as kind from f left join h using (ray_id))
 select camera_id, actor_id, count(*) as faces, round(avg((kind='visible')::int),6)+0.0 as visible, round(avg((kind='self')::int),6)+0.0 as self_occlusion, round(avg((kind='inter')::int),6)+0.0 as inter_occlusion from j group by 1,2""")
def _(spark, d):
    rays = table(spark, d, "ray_hits")
    hits = G.first_hits(rays.filter("hit_rank > 1")).selectExpr("ray_id", "actor_id % 40 as hit_actor", "double(point_id) as hx", "0D as hy", "0D as hz")
    faces = rays.filter("hit_rank = 1").selectExpr("ray_id % 3 as camera_id", "actor_id % 40 as actor_id", "ray_id", "double(point_id) as cx", "0D as cy", "0D as cz")
    return G.occlusion_rates(faces, hits).select("camera_id", "actor_id", "faces", _r("visible", 6), _r("self_occlusion", 6), _r("inter_occlusion", 6))


@query("g2_facing_face_centres", """with j as (select f.face_id, a.x as ax, a.y as ay, a.z as az, b.x as bx, b.y as by_, b.z as bz, c.x as cx, c.y as cy, c.z as cz from {faces} f join {vertices} a on a.vertex_id=f.a join {vertices} b on b.vertex_id=f.b join {vertices} c on c.vertex_id=f.c),
 n as (select *, (by_-ay)*(cz-az)-(bz-az)*(cy-ay) as nx, (bz-az)*(cx-ax)-(bx-ax)*(cz-az) as ny, (bx-ax)*(cy-ay)-(by_-ay)*(cx-ax) as nz, (ax+bx+cx)/3 as x, (ay+by_+cy)/3 as y, (az+bz+cz)/3 as z from j)
 select face_id, round(x,4)+0.0 as x, round(y,4)+0.0 as y, round(z,4)+0.0 as z from n where nx*(50.5-x)+ny*(51.25-y)+nz*(9000.75-z) > 0""")
def _(spark, d):
    got = G.facing_face_centres(table(spark, d, "faces"), table(spark, d, "vertices"), (50.5, 51.25, 9000.75))
    return got.select("face_id", _r("x"), _r("y"), _r("z"))


_HALF = "with h as (select n_nationkey as instance_id, radians(n_nationkey*30.0)/2 as hy, radians(n_regionkey*20.0)/2 as hr, 1.0+n_nationkey % 3 as sx, 1.0+n_regionkey*0.5 as sy, 2.0 as sz, n_nationkey*100.0 as ix, n_regionkey*50.0 as iy, 5.0 as iz from {nation})"


@query("g3_vertices_to_world", f"{_HALF} select instance_id, vertex_id, round(cos(2*hy)*sx*x - sin(2*hy)*(cos(2*hr)*sy*y - sin(2*hr)*sz*z) + ix,4)+0.0 as x, round(sin(2*hy)*sx*x + cos(2*hy)*(cos(2*hr)*sy*y - sin(2*hr)*sz*z) + iy,4)+0.0 as y, round(sin(2*hr)*sy*y + cos(2*hr)*sz*z + iz,4)+0.0 as z from {{vertices}} cross join h")
def _(spark, d):
    """Instances turned by roll and then yaw, as quaternions; the oracle turns by the angles."""
    half = table(spark, d, "nation").selectExpr("n_nationkey as instance_id", "radians(n_nationkey * 30D) / 2 as hy", "radians(n_regionkey * 20D) / 2 as hr", "1D + n_nationkey % 3 as sx", "1D + n_regionkey * 0.5D as sy", "2D as sz", "n_nationkey * 100D as ix", "n_regionkey * 50D as iy", "5D as iz")
    inst = half.selectExpr("instance_id", "sx", "sy", "sz", "cos(hy) * sin(hr) as qx", "sin(hy) * sin(hr) as qy", "sin(hy) * cos(hr) as qz", "cos(hy) * cos(hr) as qw", "ix", "iy", "iz")
    return G.vertices_to_world(table(spark, d, "vertices"), inst).select("instance_id", "vertex_id", _r("x"), _r("y"), _r("z"))


@query("g4_inside_test", "with b as (select point_id, actor_id, bool_or(direction='up') and bool_or(direction='down') as both_ from {ray_hits} group by 1,2) select point_id, bool_or(both_) as inside from b group by 1")
def _(spark, d):
    return G.inside_test(table(spark, d, "ray_hits"))


@query("g5_visibility_test", "select o_orderkey as ray_id, 10.0::double as distance from {orders} where not exists (select 1 from {ray_hits} h where h.ray_id=o_orderkey and h.dist<10)")
def _(spark, d):
    return G.visibility_test(table(spark, d, "orders").selectExpr("o_orderkey as ray_id", "10D as distance"), table(spark, d, "ray_hits"))


@query("g6_visual_centre", "with h as (select ray_id, arg_min(struct_pack(a := actor_id, d := dist), struct_pack(d := dist, r := hit_rank, a := actor_id)) as h from {ray_hits} where dist<=20 group by 1) select o_orderkey as ray_id, h.h.a as actor_id, h.h.d as dist, h.h is not null as found from {orders} left join h on h.ray_id=o_orderkey")
def _(spark, d):
    return G.visual_centre(table(spark, d, "orders").select(F.col("o_orderkey").alias("ray_id")), table(spark, d, "ray_hits"), 20.0)


@query("g7_scene_visibility_matrix", "with a as (select map_path, target_label as actor, false as occ from {targets} union all select map_path, 'Tree_'||map_id, true from {maps}) select t.map_path, t.target_label as target, a.actor, s.suffix, case when a.occ then s.suffix='occ' else a.actor=t.target_label end as visible from {targets} t join a using (map_path) cross join (select 'occ' as suffix union all select 'GT') s")
def _(spark, d):
    t, m = table(spark, d, "targets"), table(spark, d, "maps")
    actors = t.selectExpr("map_path", "target_label as actor", "false as is_occluder").unionByName(m.selectExpr("map_path", "concat('Tree_', map_id) as actor", "true as is_occluder"))
    return G.scene_visibility_matrix(t.selectExpr("map_path", "target_label as target"), actors)


@query("g7_visible_actors", "with p as (select unnest(['occ','GT']) as suffix) select map_path, target_label as target, target_label as actor, suffix from {targets} cross join p union all select map_path, target_label, 'Tree_'||m.map_id, 'occ' from {targets} t join {maps} m using (map_path)")
def _(spark, d):
    t, m = table(spark, d, "targets"), table(spark, d, "maps")
    actors = t.selectExpr("map_path", "target_label as actor", "false as is_occluder").unionByName(m.selectExpr("map_path", "concat('Tree_', map_id) as actor", "true as is_occluder"))
    asked = t.selectExpr("map_path", "target_label as target", "explode(array('occ', 'GT')) as suffix")
    return G.visible_actors(asked, G.visibility_rules(actors))


@query("g8_select_actors", "select map_path, target_label as label, row_number() over (partition by map_path order by target_label) as place from {targets} where target_label like 'Target_0000%'")
def _(spark, d):
    return G.select_actors(table(spark, d, "targets").selectExpr("map_path", "target_label as label"), "Target_0000")


@query("g8_missing_actors", "select map_path, target_label as label from {targets} where target_id % 7 = 0")
def _(spark, d):
    t = table(spark, d, "targets")
    return G.missing_actors(t.filter("target_id % 7 <> 0").selectExpr("map_path", "target_label as label"), t.selectExpr("map_path", "target_label as label"))


@query("g9_stencil_palette", "with o as (select p_size as scene, p_partkey as pos, p_name as name, 1 + p_partkey*17 % 260 as value from {part}), s as (select scene, min(pos) as stop from o where value>=255 group by 1), p as (select n_nationkey*10+1 as value, n_name as colour from {nation}) select o.scene, pos, o.name, cast(o.value as bigint) as key, colour from o left join s using (scene) left join p on p.value=o.value where stop is null or pos<stop")
def _(spark, d):
    objects = table(spark, d, "part").selectExpr("p_size as scene", "p_partkey as pos", "p_name as name", "1 + p_partkey * 17 % 260 as value")
    return G.stencil_palette(objects, table(spark, d, "nation").selectExpr("n_nationkey * 10 + 1 as value", "n_name as colour"), False)


# Streams: the tables are written as JSON lines in time order and read back as streams over what there is.


def _streamed(spark, rows, build, mode="append", rocks=False):
    folder = new_folder(spark, "stream")
    rows.write.json(f"{folder}/in")
    S.drain(build(spark.readStream.schema(rows.schema).json(f"{folder}/in")), f"{folder}/out", f"{folder}/state", mode, rocks)
    return spark.read.parquet(f"{folder}/out")


@query("st1_step_stream", f"with {_STEPS} select event_id, step_id, files_present, success from s")
def _(spark, d):
    folder = new_folder(spark, "steps")
    _steps(spark, d).write.json(f"{folder}/in")
    S.drain(S.step_stream(spark, f"{folder}/in"), f"{folder}/out", f"{folder}/state")
    return spark.read.schema(S.STEP).parquet(f"{folder}/out").select("event_id", "step_id", "files_present", "success")


_TOTALS = """select run_label, event_id, ts, sum(case when event_type='view' then 4 else 0 end) over (partition by run_label, era order by event_id) as total
 from (select concat('run_', cast(user_id % 20 as varchar(9))) as run_label, event_id, ts, event_type, floor((row_number() over (partition by user_id % 20 order by event_id)) / 37) as era from {events})"""


@query("st2_live_throughput", f"""with s as ({_TOTALS}), p as (select *, coalesce(lag(total) over (partition by run_label order by ts, event_id), 0) as before, date_trunc('day', ts) + to_hours(cast(6*(hour(ts)//6) as bigint)) as b from s)
 select run_label, strftime(b, '%Y-%m-%d %H:%M:%S') as start, count(*) as samples, cast(sum(case when total<before then total else total-before end) as bigint) as files, count(*) filter (total<before) as restarts, round(sum(case when total<before then total else total-before end)/21600.0,6)+0.0 as files_per_second
 from p where b + interval 6 hours <= (select max(ts) from s) - interval 10 minutes group by run_label, b""")
def _(spark, d):
    """Windows of six hours that the watermark has closed; each run's total begins again every 37 samples, and files come in no order."""
    table(spark, d, "events").createOrReplaceTempView("st2_events")
    rows = spark.sql(_TOTALS.replace("{events}", "st2_events").replace("varchar(9)", "string")).withColumn("ts", F.col("ts").cast("timestamp"))
    got = _streamed(spark, rows.repartition(6, F.xxhash64("event_id")), lambda s: S.live_throughput(s, window_ms=6 * S.HOUR), rocks=True)
    return got.select("run_label", F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "samples", "files", "restarts", _r("files_per_second", 6))


_PLACED = "(select p.*, ts from {placement} p join {events} using (event_id))"
_SIGHT = "over (partition by run_label, pid order by ts, event_id rows between unbounded preceding and 1 preceding)"


@query("st3_placement_guard_stream", f"""with s as (select *, coalesce(last_value(case when gpu_index=0 then start_time end ignore nulls) {_SIGHT} = start_time and ts - last_value(case when gpu_index=0 then ts end ignore nulls) {_SIGHT} <= interval 24 hours, false) as verified from {_PLACED}),
 v as (select run_label, event_id, pid, {_WHY} as reason from s where gpu_index<>0 and ts < date_trunc('minute', (select max(ts) from s) - interval 10 minutes)) select run_label, min(event_id) as event_id, arg_min(pid, event_id) as pid, arg_min(reason, event_id) as reason from v where reason is not null group by 1""")
def _(spark, d):
    """Files come in no order; the guard judges what the watermark has passed."""
    rows = table(spark, d, "placement").join(table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts")), "event_id")
    rows = rows.select("run_label", "event_id", "ts", F.col("gpu_index").cast("long").alias("gpu_index"), "pid", "process_type", "framebuffer_mb", F.col("sm_util_percent").cast("double").alias("sm_util_percent"), F.col("start_time").cast("double").alias("start_time"))
    return _streamed(spark, rows.repartition(6, F.xxhash64("event_id")), lambda s: S.placement_guard_stream(s, 0), rocks=True)


@query("st4_progress_stream", "select 'run_'||user_id % 20 as run, count(*) filter (event_type<>'error') as completed, count(*) filter (event_type='error') as failed, count(*) filter (event_id % 4=0 and event_type<>'error') as resumed from {events} group by 1")
def _(spark, d):
    rows = table(spark, d, "events").selectExpr("concat('run_', user_id % 20) as run", "user_id as job_id", "event_id as attempt", "if(event_type = 'error', 1, 0) as returncode", "event_id % 4 = 0 and event_type <> 'error' as resumed", "cast(ts as timestamp) as ts")
    rows = rows.unionByName(rows.filter("attempt % 10 = 0"))  # requeued copies
    folder = new_folder(spark, "progress")
    rows.write.json(f"{folder}/in")
    last = f"{folder}/out"
    stream = S.progress_stream(spark.readStream.schema(rows.schema).json(f"{folder}/in"), "30 days")
    write = lambda df, epoch: df.write.mode("overwrite").parquet(last)  # noqa: E731  complete mode: each batch has all runs
    stream.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(last)
