"""Capture tables derived from the star-schema test tables, in SQL that Spark and DuckDB run alike.

{name} stands for a base table or another fixture. Some defects are planted (bad splits, view counts, dropped and empty
files), so that rule operators have something to find."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE = {"region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings"}

TABLES = {
    "maps": """
select concat('/Game/Map/dataset/', case when n_regionkey=3 then 'test' else 'train' end, '/scene_',
              lpad(cast(n_regionkey+7 as varchar(9)),3,'0'), '_env', lpad(cast(n_nationkey as varchar(9)),2,'0')) as map_path,
       n_nationkey as map_id,
       concat('scene_', lpad(cast(n_regionkey+7 as varchar(9)),3,'0')) as source_scene,
       case when n_regionkey=3 then 'test' else 'train' end as split
from {nation}""",
    "targets": """
select m.map_path, m.map_id, s.s_suppkey as target_id,
       concat('Target_', lpad(cast(s.s_suppkey as varchar(9)),6,'0')) as target_label,
       cast(s.s_suppkey*137 % 5000 as double) as x, cast(s.s_suppkey*281 % 7000 as double)*-1.0 as y,
       cast(s.s_suppkey % 423 as double) as z
from {supplier} s join {maps} m on s.s_nationkey = m.map_id""",
    "plan_rows": """
select concat('seq_', cast(o.o_orderkey as varchar(20))) as sequence_id, o.o_orderkey as seq_no,
       t.map_path, m.source_scene,
       case when o.o_orderkey % 997=0 then 'val' else m.split end as split, t.target_label,
       case when o.o_orderkey % 1009=0 then 24 else 25 end as expected_views,
       case o.o_orderkey % 5 when 0 then 'fix_line' when 1 then 'plane_grid' when 2 then 'rot_arc'
            when 3 then 'rot_spiral' else 'rand_shell' end as trajectory,
       case cast(floor(o.o_orderkey/5) as bigint) % 6 when 0 then 50.0 when 1 then 60.0 when 2 then 70.0
            when 3 then 80.0 when 4 then 100.0 else 120.0 end * cast(1 as double) as height_m,
       cast(cast(floor(o.o_orderkey/30) as bigint) % 3 * 120 as double) as yaw_deg
from {orders} o cross join (select count(*) as n_sup from {supplier}) k
join {targets} t on o.o_custkey % k.n_sup = t.target_id
join {maps} m on t.map_path = m.map_path""",
    "sequences": """
select min(seq_no) as seq_no, map_path, target_label, trajectory, height_m, yaw_deg,
       concat(replace(replace(map_path,'/Game/Map/dataset/train/',''),'/Game/Map/dataset/test/',''), '_', target_label,
              '_height_', lpad(cast(cast(height_m as int) as varchar(9)),3,'0'),
              '_ang_', lpad(cast(cast(yaw_deg as int) as varchar(9)),3,'0')) as prefix
from {plan_rows} group by map_path, target_label, trajectory, height_m, yaw_deg""",
    "files": """
select * from (
  select q.trajectory, q.prefix, x.suffix, p.pass_name, cast(n.n_nationkey as int) as frame,
         concat(q.trajectory,'/',q.prefix,'_',x.suffix,'/',p.pass_name,'/',
                lpad(cast(n.n_nationkey as varchar(9)),4,'0'),'.',p.ext) as rel_path,
         case when (q.seq_no*131+n.n_nationkey*17+x.k*7+p.k*3) % 2111=0 then 0
              else 1000+(q.seq_no*131+n.n_nationkey*17) % 5000 end as size,
         (q.seq_no*131+n.n_nationkey*17+x.k*7+p.k*3) % 3067 as drop_key
  from {sequences} q cross join {nation} n
  cross join (select 'occ' as suffix, 0 as k union all select 'GT', 1) x
  cross join (select 'rgb' as pass_name, 'png' as ext, 0 as k union all select 'depth','exr',1) p) z
where drop_key <> 0""",
    "attempts": """
select concat('job_', cast(user_id as varchar(20))) as job_id, user_id,
       row_number() over (partition by user_id order by event_id) as attempt,
       case when event_type='error' then 1 else 0 end as returncode, value as wall_seconds, event_id
from {events}""",
    "gpu_samples": """
select concat('run_', cast(user_id % 20 as varchar(9))) as run_label, cast(event_id as double) as elapsed_seconds,
       case when event_id % 50=0 then null else least(value,100.0) end as gpu_util_percent,
       cast(4000+(event_id*37) % 90000 as double) as gpu_memory_mb,
       sum(case when event_type='view' then 4 else 0 end)
         over (partition by user_id % 20 order by event_id) as image_files,
       case when event_id % 33=0 then null else cast(200+(event_id*7) % 500 as double) end as power_w
from {events}""",
    "placement": """
select concat('run_', cast(user_id % 20 as varchar(9))) as run_label, event_id, event_id % 4 as gpu_index, user_id % 50 as pid,
       case when event_type='error' then case when event_id % 2=0 then 'C' else 'C+G' end else 'G' end as process_type,
       case when event_id % 41=0 then null else cast(event_id*13 % 300 as double) end as framebuffer_mb,
       case when event_id % 7=0 then 5.0 else 0.0 end as sm_util_percent, floor(event_id/1000) as start_time
from {events}""",
    "assets": """
select concat('asset/', cast(doc_id as varchar(20))) as path, length(text) as n, doc_id, text from {documents}""",
    "tiles": """
select vec_id as tile_id, cast(floor(vec_id/2) as bigint) as pair_id, case when vec_id % 2=0 then 'GT' else 'occ' end as suffix, label,
       cast(pos % 8 as int) as x, cast(floor(pos/8) as int) as y, abs(cast(v as double))*100 as depth_m
from {pixels}""",
    "views": """
select p.pair_id, cast(n.n_nationkey as int) as frame,
       cast(p.pair_id % 5 as double)*0.01 + cast(n.n_nationkey as double)*0.004 as theta,
       cast(n.n_nationkey as double)*0.03 as tx, cast(p.pair_id % 3 as double)*-0.01*cast(n.n_nationkey as double) as ty,
       cast(n.n_nationkey as double)*0.01 as tz
from (select distinct cast(floor(vec_id/2) as bigint) as pair_id from {embeddings}) p cross join {nation} n""",
    "audit_pairs": """
select pair_id, pair_id*2 as image_a, pair_id*2+1 as image_b, case when pair_id % 2=0 then 'GT' else 'occ' end as suffix,
       case pair_id % 3 when 0 then 'rot_arc' when 1 then 'rot_spiral' else 'rand_shell' end as family,
       case pair_id % 8 when 0 then 0 when 1 then 5 when 2 then 11 when 3 then 12 when 4 then 18 when 5 then 23 when 6 then 12 else 0 end as frame_a,
       case pair_id % 8 when 0 then 1 when 1 then 6 when 2 then 12 when 3 then 13 when 4 then 19 when 5 then 24 when 6 then 14 else 12 end as frame_b
from (select cast(floor(vec_id/2) as bigint) as pair_id, count(*) as n from {embeddings} group by 1) q where n=2""",
    "rgbd": """
select tile_id as image, x, y,
       4.0 + cast(pair_id % 10 as double)*0.3 + cast(x as double)*0.004 + cast(y as double)*0.003 + depth_m*0.0005
           + case when (tile_id*7 + x*3 + y*5) % 53=0 then 1.5 else 0.0 end as depth,
       cast((pair_id*3 + x*20 + y*10) % 256 as double) as red, cast((pair_id*5 + x*7) % 256 as double) as green, depth_m as blue
from {tiles}""",
    "matches": """
select p.pair_id, p.family, p.suffix, p.image_a, g.x*8+g.y as match_id, cast(g.x as double) as ax, cast(g.y as double) as ay, g.depth,
       10.5*q.xx/q.zz + 4.0 - 0.5 + cast((g.x*3 + g.y*7 + p.pair_id) % 5 - 2 as double)*0.02
           + case (g.x*5 + g.y*3 + p.pair_id) % 22 when 0 then 5.0 when 11 then -5.0 else 0.0 end as bx,
       10.5*q.yy/q.zz + 4.0 - 0.5 + cast((g.x*7 + g.y*3 + p.pair_id) % 5 - 2 as double)*0.02 as by
from {audit_pairs} p join {rgbd} g on g.image = p.image_a
join (select a.pair_id, a.frame as fa, b.frame as fb, m.image, m.x, m.y,
        cos(a.theta-b.theta)*m.px + sin(a.theta-b.theta)*m.d + cos(b.theta)*(a.tx-b.tx) - sin(b.theta)*(a.tz-b.tz) as xx,
        m.py + a.ty - b.ty as yy,
        cos(a.theta-b.theta)*m.d - sin(a.theta-b.theta)*m.px + sin(b.theta)*(a.tx-b.tx) + cos(b.theta)*(a.tz-b.tz) as zz
      from (select image, x, y, depth*0.97 as d, (cast(x as double) - 3.5)/10.5*depth*0.97 as px, (cast(y as double) - 3.5)/10.5*depth*0.97 as py,
              cast(floor(image/2) as bigint) as pair_id from {rgbd}) m
      join {views} a on a.pair_id = m.pair_id join {views} b on b.pair_id = m.pair_id) q
  on q.pair_id = p.pair_id and q.fa = p.frame_a and q.fb = p.frame_b and q.image = g.image and q.x = g.x and q.y = g.y""",
    "ray_hits": """
select l_orderkey as ray_id, l_partkey % 200 as point_id, l_suppkey as actor_id, l_linenumber as hit_rank,
       cast(l_quantity as double) as dist, case when l_returnflag='A' then 'up' else 'down' end as direction
from {lineitem}""",
    "vertices": """
select p_partkey as vertex_id, cast(p_partkey*37 % 101 as double) as x, cast(p_partkey*53 % 103 as double) as y,
       cast(p_partkey*71 % 107 as double) as z
from {part}""",
    "faces": """
select p_partkey as face_id, p_partkey as a, p_partkey*7 % k.n + 1 as b, p_partkey*11 % k.n + 1 as c
from {part} cross join (select count(*) as n from {part}) k""",
    "frames": """
select q.trajectory, q.prefix, q.seq_no, q.height_m, q.yaw_deg, t.x as tx, t.y as ty, t.z as tz, cast(n.n_nationkey as int) as frame
from {sequences} q join {targets} t on q.map_path=t.map_path and q.target_label=t.target_label cross join {nation} n""",
}
#: The one fixture whose spelling has to differ.
PIXELS = {"spark": "select vec_id, label, pos, v from {embeddings} lateral view posexplode(embedding) e as pos, v", "duckdb": "select vec_id, label, unnest(range(0, len(embedding))) as pos, unnest(embedding) as v from {embeddings}"}
#: In Spark the target's key is a column before the join. Else Spark may take the number of suppliers last, where a rule on the prefix
#: (which is of orders and targets) looks like a condition of their join, and pair every order with every target.
KEYED = ("from {orders} o cross join (select count(*) as n_sup from {supplier}) k\njoin {targets} t on o.o_custkey % k.n_sup = t.target_id", "from (select o_orderkey, o_custkey % n_sup as at from {orders} cross join (select count(*) as n_sup from {supplier})) o\njoin {targets} t on o.at = t.target_id")

#: In Spark a pair's two views are chosen before its pixels meet them. In the order above all 625 pairs of a sequence's views are
#: made for every pixel, shuffled, and one in 1,250 of the rows is kept. The formulas are those above.
MATCHES = """
select pair_id, family, suffix, image_a, x*8+y as match_id, cast(x as double) as ax, cast(y as double) as ay, depth,
       10.5*xx/zz + 4.0 - 0.5 + cast((x*3 + y*7 + pair_id) % 5 - 2 as double)*0.02
           + case (x*5 + y*3 + pair_id) % 22 when 0 then 5.0 when 11 then -5.0 else 0.0 end as bx,
       10.5*yy/zz + 4.0 - 0.5 + cast((x*7 + y*3 + pair_id) % 5 - 2 as double)*0.02 as by
from (select p.pair_id, p.family, p.suffix, p.image_a, m.x, m.y, m.depth,
        cos(p.ath-p.bth)*m.px + sin(p.ath-p.bth)*m.d + cos(p.bth)*(p.ax-p.bx) - sin(p.bth)*(p.az-p.bz) as xx,
        m.py + p.ay - p.by as yy,
        cos(p.ath-p.bth)*m.d - sin(p.ath-p.bth)*m.px + sin(p.bth)*(p.ax-p.bx) + cos(p.bth)*(p.az-p.bz) as zz
      from (select p.pair_id, p.family, p.suffix, p.image_a, a.theta as ath, a.tx as ax, a.ty as ay, a.tz as az,
              b.theta as bth, b.tx as bx, b.ty as by, b.tz as bz
            from {audit_pairs} p join {views} a on a.pair_id = p.pair_id and a.frame = p.frame_a
            join {views} b on b.pair_id = p.pair_id and b.frame = p.frame_b) p
      join (select image, x, y, depth, depth*0.97 as d, (cast(x as double) - 3.5)/10.5*depth*0.97 as px, (cast(y as double) - 3.5)/10.5*depth*0.97 as py
            from {rgbd}) m on m.image = p.image_a) q"""


def _names(sql: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", sql)))


def _sql(name: str, engine: str) -> str:
    if name == "pixels":
        return PIXELS[engine]
    if engine != "spark":
        return TABLES[name]
    return MATCHES if name == "matches" else TABLES[name].replace(*KEYED)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base table or fixture as a DataFrame."""
    if name in BASE:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    sql = _sql(name, "spark")
    return spark.sql(sql, **{n: table(spark, sf_dir, n) for n in _names(sql)})


def oracle(sql: str) -> str:
    """DuckDB SQL: the fixtures that {name} stands for become common table expressions."""
    order: list[str] = []

    def add(name: str) -> None:
        if name not in BASE and name not in order:
            for n in _names(_sql(name, "duckdb")):
                add(n)
            order.append(name)

    for name in _names(sql):
        add(name)
    plain = lambda s: re.sub(r"\{(\w+)\}", r"\1", s)
    ctes = ",\n".join(f"{n} as ({plain(_sql(n, 'duckdb'))})" for n in order)
    body = plain(sql).strip()
    if not ctes:
        return body
    return f"with {ctes},\n{body[5:]}" if body.startswith("with ") else f"with {ctes}\n{body}"
