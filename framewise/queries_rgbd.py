"""Registered queries of the RGB-D audit; an embedding is an 8 x 8 depth tile."""

from __future__ import annotations

from pyspark.sql import functions as F

from framewise.fixtures import oracle, table
from framewise.operators import rgbd as E

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
_R = lambda e, n, k=4: f"round({e},{k})+0.0 as {n}"


def _tiles(spark, d):
    return table(spark, d, "tiles").withColumnRenamed("depth_m", "depth")


@query("e1_summarize", f"select label, count(depth_m) as n, {_R('avg(depth_m)', 'mean')}, {_R('quantile_cont(depth_m,0.5)', 'median')}, {_R('quantile_cont(depth_m,0.95)', 'p95')}, {_R('max(depth_m)', 'max')} from {{tiles}} group by 1")
def _(spark, d):
    return E.summarize(_tiles(spark, d), "depth", "label").select("label", "n", _r("mean"), _r("median"), _r("p95"), _r("max"))


_E2 = "case when tile_id % 37=0 and x=3 and y=3 then 'inf'::double when tile_id % 41=0 then 0 when tile_id % 43=0 and x=1 and y=0 then null else depth_m end"


@query("e2_depth_frame_stats", f"with t as (select label as sequence, tile_id, {_E2} as dm from {{tiles}}), f as (select sequence, tile_id, min(dm) filter (dm>0 and isfinite(dm)) as lo, max(dm) filter (dm>0 and isfinite(dm)) as hi, quantile_cont(dm,0.5) filter (dm>0 and isfinite(dm)) as mid, count(*) filter (dm is null or not isfinite(dm)) as bad from t group by 1,2) select sequence, {_R('min(lo)', 'least')}, {_R('max(hi)', 'greatest')}, {_R('quantile_cont(mid,0.5)', 'median')}, count(*) filter (lo is null or bad>0) as bad_frames from f group by 1")
def _(spark, d):
    """Tiles with an infinite, a null or no positive depth are bad frames; what is sound in them counts."""
    dm = "case when tile_id % 37 = 0 and x = 3 and y = 3 then double('inf') when tile_id % 41 = 0 then 0D when tile_id % 43 = 0 and x = 1 and y = 0 then null else depth end as depth"
    got = E.depth_frame_stats(_tiles(spark, d).selectExpr("label as sequence", "tile_id as frame", dm))
    return got.select("sequence", _r("least"), _r("greatest"), _r("median"), "bad_frames")


@query("e3_rgb_frame_checks", "select vec_id as id, case when vec_id % 11=0 then 'empty' when vec_id % 7=0 or vec_id % 13=0 then 'wrong_size' else 'constant' end as problem from {embeddings} where vec_id % 11=0 or vec_id % 7=0 or vec_id % 13=0 or vec_id % 5=0")
def _(spark, d):
    """Some images lack pixels, some have 4 x 16 of them in place of 8 x 8."""
    data = "case when vec_id % 11 = 0 then array() when vec_id % 7 = 0 then slice(embedding, 1, 60) when vec_id % 5 = 0 then array_repeat(float(1), 64) else embedding end as data"
    images = table(spark, d, "embeddings").selectExpr("vec_id as id", data, "if(vec_id % 13 = 0, 4, 8) as width", "if(vec_id % 13 = 0, 16, 8) as height")
    return E.rgb_frame_checks(images, 8, 8)


@query("e4_depth_channel_checks", "select vec_id as id, vec_id % 9<>0 as positive, vec_id % 4<>0 as same_channels from {embeddings}")
def _(spark, d):
    e = table(spark, d, "embeddings").withColumn("r", F.expr("transform(embedding, (x, i) -> if(vec_id % 9 = 0 and i = 5, 0D, abs(double(x)) + 1))"))
    return E.depth_channel_checks(e.select(F.col("vec_id").alias("id"), "r", F.col("r").alias("g"), F.expr("if(vec_id % 4 = 0, slice(r, 1, 63), r)").alias("b")))


_ST = "st as (select *, max(h) over v - 0 as hi, min(l) over v as lo from (select *, min(depth_m) over w as l, max(depth_m) over w as h from {tiles} window w as (partition by tile_id, y order by x rows between 1 preceding and 1 following)) window v as (partition by tile_id, x order by y rows between 1 preceding and 1 following))"


@query("e5_depth_stable_mask", f"with {_ST} select tile_id, x, y, {_R('hi-lo', 'spread', 6)}, hi-lo<=greatest(0.08, 0.002*depth_m) and lo>0 as stable from st")
def _(spark, d):
    got = E.depth_stable_mask(_tiles(spark, d), "tile_id")
    return got.select("tile_id", "x", "y", (F.round(F.col("hi") - F.col("lo"), 6) + 0.0).alias("spread"), "stable")


def _camera(rows):
    eye = {f"r{i}{j}": F.lit(1.0 if i == j else 0.0) for i in range(3) for j in range(3)}
    return rows.withColumns({**eye, "t0": F.lit(0.2), "t1": F.lit(-0.1), "t2": F.lit(0.05), "f": F.lit(10.0), "c": F.lit(4.0)})


@query("e6_project_pixels", f"with p as (select *, (x+0.5-4)/10*depth_m+0.2 as px, (y+0.5-4)/10*depth_m-0.1 as py, depth_m+0.05 as z from {{tiles}}) select tile_id, x, y, {_R('px/z*10+4', 'u')}, {_R('py/z*10+4', 'v')}, {_R('z', 'z')} from p")
def _(spark, d):
    return E.project_pixels(_camera(_tiles(spark, d))).select("tile_id", "x", "y", _r("u"), _r("v"), _r("z"))


_UV = "pt as (select tile_id*64+y*8+x as point, tile_id, x+0.5+0.3*(tile_id % 3) as u, y+0.5-0.2*(tile_id % 4) as v from {tiles})"


@query("e7_sample_image", f"""with {_UV}, n as (select point, tile_id, floor(u-0.5)+i as nx, floor(v-0.5)+j as ny, (case when i=1 then u-0.5-floor(u-0.5) else 1-(u-0.5)+floor(u-0.5) end)*(case when j=1 then v-0.5-floor(v-0.5) else 1-(v-0.5)+floor(v-0.5) end) as w from pt cross join (select 0 as i union all select 1) cross join (select 0 as j union all select 1))
 select point, n.tile_id, {_R('sum(w*coalesce(t.depth_m,0))', 'sample')} from n left join {{tiles}} t on t.tile_id=n.tile_id and t.x=nx and t.y=ny group by 1,2""")
def _(spark, d):
    t = _tiles(spark, d)
    points = t.selectExpr("tile_id * 64 + y * 8 + x as point", "tile_id", "x + 0.5D + 0.3D * (tile_id % 3) as u", "y + 0.5D - 0.2D * (tile_id % 4) as v")
    return E.sample_image(points, t, ["tile_id"]).select("point", "tile_id", _r("sample"))


@query("e7_sample_image_nearest", f"""with {_UV} select point, pt.tile_id, {_R('coalesce(t.depth_m,0)', 'sample')} from pt left join {{tiles}} t on t.tile_id=pt.tile_id and t.x=floor(u) and t.y=floor(v)""")
def _(spark, d):
    t = _tiles(spark, d)
    points = t.selectExpr("tile_id * 64 + y * 8 + x as point", "tile_id", "x + 0.5D + 0.3D * (tile_id % 3) as u", "y + 0.5D - 0.2D * (tile_id % 4) as v")
    return E.sample_image(points, t, ["tile_id"], nearest=True).select("point", "tile_id", _r("sample"))


@query("e12_descriptor_match", """with l as (select cast(floor(vec_id/64) as bigint) as pair, vec_id as a, list_transform(embedding, lambda v: v::double) as d from {embeddings}),
 r as (select cast(floor(vec_id/64) as bigint) as pair, vec_id as b, list_transform(embedding, lambda v, i: v::double + 0.001::double*((vec_id + i - 1) % 3)) as d from {embeddings}),
 k as (select pair from (select pair, count(*) as n from l group by 1) join (select pair, count(*) as m from r group by 1) using (pair) where n>=8 and m>=8),
 x as (select pair, a, b, list_distance(l.d, r.d) as dist from l join r using (pair) join k using (pair)),
 y as (select *, row_number() over (partition by pair, a order by dist, b) as ra, lead(dist) over (partition by pair, a order by dist, b) as na, row_number() over (partition by pair, b order by dist, a) as rb, lead(dist) over (partition by pair, b order by dist, a) as nb from x),
 m as (select *, count(*) over (partition by pair) as n from y where ra=1 and rb=1 and dist<0.75*na and dist<0.75*nb)
 select pair, a, b, round(dist,4)+0.0 as dist from m where n>=8""")
def _(spark, d):
    """Every row is on both sides, moved on the right; an image is a block of 64 rows."""
    e = table(spark, d, "embeddings")
    left = e.selectExpr("cast(floor(vec_id / 64) as bigint) as pair", "vec_id as id", "transform(embedding, v -> double(v)) as d")
    right = e.selectExpr("cast(floor(vec_id / 64) as bigint) as pair", "vec_id as id", "transform(embedding, (v, i) -> double(v) + 0.001D * ((vec_id + i) % 3)) as d")
    return E.descriptor_match(left, right).select("pair", "a", "b", _r("dist"))


QUERIES["e12_descriptor_match_all"], ORACLES["e12_descriptor_match_all"] = QUERIES["e12_descriptor_match"], ORACLES["e12_descriptor_match"]


@query("e17_half_float_step", f"select label, {_R('max(pow(2.0,floor(log2(depth_m))-10))', 'largest', 9)}, {_R('avg(pow(2.0,floor(log2(depth_m))-10))', 'mean', 9)} from {{tiles}} where depth_m>0.001 group by 1")
def _(spark, d):
    rows = _tiles(spark, d).filter("depth > 0.001").withColumn("step", E.half_float_step(F.col("depth")))
    return rows.groupBy("label").agg(F.max("step").alias("largest"), F.avg("step").alias("mean")).select("label", _r("largest", 9), _r("mean", 9))


@query("e18_occlusion_fractions", f"with g as (select pair_id as pair, x, y, max(case when suffix='GT' then depth_m end) as gt, max(case when suffix='occ' then depth_m end) as occ from {{tiles}} group by 1,2,3) select pair, {_R('avg((abs(gt-occ)<=greatest(0.08,0.002*gt))::int)', 'equal')}, {_R('avg((occ>gt and not abs(gt-occ)<=greatest(0.08,0.002*gt))::int)', 'farther')} from g where gt is not null and occ is not null group by 1")
def _(spark, d):
    return E.occlusion_fractions(_tiles(spark, d).withColumnRenamed("pair_id", "pair")).select("pair", _r("equal"), _r("farther"))


@query("e21_raw_intrinsic_delta", f"select l_orderkey*10+l_linenumber as id, {_R('(l_quantity+10)::double/35*512-512.0', 'delta')} from {{lineitem}}")
def _(spark, d):
    rows = table(spark, d, "lineitem").selectExpr("l_orderkey * 10 + l_linenumber as id", "double(l_quantity + 10) as focal_mm", "35D as film_mm", "512 as width", "512D as fx")
    return E.raw_intrinsic_delta(rows).select("id", _r("delta"))


@query("e25_depth_display_range", f"with e as (select tile_id, quantile_cont(depth_m,0.01) as lo, greatest(quantile_cont(depth_m,0.99), quantile_cont(depth_m,0.01)+0.05) as hi from {{tiles}} group by 1) select tile_id, x, y, {_R('greatest(0.0,least(255.0,(depth_m-lo)/(hi-lo)*255))', 'shade')} from {{tiles}} join e using (tile_id)")
def _(spark, d):
    return E.depth_display_range(_tiles(spark, d), "tile_id").select("tile_id", "x", "y", _r("shade"))


