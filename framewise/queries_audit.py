"""Registered queries of the RGB-D audit over poses and images; the fixture's images are 8 x 8, its cameras turn about one
axis, so that the oracles can write their moves in closed form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewise.fixtures import oracle, table
from framewise.operators import audit as A
from framewise.operators import pose as D
from framewise.operators import rgbd as E
from framewise.operators.complete import source_completeness
from framewise.sources.store import stash

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
FOCAL, CENTRE, SIDE = 10.0, 4.0, 8


def _poses(spark, d) -> DataFrame:
    return _turned(table(spark, d, "views").withColumnRenamed("pair_id", "sequence"))


def _turned(views: DataFrame) -> DataFrame:
    """Turned by theta about the second axis."""
    c, s, one, none = F.cos("theta"), F.sin("theta"), F.lit(1.0), F.lit(0.0)
    m = [[c, none, s], [none, one, none], [-s, none, c]]
    move = {f"r{i}{j}": m[i][j] for i in range(3) for j in range(3)} | {"t0": F.col("tx"), "t1": F.col("ty"), "t2": F.col("tz")}
    return views.withColumns(move).drop("theta", "tx", "ty", "tz")


def _pairs(spark, d) -> DataFrame:
    rows = table(spark, d, "audit_pairs").withColumns({"pair": F.col("pair_id"), "sequence": F.col("pair_id"), "f": F.lit(FOCAL), "c": F.lit(CENTRE)})
    return rows.select("pair", "sequence", "frame_a", "frame_b", "image_a", "image_b", "f", "c")


def _dense(spark, d, hypotheses=A.HYPOTHESES) -> DataFrame:
    return A.dense_pairs(table(spark, d, "rgbd"), _pairs(spark, d), _poses(spark, d), SIDE, SIDE, 1, hypotheses)


#: Moves of every pair under every hypothesis: angle of the turn, shift, and whether both cameras' axes are flipped.
_REL = """hyp as (select unnest(['correct','depth_cm_as_m','depth_divide_twice','double_yz_flip','c2w_as_w2c','focal_x2','radial_depth','pose_frame_plus1']) as mode),
 pm as (select p.*, h.mode, h.mode='c2w_as_w2c' as inv, case when h.mode='double_yz_flip' then -1.0 else 1.0 end as s, case h.mode when 'depth_cm_as_m' then 100.0 when 'depth_divide_twice' then 0.01 else 1.0 end as ds, case when h.mode='focal_x2' then 20.0 else 10.0 end as f, h.mode='radial_depth' as rad,
   case when h.mode='pose_frame_plus1' then least(frame_a+1,24) else frame_a end as fa, case when h.mode='pose_frame_plus1' then least(frame_b+1,24) else frame_b end as fb from {audit_pairs} p cross join hyp h),
 pv as (select pm.*, case when inv then -a.theta else a.theta end as tha, case when inv then -b.theta else b.theta end as thb,
   case when inv then sin(a.theta)*a.tz-cos(a.theta)*a.tx else a.tx end as pa0, case when inv then -a.ty else a.ty end as pa1, case when inv then -sin(a.theta)*a.tx-cos(a.theta)*a.tz else a.tz end as pa2,
   case when inv then sin(b.theta)*b.tz-cos(b.theta)*b.tx else b.tx end as pb0, case when inv then -b.ty else b.ty end as pb1, case when inv then -sin(b.theta)*b.tx-cos(b.theta)*b.tz else b.tz end as pb2
   from pm join {views} a on a.pair_id=pm.pair_id and a.frame=fa join {views} b on b.pair_id=pm.pair_id and b.frame=fb),
 rel as (select *, (tha-thb)*s as th, cos(thb)*(pa0-pb0)-sin(thb)*(pa2-pb2) as sx, (pa1-pb1)*s as sy, (sin(thb)*(pa0-pb0)+cos(thb)*(pa2-pb2))*s as sz from pv)"""
_GO = lambda x, y, depth: f"""select *, f*(cos(th)*px+sin(th)*dd+sx)/(case when abs(zz)>1e-12 then zz else 1e-12 end)+3.5 as qx, f*(py+sy)/(case when abs(zz)>1e-12 then zz else 1e-12 end)+3.5 as qy, zz as z from (select *, cos(th)*dd-sin(th)*px+sz as zz from (select *, ({x}-3.5)/f*dd as px, ({y}-3.5)/f*dd as py from (select *, case when rad then {depth}*ds/sqrt(pow(({x}-3.5)/f,2)+pow(({y}-3.5)/f,2)+1) else {depth}*ds end as dd from """
_STABLE = "sb as (select *, max(h) over v - min(l) over v <= greatest(0.08, 0.002*depth) and min(l) over v > 0 as stable from (select *, min(depth) over w as l, max(depth) over w as h from {rgbd} window w as (partition by image, y order by x rows between 1 preceding and 1 following)) window v as (partition by image, x order by y rows between 1 preceding and 1 following))"
_DENSE = f"""{_REL}, {_STABLE}, q as ({_GO('x', 'y', 'depth')} (select rel.*, a.x, a.y, a.depth, a.stable as sa, a.red, a.green, a.blue from rel join sb a on a.image=rel.image_a))))),
 n as (select q.pair_id, q.mode, q.x, q.y, any_value(ds) as ds, any_value(f) as f, any_value(rad) as rad, any_value(qx) as qx, any_value(qy) as qy, any_value(z) as z, any_value(q.depth) as depth, any_value(sa) as sa, any_value(q.red) as red, any_value(q.green) as green, any_value(q.blue) as blue,
   sum(w*coalesce(b.depth,0)) as td, sum(w*coalesce(b.red,0)) as tr, sum(w*coalesce(b.green,0)) as tg, sum(w*coalesce(b.blue,0)) as tb, max(case when nr then b.stable::int end) as st
   from (select *, floor(qx)+i as nx, floor(qy)+j as ny, abs(1-i-qx+floor(qx))*abs(1-j-qy+floor(qy)) as w, (qx-floor(qx)>=0.5)=(i=1) and (qy-floor(qy)>=0.5)=(j=1) as nr from q cross join (values (0),(1)) ii(i) cross join (values (0),(1)) jj(j)) q
   left join sb b on b.image=q.image_b and b.x=nx and b.y=ny group by 1,2,3,4),
 e as (select *, abs(tgt-z) as err, qx>=1 and qx<6 and qy>=1 and qy<6 and z>0 and depth>0 as ib from (select *, case when rad then td*ds/sqrt(pow((qx-3.5)/f,2)+pow((qy-3.5)/f,2)+1) else td*ds end as tgt from n)),
 s as (select *, ib and coalesce(sa,false) and coalesce(st=1,false) as stab from e),
 v as (select *, stab and tgt>0 and err<=greatest(0.1*ds,0.005*abs(z)) as vis, (pow(tr-red,2)+pow(tg-green,2)+pow(tb-blue,2))/3 as sq from s),
 w as (select *, ib and bool_or(vis and mode='correct') over (partition by pair_id, x, y) as sup from v),
 dp as (select pair_id as pair, mode, count(*) as samples, count(*) filter (ib) as in_bounds, count(*) filter (stab) as stable, count(*) filter (vis) as visible, avg(err) filter (vis) as mean_error, quantile_cont(err,0.5) filter (vis) as median_error, quantile_cont(err,0.95) filter (vis) as p95_error, max(err) filter (vis) as max_error, quantile_cont(err,0.95) filter (stab) as stable_p95, avg(err) filter (ib) as mean_error_all, quantile_cont(err,0.5) filter (ib) as median_error_all, quantile_cont(err,0.95) filter (ib) as p95_error_all,
   count(*) filter (sup) as rgb_support, coalesce(sum(sq) filter (sup),0) as sse, count(*) filter (vis)/greatest(count(*) filter (ib),1) as visible_fraction from w group by 1,2)"""
_DP = f"pair, mode, samples, in_bounds, stable, visible, {_R('visible_fraction', 'visible_fraction')}, {_R('mean_error', 'mean_error')}, {_R('median_error', 'median_error')}, {_R('p95_error', 'p95_error')}, {_R('stable_p95', 'stable_p95')}, {_R('mean_error_all', 'mean_error_all')}, {_R('median_error_all', 'median_error_all')}, {_R('p95_error_all', 'p95_error_all')}, rgb_support, {_R('case when rgb_support>0 then 10*log10(65025.0/greatest(sse/rgb_support,1e-12)) end', 'rgb_psnr')}"


def _columns() -> list:
    return ["pair", "mode", "samples", "in_bounds", "stable", "visible", *map(_r, ("visible_fraction", "mean_error", "median_error", "p95_error", "stable_p95", "mean_error_all", "median_error_all", "p95_error_all")), "rgb_support", _r("rgb_psnr")]


@query("e8_dense_pair", f"with {_DENSE} select {_DP} from dp where mode='correct'")
def _(spark, d):
    return _dense(spark, d, A.HYPOTHESES[:1]).select(*_columns())


@query("e9_negative_controls", f"with {_DENSE} select {_DP} from dp")
def _(spark, d):
    return _dense(spark, d).select(*_columns())


@query("e9_control_rollup", f"with {_DENSE} select mode, count(*) as pairs, {_R('avg(case when rgb_support>0 then 10*log10(65025.0/greatest(sse/rgb_support,1e-12)) end)', 'mean_psnr')}, {_R('case when sum(rgb_support)>0 and sum(sse)>0 then 10*log10(65025.0/(sum(sse)/sum(rgb_support))) end', 'pooled_psnr')}, cast(sum(rgb_support) as bigint) as rgb_support, {_R('quantile_cont(visible_fraction,0.5)', 'median_visible')} from dp group by 1")
def _(spark, d):
    return A.control_rollup(_dense(spark, d)).select("mode", "pairs", _r("mean_psnr"), _r("pooled_psnr"), "rgb_support", _r("median_visible"))


@query("e11_pair_enumeration", """select seq_no, prefix, a as frame_a, b as frame_b, suffix, 'dense' as kind from {sequences} cross join (values (0,1),(5,6),(11,12),(12,13),(18,19),(23,24),(12,14),(0,12)) p(a,b) cross join (values ('occ'),('GT')) s(suffix)
 union all select seq_no, prefix, a, b, suffix, 'feature' from {sequences} cross join (values ('GT',0,1),('GT',12,13),('GT',23,24),('occ',12,13)) p(suffix,a,b)""")
def _(spark, d):
    return A.audit_pairs(table(spark, d, "sequences").select("seq_no", "prefix"))


@query("e13_homography_gate", "with m as (select floor(vec_id/64) as pair, count(*) as n, count(*) filter (vec_id % 10<>3) as good from {embeddings} group by 1) select cast(pair as bigint) as pair, good as kept, true as only_true from m where n>=20 and good>=4")
def _(spark, d):
    """Matches follow one projective map a pair; every tenth is moved far off and must go. Image pairs are blocks of 64 rows."""
    m = table(spark, d, "embeddings").selectExpr("cast(floor(vec_id / 64) as bigint) as pair", "vec_id", "double(vec_id * 37 % 509) as ax", "double(vec_id * 91 % 503) as ay")
    m = m.withColumns({"w": F.expr("1 + 0.0002D * ax - 0.0001D * ay"), "off": F.expr("if(vec_id % 10 = 3, 90D + vec_id % 17 * 9, 0D)")})
    m = m.selectExpr("pair", "vec_id", "ax", "ay", "(ax + 0.05D * ay + pair % 7) / w + off as bx", "(ay - 0.04D * ax - 3) / w as by", "off = 0 as planted")
    full = m.groupBy("pair").agg(F.count("*").alias("n")).filter("n >= 20").select("pair")
    kept = A.homography_gate(m.join(full, "pair"))
    return kept.groupBy("pair").agg(F.count("*").alias("kept"), F.bool_and("planted").alias("only_true"))


def _matches(spark, d) -> DataFrame:
    return table(spark, d, "matches").withColumnsRenamed({"pair_id": "pair", "match_id": "match"})


_FE = f"fm as (select m.pair_id, m.match_id, m.ax as mx, m.ay as my, m.bx as ux, m.by as uy, sb.depth as fd from {{matches}} m join sb on sb.image=m.image_a and sb.x=m.ax and sb.y=m.ay where sb.stable and sb.depth>0), fe as (select pair_id, mode, sqrt(pow(qx-ux,2)+pow(qy-uy,2)) as e from ({_GO('mx', 'my', 'fd')} (select rel.*, mx, my, ux, uy, fd from rel join fm using (pair_id)))))))"
_M = f"{_REL}, {_STABLE}, {_FE}"


def _feature_errors(spark, d, hypotheses=A.HYPOTHESES) -> DataFrame:
    found = A.feature_depth(_matches(spark, d).drop("depth", "family", "suffix"), table(spark, d, "rgbd"))
    return A.feature_errors(found, A.relative_poses(_pairs(spark, d).drop("image_a", "image_b"), _poses(spark, d), hypotheses))


@query("e14_feature_reprojection_error", f"with {_M} select pair_id as pair, mode, count(*) as matches, {_R('quantile_cont(e,0.5)', 'median')}, {_R('avg(e)', 'mean')}, {_R('max(e)', 'max')}, count(*)>=12 as qualified from fe group by 1,2")
def _(spark, d):
    return _feature_errors(spark, d).select("pair", "mode", "matches", _r("median"), _r("mean"), _r("max"), "qualified")


_RES = f"{_REL}, r as (select family, qx-ux as dx, qy-uy as dy from ({_GO('mx', 'my', 'fd')} (select rel.*, m.ax as mx, m.ay as my, m.bx as ux, m.by as uy, m.depth as fd from rel join {{matches}} m using (pair_id) where mode='correct')))))), a as (select case when family='rand_shell' then 'holdout' else 'training' end as part, abs(unnest([dx, dy])) as e from r)"


def _parts(spark, d) -> DataFrame:
    moves = A.relative_poses(_pairs(spark, d).drop("image_a", "image_b"), _poses(spark, d), A.HYPOTHESES[:1])
    part = F.when(F.col("family") == "rand_shell", "holdout").otherwise("training").alias("part")
    return stash(_matches(spark, d).select("pair", part, "ax", "ay", "bx", "by", "depth").join(moves, "pair"), "matches")


@query("e15_scale_values")
def _(spark, d):
    """Both parts' summaries before and after the fit, with the scales that the training part gave: values, no truths."""
    rows = _parts(spark, d)
    focal, depth = A.fit_scales(rows.filter("part = 'training'"))
    got = A.scale_report(rows, focal, depth).withColumns({"focal_scale": F.lit(focal), "depth_scale": F.lit(depth)})
    return got.select("part", "fit", "n", "mean", "median", "p95", "max", "focal_scale", "depth_scale")


@query("e15_fit_scales", f"with {_RES} select part, count(*) as n, {_R('avg(e)', 'mean')}, {_R('quantile_cont(e,0.5)', 'median')}, {_R('quantile_cont(e,0.95)', 'p95')}, {_R('max(e)', 'max')}, true as better_after, true as scales_found from a group by 1")
def _(spark, d):
    """Summaries before the fit; afterwards both medians must be lower and the planted scales (1.05 and 0.97) found."""
    rows = _parts(spark, d)
    focal, depth = A.fit_scales(rows.filter("part = 'training'"))
    both = A.scale_report(rows, focal, depth)
    after = both.filter("fit = 'after'").select("part", F.col("median").alias("_after"))
    found = abs(focal - 1.05) < 0.02 and abs(depth - 0.97) < 0.02
    return both.filter("fit = 'before'").join(after, "part").select("part", "n", _r("mean"), _r("median"), _r("p95"), _r("max"), (F.col("_after") < F.col("median")).alias("better_after"), F.lit(found).alias("scales_found"))


@query("e16_point_cloud", f"with p as (select g.*, p.pair_id, p.frame_a, (x-3.5)/10.0*depth as px, (y-3.5)/10.0*depth as py from {{audit_pairs}} p join {{rgbd}} g on g.image=p.image_a where x % 2=0 and y % 2=0) select p.pair_id as sequence, frame, x, y, {_R('cos(theta)*px+sin(theta)*depth+tx-p.pair_id', 'wx')}, {_R('py+ty-1', 'wy')}, {_R('cos(theta)*depth-sin(theta)*px+tz-2', 'wz')}, red, green, {_R('blue', 'blue')} from p join {{views}} v on v.pair_id=p.pair_id and v.frame=p.frame_a")
def _(spark, d):
    poses = _poses(spark, d).withColumns({"target_x": F.col("sequence").cast("double"), "target_y": F.lit(1.0), "target_z": F.lit(2.0)})
    pixels = _pairs(spark, d).select("sequence", F.col("frame_a").alias("frame"), F.col("image_a").alias("image"), "f", "c").join(table(spark, d, "rgbd"), "image")
    return A.point_cloud(pixels, poses, 2).select("sequence", "frame", "x", "y", _r("wx"), _r("wy"), _r("wz"), "red", "green", _r("blue"))


@query("e19_pass_evidence", f"with {_DENSE}, t as (select case when pair % 2=0 then 'GT' else 'occ' end as suffix, visible_fraction as vf, case when stable>0 then stable_p95 end as p from dp where mode='correct') select suffix, count(*) as pairs, {_R('quantile_cont(vf,0.5)', 'median_visible')}, count(p) as n, {_R('avg(p)', 'mean')}, {_R('quantile_cont(p,0.5)', 'median')}, {_R('quantile_cont(p,0.95)', 'p95')}, {_R('max(p)', 'max')} from t group by 1")
def _(spark, d):
    suffix = table(spark, d, "audit_pairs").select(F.col("pair_id").alias("pair"), "suffix")
    got = A.pass_evidence(_dense(spark, d, A.HYPOTHESES[:1]).join(suffix, "pair"))
    return got.select("suffix", "pairs", _r("median_visible"), "n", *map(_r, ("mean", "median", "p95", "max")))


@query("e10_psnr_rollup", f"with {_DENSE}, p as (select dp.*, suffix, case when rgb_support>0 then 10*log10(65025.0/greatest(sse/rgb_support,1e-12)) end as ps from dp join {{audit_pairs}} on pair_id=pair) select suffix, mode, count(*) as pairs, {_R('avg(ps)', 'mean_psnr')}, {_R('case when sum(rgb_support)>0 and sum(sse)>0 then 10*log10(65025.0/(sum(sse)/sum(rgb_support))) end', 'pooled_psnr')}, cast(sum(rgb_support) as bigint) as rgb_support from p group by 1,2")
def _(spark, d):
    """By pass and hypothesis, from the colour errors of the dense pairs."""
    suffix = table(spark, d, "audit_pairs").select(F.col("pair_id").alias("pair"), "suffix")
    got = A.control_rollup(_dense(spark, d).join(suffix, "pair"), ("suffix", "mode"))
    return got.select("suffix", "mode", "pairs", _r("mean_psnr"), _r("pooled_psnr"), "rgb_support")


@query("e24_feature_error_by_trajectory", f"with {_M}, m as (select pair_id, quantile_cont(e,0.5) as med from fe where mode='correct' group by 1 having count(*)>=12) select family, count(*) as pairs, {_R('min(med)', 'least')}, {_R('quantile_cont(med,0.25)', 'q1')}, {_R('quantile_cont(med,0.5)', 'q2')}, {_R('quantile_cont(med,0.75)', 'q3')}, {_R('max(med)', 'greatest')} from m join {{audit_pairs}} using (pair_id) group by 1")
def _(spark, d):
    families = table(spark, d, "audit_pairs").select(F.col("pair_id").alias("pair"), "family")
    got = A.feature_error_by_family(_feature_errors(spark, d, A.HYPOTHESES[:1]), families)
    return got.select("family", "pairs", *map(_r, ("least", "q1", "q2", "q3", "greatest")))


@query("e23_assessment", f"""with {_DENSE}, {_FE}, sc as (select pair_id, family||'/'||(pair_id % 7) as scope, suffix, pair_id % 7=1 and pair_id % 5=0 as moved, pair_id % 7=2 and pair_id % 5=0 as turned, pair_id % 7=3 and pair_id % 5=0 as zoomed, pair_id % 7=4 and pair_id % 5=0 as stale, pair_id % 7=5 and pair_id % 5=0 as other from {{audit_pairs}}),
 ft as (select pair_id, quantile_cont(e,0.5) as med from fe where mode='correct' group by 1 having count(*)>=12), dd as (select pair as pair_id, stable_p95 as p from dp where mode='correct' and stable>0),
 ev as (select scope, count(*) as sequences, max(case when moved then 0.25 else 0 end)::double as pos, max(case when turned then 0.05 else 0 end)::double as ang, max(case when zoomed then 0.02 else 0 end)::double as k, not bool_or(stale or other) as st, quantile_cont(med,0.5) as fm, quantile_cont(case when suffix='GT' then p end,0.5) as gt, quantile_cont(p,0.5) as dpt from sc left join ft using (pair_id) left join dd using (pair_id) group by 1)
 select scope, sequences, {_R('pos', 'max_position_m')}, {_R('ang', 'max_rotation_deg')}, {_R('k', 'max_intrinsic_px')}, st as stored_matches, {_R('fm', 'feature_median_px')}, {_R('gt', 'gt_depth_p95_m')}, {_R('dpt', 'depth_p95_m')}, coalesce(pos<0.001 and ang<0.01 and k<0.001 and st and fm<1 and gt<0.15, false) as valid from ev""")
def _(spark, d):
    """The whole chain: poses against those expected, intrinsics against the lens, stored documents against fresh ones, matches
    and dense pairs. Some sequences of five scopes of every family are wrong in one frame or one number."""
    of = table(spark, d, "audit_pairs").selectExpr("pair_id as sequence", "pair_id as pair", "concat(family, '/', pair_id % 7) as scope", "suffix", "if(pair_id % 5 = 0, pair_id % 7, 0) as fault")
    views = table(spark, d, "views").withColumnRenamed("pair_id", "sequence").join(of.select("sequence", "fault"), "sequence")
    columns = {f"r{i}{j}": f"c{i}{j}" for i in range(3) for j in range(3)} | {"t0": "px", "t1": "py", "t2": "pz"}
    fresh = views.withColumns({"theta": F.expr("if(fault = 2 and frame = 3, theta + radians(0.05D), theta)"), "tz": F.expr("if(fault = 1 and frame = 7, tz + 0.25D, tz)")})
    poses = D.pose_error(*(_turned(v).withColumnsRenamed(columns) for v in (fresh, views)), ["sequence", "frame"])
    raw = E.raw_intrinsic_delta(of.selectExpr("sequence", f"({FOCAL} + if(fault = 3, 0.02D, 0D)) * 36 / {SIDE} as focal_mm", "36D as film_mm", f"{SIDE} as width", f"double({FOCAL}) as fx"))
    document = views.selectExpr("sequence", "frame", "fault", "array(cos(theta), sin(theta), tx, ty, tz) as pose", f"array({FOCAL}D, {CENTRE}D) as k", "sha2(string(sequence), 256) as source_hash")
    old = document.withColumns({"pose": F.expr("if(fault = 4 and frame = 24, transform(pose, (v, i) -> if(i = 3, v + 0.001D, v)), pose)"), "source_hash": F.expr("if(fault = 5, sha2('other', 256), source_hash)")})
    features = _feature_errors(spark, d, A.HYPOTHESES[:1]).withColumn("sequence", F.col("pair"))
    dense = _dense(spark, d, A.HYPOTHESES[:1]).join(of.select("pair", "sequence", "suffix"), "pair")
    got = A.assessment(of, poses, raw, A.stored_payload_delta(old, document), features, dense)
    return got.select("scope", "sequences", *map(_r, ("max_position_m", "max_rotation_deg", "max_intrinsic_px")), "stored_matches", *map(_r, ("feature_median_px", "gt_depth_p95_m", "depth_p95_m")), "valid")


@query("e20_existing_pose_delta", f"select pair_id as sequence, {_R('max(case when pair_id % 13=0 and frame=7 then 0.25::double else 0 end)', 'pose_delta', 9)}, {_R('max(case when pair_id % 11=0 then 0.5::double else 0 end)', 'k_delta', 9)}, pair_id % 7<>0 and pair_id % 17<>0 as hash_matches, pair_id % 17<>0 as matched from {{views}} group by pair_id")
def _(spark, d):
    """A second extraction of the same poses, with planted differences and missing frames."""
    rows = table(spark, d, "views").selectExpr("pair_id as sequence", "frame", "array(cos(theta), sin(theta), tx, ty, tz) as pose", "array(10D, 10D, 4D, 4D) as k", "sha2(string(pair_id), 256) as source_hash")
    fresh = rows.filter("not (sequence % 17 = 0 and frame = 4)").withColumns({
        "pose": F.expr("if(sequence % 13 = 0 and frame = 7, transform(pose, (v, i) -> if(i = 2, v + 0.25D, v)), pose)"),
        "k": F.expr("if(sequence % 11 = 0, transform(k, (v, i) -> if(i = 3, v - 0.5D, v)), k)"),
        "source_hash": F.expr("if(sequence % 7 = 0, sha2('other', 256), source_hash)"),
    })
    return A.stored_payload_delta(rows, fresh).select("sequence", _r("pose_delta", 9), _r("k_delta", 9), "hash_matches", "matched")


_SCOPE = "case seq_no % 3 when 0 then 'production_audit' when 1 then 'existing_json' else 'environment_audit' end"


@query("e22_coverage", f"""with s as (select trajectory||'/'||prefix as sequence, {_SCOPE} as scope, seq_no % 3=1 as existing from {{sequences}}), f as (select trajectory||'/'||prefix as sequence, count(distinct (suffix, frame)) as frames, count(*) filter (pass_name='rgb') as rgb, count(*) filter (pass_name='depth') as depth from {{files}} group by 1)
 select scope, count(*) as sequences, cast(coalesce(sum(frames),0) as bigint) as frames, cast(coalesce(sum(rgb),0) as bigint) as rgb_files, cast(coalesce(sum(depth),0) as bigint) as depth_files, count(*)*20 as pairs, count(*) filter (existing) as existing_json_pairs from s left join f using (sequence) group by 1""")
def _(spark, d):
    key = F.concat("trajectory", F.lit("/"), "prefix").alias("sequence")
    s = table(spark, d, "sequences").select(key, F.expr(_SCOPE).alias("scope"), (F.col("seq_no") % 3 == 1).alias("existing"))
    return A.coverage(s, table(spark, d, "files").select(key, "pass_name", "suffix", "frame"), A.audit_pairs(s.select("sequence")))


@query("e26_render_validation_report", """with m as (select map_path, map_id, row_number() over (order by map_id)-1 as k from {maps}), img as (select map_path, vec_id, case when vec_id % 211=0 then 'empty' when vec_id % 97=0 then 'constant' end as problem from {embeddings} join m on vec_id % 25=k),
 f as (select trajectory, prefix, count(*) filter (pass_name='rgb') as rgb, count(*) filter (pass_name='depth') as depth, count(*) filter (size>0) as good from {files} group by 1,2),
 q as (select map_path, count(*) as sequences, cast(coalesce(sum(rgb),0) as bigint) as rgb_files, cast(coalesce(sum(depth),0) as bigint) as depth_files, count(*) filter (coalesce(good,0)<100) as incomplete, count(*) filter (seq_no % 31=0 or seq_no % 37=0) as bad_sources from {sequences} left join f using (trajectory, prefix) group by 1),
 fr as (select image, min(depth) filter (depth>0) as lo, max(depth) filter (depth>0) as hi, quantile_cont(depth,0.5) filter (depth>0) as mid from {rgbd} group by 1), sq as (select map_path, cast(floor(image/50) as bigint) as s, min(lo) as least, max(hi) as greatest, quantile_cont(mid,0.5) as median from fr join m on image % 25=k group by 1,2),
 d as (select map_path, min(least) as least, max(greatest) as greatest, quantile_cont(median,0.5) as median from sq group by 1), p as (select map_path, count(problem) as rgb_problems from img group by 1)
 select map_path, sequences, rgb_files, depth_files, incomplete, bad_sources, coalesce(rgb_problems,0) as rgb_problems, round(least,4)+0.0 as least, round(greatest,4)+0.0 as greatest, round(median,4)+0.0 as median, cast(0 as bigint) as bad_frames, incomplete+bad_sources+coalesce(rgb_problems,0)=0 and least is not null as success from q left join p using (map_path) left join d using (map_path)""")
def _(spark, d):
    """Images belong to the 25 maps in turn; some are empty or of one colour, and some sources are missing or short."""
    maps = table(spark, d, "maps").select("map_path", F.col("map_id").alias("k"))
    images = table(spark, d, "embeddings").select("vec_id", F.expr("case when vec_id % 211 = 0 then array() when vec_id % 97 = 0 then array_repeat(float(1), 64) else embedding end").alias("data"))
    problems = E.rgb_frame_checks(images.withColumnRenamed("vec_id", "id").withColumns({"width": F.lit(SIDE), "height": F.lit(SIDE)}), SIDE, SIDE).join(maps, F.col("id") % 25 == F.col("k")).select("map_path", "problem")
    pixels = table(spark, d, "rgbd").join(maps, F.col("image") % 25 == F.col("k")).select(F.struct("map_path", F.floor(F.col("image") / 50).alias("s")).alias("sequence"), F.col("image").alias("frame"), "depth")
    depth = E.depth_frame_stats(pixels).select("sequence.map_path", "least", "greatest", "median", "bad_frames")
    sequences = table(spark, d, "sequences")
    sources = sequences.select("trajectory", "prefix", F.expr("if(seq_no % 37 = 0, 100, 5000)").alias("size")).join(sequences.filter("seq_no % 31 = 0").select("trajectory", "prefix"), ["trajectory", "prefix"], "left_anti")
    report = A.render_report(sequences, table(spark, d, "files"), problems, depth, source_completeness(sequences, sources))
    return report.select("map_path", "sequences", "rgb_files", "depth_files", "incomplete", "bad_sources", "rgb_problems", _r("least"), _r("greatest"), _r("median"), "bad_frames", "success")
