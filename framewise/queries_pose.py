"""Registered queries of the trajectory and pose operators."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from framewise.fixtures import oracle, table
from framewise.operators import plan as P
from framewise.operators import pose as D

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
KEYS = ["seq_no", "frame"]


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = oracle(sql)
        return f

    return add


def _frames(spark, d):
    return table(spark, d, "frames").select("seq_no", "frame", "tx", "ty", "tz", (F.col("height_m") * 100).alias("h"), F.col("yaw_deg").alias("yaw"), "trajectory", "prefix")


def _out(df, *names, keys=KEYS, digits=4):
    return df.select(*keys, *((F.round(n, digits) + 0.0).alias(n) for n in names))


_F = "f as (select seq_no, frame, tx, ty, tz, height_m*100 as h, yaw_deg as yaw, trajectory, prefix from {frames})"
_r = lambda e, n, digits=4: f"round({e}, {digits})+0.0 as {n}"
_xyz = lambda x, y, z: ", ".join((_r(x, "x"), _r(y, "y"), _r(z, "z")))
_STEP = "(frame-12)*(3500.0::double/24)"


@query("d1_canonical_pose", f"with {_F} select seq_no, frame, {_xyz('tx', 'ty', 'tz+h')}, 0.0::double as roll, -90.0::double as pitch, yaw from f")
def _(spark, d):
    return _out(D.canonical_pose(_frames(spark, d)), "x", "y", "z", "roll", "pitch", "yaw")


def _angles(spark, d):
    return _frames(spark, d).withColumns({"roll": (F.col("frame") * 7 % 90 - 45).cast("double"), "pitch": (F.col("seq_no") % 181 - 90).cast("double"), "yaw": (F.col("seq_no") * 13 % 360 - 180).cast("double")})


_ANGLES = "a as (select seq_no, frame, (frame*7 % 90 - 45)::double as roll, (seq_no % 181 - 90)::double as pitch, (seq_no*13 % 360 - 180)::double as yaw from {frames}), t as (select *, sin(radians(roll)) as sr, cos(radians(roll)) as cr, sin(radians(pitch)) as sp, cos(radians(pitch)) as cp, sin(radians(yaw)) as sy, cos(radians(yaw)) as cy from a)"
_M = {"r00": "cp*cy", "r01": "sr*sp*cy-cr*sy", "r02": "-(cr*sp*cy+sr*sy)", "r10": "cp*sy", "r11": "sr*sp*sy+cr*cy", "r12": "cy*sr-cr*sp*sy", "r20": "sp", "r21": "-sr*cp", "r22": "cr*cp"}


@query("d2_euler_to_matrix", f"with {_ANGLES} select seq_no, frame, {', '.join(_r(e, n, 6) for n, e in _M.items())} from t")
def _(spark, d):
    return _out(D.euler_to_matrix(_angles(spark, d)), *_M, digits=6)


_BASE = "(seq_no*29+frame*31) % 360 - 179.75"
_WRAP = lambda e: f"(({e})+180-360*floor((({e})+180)/360)-180)"


@query("d3_matrix_to_euler", f"""with {_ANGLES}, m as (select seq_no, frame, {_BASE}::double as b, {', '.join(f'{e} as {n}' for n, e in _M.items())} from t),
 e as (select seq_no, frame, b, sqrt(r00*r00+r10*r10) as flat, degrees(atan2(-r21,r22)) as x, degrees(atan2(r20,sqrt(r00*r00+r10*r10))) as p, degrees(atan2(r10,r00)) as w from m),
 c as (select seq_no, frame, b, flat, {_WRAP('x')} as x1, p as p1, b+{_WRAP('w-b')} as w1, {_WRAP('x+180')} as x2, -180-p as p2, b+{_WRAP('w+180-b')} as w2 from e),
 k as (select *, flat<1e-10 as down, x1*x1+(w1-b)*(w1-b)+0.25*(p1+90)*(p1+90) <= x2*x2+(w2-b)*(w2-b)+0.25*(p2+90)*(p2+90) as one from c)
 select seq_no, frame, {_r('case when down then 0 when one then x1 else x2 end', 'roll', 5)}, {_r('case when down then -90 when one then p1 else p2 end', 'pitch', 5)}, {_r('case when down then b when one then w1 else w2 end', 'yaw', 5)} from k""")
def _(spark, d):
    """Angles around a base yaw; pitches of 90 and -90 degrees are among them."""
    m = D.euler_to_matrix(_angles(spark, d)).withColumn("base", F.expr(f"cast({_BASE} as double)"))
    return _out(D.matrix_to_euler(m, "base"), "roll", "pitch", "yaw", digits=5)


@query("d4_traj_line", f"with {_F}, s as (select *, {_STEP} as s from f) select seq_no, frame, {_xyz('tx+s*cos(radians(yaw))', 'ty+s*sin(radians(yaw))', 'tz+h')}, -90.0::double as pitch from s")
def _(spark, d):
    return _out(D.traj_line(_frames(spark, d), 3500.0), "x", "y", "z", "pitch")


@query("d5_traj_grid", f"with {_F}, s as (select *, ((case when (frame//5) % 2=0 then frame % 5 else 4 - frame % 5 end)-2)*875.0::double as u, (2-(frame//5))*875.0::double as v from f) select seq_no, frame, {_xyz('tx+u*cos(radians(yaw))-v*sin(radians(yaw))', 'ty+u*sin(radians(yaw))+v*cos(radians(yaw))', 'tz+h')}, -90.0::double as pitch from s")
def _(spark, d):
    return _out(D.traj_grid(_frames(spark, d), 3500.0), "x", "y", "z", "pitch")


@query("d6_traj_arc", f"with {_F}, s as (select *, 90+(frame-12)*(90.0::double/24) as a from f) select seq_no, frame, {_xyz('tx+h*cos(radians(a))*cos(radians(yaw))', 'ty+h*cos(radians(a))*sin(radians(yaw))', 'tz+h*sin(radians(a))')}, {_r('a-180', 'pitch')} from s")
def _(spark, d):
    return _out(D.traj_arc(_frames(spark, d), 90.0), "x", "y", "z", "pitch")


_TRACK = "h*tan(radians(45))*sin(radians((frame-12)*3.75))/sin(radians(45))"


@query("d7_traj_tracking_line", f"with {_F}, s as (select *, {_TRACK} as s from f) select seq_no, frame, {_xyz('tx+s*cos(radians(yaw))', 'ty+s*sin(radians(yaw))', 'tz+h')}, {_r('-90-degrees(atan2(s,h))', 'pitch')} from s")
def _(spark, d):
    return _out(D.traj_tracking_line(_frames(spark, d), 90.0), "x", "y", "z", "pitch")


_DENSE = """dn as (select i, i/4096.0::double as s from range(0,4097) u(i)), dp as (select i, s, sin(radians((1-s)*45.0))*cos(radians(s*540.0)) as x, sin(radians((1-s)*45.0))*sin(radians(s*540.0)) as y, cos(radians((1-s)*45.0)) as z from dn),
 dl as (select i, s, coalesce(sqrt((x-lag(x) over w)**2+(y-lag(y) over w)**2+(z-lag(z) over w)**2),0) as st from dp window w as (order by i)), da as (select i, s, sum(st) over (order by i rows unbounded preceding) as pos from dl),
 ds as (select s, pos, lead(s) over (order by i) as s1, lead(pos) over (order by i) as pos1 from da), dw as (select f, total*f/24 as d from (select max(pos) as total from da) cross join range(0,25) v(f)),
 sm as (select cast(f as int) as frame, s + case when pos1 is null or pos1=pos then 0 else (d-pos)/(pos1-pos) end*(coalesce(s1,s)-s) as s from dw join ds on d>=pos and (d<pos1 or pos1 is null))"""


def _samples(spark):
    return D.resample_by_arc_length(D.dense_spiral(spark.range(D.DENSE), 90.0, 1.5))


@query("d9_resample_by_arc_length", f"with {_F}, {_DENSE} select f.seq_no, f.frame, round(sm.s, 6)+0.0 as s from f join sm using (frame) where trajectory='rot_spiral'")
def _(spark, d):
    rows = _frames(spark, d).filter("trajectory = 'rot_spiral'").join(_samples(spark), "frame")
    return _out(rows, "s", digits=6)


_SPIRAL = f"""with {_F}, {_DENSE}, j as (select f.*, (1-s)*45.0 as t, s*540.0+yaw as u from f join sm using (frame) where trajectory='rot_spiral'),
 q as (select *, case when frame=24 then tx else tx+h*sin(radians(t))*cos(radians(u)) end as x, case when frame=24 then ty else ty+h*sin(radians(t))*sin(radians(u)) end as y, case when frame=24 then tz+h else tz+h*cos(radians(t)) end as z from j),
 n as (select *, (tx-x)/h as ux, (ty-y)/h as uy, (tz-z)/h as uz, sin(radians(yaw)) as sy, cos(radians(yaw)) as cy from q),
 e as (select *, degrees(atan2(ux*sy-uy*cy, ux*cy+uy*sy)) as a, degrees(atan2(uz, sqrt(ux*ux+uy*uy))) as p, degrees(atan2(uy, ux)) as w from n),
 c as (select *, {_WRAP('a')} as x1, {_WRAP('w-yaw')} as w1, {_WRAP('a+180')} as x2, {_WRAP('w+180-yaw')} as w2 from e)
 select seq_no, frame, {', '.join((_r('x', 'x', 3), _r('y', 'y', 3), _r('z', 'z', 3)))}, {_r('case when frame=24 then 0 when x1*x1+w1*w1<=x2*x2+w2*w2 then x1 else x2 end', 'roll', 3)}, {_r('case when frame=24 then -90 when x1*x1+w1*w1<=x2*x2+w2*w2 then p else -180-p end', 'pitch', 3)}, {_r('case when frame=24 then yaw when x1*x1+w1*w1<=x2*x2+w2*w2 then yaw+w1 else yaw+w2 end', 'yaw', 3)} from c"""


@query("d8_traj_spiral", _SPIRAL)
def _(spark, d):
    return _out(D.traj_spiral(_frames(spark, d).filter("trajectory = 'rot_spiral'"), _samples(spark), 90.0, 1.5), "x", "y", "z", "roll", "pitch", "yaw", digits=3)


def _shell(spark, d):
    plan = table(spark, d, "plan_rows")
    seeds = P.trajectory_seed(plan).withColumn("seed", F.col("seed").cast("string"))
    rows = plan.filter("trajectory = 'rand_shell'").select("sequence_id", "seq_no", "map_path", "target_label", (F.col("height_m") * 100).alias("h"), F.col("yaw_deg").alias("yaw"))
    targets = table(spark, d, "targets").select("map_path", "target_label", F.col("x").alias("tx"), F.col("y").alias("ty"), F.col("z").alias("tz"))
    return D.traj_random_shell(rows.join(seeds, "sequence_id").join(targets, ["map_path", "target_label"]), 5000.0, 12000.0, 120.0)


@query("d10_traj_random_shell", "select seq_no, cast(25 as bigint) as frames, true as inside, true as even, true as ends_at_reference, true as looks_at_target from {plan_rows} where trajectory='rand_shell'")
def _(spark, d):
    """Whether all 25 frames stay inside the shell and cap at steps of much the same chord, the last one is the reference pose,
    and every camera's forward axis points at the target. Positions are held against Python's generator in the tests."""
    s = D.euler_to_matrix(_shell(spark, d)).withColumn("n", F.expr("sqrt(pow(tx - x, 2) + pow(ty - y, 2) + pow(tz - z, 2))"))
    gap = F.greatest(*(F.abs(F.col(f"r{k}0") - (F.col(f"t{c}") - F.col(c)) / F.col("n")) for k, c in enumerate("xyz")))
    w = Window.partitionBy("seq_no").orderBy("frame")
    s = s.withColumn("chord", F.sqrt(sum((F.pow(F.col(c) - F.lag(c).over(w), 2) for c in "xyz"), F.lit(0.0))))
    return s.groupBy("seq_no").agg(
        F.count("*").alias("frames"), F.bool_and(F.expr("radius between 4999.999 and 12000.001 and tilt <= 60.001")).alias("inside"),
        (F.max("chord") < 2 * F.avg("chord")).alias("even"),
        F.bool_and(F.expr("frame < 24 or (x = tx and y = ty and z = tz + h and roll = 0 and pitch = -90)")).alias("ends_at_reference"),
        F.bool_and(gap < 1e-6).alias("looks_at_target"),
    )


def _basis_sql(i: int, k: int, knots: list[float]) -> str:
    """Basis function i of degree k by its recursive definition."""
    if k == 0:
        return f"(case when t>={knots[i]} and (t<{knots[i + 1]} or (t=1 and {knots[i + 1]}=1)) and {knots[i]}<{knots[i + 1]} then 1.0::double else 0.0 end)"
    one = f"(t-{knots[i]})/{knots[i + k] - knots[i]}*{_basis_sql(i, k - 1, knots)}" if knots[i + k] > knots[i] else "0.0::double"
    two = f"({knots[i + k + 1]}-t)/{knots[i + k + 1] - knots[i + 1]}*{_basis_sql(i + 1, k - 1, knots)}" if knots[i + k + 1] > knots[i + 1] else "0.0::double"
    return f"({one}+{two})"


_BASIS = [_r(_basis_sql(i, 3, [0, 0, 0, 0, 0.2, 0.4, 0.6, 0.8, 1, 1, 1, 1]), f"n{i}", 9) for i in range(8)]


@query("d11_bspline_eval", f"with p as (select event_id as id, value-floor(value) as t from {{events}}) select id, 1.0::double as total, {', '.join(_BASIS)} from p")
def _(spark, d):
    """All eight basis values at the fractions of the events' values."""
    points = table(spark, d, "events").selectExpr("event_id as id", "double(value) - floor(value) as t")
    return D.bspline_eval(points).select("id", F.round("total", 9).alias("total"), *((F.round(F.get("basis", k), 9) + 0.0).alias(f"n{k}") for k in range(8)))


_LOOK = f"""with {_F}, p as (select *, tx+s*cos(radians(yaw)) as x, ty+s*sin(radians(yaw)) as y, case when seq_no % 101=0 then tz-1 else tz+h end as z from (select *, {_STEP} as s from f)),
 u as (select seq_no, frame, tz<z as above, (tx-x)/n as ux, (ty-y)/n as uy, (tz-z)/n as uz from (select *, sqrt((tx-x)**2+(ty-y)**2+(tz-z)**2) as n from p))"""


@query("d13_lookat_rotations", f"{_LOOK} select seq_no, frame, above, case when above then round(degrees(acos(greatest(-1.0,least(1.0,-uz)))),4)+0.0 end as angle, case when above then round(-uz+uy*uy/(1-uz),6)+0.0 end as a00, case when above then round(-uy*ux/(1-uz),6)+0.0 end as a01, case when above then round(-ux,6)+0.0 end as a02, case when above then round(-uz,6)+0.0 end as a22 from u")
def _(spark, d):
    rows = D.traj_line(_frames(spark, d), 3500.0).withColumn("z", F.expr("if(seq_no % 101 = 0, tz - 1, z)"))
    got = D.lookat_rotations(rows)
    return got.select(*KEYS, "above", (F.round("angle", 4) + 0.0).alias("angle"), *((F.round(c, 6) + 0.0).alias(c) for c in ("a00", "a01", "a02", "a22")))


def _payloads(spark, d):
    c = "if(frame = 3 and seq_no % 17 = 0, 2.0D, 1.0D)"
    m = f"array({c}, 0D, 0D, tx, 0D, 1D, 0D, ty, 0D, 0D, 1D, tz, 0D, 0D, 0D, 1D)"
    path = "concat('../rgb/', lpad(cast(if(seq_no % 23 = 0 and frame = 3, 7, frame) as string), 4, '0'), '.png') as file_path"
    rows = _frames(spark, d).filter("not (seq_no % 19 = 0 and frame = 24)").selectExpr("seq_no", "frame as frame_id", path, f"{m} as m")
    return D.build_payload(rows)


_CODES = {
    "schema_version": "seq_no % 29=0", "depth_units": "seq_no % 41=0", "num_views": "seq_no % 59=0", "pixel_center_offset": "seq_no % 61=0", "trajectory": "seq_no % 53=0",
    "center_idx": "(seq_no % 31=0) or (seq_no % 53=0 and t in ('rot_spiral','rand_shell'))", "intrinsics": "seq_no % 37=0", "principal_point": "seq_no % 67=0", "frame_count": "seq_no % 19=0", "path": "seq_no % 23=0", "rigid": "seq_no % 17=0",
}


@query("d14_pose_rules", "with s as (select seq_no, any_value(trajectory) as t from {frames} group by 1) select seq_no as id, concat_ws(',', " + ", ".join(f"case when {c} then '{k}' end" for k, c in _CODES.items()) + ") as codes from s")
def _(spark, d):
    """Documents with planted faults: other constants, a centre that the document's own trajectory doesn't have, frame 3 with the image
    of frame 7."""
    kind = _frames(spark, d).groupBy("seq_no").agg(F.max("trajectory").alias("t"))
    docs = _payloads(spark, d).join(kind, "seq_no").selectExpr(
        "seq_no as id", "if(seq_no % 29 = 0, 'camera-json-v2', 'camera-json-v1-25views') as schema_version", "'opencv_c2w' as coordinate_convention", "'m' as translation_units", "if(seq_no % 41 = 0, 'm', 'cm') as depth_units", "512 as w", "512 as h",
        "if(seq_no % 59 = 0, 24, 25) as num_views", "true as includes_occ_center", "'sequence' as view_order", "if(seq_no % 61 = 0, 0D, 0.5D) as pixel_center_offset", "if(seq_no % 53 = 0, 'orbit', t) as trajectory",
        "if(if(seq_no % 31 = 0, seq_no % 53 = 0 or t not in ('rot_spiral', 'rand_shell'), t in ('rot_spiral', 'rand_shell')), 24, 12) as center_idx", "if(seq_no % 37 = 0, double('nan'), 500D) as fl_x", "500D as fl_y", "256D as cx", "if(seq_no % 67 = 0, 512.5D, 256D) as cy", "frames",
    )
    return D.pose_rules(docs)


@query("d15_build_payload", "select seq_no, count(*) as frames, string_agg(frame::varchar, ',' order by frame) as order_ from {frames} where not (seq_no % 19=0 and frame=24) group by 1")
def _(spark, d):
    return _payloads(spark, d).select("seq_no", F.size("frames").cast("long").alias("frames"), F.array_join(F.transform("frames", lambda f: f["frame_id"].cast("string")), ",").alias("order_"))


_D16 = "(select *, case when id % 7=0 then 'reflection' when id % 5=0 then 'singular' when id % 3=0 then 'not_uniform' when id % 11=0 then 'not_affine' else 'ok' end as status from (select l_orderkey*10+l_linenumber as id, l_partkey % 360 - 180 as a from {lineitem}))"


@query("d16_rigid_c2w", f"select id, case when id % 11=0 then 'not_affine' else status end as status, {', '.join(f'case when status={chr(39)}ok{chr(39)} then round({e},6)+0.0 end as {n}' for n, e in (('m00', 'cos(radians(a))'), ('m01', 'sin(radians(a))'), ('m10', 'sin(radians(a))'), ('m11', '-cos(radians(a))'), ('m22', '-1.0::double'), ('m03', '1.0::double')))} from {_D16}")
def _(spark, d):
    """Turned and scaled matrices, with a shear far below the tolerance that must not come through as scale."""
    rows = table(spark, d, "lineitem").selectExpr("l_orderkey * 10 + l_linenumber as id", "double(1 + l_partkey % 4) / 100 as s", "radians(l_partkey % 360 - 180) as a")
    first = "if(id % 7 = 0, -s, if(id % 5 = 0, 0D, if(id % 3 = 0, 1.01D * s, s)))"
    e = f"array({first} * cos(a), -s * sin(a), 0D, 1D, {first} * sin(a), s * cos(a), 0D, 2D, 0D, 0D, s, 3D, 0D, 0D, if(id % 11 = 0, 1D, 0D), 1D)"
    got = D.rigid_c2w(rows.selectExpr("id", f"{e} as m"))
    return got.select("id", "status", *((F.round(F.get("c2w", 4 * i + j), 6) + 0.0).alias(f"m{i}{j}") for i, j in ((0, 0), (0, 1), (1, 0), (1, 1), (2, 2), (0, 3))))


_PROJ = "(select l_orderkey*10+l_linenumber as id, 2.0::double*(1+l_partkey % 9) * case when l_suppkey % 11=0 then -1 else 1 end as p00, 1.5::double*(1+l_suppkey % 9) as p11, (l_quantity-25)::double/20 as p02, l_discount::double as p12, l_partkey, l_linenumber from {lineitem})"


@query("d17_intrinsics_from_projection", f"with i as (select *, p00*256 as fx, p11*256 as fy, (1-p02)*256 as cx, (1+p12)*256 as cy from {_PROJ}) select id, case when l_partkey % 13=0 then 'orthographic' when l_partkey % 17=0 or l_partkey % 19=0 or l_partkey % 23=0 then 'skew' when fx<=0 or fy<=0 then 'focal' when not (cx between 0 and 512 and cy between 0 and 512) then 'principal_point' else 'ok' end as status, {', '.join(_r(c, c) for c in ('fx', 'fy', 'cx', 'cy'))} from i")
def _(spark, d):
    """Projections whose last row is not a perspective's, with skew, off-axis terms, negative focal lengths, shifts too wide."""
    off = lambda k: f"if(l_partkey % {k} = 0, 0.001D, 0D)"
    m = f"array(2D * (1 + l_partkey % 9) * if(l_suppkey % 11 = 0, -1, 1), {off(17)}, double(l_quantity - 25) / 20, {off(19)}, 0D, 1.5D * (1 + l_suppkey % 9), double(l_discount), {off(23)}, 0D, 0D, -1D, -0.2D, 0D, 0D, -1D, {off(13)})"
    rows = table(spark, d, "lineitem").selectExpr("l_orderkey * 10 + l_linenumber as id", f"{m} as m", "512 as width", "512 as height")
    got = D.intrinsics_from_projection(rows)
    return got.select("id", "status", *((F.round(c, 4) + 0.0).alias(c) for c in ("fx", "fy", "cx", "cy")))


@query("d18_intrinsics_constant", "select seq_no, case when seq_no % 43=0 then 0.5 else 0.0 end::double as largest, seq_no % 43<>0 as constant from (select distinct seq_no from {frames})")
def _(spark, d):
    rows = _frames(spark, d).selectExpr("seq_no", "frame", "500D + if(seq_no % 43 = 0 and frame = 9, 0.5D, 0D) as fx", "500D as fy", "256D as cx", "256D as cy")
    return D.intrinsics_constant(rows)


@query("d19_frame_range_rule", "select seq_no, (case when seq_no % 47=0 then 1 else 0 end + case when seq_no % 13=0 then 0.0005 else 0 end)::double as first, (case when seq_no % 5=0 then case when seq_no % 11=0 then 24.5 else 25 end else 24 end)::double as last, seq_no % 47<>0 and (seq_no % 5<>0 or (seq_no % 11<>0 and seq_no % 3<>0)) as ok from (select distinct seq_no from {frames})")
def _(spark, d):
    """Animations that start a little or a whole frame late, end between frames, or move in frame 25."""
    rows = _frames(spark, d).filter("not (seq_no % 47 = 0 and frame = 0)").selectExpr("seq_no", "double(frame) as frame", "array(double(frame), ty, tz) as pose")
    rows = rows.withColumn("frame", F.expr("if(seq_no % 13 = 0 and frame = if(seq_no % 47 = 0, 1, 0), frame + 0.0005D, frame)"))
    more = rows.filter("frame = 24 and seq_no % 5 = 0").withColumns({"frame": F.expr("if(seq_no % 11 = 0, 24.5D, 25D)"), "pose": F.expr("if(seq_no % 3 = 0, transform(pose, (v, i) -> if(i = 0, 99D, v)), pose)")})
    return D.frame_range_rule(rows.unionByName(more))


def _engine(spark, d):
    return D.traj_tracking_line(_frames(spark, d), 90.0).withColumn("roll", F.lit(0.0))


_CV = f"""with {_F}, e as (select seq_no, frame, tx+s*cos(radians(yaw)) as x, ty+s*sin(radians(yaw)) as y, tz+h as z, radians(-90-degrees(atan2(s,h))) as p, radians(yaw) as w from (select *, {_TRACK} as s from f))"""


@query("d20_to_opencv", f"{_CV} select seq_no, frame, {', '.join((_r('-sin(w)', 'c00', 6), _r('sin(p)*cos(w)', 'c01', 6), _r('cos(p)*cos(w)', 'c02', 6), _r('-cos(w)', 'c10', 6), _r('-cos(p)*sin(w)', 'c12', 6), _r('-cos(p)', 'c21', 6), _r('sin(p)', 'c22', 6), _r('x/100', 'px'), _r('-y/100', 'py'), _r('z/100', 'pz')))} from e")
def _(spark, d):
    got = D.to_opencv(_engine(spark, d))
    return got.select(*KEYS, *((F.round(c, 6) + 0.0).alias(c) for c in ("c00", "c01", "c02", "c10", "c12", "c21", "c22")), *((F.round(c, 4) + 0.0).alias(c) for c in ("px", "py", "pz")))


@query("d21_pose_error", f"with {_F} select seq_no, frame, case when frame % 4=0 then 0.5 else 0.0 end::double as position_m, case when seq_no % 3=0 then 2.0 else 0.0 end::double as rotation_deg from f")
def _(spark, d):
    a = _engine(spark, d)
    b = a.withColumn("z", F.expr("if(frame % 4 = 0, z + 50, z)")).withColumn("yaw", F.expr("if(seq_no % 3 = 0, yaw + 2, yaw)")).withColumn("pitch", F.col("pitch") * 0)
    a = a.withColumn("pitch", F.col("pitch") * 0)
    err = D.pose_error(D.to_opencv(a), D.to_opencv(b), KEYS)
    return err.select(*KEYS, (F.round("position_m", 4) + 0.0).alias("position_m"), (F.round("rotation_deg", 4) + 0.0).alias("rotation_deg"))


@query("d22_reference_view_consistency", "with v as (select case when min(seq_no) over (partition by prefix) % 2=0 then 'a' else 'b' end as scope, * from (select prefix, trajectory, min(seq_no) as seq_no, min(tx) + case when min(seq_no) % 6=0 then 0.25 else 0 end as x, case when min(seq_no) % 10=0 then 500.5 else 500.0 end as fx from {frames} where frame=12 group by 1,2)), f as (select scope, prefix, count(distinct trajectory) as trajectories, arg_min(x, trajectory) as f, min(x) as lo, max(x) as hi, arg_min(fx, trajectory) as g, min(fx) as gl, max(fx) as gh from v group by 1,2) select scope, prefix, trajectories, round(greatest(hi-f, f-lo),4)+0.0 as pose_delta, round(greatest(gh-g, g-gl),4)+0.0 as k_delta from f where trajectories>=2")
def _(spark, d):
    views = _frames(spark, d).filter("frame = 12").groupBy("prefix", "trajectory").agg(F.min("tx").alias("x"), F.min("seq_no").alias("n"))
    views = views.withColumn("least", F.min("n").over(Window.partitionBy("prefix"))).selectExpr("if(least % 2 = 0, 'a', 'b') as scope", "prefix", "trajectory", "x + if(n % 6 = 0, 0.25D, 0D) as x", "0D as y", "0D as z", "if(n % 10 = 0, 500.5D, 500D) as fx", "256D as cx")
    got = D.reference_view_consistency(views)
    return got.select("scope", "prefix", "trajectories", (F.round("pose_delta", 4) + 0.0).alias("pose_delta"), (F.round("k_delta", 4) + 0.0).alias("k_delta"))


@query("d22_reference_depth", "with t as (select label as scope, cast(floor(pair_id/4) as bigint) as prefix, tile_id as trajectory, x, y, depth_m as depth from {tiles}), f as (select *, first_value(depth) over (partition by scope, prefix, y, x order by trajectory) as d0 from t), g as (select scope, prefix, trajectory, avg(abs(depth-d0)) as off from f group by 1,2,3) select scope, prefix, count(*) as trajectories, round(max(off),4)+0.0 as depth_delta from g group by 1,2 having count(*)>=2")
def _(spark, d):
    rows = table(spark, d, "tiles").selectExpr("label as scope", "cast(floor(pair_id / 4) as bigint) as prefix", "tile_id as trajectory", "x", "y", "depth_m as depth")
    return D.reference_depth_consistency(rows).select("scope", "prefix", "trajectories", (F.round("depth_delta", 4) + 0.0).alias("depth_delta"))


@query("d23_pose_continuity", f"with {_F}, g as (select seq_no, frame, ((case when (frame//5) % 2=0 then frame % 5 else 4 - frame % 5 end)-2)*875.0::double as u, ((frame//5)-2)*875.0::double as v from f), s as (select seq_no, frame, sqrt((u-lag(u) over w)**2+(v-lag(v) over w)**2) as st from g window w as (partition by seq_no order by frame)) select seq_no, round(max(st),3) as largest, round(quantile_cont(st,0.5),3) as median, round(arg_max(st, frame),3) as last from s group by 1")
def _(spark, d):
    return _out(D.pose_continuity(D.traj_grid(_frames(spark, d), 3500.0)), "largest", "median", "last", keys=["seq_no"], digits=3)


@query("d24_recentre_keys", "select seq_no, frame, frame+100 as key, 100 + count(*) over (partition by seq_no) as end_ from {frames}")
def _(spark, d):
    return D.recentre_keys(_frames(spark, d), 100).select("seq_no", "frame", "key", F.col("end").alias("end_"))
