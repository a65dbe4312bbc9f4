"""Camera trajectories and poses as column algebra.

Angles are degrees, engine lengths centimetres. Matrices are arrays of rows. frames rows carry frame (0..24), target
position tx, ty, tz, height h (cm) and yaw."""

from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FRAMES, CENTRE = 25, 12
DENSE = 4097


def sin(c) -> Column:
    return F.sin(F.radians(c))


def cos(c) -> Column:
    return F.cos(F.radians(c))


def wrap(c: Column) -> Column:
    """Degrees in [-180, 180)."""
    return F.pmod(c + 180, F.lit(360.0)) - 180


def canonical_pose(rows: DataFrame) -> DataFrame:
    """Straight above the target, looking down, turned by yaw."""
    return rows.withColumns({"x": F.col("tx"), "y": F.col("ty"), "z": F.col("tz") + F.col("h"), "roll": F.lit(0.0), "pitch": F.lit(-90.0), "yaw": F.col("yaw")})


def euler_matrix(roll: Column, pitch: Column, yaw: Column) -> list[list[Column]]:
    """Columns of the engine's rotation matrix (forward, right, up as columns)."""
    sr, cr, sp, cp, sy, cy = sin(roll), cos(roll), sin(pitch), cos(pitch), sin(yaw), cos(yaw)
    return [
        [cp * cy, sr * sp * cy - cr * sy, -(cr * sp * cy + sr * sy)],
        [cp * sy, sr * sp * sy + cr * cy, cy * sr - cr * sp * sy],
        [sp, -sr * cp, cr * cp],
    ]


def euler_to_matrix(rows: DataFrame) -> DataFrame:
    m = euler_matrix(F.col("roll"), F.col("pitch"), F.col("yaw"))
    return rows.withColumns({f"r{i}{j}": m[i][j] for i in range(3) for j in range(3)})


def matrix_to_euler(rows: DataFrame, base: str) -> DataFrame:
    """roll, pitch, yaw of r00..r22 around the base yaw. Two angle triples give one matrix; the one nearer to the canonical
    view (0, -90, base) is taken, by squared turns with a quarter's weight on pitch. Looking straight down is that view."""
    r = {(i, j): F.col(f"r{i}{j}") for i in range(3) for j in range(3)}
    flat, around = F.hypot(r[0, 0], r[1, 0]), F.col(base).cast("double")
    roll, pitch, yaw = F.degrees(F.atan2(-r[2, 1], r[2, 2])), F.degrees(F.atan2(r[2, 0], flat)), F.degrees(F.atan2(r[1, 0], r[0, 0]))
    one = (wrap(roll), pitch, around + wrap(yaw - around))
    two = (wrap(roll + 180), -180 - pitch, around + wrap(yaw + 180 - around))
    cost = lambda e: e[0] * e[0] + (e[2] - around) * (e[2] - around) + 0.25 * (e[1] + 90) * (e[1] + 90)
    nadir = (F.lit(0.0), F.lit(-90.0), around)
    chosen = [F.when(flat < 1e-10, nadir[k]).when(cost(one) <= cost(two), one[k]).otherwise(two[k]) for k in range(3)]
    return rows.withColumns(dict(zip(("roll", "pitch", "yaw"), chosen, strict=True)))


def _step(span: Column | float) -> Column:
    """-span/2 .. span/2 over the frames."""
    return (F.col("frame") - CENTRE) * (F.lit(span) / (FRAMES - 1))


def traj_line(rows: DataFrame, side: float) -> DataFrame:
    """Along the yaw direction with fixed nadir attitude; frame 12 is the canonical pose."""
    s = _step(side)
    return rows.withColumns({"x": F.col("tx") + s * cos("yaw"), "y": F.col("ty") + s * sin("yaw"), "z": F.col("tz") + F.col("h"), "pitch": F.lit(-90.0)})


def traj_grid(rows: DataFrame, side: float) -> DataFrame:
    """5 x 5 places in snake order: every other row runs back."""
    row = F.floor(F.col("frame") / 5)
    col = F.when(row % 2 == 0, F.col("frame") % 5).otherwise(4 - F.col("frame") % 5)
    u, v = (col - 2) * (side / 4), (2 - row) * (side / 4)
    return rows.withColumns({"x": F.col("tx") + u * cos("yaw") - v * sin("yaw"), "y": F.col("ty") + u * sin("yaw") + v * cos("yaw"), "z": F.col("tz") + F.col("h"), "pitch": F.lit(-90.0)})


def traj_arc(rows: DataFrame, span: float) -> DataFrame:
    """A vertical arc of `span` degrees around the target; the signed pitch is the arc angle less 180."""
    angle = F.lit(90.0) + _step(span)
    return rows.withColumns({"x": F.col("tx") + F.col("h") * cos(angle) * cos("yaw"), "y": F.col("ty") + F.col("h") * cos(angle) * sin("yaw"), "z": F.col("tz") + F.col("h") * sin(angle), "pitch": angle - 180})


def traj_tracking_line(rows: DataFrame, span: float) -> DataFrame:
    """A line along the yaw direction that always looks at the target and is seen from it under `span` degrees. Offsets go by
    the sine of an even angle, so that they lie closer towards the ends; frame 12 is the canonical pose."""
    half = math.radians(span / 2)
    s = F.col("h") * (math.tan(half) / math.sin(half)) * sin(_step(span))
    return rows.withColumns({"x": F.col("tx") + s * cos("yaw"), "y": F.col("ty") + s * sin("yaw"), "z": F.col("tz") + F.col("h"), "pitch": -90 - F.degrees(F.atan2(s, F.col("h")))})


def dense_spiral(one: DataFrame, span: float, turns: float) -> DataFrame:
    """One row per dense sample: the unit-radius spiral on the sphere from the rim to the zenith. The table depends on span
    and turns only, so it is made once and broadcast."""
    s = F.col("id") / (DENSE - 1)
    tilt, turn = (1 - s) * (span / 2), s * (360.0 * turns)
    return one.select(F.lit(0).alias("curve"), "id", s.alias("s"), (sin(tilt) * cos(turn)).alias("x"), (sin(tilt) * sin(turn)).alias("y"), cos(tilt).alias("z"))


def resample_by_arc_length(dense: DataFrame, n: int = FRAMES) -> DataFrame:
    """(curve, frame, s): parameters at equal distances along the polyline of each curve's dense samples (curve, id, s, x, y,
    z), by running chord length and linear interpolation in the segment that holds each distance. A curve has a fixed number
    of samples; curves are dealt by their key."""
    w = Window.partitionBy("curve").orderBy("id")
    step = F.sqrt(F.pow(F.col("x") - F.lag("x").over(w), 2) + F.pow(F.col("y") - F.lag("y").over(w), 2) + F.pow(F.col("z") - F.lag("z").over(w), 2))
    length = dense.withColumn("step", F.coalesce(step, F.lit(0.0))).withColumn("at", F.sum("step").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    segments = length.select("curve", "s", "at", F.lead("s").over(w).alias("s1"), F.lead("at").over(w).alias("at1"))
    total = length.groupBy(F.col("curve").alias("of")).agg(F.max("at").alias("total"))
    wanted = total.select("of", "total", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("frame")).withColumn("d", F.col("total") * F.col("frame") / (n - 1))
    inside = (wanted["of"] == segments["curve"]) & (wanted["d"] >= segments["at"]) & ((wanted["d"] < segments["at1"]) | (segments["at1"].isNull() & (wanted["d"] >= segments["at"])))
    share = F.when(F.col("at1").isNull() | (F.col("at1") == F.col("at")), F.lit(0.0)).otherwise((F.col("d") - F.col("at")) / (F.col("at1") - F.col("at")))
    return wanted.join(segments, inside).select("curve", "frame", (F.col("s") + share * (F.coalesce("s1", "s") - F.col("s"))).alias("s"))


def traj_spiral(rows: DataFrame, samples: DataFrame, span: float, turns: float) -> DataFrame:
    """A spiral on the sphere of radius h around the target at equal arc steps, looking at it; the last frame is the canonical
    pose."""
    joined = rows.join(samples.select("frame", "s"), "frame")
    tilt, turn = (1 - F.col("s")) * (span / 2), F.col("s") * (360.0 * turns) + F.col("yaw")
    placed = joined.withColumns({"x": F.col("tx") + F.col("h") * sin(tilt) * cos(turn), "y": F.col("ty") + F.col("h") * sin(tilt) * sin(turn), "z": F.col("tz") + F.col("h") * cos(tilt)})
    return ending_canonical(target_rotations(placed))


def target_rotations(rows: DataFrame) -> DataFrame:
    """rows(x, y, z, tx, ty, tz, yaw: the base yaw) with roll, pitch, yaw: the canonical camera frame, turned whole by the least
    tilt that points it at the target, as the angle triple nearest to the canonical view. above = false and null angles where
    the camera isn't above the target."""
    view = euler_matrix(F.lit(0.0), F.lit(-90.0), F.col("yaw"))
    tilted = lookat_rotations(rows)
    turned = {f"r{i}{j}": sum((F.col(f"a{i}{k}") * view[k][j] for k in range(1, 3)), F.col(f"a{i}0") * view[0][j]) for i in range(3) for j in range(3)}
    work = [*turned, *(f"a{i}{j}" for i in range(3) for j in range(3)), "angle", "base_yaw"]
    return matrix_to_euler(tilted.withColumns(turned).withColumn("base_yaw", F.col("yaw")), "base_yaw").drop(*work)


def ending_canonical(rows: DataFrame) -> DataFrame:
    """The last frame is the canonical pose itself: above the target by h, looking straight down; the yaw of such a camera is the
    base yaw already."""
    last = F.col("frame") == FRAMES - 1
    exact = {"x": F.col("tx"), "y": F.col("ty"), "z": F.col("tz") + F.col("h"), "roll": F.lit(0.0), "pitch": F.lit(-90.0)}
    return rows.withColumns({c: F.when(last, v).otherwise(F.col(c)) for c, v in exact.items()})


def bspline_basis(t: np.ndarray, n: int, degree: int = 3) -> np.ndarray:
    """Clamped uniform basis functions at t in [0, 1], one column per control point (Cox-de Boor)."""
    knots = np.concatenate([np.zeros(degree), np.linspace(0, 1, n - degree + 1), np.ones(degree)])
    basis = ((knots[:-1] <= t[:, None]) & (t[:, None] < knots[1:])).astype(float)
    basis[t >= 1, np.flatnonzero(knots[:-1] < 1)[-1]] = 1.0
    for k in range(1, degree + 1):
        left, right = knots[k:-1] - knots[: -k - 1], knots[k + 1 :] - knots[1:-k]
        a = np.divide(t[:, None] - knots[: -k - 1], left, out=np.zeros((len(t), len(left))), where=left > 0)
        b = np.divide(knots[k + 1 :] - t[:, None], right, out=np.zeros((len(t), len(right))), where=right > 0)
        basis = a * basis[:, :-1] + b * basis[:, 1:]
    return basis


def basis_columns(t: Column, controls: int, degree: int = 3) -> list[Column]:
    """The same basis as column expressions."""
    inner = controls - degree
    knots = [0.0] * degree + [k / inner for k in range(inner + 1)] + [1.0] * degree

    def piece(i: int, k: int) -> Column | None:
        """Basis function i of degree k; None where it is zero everywhere."""
        if k == 0:
            if knots[i] == knots[i + 1]:
                return None
            before = t <= 1.0 if knots[i + 1] == 1.0 else t < knots[i + 1]
            return F.when((t >= knots[i]) & before, F.lit(1.0)).otherwise(F.lit(0.0))
        terms = []
        if (low := piece(i, k - 1)) is not None:
            terms.append((t - knots[i]) / (knots[i + k] - knots[i]) * low)
        if (high := piece(i + 1, k - 1)) is not None:
            terms.append((knots[i + k + 1] - t) / (knots[i + k + 1] - knots[i + 1]) * high)
        return sum(terms[1:], terms[0]) if terms else None

    return [piece(i, degree) for i in range(controls)]


def bspline_eval(points: DataFrame, controls: int = 8) -> DataFrame:
    """points(id, t) -> id, the basis values as an array and their sum (a partition of unity)."""
    basis = basis_columns(F.col("t"), controls)
    return points.select("id", F.array(*basis).alias("basis"), sum(basis[1:], basis[0]).alias("total"))


#: Random control points, then how often the reference view, and the share of the shell kept free below.
SHELL_DRAWS, SHELL_ENDS, SHELL_MARGIN = 6, 2, 0.05
#: Curves that are evaluated together.
SHELL_ROWS = 64


def shell_controls(seeds: list[str], heights: np.ndarray, low: float, high: float, span: float) -> np.ndarray:
    """Control points (curve, point, (radius, tilt vector in radians)): for each point Python's generator draws the radius, the
    cosine of the polar angle and the azimuth; the reference view ends the curve."""
    least, flat = low + SHELL_MARGIN * (high - low), math.cos(math.radians(span / 2))
    out = np.zeros((len(seeds), SHELL_DRAWS + SHELL_ENDS, 3))
    draws = np.array([[(r.uniform(least, high), r.uniform(flat, 1.0), r.uniform(0.0, 2 * math.pi)) for _ in range(SHELL_DRAWS)] for r in map(random.Random, map(int, seeds))]).reshape(-1, SHELL_DRAWS, 3)
    polar = np.arccos(draws[:, :, 1])
    out[:, :SHELL_DRAWS, 0] = draws[:, :, 0]
    out[:, :SHELL_DRAWS, 1], out[:, :SHELL_DRAWS, 2] = polar * np.cos(draws[:, :, 2]), polar * np.sin(draws[:, :, 2])
    out[:, SHELL_DRAWS:, 0] = heights[:, None]
    return out


def shell_points(values: np.ndarray) -> np.ndarray:
    """(..., (radius, tilt vector)) -> (..., xyz): the tilt vector's length is the polar angle, its direction the azimuth."""
    polar = np.hypot(values[..., 1], values[..., 2])
    across = values[..., :1] * values[..., 1:] * np.sinc(polar / math.pi)[..., None]
    return np.concatenate([across, values[..., :1] * np.cos(polar)[..., None]], axis=-1)


def traj_random_shell(rows: DataFrame, low: float, high: float, span: float) -> DataFrame:
    """rows(seq_no, seed, tx, ty, tz, h, yaw) -> 25 frames each: seeded control points in radius and tilt around the zenith and
    the reference view at height h twice, so that the curve comes to rest there; a clamped cubic spline through their hull,
    taken at parameters of equal arc length, turned by yaw and looking at the target. Radii stay in [low, high], tilts within
    span / 2 degrees. Curves are evaluated by matrix products, SHELL_ROWS at a time."""

    def run(batches):
        grid = np.linspace(0, 1, DENSE)
        basis = bspline_basis(grid, SHELL_DRAWS + SHELL_ENDS)
        for batch in batches:
            for first in range(0, batch.num_rows, SHELL_ROWS):
                b = batch.slice(first, SHELL_ROWS)
                n, number = b.num_rows, lambda c: b[c].to_numpy(zero_copy_only=False)  # noqa: B023
                control = shell_controls(b["seed"].to_pylist(), number("h"), low, high, span)
                steps = np.linalg.norm(np.diff(shell_points(basis @ control), axis=1), axis=2)
                at = np.concatenate([np.zeros((n, 1)), np.cumsum(steps, axis=1)], axis=1)
                t = np.stack([np.interp(np.linspace(0, a[-1], FRAMES), a, grid) for a in at])
                values = bspline_basis(t.ravel(), SHELL_DRAWS + SHELL_ENDS).reshape(n, FRAMES, -1) @ control
                p, turn = shell_points(values), np.radians(number("yaw"))[:, None]
                x, y = p[..., 0] * np.cos(turn) - p[..., 1] * np.sin(turn), p[..., 0] * np.sin(turn) + p[..., 1] * np.cos(turn)
                placed = {c: (v + number("t" + c)[:, None]).ravel() for c, v in zip("xyz", (x, y, p[..., 2]), strict=True)}
                again = {c: np.repeat(number(c), FRAMES) for c in ("tx", "ty", "tz", "h", "yaw")}
                inside = {"radius": values[..., 0].ravel(), "tilt": np.degrees(np.hypot(values[..., 1], values[..., 2])).ravel()}
                out = {"seq_no": np.repeat(number("seq_no"), FRAMES), "frame": np.tile(np.arange(FRAMES, dtype=np.int32), n)} | placed | again | inside
                yield pa.record_batch([pa.array(v) for v in out.values()], names=list(out))

    numbers = ", ".join(f"{c} double" for c in ("x", "y", "z", "tx", "ty", "tz", "h", "yaw", "radius", "tilt"))
    made = rows.select("seq_no", "seed", *(F.col(c).cast("double").alias(c) for c in ("tx", "ty", "tz", "h", "yaw"))).mapInArrow(run, f"seq_no long, frame int, {numbers}")
    return ending_canonical(target_rotations(made))


def lookat_rotations(rows: DataFrame) -> DataFrame:
    """Minimal turn from nadir to the direction of the target (Rodrigues): its axis, angle and matrix a00..a22. Rows whose
    camera isn't above the target have above = false and null values."""
    d = [F.col(f"t{c}") - F.col(c) for c in "xyz"]
    norm = F.sqrt(d[0] * d[0] + d[1] * d[1] + d[2] * d[2])
    u = [c / norm for c in d]
    above = d[2] < 0
    # nadir x u = (0, 0, -1) x u
    k = (u[1], -u[0])
    c, c1 = -u[2], 1 / (1 - u[2])
    m = [[c + k[0] * k[0] * c1, k[0] * k[1] * c1, k[1]], [k[0] * k[1] * c1, c + k[1] * k[1] * c1, -k[0]], [-k[1], k[0], c]]
    named = {f"a{i}{j}": F.when(above, m[i][j]) for i in range(3) for j in range(3)}
    return rows.withColumns({"above": above, "angle": F.when(above, F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), c))))), **named})


#: Fixed values of the pose protocol: what every document must say, and the trajectories that end on the reference view.
PROTOCOL = {"schema_version": "camera-json-v1-25views", "coordinate_convention": "opencv_c2w", "translation_units": "m", "depth_units": "cm", "w": 512, "h": 512, "num_views": 25, "includes_occ_center": True, "view_order": "sequence", "pixel_center_offset": 0.5}
TRAJECTORIES = ("fix_line", "plane_grid", "rot_arc", "rot_spiral", "rand_shell")
ENDING = ("rot_spiral", "rand_shell")


def pose_rules(payloads: DataFrame, tolerance: float = 1e-5) -> DataFrame:
    """payloads(id, the fields of PROTOCOL, trajectory, center_idx, fl_x, fl_y, cx, cy, frames array<struct<frame_id, file_path,
    m array<double> 16>>) -> violated rules, comma-joined. Whole numbers must have whole types; matrices must be rigid: a
    rotation and the row 0, 0, 0, 1."""
    dot = lambda m, i, j: m[4 * 0 + i] * m[4 * 0 + j] + m[4 + i] * m[4 + j] + m[8 + i] * m[8 + j]
    det = lambda m: m[0] * (m[5] * m[10] - m[6] * m[9]) - m[1] * (m[4] * m[10] - m[6] * m[8]) + m[2] * (m[4] * m[9] - m[5] * m[8])
    near = lambda x, v, t: F.abs(x - v) <= t
    number = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    orthogonal = lambda m: F.greatest(*(F.abs(dot(m, i, j) - (1.0 if i == j else 0.0)) for i in range(3) for j in range(i, 3))) <= tolerance
    rigid = lambda f: (F.size(f["m"]) == 16) & F.forall(f["m"], number) & orthogonal(f["m"]) & near(det(f["m"]), 1, tolerance) & near(f["m"][12], 0, 1e-7) & near(f["m"][13], 0, 1e-7) & near(f["m"][14], 0, 1e-7) & near(f["m"][15], 1, 1e-7)
    whole = {f.name for f in payloads.schema if f.dataType.typeName() in ("byte", "short", "integer", "long")}
    integers = ("w", "h", "num_views", "center_idx")
    centre = F.when(F.col("trajectory").isin(*ENDING), 24).otherwise(CENTRE)
    focal = F.coalesce(number(F.col("fl_x")) & number(F.col("fl_y")) & number(F.col("cx")) & number(F.col("cy")) & (F.col("fl_x") > 0) & (F.col("fl_y") > 0), F.lit(False))
    rules = {
        **{k: ~F.col(k).eqNullSafe(F.lit(v)) | F.lit(k in integers and k not in whole) for k, v in PROTOCOL.items()},
        "trajectory": ~F.coalesce(F.col("trajectory").isin(*TRAJECTORIES), F.lit(False)),
        "center_idx": ~F.col("center_idx").eqNullSafe(centre) | F.lit("center_idx" not in whole),
        "intrinsics": ~focal,
        "principal_point": ~F.coalesce(F.col("cx").between(0, SIDE) & F.col("cy").between(0, SIDE), F.lit(False)),
        "frame_count": ~F.coalesce(F.size("frames") == FRAMES, F.lit(False)),
        "frame_order": ~F.forall(F.transform("frames", lambda f, i: f["frame_id"].eqNullSafe(i)), lambda ok: ok),
        "path": ~F.forall(F.transform("frames", lambda f, i: f["file_path"].eqNullSafe(F.format_string("../rgb/%04d.png", i))), lambda ok: ok),
        "rigid": ~F.forall("frames", lambda f: F.coalesce(rigid(f), F.lit(False))),
    }
    return payloads.select("id", F.array_join(F.array_compact(F.array(*(F.when(c, F.lit(k)) for k, c in rules.items()))), ",").alias("codes"))


def build_payload(frames: DataFrame) -> DataFrame:
    """frames(seq_no, frame_id, file_path, m) -> one nested document per sequence, in frame order."""
    return frames.groupBy("seq_no").agg(F.sort_array(F.collect_list(F.struct("frame_id", "file_path", "m"))).alias("frames"))


def rigid_c2w(matrices: DataFrame, tolerance: float = 1e-4) -> DataFrame:
    """matrices(id, m: 16 numbers) -> status and the rigid camera-to-world: the polar factor of the linear part (the rotation
    nearest to it) with second and third columns flipped, and the translation as it is. Singular values must agree with their
    mean. Non-affine, reflecting, singular, sheared or unevenly scaled matrices have a status and no matrix."""

    def run(batches):
        for b in batches:
            m = np.array(b["m"].to_pylist(), float).reshape(-1, 4, 4)
            finite = np.isfinite(m).all((1, 2))
            safe = np.where(finite[:, None, None], m, np.eye(4))
            left, s, right = np.linalg.svd(safe[:, :3, :3])
            affine = (np.abs(safe[:, 3] - [0, 0, 0, 1]) <= 1e-7).all(1)
            det, scale = np.linalg.det(safe[:, :3, :3]), s.mean(1)
            uniform = (scale > 1e-12) & (np.abs(s - scale[:, None]) <= 1e-12 + tolerance * scale[:, None]).all(1)
            status = np.select([~finite, ~affine, det < 0, det == 0, ~uniform], ["not_finite", "not_affine", "reflection", "singular", "not_uniform"], "ok")
            out = np.tile(np.eye(4), (len(m), 1, 1))
            out[:, :3, :3] = left @ right * [1.0, -1.0, -1.0]
            out[:, :3, 3] = safe[:, :3, 3]
            rows = [v if k == "ok" else None for k, v in zip(status.tolist(), out.reshape(-1, 16).tolist(), strict=True)]
            yield pa.record_batch([b["id"], pa.array(status.tolist(), pa.string()), pa.array(rows, pa.list_(pa.float64()))], names=["id", "status", "c2w"])

    return matrices.select("id", "m").mapInArrow(run, "id long, status string, c2w array<double>")


#: Fixed value: the side of the images of the pose protocol.
SIDE = 512


def intrinsics_from_projection(rows: DataFrame) -> DataFrame:
    """rows(m: the 16 numbers of a projection, width, height) with fx, fy, cx, cy and status; lens shift moves the principal
    point. Only a perspective of square images of the protocol's side, without skew or off-axis terms, is ok."""
    p = lambda i, j: F.col("m")[4 * i + j]
    near = lambda c, v=0.0: F.abs(c - v) <= 1e-7
    fx, fy = p(0, 0) * F.col("width") / 2, p(1, 1) * F.col("height") / 2
    cx, cy = (1 - p(0, 2)) * F.col("width") / 2, (1 + p(1, 2)) * F.col("height") / 2
    whole = (F.size("m") == 16) & F.forall("m", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rules = {
        "size": (F.col("width") != SIDE) | (F.col("height") != SIDE),
        "not_finite": ~whole,
        "orthographic": ~(near(p(3, 0)) & near(p(3, 1)) & near(p(3, 2), -1.0) & near(p(3, 3))),
        "skew": ~(near(p(0, 1)) & near(p(1, 0)) & near(p(0, 3)) & near(p(1, 3))),
        "focal": (fx <= 0) | (fy <= 0),
        "principal_point": ~(cx.between(0, F.col("width")) & cy.between(0, F.col("height"))),
    }
    status = F.coalesce(*(F.when(c, F.lit(k)) for k, c in rules.items()), F.lit("ok"))
    return rows.withColumns({"status": status, "fx": fx, "fy": fy, "cx": cx, "cy": cy})


def intrinsics_constant(rows: DataFrame, atol: float = 1e-5, rtol: float = 1e-6) -> DataFrame:
    """rows(seq_no, frame, fx, fy, cx, cy): whether all frames share the first frame's values."""
    names = ["fx", "fy", "cx", "cy"]
    first = rows.groupBy("seq_no").agg(*(F.min_by(c, "frame").alias(f"first_{c}") for c in names), *(F.min(c).alias(f"lo_{c}") for c in names), *(F.max(c).alias(f"hi_{c}") for c in names))
    off = {c: F.greatest(F.col(f"hi_{c}") - F.col(f"first_{c}"), F.col(f"first_{c}") - F.col(f"lo_{c}")) for c in names}
    ok = [off[c] <= atol + rtol * F.abs(F.col(f"first_{c}")) for c in names]
    return first.select("seq_no", F.greatest(*off.values()).alias("largest"), (ok[0] & ok[1] & ok[2] & ok[3]).alias("constant"))


def frame_range_rule(keys: DataFrame, tolerance: float = 1e-3) -> DataFrame:
    """keys(seq_no, frame, pose array<double>), frames with fractions: an animation starts at 0 and ends in 24 to 25; one that
    ends beyond 24 must hold its pose at frame 25. Poses are those at the whole frames, whatever keys lie between."""
    at = lambda k: F.max(F.when(F.col("frame") == k, F.col("pose")))
    ends = keys.groupBy("seq_no").agg(F.min("frame").alias("first"), F.max("frame").alias("last"), at(24).alias("p24"), at(25).alias("p25"))
    held = F.coalesce(F.forall(F.zip_with("p24", "p25", lambda x, y: F.abs(x - y) <= 1e-5), lambda ok: ok), F.lit(False))
    inside = (F.abs("first") <= tolerance) & F.col("last").between(24 - tolerance, 25 + tolerance)
    return ends.select("seq_no", "first", "last", (inside & ((F.col("last") <= 24 + tolerance) | held)).alias("ok"))


def to_opencv(rows: DataFrame) -> DataFrame:
    """Engine pose (x, y, z, roll, pitch, yaw in cm and degrees) -> OpenCV camera-to-world c00..c22 and metres px, py, pz:
    the world's y axis is mirrored; the camera's axes become right, down, forward."""
    m = euler_matrix(F.col("roll"), F.col("pitch"), F.col("yaw"))
    sign = (1, -1, 1)
    columns = (1, 2, 0), (1, -1, 1)  # right, up, forward; up becomes down
    named = {f"c{i}{j}": F.lit(float(sign[i] * columns[1][j])) * m[i][columns[0][j]] for i in range(3) for j in range(3)}
    return rows.withColumns({**named, "px": F.col("x") / 100, "py": -F.col("y") / 100, "pz": F.col("z") / 100})


def pose_error(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Position (m) and rotation (degrees) error of two pose tables with c00..c22, px, py, pz."""
    names = [f"c{i}{j}" for i in range(3) for j in range(3)] + ["px", "py", "pz"]
    other = b.select(*keys, *(F.col(c).alias(f"b_{c}") for c in names))
    trace = sum((F.col(c) * F.col(f"b_{c}") for c in names[:9]), F.lit(0.0))
    position = F.sqrt(sum((F.pow(F.col(c) - F.col(f"b_{c}"), 2) for c in names[9:]), F.lit(0.0)))
    angle = F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (trace - 1) / 2))))
    return a.join(other, keys).select(*keys, position.alias("position_m"), angle.alias("rotation_deg"))


def reference_view_consistency(views: DataFrame, pose: tuple[str, ...] = ("x", "y", "z"), k: tuple[str, ...] = ("fx", "cx")) -> DataFrame:
    """views(scope, prefix, trajectory, pose and intrinsic columns): largest deviations of pose and of intrinsics from the first
    trajectory's view, for prefixes with two or more. The first and the extremes are aggregates, so no group is gathered."""
    every = (*pose, *k)
    first = views.groupBy("scope", "prefix").agg(F.count_distinct("trajectory").alias("trajectories"), *(F.min_by(c, "trajectory").alias(f"f{c}") for c in every), *(F.min(c).alias(f"lo{c}") for c in every), *(F.max(c).alias(f"hi{c}") for c in every))
    off = lambda some: F.greatest(*(F.greatest(F.col(f"hi{c}") - F.col(f"f{c}"), F.col(f"f{c}") - F.col(f"lo{c}")) for c in some))
    return first.filter("trajectories >= 2").select("scope", "prefix", "trajectories", off(pose).alias("pose_delta"), off(k).alias("k_delta"))


def reference_depth_consistency(depths: DataFrame) -> DataFrame:
    """depths(scope, prefix, trajectory, y, x, depth) of the centre views: the largest of the trajectories' mean depth
    differences from the first one. A pixel of the first is a minimum over its pixel, so no image is joined with another."""
    w = Window.partitionBy("scope", "prefix", "y", "x")
    first = F.min(F.struct("trajectory", "depth")).over(w)["depth"]
    rows = depths.withColumn("off", F.abs(F.col("depth") - first)).groupBy("scope", "prefix", "trajectory").agg(F.avg("off").alias("off"))
    return rows.groupBy("scope", "prefix").agg(F.count("*").alias("trajectories"), F.max("off").alias("depth_delta")).filter("trajectories >= 2")


def pose_continuity(rows: DataFrame) -> DataFrame:
    """Steps between consecutive frames of each sequence: largest, median and last against median."""
    w = Window.partitionBy("seq_no").orderBy("frame")
    step = F.sqrt(sum((F.pow(F.col(c) - F.lag(c).over(w), 2) for c in "xyz"), F.lit(0.0)))
    rows = rows.withColumn("step", step)
    return rows.groupBy("seq_no").agg(F.max("step").alias("largest"), F.expr("percentile(step, 0.5)").alias("median"), F.max_by("step", "frame").alias("last"))


def recentre_keys(rows: DataFrame, start: int) -> DataFrame:
    """Frame numbers moved to begin at `start`; end is start plus the number of frames."""
    return rows.withColumn("key", F.col("frame") + start).withColumn("end", F.lit(start) + F.count("*").over(Window.partitionBy("seq_no")))
