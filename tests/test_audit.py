"""The audit's geometry against numpy, with cameras that turn about all axes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from framewise import queries_audit
from framewise.operators import audit


def turn(rnd, size):
    q, r = np.linalg.qr(np.eye(3) + size * rnd.normal(size=(3, 3)))
    return q * np.sign(np.diag(r))


def pose_row(seq, frame, r, t):
    return (seq, frame, *map(float, r.ravel()), *map(float, t))


POSES = "sequence int, frame int, " + ", ".join(f"r{i}{j} double" for i in range(3) for j in range(3)) + ", t0 double, t1 double, t2 double"


@pytest.fixture(scope="module")
def cameras():
    rnd = np.random.default_rng(3)
    return {(s, k): (turn(rnd, 0.1), rnd.normal(size=3) * 0.3) for s in (1, 2) for k in range(25)}


def wrong(mode, cameras, s, i, j):
    """(a, b, depth scale, focal scale) of a hypothesis, by 4 x 4 matrices."""
    if mode == "pose_frame_plus1":
        i, j = min(i + 1, 24), min(j + 1, 24)
    a, b = (np.block([[cameras[s, k][0], cameras[s, k][1][:, None]], [np.zeros((1, 3)), np.ones((1, 1))]]) for k in (i, j))
    if mode == "double_yz_flip":
        a, b = a @ np.diag([1.0, -1, -1, 1]), b @ np.diag([1.0, -1, -1, 1])
    if mode == "c2w_as_w2c":
        a, b = np.linalg.inv(a), np.linalg.inv(b)
    return a, b, {"depth_cm_as_m": 100, "depth_divide_twice": 0.01}.get(mode, 1), 2 if mode == "focal_x2" else 1


def test_projection_under_every_hypothesis(spark, cameras):
    pairs = [(10, 1, 0, 1), (11, 1, 23, 24), (12, 2, 0, 12)]
    p = spark.createDataFrame([(*x, 30.0, 16.0) for x in pairs], "pair int, sequence int, frame_a int, frame_b int, f double, c double")
    moves = audit.relative_poses(p, spark.createDataFrame([pose_row(s, k, *x) for (s, k), x in cameras.items()], POSES))
    rows = [(q[0], m, float(m % 7), float(m % 5), 2.0 + m % 3, 3.0, 4.0) for q in pairs for m in range(14)]
    df = spark.createDataFrame(rows, "pair int, match int, ax double, ay double, depth double, bx double, by double")
    got = {(r.pair, r.match, r.mode): (r.qx, r.qy, r.z) for r in audit.projected(df.join(moves, "pair"), "ax", "ay").collect()}
    errors = {}
    for pair, s, i, j in pairs:
        for mode in audit.HYPOTHESES:
            a, b, scale, zoom = wrong(mode, cameras, s, i, j)
            f = 30.0 * zoom
            for _, m, x, y, d, bx, by in (r for r in rows if r[0] == pair):
                ray = np.array([(x + 0.5 - 16) / f, (y + 0.5 - 16) / f, 1.0])
                d = d * scale / (np.linalg.norm(ray) if mode == "radial_depth" else 1)
                q = (np.linalg.inv(b) @ a @ np.append(ray * d, 1.0))[:3]
                want = (f * q[0] / q[2] + 16 - 0.5, f * q[1] / q[2] + 16 - 0.5, q[2])
                assert np.allclose(got[pair, m, mode], want, rtol=1e-9, atol=1e-9), (pair, m, mode)
                errors.setdefault((pair, mode), []).append(np.hypot(want[0] - bx, want[1] - by))
    for r in audit.feature_errors(df, moves).collect():
        e = errors[r.pair, r.mode]
        assert r.matches == 14 and r.qualified and np.allclose((r.median, r.mean, r.max), (np.median(e), np.mean(e), np.max(e)))


def test_scales_are_found(spark, cameras):
    rnd, rows = np.random.default_rng(5), []
    for s, i, j in ((1, 0, 5), (1, 3, 9), (2, 7, 8), (2, 2, 20)):
        a, b, _, _ = wrong("correct", cameras, s, i, j)
        for _ in range(60):
            x, y, d = rnd.uniform(0, 31), rnd.uniform(0, 31), rnd.uniform(2, 9)
            ray = np.array([(x + 0.5 - 16) / 33, (y + 0.5 - 16) / 33, 1.0])
            q = (np.linalg.inv(b) @ a @ np.append(ray * d * 0.9, 1.0))[:3]
            off = rnd.normal(size=2) * 0.01 + (rnd.random() < 0.1) * rnd.normal(size=2) * 20
            rows.append((s * 1000 + i, s, i, j, x, y, d, float(33 * q[0] / q[2] + 15.5 + off[0]), float(33 * q[1] / q[2] + 15.5 + off[1]), 30.0, 16.0))
    df = spark.createDataFrame(rows, "pair int, sequence int, frame_a int, frame_b int, ax double, ay double, depth double, bx double, by double, f double, c double")
    poses = spark.createDataFrame([pose_row(s, k, *x) for (s, k), x in cameras.items()], POSES)
    m = audit.relative_poses(df, poses, audit.HYPOTHESES[:1])
    focal, depth = audit.fit_scales(m)
    assert abs(focal - 1.1) < 5e-3 and abs(depth - 0.9) < 3e-2
    r = {x.fit: x.median for x in audit.scale_report(m.withColumn("part", F.lit("a")), focal, depth).collect()}
    assert r["after"] < 0.05 < r["before"]
    assert audit.fit_scales(m.limit(0)) == (1.0, 1.0)


def test_scale_values_of_the_query(spark):
    """The registered query against numpy: no scales near those found have less soft-L1 cost, and the summaries are right."""
    sf = "/root/testdata/sf0.001"
    rows = queries_audit._parts(spark, sf).toPandas()
    r = np.array([[rows[f"r{i}{j}"] for j in range(3)] for i in range(3)])
    t, f, c = np.array([rows[f"t{i}"] for i in range(3)]), rows.f.to_numpy(), rows.c.to_numpy()

    def residuals(focal, depth, part):
        z = rows.depth.to_numpy() * depth
        ray = np.array([(rows.ax + 0.5 - c) / (f * focal) * z, (rows.ay + 0.5 - c) / (f * focal) * z, z])
        q = np.einsum("ijn,jn->in", r, ray) + t
        e = np.array([f * focal * q[k] / q[2] + c - 0.5 - rows[b] for k, b in ((0, "bx"), (1, "by"))])
        return e[:, (rows.part == part).to_numpy()].ravel()

    cost = lambda focal, depth: (2 * (np.sqrt(1 + residuals(focal, depth, "training") ** 2) - 1)).sum()
    got = queries_audit.QUERIES["e15_scale_values"](spark, sf).collect()
    assert {(x.part, x.fit) for x in got} == {(p, w) for p in ("training", "holdout") for w in ("before", "after")}
    focal, depth = got[0].focal_scale, got[0].depth_scale
    least = cost(focal, depth)
    for step in (1e-3, 1e-2, 0.1):
        for k in range(16):
            assert cost(focal * np.exp(step * np.cos(k * np.pi / 8)), depth * np.exp(step * np.sin(k * np.pi / 8))) > least
    for x in got:
        assert (x.focal_scale, x.depth_scale) == (focal, depth)
        e = np.abs(residuals(*((focal, depth) if x.fit == "after" else (1.0, 1.0)), x.part))
        assert x.n == len(e) and np.allclose((x.mean, x.median, x.p95, x.max), (e.mean(), np.median(e), np.percentile(e, 95), e.max()), rtol=1e-7, atol=1e-9)


def test_homography_gate(spark):
    rnd, rows = np.random.default_rng(1), []
    for pair in range(3):
        h = np.eye(3) + np.array([[0.1, 0.05, 20], [-0.03, 0.02, -7], [1e-4, -1e-4, 0]]) * (pair + 1)
        for k in range(80):
            x, y = rnd.uniform(0, 500, 2)
            q = h @ (x, y, 1)
            far = k % 4 == 0
            rows.append((pair, k, x, y, q[0] / q[2] + far * 60, q[1] / q[2] - far * 40, not far))
    rows += [(9, k, float(k), 1.0, 2.0, 3.0, True) for k in range(3)]  # too few
    df = spark.createDataFrame([tuple(float(v) if isinstance(v, np.floating) else v for v in r) for r in rows], "pair int, k int, ax double, ay double, bx double, by double, good boolean")
    kept = audit.homography_gate(df).collect()
    assert len(kept) == 180 and all(r.good for r in kept)


def verdict(spark, **change):
    """Scopes a and b are sound, c has no matches, d no stable GT pair, e no stored document; `change` replaces tables."""
    t = {
        "scopes": ([(k, s, "extra") for k, s in enumerate("aabbcde")], "sequence int, scope string, frame string"),
        "poses": ([(k, 1e-4 * f, 1e-3 * f) for k in range(7) for f in range(3)], "sequence int, position_m double, rotation_deg double"),
        "raw": ([(k, -1e-4) for k in range(7)], "sequence int, delta double"),
        "stored": ([(k, 0.0, 0.0, True, True) for k in range(6)], "sequence int, pose_delta double, k_delta double, hash_matches boolean, matched boolean"),
        "features": ([(k, m, e, q) for k in (0, 1, 2, 3, 5, 6) for m, e, q in (("correct", 0.2 + k / 10, True), ("focal_x2", 30.0, True), ("correct", 99.0, False))], "sequence int, mode string, median double, qualified boolean"),
        "dense": ([(k, "correct", "GT" if k != 5 else "occ", 4, 0.1 + k / 1000) for k in range(7)] + [(0, "correct", "GT", 0, None), (0, "focal_x2", "GT", 9, 5.0)], "sequence int, mode string, suffix string, stable int, stable_p95 double"),
    }
    t |= {k: (rows, t[k][1]) for k, rows in change.items()}
    return {r.scope: r for r in audit.assessment(*(spark.createDataFrame(*v) for v in t.values())).collect()}


def test_verdict_and_its_evidence(spark):
    r = verdict(spark)
    assert {k: v.valid for k, v in r.items()} == {"a": True, "b": True, "c": False, "d": False, "e": True}
    assert (r["a"].sequences, r["a"].max_position_m, r["a"].max_rotation_deg, r["a"].max_intrinsic_px) == (2, 2e-4, 2e-3, 1e-4)
    assert np.isclose(r["a"].feature_median_px, 0.25) and np.isclose(r["b"].gt_depth_p95_m, 0.1025)
    assert r["c"].feature_median_px is None and r["d"].gt_depth_p95_m is None and np.isclose(r["d"].depth_p95_m, 0.105)
    assert verdict(spark, scopes=[]) == {}


@pytest.mark.parametrize("table, rows", [
    ("poses", [(k, 0.0011 if k == 1 else 0.0, 0.0) for k in range(7)]),
    ("poses", [(k, 0.0, 0.011 if k == 1 else 0.0) for k in range(7)]),
    ("poses", [(k, float("nan") if k == 1 else 0.0, 0.0) for k in range(7)]),
    ("poses", [(k, 0.0, 0.0) for k in range(7) if k != 1]),
    ("raw", [(k, -0.002 if k == 1 else 0.0) for k in range(7)]),
    ("stored", [(1, 2e-7, 0.0, True, True)]),
    ("stored", [(1, 0.0, 0.0, False, True)]),
    ("stored", [(1, None, None, False, False)]),
    ("features", [(k, "correct", 2.0 if k < 2 else 0.5, True) for k in range(7)]),
])
def test_one_fault_turns_the_verdict_of_its_scope(spark, table, rows):
    r = verdict(spark, **{table: rows})
    assert not r["a"].valid and r["b"].valid


def test_distribution_of_a_family(spark):
    errors = spark.createDataFrame([(k, m, float(k), k != 5) for k in range(8) for m in ("correct", "focal_x2")], "pair int, mode string, median double, qualified boolean")
    families = spark.createDataFrame([(k, "x" if k < 6 else "y" if k == 6 else None) for k in range(9)], "pair int, family string")
    got = {r.family: (r.pairs, r.least, r.q1, r.q2, r.q3, r.greatest) for r in audit.feature_error_by_family(errors, families).collect()}
    assert got == {"x": (5, 0.0, 1.0, 2.0, 3.0, 4.0), "y": (1, *[6.0] * 5), None: (1, *[7.0] * 5)}


def test_homography_gate_at_infinity(spark, monkeypatch):
    """A match on the line that the hypothesis moves to infinity is not near; the others stay."""
    names = ", ".join(f"h{i}{j} double" for i in range(3) for j in range(3))
    made = spark.createDataFrame([(1, 0, 1.0, 0.0, 0.0, 0.0, 1.0, 0.0, 1.0, 0.0, -2.0)], f"pair long, h int, {names}")
    monkeypatch.setattr("framewise.operators.audit.homographies", lambda matches, tries: made)
    rows = [(1, float(x), 3.0, x / (x - 2.0) if x != 2 else 0.0, 3.0 / (x - 2.0) if x != 2 else 0.0) for x in range(6)]
    got = audit.homography_gate(spark.createDataFrame(rows, "pair long, ax double, ay double, bx double, by double"))
    assert sorted(r.ax for r in got.collect()) == [0.0, 1.0, 3.0, 4.0, 5.0]
