"""Small cases with known answers."""

import math
import struct
from io import BytesIO

import numpy as np
import pytest
from pyspark.sql import functions as F

from framewise.operators import complete, plan, pose, rgbd, scene, telemetry
from framewise.plans.flagship import remaining_by_map
from framewise.sources import capture


def test_plan_rules_and_duplicates(spark):
    rows = [("a", 0, "/Game/m", "s", "train", "T1", 25, "k", 50.0, 0.0), ("b", 1, "/Game/m", "s", "val", "T1", 24, "k", 50.0, 0.0), ("c", 2, "/Game/x", "s", "train", "T1", 25, "k", 50.0, 0.0), ("a", 3, "/Game/m", "s", "train", "T9", 25, "k", 60.0, 0.0)]
    p = spark.createDataFrame(rows, "sequence_id string, seq_no long, map_path string, source_scene string, split string, target_label string, expected_views int, trajectory string, height_m double, yaw_deg double")
    maps = spark.createDataFrame([("/Game/m", "s", "train")], "map_path string, source_scene string, split string")
    targets = spark.createDataFrame([("/Game/m", "T1")], "map_path string, target_label string")
    got = {(r.seq_no, r.codes) for r in plan.validate_plan(p, maps, targets).collect()}
    assert got == {(1, "split,expected_views"), (2, "unknown_map"), (3, "unknown_target")}
    assert {(r.seq_no, r.rule, r.keeper) for r in plan.duplicate_recipes(p).collect()} == {(3, "sequence_id", 0), (1, "recipe", 0)}


def test_a_bad_row_takes_no_good_one_along(spark):
    """Row 1 is good and shares its id with the bad row 0; 2 repeats its id with another recipe; 3 repeats its recipe."""
    rows = [("a", 0, "/Game/m", "s", "val", "T1", 25, "k", 50.0, 0.0), ("a", 1, "/Game/m", "s", "train", "T1", 25, "k", 60.0, 0.0), ("a", 2, "/Game/m", "s", "train", "T1", 25, "k", 70.0, 0.0), ("b", 3, "/Game/m", "s", "train", "T1", 25, "k", 60.0, 0.0)]
    p = spark.createDataFrame(rows, "sequence_id string, seq_no long, map_path string, source_scene string, split string, target_label string, expected_views int, trajectory string, height_m double, yaw_deg double")
    maps = spark.createDataFrame([("/Game/m", "s", "train")], "map_path string, source_scene string, split string")
    targets = spark.createDataFrame([("/Game/m", "T1")], "map_path string, target_label string")
    files = spark.createDataFrame([("k", "m_T1_height_060_ang_000", "occ", "rgb", f, 9) for f in range(25)], "trajectory string, prefix string, suffix string, pass_name string, frame int, size int")
    one = lambda name, v: spark.createDataFrame([(v,)], f"{name} string")
    got = remaining_by_map(p, maps, targets, files, one("pass_name", "rgb"), one("suffix", "occ")).collect()
    assert [tuple(r) for r in got] == [("/Game/m", 1, 0)]
    got = remaining_by_map(p, maps, targets, files.limit(0), one("pass_name", "rgb"), one("suffix", "occ")).collect()
    assert [tuple(r) for r in got] == [("/Game/m", 1, 1)]


@pytest.mark.parametrize("block", [1, 3, 100])
def test_places_over_blocks(spark, block):
    """The same jobs whatever the blocks, for gaps in seq_no, a null map and one group with most rows."""
    rnd = np.random.default_rng(block)
    rows = [("m" if rnd.random() < 0.7 else None, f"T{rnd.integers(3)}", int(n), f"s{n}") for n in rnd.permutation(400)[:150]]
    df = spark.createDataFrame(rows, "map_path string, target_label string, seq_no long, sequence_id string").repartition(5)
    want, seen = {}, {}
    for m, t, n, s in sorted(rows, key=lambda r: r[2]):
        k = seen[m, t] = seen.get((m, t), -1) + 1
        want[s] = (m, t, k)
    got = {r.sequence_id: (r.map_path, r.target_label, r.rn) for r in plan.places(df, ["map_path", "target_label"], block).collect()}
    assert got == want
    jobs = plan.job_tasks(df.filter("map_path is not null"), 4, block=block).collect()
    assert {(r.sequence_id, r.job_id, r.place) for r in jobs} == {(s, f"m_{t}_s{k % 4:03d}", k // 4) for s, (m, t, k) in want.items() if m}


def test_job_rows(spark):
    jobs = [("ok", "/Game/a/B_1", 0), ("low", "/Game/a", -1), ("high", "/Game/a", 3), ("path", "/Other/a", 1), ("none", None, None), ("tasks", "/Game/a", 2), ("names", "/Game/a", 2), ("nan", "/Game/a", 2), ("inf", "/Game/a", 2), ("null", "/Game/a", 2)]
    tasks = [("ok", "k", 1.0, 0.0), ("ok", "k", 1.0, 9.0), ("tasks", "k", 1.0, 0.0), ("tasks", "k", 1.0, 0.0), ("nan", "k", float("nan"), 0.0), ("inf", "k", 1.0, float("-inf")), ("null", "k", None, 0.0)]
    targets = [("ok", "T1"), ("ok", "T2"), ("names", "T1"), ("names", "T1"), ("tasks", "T1")]
    got = plan.job_row_rules(spark.createDataFrame(jobs, "job_id string, map_path string, shard_index int"), spark.createDataFrame(tasks, "job_id string, kind string, height double, yaw double"), spark.createDataFrame(targets, "job_id string, target string"), 3)
    assert {r.job_id: r.codes for r in got.collect()} == {"ok": "", "low": "shard_index", "high": "shard_index", "path": "package_path", "none": "package_path,shard_index", "tasks": "duplicate_task", "names": "duplicate_target", "nan": "not_finite", "inf": "not_finite", "null": "not_finite"}


def test_names_keep_four_digits(spark):
    df = spark.createDataFrame([("q", "/Game/m", "Target_001", "k", 1200.9, 120.0)], "sequence_id string, map_path string, target_label string, trajectory string, height_m double, yaw_deg double")
    assert plan.canonical_names(df).first().prefix == "m_Target_001_height_1200_ang_120"


def test_frame_rules(spark):
    seqs = spark.createDataFrame([("k", "p"), ("k", "q"), ("k", "none")], "trajectory string, prefix string")
    files = [("k", "p", "occ", "rgb", f, 9) for f in range(25)] + [("k", "q", "occ", "rgb", f, 9) for f in range(25)] + [("k", "q", "occ", "rgb", 0, 9)]
    df = spark.createDataFrame(files, "trajectory string, prefix string, suffix string, pass_name string, frame int, size int")
    got = complete.frame_completeness(seqs, df, spark.createDataFrame([("rgb",)], "pass_name string"), spark.createDataFrame([("occ",)], "suffix string"))
    assert {(r.prefix, r.complete) for r in got.collect()} == {("p", True), ("q", False), ("none", False)}


def test_frames_are_counted_once_whatever_their_number(spark):
    frames = [0, 0, 3, 63, 64, 64, 127, 128, 1_000_000, -1, -64, None]
    df = spark.createDataFrame([("k", "p", "occ", "rgb", f, 2) for f in frames] + [("k", "q", "GT", "rgb", None, None)], "trajectory string, prefix string, suffix string, pass_name string, frame int, size int")
    got = {r.prefix: r for r in complete.directories(df, 130).collect()}
    assert (got["p"].frames_found, got["p"].files, got["p"].unexpected) == (6, 12, 4)
    assert (got["q"].frames_found, got["q"].complete, got["q"].unexpected) == (0, False, 1)


def test_inventory_of_a_job(spark):
    names = ["rgb/0000.png", "depth/0000.EXR", "rgb/0.png", "rgb/a.b.jpg", "depth/a.b.jpeg", "rgb/0001.txt", "rgb/0001.png"]
    split = lambda n: (n.rpartition("/")[2].rpartition(".")[0], n.rpartition(".")[2])
    rows = [("k", "p", "occ", *split(n), 5) for n in names] + [("k", "p", "GT", "0000", "png", 5), ("k", "q", "GT", "0000", "png", 7)]
    files = spark.createDataFrame(rows, "trajectory string, prefix string, suffix string, stem string, ext string, size int")
    jobs = spark.createDataFrame([("j", "k", "p"), ("j", "k", "none")], "job_id string, trajectory string, prefix string")
    got = complete.output_inventory(files, jobs).collect()
    # 0000, 0, a.b and 0001 are four views of one folder, whatever the pass.
    assert [tuple(r) for r in got] == [("j", 7, 35, 5, ["p_GT", "p_occ"])]


def test_credit_counts_every_attempt(spark):
    a = [("j", 1, 1, 13, 8, 13, 400), ("j", 2, 1, 8, None, 13, 500), ("j", 3, 0, 8, 2, 13, 1300), ("k", 1, 1, 4, 6, 5, 90)]
    got = complete.credited_throughput(spark.createDataFrame(a, "job_id string, attempt int, returncode int, launched int, remaining int, tasks int, images int")).collect()
    assert sorted(map(tuple, got)) == [("j", 5 + 0 + 8, 1300 * 13 // 13), ("k", 0, 0)]


def rotation(roll, pitch, yaw):
    """The engine's rotation as a product of three plain ones."""
    r, p, y = np.radians([roll, pitch, yaw])
    about_z = np.array([[np.cos(y), -np.sin(y), 0], [np.sin(y), np.cos(y), 0], [0, 0, 1]])
    about_y = np.array([[np.cos(p), 0, -np.sin(p)], [0, 1, 0], [np.sin(p), 0, np.cos(p)]])
    about_x = np.array([[1, 0, 0], [0, np.cos(r), np.sin(r)], [0, -np.sin(r), np.cos(r)]])
    return about_z @ about_y @ about_x


def test_angles_of_a_matrix(spark):
    """The triple is one of the matrix's, and no triple nearer to the canonical view is."""
    cases = [(r, p, y, b) for r in (-170.0, 0.0, 20.0) for p in (-90.0, -89.0, -45.0, 0.0, 60.0) for y in (-170.0, 0.0, 121.0) for b in (0.0, 240.0)]
    df = spark.createDataFrame([(k, *c) for k, c in enumerate(cases)], "k int, roll double, pitch double, yaw double, base double")
    got = {r.k: r for r in pose.matrix_to_euler(pose.euler_to_matrix(df), "base").collect()}
    away = lambda r, p, y, b: r * r + (y - b) ** 2 + 0.25 * (p + 90) ** 2
    turn = lambda a: (a + 180) % 360 - 180
    for k, (r, p, y, b) in enumerate(cases):
        g = got[k]
        if p == -90:
            assert (g.roll, g.pitch, g.yaw) == (0, -90, b)
            continue
        assert np.allclose(rotation(g.roll, g.pitch, g.yaw), rotation(r, p, y), atol=1e-9)
        for other in ((turn(r), p, b + turn(y - b)), (turn(r + 180), -180 - p, b + turn(y + 180 - b))):
            assert away(g.roll, g.pitch, g.yaw, b) <= away(*other, b) + 1e-6


def test_polar_factor(spark):
    rng = np.random.default_rng(3)
    cases, want = [], []
    for k in range(60):
        turned = rotation(*rng.uniform(-180, 180, 3)) * rng.choice([0.01, 1.0, 100.0])
        if k % 2:
            turned = turned @ (np.eye(3) + 1e-5 * rng.uniform(-1, 1, (3, 3)))
        m = np.eye(4)
        m[:3, :3], m[:3, 3] = turned, rng.uniform(-9, 9, 3)
        cases.append(m)
        x = turned / np.cbrt(np.linalg.det(turned))
        for _ in range(40):  # Newton's iteration for the polar factor
            x = (x + np.linalg.inv(x).T) / 2
        want.append(x @ np.diag([1.0, -1.0, -1.0]))
    bad = {"reflection": np.diag([-1.0, 1, 1, 1]), "singular": np.diag([0.0, 1, 1, 1]), "not_uniform": np.diag([1.001, 1, 1, 1]), "not_affine": np.eye(4) + np.outer([0, 0, 0, 1], [1e-6, 0, 0, 0]), "not_finite": np.diag([np.inf, 1, 1, 1])}
    rows = [(k, m.ravel().tolist()) for k, m in enumerate([*cases, *bad.values()])]
    got = {r.id: r for r in pose.rigid_c2w(spark.createDataFrame(rows, "id long, m array<double>")).collect()}
    for k, (m, w) in enumerate(zip(cases, want, strict=True)):
        c = np.array(got[k].c2w).reshape(4, 4)
        assert got[k].status == "ok" and np.allclose(c[:3, :3], w, atol=1e-9) and np.allclose(c[:3, 3], m[:3, 3]) and c[3].tolist() == [0, 0, 0, 1]
    assert [got[len(cases) + k].status for k in range(len(bad))] == list(bad)


def test_basis_columns_are_the_basis(spark):
    t = np.append(np.linspace(0, 1, 101), [0.2, 0.4, 0.6, 0.8])
    rows = spark.createDataFrame([(k, float(x)) for k, x in enumerate(t)], "id long, t double")
    got = sorted(pose.bspline_eval(rows).collect())
    assert np.allclose([r.basis for r in got], pose.bspline_basis(t, 8), atol=1e-12) and np.allclose([r.total for r in got], 1)


def least_tilt(view, base):
    """The canonical frame turned whole onto a viewing direction, about the axis across both."""
    down = np.array([0.0, 0.0, -1.0])
    axis, cosine = np.cross(down, view), down @ view
    if np.linalg.norm(axis) < 1e-12:
        return rotation(0, -90, base)
    k, angle = axis / np.linalg.norm(axis), np.arccos(cosine)
    cross = np.array([[0, -k[2], k[1]], [k[2], 0, -k[0]], [-k[1], k[0], 0]])
    return (np.eye(3) + np.sin(angle) * cross + (1 - np.cos(angle)) * cross @ cross) @ rotation(0, -90, base)


def test_cameras_are_tilted_least(spark):
    rng = np.random.default_rng(8)
    rows = [(k, *map(float, rng.uniform(-900, 900, 2)), float(rng.uniform(10, 900)), 3.0, -4.0, 5.0, float(b)) for k, b in enumerate([0, 120, 240] * 20)]
    rows.append((99, 3.0, -4.0, 50.0, 3.0, -4.0, 5.0, 120.0))
    df = spark.createDataFrame(rows, "k int, x double, y double, z double, tx double, ty double, tz double, yaw double")
    got = {r.k: r for r in pose.target_rotations(df).collect()}
    for k, x, y, z, tx, ty, tz, base in rows:
        view = np.array([tx - x, ty - y, tz - z])
        if view[2] < 0:
            assert np.allclose(rotation(got[k].roll, got[k].pitch, got[k].yaw), least_tilt(view / np.linalg.norm(view), base), atol=1e-8)
        else:
            assert not got[k].above and got[k].roll is None
    assert (got[99].roll, got[99].pitch, got[99].yaw) == (0, -90, 120)


def test_shell_draws_are_pythons(spark):
    """Control points for 10**4 seeds, one draw at a time."""
    import math
    import random

    seeds = [str(k * 48_271) for k in range(10_000)]
    got = pose.shell_controls(seeds, np.full(len(seeds), 6000.0), 5000.0, 12000.0, 120.0)
    for seed, points in list(zip(seeds, got, strict=True))[::7]:
        r = random.Random(int(seed))
        for p in points[:6]:
            radius, polar, azimuth = r.uniform(5000 + 0.05 * 7000, 12000), math.acos(r.uniform(math.cos(math.radians(60)), 1.0)), r.uniform(0, 2 * math.pi)
            assert np.allclose(p, [radius, polar * math.cos(azimuth), polar * math.sin(azimuth)], atol=1e-12)
        assert (points[6:] == [6000.0, 0, 0]).all()


def test_spline_is_a_partition_of_unity():
    basis = pose.bspline_basis(np.linspace(0, 1, 1001), 8)
    assert np.allclose(basis.sum(1), 1) and (basis >= 0).all() and basis[0, 0] == 1 and basis[-1, -1] == 1


def test_random_shell_stays_inside_and_repeats(spark):
    rows = spark.createDataFrame([(i, str(i * 7919), 1.0, 2.0, 3.0, 5000.0 + i * 20, i * 40.0) for i in range(300)], "seq_no long, seed string, tx double, ty double, tz double, h double, yaw double")
    got = pose.traj_random_shell(rows, 5000, 12000, 120).toPandas()
    r = np.sqrt((got.x - 1) ** 2 + (got.y - 2) ** 2 + (got.z - 3) ** 2)
    assert len(got) == 7500 and r.between(4999, 12001).all() and (got.tilt <= 60.001).all()
    last = got[got.frame == 24].sort_values("seq_no")  # the reference view, above the target at its height
    assert (last[["x", "y"]] == [1, 2]).all().all() and (last.pitch == -90).all() and (last.roll == 0).all() and np.allclose(last.z, 3 + 5000 + np.arange(300) * 20)
    assert got.equals(pose.traj_random_shell(rows, 5000, 12000, 120).toPandas())


def test_two_curves_are_resampled_apart(spark):
    n = 101
    rows = [(c, k, k / (n - 1), float(k * (c + 1)) if c else float(k * k), 0.0, 0.0) for c in (0, 1) for k in range(n)]
    got = pose.resample_by_arc_length(spark.createDataFrame(rows, "curve int, id int, s double, x double, y double, z double"), 25).toPandas()
    even = got[got.curve == 1].sort_values("frame").s
    assert np.allclose(even, np.linspace(0, 1, 25)) and len(got) == 50
    x = np.interp(got[got.curve == 0].sort_values("frame").s, np.arange(n) / (n - 1), np.arange(n) ** 2)
    assert np.allclose(np.diff(x), 10_000 / 24)


def test_plane_shift_is_focal_times_baseline_over_depth(spark):
    eye = {f"r{i}{j}": F.lit(float(i == j)) for i in range(3) for j in range(3)}
    px = spark.range(64).selectExpr("int(id % 8) as x", "int(id div 8) as y", "5D as depth", "100D as f", "32D as c").withColumns({**eye, "t0": F.lit(0.2), "t1": F.lit(0.0), "t2": F.lit(0.0)})
    got = rgbd.project_pixels(px).selectExpr("max(abs(u - x - 0.5 - 4)) as off").first().off
    assert got < 1e-9
    behind = rgbd.project_pixels(px.withColumn("t2", F.lit(-10.0))).filter("u is not null").count()
    assert behind == 0


def test_placement_reasons(spark):
    cases = [  # pid 1 is on the target, pid 3 is known from before
        (1, "G", 10.0, 0.0, None), (1, "G", 128.0, None, None), (1, "G", 128.5, 0.0, "framebuffer_allocation"), (2, "G", 10.0, 0.0, "unverified_graphics_placement"),
        (1, "C", 10.0, 5.0, "compute_context"), (1, "C+G", 10.0, 0.0, "compute_context"), (1, "G", 10.0, 5.0, "sm_activity"), (1, "G", None, 0.0, "unverified_graphics_placement"),
        (1, "G", -1.0, 0.0, "unverified_graphics_placement"), (1, None, 10.0, 0.0, "unverified_graphics_placement"), (2, "G", 300.0, 5.0, "sm_activity"), (3, "G", 0.0, 0.0, None),
    ]
    rows = [("r", -1, 0, 1, "G", 10.0, 0.0), *(("r", k, 1, *c[:4]) for k, c in enumerate(cases))]
    df = spark.createDataFrame(rows, "run_label string, k int, gpu_index int, pid int, process_type string, framebuffer_mb double, sm_util_percent double")
    verified = spark.createDataFrame([("r", 3)], "run_label string, pid int")
    got = {r.k: r.reason for r in telemetry.placement_violations(df, 0, verified=verified).collect()}
    assert got == {k: c[4] for k, c in enumerate(cases) if c[4]}


def test_plan_files(spark, tmp_path):
    """Quoted fields, an unknown number, several files; order inside a file is kept."""
    from framewise.sources import capture

    head = "sequence_id,map_path,expected_views\n"
    (tmp_path / "a.csv").write_text("\ufeff" + head + "".join(f'"s,{k}",/m,{k}\n' for k in range(200)))
    (tmp_path / "b.csv").write_text(head + "x,/m,many\n")
    rows = capture.read_sequence_plan(spark, str(tmp_path / "a.csv"), str(tmp_path / "b.csv")).orderBy("plan_file", "row_pos").collect()
    assert [(r.sequence_id, r.expected_views) for r in rows] == [(f"s,{k}", k) for k in range(200)] + [("x", None)]
    import hashlib

    assert {r.sha256 for r in capture.plan_file_hashes(spark, str(tmp_path)).collect()} == {hashlib.sha256((tmp_path / f).read_bytes()).hexdigest() for f in ("a.csv", "b.csv")}
    (tmp_path / "c.csv").write_text(head)
    with pytest.raises(ValueError):
        capture.read_sequence_plan(spark, str(tmp_path / "c.csv"))


def test_inside_needs_one_actor_on_both_sides(spark):
    df = spark.createDataFrame([(1, 7, "up"), (1, 7, "down"), (2, 7, "up"), (2, 8, "down")], "point_id int, actor_id int, direction string")
    assert {(r.point_id, r.inside) for r in scene.inside_test(df).collect()} == {(1, True), (2, False)}


def test_exr_header():
    head = struct.pack("<II", 20000630, 2) + b"channels\0chlist\0" + struct.pack("<i", 19) + b"R\0" + struct.pack("<iiii", 1, 0, 1, 1) + b"\0\0"
    assert [capture.read_exr_channels(BytesIO(b)) for b in (head, head[:20], b"no")] == [{"R": "half"}, None, None]


def test_whole_tables_are_read(spark):
    """The queries over whole tables against the rows that their older namesakes leave out."""
    from framewise.fixtures import table
    from framewise.queries import QUERIES

    d = "/root/testdata/sf0.001"
    frames = table(spark, d, "frames")
    assert QUERIES["a3_read_camera_json_all"](spark, d).count() == frames.count()
    jobs = {r.job_id for r in QUERIES["c7_classify_jobs_all"](spark, d).collect()}
    assert jobs == {r[0] for r in table(spark, d, "sequences").select("target_label").distinct().collect()}
    last = table(spark, d, "events").filter("event_type in ('error', 'purchase', 'click')").groupBy(F.col("user_id").alias("worker")).agg(F.max_by("event_type", "event_id").alias("t"))
    ends = {r.worker: r.t for r in last.collect()}
    for r in QUERIES["c18_worker_outcome_all"](spark, d).collect():
        says = {"click": ["cancelled"], "error": ["failed"], "purchase": ["finished", "unreaped", "teardown_incomplete"]}
        assert r.outcome in says.get(ends.get(r.worker), ["crash"])
    placed = table(spark, d, "placement")
    known = {(r.run_label, r.pid) for r in placed.filter("gpu_index = 0").collect()}
    assert not any(r.reason == "unverified_graphics_placement" and r.framebuffer_mb is not None and (r.run_label, r.pid) in known for r in telemetry.placement_violations(placed, 0).collect())


def test_descriptors_of_all_rows_match(spark):
    """Every row is on both sides and its moved copy is found; no list of distances is collected."""
    from framewise.fixtures import table
    from framewise.queries import QUERIES

    d = "/root/testdata/sf0.001"
    found = QUERIES["e12_descriptor_match_all"](spark, d)
    assert "collect_list" not in found._jdf.queryExecution().toString()
    ids = {r.vec_id for r in table(spark, d, "embeddings").select("vec_id").collect()}
    blocks = {k: sum(i // 64 == k for i in ids) for k in {i // 64 for i in ids}}
    assert {(r.a, r.b) for r in found.collect()} == {(i, i) for i in ids if blocks[i // 64] >= 8}


def test_visible_actors_are_the_visible_rows_of_the_matrix(spark):
    from framewise.operators import scene

    actors = spark.createDataFrame([("m", a, o) for a, o in (("t1", False), ("t2", False), ("t3", None), ("tree", True), ("rock", True))] + [("n", "t1", False), ("o", "tree", True)], "map_path string, actor string, is_occluder boolean")
    targets = spark.createDataFrame([("m", "t1"), ("m", "t2"), ("m", "gone"), ("n", "t1"), ("o", "t9")], "map_path string, target string")
    rows = lambda df: sorted(map(tuple, df.select("map_path", "target", "actor", "suffix").collect()))
    asked = targets.selectExpr("map_path", "target", "explode(array('occ', 'GT')) as suffix", "1 as actor")
    got = scene.visible_actors(asked, scene.visibility_rules(actors))
    assert rows(got) == rows(scene.scene_visibility_matrix(targets, actors).filter("visible"))
    assert rows(scene.visible_actors(asked.filter("target = 't1' and suffix = 'GT'"), scene.visibility_rules(actors))) == [("m", "t1", "t1", "GT"), ("n", "t1", "t1", "GT")]


def test_planted_centres_are_faults_of_renamed_trajectories_too(spark):
    """1643 = 31 * 53 has both faults; sf0.01 is the smallest size with such a sequence that ends on the reference view."""
    from framewise.fixtures import table
    from framewise.queries import QUERIES

    d = "/root/testdata/sf0.01"
    ending = {r.seq_no for r in table(spark, d, "sequences").filter("seq_no % 1643 = 0 and trajectory in ('rot_spiral', 'rand_shell')").collect()}
    got = {r.id: r.codes.split(",") for r in QUERIES["d14_pose_rules"](spark, d).filter("id % 31 = 0 or id % 53 = 0").collect()}
    assert ending and all({"trajectory", "center_idx"} <= set(got[k]) for k in ending)
    assert all(("center_idx" in codes) for k, codes in got.items() if k % 31 == 0)
