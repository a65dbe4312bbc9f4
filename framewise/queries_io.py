"""Registered queries of the sources and sinks: tables are written in the capture's formats and read back."""

from __future__ import annotations

import struct
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import functions as F

from framewise.fixtures import oracle, table
from framewise.operators import plan as P
from framewise.sources import capture as A
from framewise.sources import pose_store as PS
from framewise.sources.listing import walk
from framewise.sources.png import SIGNATURE
from framewise.sources.store import new_folder

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = oracle(sql)
        return f

    return add


def _plan(spark, d):
    return table(spark, d, "plan_rows").select("seq_no", *A.PLAN)


@query("a1_read_sequence_plan", "select sequence_id, map_path, split, expected_views, trajectory, height_m, yaw_deg from {plan_rows}")
def _(spark, d):
    path = new_folder(spark, "plan")
    _plan(spark, d).drop("seq_no").write.option("header", True).csv(path)
    return A.read_sequence_plan(spark, path).select("sequence_id", "map_path", "split", "expected_views", "trajectory", "height_m", "yaw_deg")


@query("a2_read_manifest", "select map_path, target_label, x, y, z from {targets}")
def _(spark, d):
    t, path = table(spark, d, "targets"), new_folder(spark, "manifest")
    targets = F.map_from_entries(F.collect_list(F.struct("target_label", F.struct("x", "y", "z"))))
    part = F.floor(F.col("target_id") / 512).alias("part")  # a document holds a bounded stretch of a map's targets
    per_map = t.groupBy("map_path", part).agg(targets.alias("targets")).join(table(spark, d, "maps"), "map_path")
    one = F.struct(F.col("map_path").alias("map"), "source_scene", "split", "targets", F.array(F.lit("Tree_1")).alias("occlusion_actor_names"))
    per_map.select(F.lit("me").alias("owner"), F.lit("approved").alias("status"), F.array(one).alias("maps")).write.json(path)
    return A.read_manifest(spark, path, multi_line=False)[1]


@query("a3_read_camera_json", "select 'T'||seq_no as target, frame as frame_id, tx, cast(frame as bigint) as pos from {frames}")
def _(spark, d):
    path = new_folder(spark, "poses")
    row = lambda *v: F.array(*(F.lit(float(x)) if isinstance(x, int) else x for x in v))
    # What a frame has of its own is shuffled; the document is made of it afterwards, and written compressed.
    own = table(spark, d, "frames").groupBy("seq_no").agg(F.sort_array(F.collect_list(F.struct("frame", "tx", "ty", "tz"))).alias("own"))
    f = lambda x: F.struct(x["frame"].alias("frame_id"), F.format_string("rgb/%04d.png", x["frame"]).alias("file_path"), F.array(row(1, 0, 0, x["tx"]), row(0, 1, 0, x["ty"]), row(0, 0, 1, x["tz"]), row(0, 0, 0, 1)).alias("transform"))
    docs = own.select("seq_no", F.transform("own", f).alias("frames"))
    docs.select(F.lit("1").alias("version"), F.lit(12).alias("centre_frame"), F.struct(F.concat(F.lit("T"), F.col("seq_no").cast("string")).alias("target")).alias("source"), "frames").write.option("compression", "gzip").json(path)
    got = A.read_camera_json(spark, path, multi_line=False)
    return got.select("source.target", "frame_id", F.get(F.get("transform", 0), 3).alias("tx"), F.col("pos").cast("long").alias("pos"))


QUERIES["a3_read_camera_json_all"], ORACLES["a3_read_camera_json_all"] = QUERIES["a3_read_camera_json"], ORACLES["a3_read_camera_json"]


def _blobs(spark, d, name, rel: str, content) -> str:
    """Write a file for every supplier, in the tasks: its place is the SQL expression rel over s_suppkey, its bytes content(k)."""
    folder = new_folder(spark, name)

    def run(batches):
        for b in batches:
            for rel, k in zip(b["rel"].to_pylist(), b["k"].to_pylist(), strict=True):
                where, path = fs.FileSystem.from_uri(folder)
                where.create_dir(f"{path}/{rel}".rpartition("/")[0], recursive=True)
                with where.open_output_stream(f"{path}/{rel}", compression=None) as f:
                    f.write(content(k))
            yield pa.record_batch([b["k"]], names=["k"])

    rows = table(spark, d, "supplier").selectExpr("cast(s_suppkey as bigint) as k", f"{rel} as rel")
    rows.mapInArrow(run, "k long").write.parquet(new_folder(spark, f"{name}-written"))
    return folder


_TREE = "concat(if(s_suppkey % 3 = 0, 'rot_arc', 'deep/er/fix_line'), '/m_Target_', lpad(cast(s_suppkey as string), 6, '0'), if(s_suppkey % 2 = 0, '_occ', '_GT'), '/depth/', if(s_suppkey % 7 = 0, concat('view.', s_suppkey), lpad(cast(s_suppkey % 25 as string), 4, '0')), if(s_suppkey % 5 = 0, '.EXR', if(s_suppkey % 11 = 0, '.txt', '.exr')))"


@query("a4_scan_output_tree", "select case when s_suppkey % 3=0 then 'rot_arc' else 'fix_line' end as trajectory, printf('m_Target_%06d', s_suppkey) as prefix, case when s_suppkey % 2=0 then 'occ' else 'GT' end as suffix, 'depth' as pass_name, case when s_suppkey % 7<>0 then cast(s_suppkey % 25 as int) end as frame, case when s_suppkey % 7=0 then 'view.'||s_suppkey else printf('%04d', s_suppkey % 25) end as stem, 'exr' as ext, s_suppkey % 40 as size from {supplier} where s_suppkey % 5=0 or s_suppkey % 11<>0")
def _(spark, d):
    """Files of several depths and sizes, with stems that are no numbers, extensions in capitals and files of other kinds."""
    folder = _blobs(spark, d, "tree", _TREE, lambda k: b"x" * (k % 40))
    return A.scan_output_tree(spark, folder).select("trajectory", "prefix", "suffix", "pass_name", "frame", "stem", "ext", "size")


@query("a5_read_step_telemetry", "select event_id, 'step_'||user_id as step_id, value as wall_seconds, event_type<>'error' as success from {events}")
def _(spark, d):
    path = new_folder(spark, "steps")
    table(spark, d, "events").selectExpr("event_id", "concat('step_', user_id) as step_id", "value as wall_seconds", "event_type <> 'error' as success").write.json(path)
    return A.read_step_telemetry(spark, path).select("event_id", "step_id", "wall_seconds", "success")


@query("a6_read_job_results", "select 'run_'||user_id % 20 as run, job_id, returncode, wall_seconds, cast(attempt as int) as retry_attempt, event_id as files from {attempts}")
def _(spark, d):
    path = new_folder(spark, "results")
    r = F.struct(F.col("job_id").alias("id"), "returncode", "wall_seconds", F.col("attempt").alias("retry_attempt"), F.lit(False).alias("requeued"), F.struct(F.col("event_id").alias("files")).alias("output"))
    part = F.floor(F.col("event_id") / 256).alias("part")  # a document holds a bounded stretch of a run
    table(spark, d, "attempts").groupBy(F.expr("concat('run_', user_id % 20) as run"), part).agg(F.collect_list(r).alias("results")).drop("part").write.json(path)
    return A.read_job_results(spark, path, multi_line=False).select("run", "job_id", "returncode", "wall_seconds", "retry_attempt", "files")


@query("a7_read_gpu_samples", "select run_label, elapsed_seconds, gpu_util_percent, gpu_memory_mb, cast(image_files as bigint) as image_files from {gpu_samples}")
def _(spark, d):
    path = new_folder(spark, "samples")
    rows = table(spark, d, "gpu_samples").withColumn("gpu_util_percent", F.coalesce(F.col("gpu_util_percent").cast("string"), F.lit("[N/A]")))
    rows.select(*(c.split()[0] for c in A.SAMPLE)).write.option("header", True).csv(path)
    return A.read_gpu_samples(spark, path)


def _exr(k: int) -> bytes:
    """A header whose channels and length depend on k; some are cut off, some are no EXR."""
    text = lambda *names: b"".join(n.encode() + b"\0" for n in names)
    channels = [("R", 1), ("Z", 2)] if k % 3 else [("Y", 1), ("id", 0), ("Z", 2)]
    listed = b"".join(text(n) + struct.pack("<iiii", kind, 0, 1, 1) for n, kind in channels) + b"\0"
    note = text("comments", "string") + struct.pack("<i", 90_000 * (k % 4 == 1)) + b"c" * (90_000 * (k % 4 == 1))
    data = struct.pack("<II", 20000630, 2) + note + text("channels", "chlist") + struct.pack("<i", len(listed)) + listed + b"\0" + b"pixels"
    return b"not an image" if k % 13 == 0 else data[: len(data) - 20] if k % 7 == 0 else data


@query("a9_exr_header_audit", """with f as (select s_suppkey as k, k % 13=0 or k % 7=0 as broken from {supplier}), c as (select * from (values (true,'Y','half'),(true,'id','uint'),(true,'Z','float'),(false,'R','half'),(false,'Z','float')) v(third,channel,type))
 select channel, type, count(*) as files from f join c on third = (k % 3=0) where not broken group by 1,2 union all select null, null, count(*) from f where broken having count(*)>0""")
def _(spark, d):
    """Headers of a hundred bytes and of ninety thousand; broken ones count under no channel."""
    folder = _blobs(spark, d, "exr", "concat('d', s_suppkey % 8, '/', s_suppkey, '.exr')", _exr)
    return A.exr_header_audit(walk(spark, folder).filter("kind = 'file'"), folder).groupBy("channel", "type").agg(F.count("*").alias("files"))


@query("a10_write_sequence_index", "with n as (select *, printf('%s_%s_height_%03d_ang_%03d', string_split(map_path,'/')[-1], target_label, cast(trunc(height_m) as int), cast(trunc(yaw_deg) as int)) as prefix from {plan_rows}) select sequence_id, trajectory||'/'||prefix||'_occ' as occ_directory, trajectory||'/'||prefix||'_GT' as gt_directory from n")
def _(spark, d):
    path = new_folder(spark, "index")
    A.write_sequence_index(P.canonical_names(table(spark, d, "plan_rows")).select("sequence_id", "occ_directory", "gt_directory"), path)
    return spark.read.schema("sequence_id string, occ_directory string, gt_directory string").option("header", True).csv(path)


@query("a11_write_pose_pairs", """with s as (select prefix, suffix, n, case when n % 5=0 then 'written' when n % 7=0 and suffix='occ' then 'conflict' else 'unchanged' end as status from (select prefix, min(seq_no) as n from {sequences} group by 1) q cross join (values ('GT'),('occ')) s(suffix))
 select prefix, suffix, status, sha256(case when status='unchanged' then '{"pose": 1.0, "prefix": "'||prefix||'"}' else '{"prefix": "'||prefix||'", "pose": 1}' end) as sha256 from s""")
def _(spark, d):
    """Over documents of another key order, some of another pose, and some missing: a conflict first refuses the version, then is
    overwritten. The digests are of the documents read back."""
    one = table(spark, d, "sequences").groupBy("prefix").agg(F.min("seq_no").alias("n"))
    hashed = F.sha2("prefix", 256)
    payloads = one.select("prefix", F.format_string('{"prefix": "%s", "pose": 1}', "prefix").alias("content"), hashed.alias("source_hash"), hashed.alias("current_hash"))
    there = one.filter("n % 5 <> 0").withColumn("suffix", F.explode(F.array(*map(F.lit, PS.SUFFIXES))))
    pose = F.expr("if(n % 7 = 0 and suffix = 'occ', '2.0', '1.0')")
    root = new_folder(spark, "pose-store")
    PS.write_documents(there.select("prefix", "suffix", F.format_string('{"pose": %s, "prefix": "%s"}', pose, "prefix").alias("content"), hashed.alias("source_hash")), root)
    if PS.write_pose_pairs(payloads, root)[1] is not None:
        raise RuntimeError("a conflict must refuse a version unless overwriting is asked for")
    status, _version = PS.write_pose_pairs(payloads, root, overwrite=True)
    found = PS.read_documents(spark, root).select("prefix", "suffix", F.sha2("content", 256).alias("sha256"))
    return status.join(found, ["prefix", "suffix"]).select("prefix", "suffix", "status", "sha256")


@query("a12_write_report", "select trajectory, count(*) as files, cast(sum(size) as bigint) as bytes from {files} group by 1")
def _(spark, d):
    path = new_folder(spark, "report")
    A.write_report(table(spark, d, "files").groupBy("trajectory").agg(F.count("*").alias("files"), F.sum("size").cast("long").alias("bytes")), path)
    return spark.read.schema("trajectory string, files long, bytes long").json(path)


def _png(k: int) -> bytes:
    """An image whose size and pixels depend on k, with another row filter in every row; some are cut off."""
    width, height = 4 + k % 5, 3 + k % 4
    pixel = lambda x, y: ((k + 7 * x) % 256, (3 * k + 5 * y) % 256, (x * y + k) % 256)
    rows = [[v for x in range(width) for v in pixel(x, y)] for y in range(height)]
    out = b""
    for y, row in enumerate(rows):
        kind, above = (k + y) % 5, rows[y - 1] if y else [0] * len(row)
        left, corner = [0, 0, 0, *row[:-3]], [0, 0, 0, *above[:-3]]
        guess = []
        for a, b, c in zip(left, above, corner, strict=True):
            near = min((abs(b - c), 0, a), (abs(a - c), 1, b), (abs(a + b - 2 * c), 2, c))[2]
            guess.append((0, a, b, (a + b) // 2, near)[kind])
        out += bytes([kind]) + bytes((v - g) % 256 for v, g in zip(row, guess, strict=True))
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    packed = zlib.compress(out)
    data = SIGNATURE + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + chunk(b"IDAT", packed[:9]) + chunk(b"IDAT", packed[9:]) + chunk(b"IEND", b"")
    return data[:-15] if k % 17 == 0 else data


_TOTAL = "case when k % 17<>0 then (select sum({}) from range(4+k % 5) a(x), range(3+k % 4) b(y)) end"


@query("a8_scan_rgb_frames", f"select k, case when k % 17<>0 then cast(4+k % 5 as int) end as width, case when k % 17<>0 then cast(3+k % 4 as int) end as height, cast({_TOTAL.format('(x*y+k) % 256')} as bigint) as blue, cast({_TOTAL.format('(3*k+5*y) % 256')} as bigint) as green, cast({_TOTAL.format('(k+7*x) % 256')} as bigint) as red from (select cast(s_suppkey as bigint) as k from {{supplier}})")
def _(spark, d):
    """One image for each supplier; the sum of each channel stands for its pixels. Bytes come as blue, green, red."""
    folder = _blobs(spark, d, "frames", "concat('f', s_suppkey % 6, '/', s_suppkey, if(s_suppkey % 2 = 0, '.png', '.PNG'))", _png)
    rows = A.scan_rgb_frames(spark, folder)
    k = F.regexp_extract("path", r"([0-9]+)\.[^.]*$", 1).cast("long").alias("k")
    byte = lambda i: F.conv(F.substring(F.hex("bgr"), 2 * i + 1, 2), 16, 10).cast("long")
    total = lambda first: F.when(F.col("bgr").isNotNull(), F.aggregate(F.sequence(F.lit(first), F.octet_length("bgr") - 1, F.lit(3)), F.lit(0).cast("long"), lambda s, i: s + byte(i)))
    return rows.select(k, "width", "height", *(total(c).alias(n) for c, n in enumerate(("blue", "green", "red"))))
