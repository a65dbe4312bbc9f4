"""Sources and sinks of a capture: plans, manifests, pose documents, telemetry, images. Schemas are explicit."""

from __future__ import annotations

import struct

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewise.sources.listing import walk
from framewise.sources.png import decode

PLAN = {"sequence_id": "string", "map_path": "string", "source_scene": "string", "split": "string", "target_label": "string", "expected_views": "int", "trajectory": "string", "height_m": "double", "yaw_deg": "double"}
MANIFEST = "owner string, status string, maps array<struct<map:string,source_scene:string,split:string,targets:map<string,struct<x:double,y:double,z:double>>,occlusion_actor_names:array<string>>>"
POSES = "version string, centre_frame int, intrinsics array<array<double>>, source struct<map:string,target:string,sha256:string>, frames array<struct<frame_id:int,file_path:string,transform:array<array<double>>>>"
STEP = "event_id long, step_id string, files_present int, wall_seconds double, success boolean"
SAMPLE = ("run_label string, elapsed_seconds string, gpu_util_percent string, gpu_memory_mb string, image_files string").split(", ")
RESULTS = "run string, results array<struct<id:string,returncode:int,wall_seconds:double,retry_attempt:int,requeued:boolean,output:struct<files:bigint,bytes:bigint>>>"


def read_sequence_plan(spark: SparkSession, *paths: str) -> DataFrame:
    """Header CSV plans, all columns read as text and cast. plan_file and row_pos (the place of the row's block in the file and
    its number in it) keep the file order, while large files are read in blocks. Files must have one header; an empty set of
    rows is an error."""
    at = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    for path in paths:
        if spark.read.option("header", True).csv(path).isEmpty():
            raise ValueError(f"the plan is empty: {path}")
    rows = spark.read.option("header", True).option("enforceSchema", False).csv(list(paths))
    names = rows.columns
    rows = rows.select("*", F.col("_metadata.file_path").alias("plan_file"), at.alias("row_pos"))
    return rows.select("plan_file", "row_pos", *(F.expr(f"try_cast(`{n}` as {PLAN.get(n, 'string')})").alias(n) for n in names))


def plan_file_hashes(spark: SparkSession, path: str) -> DataFrame:
    """plan_file and the SHA-256 of its bytes."""
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("plan_file"), F.sha2("content", 256).alias("sha256"))


def write_sequence_index(named: DataFrame, path: str) -> None:
    """The plan with its occ and GT directories as header CSV."""
    named.write.option("header", True).csv(path)


def read_manifest(spark: SparkSession, path: str, multi_line: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(maps, targets, occluders) of JSON manifests: one document a file, or one a line."""
    rows = spark.read.schema(MANIFEST).option("multiLine", multi_line).json(path).select("owner", "status", F.explode("maps").alias("m"))
    maps = rows.select("owner", "status", F.col("m.map").alias("map_path"), "m.source_scene", "m.split")
    targets = rows.select(F.col("m.map").alias("map_path"), F.explode("m.targets").alias("target_label", "p")).select("map_path", "target_label", "p.*")
    occluders = rows.select(F.col("m.map").alias("map_path"), F.explode("m.occlusion_actor_names").alias("actor"))
    return maps, targets, occluders


def read_camera_json(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Pose documents, one a file or one a line; one row per frame."""
    rows = spark.read.schema(POSES).option("multiLine", multi_line).json(path).withColumn("file", F.col("_metadata.file_path"))
    return rows.select("file", "version", "centre_frame", "intrinsics", "source", F.posexplode("frames").alias("pos", "f")).select("file", "version", "centre_frame", "intrinsics", "source", "pos", "f.*")


def scan_output_tree(spark: SparkSession, root: str, extensions: tuple[str, ...] = ("png", "exr")) -> DataFrame:
    """Listing of an output tree (listing.py): trajectory, prefix, suffix, pass, frame (null where the stem is no number), stem,
    size and time; file contents are never read and links are not followed."""
    rows = walk(spark, root).filter("kind = 'file'")
    pattern = r"/([^/]+)/([^/]+)_(occ|GT)/([^/]+)/([^/]+)\.(\w+)$"
    part = lambda k: F.regexp_extract("path", pattern, k)
    rows = rows.select(part(1).alias("trajectory"), part(2).alias("prefix"), part(3).alias("suffix"), part(4).alias("pass_name"), part(5).try_cast("int").alias("frame"), part(5).alias("stem"), F.lower(part(6)).alias("ext"), "size", F.timestamp_micros(F.floor(F.col("mtime_ns") / 1000)).alias("modified"), "mtime_ns", "path")
    return rows.filter(F.col("ext").isin(*extensions))


def read_step_telemetry(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STEP).json(path)


def read_job_results(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Attempt rows of nested result documents, one a file or one a line."""
    rows = spark.read.schema(RESULTS).option("multiLine", multi_line).json(path)
    return rows.select("run", F.inline("results")).select("run", F.col("id").alias("job_id"), "returncode", "wall_seconds", "retry_attempt", "requeued", "output.files", "output.bytes")


def read_gpu_samples(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV samples; a metric that is no number is null and its row stays."""
    rows = spark.read.schema(", ".join(SAMPLE)).option("header", True).csv(path)
    kinds = {"run_label": "string", "image_files": "long"}
    return rows.select(*(F.expr(f"try_cast({c} as {kinds.get(c, 'double')})").alias(c) for c in rows.columns))


def _bytes_of(path: str, scheme: str | None):
    """An open file; path has no scheme, which is that of the tree it was found in."""
    where = fs.LocalFileSystem() if scheme is None else fs.FileSystem.from_uri(scheme)[0]
    return where.open_input_file(path)


def _scheme(root: str) -> str | None:
    return None if "://" not in root or root.startswith("file:") else root


def scan_rgb_frames(spark: SparkSession, root: str) -> DataFrame:
    """Every PNG under root: path, width, height, nChannels and pixel bytes in BGR order, row by row; all null where the file is
    broken. Files are found by tasks and decoded by tasks, one at a time."""
    scheme = _scheme(root)

    def run(batches):
        for b in batches:
            for path in b["path"].to_pylist():
                with _bytes_of(path, scheme) as f:
                    image = decode(f.read())
                row = [path, None, None, None, None]
                if image is not None:
                    turned = image if image.shape[2] < 3 else image[:, :, [2, 1, 0, *range(3, image.shape[2])]]
                    row = [path, image.shape[1], image.shape[0], image.shape[2], turned.tobytes()]
                yield pa.record_batch([pa.array([v], t) for v, t in zip(row, (pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.binary()), strict=True)], names=["path", "width", "height", "nChannels", "bgr"])

    found = walk(spark, root).filter("kind = 'file' and lower(path) like '%.png'").select("path")
    return found.mapInArrow(run, "path string, width int, height int, nChannels int, bgr binary")


#: First bytes of a header that are read; as many again as there are, until it ends.
HEADER_BYTES = 4096


def exr_channels(head: bytes) -> dict[str, str] | None:
    """Channel -> sample type of an OpenEXR header; None if it is no EXR or has no channels. IndexError if it goes on beyond
    these bytes."""
    kinds = {0: "uint", 1: "half", 2: "float"}
    if _number(head, 0) != 20000630:
        return None
    at = 8
    while head[at]:
        name, at = _cstring(head, at)
        kind, at = _cstring(head, at)
        size = _number(head, at)
        at += 4
        if name == "channels" and kind == "chlist":
            out, p = {}, at
            while head[p]:
                channel, p = _cstring(head, p)
                out[channel] = kinds.get(_number(head, p), "unknown")
                p += 16
            return out
        if size < 0:
            return None
        at += size
    return None


def _number(data: bytes, at: int) -> int:
    if at + 4 > len(data):
        raise IndexError
    return struct.unpack_from("<i", data, at)[0]


def _cstring(data: bytes, at: int) -> tuple[str, int]:
    end = data.find(b"\0", at)
    if end < 0:
        raise IndexError
    return data[at:end].decode("latin-1"), end + 1


def read_exr_channels(file) -> dict[str, str] | None:
    """exr_channels() of an open file, of which as much is read as its header has; None too if the file ends before."""
    head, more = b"", HEADER_BYTES
    while piece := file.read(more):
        head, more = head + piece, len(head) + len(piece)
        try:
            return exr_channels(head)
        except IndexError:
            continue
    return None


def exr_header_audit(paths: DataFrame, root: str = "") -> DataFrame:
    """paths(path: URIs, or without scheme if found by walk() under root) -> channel, type rows; unreadable or truncated headers
    have null. Headers are read to their end, whatever their length; images never."""
    scheme = _scheme(root)

    def run(batches):
        for b in batches:
            out = []
            for path in b["path"].to_pylist():
                where, name = fs.FileSystem.from_uri(path) if "://" in path else (None, path)
                with where.open_input_file(name) if where else _bytes_of(name, scheme) as f:
                    found = read_exr_channels(f)
                out.append(None if found is None else list(found.items()))
            yield pa.record_batch([b["path"], pa.array(out, pa.map_(pa.string(), pa.string()))], names=["path", "channels"])

    return paths.select("path").mapInArrow(run, "path string, channels map<string,string>").select("path", F.explode_outer("channels").alias("channel", "type"))


def write_report(metrics: DataFrame, path: str) -> None:
    metrics.coalesce(1).write.json(path)
