"""Pose documents of captures, written in two phases.

A store is a folder: `documents/<version>/...` has the documents, `manifests/<version>` (Parquet) says which document each
sequence's two passes have in that version, `claims/<version>` is the writer's lock. Phase one stages documents in tasks, each
attempt in a folder of its own. Phase two is the manifest: its rows come from the tasks whose attempts Spark commits, and a
version exists once the committer's _SUCCESS mark is there. So a reader sees both documents of every pair of a version or
none, whatever was killed, retried or run twice; old documents are never touched, and an old version can be restored."""

from __future__ import annotations

import hashlib
import json
import math
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewise.sources.listing import walk
from framewise.sources.store import stash

# The passes of a pair; what refuses a version.
SUFFIXES = ("GT", "occ")
REFUSED = ("invalid", "ambiguous", "source_changed")
MANIFEST = "prefix string, suffix string, path string, sha256 string, source_hash string"
#: Documents of one folder.
FILES = 4096


def _hadoop(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    where, at = _hadoop(spark, folder)
    names = [f.getPath().getName() for f in where.listStatus(at)] if where.exists(at) else []
    return sorted(int(n) for n in names if n.isdigit())


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the versions that are complete, rising."""

    def whole(n: int) -> bool:
        where, mark = _hadoop(spark, f"{root}/manifests/{n:09d}/_SUCCESS")
        return where.exists(mark)

    return [n for n in _numbers(spark, f"{root}/manifests") if whole(n)]


def manifest(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """prefix, suffix, path (under root), sha256 of the bytes and source_hash of the last version, or of the one asked for; no rows
    in a store without versions."""
    known = versions(spark, root)
    if version is not None and version not in known:
        raise ValueError(f"the store has no version {version}")
    if not known:
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(f"{root}/manifests/{version or known[-1]:09d}")


def _claim(spark: SparkSession, root: str, take_over: bool) -> int:
    """The next version's number, which no other writer has. A claim without a version is that of a writer at work, or of one that
    was killed: it is respected unless take_over."""
    done, claimed = versions(spark, root), _numbers(spark, f"{root}/claims")
    if claimed and claimed[-1] > (done[-1] if done else 0) and not take_over:
        raise RuntimeError(f"another writer holds version {claimed[-1]} of {root}")
    version = max([0, *done, *claimed]) + 1
    where, at = _hadoop(spark, f"{root}/claims/{version:09d}")
    where.create(at, False).close()  # fails if it exists
    return version


def _release(spark: SparkSession, root: str, version: int) -> None:
    where, at = _hadoop(spark, f"{root}/claims/{version:09d}")
    where.delete(at, False)


def _at(root: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(root if "://" in root or root.startswith("file:") else f"file://{root}")


def write_bytes(where: fs.FileSystem, path: str, data: bytes) -> None:
    with where.open_output_stream(path) as f:
        f.write(data)


def _read(where: fs.FileSystem, path: str) -> bytes | None:
    try:
        with where.open_input_stream(path) as f:
            return f.read()
    except FileNotFoundError:
        return None


def _parsed(text: str | bytes | None):
    """(whether it is a document, the document). Numbers that JSON has no form for are not allowed."""

    def number(s: str) -> float:
        v = float(s)
        if not math.isfinite(v):
            raise ValueError(s)
        return v

    if text is None:
        return False, None
    try:
        return True, json.loads(text, parse_float=number, parse_constant=number)
    except (ValueError, RecursionError):
        return False, None


def pair_status(payloads: DataFrame, old: DataFrame, root: str) -> DataFrame:
    """payloads(prefix, content: JSON text, source_hash, current_hash) against old, a manifest of the store at root: prefix, suffix,
    status, content, source_hash, for both passes.

    written: there is no document yet (or its file is gone); unchanged: the document there is the same when parsed, whatever
    its bytes; conflict: it differs, or can't be parsed. source_changed: the source is no longer what the payload was made of (two
    unknown hashes are equal). invalid: no prefix, or content that is null or no JSON. ambiguous: a prefix with different
    payloads; equal ones count once. Payloads and manifest meet once, on the prefix; documents are compared in tasks."""
    row = F.struct("content", "source_hash", "current_hash")
    one = payloads.groupBy("prefix").agg(F.min(row).alias("p"), F.max(row).alias("q"))
    path = lambda s: F.max(F.when(F.col("suffix") == s, F.col("path"))).alias(s)
    rows = one.join(old.groupBy("prefix").agg(*map(path, SUFFIXES)), "prefix", "left")
    rows = rows.select("prefix", "p.*", F.col("p").eqNullSafe(F.col("q")).alias("alike"), *SUFFIXES)

    def run(batches):
        where, top = _at(root)
        for b in batches:
            out: dict[str, list] = {k: [] for k in ("prefix", "suffix", "status", "content", "source_hash")}
            for r in b.to_pylist():
                good, new = _parsed(r["content"])
                for suffix in SUFFIXES:
                    if r["prefix"] is None or not good:
                        status = "invalid" if r["alike"] else "ambiguous"
                    elif not r["alike"]:
                        status = "ambiguous"
                    elif r["source_hash"] != r["current_hash"]:
                        status = "source_changed"
                    else:
                        there = _read(where, f"{top}/{r[suffix]}") if r[suffix] else None
                        status = "written" if there is None else "unchanged" if _parsed(there) == (True, new) else "conflict"
                    for k, v in zip(out, (r["prefix"], suffix, status, r["content"], r["source_hash"]), strict=True):
                        out[k].append(v)
            yield pa.record_batch([pa.array(v, pa.string()) for v in out.values()], names=list(out))

    return rows.mapInArrow(run, "prefix string, suffix string, status string, content string, source_hash string")


def _stage(documents: DataFrame, root: str, version: int, write: Callable[[fs.FileSystem, str, bytes], None]) -> DataFrame:
    """documents(prefix, suffix, content, source_hash), each written as a file -> rows of the manifest."""

    def run(batches):
        where, top = _at(root)
        own, n = f"documents/{version:09d}/{uuid.uuid4().hex}", 0
        for b in batches:
            paths, sums = [], []
            for text in b["content"].to_pylist():
                folder, data = f"{own}/{n // FILES:05d}", text.encode()
                if n % FILES == 0:
                    where.create_dir(f"{top}/{folder}", recursive=True)
                paths.append(f"{folder}/{n % FILES:04d}.json")
                write(where, f"{top}/{paths[-1]}", data)
                sums.append(hashlib.sha256(data).hexdigest())
                n += 1
            yield pa.record_batch([b["prefix"], b["suffix"], pa.array(paths, pa.string()), pa.array(sums, pa.string()), b["source_hash"]], names=["prefix", "suffix", "path", "sha256", "source_hash"])

    return documents.select("prefix", "suffix", "content", "source_hash").mapInArrow(run, MANIFEST)


def _publish(documents: DataFrame, old: DataFrame, root: str, version: int, write=write_bytes) -> None:
    kept = old.join(documents.select("prefix", "suffix"), ["prefix", "suffix"], "left_anti").select(old.columns)
    kept.unionByName(_stage(documents, root, version, write)).write.mode("overwrite").parquet(f"{root}/manifests/{version:09d}")


def write_documents(documents: DataFrame, root: str, take_over: bool = False) -> int:
    """Publish documents(prefix, suffix, content, source_hash), one a prefix and suffix, as they are, in place of those there:
    the new version's number."""
    spark = documents.sparkSession
    version = _claim(spark, root, take_over)
    try:
        _publish(documents, manifest(spark, root), root, version)
    except Exception:
        _release(spark, root, version)
        raise
    return version


def write_pose_pairs(payloads: DataFrame, root: str, overwrite: bool = False, take_over: bool = False, write=write_bytes) -> tuple[DataFrame, int | None]:
    """Write both documents of all payloads, or none: (pair_status(), the store's version then). The version is None where a status
    of REFUSED, or a conflict unless overwriting, forbids it. Documents that are unchanged keep their bytes; the others of
    a pair get equal bytes. Nothing to write makes no new version."""
    spark = payloads.sparkSession
    version = _claim(spark, root, take_over)
    try:
        old = manifest(spark, root)
        status = stash(pair_status(payloads, old, root), "pose-status")
        new, refused = status.filter("status <> 'unchanged'"), list(REFUSED) + ([] if overwrite else ["conflict"])
        allowed = status.filter(F.col("status").isin(refused)).isEmpty()
        if not allowed or new.isEmpty():
            _release(spark, root, version)
            return status, (versions(spark, root) or [0])[-1] if allowed else None
        _publish(new, old, root, version, write)
    except Exception:
        _release(spark, root, version)
        raise
    return status, version


def restore(spark: SparkSession, root: str, version: int, take_over: bool = False) -> int:
    """Make an old version the last one again, under a new number; its documents are still there."""
    new = _claim(spark, root, take_over)
    try:
        manifest(spark, root, version).write.mode("overwrite").parquet(f"{root}/manifests/{new:09d}")
    except Exception:
        _release(spark, root, new)
        raise
    return new


def read_documents(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """prefix, suffix, content of a version (the last one), read in tasks; content is null where a file is gone."""

    def run(batches):
        where, top = _at(root)
        for b in batches:
            found = [_read(where, f"{top}/{p}") for p in b["path"].to_pylist()]
            yield pa.record_batch([b["prefix"], b["suffix"], pa.array([v and v.decode(errors="replace") for v in found], pa.string())], names=["prefix", "suffix", "content"])

    return manifest(spark, root, version).select("prefix", "suffix", "path").mapInArrow(run, "prefix string, suffix string, content string")


def abandoned(spark: SparkSession, root: str) -> DataFrame:
    """path (under root) of documents that no version names: those of killed or repeated attempts."""
    here = walk(spark, f"{root}/documents").filter("kind = 'file'").select(F.regexp_extract("path", r"documents/\d{9}/[0-9a-f]{32}/\d+/\d+\.json$", 0).alias("path"))
    known = [f"{root}/manifests/{v:09d}" for v in versions(spark, root)]
    named = spark.read.schema(MANIFEST).parquet(*known) if known else spark.createDataFrame([], MANIFEST)
    return here.filter("path <> ''").join(named.select("path"), "path", "left_anti")
