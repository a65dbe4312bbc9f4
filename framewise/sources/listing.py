"""Distributed listing of a folder tree.

Directories are rows. A round lists its frontier in tasks, through the file system's interface, and writes what it finds; the
directories among it are the next frontier, until there is none. The driver sees how many directories a round has, never
their names or those of files. Symbolic links are rows of their own and are not followed, so that a loop ends. A directory
that can't be read, or a name that is no text, is a row of kind `unreadable` rather than missing."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewise.sources.store import new_folder

ENTRY = "path string, kind string, size long, mtime_ns long"
#: Directories of one task, and entries of one batch.
DIRECTORIES, ENTRIES = 64, 4096


def _local(path: str) -> Iterator[tuple[str, str, int | None, int | None]]:
    with os.scandir(path) as found:
        for e in found:
            try:
                e.name.encode()
            except UnicodeEncodeError:
                yield os.fsencode(e.path).decode(errors="replace"), "unreadable", None, None
                continue
            try:
                link = e.is_symlink()
                kind = "link" if link else "directory" if e.is_dir(follow_symlinks=False) else "file" if e.is_file(follow_symlinks=False) else "other"
                stat = e.stat(follow_symlinks=False)
                yield e.path, kind, stat.st_size if kind == "file" else None, stat.st_mtime_ns
            except FileNotFoundError:
                continue  # gone since the folder was read


def _remote(where: fs.FileSystem, path: str) -> Iterator[tuple[str, str, int | None, int | None]]:
    kinds = {fs.FileType.Directory: "directory", fs.FileType.File: "file"}
    for e in where.get_file_info(fs.FileSelector(path)):
        kind = kinds.get(e.type, "other")
        yield e.path, kind, e.size if kind == "file" else None, e.mtime_ns


def walk(spark: SparkSession, root: str) -> DataFrame:
    """Everything under root: path (without scheme), kind (file, directory, link, other, unreadable), size of files and
    mtime_ns. The rows are in written tables, one for each depth."""
    where, top = fs.FileSystem.from_uri(root if "://" in root else f"file://{os.path.abspath(root)}")
    scheme = None if isinstance(where, fs.LocalFileSystem) else root
    folder, depth = new_folder(spark, "listing"), 0

    def run(batches):
        store = None if scheme is None else fs.FileSystem.from_uri(scheme)[0]
        held: list[tuple] = []

        def batch():
            columns = zip(*held, strict=True)
            return pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64(), pa.int64()), strict=True)], names=["path", "kind", "size", "mtime_ns"])

        for b in batches:
            for path in b["path"].to_pylist():
                try:
                    for entry in _local(path) if store is None else _remote(store, path):
                        held.append(entry)
                        if len(held) == ENTRIES:
                            yield batch()
                            held.clear()
                except OSError:
                    held.append((path, "unreadable", None, None))
        if held:
            yield batch()

    frontier, n, done = spark.createDataFrame([(top.rstrip("/") or "/",)], "path string"), 1, []
    while n:
        tasks = max(1, min(n, max(4 * spark.sparkContext.defaultParallelism, n // DIRECTORIES)))
        done.append(f"{folder}/depth-{depth:04d}")
        frontier.repartition(tasks, F.xxhash64("path")).mapInArrow(run, ENTRY).write.parquet(done[-1])
        frontier = spark.read.schema(ENTRY).parquet(done[-1]).filter("kind = 'directory'").select("path")
        n, depth = frontier.count(), depth + 1
    return spark.read.schema(ENTRY).parquet(*done)
