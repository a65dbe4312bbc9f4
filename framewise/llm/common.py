"""Session settings, shared work folder and small Arrow helpers of the operators."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of one Arrow batch: a task holds this many whole texts at once.
ARROW_ROWS = 512

_own_folder: str | None = None


def tune(spark: SparkSession) -> SparkSession:
    """Small Arrow batches, so that a Python worker's memory follows the batch and not the partition."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


@lru_cache(maxsize=1)
def _trim() -> Callable[[int], int]:
    return getattr(ctypes.CDLL(None), "malloc_trim", lambda pad: 0)


def give_back() -> None:
    """Return what the allocators of this Python worker hold without use; workers live on between tasks and stages."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


def tidy(work: Callable) -> Callable:
    """A function for applyInArrow that gives unused memory back after each group; it takes as many arguments as work,
    from which Spark tells whether to pass the key."""

    def one(*tables):
        try:
            return work(*tables)
        finally:
            give_back()

    return (lambda a: one(a), lambda a, b: one(a, b), lambda a, b, c: one(a, b, c))[work.__code__.co_argcount - 1]


def tidy_batches(work: Callable) -> Callable:
    """A function for mapInArrow that gives unused memory back at the end of its task."""

    def run(batches):
        try:
            yield from work(batches)
        finally:
            give_back()

    return run


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or one of our own where it is unset and the
    master is local (tests). On a cluster without that setting there is none that is known to be shared: an error."""
    global _own_folder
    conf = spark.sparkContext.getConf()
    if path := conf.get("spark.checkpoint.dir", None):
        return path.rstrip("/")
    if not conf.get("spark.master", "local").startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    _own_folder = _own_folder or tempfile.mkdtemp(prefix="spark-framewise-")
    return f"file://{_own_folder}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stash(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write df as Parquet in the shared folder and read it again."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, *work: str | DataFrame) -> None:
    """Delete work folders, or those that hold the files of stashed tables."""
    for item in work:
        paths = [item] if isinstance(item, str) else sorted({f.rpartition("/")[0] for f in item.inputFiles()})
        for path in paths:
            path = spark._jvm.org.apache.hadoop.fs.Path(path)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Names for work columns: those given, with underscores in front until df has no such column."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = f"_{n}"
        taken.add(n.lower())
        out.append(n)
    return out


#: Most text of one block of documents, on average: a block is one table in a Python worker.
BLOCK_BYTES = 128 << 20


def n_blocks(spark: SparkSession) -> int:
    """As many as shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def blocks_for(spark: SparkSession, size: int | None) -> int:
    """Blocks of documents for `size` bytes of text: as many as shuffle partitions, and more where blocks would hold more than
    BLOCK_BYTES."""
    return max(n_blocks(spark), -(-(size or 0) // BLOCK_BYTES))


def text_bytes(docs: DataFrame) -> int | None:
    """Bytes of all texts, by a scan of that one column."""
    return docs.agg(F.sum(F.octet_length("text"))).first()[0]


def texts_of(column) -> pa.LargeStringArray:
    """A null-free large_string array; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    return pc.fill_null(column.cast(pa.large_string()), "")


def slices(texts: pa.LargeStringArray, most_bytes: int = 1 << 20):
    """(first, last) row ranges of at most most_bytes of text each; a longer text makes a range of its own."""
    n = len(texts)
    if not n:
        return
    sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    a = 0
    while a < n:
        before = sizes[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(sizes, before + most_bytes, "right")))
        yield a, min(b, n)
        a = b
