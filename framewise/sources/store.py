"""Where queries put files that they write and read again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: str | None = None


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder under spark.checkpoint.dir, which executors share; a temporary one where it is unset and Spark is
    local."""
    global _own
    conf = spark.sparkContext.getConf()
    base = conf.get("spark.checkpoint.dir", None)
    if not base and not conf.get("spark.master", "local").startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not base:
        _own = _own or tempfile.mkdtemp(prefix="spark-framewise-")
        base = f"file://{_own}"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stash(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write df as Parquet in a new folder and read it again."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
