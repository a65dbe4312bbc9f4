"""Exact dedup of a batch against an immutable snapshot.

A document's digest is SHA-256 of its text without white space. Every bucket of the snapshot's digests has a static
binary-fuse filter. The incoming batch is grouped by digest first (its own duplicates never reach the snapshot one by one),
and its distinct digests are screened: negatives can't be in the snapshot and are done; positives join the exact bucket, and
the normalised texts of both sides' representatives are compared byte by byte. Groups are aggregates with map-side
combination, so a text repeated in a third of all rows is one row per task.

Defined results: null text counts as empty; a null doc_id orders after all others; rows that repeat a doc_id with the same
text are the same document and share its decision; texts are compared whole, whatever their length; an empty snapshot or
batch is allowed; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewise.llm.common import n_blocks, stash, tidy, tune
from framewise.llm.fuse_filter import FuseFilter

#: Digests of one bucket, on average: its filter is built by one Python call. As many buckets as shuffle partitions at least.
BUCKET_DIGESTS = 1 << 22

#: The characters of [\x20\x09-\x0D].
WHITE = " \t\n\x0b\x0c\r"


def normalised(text: str = "text") -> Column:
    return F.translate(F.coalesce(F.col(text), F.lit("")), WHITE, "")


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, new, digest (32 bytes) and chars, the code points of the original text."""
    return docs.select("new", F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.sha2(normalised(), 256)).alias("digest"), F.length(F.coalesce("text", F.lit(""))).cast("long").alias("chars"))


def groups(rows: DataFrame) -> DataFrame:
    """One row per digest and side: rows, and the one that stays (most code points, then smallest doc_id, null last)."""
    best = F.min(F.struct((-F.col("chars")).alias("less"), F.col("doc_id").isNull().alias("last"), "doc_id"))
    return rows.groupBy("digest", "new").agg(F.count("*").alias("rows"), best.alias("best"))


def filters(snapshot: DataFrame, buckets: int) -> DataFrame:
    """A filter for each bucket of the snapshot's distinct digests: bucket, seed, segment, span, prints."""

    def one(key, table):
        f = FuseFilter.build(table["h"].to_numpy().view(np.uint64))
        return pa.table({"bucket": pa.array([key[0].as_py()], pa.int64()), "seed": [f.seed], "segment": [f.segment], "span": [f.span], "prints": pa.array([f.prints.tobytes()], pa.binary())})

    return _keyed(snapshot, buckets).select("bucket", "h").groupBy("bucket").applyInArrow(tidy(one), "bucket long, seed long, segment long, span long, prints binary")


def _keyed(rows: DataFrame, buckets: int) -> DataFrame:
    h = F.xxhash64("digest")
    return rows.withColumn("h", h).withColumn("bucket", F.pmod(h, F.lit(buckets)).cast("long"))


def screen(batch: DataFrame, made: DataFrame, buckets: int) -> DataFrame:
    """batch groups with `maybe`: false where the snapshot surely lacks the digest."""

    def one(key, left, right):
        maybe = np.zeros(left.num_rows, bool)
        if right.num_rows:
            r = right.to_pylist()[0]
            maybe = FuseFilter(r["seed"], r["segment"], r["span"], np.frombuffer(r["prints"], np.uint8)).may_hold(left["h"].to_numpy().view(np.uint64))
        return left.select(["digest"]).append_column("maybe", pa.array(maybe))

    keyed = _keyed(batch.select("digest"), buckets)
    return keyed.groupBy("bucket").cogroup(made.groupBy("bucket")).applyInArrow(tidy(one), "digest binary, maybe boolean")


def dedup(snapshot: DataFrame, batch: DataFrame) -> DataFrame:
    """One row for each row of both inputs (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256."""
    side = lambda df, new: df.select("doc_id", "text", F.lit(new).alias("new"))
    return dedup_sides(side(snapshot, False).unionByName(side(batch, True)))


def dedup_sides(docs: DataFrame) -> DataFrame:
    """The same for one table (doc_id, text, new), whose rows with `new` are the incoming batch and the others the snapshot."""
    spark = tune(docs.sparkSession)
    rows = stash(digests(docs), "digests")
    of = stash(groups(rows), "groups")
    buckets = max(n_blocks(spark), -(-of.count() // BUCKET_DIGESTS))
    old_groups, new_groups = of.filter("not new").drop("new"), of.filter("new").drop("new")
    screened = new_groups.join(screen(new_groups, filters(old_groups, buckets), buckets).filter("maybe"), "digest").drop("maybe")
    found = screened.join(old_groups.select("digest", F.col("rows").alias("old_rows"), F.col("best").alias("old_best")), "digest")
    found = stash(found.select("digest", "rows", "best", "old_rows", "old_best"), "positives")
    # The byte check, on the texts of both sides' representatives. Ids that can't be looked up (null) rest on the 256-bit
    # digest. The text is shuffled at every size, so that what moves is in proportion to the input.
    ids = F.array(F.struct(F.col("best.doc_id").alias("doc_id"), F.lit(True).alias("new")), F.struct(F.col("old_best.doc_id").alias("doc_id"), F.lit(False).alias("new")))
    asked = found.filter("best.doc_id is not null and old_best.doc_id is not null").select("digest", F.inline(ids))
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "new", normalised().alias("text"))
    texts = asked.hint("shuffle_hash").join(text, ["doc_id", "new"]).groupBy("digest", "text").agg((F.min("new") < F.max("new")).alias("both"))
    differ = texts.groupBy("digest").agg(F.max("both").alias("same")).filter("not same").select("digest")
    same = found.join(differ, "digest", "left_anti")
    both = F.explode(F.array(F.lit(False), F.lit(True))).alias("new")
    joint = same.select("digest", (F.col("rows") + F.col("old_rows")).alias("rows"), F.least("best", "old_best").alias("best"), both)
    # One row for each digest and side. Written, so that the join below is of two plain tables, whose hot digests adaptive
    # execution splits over tasks.
    alone = of.join(same.select("digest"), "digest", "left_anti").select("digest", "rows", "best", "new")
    decided = stash(alone.unionByName(joint), "decided")
    return rows.join(decided, ["digest", "new"]).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        F.col("rows").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("best.doc_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def dedup_table(docs: DataFrame) -> DataFrame:
    """A whole table, of which a seeded half is the snapshot and the other half the incoming batch."""
    return dedup_sides(docs.select("doc_id", "text", (F.pmod(F.xxhash64(F.lit("snapshot"), F.col("doc_id")), F.lit(2)) == 1).alias("new")))
