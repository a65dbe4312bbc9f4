import hashlib

import zstandard

from framewise.llm.common import new_path, stash
from framewise.llm.warc import FRAME_BYTES, BundleReader, archive, fetch, plan, write

SCHEMA = "page_id long, url string, html string, digest string, bundle string"


def brute(rows):
    first = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= 100:
            first[h] = min(i, first.get(h, i))
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        ref = first.get(h) if len(data) >= 100 else None
        ref = None if ref == i else ref
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "response" if ref is None else "revisit", ref))
    return sorted(out, key=str)


def rows():
    big = "é<p>\r\n\r\n" * 40
    out = [(i, f"http://h/{i}\nx", [big, "short", None, "", f"page {i} " * 200][i % 5]) for i in range(300)]
    return out + [(None, None, big), (None, "u", "lone" * 50), (2, "a", "z" * (3 * FRAME_BYTES)), (5, "again", big)]


def test_against_brute_force(spark):
    df = spark.createDataFrame([(*r, "x", None) for r in rows()], SCHEMA)
    assert sorted(map(tuple, archive(df).collect()), key=str) == brute(rows())
    assert archive(df.limit(0)).collect() == []


def test_index_and_plain_reader(spark):
    df = spark.createDataFrame([(*r, "x", None) for r in rows()], SCHEMA)
    index = stash(write(plan(df.repartition(3)), new_path(spark, "warc")), "index")
    got = fetch(index.filter("record_id in ('<urn:x-page:4>', '<urn:x-page:9>')")).collect()
    assert sorted(bytes(r.payload) for r in got) == sorted((f"page {i} " * 200).encode() for i in (4, 9))
    uri = index.first().bundle
    reader = BundleReader(uri)
    whole = b"".join(reader.frame(k) for k in range(len(reader.frames)))
    # Any Zstandard decoder reads a bundle: the seek table is a frame that decoders skip.
    with open(uri.removeprefix("file://"), "rb") as f:
        assert zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read() == whole


def test_read_back_is_spread(spark):
    """Bundles of many frames are read by several tasks, one piece of READ_FRAMES frames each."""
    from pyspark.sql import functions as F

    from framewise.llm.warc import READ_FRAMES, read

    n = 2 * READ_FRAMES + 3
    df = spark.createDataFrame([(i, "u", f"{i:03d}" * (FRAME_BYTES // 3 + 1), "x", None) for i in range(n)], SCHEMA)
    index = stash(write(plan(df).coalesce(1), new_path(spark, "warc")), "index")
    assert index.select("bundle").distinct().count() == 1 and index.select("frame").distinct().count() == n
    back = read(index)
    assert back.groupBy(F.spark_partition_id()).count().count() >= 3
    assert sorted(r.page_id for r in back.collect()) == list(range(n))
