import hashlib
import re

import numpy as np

from framewise.llm import exact_dedup
from framewise.llm.exact_dedup import dedup_table
from framewise.llm.fuse_filter import FuseFilter
from framewise.llm.hashing import mix

SCHEMA = "doc_id long, text string, digest string, rows string"


def test_filter_holds_all_keys():
    for n in (0, 1, 2, 3, 10, 100, 1000, 50_000):
        keys = mix(np.arange(n, dtype=np.uint64))
        f = FuseFilter.build(keys)
        assert f.may_hold(keys).all()
        other = mix(np.arange(10_000_000, 10_020_000, dtype=np.uint64))
        assert f.may_hold(other).mean() < 0.01
        assert n < 50_000 or len(f.prints) < 1.3 * n  # small filters need more slots


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i is None, i))
    out = []
    for i, t in rows:
        norm = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        keep = min(groups[norm], key=lambda g: (g[0], g[1], g[2] or 0))[2]
        out.append((i, keep, len(groups[norm]), i == keep, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=str)


def test_against_brute_force(spark):
    rows = [(i, ["a b", "ab", " a\tb\n", "é", None, "", " ", "x" * 50_000, f"own {i}"][i % 9]) for i in range(200)]
    rows += [(None, "ab"), (None, "lone"), (3, "ab"), (7, rows[7][1]), (500, "a b")]
    df = spark.createDataFrame([(*r, "x", None) for r in rows], SCHEMA)
    assert sorted(map(tuple, dedup_table(df).collect()), key=str) == brute(rows)
    assert dedup_table(df.limit(0)).collect() == []


def test_more_buckets_than_partitions(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "BUCKET_DIGESTS", 10)
    rows = [(i, f"text {i % 70}" if i % 3 else "the same") for i in range(250)]
    assert sorted(map(tuple, dedup_table(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str) == brute(rows)


def test_hot_copies(spark):
    df = spark.range(3000).selectExpr("id as doc_id", "if(id % 3 = 0, 'same text', concat('t', id)) as text", "null as digest", "null as rows")
    got = dedup_table(df).collect()
    assert sum(r.kept for r in got) == 2001 and max(r.group_size for r in got) == 1000
