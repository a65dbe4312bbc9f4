"""Exact percentiles by refinement against a plain sort, with small limits so that every way is taken."""

import math
import random

import pytest
from pyspark.sql import functions as F

from framewise.operators import quantiles as Q

WANTS = {"low": ("a", 0.0), "q1": ("a", 0.25), "median": ("a", 0.5), "p95": ("a", 0.95), "top": ("a", 1.0), "b_median": ("b", 0.5)}


def rows():
    r = random.Random(4)
    out = [(1, r.gauss(0, 1), 5.0) for _ in range(700)]  # both signs; b is one value
    out += [(2, 1000 + r.random() / 4096, float(k)) for k in range(600)]  # all in one first bin
    out += [(3, r.choice([0.0, -0.0, 1.5, 1.5, 2.0, 5e-324, -1e308, 1e308]), r.choice([None, 7.0])) for _ in range(400)]
    out += [(4, 2.0 ** r.randint(-1070, 1020) * r.choice([1, -1]), 1.0) for _ in range(300)]
    out += [(None, float(k % 7), float(-k)) for k in range(200)] + [(5, None, 1.0), (5, float("nan"), 3.0), (6, 1.0, 2.0), (6, 4.0, None), (7, float("inf"), float("-inf")), (7, 3.0, 0.0)]
    return out


def brute(key, c, q):
    v = sorted(x + 0.0 for x in (r[1 if c == "a" else 2] for r in rows() if r[0] == key) if x is not None and not math.isnan(x))
    if not v:
        return None
    at = q * (len(v) - 1)
    lo, hi = v[math.floor(at)], v[math.ceil(at)]
    return lo if lo == hi else (math.ceil(at) - at) * lo + (at - math.floor(at)) * hi


@pytest.mark.parametrize("most, steps", [(1 << 20, 1 << 16), (40, 16), (3, 4)])
def test_against_a_sort(spark, monkeypatch, most, steps):
    monkeypatch.setattr(Q, "MOST_ROWS", most)
    monkeypatch.setattr(Q, "STEPS", steps)
    df = spark.createDataFrame(rows(), "k int, a double, b double").repartition(5)
    got = {r.k: r for r in Q.aggregate(df, ["k"], [F.count("*").alias("n")], WANTS).collect()}
    assert sorted(got, key=str) == sorted({r[0] for r in rows()}, key=str)
    for k, r in got.items():
        assert r.n == sum(x[0] == k for x in rows())
        for name, (c, q) in WANTS.items():
            assert r[name] == pytest.approx(brute(k, c, q), rel=1e-15) if brute(k, c, q) is not None else r[name] is None, (k, name)


def test_one_group_is_spread_over_all_tasks(spark, monkeypatch):
    """A single group of two million values: equal to percentile(), and no stage's task holds the group."""
    monkeypatch.setattr(Q, "MOST_ROWS", 20_000)
    df = spark.range(0, 2_000_000, numPartitions=8).select(F.lit("x").alias("g"), (F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 7).alias("v"))
    got = Q.aggregate(df, ["g"], [], {"median": ("v", 0.5), "p95": ("v", 0.95)})
    want = df.groupBy("g").agg(F.percentile("v", F.lit(0.5)).alias("median"), F.percentile("v", F.lit(0.95)).alias("p95")).first()
    assert got.first() == want
    assert "percentile(" not in got._jdf.queryExecution().executedPlan().toString()


def test_empty_and_no_keys(spark):
    df = spark.createDataFrame([], "k int, v double")
    assert Q.aggregate(df, ["k"], [F.count("*").alias("n")], {"m": ("v", 0.5)}).collect() == []
    assert Q.exact_percentiles(df, ["k"], {"m": ("v", 0.5)}).collect() == []
