import hashlib
import math

import numpy as np
import pytest

from framewise.llm.centroids import Grid, cluster, intervals

SCHEMA = "vec_id long, embedding array<double>, label int, cluster string, distance string, n int"


def brute(rows, dims, k, rounds, seed=3):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    hashed = sorted((i is None, "" if i is None else hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), q) for i, q in kept)
    centroids = [q for _, _, q in hashed[:k]]
    away = lambda q, c: sum((x - y) ** 2 for x, y in zip(q, c, strict=True))
    assign = lambda: [min((away(q, c), j) for j, c in enumerate(centroids)) for _, q in kept]
    for _ in range(rounds):
        near = assign()
        for j in range(len(centroids)):
            mine = [q for (_, q), (_, c) in zip(kept, near, strict=True) if c == j]
            if mine:
                centroids[j] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    near, out = assign(), []
    for (i, _), (d, j) in zip(kept, near, strict=True):
        out.append((i, j, d, sum(x for x, c in near if c == j), sum(x for x, _ in near), hashlib.sha256(",".join(map(str, centroids[j])).encode()).hexdigest()))
    return sorted(out, key=str)


def ask(spark, rows, **how):
    df = spark.createDataFrame([(i, v, 1, "x", None, 0) for i, v in rows], SCHEMA)
    return sorted(map(tuple, cluster(df, **how).collect()), key=str)


def sample(n, dims, seed, spread=0.1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, dims))
    return [(k, (centres[k % 5] + spread * rng.normal(size=dims)).tolist()) for k in range(n)]


@pytest.mark.parametrize("spread, bits", [(0.1, 4), (1.0, 8), (1.0, 2)])
def test_against_brute_force(spark, spread, bits):
    rows = sample(260, 8, 4, spread)
    rows += [(1000, None), (1001, []), (1002, [1.0] * 7), (1003, [1.0] * 7 + [None]), (1004, [1.0] * 7 + [float("nan")]), (1005, [float("inf")] * 8)]
    rows += [(None, [0.5] * 8), (7, [0.5] * 8), (7, [0.5] * 8), (3, [-3.0] * 8)] + [(2000 + k, [0.25] * 8) for k in range(90)]
    assert ask(spark, rows, dims=8, k=6, rounds=4, bits=bits) == brute(rows, 8, 6, 4)


def test_fewer_vectors_than_centroids_and_none(spark):
    rows = sample(3, 4, 1)
    assert ask(spark, rows, dims=4) == brute(rows, 4, 8, 10)
    assert ask(spark, [], dims=4) == [] and ask(spark, [(1, [1.0])], dims=4) == []


def test_equal_distances_and_empty_clusters(spark):
    rows = [(k, [float(k % 2), 0.0]) for k in range(40)]
    assert ask(spark, rows, dims=2, k=8, rounds=3) == brute(rows, 2, 8, 3)


def test_large_components_are_refused(spark):
    with pytest.raises(Exception, match="component"):
        ask(spark, [(1, [1e9, 0.0]), (2, [0.0, 0.0])], dims=2)


def test_intervals_hold_the_distances():
    rng = np.random.default_rng(2)
    v = rng.integers(-900, 900, (500, 16))
    grid = Grid(v[:300], 5)
    centre, half = grid.tables(v.min(0), v.max(0))
    d, cells = np.arange(16), grid.cells(v)
    c = rng.integers(-500, 500, (8, 16))
    low, high = intervals(centre[d, cells], half[d, cells], c)
    mean = c.mean(0)
    exact = np.stack([((v - x) ** 2).sum(1) - ((v - mean) ** 2).sum(1) for x in c], axis=1)
    assert (low <= exact).all() and (exact <= high).all()


def test_only_overlapping_or_moved_vectors_are_fetched(spark):
    stats = []
    rows = sample(4000, 16, 9, 0.02)
    df = spark.createDataFrame([(i, v, 1, "x", None, 0) for i, v in rows], SCHEMA)
    assert cluster(df, dims=16, k=5, rounds=6, stats=stats).count() == 4000
    assert stats[0] == 4000 and sum(stats[1:]) < 0.6 * 4000 * len(stats[1:])
