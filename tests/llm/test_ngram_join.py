import random
import re

import numpy as np

from framewise.llm import ngram_join
from framewise.llm.components import components
from framewise.llm.count_rtree import CountRTree, count_vector, overlap_bound
from framewise.llm.hashing import mix
from framewise.llm.ngram_join import join, keep_one

SCHEMA = "doc_id long, text string, component long, n string"


def brute(rows):
    sets = []
    for _, t in rows:
        ws = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(ws[i : i + 5]) for i in range(len(ws) - 4)} if len(ws) >= 5 else {tuple(ws)} if ws else set())
    up = list(range(len(rows)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                up[top(i)] = top(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[top(i)] = min(r[0], least.get(top(i), r[0]))
    return sorted(((r[0], len(s), (least.get(top(i)) if s else r[0])) for i, (r, s) in enumerate(zip(rows, sets))), key=str)


def corpus(seed, n):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choices("abcdé", k=rnd.randint(1, 4)))
    rows, passage = [], [word() for _ in range(30)]
    for i in range(n):
        kind = rnd.random()
        if kind < 0.5 and rows:
            ws = (rnd.choice(rows)[1] or "").split()
            for _ in range(rnd.randint(0, 4)):
                if ws:
                    at = rnd.randrange(len(ws))
                    ws[at : at + rnd.randint(0, 2)] = [word() for _ in range(rnd.randint(0, 2))]
        else:
            ws = [word() for _ in range(rnd.choice([0, 1, 3, 4, 5, 6, 20, 60, 150]))]
            if kind > 0.9:
                ws += passage
        rows.append((i * 3 % (3 * n + 1), rnd.choice([" ", "\n", "\t "]).join(ws).replace("a", rnd.choice("aA"))))
    return rows


def same(spark, rows):
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], SCHEMA)
    assert sorted(map(tuple, join(df).collect()), key=str) == brute(rows)


def test_against_brute_force(spark):
    same(spark, [*corpus(1, 250), (10_001, None), (10_002, "  \n"), (None, "a b"), (None, None)])


def test_blocks_of_one_shingle(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 4)
    monkeypatch.setattr(ngram_join, "PART_MEMBERS", 20)
    same(spark, corpus(2, 150))


def test_keep_one_and_empty(spark):
    rows = corpus(3, 60)
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], SCHEMA)
    kept = keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r[0] for r in brute(rows) if r[0] == r[2])
    assert join(df.limit(0)).collect() == []


def test_components(spark):
    rnd = random.Random(5)
    edges = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(1, 60)] + [(rnd.randint(200, 300), rnd.randint(200, 300)) for _ in range(70)] + [(5, 5), (None, 3)]
    near = {}
    for a, b in edges:
        if a is not None:
            near.setdefault(a, {a}).add(b), near.setdefault(b, {b}).add(a)
    want = {}
    for v in near:
        seen, todo = {v}, [v]
        while todo:
            new = near[todo.pop()] - seen
            seen |= new
            todo += new
        if len(seen) > 1:
            want[v] = min(seen)
    assert dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect())) == want


def test_rtree_loses_nothing():
    rng = np.random.default_rng(0)
    base = rng.poisson(3, (40, 16))
    v = np.concatenate([base, np.maximum(0, base[rng.integers(0, 40, 400)] + rng.integers(-1, 2, (400, 16)))]).astype(np.int64)
    n = v.sum(1)
    tree = CountRTree(v, n)
    for q in range(len(v)):
        want = np.flatnonzero((9 * np.minimum(v, v[q]).sum(1) >= 4 * (n + n[q])) & (5 * n >= 4 * n[q]) & (4 * n <= 5 * n[q]))
        assert set(tree.near(v[q], n[q])) == set(want)


def test_bound_is_never_below_the_overlap():
    rng = np.random.default_rng(0)
    for size in (1, 5, 200, 300, 1025, 5000):
        x = mix(rng.integers(0, 1 << 62, size).astype(np.uint64))
        y = np.unique(np.concatenate([x[: size * 9 // 10], mix(rng.integers(0, 1 << 62, size // 8 + 1).astype(np.uint64))]))
        x = np.unique(x)
        assert overlap_bound(count_vector(x), count_vector(y)) >= len(np.intersect1d(x, y))
    same = np.zeros(1000, np.uint64) + np.arange(1000, dtype=np.uint64)  # all in one group: its counter is full
    assert overlap_bound(count_vector(same), count_vector(same)) >= 1000
