import collections
import itertools
import math
import random
import re

import pytest

from framewise.llm import quality
from framewise.llm.quality import BUCKETS, PRIOR, THRESHOLD, best_cut, judge

SCHEMA = "doc_id long, text string, h string, score string"


def brute(text):
    text = text or ""
    ws = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(ws[i : i + 8]) for i in range(len(ws) - 7)]
    seen = {}
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    hit = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit), len(ws) < 20 or 100 * len(hit) > 30 * len(ws)


def test_against_brute_force(spark):
    a = " ".join(f"w{i}" for i in range(30))
    texts = [None, "", " \n\t", "a", "x y", a, a + "\n" + a, a + " q " + a[:60], "a b\na b\n\na b ", "é## *$%&|<> 🙂", "the " * 100, a + "\x0b" + "z " * 9, " ".join(f"u{i % 7000}" for i in range(20000)), "same\n" * 40]
    rows = [(i, t, "c", None) for i, t in enumerate(texts)] + [(None, a, "", ""), (5, a, "", "")]
    labels = spark.createDataFrame([(5, 1), (None, 1), (6, 0), (7, None)], "doc_id long, quality int")
    got = judge(spark.createDataFrame(rows, SCHEMA), labels).collect()
    assert sorted((str(r.doc_id), *r[1:7]) for r in got) == sorted((str(i), *brute(t)) for i, t, _, _ in rows)
    assert all(not (r.kept and r.base_failed) for r in got)
    assert judge(spark.createDataFrame([], SCHEMA), labels).collect() == []


@pytest.mark.parametrize("d", ["/root/testdata/sf0.01"])
def test_labels_are_told_apart(spark, d):
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    rows = judge(docs, labels, scores=True).join(labels, "doc_id").filter("not base_failed").collect()
    good, bad = ([r.kept for r in rows if r.quality == q] for q in (1, 0))
    assert sum(good) > 0.97 * len(good) and sum(bad) < 0.1 * len(bad)


def test_cut():
    assert best_cut([]) == best_cut([(0.5, 1)] * 3) == best_cut([(0.1, 0)]) == THRESHOLD
    assert best_cut([(-0.4, 0), (-0.2, 0), (0.0, 1), (0.2, 1)]) == -0.1
    assert best_cut([(-0.4, 0), (0.0, 1), (0.2, 0), (0.3, 1)]) == -0.2  # one good of two costs more than one bad of two
    assert best_cut([(0.3, 0), (0.3, 0), (0.1, 1)]) < 0.1  # never all


def test_scores_and_verdicts_against_brute_force(spark):
    """The model in plain Python: counters by the same hash, ratios, scores, cut and verdict of every document."""
    rnd = random.Random(2)
    good, bad = [f"good{i}" for i in range(60)], [f"bad{i}" for i in range(60)]
    rows = [(i, " ".join(rnd.choice(bad if i % 4 == 0 and rnd.random() < 0.9 else good) for _ in range(rnd.randint(0, 60)))) for i in range(300)]
    rows += [(300, None), (None, "good1 " * 30), (3, "good1 good2 a"), (301, " ".join(good) * 3)]
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    known = [(i, int(i % 4 > 0)) for i in range(0, 300, 2)]
    got = judge(docs, spark.createDataFrame(known, "doc_id long, quality int"), scores=True).collect()

    every = sorted({w for _, t in rows for w in (t or "").split()})
    hashed = {r.w: r.h for r in spark.createDataFrame([(w,) for w in every], "w string").selectExpr("w", "xxhash64(w) as h").collect()}
    pairs = sorted({(a, b) for _, t in rows for a, b in itertools.pairwise((t or "").split())})
    two = {(r.a, r.b): r.h for r in spark.createDataFrame([(a, b, hashed[a], hashed[b]) for a, b in pairs], "a string, b string, x long, y long").selectExpr("a", "b", "xxhash64(x, y) as h").collect()}
    grams = lambda t: [hashed[w] % BUCKETS for w in (t or "").split()] + [two[p] % BUCKETS for p in itertools.pairwise((t or "").split())]
    raw = collections.Counter(g for _, t in rows for g in grams(t))
    trusted = collections.Counter(g for i, t in rows if dict(known).get(i) == 1 for g in grams(t))
    n, m = sum(raw.values()), sum(trusted.values())
    ratio = {g: round(math.log((trusted[g] / 1 + PRIOR * BUCKETS * raw[g] / n) / (m + PRIOR * BUCKETS) / (raw[g] / n)), 4) for g in raw}
    score = [sum(map(ratio.get, grams(t))) / len(grams(t)) if grams(t) else 0.0 for _, t in rows]
    failed = [brute(t)[5] for _, t in rows]
    taught = [(s, dict(known)[i]) for (i, _), s, f in zip(rows, score, failed) if i in dict(known) and not f]
    places = sorted({s for s, _ in taught})
    worth = lambda c: sum((s < c) * (-5 * q / sum(q for _, q in taught) + (1 - q) / sum(1 - q for _, q in taught)) for s, q in taught)
    cut = max([(round(worth((a + b) / 2), 9), -(a + b) / 2) for a, b in itertools.pairwise(places)])
    want = sorted((str(i), not f and s >= -cut[1]) for (i, _), s, f in zip(rows, score, failed))
    assert sorted((str(r.doc_id), r.kept) for r in got) == want
    assert sorted(round(r.score, 6) for r in got) == sorted(round(s, 6) for s in score)
    assert 20 < sum(k for _, k in want) < 290


@pytest.mark.parametrize("seed", range(6))
def test_the_cut_of_a_table_is_that_of_a_list(spark, monkeypatch, seed):
    rnd = random.Random(seed)
    cases = [[], [(0.5, 1)] * 3, [(0.3, 0), (0.3, 0), (0.1, 1)], [(-0.4, 0), (0.0, 1), (0.2, 0), (0.3, 1)], [(-0.4, 0), (-0.2, 0), (0.0, 1), (0.2, 1)]]
    cases = cases[seed : seed + 1] or cases[:1]
    for digits, gap in ((1, 0.8), (4, 0.3), (9, 0.05)):
        cases.append([(round(rnd.gauss(gap * q, 0.3), digits), q) for q in (int(rnd.random() < 0.8) for _ in range(400))])
    for rows in cases:
        df = spark.createDataFrame(rows, "score double, q int")
        for parts in (2, quality.PARTS):
            monkeypatch.setattr(quality, "PARTS", parts)
            assert quality.fitted_cut(df) == best_cut(rows)
            monkeypatch.undo()


def test_every_labelled_row_teaches(spark):
    """12,800 ids are labelled, and the bad ones among them come last by hash; they differ from the good ones by one word."""
    n = 12_800
    labels = spark.range(n).selectExpr("id as doc_id", "int(row_number() over (order by xxhash64(id), id) <= 12500) as quality")
    text = " ".join(f"g{i}" for i in range(24))
    docs = spark.range(n + 300).join(labels.withColumnRenamed("doc_id", "id"), "id", "left").selectExpr("id as doc_id", f"concat('{text} ', if(quality = 1, 'g24', 'b24')) as text")
    got = judge(docs, labels).groupBy("kept").count().collect()
    assert {r.kept: r["count"] for r in got} == {True: 12_500, False: 600}
    found = quality.counts(docs, labels).agg({"n": "sum", "good": "sum"}).first()
    assert (found["sum(n)"], found["sum(good)"]) == ((n + 300) * 49, 12_500 * 49)
