import hashlib
import re

from framewise.llm.substring_dedup import remove_repeats

SCHEMA = "doc_id long, text string, window int, rank string"


def brute(rows, k):
    docs = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    seen, out = {}, []
    cut = [re.findall(r"[^\x20\x09-\x0D]+", r[1] or "") for r in docs]
    for ws in cut:
        gone = [False] * len(ws)
        for i in range(len(ws) - k + 1):
            key = tuple(ws[i : i + k])
            if key in seen:
                gone[i : i + k] = [True] * k
            seen[key] = 1
        kept = " ".join(w for w, g in zip(ws, gone) if not g)
        out.append((len(ws), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted((r[0] if r[0] is not None else -1, *o) for r, o in zip(docs, out))


def check(spark, rows, k):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    got = sorted((r[0] if r[0] is not None else -1, *r[1:]) for r in remove_repeats(df, k).collect())
    assert got == brute(rows, k)


def test_against_brute_force(spark):
    a = " ".join(f"w{i}" for i in range(40))
    rows = [(5, a), (3, "é x\ty " + a[:60] + " q"), (1, None), (2, ""), (None, a), (None, None), (9, "the " * 50), (7, a), (7, a), (8, "ab c d\r\ne")]
    check(spark, rows, 5)
    check(spark, rows, 20)


def test_hot_passage_and_long_text(spark):
    passage = " ".join(f"p{i}" for i in range(12))
    rows = [(i, f"own{i} {passage} tail{i}") for i in range(600)] + [(1000, " ".join(f"u{i % 9000}" for i in range(20000)))]
    check(spark, rows, 6)


def test_empty(spark):
    assert remove_repeats(spark.createDataFrame([], SCHEMA)).collect() == []
