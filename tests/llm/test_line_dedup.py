import hashlib
import random

from framewise.llm.line_dedup import NEAR_CHARS, dedup, digests

SCHEMA = "doc_id long, text string, n_chars long, line string"
WHITE = " \t\n\x0b\x0c\r"


def one_apart(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > 1:
        return False
    k = 0
    while k < len(b) and a[k] == b[k]:
        k += 1
    return a[k + 1 :] == (b[k + 1 :] if len(a) == len(b) else b[k:])


def brute(rows):
    lines = sorted({(i if i is not None else 1 << 62, k, x.strip(WHITE)) for i, t in rows for k, x in enumerate((t or "").split("\n")) if x.strip(WHITE)})
    gone = set()
    for a, (i, k, x) in enumerate(lines):
        for j, m, y in lines[:a]:
            if (j, m) < (i, k) and (x == y or (len(x) >= NEAR_CHARS and one_apart(x, y))):
                gone.add((i, k, x))
    out = []
    for i, t in rows:
        ls = (t or "").split("\n")
        mine = [k for k, x in enumerate(ls) if (i if i is not None else 1 << 62, k, x.strip(WHITE)) in gone]
        kept = "\n".join(x for k, x in enumerate(ls) if k not in mine)
        out.append((i, sum(bool(x.strip(WHITE)) for x in ls), len(mine), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def corpus(seed, n):
    rnd = random.Random(seed)
    pool = ["".join(rnd.choices("abé ", k=rnd.choice([0, 1, 5, 18, 19, 20, 21, 22, 40, 90]))) for _ in range(30)]
    rows = []
    for i in range(n):
        lines = []
        for _ in range(rnd.randint(0, 6)):
            x = list(rnd.choice(pool))
            for _ in range(rnd.choice([0, 0, 1, 1, 2])):
                at = rnd.randint(0, len(x))
                x[at : at + rnd.randint(0, 1)] = rnd.choice(["", "c", "a"])
            lines.append(rnd.choice(["", " ", "\t"]) + "".join(x) + rnd.choice(["", "\r", " "]))
        rows.append((n - i, "\n".join(lines)))
    return rows


def test_against_brute_force(spark):
    rows = [*corpus(1, 120), (9000, None), (9001, ""), (9002, "\n\n"), (None, "same line here, of some length\nx"), (None, None), (9003, "Same line here, of some length")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    assert sorted(map(tuple, digests(df).collect()), key=str) == brute(rows)


def test_template_line(spark):
    rows = [(i, f"Here is item number {i % 10} of the list\nown line {i} " + "y" * i) for i in range(400)] + [(1000, "z" * 70_000)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    assert sorted(map(tuple, digests(df).collect()), key=str) == brute(rows)


def test_dedup_keeps_columns(spark):
    df = spark.createDataFrame([(1, "a b\nc", 5, "p"), (2, "a b", 3, "q"), (3, "a b\nd", 5, None), (4, "", 0, "r"), (5, None, None, "s")], SCHEMA)
    got = dedup(df)
    assert got.columns == df.columns
    assert sorted(map(tuple, got.collect()), key=str) == [(1, "a b\nc", 5, "p"), (3, "d", 1, None), (4, "", 0, "r"), (5, None, None, "s")]
    assert digests(df.limit(0)).collect() == []


def test_clashing_names_and_repeated_ids(spark):
    rows = [(1, "a line of more than twenty characters\nb", 1), (1, "other text under one id\nb", 2), (2, "a line of more than twenty charactersX\nother text under one id\nc", 3), (None, "b", 4), (None, None, 5)]
    names = ["_block", "_n_lines", "_n_removed", "n_lines", "n_removed", "rest", "total", "c0"]
    df = spark.createDataFrame([(i, t, *[k] * len(names)) for i, t, k in rows], "doc_id long, text string, " + ", ".join(f"`{c}` int" for c in names))
    got = dedup(df)
    assert got.columns == df.columns
    assert sorted((r[0], r[1], r[2]) for r in got.collect() if r[0] is not None) == [(1, "a line of more than twenty characters\nb", 1), (1, "other text under one id\nb", 2), (2, "c", 3)]
    assert [(r[1], r[9]) for r in got.collect() if r[0] is None] == [(None, 5)]
