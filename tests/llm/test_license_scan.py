import re

from framewise.llm.license_rules import rules
from framewise.llm.license_scan import PHRASES, scan, scanner, suppress

SCHEMA = "doc_id long, text string, labels string, score string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    ws = WORD.findall(low)
    at = [(i, label) for p, label in PHRASES.items() for i in range(len(ws)) if ws[i : i + len(p.split())] == p.split()]
    places = [i for i, _ in at]
    return len(ws), len(at), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in at}))


TEXTS = [
    None, "", "GNU General\nPublic -- License", "the Apache License, Version 2.0.", "cc by", "CC BY-NC 4.0 cc by", "éMIT License", "MIT licenseé", "mit\x00license mit  license",
    "gnu general public license gnu general public license", "SPDX-License-Identifier: MIT OR Apache-2.0", "Licensed under the MIT License.", "Licensed under CC BY-SA 4.0", "cc", "by", "İ apache license", "x " * 60000 + "mit license",
    "Released under the GNU Lesser General Public License, version 2.1", "https://opensource.org/licenses/BSD-3-Clause",
]


def test_base_columns(spark):
    rows = [(i, t, "a", None) for i, t in enumerate(TEXTS)] + [(None, "cc by", "", ""), (2, TEXTS[2], "", "")]
    got = {(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in scan(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {(r[0], *brute(r[1])) for r in rows}
    assert scan(spark.createDataFrame([], SCHEMA)).collect() == []


def test_labels(spark):
    df = spark.createDataFrame([(i, t, "", "") for i, t in enumerate(TEXTS)], SCHEMA)
    got = {r.doc_id: r for r in scan(df, spans=True).collect()}
    assert got[3].labels == "apache,apache-2.0" and got[5].labels == "cc-by,cc-by-nc" and "mit" in got[10].labels
    assert got[12].labels == "cc-by,cc-by-sa" and got[17].labels == "lgpl-2.1" and got[18].labels == "bsd-3-clause"
    assert all(0 <= r.score <= 1 and (r.score > 0) == (r.labels != "") for r in got.values())


def test_prefilter_loses_nothing():
    s = scanner()
    samples = [t for t in TEXTS if t and len(t) < 1000] + [re.sub(r"\\s\+|\\s\*", " ", re.sub(r"\[sc\]", "s", re.sub(r"\(\?:[^()]*\)\?|\\", "", line.split(" | ")[2]))) for line in __import__("framewise.llm.license_rules", fromlist=["FAMILIES"]).FAMILIES.strip().splitlines()]
    for t in samples:
        low = t.lower()
        every = s.matches(low, range(len(s.rules)))
        assert s.detections(t) == [(a, b, k) for k, a, b in suppress([(k, a, b) for k, _, a, b in every])], t
    assert len(s.rules) > 300


def test_suppression():
    assert suppress([(0, 5, 20), (1, 6, 10), (1, 5, 20), (2, 0, 30), (3, 4, 21), (3, 25, 40)]) == [(0, 5, 20), (2, 0, 30), (3, 25, 40)]


def a_match(parsed, rnd, gap):
    """Some text that a parsed pattern matches, with gap wherever it takes white space."""
    out = ""
    for op, v in parsed:
        op = str(op)
        if op == "LITERAL":
            out += chr(v)
        elif op == "IN":
            kind, x = v[-1]
            out += gap if str(v[0][1]) == "CATEGORY_SPACE" else "1" if "DIGIT" in str(x) else "x" if "NOT_SPACE" in str(x) or "WORD" in str(x) else chr(x if isinstance(x, int) else x[0])
        elif op in ("MAX_REPEAT", "MIN_REPEAT"):
            low, high, inner = v
            spaces = str(inner[0][0]) == "IN" and str(inner[0][1][0][1]) == "CATEGORY_SPACE"
            out += gap if spaces else "".join(a_match(inner, rnd, gap) for _ in range(rnd.randint(low, min(int(high), low + 1))))
        elif op == "SUBPATTERN":
            out += a_match(v[3], rnd, gap)
        elif op == "BRANCH":
            out += a_match(rnd.choice(v[1]), rnd, gap)
    return out


def test_line_breaks_between_all_words():
    """Every rule on texts with line breaks and indents wherever its pattern takes white space, against no prefilter."""
    import random

    s, rnd, met = scanner(), random.Random(5), set()
    for k, r in enumerate(s.rules):
        parsed = re._parser.parse(r.pattern)
        for gap in (" ", "\n", "  \n\t"):
            for _ in range(3):
                t = a_match(parsed, rnd, gap)
                every = s.matches(t.lower(), range(len(s.rules)))
                met |= {m[0] for m in every} & {k}
                assert s.detections(t) == [(a, b, j) for j, a, b in suppress([(j, a, b) for j, _, a, b in every])], (r, t)
    assert met == set(range(len(s.rules)))


def brute_labels(text):
    """Labels and score by every rule's plain pattern in turn, and containment by comparing all intervals."""
    low, taken = (text or "").lower(), []
    for r in rules():
        spans = [m.span("at" if r.kind == "tag" else 0) for m in re.finditer(r.pattern, low)]
        for a, b in sorted(spans, key=lambda s: (s[0] - s[1], s[0])):
            if not any(x <= a and b <= y for x, y, _ in taken):
                taken.append((a, b, r))
    base = set(filter(None, brute(text)[4].split(",")))
    missed = 0.3 if base else 1.0
    for _, weight in {(r.label, r.weight) for _, _, r in taken}:
        missed *= 1 - weight
    return ",".join(sorted(base | {r.label for _, _, r in taken})), round(1 - missed, 9)


def test_labels_and_score_against_brute_force(spark):
    import random

    rnd = random.Random(9)
    parts = [t for t in TEXTS if t and len(t) < 1000] + [a_match(re._parser.parse(r.pattern), rnd, " ") for r in rules()]
    texts = parts + [" and ".join(rnd.choices(parts, k=4)) for _ in range(150)] + [None, ""]
    got = {r.doc_id: (r.labels, round(r.score, 9)) for r in scan(spark.createDataFrame([(i, t, "", "") for i, t in enumerate(texts)], SCHEMA)).collect()}
    assert got == {i: brute_labels(t) for i, t in enumerate(texts)}


def test_long_white_space():
    """Every rule on a match with a run of white space wherever it takes some, cut off before its end: read in one pass."""
    import random
    import time

    s, rnd = scanner(), random.Random(4)
    heads = {a_match(re._parser.parse(r.pattern), rnd, "\0") for r in s.rules}
    began = time.time()
    for t in sorted(heads):
        first, *more = t.split("\0")
        for k in range(len(more)):
            s.detections("\n".join([first, *more[:k]]) + " " * 20_000 + "x")
    assert time.time() - began < 120
    began = time.time()
    for title in ("apache license", "gnu general public license", "mozilla public license", "common development and distribution license", "licensed under the"):
        s.detections(title + " " * 300_000 + "x")
        s.detections((title + " \n\t") * 10_000)
    assert time.time() - began < 60
