import math
import re
import zlib

import pytest

from framewise.llm import toxicity as X
from framewise.llm.toxicity import INSULT3, NEGATION, OTHER, REPORT, TARGET, Matcher, grammar, keep_clean, learn_lexicon, predict


def test_grammar():
    best = grammar().best
    plain = best([OTHER, INSULT3, OTHER])
    assert best([TARGET, OTHER, INSULT3]) > plain > best([NEGATION, INSULT3]) > 0 and plain > best([REPORT, OTHER, INSULT3])
    assert best([OTHER, TARGET]) == 0
    assert best([INSULT3, INSULT3]) > plain


def test_matcher():
    m = Matcher({"scum": 6.0, "lowe*": 6.0})
    assert m.features("a scum.")[0] == m.features("x Loweischaft b")[0] > 0
    assert m.features("scummy") == m.features("flowe") == m.features("") == (0.0, 0.0, 0.0)
    assert m.features("not scum")[0] < m.features("a scum")[0] < m.features("you scum")[0]


def test_copies_teach_nothing(spark):
    rows = [("zork lives here", 1)] * 50 + [(f"w{chr(97 + i)} grum x", 1) for i in range(20)] + [(f"w{chr(97 + i)} fine x", 0) for i in range(20)] * 20
    found = learn_lexicon(spark.createDataFrame(rows, "text string, toxic int"))
    assert "grum" in found and "zork" not in found and "fine" not in found


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    rows = predict(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    toxic = [r.score for r in rows if r.toxic]
    clean = [r.score for r in rows if not r.toxic]
    auc = sum((t > c) + 0.5 * (t == c) for t in toxic for c in clean) / len(toxic) / len(clean)
    assert auc > 0.9 and sum(s >= 0.3 for s in clean) < 0.02 * len(clean)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 3), (2, "", 4), (None, "scum", 5), (4, "x " * 50_000, 6), (4, "a", 7)], "doc_id long, text string, toxic int")
    labels = spark.createDataFrame([(1, 0), (None, 1), (4, None)], "doc_id long, toxic int")
    got = predict(docs, labels).collect()
    assert len(got) == 5 and all(r.predicted == 0 for r in got)
    assert keep_clean(docs, labels).count() == 5
    assert predict(docs.limit(0), labels.limit(0)).collect() == []


@pytest.mark.parametrize("word", ["İstanbul", "ß", "a'b"])
def test_odd_words(word):
    assert Matcher({"scum": 6.0}).features(word) == (0.0, 0.0, 0.0)


def test_long_text_is_scored_in_linear_time(spark):
    import time

    m = Matcher({"scum": 6.0})
    took = []
    for n in (10_000, 100_000):
        began = time.time()
        assert m.features("you are scum and " + "some other words stand here with no insult at all in this clause; plus a scum here. " * n)[0] > 0
        took.append(time.time() - began)
    assert took[1] < 30 and took[1] < 25 * took[0]


def test_an_id_of_many_rows_teaches_once(spark):
    docs = spark.createDataFrame([(1, "b scum"), (1, "a"), (1, None)] + [(3, f"t{k}") for k in range(50)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (3, 0)], "doc_id long, toxic int")
    assert sorted(map(tuple, X.labelled(docs, labels).collect())) == [("", 1), ("t0", 0)]


def brute_clause(words, lexicon):
    """A clause's score word by word: reported speech and negation weaken what follows, a target near an insult adds half."""
    grade = lambda w: 3 if w >= 5 else 2 if w >= 3.5 else 1
    kind = []
    for w in words:
        whole = lexicon.get(w)
        stems = [grade(lexicon[w[:k] + "*"]) for k in X.STEMS if w[:k] + "*" in lexicon]
        if whole is not None:
            kind.append(grade(whole))
        elif stems:
            kind.append(max(stems))
        else:
            kind.append("report" if w in X.REPORTED else "not" if w in X.NEGATIONS else "target" if w in X.TARGETS else "threat" if w in X.THREATS else None)
    if not any(k == "threat" or isinstance(k, int) for k in kind):
        return None
    weaken = lambda k: {3: 2, 2: 1, 1: None, "threat": 1}[k]
    hurts = lambda k: k == "threat" or isinstance(k, int)
    reported = negated = False
    aim, score, first = 0, 0.0, True  # aim: 0 nothing yet, 1 a target stands, 2 an insult stands, 3 they met
    for k in kind:
        if hurts(k) and reported:
            k = weaken(k)
        elif k == "report" and not reported:
            reported, k = True, None
        if hurts(k) and negated:
            negated, k = False, weaken(k)
        elif k == "not" and not negated:
            negated, k = True, None
        if k == "target" and aim in (0, 2):
            score += 0.5 if aim == 2 else 0.0
            aim, k = (3 if aim == 2 else 1), None
        elif isinstance(k, int) and aim in (0, 1):
            score += 0.5 if aim == 1 else 0.0
            aim = 3 if aim == 1 else 2
        elif k == "threat" and aim == 1:
            score, aim = score + 1.0, 3
        if hurts(k):
            score += (1.0 if k == "threat" else float(k)) / (1 if first else 2)
            first = False
    return score


def brute_features(text, lexicon):
    low = (text or "").lower()
    found = [brute_clause(X.TOKEN.findall(c), lexicon) for c in re.split(r"[.!?;:\n]", low)]
    scores = [max(0.0, s) for s in found if s is not None]
    if not scores:
        return 0.0, 0.0, 0.0
    return max(scores), math.log1p(sum(scores)), 10 * sum(scores) / (10 + low.count(" ") + low.count("\n") + 1)


def test_against_brute_force(spark):
    """Lexicon, clauses and scores of every document of the smallest tables in plain Python."""
    d = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    text = {r.doc_id: r.text or "" for r in docs.collect()}
    known = {r.doc_id: int(r.toxic) for r in labels.collect() if r.toxic is not None and r.doc_id in text and zlib.crc32(str(r.doc_id).encode()) % 4 != 2}
    seen = {}
    for i, toxic in known.items():
        words = re.findall(r"[^\W\d_]{2,}", text[i].lower())
        for before, w in zip(["", *words], words):
            seen[w, before] = max(toxic, seen.get((w, before), 0))
    forms, T, C = {}, sum(seen.values()), sum(1 - t for t in seen.values())
    for (w, _), t in seen.items():
        for f in (w, *(w[:k] + "*" for k in X.STEMS if len(w) >= k)):
            a, b = forms.get(f, (0, 0))
            forms[f] = (a + t, b + 1 - t)
    weight = lambda t, c: math.log((t + 0.5) / (T + 1.0)) - math.log((c + 0.5) / (C + 1.0))
    lexicon = {f: weight(t, c) for f, (t, c) in forms.items() if t >= X.LEAST_CONTEXTS and weight(t, c) >= X.LEAST_WEIGHT}
    learned, w = X.learn(docs, labels)
    assert set(learned) == set(lexicon) and all(abs(learned[f] - v) < 1e-9 for f, v in lexicon.items()) and lexicon
    m = X.Matcher(lexicon)
    spiced = [f"{a} {b} {c}" for a in ("you", "not", "said", "never you", "kill") for b in [*sorted(lexicon)[:8], "kill"] for c in ("they", "kill them", "not", sorted(lexicon)[0])]
    for t in [*text.values(), *(s.replace("*", "xx") for s in spiced)]:
        assert m.features(t) == pytest.approx(brute_features(t, lexicon)), t[:80]
    rows = {r.doc_id: r for r in predict(docs, labels).collect()}
    for i, t in text.items():
        x = brute_features(t, lexicon)
        assert rows[i].score == pytest.approx(1 / (1 + math.exp(-(w[0] + sum(a * b for a, b in zip(w[1:], x))))), abs=1e-9)
        assert rows[i].predicted == int(rows[i].score >= 0.3)
