"""Toxicity by a weighted finite-state pattern grammar over clauses.

A lexicon of insults is learned from labelled rows: words and word beginnings whose contexts (the word before) are mostly
toxic. Counting contexts and not occurrences keeps copies of one text from teaching its other words. A text's tokens are
mapped to symbols (insults of three strengths, threats, targets, negation, reported speech, others), and each clause with an
insult or threat runs through one machine: the composition of transducers for reported speech, negation, target and insult
or threat, whose weights add up along the best path. The score of a text is a logistic function of its clauses' scores,
fitted on the same rows. Words outside a matched clause count for nothing.

Everything is learned on at most SAMPLE labelled rows (those with the smallest hash), a documented bound; no row with
crc32(doc_id) % 4 = 2 is among them. The lexicon holds all forms of those rows with enough evidence: LEAST_CONTEXTS toxic
contexts and log-odds of LEAST_WEIGHT. Labels, lang, source and doc_id are no inputs of a score.

Defined results: null text counts as empty and scores as a text without a match; repeated rows score alike; without any
toxic label the lexicon is empty and all scores are low; texts are read whole; further columns are ignored.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewise.llm.common import texts_of, tidy_batches, tune

SAMPLE = 12_000
LEAST_CONTEXTS, LEAST_WEIGHT = 5, 2.5
STEMS = (4, 5, 6)
THRESHOLD = 0.3

# Closed-class words in English, French, German and Spanish.
THREATS = "kill hurt destroy burn beat shoot stab strangle tuer frapper détruire brûler töten schlagen zerstören matar golpear destruir quemar".split()
TARGETS = "you your yours yourself he she they them him his her their tu toi vous ton votre ils elles du dich ihr euch sie tú vosotros usted ustedes ellos ellas".split()
NEGATIONS = "not never no none nobody don't isn't aren't wasn't ne pas jamais aucun nicht nie kein keine niemals nunca ningún ninguna tampoco".split()
REPORTED = "said says claimed claims reported reports wrote quoted according alleged dit dite affirme rapporte selon sagte sagt behauptet laut berichtet dijo dice afirmó según escribió".split()

CLAUSE_END = re.compile(r"[.!?;:\n]")
TOKEN = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)*|[.!?;:\n]")
OTHER, INSULT1, INSULT2, INSULT3, THREAT, TARGET, NEGATION, REPORT = range(8)


class Transducer:
    """Weighted transitions {(state, symbol): [(next, output, weight)]}; state 0 starts, all states accept, and a symbol
    without a transition is passed on with weight 0."""

    def __init__(self, moves: dict[tuple[int, int], list[tuple[int, int, float]]]):
        self.moves = moves

    def step(self, state: int, symbol: int) -> list[tuple[int, int, float]]:
        return self.moves.get((state, symbol), [(state, symbol, 0.0)])

    def then(self, other: Transducer) -> Transducer:
        """The composition: other reads what this writes. Its states are pairs, numbered as they are reached."""
        number, todo, moves = {(0, 0): 0}, [(0, 0)], {}
        while todo:
            at = todo.pop()
            for symbol in range(8):
                out = []
                for a, middle, w in self.step(at[0], symbol):
                    for b, last, x in other.step(at[1], middle):
                        if (a, b) not in number:
                            number[(a, b)] = len(number)
                            todo.append((a, b))
                        out.append((number[(a, b)], last, w + x))
                moves[(number[at], symbol)] = out
        return Transducer(moves)

    def best(self, symbols: list[int]) -> float:
        """The weight of the heaviest path."""
        live = {0: 0.0}
        for symbol in symbols:
            after: dict[int, float] = {}
            for state, weight in live.items():
                for to, _, w in self.step(state, symbol):
                    after[to] = max(after.get(to, -math.inf), weight + w)
            live = after
        return max(live.values())


_INSULTS = (INSULT1, INSULT2, INSULT3)


@lru_cache(maxsize=1)
def grammar() -> Transducer:
    """Clauses: reported speech halves what follows, a negation takes most of the next insult, a target near it adds."""
    weaker = {INSULT1: OTHER, INSULT2: INSULT1, INSULT3: INSULT2, THREAT: INSULT1}
    report = Transducer({(0, REPORT): [(1, OTHER, 0.0)], **{(1, s): [(1, weaker[s], 0.0)] for s in (*_INSULTS, THREAT)}})
    negate = Transducer({(0, NEGATION): [(1, OTHER, 0.0)], **{(1, s): [(0, weaker[s], 0.0)] for s in (*_INSULTS, THREAT)}})
    target = Transducer({(0, TARGET): [(1, OTHER, 0.0)], **{(0, s): [(2, s, 0.0)] for s in _INSULTS}, **{(1, s): [(3, s, 0.5)] for s in _INSULTS}, (1, THREAT): [(3, THREAT, 1.0)], (2, TARGET): [(3, OTHER, 0.5)]})
    insult = Transducer({(s, x): [(1, OTHER, w if s == 0 else w / 2)] for s in (0, 1) for x, w in ((INSULT1, 1.0), (INSULT2, 2.0), (INSULT3, 3.0), (THREAT, 1.0))})
    return report.then(negate).then(target).then(insult)


class Matcher:
    """Maps a text to its clauses' symbols: whole words and word beginnings of the lexicon, and the fixed words."""

    def __init__(self, lexicon: dict[str, float]):
        level = lambda w: INSULT3 if w >= 5 else INSULT2 if w >= 3.5 else INSULT1
        self.words = {k: level(w) for k, w in lexicon.items() if not k.endswith("*")}
        self.stems = {k[:-1]: level(w) for k, w in lexicon.items() if k.endswith("*")}
        for words, symbol in ((REPORTED, REPORT), (NEGATIONS, NEGATION), (TARGETS, TARGET), (THREATS, THREAT)):
            for w in words:
                self.words.setdefault(w, symbol)
        whole = [k for k, s in self.words.items() if s in (*_INSULTS, THREAT)]
        import ahocorasick

        self.any = ahocorasick.Automaton()
        for w in {*whole, *self.stems}:
            self.any.add_word(w, len(w))
        self.any.make_automaton()

    def symbol(self, word: str) -> int:
        s = self.words.get(word, OTHER)
        if s in _INSULTS or not self.stems:
            return s
        return max([s if s != OTHER else 0, *(self.stems.get(word[:k], 0) for k in STEMS)], key=lambda x: x if x in _INSULTS else 0) or s

    def places(self, low: str) -> list[int]:
        """Where lexicon words begin; nothing else can match."""
        out = []
        for end, n in self.any.iter(low) if len(self.any) else ():
            begin = end - n + 1
            if begin == 0 or not low[begin - 1].isalpha():
                out.append(begin)
        return out

    def features(self, text: str) -> tuple[float, float, float]:
        """The best clause's score, the log of all clauses' scores, and the scores for each ten words."""
        low = text.lower()
        at = self.places(low)
        if not at:
            return 0.0, 0.0, 0.0
        scores, done = [], -1
        marks = [m.start() for m in CLAUSE_END.finditer(low)]
        for p in at:
            if p < done:
                continue
            k = bisect_left(marks, p)
            begin = marks[k - 1] + 1 if k else 0
            done = marks[k] if k < len(marks) else len(low)
            symbols = [self.symbol(m) for m in TOKEN.findall(low[begin:done])]
            if any(s in (*_INSULTS, THREAT) for s in symbols):
                scores.append(max(0.0, grammar().best(symbols)))
        words = low.count(" ") + low.count("\n") + 1
        return max(scores, default=0.0), math.log1p(sum(scores)), 10 * sum(scores) / (10 + words)


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text and toxic of the bounded sample of ids that may teach; of an id's rows the smallest text does."""
    known = labels.filter("doc_id is not null and toxic is not null").filter(~held_out()).select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("toxic"))
    few = known.groupBy("id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("id"), "id").limit(SAMPLE)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(few), F.col("doc_id") == F.col("id"))
    return rows.groupBy("id", "toxic").agg(F.min("text").alias("text")).select("text", "toxic")  # an id's rows may be any number


def learn_lexicon(sample: DataFrame) -> dict[str, float]:
    """Log-odds of toxic against clean contexts, of words and (with *) word beginnings."""
    words = F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}{2,})"), F.lit(1))
    seen = sample.select(words.alias("w"), "toxic").select("toxic", F.explode(F.expr("transform(w, (x, i) -> struct(x as word, if(i > 0, w[i - 1], '') as before))")).alias("p"))
    contexts = seen.groupBy("p.word", "p.before").agg(F.max("toxic").alias("t")).groupBy("word").agg(F.sum("t").alias("t"), F.sum(1 - F.col("t")).alias("c"))
    forms = F.array(F.col("word"), *(F.when(F.length("word") >= k, F.concat(F.substring("word", 1, k), F.lit("*"))) for k in STEMS))
    counts = contexts.select(F.explode(F.array_compact(forms)).alias("form"), "t", "c", F.lit(1).alias("n")).groupBy("form").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    total = contexts.agg(F.sum("t").alias("T"), F.sum("c").alias("C")).first()
    if not total.T:
        return {}
    weight = F.log((F.col("t") + 0.5) / F.lit(total.T + 1.0)) - F.log((F.col("c") + 0.5) / F.lit(total.C + 1.0))
    rows = counts.withColumn("w", weight).filter(f"t >= {LEAST_CONTEXTS} and w >= {LEAST_WEIGHT}").collect()
    return {r.form: r.w for r in sorted(rows)}


def fit(features: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton's method with a small ridge."""
    x = np.column_stack([np.ones(len(features)), features])
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        ridge = 1e-2 * np.eye(len(w))
        w += np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge, x.T @ (toxic - p) - ridge @ w)
    return w


def _features(df: DataFrame, matcher, carry: str, schema: str) -> DataFrame:
    def run(batches):
        m = Matcher(matcher.value)
        for b in batches:
            found = [m.features(t) for t in texts_of(b["text"]).to_pylist()]
            columns = [pa.array(x, pa.float64()) for x in zip(*found, strict=True)] if found else [pa.array([], pa.float64())] * 3
            yield pa.record_batch([b[carry], *columns], names=[carry, "best", "all", "dense"])

    return df.mapInArrow(tidy_batches(run), f"{schema}, best double, all double, dense double")


def learn(docs: DataFrame, labels: DataFrame) -> tuple[dict[str, float], list[float]]:
    """(lexicon, weights): both bounded, learned on the sample."""
    tune(docs.sparkSession)
    sample = labelled(docs, labels)
    lexicon = learn_lexicon(sample)
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    rows = _features(sample.select("text", "toxic"), shared, "toxic", "toxic int").collect()  # SAMPLE rows of four numbers
    if not rows:
        return lexicon, [-5.0, 0.0, 0.0, 0.0]
    data = np.array(sorted(map(tuple, rows)), float)
    return lexicon, fit(data[:, 1:], data[:, 0]).tolist()


def scored(docs: DataFrame, model: tuple[dict[str, float], list[float]]) -> DataFrame:
    """documents -> doc_id, score."""
    lexicon, w = model
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    rows = _features(docs.select("text", F.col("doc_id").cast("long").alias("doc_id")), shared, "doc_id", "doc_id long")
    z = F.lit(w[0]) + F.col("best") * w[1] + F.col("all") * w[2] + F.col("dense") * w[3]
    return rows.select("doc_id", (1 / (1 + F.exp(-z))).alias("score"))


def predict(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """documents -> doc_id, held_out, score, predicted."""
    rows = scored(docs, learn(docs, labels))
    return rows.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """documents without those predicted toxic; all columns are kept, and the score is computed row by row."""
    lexicon, w = learn(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    at = docs.columns.index("text")

    def run(batches):
        m = Matcher(shared.value)
        for b in batches:
            x = np.array([m.features(t) for t in texts_of(b.column(at)).to_pylist()]).reshape(-1, 3)
            yield b.filter(pa.array(1 / (1 + np.exp(-np.clip(w[0] + x @ np.array(w[1:]), -500, 500))) < THRESHOLD))

    return docs.mapInArrow(tidy_batches(run), docs.schema)
