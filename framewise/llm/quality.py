"""Quality rules and a hashed n-gram log-likelihood ratio, in DataFrame functions only.

Words and word pairs are hashed into BUCKETS counters. Two smoothed multinomials over the counters, one of trusted rows and
one of the whole corpus, give each counter a log ratio; a document's score is the mean over its n-grams. Documents that fail
the base rules or score below a cut are not kept. The corpus counts cover all documents, the trusted ones all rows labelled good,
and the cut is fitted on all labelled rows that pass the base rules.

Everything about one document is computed inside its row. Texts are shuffled once, to meet their labels.
Measures and scores are written once as a work table; the cut is fitted on its labelled rows. The log ratios are one constant
array of BUCKETS numbers.

Defined results: null text has no words and fails the base rules; a null doc_id is passed on; repeated rows are judged each;
without trusted rows every ratio is 0; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framewise.llm.common import stash

BUCKETS = 1 << 14
PRIOR = 50.0
#: The cut where labels don't tell one, and how many shares of bad rows one share of good rows is worth.
THRESHOLD = -0.05
GOOD_COST = 5.0
#: Ranges of scores, to a unit of score, whose totals are looked at before single scores; it bounds memory and changes no result.
PARTS = 4096
WINDOW = 8
LEAST_WORDS, MOST_REPEATED = 20, 30

# The characters of [\x20\x09-\x0D] and of [#*$%&|<>].
WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))


def settled(rows: DataFrame, **columns: Column) -> DataFrame:
    """rows with columns that are computed once: a generator of one row keeps the optimizer from putting their expressions
    into the lambdas that read them, where they would be computed again for every element."""
    return rows.select("*", F.inline(F.array(F.struct(*(c.alias(k) for k, c in columns.items())))))


def with_hashes(docs: DataFrame, *keep: str) -> DataFrame:
    """docs with text (null: empty) and h, the hashes of its words."""
    rows = docs.select(*keep, F.coalesce("text", F.lit("")).alias("text"))
    return settled(rows, h=F.transform(words(F.col("text")), lambda w: F.xxhash64(w)))


def grams(h: Column) -> Column:
    """Counters of the words and of the pairs of neighbours."""
    one = F.transform(h, lambda x: F.pmod(x, F.lit(BUCKETS)))
    two = F.transform(h, lambda x, i: F.pmod(F.xxhash64(x, F.get(h, i + 1)), F.lit(BUCKETS)))
    return F.concat(one, F.when(F.size(h) > 1, F.slice(two, F.lit(1), F.size(h) - 1)).otherwise(F.array().cast("array<bigint>")))


def known(labels: DataFrame) -> DataFrame:
    """One row an id: whether a row labels it good, and q, its least label."""
    rows = labels.filter("quality in (0, 1) and doc_id is not null").groupBy(F.col("doc_id").alias("id"))
    return rows.agg(F.max(F.col("quality") == 1).alias("good"), F.min("quality").cast("int").alias("q"))


def counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Of each counter n, its n-grams in all rows, and good, those in rows labelled good."""
    taught = stash(known(labels), "quality-labels").filter("good").select("id", "good")
    # By sort and merge at every size: labels grow with the documents, so that a broadcast would end at some size. The labels' side is
    # a plain table, which lets Spark split the documents of one id, or without one, over tasks.
    rows = docs.select("doc_id", "text").join(taught.hint("merge"), F.col("doc_id") == F.col("id"), "left")
    return with_hashes(rows, "good").select("good", F.explode(grams(F.col("h"))).alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"), F.count("good").alias("good"))


def log_ratios(docs: DataFrame, labels: DataFrame) -> list[float]:
    """log(trusted / corpus) of each counter, rounded; BUCKETS numbers whatever the input."""
    found = counts(docs, labels).collect()
    raw, good = {r.bucket: r.n for r in found}, {r.bucket: r.good for r in found}
    n_raw, n_good = sum(raw.values()), sum(good.values())
    if not n_good:
        return [0.0] * BUCKETS
    # Smoothing draws the trusted side to the corpus, so that counters without evidence are neutral.
    ratio = lambda k: math.log((good[k] + PRIOR * raw[k] * BUCKETS / n_raw) / (n_good + PRIOR * BUCKETS) * n_raw / raw[k]) if k in raw else 0.0
    return [round(ratio(k), 4) for k in range(BUCKETS)]


def repeated_words(rows: DataFrame) -> DataFrame:
    """rows(h, ...) with n_repeat_words: words in windows found twice or more in the row."""
    n = F.size("h")
    windows = F.when(n >= WINDOW, F.transform(F.sequence(F.lit(1), F.greatest(n - WINDOW + 1, F.lit(1))), lambda i: F.xxhash64(F.slice("h", i, WINDOW)))).otherwise(F.array().cast("array<bigint>"))
    rows = settled(rows, w=windows)
    # Only rows with a repeated window go on to the places of its occurrences.
    some = F.size(F.array_distinct("w")) < F.size("w")
    none = F.array().cast("array<struct<w:bigint,i:int>>")
    rows = settled(rows, s=F.when(some, F.sort_array(F.transform("w", lambda w, i: F.struct(w.alias("w"), i.alias("i"))))).otherwise(none))
    same = lambda k, x: F.get(F.col("s"), k)["w"] == x["w"]
    twice = F.filter("s", lambda x, k: F.coalesce(same(k - 1, x), F.lit(False)) | F.coalesce(same(k + 1, x), F.lit(False)))
    places = F.sort_array(F.transform(twice, lambda x: x["i"]))
    start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n"))
    covered = F.aggregate(places, start, lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n")), lambda a: a["n"])
    return rows.withColumn("n_repeat_words", covered).drop("w", "s")


def measured(docs: DataFrame, ratios: list[float], *keep: str) -> DataFrame:
    """docs -> the columns to keep, the base measures, base_failed and score."""
    ratio = F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")
    rows = repeated_words(with_hashes(docs, *keep))
    without = lambda chars: F.length(F.translate("text", chars, ""))
    lines = F.filter(F.split("text", "\n", -1), lambda x: F.length(F.translate(x, WHITE, "")) > 0)
    g = grams(F.col("h"))
    rows = rows.select(
        *keep,
        F.size("h").cast("long").alias("n_words"),
        without(WHITE).cast("long").alias("word_chars"),
        (F.length("text") - without(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        F.aggregate(g, F.lit(0.0), lambda a, k: a + F.get(ratio, k.cast("int"))).alias("sum"),
    )
    score = F.when(F.col("n_words") > 0, F.col("sum") / (2 * F.col("n_words") - 1)).otherwise(0.0)
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return rows.withColumn("score", score).withColumn("base_failed", failed).drop("sum")


def best_cut(scores: list[tuple[float, int]]) -> float:
    """The score under which documents are rejected: of all places halfway between neighbouring scores, the one that takes the
    largest share of bad rows (0) less GOOD_COST times the share of good ones (1); of equal places the lowest. With one kind
    of rows only, THRESHOLD. This is the rule on a list; fitted_cut follows it on a table."""
    n_good = sum(q for _, q in scores)
    n_bad = len(scores) - n_good
    if not n_good or not n_bad:
        return THRESHOLD
    rows = sorted(scores)
    best, cut, gain = 0.0, rows[0][0] - 1.0, 0.0
    for (s, q), (after, _) in zip(rows, [*rows[1:], (rows[-1][0] + 1.0, 0)], strict=True):
        gain += -GOOD_COST / n_good if q else 1 / n_bad
        if after > s and gain > best + 1e-12:
            best, cut = gain, (s + after) / 2
    return cut


def fitted_cut(taught: DataFrame) -> float:
    """best_cut of taught(score, q), a table of any size. The totals of narrow ranges of scores tell which ranges can hold the
    best place; in those, places are compared one by one. Gains are whole numbers here, in units of 1 / (n_good * n_bad)."""
    places = taught.groupBy("score").agg(F.count_if(F.col("q") == 0).alias("bad"), F.count_if(F.col("q") == 1).alias("good")).withColumn("part", F.floor(F.col("score") * PARTS))
    parts = places.groupBy("part").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"), F.min("score").alias("first")).orderBy("part").collect()
    n_bad, n_good = sum(p.bad for p in parts), sum(p.good for p in parts)
    if not n_good or not n_bad:
        return THRESHOLD
    price = Decimal(GOOD_COST) * n_bad
    gain = lambda bad, good: bad * n_good - good * price
    least, bad, good, ranges = Decimal(0), 0, 0, []
    for p, after in zip(parts, [*(p.first for p in parts[1:]), None], strict=True):
        ranges.append((gain(bad + p.bad, good), (p.part, bad, good, after)))
        bad, good = bad + p.bad, good + p.good
        least = max(least, gain(bad, good))
    spark, inside, whole = taught.sparkSession, Window.partitionBy("part").orderBy("score"), "decimal(18,0)"
    some = spark.createDataFrame([r for most, r in ranges if most >= least], "part long, bad_before long, good_before long, next double")
    rows = places.join(F.broadcast(some), "part").select(
        "score",
        F.coalesce(F.lead("score").over(inside), "next", F.col("score") + 1.0).alias("after"),
        ((F.col("bad_before") + F.sum("bad").over(inside)).cast(whole) * F.lit(Decimal(n_good)) - (F.col("good_before") + F.sum("good").over(inside)).cast(whole) * F.lit(price)).alias("gain"),
    )
    best = rows.filter("gain > 0").orderBy(F.desc("gain"), "score").first()
    return (best.score + best.after) / 2 if best else parts[0].first - 1.0


def judge(docs: DataFrame, labels: DataFrame, scores: bool = False) -> DataFrame:
    """documents -> doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept and, if asked
    for, score."""
    rows = stash(measured(docs.select("doc_id", "text"), log_ratios(docs, labels), "doc_id"), "quality")
    cut = fitted_cut(rows.filter("not base_failed").join(known(labels), F.col("doc_id") == F.col("id")).select("score", "q"))
    out = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= cut)).select(*out, *["score"] * scores)
