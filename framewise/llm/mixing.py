"""Mixing sources to target weights by min-cost flow over membership patterns.

A document belongs to one source or to several. Documents are aggregated by membership pattern; a small network routes each
pattern's token capacity to the quotas of its sources, where a second and third repetition of a pattern cost more and more
(convex), so that repetition is spread as thin as the quotas allow. The flow gives each pattern a number of words to take:
whole repetitions of all its documents, and a rest that documents fill in the order of a seeded hash: one larger than what
is left is left aside, and those behind it go on filling until nothing fits. If words are missing then, a second try takes
documents larger than the gap first. Of the documents left aside the smallest is taken too if it brings the sum nearer.

The network has one node for each pattern and source, never for documents; its size is checked against MOST_PATTERNS. The
document side is aggregates and a broadcast of one row per pattern: no document is shuffled for its decision.

Above MOST_PATTERNS the plan raises instead of routing: the flow is solved on the driver, in memory that grows with patterns
and not with documents. Patterns are distinct sets of sources, so this takes more than 100,000 of them.

Defined results: null text has size 0; the null source is a source of its own, ordered last; documents of size 0 take 0
words; a null doc_id is drawn like any other; texts are counted whole, whatever their length; an empty table gives an empty
result; repeated rows are selected alike; further columns are ignored or passed on, whatever their names.
"""

from __future__ import annotations

import heapq
from collections import deque
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewise.llm.common import free_names, stash

WEIGHTS = (1, 2, 3)
MOST_REPEATS = 3
MOST_PATTERNS = 100_000
#: Costs of a pattern's first, second and third repetition.
COSTS = (0, 1, 3)
SEED = 7
BINS = 1 << 12
HASH_BITS = 62
LAST = 1 << HASH_BITS
ROUND = "struct<lo:long,hi:long,least:long,most:long>"


def size_of(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: dict[str | None, int], weights=WEIGHTS, most: int = MOST_REPEATS) -> dict[str | None, float]:
    """Sources by code point, null last, share all words by their weights; no target is above `most` times its source's
    size, and what is over is shared again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode("utf-32-be")) + [None] * (None in sizes)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    left, open_, out = float(sum(sizes.values())), list(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > most * sizes[s]]
        if not over:
            return out | {s: left * weight[s] / total for s in open_}
        for s in over:
            out[s] = float(most * sizes[s])
        left -= sum(out[s] for s in over)
        open_ = [s for s in open_ if s not in out]
    return out


class Flow:
    """Min-cost flow by successive shortest paths with potentials."""

    def __init__(self):
        self.to, self.cap, self.cost, self.out = [], [], [], []

    def node(self) -> int:
        self.out.append([])
        return len(self.out) - 1

    def arc(self, a: int, b: int, cap: int, cost: int) -> int:
        for x, y, c, w in ((a, b, cap, cost), (b, a, 0, -cost)):
            self.out[x].append(len(self.to))
            self.to.append(y)
            self.cap.append(c)
            self.cost.append(w)
        return len(self.to) - 2

    def run(self, source: int, sink: int) -> None:
        n = len(self.out)
        height = [0] * n
        while True:
            dist = [1 << 60] * n
            dist[source], todo = 0, [(0, source)]
            while todo:
                d, v = heapq.heappop(todo)
                if d > dist[v]:
                    continue
                for e in self.out[v]:
                    w = self.to[e]
                    if self.cap[e] and (x := d + self.cost[e] + height[v] - height[w]) < dist[w]:
                        dist[w] = x
                        heapq.heappush(todo, (x, w))
            if dist[sink] == 1 << 60:
                return
            height = [h + min(d, dist[sink]) for h, d in zip(height, dist, strict=True)]
            self._block(source, sink, height)

    def _block(self, source: int, sink: int, height: list[int]) -> None:
        """All flow along arcs of reduced cost 0, level by level (a maximum flow of that subnetwork)."""
        tight = lambda v, e: self.cap[e] and self.cost[e] + height[v] - height[self.to[e]] == 0
        while True:
            level = {source: 0}
            todo = deque([source])
            while todo:
                v = todo.popleft()
                for e in self.out[v]:
                    if self.to[e] not in level and tight(v, e):
                        level[self.to[e]] = level[v] + 1
                        todo.append(self.to[e])
            if sink not in level:
                return
            at, path = [0] * len(self.out), []
            v = source
            while True:
                if v == sink:
                    push = min(self.cap[e] for e in path)
                    for e in path:
                        self.cap[e] -= push
                        self.cap[e ^ 1] += push
                    path, v = [], source
                    continue
                while at[v] < len(self.out[v]):
                    e = self.out[v][at[v]]
                    if level.get(self.to[e]) == level[v] + 1 and tight(v, e):
                        break
                    at[v] += 1
                if at[v] < len(self.out[v]):
                    path.append(self.out[v][at[v]])
                    v = self.to[path[-1]]
                elif path:
                    v = self.to[path.pop() ^ 1]
                    at[v] += 1
                else:
                    break


def route(capacity: dict[tuple, int], quota: dict[str | None, float]) -> dict[tuple, int]:
    """Words to take of each pattern: as much of the quotas as can be met, at the least cost of repetition."""
    f = Flow()
    source, sink = f.node(), f.node()
    for_source = {s: f.node() for s in quota}
    for s, q in quota.items():
        f.arc(for_source[s], sink, round(q), 0)
    tiers = {}
    for pattern, words in capacity.items():
        node = f.node()
        tiers[pattern] = [f.arc(source, node, words, cost) for cost in COSTS]
        for s in pattern:
            f.arc(node, for_source[s], words * len(COSTS), 0)
    f.run(source, sink)
    return {pattern: sum(f.cap[e ^ 1] for e in arcs) for pattern, arcs in tiers.items()}


def _key(members: Column) -> Column:
    """A pattern as text: its sources by length and name, null apart."""
    return F.array_join(F.transform(members, lambda s: F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.length(s).cast("string"), F.lit(":"), s))), ",")


def _spread(doc_id: Column, text: Column, seed: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), doc_id, text), 64 - HASH_BITS)


@dataclass
class Filled:
    """How a pattern's rest is filled: rounds (from hash, to hash, least and most size) whose documents are all taken, one
    more document by its hash, and the words that are missing without and with it."""

    left: int
    rounds: list[tuple[int, int, int, int]] = field(default_factory=list)
    last: int | None = None
    off: int = 0


def _in_rounds(rounds: Column, u: Column, size: Column) -> Column:
    return F.exists(rounds, lambda r: (u >= r["lo"]) & (u < r["hi"]) & (size >= r["least"]) & (size <= r["most"]))


def _take(narrow: DataFrame, filled: dict[str, Filled], least: dict[str, int], most: dict[str, int]) -> None:
    """Documents of at least `least` and at most `most` words in hash order, each that fits what is left. A round goes on to
    the first that does not fit (first its bin, then the place inside it) among those no larger than what is left; the next
    goes on behind it."""
    spark = narrow.sparkSession
    lo = {n: 0 for n in least if filled[n].left > 0}
    while lo:
        state = [(n, at, max(1, least[n]), min(most[n], filled[n].left), filled[n].left) for n, at in lo.items()]
        state = spark.createDataFrame(state, "pattern string, lo long, least long, most long, rest long")
        fits = narrow.join(F.broadcast(state), "pattern").filter("u >= lo and size between least and most").withColumn("bin", F.shiftright("u", HASH_BITS - 12).cast("int"))
        per_bin = fits.groupBy("pattern", "bin").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
        sums = per_bin.selectExpr("pattern", "bin", "rest", "sum(words) over (partition by pattern order by bin) as upto")
        edges = sums.groupBy("pattern").agg(F.min(F.when(F.col("upto") > F.col("rest"), F.col("bin"))).alias("edge"), F.max(F.when(F.col("upto") <= F.col("rest"), F.col("upto")).otherwise(0)).alias("before")).collect()
        found = {r.pattern: (LAST, r.before) for r in edges}
        if at_edge := [r for r in edges if r.edge is not None]:
            edge = F.broadcast(spark.createDataFrame(at_edge, "pattern string, edge int, before long"))
            inside = fits.join(edge, "pattern").filter("bin = edge").selectExpr("pattern", "u", "before", "rest", "before + sum(size) over (partition by pattern order by u) as upto")
            cut = inside.groupBy("pattern").agg(F.min(F.when(F.col("upto") > F.col("rest"), F.col("u"))).alias("cut"), F.max(F.when(F.col("upto") <= F.col("rest"), F.col("upto")).otherwise(F.col("before"))).alias("words"))
            found |= {r.pattern: (r.cut, r.words) for r in cut.collect()}
        for n, (cut, words) in found.items():
            f = filled[n]
            # Documents of size 0 go with the first round.
            f.rounds.append((lo[n], cut, max(1, least[n]) if f.rounds else least[n], min(most[n], f.left)))
            f.left -= words
            lo[n] = cut + 1
        lo = {n: at for n, at in lo.items() if n in found and filled[n].left > 0 and at < LAST}


def _last(narrow: DataFrame, filled: dict[str, Filled]) -> None:
    """The document not taken whose words bring the sum nearest, if one brings it nearer at all."""
    for f in filled.values():
        f.off = f.left
    if not (rows := [(n, f.rounds, f.left) for n, f in filled.items() if f.left > 0]):
        return
    state = F.broadcast(narrow.sparkSession.createDataFrame(rows, f"pattern string, rounds array<{ROUND}>, rest long"))
    after = narrow.join(state, "pattern").filter("size > 0 and size < 2 * rest").filter(~_in_rounds(F.col("rounds"), F.col("u"), F.col("size")))
    after = after.groupBy("pattern", "u").agg(F.sum("size").alias("size"), F.first("rest").alias("rest"))
    for r in after.groupBy("pattern").agg(F.min(F.struct(F.abs(F.col("size") - F.col("rest")).alias("off"), "u")).alias("f")).collect():
        if r.f.off < filled[r.pattern].off:
            filled[r.pattern].off, filled[r.pattern].last = r.f.off, r.f.u


def fill(narrow: DataFrame, rest: dict[str, int], smallest: dict[str, int]) -> dict[str, Filled]:
    """narrow(pattern, u, size) -> how each pattern's rest is filled."""
    filled = {n: Filled(w) for n, w in rest.items()}
    _take(narrow, filled, dict.fromkeys(rest, 0), rest)
    _last(narrow, filled)
    # A gap that smaller documents could not close, for they are all taken: those above it go first.
    if short := {n: f.left for n, f in filled.items() if f.off > 0 and f.left >= smallest[n]}:
        again = {n: Filled(rest[n]) for n in short}
        _take(narrow, again, {n: gap + 1 for n, gap in short.items()}, {n: rest[n] for n in short})
        _take(narrow, again, dict.fromkeys(short, 0), short)
        _last(narrow, again)
        filled |= {n: f for n, f in again.items() if f.off < filled[n].off}
    return filled


def plan(docs: DataFrame, members: Column, seed: int = SEED, weights=WEIGHTS) -> tuple[DataFrame, dict, dict]:
    """(one row per pattern: pattern, copies, rounds, fill), source sizes and targets. A document's repetitions are copies,
    one more where it is in one of the rounds or its hash equals fill."""
    spark = docs.sparkSession
    narrow = stash(docs.select(_key(F.array_sort(F.array_distinct(members))).alias("pattern"), F.array_distinct(members).alias("members"), size_of().alias("size"), _spread(F.col("doc_id"), F.col("text"), seed).alias("u")), "sizes")
    patterns = narrow.groupBy("pattern").agg(F.any_value("members").alias("members"), F.sum("size").alias("words"), F.min(F.when(F.col("size") > 0, F.col("size"))).alias("smallest"))
    rows = patterns.limit(MOST_PATTERNS + 1).collect()
    if len(rows) > MOST_PATTERNS:
        raise ValueError(f"more than {MOST_PATTERNS} membership patterns: group the sources first")
    capacity, name, sizes = {}, {}, {}
    for r in sorted(rows, key=lambda r: r.pattern):
        key = tuple(r.members)
        capacity[key], name[key] = r.words, r.pattern
        for s in key:
            sizes[s] = sizes.get(s, 0) + r.words
    quota = targets(sizes, weights)
    if any(len(k) > 1 for k in capacity):  # overlapping sources count words more than once; quotas share the words there are
        share = sum(capacity.values()) / max(1, sum(sizes.values()))
        quota = {s: q * share for s, q in quota.items()}
    words = route(capacity, quota)
    copies = {k: min(MOST_REPEATS, w // capacity[k]) if capacity[k] else 0 for k, w in words.items()}
    rest = {k: words[k] - copies[k] * capacity[k] for k in words}
    filled = fill(narrow, {name[k]: int(n) for k, n in rest.items() if n > 0}, {r.pattern: r.smallest for r in rows})
    none = Filled(0)
    rows = [(name[k], int(copies[k]), filled.get(name[k], none).rounds, filled.get(name[k], none).last) for k in words]
    return spark.createDataFrame(rows, f"pattern string, copies int, rounds array<{ROUND}>, fill long"), sizes, quota


def repeats(docs: DataFrame, planned: DataFrame, members: Column, seed: int = SEED, names: tuple[str, str] = ("_size", "_times")) -> DataFrame:
    """docs and two more columns: size, and how often the mix takes the row. The names must not be columns of docs."""
    mine, of = free_names(docs, "mix", "pattern")
    row = F.struct(_key(F.array_sort(F.array_distinct(members))).alias("pattern"), _spread(F.col("doc_id"), F.col("text"), seed).alias("u"), size_of().alias("size"))
    p = F.broadcast(planned.select(F.struct("pattern", "copies", "rounds", "fill").alias(of)))
    x = lambda c: F.col(f"{mine}.{c}")
    more = (_in_rounds(F.col(f"{of}.rounds"), x("u"), x("size")) | (x("u") == F.coalesce(f"{of}.fill", F.lit(-1)))).cast("int")
    joined = docs.withColumn(mine, row).join(p, x("pattern") == F.col(f"{of}.pattern"))
    return joined.select(*(F.col(f"`{c}`") for c in docs.columns), x("size").alias(names[0]), F.least(F.col(f"{of}.copies") + more, F.lit(MOST_REPEATS)).alias(names[1]))


def mix_table(docs: DataFrame) -> DataFrame:
    """documents -> doc_id, size, source_size, target, taken; each document has the one source of its row."""
    members = F.array("source")
    planned, sizes, quota = plan(docs, members)
    by_source = docs.sparkSession.createDataFrame([(s, int(n), float(quota[s])) for s, n in sizes.items()], "source string, source_size long, target double")
    rows = repeats(docs.select("doc_id", "text", "source"), planned, members, names=("size", "times")).drop("text")
    by_source = F.broadcast(by_source.withColumnRenamed("source", "s"))
    return rows.join(by_source, rows["source"].eqNullSafe(by_source["s"])).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"))


def mixed(docs: DataFrame) -> DataFrame:
    """The mix itself: documents, each as often as it is taken. All columns are kept."""
    members = F.array("source")
    planned, _, _ = plan(docs, members)
    size, times = free_names(docs, "size", "times")
    rows = repeats(docs, planned, members, names=(size, times)).filter(f"`{times}` > 0")
    return rows.select(*(F.col(f"`{c}`") for c in docs.columns), F.explode(F.sequence(F.lit(1), F.col(times))).alias(times)).drop(times)
