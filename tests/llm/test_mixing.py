import random
import re

from pyspark.sql import functions as F

from framewise.llm.mixing import COSTS, mix_table, mixed, plan, repeats, route, size_of, targets

SCHEMA = "doc_id long, text string, source string, size string, target long"


def test_targets():
    got = targets({"b": 10, "a": 1000, "c": 500, None: 90})
    assert got["b"] == 30 and abs(sum(got.values()) - 1600) < 1e-6
    assert all(got[s] <= 3 * n + 1e-9 for s, n in {"b": 10, "a": 1000, "c": 500, None: 90}.items())
    assert targets({}) == {} and targets({"a": 0}) == {"a": 0.0}


def brute_cost(capacity, quota, steps):
    """The least cost of repetition that meets as much of the quotas as can be, by trying all whole flows."""
    import itertools

    arcs = [(p, s) for p in capacity for s in p]
    best = None
    for flow in itertools.product(range(steps + 1), repeat=len(arcs)):
        used = {p: sum(f for f, a in zip(flow, arcs) if a[0] == p) for p in capacity}
        if any(used[p] > 3 * capacity[p] for p in capacity) or any(sum(f for f, a in zip(flow, arcs) if a[1] == s) > quota[s] for s in quota):
            continue
        cost = sum(c * max(0, min(used[p] - k * capacity[p], capacity[p])) for p in capacity for k, c in enumerate(COSTS))
        best = min(best or (0, 0), (-sum(flow), cost))
    return best


def test_flow_against_all_flows():
    rnd = random.Random(1)
    for _ in range(25):
        capacity = {("a",): rnd.randint(0, 3), ("b",): rnd.randint(0, 2), ("a", "b"): rnd.randint(0, 3)}
        quota = {"a": rnd.randint(0, 5), "b": rnd.randint(0, 5)}
        took = route(capacity, quota)
        cost = sum(c * max(0, min(took[p] - k * capacity[p], capacity[p])) for p in capacity for k, c in enumerate(COSTS))
        assert (-sum(took.values()), cost) == (brute_cost(capacity, quota, 5) or (0, 0))


def rows():
    rnd = random.Random(3)
    out = [(i, " ".join(["w"] * rnd.choice([0, 1, 5, 40, 200, 900])), rnd.choice(["s1", "s2", "s10", "é", None, "hot", "hot", "hot"])) for i in range(900)]
    return out + [(None, "a b", "s1"), (5000, None, "lone"), (5001, "x", "tiny"), (5001, "x", "tiny")]


def test_contract(spark):
    df = spark.createDataFrame([(*r, "n", 1) for r in rows()], SCHEMA)
    got = mix_table(df).collect()
    assert len(got) == len(rows())
    sizes = {}
    for _, t, s in rows():
        sizes[s] = sizes.get(s, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want = targets(sizes)
    by_id = {r[0]: r for r in rows()}
    took = dict.fromkeys(sizes, 0)
    for r in got:
        s = by_id[r.doc_id][2]
        assert r.source_size == sizes[s] and abs(r.target - want[s]) < 1e-6 and r.taken in [k * r.size for k in range(4)]
        took[s] += r.taken
    assert all(abs(took[s] - want[s]) <= max(2, 0.01 * want[s]) for s in sizes), (took, want)
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mix_table(df.repartition(5)).collect()), key=str)
    assert mix_table(df.limit(0)).collect() == []


def test_mixed_rows(spark):
    df = spark.createDataFrame([(*r, "n", 1) for r in rows()], SCHEMA)
    out = mixed(df)
    assert out.columns == df.columns
    assert out.agg(F.sum(size_of())).first()[0] == sum(r.taken for r in mix_table(df).collect())


def test_overlapping_sources(spark):
    df = spark.createDataFrame([(i, "w " * (1 + i % 7), ["a", "b", "c"][i % 3]) for i in range(600)], "doc_id long, text string, source string")
    members = F.when(F.col("doc_id") % 5 == 0, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array("source"))
    planned, sizes, quota = plan(df, members)
    taken = repeats(df, planned, members).agg(F.sum(size_of() * F.col("_times"))).first()[0]
    assert abs(taken - sum(quota.values())) < 0.02 * taken


def test_one_document_of_over_half_a_source(spark):
    """A source with one very long document meets its target from the others wherever the long one falls in hash order, and
    by the long one where the others are too few."""
    small = [(i, "w " * 100, "a") for i in range(60)]
    for long_words, copies_of_b in ((6500, 40), (6500, 2)):
        df = spark.createDataFrame([*small, (99, "w " * long_words, "a"), *((1000 + i, "w " * 100, "b") for i in range(copies_of_b))], "doc_id long, text string, source string")
        for seed in range(4):
            planned, sizes, quota = plan(df, F.array("source"), seed, weights=(1, 3))
            taken = repeats(df, planned, F.array("source"), seed).filter("source = 'a'").agg(F.sum(size_of() * F.col("_times"))).first()[0]
            assert abs(taken - quota["a"]) <= 100, (long_words, copies_of_b, seed, taken, quota)


def test_clashing_names(spark):
    names = ["_u", "_times", "_size", "_copies", "mix", "pattern", "times", "size", "rounds", "s"]
    df = spark.createDataFrame([(i, "w " * (1 + i % 9), "ab"[i % 2], *[i] * len(names)) for i in range(80)] + [(None, None, None, *[0] * len(names))], "doc_id long, text string, source string, " + ", ".join(f"`{c}` int" for c in names))
    out = mixed(df)
    assert out.columns == df.columns and all(len(set(r[3:])) == 1 and (r.doc_id is None or r.mix == r.doc_id) for r in out.collect())
    plain = df.select("doc_id", "text", "source")
    assert sorted(r.doc_id or -1 for r in out.collect()) == sorted(r.doc_id or -1 for r in mixed(plain).collect())
    assert sorted(map(tuple, mix_table(df).collect()), key=str) == sorted(map(tuple, mix_table(plain).collect()), key=str)
