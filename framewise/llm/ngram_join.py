"""Exact Jaccard join of documents' word shingles (0.8 and more), down to connected components.

1. Documents with equal shingle sets are one class; its smallest doc_id stands for it.
2. Prefix filter: two sets that are similar enough share one of their first n - ceil(0.8 n) + 1 shingles in any order that
   is the same for all. A count-min sketch over the classes' shingles (sketch.py) gives the order: shingles of one class
   only come first, hot ones last. A document with enough shingles of its own has no shared one among its first and can be
   similar to none; nearly all documents end here. No shingle of one class is shuffled.
3. Stars: of the classes that share a prefix shingle, all are tried against the smallest. Bounds on count vectors come
   first, then the sets themselves. What links is joined into components.
4. Count-vector R-trees: shingles whose classes are not all in one component are worked through whole. Their classes'
   count vectors are indexed in R-trees, every class queries them, and pairs of different components that survive the bound
   are verified on the sets. A shingle of many classes is dealt over groups of chunks, of which none holds two chunks of the
   component that the smallest class is in.
No pair is listed between classes already linked, so a large group of near copies costs one verification per class.

Defined results: a document without words (or null text) has an empty set, n_shingles 0, and links with nothing; one of
fewer than five words has its whole sequence as its one shingle; texts are taken whole, whatever their length; a null doc_id has its class's smallest doc_id as its
component and no near links of its own; rows that repeat a doc_id are linked each by its text; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framewise.llm import sketch
from framewise.llm.common import blocks_for, n_blocks, slices, stash, texts_of, tidy, tidy_batches, tune
from framewise.llm.components import components
from framewise.llm.count_rtree import CountRTree, count_vector, enough, overlap_bound, vectors
from framewise.llm.hashing import mix, new_key, shingle_sets

WORDS = 5
#: Classes of one chunk, the rows of one slot of a pivot, and the rows of one part where these are more than the shuffle's.
#: Sizes of work, not limits: every pair that counts meets in some part.
BLOCK = 512
PART_ROWS = 1024
PART_MEMBERS = 1 << 17


def signatures(docs: DataFrame, secret: int) -> DataFrame:
    """doc_id, n (distinct shingles), 128 bits that stand for the set (64 of each half of its words' identities), and the
    text's bytes."""

    def run(batches):
        for b in batches:
            texts = texts_of(b["text"])
            for a, z in slices(texts):
                bounds, *both = shingle_sets(texts.slice(a, z - a), WORDS, secret, both=True)
                sums = [np.diff(np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(h, 3))])[bounds]).view(np.int64) for h in both]
                size = pc.binary_length(texts.slice(a, z - a)).cast(pa.int64())
                yield pa.record_batch([b["doc_id"].slice(a, z - a).cast(pa.int64()), *(pa.array(x, pa.int64()) for x in (np.diff(bounds), *sums)), size], names=["doc_id", "n", "s1", "s2", "size"])

    return docs.select("doc_id", "text").mapInArrow(tidy_batches(run), "doc_id long, n long, s1 long, s2 long, size long")


def prefixes(bounds: np.ndarray, hashes: np.ndarray, shared: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, shingle) of the shared shingles in each text's prefix, in the order of step 2."""
    sizes = np.diff(bounds)
    text = np.repeat(np.arange(len(sizes)), sizes)
    rank = shared.astype(np.int8) + hot
    order = np.argsort(text * 3 + rank, kind="stable")  # equal ranks stay in hash order
    first = np.arange(len(hashes)) - np.repeat(bounds[:-1], sizes) < np.repeat(sizes - (4 * sizes + 4) // 5 + 1, sizes)
    first &= shared[order]
    return text[first], hashes[order][first]


CANDIDATE = "id long, n long, vector binary, hashes binary, tokens array<long>"


def candidates(docs: DataFrame, classes: DataFrame, n: int, secret: int) -> DataFrame:
    """Classes that may share a prefix shingle with another: their sizes, count vectors, sets and those shingles. n: blocks."""
    bits = sketch.bits_for(n)
    blocks = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", sketch.block_of("doc_id", n)).repartition("block")
    wanted = classes.select(sketch.block_of("id", n), "id").repartition("block")

    def sets(table, ids):
        """(ids, bounds, hashes) of the block's classes, in pieces; of equal rows one."""
        table = table.filter(pa.array(np.isin(table["doc_id"].fill_null(-1 << 63).to_numpy(), ids)))
        texts, mine = texts_of(table["text"]), table["doc_id"].to_numpy()
        for a, z in slices(texts):
            yield mine[a:z], *shingle_sets(texts.slice(a, z - a), WORDS, secret)

    def sketched(key, table, more):
        parts = [h for _, _, h in sets(table, more["id"].to_numpy())]
        return sketch.sketch_rows(key[0].as_py(), np.concatenate(parts) if parts else np.zeros(0, np.uint64), n, bits)

    found = sketch.merge(blocks.groupBy("block").cogroup(wanted.groupBy("block")).applyInArrow(tidy(sketched), sketch.SKETCH))
    more = found.withColumn("id", F.lit(None).cast("long")).unionByName(wanted.select("block", F.lit(None).cast("binary").alias("cells"), F.lit(None).cast("binary").alias("hot"), "id"))

    def one(key, table, more):
        cells, hot = sketch.union(more["cells"]), sketch.union(more["hot"])
        rows: dict[str, list] = {k: [] for k in ("id", "n", "vector", "hashes", "tokens")}
        for ids, bounds, h in sets(table, more["id"].drop_null().to_numpy()) if len(cells) else ():
            text, token = prefixes(bounds, h, sketch.member(h, cells, bits), sketch.member(h, hot, bits))
            at = np.searchsorted(text, np.arange(len(ids) + 1))
            for k in np.unique(text).tolist():
                mine = h[bounds[k] : bounds[k + 1]]
                rows["id"].append(ids[k])
                rows["n"].append(len(mine))
                rows["vector"].append(count_vector(mine))
                rows["hashes"].append(mine.tobytes())
                rows["tokens"].append(token[at[k] : at[k + 1]].view(np.int64))
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()))
        return pa.table({k: pa.array(v, t) for (k, v), t in zip(rows.items(), kinds, strict=True)})

    return blocks.groupBy("block").cogroup(more.groupBy("block")).applyInArrow(tidy(one), CANDIDATE)


def bounded(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs (a, b) that the sizes and the sum of coordinate minima leave."""
    side = lambda x: found.select(F.col("id").alias(x), F.col("n").alias(f"n{x}"), F.col("vector").alias(f"v{x}"))

    def run(batches):
        for b in batches:
            na, nb = b["na"].to_numpy(), b["nb"].to_numpy()
            ok = (5 * na >= 4 * nb) & (5 * nb >= 4 * na)
            va, vb = b["va"].to_pylist(), b["vb"].to_pylist()
            for k in np.flatnonzero(ok).tolist():
                ok[k] = enough(overlap_bound(va[k], vb[k]), na[k] + nb[k])
            yield b.select(["a", "b"]).filter(pa.array(ok))

    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "nb", "va", "vb").mapInArrow(tidy_batches(run), "a long, b long")


def verified(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs (a, b) whose sets are similar enough."""
    side = lambda x: found.select(F.col("id").alias(x), F.col("hashes").alias(f"h{x}"))

    def run(batches):
        for b in batches:
            ok = []
            for x, y in zip(b["ha"], b["hb"], strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.sort(np.concatenate([x, y]))
                same = int((both[1:] == both[:-1]).sum())
                ok.append(100 * same >= 80 * (len(x) + len(y) - same))
            yield b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "ha", "hb").mapInArrow(tidy_batches(run), "a long, b long")


def dealt_rows(members: DataFrame, parts: int) -> DataFrame:
    """members(token, pivot, slot, main, n, others, id, label) -> part, token, i, j, side, id, label: the groups (token, i, j)
    in which classes are compared, each of at most two chunks of BLOCK. Classes of the pivot's component (label = main) are
    linked with each other; only the others are compared with all, so a hot shingle's rows don't grow with their square.
    Chunks of others come first, then those of the main component; a group of two chunks compares across its sides."""
    is_main = F.col("label") == F.col("main")
    rows = members.withColumns({"o": F.ceil(F.col("others") / BLOCK).cast("int"), "m": F.ceil((F.col("n") - F.col("others")) / BLOCK).cast("int")})
    rows = rows.withColumn("c", F.pmod(F.xxhash64("id"), F.when(is_main, F.col("m")).otherwise(F.col("o"))).cast("int"))
    of_main = F.transform(F.sequence(F.lit(0), F.col("o") - 1), lambda i: F.struct(i.alias("i"), (F.col("o") + F.col("c")).alias("j"), F.lit(1).alias("side")))
    of_other = F.transform(F.sequence(F.lit(0), F.col("o") + F.col("m") - 1), lambda j: F.struct(F.least("c", j).alias("i"), F.greatest("c", j).alias("j"), (j < F.col("c")).cast("int").alias("side")))
    rows = rows.select("token", "pivot", "slot", "id", "label", F.explode(F.when(is_main, of_main).otherwise(of_other)).alias("g")).select("*", "g.*")
    # Shingles with the same smallest class have much the same classes and go together, as each class's count vector comes
    # once a part; where they have many rows, they are spread over neighbouring parts by their slots.
    return rows.select(F.pmod(F.xxhash64("pivot", "i", "j") + F.col("slot"), F.lit(parts)).alias("part"), "token", "i", "j", "side", "id", "label")


def rtree_pairs(members: DataFrame, found: DataFrame, parts: int) -> DataFrame:
    """Pairs of different labels that share a token and survive the R-tree, each once: only the group of a pair's first common
    token gives it out."""
    dealt = dealt_rows(members, parts)
    tokens = members.groupBy("id").agg(F.collect_set("token").alias("tokens"))  # at most the shingles of one prefix
    points = dealt.select("part", "id").distinct().join(found.select("id", "n", "vector").join(tokens, "id"), "id")
    points = points.select(F.col("part").alias("at"), F.col("id").alias("point"), "n", "vector", "tokens")

    def one(key, table, points):
        table = table.sort_by([("token", "ascending"), ("i", "ascending"), ("j", "ascending"), ("id", "ascending")])
        col = {c: table[c].to_numpy() for c in ("token", "i", "j", "side", "id", "label")}
        packed = dict(zip(points["point"].to_pylist(), zip(points["n"].to_pylist(), points["vector"].to_pylist(), strict=True), strict=True))
        tokens = dict(zip(points["point"].to_pylist(), map(frozenset, points["tokens"].to_pylist()), strict=True))
        group = np.stack([col["token"], col["i"], col["j"]])
        cut = np.flatnonzero(np.concatenate([[True], (group[:, 1:] != group[:, :-1]).any(0), [True]])) if table.num_rows else []
        out: list[tuple[int, int]] = []
        for lo, hi in zip(cut, cut[1:], strict=False):
            token, ids, labels, side = int(col["token"][lo]), col["id"][lo:hi], col["label"][lo:hi], col["side"][lo:hi]
            n = np.array([packed[k][0] for k in ids.tolist()])
            v = [packed[k][1] for k in ids.tolist()]
            groups = np.array([len(x) for x in v])
            across = col["i"][lo] != col["j"][lo]
            if across and (side == side[0]).all():
                continue  # one of the two chunks is empty
            for g in np.unique(groups).tolist():
                # Similar sets' vectors are equally fine, or one is twice as fine and is folded.
                level = np.flatnonzero((groups == g) | (groups == 2 * g))
                points_g = vectors([v[k] for k in level.tolist()], g)
                tree = CountRTree(points_g, n[level])
                for q in np.flatnonzero(groups[level] == g).tolist():
                    me = level[q]
                    near = level[tree.near(points_g[q], int(n[me]))]
                    near = near[labels[near] != labels[me]]
                    near = near[side[near] != side[me]] if across else near
                    near = near[(groups[near] != g) | (ids[near] > ids[me])]
                    my, mine = int(ids[me]), tokens[int(ids[me])]
                    out += [(min(my, x), max(my, x)) for x in ids[near].tolist() if min(mine & tokens[x]) == token]
        pairs = np.array(out, np.int64).reshape(-1, 2)
        return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})

    return dealt.groupBy("part").cogroup(points.groupBy("at")).applyInArrow(tidy(one), "a long, b long").distinct()


def links(found: DataFrame, parts: int) -> DataFrame:
    """(id, component) of the classes that have a link."""
    tokens = found.select("id", F.explode("tokens").alias("token"))
    shared = tokens.groupBy("token").agg(F.min("id").alias("pivot"), F.max("id").alias("last")).filter("pivot < last")
    members = stash(tokens.join(shared.drop("last"), "token"), "members")
    stars = members.filter("id <> pivot").select(F.col("pivot").alias("a"), F.col("id").alias("b")).distinct()
    stars = bounded(stars, found).groupBy("b").agg(F.min("a").alias("a"))
    first = components(verified(stars, found))
    labelled = members.join(first, "id", "left").select("token", "pivot", "id", F.coalesce("component", "id").alias("label"))
    main = F.max(F.when(F.col("id") == F.col("pivot"), F.col("label")))
    same = [F.count("*").alias("n"), F.bit_xor(F.xxhash64("id")).alias("x"), F.sum(F.shiftright(F.xxhash64("id"), 20)).alias("s")]
    mixed = labelled.groupBy("token", "pivot").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), main.alias("main"), *same).filter("lo < hi")
    mixed = mixed.groupBy("n", "x", "s").agg(F.min(F.struct("token", "pivot", "main")).alias("t")).select("n", "t.*")  # shingles of equal classes once
    mixed = stash(mixed, "mixed")
    slot = F.floor(F.sum("n").over(Window.partitionBy("pivot").orderBy("token")) / PART_ROWS)  # a pivot's are those of one prefix
    rows = labelled.select("token", "id", "label").join(mixed.withColumn("slot", slot), "token")
    others = rows.groupBy("token").agg(F.count(F.when(F.col("label") != F.col("main"), 1)).alias("others"))
    parts = max(parts, -(-(mixed.agg(F.sum("n")).first()[0] or 0) // PART_MEMBERS))
    pairs = rtree_pairs(rows.join(others, "token"), found, parts)
    second = verified(pairs, found)
    return components(first.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(second))


def join(docs: DataFrame) -> DataFrame:
    """documents -> doc_id, n_shingles, component_id."""
    spark = tune(docs.sparkSession)
    secret = new_key()
    signed = stash(signatures(docs, secret), "signatures")
    sets = signed.filter("n > 0").groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("id"))
    classes = sets.filter("id is not null").select("id").distinct()
    blocks = blocks_for(spark, signed.agg(F.sum("size")).first()[0])
    found = stash(candidates(docs, classes, blocks, secret), "candidates")
    linked = links(found, n_blocks(spark))
    classes_of = sets.join(linked, "id", "left").select("n", "s1", "s2", F.coalesce("component", "id").alias("component"))
    return signed.join(classes_of, ["n", "s1", "s2"], "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """documents without those that a smaller doc_id is linked with, directly or through others; documents without words and
    null ids stay. All columns are kept."""
    drop = join(docs).filter("n_shingles > 0 and doc_id > component_id").select(F.col("doc_id").alias("_dropped")).distinct()
    return docs.join(drop, docs["doc_id"] == drop["_dropped"], "left_anti")
