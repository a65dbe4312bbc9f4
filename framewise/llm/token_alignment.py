"""Alignment of two tokenizers' tokens by merge-path partitioning, and corpus-wide counts of linked ids.

Both tokenizers code the same bytes (a space and the text), so a token of either ends at a byte offset and a batch's ends are
two ascending sequences. Merging them is split by the merge path: for every so-many-th diagonal a binary search gives how
many ends of either come before it, which cuts the merge into independent pieces of equal work, however unlike the
tokenizers cut. A piece gives out the offsets where ends meet inside it; where two ends meet across a cut, the piece after
it is stitched to the one before. Meeting ends close groups, and link the A token and the B token that end there.

Corpus-wide counts: a block of documents gives its distinct pairs of ids with their counts, these are summed by pair, the
highest count of each B id is taken over at most as many rows as A has ids, and every block gets back its own pairs'
figures. A pair that all documents hold is one row for each block in the join, and no table of pairs is broadcast.

A is a byte-level BPE file of the tokenizers library, coded by tiktoken with the file's own ranks (the file must list its
merges in the order of their ids, else it is refused); B is a SentencePiece BPE model (sentencepiece_bpe.py).

Defined results: null and empty texts, and those whose tokens don't spell a space and the text (a text that holds U+2581, as
B codes it as a space), have no tokens: zeros and an empty digest; texts are taken whole, whatever their length; repeated
rows and null doc_ids are coded and counted each; equal counts of a B id are all its highest; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framewise.llm.common import slices, stash, texts_of, tidy, tidy_batches, tune
from framewise.llm.sentencepiece_bpe import encoder, gather

#: Ends that one piece of the merge takes.
PIECE = 1 << 16
#: Links of one block of documents, on average. Blocks follow the links alone: each sends its own distinct pairs to the join.
BLOCK_LINKS = 1 << 22
#: The pattern by which byte-level BPE cuts words: a fixed value of that kind of tokenizer.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_of_char() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: bytes that print stand for themselves, the others follow at 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


class ByteLevel:
    """Ids and bytes of a byte-level BPE file."""

    def __init__(self, text: str):
        import tiktoken

        spec = json.loads(text)
        model, cut = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or spec["normalizer"] or cut["type"] != "ByteLevel" or not cut["use_regex"] or cut["add_prefix_space"]:
            raise ValueError("not a plain byte-level BPE file")
        byte_of, vocab = _byte_of_char(), model["vocab"]
        merged = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        if merged != sorted(merged):
            raise ValueError("merges are not in the order of their ids")
        special = {t["content"] for t in spec["added_tokens"]}
        spelled = {bytes(byte_of[c] for c in token): i for token, i in vocab.items() if token not in special}
        self.size = max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        self.coder = tiktoken.Encoding("a", pat_str=WORDS, mergeable_ranks=spelled, special_tokens={})
        self.table = Spelling({i: t for t, i in spelled.items()}, self.size)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [np.asarray(self.coder.encode_to_numpy(t, disallowed_special=()), np.int64) for t in texts]
        return np.concatenate(found) if found else np.zeros(0, np.int64), np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int64)


class Spelling:
    """The bytes of each id."""

    def __init__(self, of: dict[int, bytes], size: int):
        spelled = [of.get(i, b"") for i in range(size)]
        self.length = np.array([len(x) for x in spelled], np.int64)
        self.at = np.cumsum(self.length) - self.length
        self.data = np.frombuffer(b"".join(spelled), np.uint8)

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        return gather(self.data, self.at[ids], self.length[ids])


@lru_cache(maxsize=1)
def _byte_level(text: str) -> ByteLevel:
    return ByteLevel(text)


@lru_cache(maxsize=1)
def _digits(size: int) -> Spelling:
    """Each id in decimal with a comma."""
    return Spelling({i: b"%d," % i for i in range(size)}, size)


def diagonals(a: np.ndarray, b: np.ndarray, piece: int) -> tuple[np.ndarray, np.ndarray]:
    """How many of a and of b are among the first 0, piece, 2 * piece, ... and all of their merge; equal ones of a go first."""
    d = np.append(np.arange(0, len(a) + len(b), piece), len(a) + len(b))
    lo, hi = np.maximum(0, d - len(b)), np.minimum(d, len(a))
    while (open_ := np.flatnonzero(lo < hi)).size:
        mid = (lo[open_] + hi[open_]) // 2
        before = a[mid] <= b[d[open_] - mid - 1]
        lo[open_[before]] = mid[before] + 1
        hi[open_[~before]] = mid[~before]
    return lo, d - lo


def meetings(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """(place in a, place in b) where a piece's values are equal, by merging its two ascending parts."""
    both = np.concatenate([a, b])
    order = np.argsort(both, kind="stable")  # a merge of two runs
    merged = both[order]
    at = np.flatnonzero(merged[1:] == merged[:-1])
    return np.stack([order[at], order[at + 1] - len(a)])


def merge_path(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """Places in a and in b of equal values; both ascend strictly."""
    i, j = diagonals(a, b, piece)
    found = []
    for k in range(len(i) - 1):
        if 0 < i[k] and j[k] < len(b) and a[i[k] - 1] == b[j[k]]:  # stitch: the cut runs between two ends that meet
            found.append(np.array([[i[k] - 1], [j[k]]]))
        found.append(meetings(a[i[k] : i[k + 1]], b[j[k] : j[k + 1]]) + np.array([[i[k]], [j[k]]]))
    both = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
    return both[0], both[1]


def _spells(table: Spelling, ids: np.ndarray, bounds: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which texts their tokens spell."""
    made, total = table.bytes_of(ids), np.concatenate([[0], np.cumsum(table.length[ids])])[bounds]
    ok = np.diff(total) == np.diff(offsets)
    if ok.all() and np.array_equal(made, data):
        return ok
    for k in np.flatnonzero(ok).tolist():
        ok[k] = np.array_equal(made[total[k] : total[k + 1]], data[offsets[k] : offsets[k + 1]])
    return ok


def _only(ids: np.ndarray, bounds: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of some texts; the others have none."""
    n = np.diff(bounds)
    return ids[np.repeat(keep, n)], np.concatenate([[0], np.cumsum(np.where(keep, n, 0))])


def aligned(a: ByteLevel, b, texts: pa.LargeStringArray):
    """(ids and bounds of A, ids and bounds of B, places in A and in B where groups end) of a batch."""
    whole = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts, pa.scalar("", pa.large_string()))
    whole = pc.if_else(pc.equal(pc.binary_length(texts), 0), texts, whole)
    offsets = np.concatenate([[0], np.cumsum(pc.binary_length(whole).to_numpy(zero_copy_only=False))]).astype(np.int64)
    data = np.frombuffer("".join(whole.to_pylist()).encode(), np.uint8)
    ids_a, bounds_a = a.encode(whole.to_pylist())
    ids_b, bounds_b = b.encode(texts)
    ended = np.zeros(len(ids_b), bool)
    ended[bounds_b[1:] - 1] = True  # the end ids
    ids_b, bounds_b = ids_b[~ended].astype(np.int64), bounds_b - np.arange(len(bounds_b))
    table_b = _pieces(b)
    ok = _spells(a.table, ids_a, bounds_a, data, offsets) & _spells(table_b, ids_b, bounds_b, data, offsets)
    ids_a, bounds_a = _only(ids_a, bounds_a, ok)
    ids_b, bounds_b = _only(ids_b, bounds_b, ok)
    end_a, end_b = merge_path(np.cumsum(a.table.length[ids_a]), np.cumsum(table_b.length[ids_b]))
    return ids_a, bounds_a, ids_b, bounds_b, end_a, end_b


def _pieces(b) -> Spelling:
    if not hasattr(b, "spelling"):
        b.spelling = Spelling(dict(enumerate(b.text)), len(b.text))
    return b.spelling


def group_texts(ids_a, bounds_a, ids_b, bounds_b, end_a, end_b, size: int) -> list[bytes]:
    """For each text its groups as `a1,a2|b1;a3|b2,b3`."""
    na, nb = len(ids_a), len(ids_b)
    group_a, group_b = np.searchsorted(end_a, np.arange(na)), np.searchsorted(end_b, np.arange(nb))
    at_a = np.arange(na) + np.concatenate([[0], end_b + 1])[group_a]
    at_b = np.arange(nb) + (end_a + 1)[group_b]
    ids = np.empty(na + nb, np.int64)
    ids[at_a], ids[at_b] = ids_a, ids_b
    table = _digits(size)
    data, last = table.bytes_of(ids), np.cumsum(table.length[ids]) - 1
    data[last[at_a[end_a]]] = ord("|")
    data[last[at_b[end_b]]] = ord(";")
    cut = np.concatenate([[0], last + 1])[bounds_a + bounds_b].tolist()
    data = data.tobytes()
    return [data[x : max(x, y - 1)] for x, y in zip(cut, cut[1:], strict=False)]


CODED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary"


def coded(docs: DataFrame, a_path: str, b_path: str, with_groups: bool = False) -> DataFrame:
    """One row for each document: counts, the digest of its groups and its links, each as A id * size of B + B id in eight bytes or four; with
    groups: their text as well."""
    spark = docs.sparkSession
    with open(a_path, encoding="utf-8") as f:
        a_file = spark.sparkContext.broadcast(f.read())
    with open(b_path, "rb") as f:
        b_file = spark.sparkContext.broadcast(f.read())

    def run(batches):
        a, b = _byte_level(a_file.value), encoder(b_file.value)
        n_b = len(b.text)
        kind = np.uint32 if a.size * n_b < 1 << 32 else np.uint64
        for batch in batches:
            texts, ids = texts_of(batch["text"]), batch["doc_id"]
            for x, y in slices(texts):
                ids_a, bounds_a, ids_b, bounds_b, end_a, end_b = found = aligned(a, b, texts.slice(x, y - x))
                groups = group_texts(*found, max(a.size, n_b))
                per = np.searchsorted(end_a, bounds_a)
                links = (ids_a[end_a] * n_b + ids_b[end_b]).astype(kind).tobytes()
                step = np.dtype(kind).itemsize
                counts = (np.diff(bounds_a), np.diff(bounds_b), np.diff(per), np.diff(per))
                columns = [ids.slice(x, y - x), *(pa.array(c, pa.int64()) for c in counts), pa.array([hashlib.sha256(g).hexdigest() if g else "" for g in groups], pa.string()), pa.array([links[u * step : v * step] for u, v in zip(per.tolist(), per.tolist()[1:], strict=False)], pa.binary())]
                if with_groups:
                    columns.append(pa.array([g.decode() for g in groups], pa.string()))
                yield pa.record_batch(columns, names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links"] + ["groups"] * with_groups)
        b.forget()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(tidy_batches(run), CODED + ", groups string" * with_groups)


def _codes(column: pa.ChunkedArray, wide: bool) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(x.as_buffer(), np.uint64 if wide else np.uint32).astype(np.int64) for x in column)])


def align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """documents -> doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    spark = tune(docs.sparkSession)
    with open(a_path, encoding="utf-8") as f:
        size_a = ByteLevel(f.read()).size
    with open(b_path, "rb") as f:
        size_b = len(encoder(f.read()).text)
    wide = size_a * size_b >= 1 << 32
    found = stash(coded(docs, a_path, b_path), "coded")
    n = max(1, -(-(found.agg(F.sum("n_links")).first()[0] or 0) // BLOCK_LINKS))
    block = F.pmod(F.xxhash64("doc_id", "n_a", "groups_sha256"), F.lit(n)).alias("block")

    def distinct(table: pa.Table) -> pa.Table:
        code, times = np.unique(_codes(table["links"], wide), return_counts=True)
        return pa.table({"block": pa.array(np.full(len(code), table["block"][0].as_py()), pa.int64()), "code": pa.array(code), "n": pa.array(times, pa.int64())})

    pairs = found.filter("n_links > 0").select(block, "links").groupBy("block").applyInArrow(tidy(distinct), "block long, code long, n long")
    pairs = stash(pairs, "pairs")
    counts = pairs.groupBy("code").agg(F.sum("n").alias("count"))
    counts = counts.withColumn("best", F.col("count") == F.max("count").over(Window.partitionBy(F.col("code") % size_b)))
    own = pairs.select("block", "code").join(counts, "code")

    def figures(key, table: pa.Table, own_: pa.Table) -> pa.Table:
        own_ = own_.sort_by("code")
        code, count, best = own_["code"].to_numpy(), own_["count"].to_numpy(), own_["best"].to_numpy().astype(np.int64)
        at = np.searchsorted(code, _codes(table["links"], wide))
        bounds = np.concatenate([[0], np.cumsum(table["n_links"].to_numpy())])
        total = lambda x: pa.array(np.diff(np.concatenate([[0], np.cumsum(x[at])])[bounds]), pa.int64())
        columns = {c: table[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
        return pa.table(columns | {"n_best": total(best), "count_sum": total(count), "groups_sha256": table["groups_sha256"]})

    rows = found.select(block, "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links")
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return rows.groupBy("block").cogroup(own.groupBy("block")).applyInArrow(tidy(figures), schema)
