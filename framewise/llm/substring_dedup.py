"""Substring dedup: words covered by a window of words that starts earlier somewhere else are removed.

Documents are dealt into blocks by a hash of their id. Inside a block, windows with equal hashes (64 and 32 bits, of the
two independent halves of their words' identities, keyed for each run) are settled at once: all but the block's first are repeats. The first ones meet the other blocks': a count-min
prefilter (sketch.py) finds those that another block may hold, losing none, and only these are shuffled and grouped exactly.
A group has one window of a block at most, so a passage shared by a third of all documents is a small group.

The text is shuffled once; its exchange serves all three passes.

Defined results: null text has no words (its digest is that of the empty text); a null doc_id orders after all others;
rows of equal doc_id are ordered by their text, and of wholly equal rows one comes first; a document shorter than a window
loses nothing; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framewise.llm import sketch
from framewise.llm.common import blocks_for, slices, text_bytes, texts_of, tidy, tune
from framewise.llm.hashing import Words, new_key

LAST = (1 << 63) - 1


def _sorted(table: pa.Table) -> pa.Table:
    return table.sort_by([("doc_id", "ascending"), ("text", "ascending")])


def _pieces(texts: pa.LargeStringArray):
    for a, b in slices(texts):
        yield a, Words(texts.slice(a, b - a))


class Windows:
    """All windows of a block in order: their document's place, their start in it, two hashes; first: not seen before."""

    def __init__(self, texts: pa.LargeStringArray, window: int, key: int):
        parts: list[list[np.ndarray]] = [[], [], [], []]
        for a, w in _pieces(texts):
            at, (h1, h2) = w.windows(window, *w.identities(key))
            row = w.text_of()[at]
            for part, x in zip(parts, ((a + row).astype(np.int32), (at - w.first[row]).astype(np.int32), h1, h2 >> np.uint64(32)), strict=True):
                part.append(x)
        empty = (np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.uint64), np.zeros(0, np.uint64))
        self.row, self.start, self.h1, self.h2 = (np.concatenate(p) if p else e for p, e in zip(parts, empty, strict=True))
        order = np.argsort(self.h1, kind="stable")
        same = np.zeros(len(order), bool)
        same[1:] = self.h1[order[1:]] == self.h1[order[:-1]]
        again = same.copy()
        again[:-1] |= same[1:]
        some = np.sort(order[again])
        some = some[np.lexsort((some, self.h2[some], self.h1[some]))]
        repeat = np.zeros(len(some), bool)
        repeat[1:] = (self.h1[some[1:]] == self.h1[some[:-1]]) & (self.h2[some[1:]] == self.h2[some[:-1]])
        self.first = np.ones(len(order), bool)
        self.first[some[repeat]] = False


def remove_repeats(docs: DataFrame, window: int = 20, with_text: bool = False) -> DataFrame:
    """docs(doc_id, text) -> doc_id, n_words, n_removed, kept_sha256 and, if asked for, kept_text."""
    spark = tune(docs.sparkSession)
    n = blocks_for(spark, text_bytes(docs))
    bits, secret = sketch.bits_for(n), new_key()
    blocks = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", sketch.block_of("doc_id", n)).repartition("block")

    def keys(table):
        for_block = [w.windows(window, w.identities(secret)[0])[1][0] for _, w in _pieces(texts_of(table["text"]))]
        yield np.unique(np.concatenate(for_block)) if for_block else np.zeros(0, np.uint64)

    shared = sketch.merge(sketch.sketches(blocks, keys, n))

    def candidates(key, docs_: pa.Table, shared_: pa.Table) -> pa.Table:
        cells = sketch.union(shared_["cells"])
        if not len(cells):
            return pa.table({name: pa.array([], kind) for name, kind in _ROWS})
        docs_ = _sorted(docs_)
        w = Windows(texts_of(docs_["text"]), window, secret)
        may = w.first & sketch.member(w.h1, cells, bits)
        ids = docs_["doc_id"].fill_null(LAST).to_numpy()
        columns = w.h1[may].view(np.int64), ((w.h2[may] << np.uint64(32)) | w.start[may].astype(np.uint64)).view(np.int64), ids[w.row[may]], w.row[may]
        return pa.table({name: pa.array(x, kind) for (name, kind), x in zip(_ROWS, columns, strict=True)})

    rows = blocks.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(tidy(candidates), "h1 long, hs long, doc long, ord int")
    rows = rows.select("h1", F.shiftright("hs", 32).alias("h2"), "doc", "ord", F.col("hs").bitwiseAND(0xFFFFFFFF).cast("int").alias("start"))
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("h1", "h2").orderBy("doc", "ord", "start")))
    known_id = F.when(F.col("doc") != LAST, F.col("doc"))
    later = ranked.filter("rank > 1").select(F.pmod(F.xxhash64(known_id), F.lit(n)).alias("block"), "ord", "start")

    def cut(key, docs_: pa.Table, later_: pa.Table) -> pa.Table:
        docs_ = _sorted(docs_)
        texts = texts_of(docs_["text"])
        w = Windows(texts, window, secret)
        place = lambda row, start: (row.astype(np.int64) << 32) | start.astype(np.int64)
        at = np.sort(np.concatenate([place(later_["ord"].to_numpy(), later_["start"].to_numpy()), place(w.row[~w.first], w.start[~w.first])]))
        words, removed, kept = [], [], []
        for a, w in _pieces(texts):
            mine = at[np.searchsorted(at, a << 32) : np.searchsorted(at, (a + len(w.counts)) << 32)]
            first = w.first[(mine >> 32) - a] + (mine & 0xFFFFFFFF)
            depth = np.zeros(len(w.starts) + 1, np.int64)
            np.add.at(depth, first, 1)
            np.add.at(depth, first + window, -1)
            gone = np.cumsum(depth[:-1]) > 0
            words.append(w.counts)
            removed.append(np.diff(np.concatenate([[0], np.cumsum(gone)])[w.first]))
            kept += _kept(w, ~gone)
        out = {"doc_id": docs_["doc_id"], "n_words": pa.array(np.concatenate(words) if words else [], pa.int64()), "n_removed": pa.array(np.concatenate(removed) if removed else [], pa.int64()), "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string())}
        if with_text:
            out["kept_text"] = pa.array([x.decode() for x in kept], pa.string())
        return pa.table(out)

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    return blocks.groupBy("block").cogroup(later.groupBy("block")).applyInArrow(tidy(cut), schema)


_ROWS = (("h1", pa.int64()), ("hs", pa.int64()), ("doc", pa.int64()), ("ord", pa.int32()))


def _kept(w: Words, keep: np.ndarray) -> list[bytes]:
    """The kept words of each text, joined by one space."""
    starts, ends = w.starts[keep], w.ends[keep]
    step = np.zeros(len(w.data) + 2, np.int8)
    np.add.at(step, starts, 1)
    np.add.at(step, ends + 1, -1)  # the white space behind the word goes with it
    chosen = np.cumsum(step[: len(w.data)]) > 0
    data = w.data.copy()
    data[ends] = 0x20
    out = data[chosen].tobytes()
    bounds = np.concatenate([[0], np.cumsum(chosen)])[w.offsets].tolist()
    return [out[a : max(a, b - 1)] for a, b in zip(bounds, bounds[1:], strict=False)]
