"""Line dedup within an edit bound of one character, by a deletion-neighbourhood join.

A line is what stands between line feeds, without white space at its ends; lines without a word are never compared. Of equal
lines the earliest stays (smallest doc_id, then place in the document). A line of NEAR_CHARS code points or more also goes if
an earlier line is one insertion, deletion or substitution away. All is judged on the input.

Two lines within the bound share a deletion variant: both lose the same place (substitution), or one loses a character and
equals the other. Variants are emitted as hashed keys and joined by minima over equal keys; no pairs are listed. Lines that
share a variant differ from it by one inserted character, so a group's size is bounded by the line's length and alphabet,
whatever the corpus. Before that, a lossless prefilter spares most lines the full neighbourhood: of a line cut into four
parts, all but one stand unchanged at their place in any line within the bound, so only lines that share such a three-part
key with a different line emit variants. The keys meet in a count-min sketch (sketch.py), which costs two bytes a key. Found
pairs are verified by edit distance. Lines are equal if 128 bits of BLAKE2b are; the polynomial hashes of parts and variants
only find candidates. The text is shuffled once; its exchange serves all passes.

Defined results: null text counts as empty; a null doc_id orders after all others; rows that repeat a doc_id are the same
document, so equal places don't remove each other; blank lines stay; lines and texts are taken whole, whatever their length; an empty table
gives an empty result; further columns are passed on by rewrite(), whatever their names.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framewise.llm import sketch
from framewise.llm.common import blocks_for, free_names, slices, stash, text_bytes, texts_of, tidy, tidy_batches, tune
from framewise.llm.hashing import mix, powers, prefix_sums, span_hash

NEAR_CHARS = 20
PARTS = 4
LAST = (1 << 63) - 1
WHITE = " \t\n\x0b\x0c\r"
_WHITE = np.zeros(0x22, bool)
_WHITE[[ord(c) for c in WHITE]] = True


@lru_cache(maxsize=1)
def _codes() -> np.ndarray:
    """A random odd number for each code point."""
    return mix(np.arange(0x110000, dtype=np.uint64), 11) | np.uint64(1)


class Lines:
    """Lines of some texts as code points: text, place in the text, start and end without outer white space."""

    def __init__(self, texts: pa.LargeStringArray):
        whole = "\n".join(texts.to_pylist()) + "\n" if len(texts) else ""
        self.chars = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        feed = np.flatnonzero(self.chars == 0x0A)
        starts = np.concatenate([[0], feed + 1])[: len(feed)]
        per_text = np.array([t.count("\n") + 1 for t in texts.to_pylist()], np.int64)
        self.text = np.repeat(np.arange(len(texts)), per_text)
        self.place = np.arange(len(feed)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
        solid = np.append(np.flatnonzero(~_WHITE[np.minimum(self.chars, 0x21)]), len(self.chars))
        at = np.searchsorted(solid, starts)
        self.starts, self.ends = solid[at], solid[np.maximum(np.searchsorted(solid, feed), 1) - 1] + 1
        full = self.starts < feed
        self.is_full, self.full = full, np.flatnonzero(full)
        self.sums = prefix_sums(_codes()[self.chars])

    def take(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        s, e = self.starts[which], self.ends[which]
        return s, e, e - s

    def digests(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two halves of a digest of each line."""
        view = memoryview(self.chars).cast("B") if len(self.chars) else memoryview(b"")
        s, e, _ = self.take(which)
        found = np.frombuffer(b"".join(hashlib.blake2b(view[a:b], digest_size=16).digest() for a, b in zip((4 * s).tolist(), (4 * e).tolist(), strict=True)), "<i8")
        return found[::2], found[1::2]

    def part_keys(self, which: np.ndarray) -> np.ndarray:
        """The keys of the prefilter, one row for each line: for its own length and one less, without each part."""
        s, e, n = self.take(which)
        keys = []
        for base in (n, n - 1):
            for j in range(PARTS):
                before, behind = base * j // PARTS, base - base * (j + 1) // PARTS
                key = mix(span_hash(self.sums, s, s + before), 1) + mix(span_hash(self.sums, e - behind, e), 2)
                keys.append(mix(key + base.astype(np.uint64), 3 + j))
        return np.stack(keys, axis=1)

    def variants(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(line, deleted place, key) of all deletion variants; place -1 is the line itself."""
        s, e, n = self.take(which)
        line = np.repeat(np.arange(len(which)), n)
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        begin, end = s[line], e[line]
        rest = span_hash(self.sums, begin, begin + at) + span_hash(self.sums, begin + at + 1, end) * powers(at)
        length = np.concatenate([n[line] - 1, n]).astype(np.uint64)
        key = mix(np.concatenate([rest, span_hash(self.sums, s, e)]) + length * np.uint64(0x9E3779B97F4A7C15), 5)
        return np.concatenate([line, np.arange(len(which))]), np.concatenate([at, np.full(len(which), -1)]), key

    def string(self, which: int) -> str:
        return self.chars[self.starts[which] : self.ends[which]].tobytes().decode("utf-32-le")


def _key(lines: Lines, which: np.ndarray) -> np.ndarray:
    return lines.digests(which)[0]


#: A line: its document and place, and a hash of it, as rows may repeat a doc_id.
_LINE = ["doc", "line", "h1"]


def _place():
    return F.struct(*_LINE)


def _before(a: str):
    """Whether the line in column a stands before this row's."""
    return F.struct(f"{a}.doc", f"{a}.line") < F.struct("doc", "line")


def line_table(docs: DataFrame) -> DataFrame:
    """doc, line and two hashes of every line with a word."""

    def run(batches):
        for b in batches:
            texts, ids = texts_of(b["text"]), b["doc_id"].cast(pa.int64()).fill_null(LAST).to_numpy()
            for a, z in slices(texts):
                lines = Lines(texts.slice(a, z - a))
                w = lines.full
                yield pa.record_batch([pa.array(ids[a + lines.text[w]]), pa.array(lines.place[w], pa.int32()), *map(pa.array, lines.digests(w))], names=["doc", "line", "h1", "h2"])

    return docs.select("doc_id", "text").mapInArrow(tidy_batches(run), "doc long, line int, h1 long, h2 long")


def _asked(table: pa.Table) -> np.ndarray:
    """The lines of a table as sorted records."""
    found = table.select(_LINE).drop_null()
    return np.sort(np.rec.fromarrays([found[c].to_numpy().astype(np.int64) for c in _LINE], names=_LINE))


def _in(lines: Lines, ids: np.ndarray, which: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Which of some lines are among the asked ones: by document and place first, then by their digests too."""
    docs = np.unique(asked.doc)
    if not len(docs):
        return np.zeros(len(which), bool)
    at = np.minimum(np.searchsorted(docs, ids[which]), len(docs) - 1)
    hit = docs[at] == ids[which]
    hit &= np.isin(at << 32 | lines.place[which], np.searchsorted(docs, asked.doc) << 32 | asked.line)
    some = np.flatnonzero(hit)
    hit[some] = np.isin(np.rec.fromarrays([ids[which[some]], lines.place[which[some]], _key(lines, which[some])], names=_LINE), asked)
    return hit


def _pieces(table: pa.Table):
    """(lines, their documents' ids) of a block."""
    ids = table["doc_id"].fill_null(LAST).to_numpy()
    texts = texts_of(table["text"])
    for a, z in slices(texts):
        lines = Lines(texts.slice(a, z - a))
        yield lines, ids[a + lines.text]


def _near_lines(table: pa.Table, copies: np.ndarray):
    """(lines, those that may have near ones and are no copies)."""
    for lines, ids in _pieces(table):
        which = lines.full[lines.ends[lines.full] - lines.starts[lines.full] >= NEAR_CHARS - 1]
        yield lines, which[~_in(lines, ids, which, copies)]


def _strings(table: pa.Table, asked: np.ndarray) -> pa.Table:
    """The asked lines of a block with their texts. Only documents that hold one are split."""
    ids = table["doc_id"].fill_null(LAST).to_numpy()
    mine = np.isin(ids, asked.doc)
    out: dict[str, list] = {"doc": [], "line": [], "string": []}
    first, last = np.searchsorted(asked.doc, ids[mine]), np.searchsorted(asked.doc, ids[mine], "right")
    for text, doc, a, z in zip(texts_of(table["text"]).filter(pa.array(mine)).to_pylist(), ids[mine].tolist(), first.tolist(), last.tolist(), strict=True):
        lines = text.split("\n")
        for place in sorted(set(asked.line[a:z].tolist())):
            if place < len(lines) and (line := lines[place].strip(WHITE)):
                for k, v in zip(out, (doc, place, line), strict=True):
                    out[k].append(v)
    strings = pa.array(out["string"], pa.large_string())
    lines = Lines(strings)
    keys = _key(lines, lines.full) if len(strings) else np.zeros(0, np.int64)
    found = pa.table({"doc": pa.array(out["doc"], pa.int64()), "line": pa.array(out["line"], pa.int32()), "h1": pa.array(keys), "string": strings.cast(pa.string())})
    return found.filter(pa.array(np.isin(np.rec.fromarrays([found[c].to_numpy().astype(np.int64) for c in _LINE], names=_LINE), asked)))


def repeated_lines(docs: DataFrame, blocks: DataFrame, n: int) -> DataFrame:
    """(_block, doc, line, h1) of all lines to remove."""
    bits = sketch.bits_for(n)
    block = lambda: F.pmod(F.xxhash64(F.when(F.col("doc") != LAST, F.col("doc"))), F.lit(n)).alias("_block")
    by_block = blocks.groupBy("_block")
    table = stash(line_table(docs), "lines")
    # Lines by hash, with the first place and whether there is another one: lines without one are no copies.
    distinct = stash(table.groupBy("h1", "h2").agg(F.min(_place()).alias("first"), F.max(_place()).alias("last")), "distinct-lines")
    several = distinct.filter("first < last").select("h1", "h2", "first")
    copies = stash(table.join(several, ["h1", "h2"]).filter(_before("first")).select(block(), *_LINE), "line-copies")

    def sketched(key, docs_, copies_):
        parts = [lines.part_keys(which).ravel() for lines, which in _near_lines(docs_, _asked(copies_))]
        return sketch.sketch_rows(key[0].as_py(), np.concatenate(parts) if parts else np.zeros(0, np.uint64), n, bits)

    shared = sketch.merge(by_block.cogroup(copies.groupBy("_block")).applyInArrow(tidy(sketched), sketch.SKETCH))
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    more = copies.select("_block", *_LINE, none("binary", "cells")).unionByName(shared.select(F.col("block").alias("_block"), none("long", "doc"), none("int", "line"), none("long", "h1"), "cells"))

    def variants(key, docs_, more_):
        cells, out = sketch.union(more_["cells"]), []
        for lines, which in _near_lines(docs_, _asked(more_)) if len(cells) else ():
            which = which[sketch.member(lines.part_keys(which).ravel(), cells, bits).reshape(-1, 2 * PARTS).any(1)]
            line, at, k = lines.variants(which)
            out.append(pa.table({"key": pa.array(k.view(np.int64)), "at": pa.array(at, pa.int32()), "h1": pa.array(_key(lines, which)[line])}))
        return pa.concat_tables(out) if out else pa.table({"key": pa.array([], pa.int64()), "at": pa.array([], pa.int32()), "h1": pa.array([], pa.int64())})

    # Variants are made and shuffled once: both ends of a group are found in its own partition.
    of_key = Window.partitionBy("key")
    rows = by_block.cogroup(more.groupBy("_block")).applyInArrow(tidy(variants), "key long, at int, h1 long")
    groups = rows.withColumns({"lo": F.min("h1").over(of_key), "hi": F.max("h1").over(of_key)}).filter("lo < hi").select("key", "at", "h1")
    met = groups.join(distinct.select("h1", F.col("first.doc").alias("doc"), F.col("first.line").alias("line")), "h1")
    ends = {"whole": F.min(F.when(F.col("at") < 0, _place())).over(of_key), "cut": F.min(F.when(F.col("at") >= 0, _place())).over(of_key), "same": F.min(_place()).over(Window.partitionBy("key", "at"))}
    pairs = met.withColumns(ends).withColumn("earlier", F.when(F.col("at") < 0, F.col("cut")).otherwise(F.least("same", "whole"))).filter(_before("earlier")).select(*_LINE, "earlier").distinct()
    both = pairs.select(*_LINE).unionByName(pairs.select("earlier.*")).distinct()

    def strings(key, docs_, asked_):
        return _strings(docs_, _asked(asked_))

    text = by_block.cogroup(both.select(block(), *_LINE).groupBy("_block")).applyInArrow(tidy(strings), "doc long, line int, h1 long, string string").dropDuplicates(_LINE)
    near = (
        pairs.join(text, _LINE)
        .join(text.select(_place().alias("earlier"), F.col("string").alias("string2")), "earlier")
        .filter(f"length(string) >= {NEAR_CHARS}")
        .filter(F.levenshtein("string", "string2", 1).between(0, 1))
        .select(block(), *_LINE)
        .distinct()
    )
    return copies.unionByName(near)


def rewrite(docs: DataFrame, counts: tuple[str, str] = ("_n_lines", "_n_removed")) -> DataFrame:
    """docs with repeated lines taken out of text, and two more columns named by counts: lines with a word, before and
    removed. The names must not be columns of docs."""
    spark = tune(docs.sparkSession)
    n = blocks_for(spark, text_bytes(docs))
    names = list(docs.columns)
    # The further columns travel as one, whatever their names are.
    rest = [c for c in names if c not in ("doc_id", "text")]
    packed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.struct(*(F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(rest)), F.lit(0).alias("c")).alias("rest"))
    blocks = packed.withColumn("_block", F.pmod(F.xxhash64("doc_id"), F.lit(n))).repartition("_block")
    gone = repeated_lines(packed.select("doc_id", "text"), blocks, n)

    def run(key, docs_, gone_):
        asked = _asked(gone_)
        ids = docs_["doc_id"].fill_null(LAST).to_numpy()
        first, last = np.searchsorted(asked.doc, ids), np.searchsorted(asked.doc, ids, "right")
        total, removed, new = [], [], []
        for text, a, z in zip(docs_["text"].to_pylist(), first.tolist(), last.tolist(), strict=True):
            lines = (text or "").split("\n")
            full = [bool(x.strip(WHITE)) for x in lines]
            drop = _gone(lines, full, asked[a:z]) if a < z else set()
            total.append(sum(full))
            removed.append(len(drop))
            new.append("\n".join(x for k, x in enumerate(lines) if k not in drop) if drop else text)
        out = docs_.select(["doc_id", "text", "rest"]).set_column(1, "text", pa.array(new, pa.string()))
        return out.append_column("total", pa.array(total, pa.int64())).append_column("removed", pa.array(removed, pa.int64()))

    schema = T.StructType([*packed.schema, T.StructField("total", T.LongType()), T.StructField("removed", T.LongType())])
    done = blocks.groupBy("_block").cogroup(gone.groupBy("_block")).applyInArrow(tidy(run), schema)
    back = {"doc_id": F.col("doc_id"), "text": F.col("text")} | {c: F.col(f"rest.c{k}") for k, c in enumerate(rest)}
    return done.select(*(back[c].alias(c) for c in names), F.col("total").alias(counts[0]), F.col("removed").alias(counts[1]))


def _gone(lines: list[str], full: list[bool], asked: np.ndarray) -> set[int]:
    """Places of the asked lines: those of the document whose hash is asked for too, as rows may repeat a doc_id."""
    places = [k for k in np.unique(asked.line).tolist() if k < len(lines) and full[k]]
    some = Lines(pa.array([lines[k].strip(WHITE) for k in places], pa.large_string()))
    keys = _key(some, some.full).tolist() if places else []
    wanted = set(zip(asked.line.tolist(), asked.h1.tolist(), strict=True))
    return {k for k, h in zip(places, keys, strict=True) if (k, h) in wanted}


def digests(docs: DataFrame) -> DataFrame:
    """documents -> doc_id, n_lines, n_removed, kept_sha256."""
    done = rewrite(docs.select("doc_id", "text"), ("n_lines", "n_removed"))
    return done.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def dedup(docs: DataFrame) -> DataFrame:
    """documents with repeated lines removed; a document all of whose lines are repeats goes. All columns are kept, and
    n_chars, where there is one, follows the text."""
    total, removed = free_names(docs, "n_lines", "n_removed")
    done = rewrite(docs, (total, removed)).filter(f"`{total}` = 0 or `{removed}` < `{total}`")
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.when(F.col(removed) > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return done.select([f"`{c}`" for c in docs.columns])
