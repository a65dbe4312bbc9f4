"""Count-min prefilter over partition sketches.

A sketch counts 64-bit keys in 2**bits virtual cells (one row of a count-min sketch, so a cell's sum can only be too high;
bits grows with the number of blocks, which keeps the share of false positives level). Nearly all cells of a block of
documents are empty, so a sketch is kept sparse: its sorted cells as differences of two bytes, larger ones listed apart.
Sketches are merged by ranges of cells, in as many tasks as wanted; no task and no broadcast holds a whole merged sketch.
Every block gets back the cells it shares with itself or another block: keys outside them are unique.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewise.llm.common import tidy


def bits_for(blocks: int) -> int:
    return min(56, 29 + max(1, blocks - 1).bit_length())


def pack(cells: np.ndarray) -> bytes:
    """Sorted cells: the first, the number of wide gaps, their places and sizes, and the low two bytes of all gaps."""
    if not len(cells):
        return b""
    gaps = np.diff(cells)
    wide = np.flatnonzero(gaps >> np.uint64(16))
    return b"".join([cells[:1].astype("<u8").tobytes(), len(wide).to_bytes(4, "little"), wide.astype("<u4").tobytes(), gaps[wide].astype("<u8").tobytes(), gaps.astype("<u2").tobytes()])


def unpack(packed: bytes) -> np.ndarray:
    if not packed:
        return np.zeros(0, np.uint64)
    n = int.from_bytes(packed[8:12], "little")
    gaps = np.frombuffer(packed, "<u2", offset=12 + 12 * n).astype(np.uint64)
    gaps[np.frombuffer(packed, "<u4", n, 12)] = np.frombuffer(packed, "<u8", n, 12 + 4 * n)
    return np.cumsum(np.concatenate([np.frombuffer(packed, "<u8", 1), gaps]))


def cells_of(keys: np.ndarray, bits: int) -> np.ndarray:
    return keys >> np.uint64(64 - bits)


def sketch_rows(block: int, keys: np.ndarray, shards: int, bits: int) -> pa.Table:
    """One row for each range of cells that the block's keys fall in: (block, shard, cells)."""
    cells = np.sort(cells_of(keys, bits))
    edges = np.searchsorted(cells, (np.arange(shards + 1, dtype=object) * (1 << bits) // shards).astype(np.uint64))
    edges[-1] = len(cells)
    full = np.flatnonzero(np.diff(edges))
    return pa.table({"block": pa.array([block] * len(full), pa.int64()), "shard": pa.array(full, pa.int32()), "cells": pa.array([pack(cells[edges[s] : edges[s + 1]]) for s in full], pa.binary())})


SKETCH = "block long, shard int, cells binary"
SHARED = "block long, cells binary, hot binary"


def merge(sketches: DataFrame, hot_from: int = 32) -> DataFrame:
    """For each block and shard, the block's cells with a merged count of 2 or more; hot: those with hot_from or more."""

    def one(table: pa.Table) -> pa.Table:
        parts = [unpack(x) for x in table["cells"].to_pylist()]
        _, at, counts = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
        count = counts[at]
        out, a = {"block": [], "cells": [], "hot": []}, 0
        for block, part in zip(table["block"].to_pylist(), parts, strict=True):
            n, a = count[a : a + len(part)], a + len(part)
            if (n > 1).any():
                out["block"].append(block)
                out["cells"].append(pack(np.unique(part[n > 1])))
                out["hot"].append(pack(np.unique(part[n >= hot_from])))
        return pa.table(out, pa.schema([("block", pa.int64()), ("cells", pa.binary()), ("hot", pa.binary())]))

    return sketches.groupBy("shard").applyInArrow(tidy(one), SHARED)


def member(keys: np.ndarray, cells: np.ndarray, bits: int) -> np.ndarray:
    """Which keys fall in one of the sorted cells."""
    if not len(cells):
        return np.zeros(len(keys), bool)
    k = cells_of(keys, bits)
    at = np.minimum(np.searchsorted(cells, k), len(cells) - 1)
    return cells[at] == k


def union(column: pa.ChunkedArray) -> np.ndarray:
    parts = [unpack(x) for x in column.to_pylist() if x]
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)


def sketches(blocks: DataFrame, keys: Callable[[pa.Table], Iterator[np.ndarray]], n: int) -> DataFrame:
    """Sketch every one of n blocks: keys gives a block's keys, in pieces."""
    bits = bits_for(n)

    def one(table: pa.Table) -> pa.Table:
        pieces = list(keys(table))
        return sketch_rows(table["block"][0].as_py(), np.concatenate(pieces) if pieces else np.zeros(0, np.uint64), n, bits)

    return blocks.groupBy("block").applyInArrow(tidy(one), SKETCH)


def block_of(column: str, n: int):
    return F.pmod(F.xxhash64(column), F.lit(n)).alias("block")
