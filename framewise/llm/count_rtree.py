"""An R-tree over count vectors, for joins by Jaccard similarity.

A set's point counts its tokens in hashed groups. The overlap of two sets is at most the sum of the coordinates' minima, and
for a node at most the sum of minima with the node's upper corner; with the sizes' range that rules out whole subtrees."""

from __future__ import annotations

import numpy as np

#: Jaccard similarity of 0.8 or more, in whole numbers: 9 * overlap >= 4 * (sum of sizes).
NUM, DEN = 4, 9
FAN = 16
LEAST_GROUPS = 64
_FULL = 255


def groups_for(size: int) -> int:
    """Groups of a set: a quarter of its size at least, in powers of two, so that bounds stay sharp for large sets."""
    return max(LEAST_GROUPS, 1 << max(0, (int(size) + 3) // 4 - 1).bit_length())


def count_vector(tokens: np.ndarray) -> bytes:
    """Counts of a set's tokens in groups by their high bits, one byte each; a full counter stands for any number."""
    k = groups_for(len(tokens)).bit_length() - 1
    return np.minimum(np.bincount((tokens >> np.uint64(64 - k)).astype(np.int64), minlength=1 << k), _FULL).astype(np.uint8).tobytes()


def vectors(packed: list[bytes], groups: int) -> np.ndarray:
    """Count vectors as rows of wide numbers, finer ones folded to `groups`."""
    out = np.empty((len(packed), groups), np.int32)
    for k, v in enumerate(packed):
        x = np.frombuffer(v, np.uint8).astype(np.int32)
        x[x == _FULL] = 1 << 20
        out[k] = x.reshape(groups, -1).sum(1)
    return out


def overlap_bound(x: bytes, y: bytes) -> int:
    a, b = vectors([x, y], min(len(x), len(y)))
    return int(np.minimum(a, b).sum())


def enough(bound: np.ndarray, size_sum: np.ndarray) -> np.ndarray:
    return DEN * bound >= NUM * size_sum


class CountRTree:
    def __init__(self, vectors: np.ndarray, sizes: np.ndarray):
        half = vectors[:, : vectors.shape[1] // 2].sum(1)
        self.order = np.lexsort((half, sizes))
        self.vectors, self.sizes = vectors[self.order], sizes[self.order]
        upper, low, high = self.vectors, self.sizes, self.sizes
        self.levels = []
        while len(upper) > FAN:
            cut = np.arange(0, len(upper), FAN)
            upper, low, high = np.maximum.reduceat(upper, cut), np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut)
            self.levels.append((upper, low, high))

    def near(self, vector: np.ndarray, size: int) -> np.ndarray:
        """Places (in the order given) of all sets that may be similar enough."""
        at = None
        for upper, low, high in reversed(self.levels):
            at = self._open(at, len(upper))
            ok = (5 * high[at] >= 4 * size) & (4 * low[at] <= 5 * size)
            at = at[ok]
            at = at[enough(np.minimum(vector, upper[at]).sum(1), size + np.maximum(low[at], -(-4 * size // 5)))]
        at = self._open(at, len(self.sizes))
        at = at[(5 * self.sizes[at] >= 4 * size) & (4 * self.sizes[at] <= 5 * size)]
        return self.order[at[enough(np.minimum(vector, self.vectors[at]).sum(1), size + self.sizes[at])]]

    @staticmethod
    def _open(nodes: np.ndarray | None, n: int) -> np.ndarray:
        if nodes is None:
            return np.arange(n)
        at = (nodes[:, None] * FAN + np.arange(FAN)).ravel()
        return at[at < n]
