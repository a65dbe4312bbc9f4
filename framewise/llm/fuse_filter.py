"""Static 3-wise binary-fuse filters with 8-bit fingerprints, built and asked in whole arrays.

Construction peels all slots of degree one in rounds and assigns fingerprints in the reverse order; keys of one round don't
touch each other's slots, so a round is a few array operations."""

from __future__ import annotations

import math

import numpy as np

from framewise.llm.hashing import mix


class FuseFilter:
    def __init__(self, seed: int, segment: int, span: int, prints: np.ndarray):
        self.seed, self.segment, self.span, self.prints = seed, segment, span, prints

    @classmethod
    def build(cls, keys: np.ndarray) -> FuseFilter:
        keys = np.unique(keys)
        n = max(2, len(keys))
        segment = 1 << max(2, int(math.log(n) / math.log(3.33) + 2.25))
        factor = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(n))
        for seed in range(1, 100):
            span = max(1, math.ceil(n * factor / segment) - 2 + seed // 20) * segment
            f = cls(seed, segment, span, np.zeros(span + 2 * segment, np.uint8))
            if f._assign(keys):
                return f
        raise RuntimeError("no seed gave a filter")

    def _slots(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = mix(keys, self.seed)
        a = ((h >> np.uint64(32)) * np.uint64(self.span) >> np.uint64(32)).astype(np.int64)
        mask = self.segment - 1
        b = (a + self.segment) ^ ((h >> np.uint64(18)).astype(np.int64) & mask)
        c = (a + 2 * self.segment) ^ (h.astype(np.int64) & mask)
        return np.stack([a, b, c]), (h ^ (h >> np.uint64(40))).astype(np.uint8)

    def _assign(self, keys: np.ndarray) -> bool:
        slots, prints = self._slots(keys)
        size, live, rounds = len(self.prints), np.arange(len(keys)), []
        while len(live):
            mine = slots[:, live]
            degree = np.bincount(mine.ravel(), minlength=size)
            single = degree[mine] == 1
            peeled = single.any(0)
            if not peeled.any():
                return False
            rounds.append((live[peeled], single[:, peeled].argmax(0)))
            live = live[~peeled]
        for at, which in reversed(rounds):
            s = slots[:, at]
            self.prints[s[which, np.arange(len(at))]] = 0
            self.prints[s[which, np.arange(len(at))]] = prints[at] ^ self.prints[s[0]] ^ self.prints[s[1]] ^ self.prints[s[2]]
        return True

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        s, prints = self._slots(keys)
        return (self.prints[s[0]] ^ self.prints[s[1]] ^ self.prints[s[2]]) == prints
