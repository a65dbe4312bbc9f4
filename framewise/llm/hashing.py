"""Vectorised words, word identities and window hashes of a batch of texts.

Texts are laid end to end as UTF-8 bytes, one white-space byte after each. A word of up to 16 bytes is its bytes, in two
numbers, which a keyed permutation stirs: different words of one length have different identities, whatever they are. Longer
words get 128 bits of BLAKE2b. The key is drawn anew for each run, so that no text can be made to collide.

A window's hash is a polynomial over its words' identities modulo 2**64, taken as a difference of prefix sums and then mixed;
over 20 random numbers such a polynomial can lose 13 bits at most, over five 4, but it must not be taken over characters, of
which some thousand in a pattern make it zero. The two halves of the identities give two window hashes that are independent.
"""

from __future__ import annotations

import hashlib
import secrets
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BASE = 0x9E3779B97F4A7C15 | 5
_INVERSE = pow(_BASE, -1, 1 << 64)
_LOW = 1 << 16


@lru_cache(maxsize=2)
def _low(base: int) -> np.ndarray:
    """base**i for i below _LOW."""
    p = np.full(_LOW, base, np.uint64)
    p[0] = 1
    return np.multiply.accumulate(p)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(at: np.ndarray, base: int = _BASE) -> np.ndarray:
    """base**i modulo 2**64 for each i, from a table of fixed size and one of a power for each _LOW of the largest."""
    low = _low(base)
    if not len(at) or (most := int(at.max())) < _LOW:
        return low[at]
    high = np.full((most >> 16) + 1, pow(base, _LOW, 1 << 64), np.uint64)
    high[0] = 1
    return low[at & (_LOW - 1)] * np.multiply.accumulate(high)[at >> 16]


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """sums[j] = sum of values[i] * base**i for i < j."""
    out, step, low = np.zeros(len(values) + 1, np.uint64), 1, _low(_BASE)
    for a in range(0, len(values), _LOW):
        piece = values[a : a + _LOW]
        np.cumsum(piece * low[: len(piece)] * np.uint64(step), out=out[a + 1 : a + 1 + len(piece)])
        out[a + 1 : a + 1 + len(piece)] += out[a]
        step = step * pow(_BASE, _LOW, 1 << 64) % (1 << 64)
    return out


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The polynomial over values[start:end], whatever start is."""
    return (sums[ends] - sums[starts]) * powers(starts, _INVERSE)


#: Longest word whose identity is made of its bytes.
SHORT = 16
_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def new_key() -> int:
    """A key of identities, to be drawn once for a run, on the driver."""
    return secrets.randbits(63)


def identities(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, key: int) -> tuple[np.ndarray, np.ndarray]:
    """128 bits for each data[start:end], as two arrays."""
    n = ends - starts
    padded = np.concatenate([data, np.zeros(SHORT, np.uint8)])
    eight = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    low = eight[starts] & _MASK[np.minimum(n, 8)]
    high = eight[starts + 8] & _MASK[np.clip(n - 8, 0, 8)]
    k = mix(np.arange(3, dtype=np.uint64) + np.uint64(key), 9)
    low += k[0] + n.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for round_key in k:
        low, high = high + mix(low ^ round_key), low
    high, low = mix(high), mix(low)
    long = np.flatnonzero(n > SHORT)
    if len(long):
        view, salt = memoryview(np.ascontiguousarray(data)), key.to_bytes(16, "little")
        found = np.frombuffer(b"".join(hashlib.blake2b(view[a:b], digest_size=16, salt=salt).digest() for a, b in zip(starts[long].tolist(), ends[long].tolist(), strict=True)), "<u8")
        low[long], high[long] = found[::2], found[1::2]
    return low, high


#: Bytes of [\x20\x09-\x0D]; bytes of A-Z lowered.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
#: Bytes that are not in [^\x00-\x2F\x3A-\x60\x7B-\x7F] after lowering; bytes of non-ASCII characters are in words.
NOT_ALNUM = np.ones(256, bool)
NOT_ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


class Words:
    """Words of texts: starts and ends are byte positions in data, first[i] is the first word of text i (first[n]: all)."""

    def __init__(self, texts: pa.LargeStringArray, lower: bool = False, gap: np.ndarray = SPACE):
        joined = pc.binary_join_element_wise(texts, pa.scalar("", pa.large_string()), pa.scalar("\n", pa.large_string()))
        _, offsets, data = joined.buffers()
        offsets = np.frombuffer(offsets, np.int64)[joined.offset : joined.offset + len(joined) + 1] if len(joined) else np.zeros(1, np.int64)
        data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if len(joined) and data is not None else np.zeros(0, np.uint8)
        self.offsets = offsets - offsets[0]
        self.data = LOWER[data] if lower else data
        inside = np.zeros(len(data) + 2, np.int8)
        inside[1:-1] = ~gap[self.data]
        edge = np.diff(inside)
        self.starts, self.ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.first = np.searchsorted(self.starts, self.offsets)
        self.counts = np.diff(self.first)

    def identities(self, key: int) -> tuple[np.ndarray, np.ndarray]:
        return identities(self.data, self.starts, self.ends, key)

    def text_of(self) -> np.ndarray:
        """The text that each word is in."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def windows(self, size: int, *hashes: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """First words of the windows of `size` words inside one text, and each window's hash over each of the words' hashes."""
        ends = np.repeat(self.first[1:], self.counts)
        at = np.flatnonzero(np.arange(len(ends)) + size <= ends)
        return at, [mix(span_hash(prefix_sums(h), at, at + size), size) for h in hashes]


def shingle_sets(texts: pa.LargeStringArray, size: int, key: int, both: bool = False) -> tuple[np.ndarray, ...]:
    """(bounds, hashes): hashes[bounds[i]:bounds[i+1]] are the sorted distinct shingle hashes of text i, lower-cased; both: and
    the second hashes of these shingles. A text of fewer words has its whole sequence as its one shingle; a text without words
    has none."""
    w = Words(texts, lower=True)
    h = w.identities(key)[: 1 + both]
    at, win = w.windows(size, *h)
    text = w.text_of()[at]
    short = np.flatnonzero((w.counts > 0) & (w.counts < size))
    if len(short):
        whole = [mix(span_hash(prefix_sums(x), w.first[short], w.first[short + 1]), 1) + w.counts[short].astype(np.uint64) for x in h]
        text, win = np.concatenate([text, short]), [np.concatenate([x, mix(y, 2)]) for x, y in zip(win, whole, strict=True)]
    order = np.lexsort((*win[::-1], text))
    text, win = text[order], [x[order] for x in win]
    keep = np.ones(len(text), bool)
    keep[1:] = (text[1:] != text[:-1]) | np.logical_or.reduce([x[1:] != x[:-1] for x in win])
    text, win = text[keep], [x[keep] for x in win]
    return np.searchsorted(text, np.arange(len(texts) + 1)), *win
