"""Decoding of plain PNG images: eight bits a channel, not interlaced, of one to four channels."""

from __future__ import annotations

import struct
import zlib

import numpy as np

SIGNATURE = b"\x89PNG\r\n\x1a\n"
#: Fixed values of the format: channels of each colour type that is read.
CHANNELS = {0: 1, 2: 3, 4: 2, 6: 4}


def decode(data: bytes) -> np.ndarray | None:
    """(height, width, channels) of an image; None if it is broken, cut off or of another kind."""
    if data[:8] != SIGNATURE:
        return None
    at, packed, head, ended = 8, [], None, False
    while at + 12 <= len(data) and not ended:
        size, kind = struct.unpack_from(">I4s", data, at)
        body = data[at + 8 : at + 8 + size]
        if len(body) < size or data[at + 8 + size : at + 12 + size] != struct.pack(">I", zlib.crc32(kind + body)):
            return None
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", body)
        elif kind == b"IDAT":
            packed.append(body)
        ended = kind == b"IEND"
        at += 12 + size
    if not ended or head is None:
        return None
    width, height, bits, colour, _, _, interlaced = head
    n = CHANNELS.get(colour)
    try:
        raw = np.frombuffer(zlib.decompress(b"".join(packed)), np.uint8)
    except zlib.error:
        return None
    if n is None or bits != 8 or interlaced or not width or len(raw) != height * (width * n + 1):
        return None
    rows = raw.reshape(height, width * n + 1)
    return unfiltered(rows[:, 0], rows[:, 1:].reshape(height, width, n))


def unfiltered(kinds: np.ndarray, rows: np.ndarray) -> np.ndarray | None:
    """Undo the row filters. Where a row needs its left neighbours one by one, all rows go together along diagonals, on which
    no pixel needs another."""
    height, width, n = rows.shape
    if height and kinds.max() > 4:
        return None
    if not np.isin(kinds, (3, 4)).any():
        out = rows.copy()
        for y in range(height):
            if kinds[y] == 1:
                out[y] = np.cumsum(out[y], axis=0, dtype=np.uint8)
            elif kinds[y] == 2 and y:
                out[y] += out[y - 1]
        return out
    out = np.zeros((height + 1, width + 1, n), np.int32)  # a row and a column of zeros before the image
    for d in range(height + width - 1):
        y = np.arange(max(0, d - width + 1), min(height, d + 1))
        x = d - y
        left, up, corner = out[y + 1, x], out[y, x + 1], out[y, x]
        a, b, c = np.abs(up - corner), np.abs(left - corner), np.abs(left + up - 2 * corner)
        nearest = np.where((a <= b) & (a <= c), left, np.where(b <= c, up, corner))
        k = kinds[y][:, None]
        guess = np.select([k == 1, k == 2, k == 3, k == 4], [left, up, (left + up) >> 1, nearest], 0)
        out[y + 1, x + 1] = (rows[y, x] + guess) & 255
    return out[1:, 1:].astype(np.uint8)
