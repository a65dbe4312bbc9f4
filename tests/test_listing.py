"""Listings against os.walk, images and headers against their makers."""

import os
import struct
import zlib

import numpy as np
import pytest

from framewise.sources import capture, listing, png


def crooked(top):
    deep = top
    for k in range(12):
        deep = deep / f"level {k} %20 #ü"
    deep.mkdir(parents=True)
    (deep / "_hidden.png").write_bytes(b"123")
    (top / "empty").mkdir()
    (top / ".dot").mkdir()
    (top / ".dot" / "a=b?c*.exr").write_bytes(b"")
    (top / "many").mkdir()
    for k in range(300):
        (top / "many" / f"{k:04d}.exr").write_bytes(b"x" * k)
    os.symlink(top, deep / "loop")
    os.symlink(top / "many" / "0001.exr", top / "link.exr")
    os.symlink(top / "nowhere", top / "dangling")


def test_crooked_tree(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(listing, "ENTRIES", 16)
    crooked(tmp_path)
    want = {}
    for folder, dirs, names in os.walk(tmp_path):
        for n in dirs + names:
            p = os.path.join(folder, n)
            kind = "link" if os.path.islink(p) else "directory" if n in dirs else "file"
            want[p] = (kind, os.path.getsize(p) if kind == "file" else None, os.lstat(p).st_mtime_ns)
    for root in (f"file://{tmp_path}", str(tmp_path)):
        got = listing.walk(spark, root).collect()
        assert {r.path: (r.kind, r.size, r.mtime_ns) for r in got} == want and len(got) == len(want)


def test_missing_and_empty_roots(spark, tmp_path):
    assert listing.walk(spark, str(tmp_path)).collect() == []
    assert [tuple(r)[:2] for r in listing.walk(spark, str(tmp_path / "none")).collect()] == [(str(tmp_path / "none"), "unreadable")]


def test_tree_columns(spark, tmp_path):
    for rel in ("rot_arc/m_Target_1_occ/rgb/0007.PNG", "rot_arc/m_Target_1_GT/depth/x.y.exr", "rot_arc/m_Target_1_GT/depth/0001.txt", "loose.png"):
        (tmp_path / rel).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / rel).write_bytes(b"ab")
    got = capture.scan_output_tree(spark, str(tmp_path)).collect()
    assert sorted((r.trajectory, r.prefix, r.suffix, r.pass_name, r.frame, r.stem, r.ext, r.size) for r in got) == sorted([("rot_arc", "m_Target_1", "occ", "rgb", 7, "0007", "png", 2), ("rot_arc", "m_Target_1", "GT", "depth", None, "x.y", "exr", 2)], key=str)


def chunk(kind, data):
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


@pytest.mark.parametrize("colour, n", [(0, 1), (4, 2), (2, 3), (6, 4)])
@pytest.mark.parametrize("kinds", [(0,), (1,), (2,), (3,), (4,), (0, 1, 2), (4, 3, 2, 1, 0)])
def test_filters(colour, n, kinds):
    rng = np.random.default_rng(n)
    image = rng.integers(0, 256, (7, 5, n))
    raw = b""
    for y in range(7):
        kind, row = kinds[y % len(kinds)], b""
        for x in range(5):
            for c in range(n):
                left, up = (int(image[y, x - 1, c]) if x else 0), (int(image[y - 1, x, c]) if y else 0)
                corner = int(image[y - 1, x - 1, c]) if x and y else 0
                p = left + up - corner
                paeth = min((left, up, corner), key=lambda v: abs(p - v))
                row += bytes([(int(image[y, x, c]) - (0, left, up, (left + up) // 2, paeth)[kind]) % 256])
        raw += bytes([kind]) + row
    head = chunk(b"IHDR", struct.pack(">IIBBBBB", 5, 7, 8, colour, 0, 0, 0))
    whole = png.SIGNATURE + head + chunk(b"tEXt", b"k\0v") + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")
    assert (png.decode(whole) == image).all()
    for broken in (whole[:-1], whole[:40], b"", whole.replace(b"IDAT", b"IDAX"), b"GIF89a" + whole, whole[:60] + b"\xff" + whole[61:]):
        assert png.decode(broken) is None


def test_headers_of_any_length():
    from io import BytesIO

    def header(filler):
        listed = b"Z\0" + struct.pack("<iiii", 2, 0, 1, 1) + b"\0"
        return struct.pack("<II", 20000630, 2) + b"note\0string\0" + struct.pack("<i", filler) + b"n" * filler + b"channels\0chlist\0" + struct.pack("<i", len(listed)) + listed + b"\0"

    for filler in (0, 1, 4000, 4050, 4096, 65_536, 1_000_000):
        data = header(filler)
        assert capture.read_exr_channels(BytesIO(data + b"rest")) == {"Z": "float"}
        assert capture.read_exr_channels(BytesIO(data[:-4])) is None
    assert capture.read_exr_channels(BytesIO(b"")) is None and capture.read_exr_channels(BytesIO(b"nothing like it")) is None


def test_an_empty_plan_among_several(spark, tmp_path):
    (tmp_path / "a.csv").write_text("sequence_id,map_path\nx,y\n")
    (tmp_path / "b.csv").write_text("sequence_id,map_path\n")
    with pytest.raises(ValueError, match=r"b\.csv"):
        capture.read_sequence_plan(spark, str(tmp_path / "a.csv"), str(tmp_path / "b.csv"))
