import numpy as np

from framewise.llm.hashing import mix
from framewise.llm.sketch import bits_for, cells_of, member, pack, unpack


def test_pack_round_trip():
    rng = np.random.default_rng(0)
    for cells in ([], [5], [0, 0, 7], [1, 2**16, 2**16 + 1, 2**40, 2**55], rng.integers(0, 2**44, 1000), rng.integers(0, 2**20, 5000)):
        cells = np.sort(np.array(cells, np.uint64))
        assert (unpack(pack(cells)) == cells).all()


def test_member_loses_nothing():
    keys = mix(np.arange(10_000, dtype=np.uint64))
    bits = bits_for(50)
    assert member(keys, np.unique(cells_of(keys[:100], bits)), bits)[:100].all()
    assert not member(keys[100:], np.unique(cells_of(keys[:100], bits)), bits).any()
