"""Different words and lines stay different, however they were made."""

import hashlib

import numpy as np
import pytest
import sentencepiece

from framewise.llm import hashing, line_dedup, ngram_join, sentencepiece_bpe, substring_dedup
from framewise.llm.queries import piece_model


def thue_morse(n):
    """A word of n letters and its complement: polynomials modulo a power of two can't tell them apart from 1,024 on."""
    bits = [bin(k).count("1") % 2 for k in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def docs(spark, n):
    a, b = thue_morse(n)
    return spark.createDataFrame([(1, " ".join([a] * 20)), (2, " ".join([b] * 20)), (3, a), (4, b)], "doc_id long, text string")


@pytest.mark.parametrize("n", [1024, 2048])
def test_patterned_words(spark, n):
    df = docs(spark, n)
    assert {r.doc_id: (r.n_words, r.n_removed) for r in substring_dedup.remove_repeats(df).collect()} == {1: (20, 0), 2: (20, 0), 3: (1, 0), 4: (1, 0)}
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join(df).collect()} == {1: (1, 1), 2: (1, 2), 3: (1, 3), 4: (1, 4)}
    assert {r.doc_id: r.n_removed for r in line_dedup.digests(df).collect()} == {1: 0, 2: 0, 3: 0, 4: 0}
    sp = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    want = {r.doc_id: hashlib.sha256(" ".join(map(str, [*sp.encode(r.text), sp.eos_id()])).encode()).hexdigest() for r in df.collect()}
    assert {r.doc_id: r.ids_sha256 for r in sentencepiece_bpe.digests(df, piece_model()).collect()} == want


def test_short_words_are_their_bytes():
    """Words of every length around the bounds, some of which differ in one byte or by a zero byte only."""
    rng = np.random.default_rng(5)
    words = {bytes(rng.integers(0, 3, k, dtype=np.uint8)) for k in [1, 2, 7, 8, 9, 15, 16, 17, 18, 40] * 400}
    words = sorted(words)
    data, ends = np.frombuffer(b"".join(words), np.uint8), np.cumsum([len(w) for w in words])
    low, high = hashing.identities(data, ends - [len(w) for w in words], ends, 77)
    assert len(np.unique(low)) == len(np.unique(high)) == len(words)
    again = hashing.identities(np.concatenate([data, data]), np.concatenate([ends, ends + len(data)]) - [len(w) for w in words] * 2, np.concatenate([ends, ends + len(data)]), 77)
    assert (again[0] == np.tile(low, 2)).all() and (again[1] == np.tile(high, 2)).all()
    assert not (hashing.identities(data, ends - [len(w) for w in words], ends, 78)[0] == low).any()


def test_words_that_share_a_hash_are_coded_apart(monkeypatch):
    """With four bits in place of 64, all words collide; the other 64 tell them apart, in one batch and between batches."""
    import pyarrow as pa

    plain = hashing.identities
    monkeypatch.setattr(sentencepiece_bpe, "identities", lambda *a: (plain(*a)[0] & np.uint64(15), plain(*a)[1]))
    with open(piece_model(), "rb") as f:
        coder = sentencepiece_bpe.Encoder(f.read())
    sp = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    for texts in (["one two three four five six seven eight nine ten eleven", "two words"], ["", "seven other words and one more of them, eight"]):
        ids, bounds = coder.encode(pa.array(texts, pa.large_string()))
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:], strict=False)] == [[*sp.encode(t), sp.eos_id()] for t in texts]
