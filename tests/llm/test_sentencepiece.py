import hashlib

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from framewise.llm.common import texts_of
from framewise.llm.sentencepiece_bpe import Encoder, digests

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
OURS = Encoder(open(PATH, "rb").read())
ODD = ["", " ", "   ", "a", " a  b ", "\n\n\tx\r\n", "aaaaaaaaaaaaaa", "▁▁x▁", "<s> </s> <unk> <0x41>", "語🙂é é \x00\x01", "};\r\nfoo();", "ying ying yingying", "----------====", "1234567890" * 30, "onder wonder onderonder", "�"]


def same(texts):
    ids, bounds = OURS.encode(texts_of(pa.array(texts, pa.string())))
    back = OURS.decode(ids, bounds)
    for k, t in enumerate(texts):
        want = LIBRARY.encode(t, add_eos=True)
        assert ids[bounds[k] : bounds[k + 1]].tolist() == want, t
        assert back[k] == LIBRARY.decode(want), t


def test_odd_texts():
    same(ODD)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=40), st.text(alphabet="abcdeonrsty \n", max_size=60)), max_size=4))
def test_random_texts(texts):
    same(texts)


def test_long_text():
    same(["abra kadabra " * 20000])


@pytest.mark.parametrize("ids", [[], [2], [1, 259, 2], [259, 259, 5, 198, 29871], [3 + 0xE8, 3 + 0xAA, 5, 3 + 0x20, 28713], [3 + 0x20, 523]])
def test_decode_any_ids(ids):
    import numpy as np

    assert OURS.decode(np.array(ids, np.int32), np.array([0, len(ids)])) == [LIBRARY.decode(ids)]


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: r for r in digests(docs, PATH).collect()}
    for r in docs.collect():
        want = LIBRARY.encode(r.text, add_eos=True)
        g = got[r.doc_id]
        assert (g.n_tokens, g.ids_sha256) == (len(want), hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest())
        assert g.decoded_sha256 == hashlib.sha256(LIBRARY.decode(want).encode()).hexdigest()


def test_null_and_empty(spark):
    df = spark.createDataFrame([(None, None, "x"), (1, "", "y"), (1, "a", None)], "doc_id long, text string, n_tokens string")
    assert sorted(r.n_tokens for r in digests(df, PATH).collect()) == [1, 1, len(LIBRARY.encode("a", add_eos=True))]
    assert digests(df.limit(0), PATH).collect() == []


def test_clashing_names_and_odd_rows(spark):
    import public_tokenizers

    from framewise.llm.sentencepiece_bpe import decode, digests, encode

    path = public_tokenizers.path("piece_bpe_32k.model")
    df = spark.createDataFrame([(1, "a word", "x", 5), (1, "a word", "y", 6), (None, None, "z", 7), (2, "", None, 8)], "doc_id long, text string, ids string, decoded int")
    out = encode(df, path)
    assert out.columns == ["doc_id", "decoded", "ids"] and sorted(r.decoded for r in out.collect()) == [5, 6, 7, 8]
    both = encode(df, path, decoded="decoded")
    assert sorted((r.doc_id or -1, r.decoded) for r in both.collect()) == [(-1, ""), (1, "a word"), (1, "a word"), (2, "")]
    back = decode(out.withColumn("text", out["decoded"]), path)
    assert sorted((r.doc_id or -1, r.text, r.decoded) for r in back.collect()) == [(-1, "", 7), (1, "a word", 5), (1, "a word", 6), (2, "", 8)]
    assert digests(df, path).count() == 4 and digests(df.limit(0), path).collect() == []
