import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from framewise.llm.token_alignment import ByteLevel, align, coded, diagonals, merge_path

A_PATH, B_PATH = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, n_a string, links string, block int"


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    chars = {chr(b): b for b in plain}
    for k, b in enumerate(x for x in range(256) if x not in plain):
        chars[chr(256 + k)] = b
    return a, sentencepiece.SentencePieceProcessor(model_file=B_PATH), chars


def brute(rows, libraries):
    a, b, chars = libraries
    docs, counts = [], Counter()
    for doc_id, text, *_ in rows:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        spelled_a = [bytes(chars[c] for c in a.id_to_token(i)) for i in ids_a]
        spelled_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in ids_b for p in [b.id_to_piece(i)]]
        if text and not b"".join(spelled_a) == b"".join(spelled_b) == (" " + text).encode():
            ids_a, ids_b, spelled_a, spelled_b = [], [], [], []
        ends_a, ends_b = np.cumsum([len(x) for x in spelled_a]).tolist(), np.cumsum([len(x) for x in spelled_b]).tolist()
        place_b = {e: k for k, e in enumerate(ends_b)}
        links = [(ids_a[k], ids_b[place_b[e]]) for k, e in enumerate(ends_a) if e in place_b]
        groups, x, y = [], 0, 0
        for k, e in enumerate(ends_a):
            if e in place_b:
                groups.append(",".join(map(str, ids_a[x : k + 1])) + "|" + ",".join(map(str, ids_b[y : place_b[e] + 1])))
                x, y = k + 1, place_b[e] + 1
        counts.update(links)
        docs.append((doc_id, len(ids_a), len(ids_b), links, ";".join(groups)))
    best = defaultdict(int)
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    out = []
    for doc_id, n_a, n_b, links, groups in docs:
        out.append((doc_id, n_a, n_b, len(links), len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links), hashlib.sha256(groups.encode()).hexdigest() if groups else ""))
    return sorted(out, key=str)


def rows():
    texts = [None, "", " ", "\n\t x", "a", "the token of the day", "<|endoftext|> and <s> </s> <unk> <0x41>", "mark ▁ inside", "naïve café Ünïcödé 漢字 🙂🏽", "x" * 5000, "ab " * 3000, "the same line\n" * 7, "\x00\x01 odd \u200b", "١٢٣ ½"]
    texts += ["The quick brown fox, 12345 times: don't! " * 50] * 3
    long = "Wörter und words, " * 60_000
    out = [(k, t) for k, t in enumerate(texts)] + [(None, "a null id"), (None, "a null id"), (5, "the token of the day"), (99, long)]
    return [(*r, "x", None, 1) for r in out]


def test_against_the_libraries(spark, libraries):
    df = spark.createDataFrame(rows(), SCHEMA)
    got = sorted(map(tuple, align(df.repartition(3), A_PATH, B_PATH).collect()), key=str)
    assert got == brute(rows(), libraries)
    assert align(df.limit(0), A_PATH, B_PATH).collect() == []


def test_groups_are_real_outputs(spark):
    df = spark.createDataFrame([(1, "unhappy", "", "", 1)], SCHEMA)
    row = coded(df, A_PATH, B_PATH, with_groups=True).first()
    assert hashlib.sha256(row.groups.encode()).hexdigest() == row.groups_sha256 and row.groups.count(";") == row.n_groups - 1


@pytest.mark.parametrize("piece", [1, 2, 3, 7, 1000])
def test_pieces_of_the_merge_path(piece):
    rng = np.random.default_rng(piece)
    for n, m in ((0, 0), (0, 5), (5, 0), (40, 3), (30, 30), (200, 180)):
        a, b = np.sort(rng.choice(300, n, False)), np.sort(rng.choice(300, m, False))
        i, j = diagonals(a, b, piece)
        assert (np.diff(i + j)[:-1] == piece).all() and i[-1] == n and j[-1] == m
        x, y = merge_path(a, b, piece)
        assert a[x].tolist() == b[y].tolist() == sorted(set(a.tolist()) & set(b.tolist()))


def test_byte_level_coder_is_the_library(libraries):
    with open(A_PATH, encoding="utf-8") as f:
        mine = ByteLevel(f.read())
    texts = [" a" + "".join(map(chr, range(lo, lo + 64))) + " 1" for lo in range(0, 0x3000, 64)] + [t for _, t, *_ in rows() if t]
    ids, bounds = mine.encode(texts)
    assert [ids[x:y].tolist() for x, y in zip(bounds, bounds[1:], strict=False)] == [e.ids for e in libraries[0].encode_batch(texts, add_special_tokens=False)]


def test_other_files_are_refused():
    with pytest.raises(ValueError), open(P.path("word_bpe_49k.json"), encoding="utf-8") as f:
        ByteLevel(f.read())
