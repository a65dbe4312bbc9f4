import hashlib

import public_tokenizers
import sentencepiece
from test_line_dedup import brute as brute_lines
from test_ngram_join import brute as brute_join

import corpus_pipeline
from framewise.llm import mixing, toxicity


def test_against_brute_force(spark, tmp_path):
    """Every stage against plain Python on the rows its predecessor kept; the mix's rows against its plan's counts."""
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    scores = {r.doc_id: r.predicted for r in toxicity.predict(docs, spark.read.parquet(f"{d}/labels.parquet")).collect()}

    def step(name, df):
        out = stages[name](spark, df, d)
        out.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    clean = step("toxicity", docs)
    assert clean.columns == columns
    assert sorted(r.doc_id for r in clean.collect()) == sorted(i for i, p in scores.items() if not p)
    lines = step("line_dedup", clean)
    want = {r[0]: r for r in brute_lines([(r.doc_id, r.text) for r in clean.collect()])}
    got = {r.doc_id: r for r in lines.collect()}
    assert lines.columns == columns and set(got) == {i for i, r in want.items() if r[1] == 0 or r[2] < r[1]}
    assert all(hashlib.sha256(r.text.encode()).hexdigest() == want[i][3] and r.n_chars == len(r.text) for i, r in got.items())
    single = step("ngram_join", lines)
    assert sorted(r.doc_id for r in single.collect()) == sorted(r[0] for r in brute_join([(r.doc_id, r.text) for r in lines.collect()]) if r[0] == r[2])
    mix = step("mixing", single)
    taken = {r.doc_id: r.taken // max(1, r.size) for r in mixing.mix_table(single).collect()}
    rows = [r.doc_id for r in mix.collect()]
    assert mix.columns == columns and {i: rows.count(i) for i in set(rows)} == {i: n for i, n in taken.items() if n}
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    ids = sorted((r.doc_id, len(library.encode(r.text)) + 1) for r in mix.collect())
    final = step("sentencepiece", mix)
    assert sorted((r.doc_id, r.n_tokens) for r in final.collect()) == ids


def test_odd_tables(spark, tmp_path):
    """Nulls in any column, repeated rows, columns of clashing names, and no rows at all, through every stage."""
    names = ["_block", "_u", "_times", "ids", "n_lines", "rest", "_dropped", "mix"]
    rows = [(1, "one line of this text is here\nand another", "en", "a", 5), (1, "one line of this text is here\nand another", "en", "a", 5), (2, None, None, None, None), (None, "one line of this text is here\nmore", None, "b", 3), (None, None, None, None, None), (3, "", "en", "b", 0), (4, "x " * 50_000, "en", "a", 100_000)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` int" for c in names)
    spark.createDataFrame([(1, 1, 0), (None, 0, 1), (2, None, None)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for some in (rows, []):
        docs = spark.createDataFrame([(*r, *range(len(names))) for r in some], schema)
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, str(tmp_path))
            if k < len(corpus_pipeline.STAGES) - 1:
                assert out.columns == docs.columns, name
                assert all(tuple(r[5:]) == tuple(range(len(names))) for r in out.collect()), name
            assert (out.count() > 0) == bool(some), name
            docs = out
