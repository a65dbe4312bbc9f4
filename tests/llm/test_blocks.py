"""Blocks follow the size of the text, and results don't depend on their number."""

import test_line_dedup
import test_ngram_join
import test_substring_dedup

from framewise.llm import common, line_dedup, ngram_join, substring_dedup


def test_number(spark):
    partitions = common.n_blocks(spark)
    assert common.blocks_for(spark, None) == common.blocks_for(spark, 1000) == partitions
    assert common.blocks_for(spark, common.BLOCK_BYTES * (partitions + 3) + 1) == partitions + 4
    docs = spark.createDataFrame([(1, "aé"), (2, None), (None, ""), (4, "x" * 50)], "doc_id long, text string")
    assert common.text_bytes(docs) == 53 and common.text_bytes(docs.limit(0)) is None


def test_more_blocks_than_partitions(spark, monkeypatch):
    monkeypatch.setattr(common, "BLOCK_BYTES", 400)
    lines = test_line_dedup.corpus(3, 30)
    assert common.blocks_for(spark, sum(len(r[1] or "") for r in lines)) > common.n_blocks(spark)
    got = line_dedup.digests(spark.createDataFrame([r[:2] for r in lines], "doc_id long, text string")).collect()
    assert sorted((tuple(r) for r in got), key=str) == test_line_dedup.brute([r[:2] for r in lines])
    near = test_ngram_join.corpus(4, 60)
    got = ngram_join.join(spark.createDataFrame(near, "doc_id long, text string")).collect()
    assert sorted((tuple(r) for r in got), key=str) == test_ngram_join.brute(near)
    rows = [(i, " ".join(f"w{(i * 7 + k) % 90}" for k in range(60))) for i in range(40)]
    got = substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), 20).collect()
    assert sorted(tuple(r) for r in got) == test_substring_dedup.brute(rows, 20)
