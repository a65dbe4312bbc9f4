"""The corpus pipeline: toxicity, line dedup, n-gram Jaccard join, mixing, SentencePiece.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its rows are written as Parquet and read again as the next
stage's docs. All stages but the last return the columns of documents, whatever further ones there are and whatever their
names. An empty table gives an empty result in every stage, and texts are taken whole, whatever their length."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from framewise.llm import line_dedup, mixing, ngram_join, sentencepiece_bpe, toxicity
from framewise.llm.common import stash
from framewise.llm.queries import piece_model


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go. Null and empty texts have no insult and stay; repeated rows share their verdict; a null
    doc_id teaches nothing but is judged; a score that ties with the threshold is toxic."""
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier one go; a document all of whose lines repeat goes, one without lines stays. Rows of one
    doc_id are one document, whose equal places don't remove each other; null doc_ids come last; of equal lines the one with
    the smallest doc_id and place stays."""
    return line_dedup.dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked documents the one with the smallest doc_id stays, with all rows of that id. Null and empty texts and null
    doc_ids stay."""
    return ngram_join.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, up to three times. The null source is a source of its own; null and empty
    texts have size 0 and go with their source's whole repetitions; equal rows are taken alike."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row; null text counts as empty, null doc_ids and repeated rows are
    coded each."""
    return sentencepiece_bpe.digests(docs, piece_model())


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_join", drop_near_copies),
    ("mixing", mix),
    ("sentencepiece", encode),
]

#: The learned score, the tokenizer and the hash-ordered mix have no SQL; tests/llm/test_pipeline.py is the reference.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
