"""A corpus pipeline over ``documents``: each stage applies one operator to all that the last one kept.

Every stage but the last returns the columns of its documents; each result is written as
Parquet in the shared folder and read back as the next stage's documents.  Classifiers are
trained inside a stage on what the stage may see: the quality labels of ``sf_dir``, or the stage's
own documents.  Null and empty texts, repeated rows, extra columns and empty tables are handled as the
operators' docstrings say: a wordless document is judged by the quality classifier like any other,
links with no document, holds no secret, has no words to take (the mix drops it) and so
never reaches the encoder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stationlake.llm import bpe_automaton, mixing, quality_fm, secrets, trie_join
from stationlake.llm.common import read, staged


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality classifier rejects (score below 0.5)."""
    return quality_fm.keep_good(docs, quality_fm.train(docs, read(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the least id of each group of linked documents."""
    return trie_join.keep_one(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every secret in the texts; clean texts stay as they are."""
    return secrets.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draw the sources to their target weights: documents repeat as often as they are drawn."""
    return mixing.mix(docs, shard=None)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every drawn document."""
    return bpe_automaton.encode_documents(docs)


STAGES = [("quality classifier", quality), ("n-gram jaccard join", near_duplicates), ("secret scans", secret_scan),
          ("mixing sources", mixture), ("bpe encoding", encoding)]

#: A trained classifier decides in the first stage, which SQL cannot express: tests/llm holds the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after the other, each written as Parquet and read back."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
