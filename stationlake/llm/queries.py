"""The registered queries: one thin ``opN_<name>`` an operator, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stationlake.llm import (bpe_automaton, gru_lm, html_crf, mixing, prefix_trie, quality_fm, quality_rules, secrets, setm, topk,
                             trie_join, url_filter, wavelet)
from stationlake.llm.common import read


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(read(spark, sf_dir, "documents"))


def op2_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.binary_output(read(spark, sf_dir, "documents"))


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gru_lm.score_documents(read(spark, sf_dir, "documents"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_fm.score_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_join.near_duplicates(read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(read(spark, sf_dir, "pages"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    # alone in its workers, the operator has room for larger tables than next to the pipeline's other stages
    return bpe_automaton.encode_documents(read(spark, sf_dir, "documents"), max_states=250_000, max_chunks=200_000)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(read(spark, sf_dir, "documents")).drop("shards")  # the twin in SQL has no tree


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read(spark, sf_dir, "embeddings"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_rules(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_crf.extract(read(spark, sf_dir, "pages"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(read(spark, sf_dir, "conversations"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setm.collocations(read(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_secrets, op2_token_ids, op3_lm_score, op4_quality_classifier, op5_jaccard_join, op6_url_filters, op7_bpe, op8_mixing, op9_topk,
    op10_quality_rules, op11_html_extraction, op12_prefix_trie, op13_collocations)}


def oracle_sql() -> dict[str, str]:
    return {"op6_url_filters": url_filter.oracle(), "op8_mixing": mixing.oracle(),
            "op9_topk": topk.oracle(), "op12_prefix_trie": prefix_trie.oracle(), "op13_collocations": setm.oracle()}
