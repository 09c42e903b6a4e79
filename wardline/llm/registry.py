"""Registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (bpe, chat, collocations, embedding, exact_dedup, html_extract, licenses, mixing, ngram_join, prefix_trie,
               toxicity, url_filter, warc)
from .common import registered, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {"op1_exact_dedup": exact_dedup.ORACLE, "op4_warc": warc.ORACLE,
                          "op5_tool_calls": chat.ORACLE, "op7_embedding_caps": embedding.ORACLE,
                          "op8_ngram_join": ngram_join.ORACLE,
                          "op11_url_filter": url_filter.ORACLE, "op12_collocations": collocations.ORACLE,
                          "op13_prefix_trie": prefix_trie.ORACLE}

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


@registered(QUERIES, "op1_exact_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents")).drop("text_hash")


@registered(QUERIES, "op2_mixing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing.decide(docs, mixing.fit(docs))


@registered(QUERIES, "op3_html_extract")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


@registered(QUERIES, "op4_warc")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


@registered(QUERIES, "op5_tool_calls")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.link(*chat.from_conversations(table(spark, sf_dir, "conversations")))


@registered(QUERIES, "op6_toxicity")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.severity(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@registered(QUERIES, "op7_embedding_caps")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding.near_duplicates(table(spark, sf_dir, "embeddings"))


@registered(QUERIES, "op8_ngram_join")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_join(table(spark, sf_dir, "documents")).drop("text_hash")


@registered(QUERIES, "op9_licenses")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return licenses.scan(docs, licenses.build_index(docs)).drop("spans")


@registered(QUERIES, "op10_bpe")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"), WORD_BPE)


@registered(QUERIES, "op11_url_filter")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


@registered(QUERIES, "op12_collocations")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


@registered(QUERIES, "op13_prefix_trie")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))
