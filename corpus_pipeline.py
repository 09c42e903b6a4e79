"""Corpus pipeline: toxicity, exact dedup, near-duplicate join, mixing, tokenisation.

Every stage takes (spark, docs, sf_dir) and decides on all rows its predecessor
kept; the frame it returns is written as Parquet and read again for the next.
All but the last return the columns of ``documents``.

A row is known by its doc_id and text: rows that repeat a doc_id on different texts
go or stay by themselves, and of rows equal in both one stays.  Exact copies go
also where they have no doc_id; the near-duplicate stage keeps rows without one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm import bpe, exact_dedup, mixing, ngram_join, registry, toxicity
from wardline.llm.common import Scratch

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

#: The stages train, sample and compare, which SQL does not express; tests hold run() against a brute-force version.
ORACLE_SQL = None


def with_hash(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS, F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """``docs`` without the rows whose doc_id and text are those of ``dropped`` (doc_id, text_hash)."""
    gone = dropped.select(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash"))
    same = F.col("doc_id").eqNullSafe(F.col("gone_id")) & (F.col("text_hash") == F.col("gone_hash"))
    return with_hash(docs).join(gone, same, "left_anti").select(*COLUMNS)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model does not call toxic."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, registry.table(spark, sf_dir, "labels")), COLUMNS)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of equal texts."""
    rows = exact_dedup.exact_dedup(docs).groupBy("doc_id", "text_hash").agg(
        F.max("kept").alias("stays"), F.count(F.lit(1)).alias("n"))
    rows = Scratch(spark, "distinct").keep(rows, "rows", repeated=F.count_if(F.col("stays") & (F.col("n") > 1)))
    if not rows.measured["repeated"]:
        return without(docs, rows.where("not stays"))
    # rows that are equal in doc_id and text: one of them, the others as above
    once = without(docs, rows.where("not stays or n > 1"))
    again = without(docs, rows.where("not stays or n = 1"))
    return once.unionByName(with_hash(again).dropDuplicates(["doc_id", "text_hash"]).drop("text_hash"))


def different(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of every group of near copies (five-word shingles, 0.8)."""
    groups = ngram_join.jaccard_join(docs, words=5, percent=80)
    return without(docs, groups.where(F.col("component_id") != F.col("doc_id")))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sample whose tokens have the target marginals."""
    return mixing.keep(docs, mixing.fit(docs), COLUMNS)


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text."""
    return bpe.encode(docs, registry.WORD_BPE)


STAGES = [("toxicity", clean), ("exact_dedup", distinct), ("ngram_join", different), ("mixing", mixed),
          ("bpe", tokenised)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's rows are written to the shared folder and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = registry.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before, docs = docs, scratch.keep(stage(spark, docs, sf_dir), name)
        if hasattr(before, "_scratch"):
            scratch.drop(before)
    return docs
