"""A training-data pipeline over ``documents``: quality rules, toxicity, near duplicates,
benchmark decontamination, BPE encoding. Every stage works on all its predecessor kept.

Stages decide about *rows*, not ids. Where a decision has to come back from an operator that works on ids, a
row is known by a hash of its id and text. Defined cases: null and empty texts fail the quality rules and go
there; rows with a null ``doc_id`` are rows like others; of rows that share an id each one is judged by its own
text, so copies under one id leave one row and other texts of that id stay; identical rows (id and text) are
copies too; of a group of near duplicates the row with the smallest id stays (null ids last; of equal ids the one
whose hash is smallest); columns beside ``doc_id`` and ``text`` pass through, whatever their names; texts of any
length are read whole; an empty table gives an empty one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keysweep.llm.bpe_transducer import token_digests
from keysweep.llm.common import written
from keysweep.llm.decontamination import contaminated
from keysweep.llm.ngram_join import near_duplicates
from keysweep.llm.quality_rules import filter_quality
from keysweep.llm.toxicity import filter_toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the learned decision list keep."""
    return filter_quality(docs, _table(spark, sf_dir, "labels"))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below 0.7."""
    return filter_toxicity(docs, _table(spark, sf_dir, "labels"))


def _row() -> Column:
    """What a row is known by. Two different rows with one value do no harm: see the stages."""
    return F.xxhash64("doc_id", "text")


def _free(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, the one with the smallest id. (Of two rows that share a hash value
    both stay if one does, so no row without duplicates is lost.)"""
    row, copies = _free(docs, "row_of"), _free(docs, "copies_of")
    found = near_duplicates(docs.select(_row().alias("doc_id"), "text")).select(F.col("doc_id").alias(row), "component_id").distinct()
    named = docs.select(_row().alias(row), "doc_id").groupBy(row).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias(copies))
    least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", row, copies)).alias("least")
    keep = written(found.join(named, row).groupBy("component_id").agg(least).select(f"least.{row}", f"least.{copies}"), "kept-rows")
    once, more = keep.filter(F.col(copies) == 1).select(row), keep.filter(F.col(copies) > 1).select(row)
    kept = docs.join(once, _row() == F.col(row), "left_semi")
    if more.isEmpty():
        return kept
    return kept.unionByName(docs.join(more, _row() == F.col(row), "left_semi").dropDuplicates(["doc_id", "text"]))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a benchmark passage. (A row goes only if both its hash and its id are those of a row with one.)"""
    row, of_id = _free(docs, "row_of"), _free(docs, "id_of")
    hit = contaminated(docs.select(_row().alias("doc_id"), "text"), _table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias(row)).distinct()
    hit = written(docs.select(_row().alias(row), F.col("doc_id").alias(of_id)).join(hit, row).distinct(), "contaminated-rows")
    return docs.join(hit, (_row() == F.col(row)) & F.col("doc_id").eqNullSafe(F.col(of_id)), "left_anti")


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the documents that are left."""
    return token_digests(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality rules", quality_rules), ("toxicity", toxicity), ("n-gram Jaccard join", ngram_join), ("benchmark decontamination", decontamination), ("BPE encoding and decoding", bpe)]

#: The learned stages have no SQL form; tests/llm compares them with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, f"stage{i}")
    return docs
