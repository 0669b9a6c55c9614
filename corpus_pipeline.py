"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; all but the last
return the columns of documents. run() writes a stage's result as a table in the shared folder and the
next stage reads that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vigilo.llm import decontaminate, lang_id, near_dup, packing, quality
from vigilo.llm.common import table
from vigilo.session import stage


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling draws; the others go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose words' languages are known, one or several; those without letters, or of unclear words, go."""
    return lang_id.keep_identified(docs)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one of the smallest id."""
    return near_dup.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return decontaminate.drop_leaked(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the remaining documents, with their sequences and places."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("language id", language_id),
    ("minhash near-dedup", minhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("best-fit packing", best_fit_packing),
]

#: The classifiers and the tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stage(docs, name.replace(" ", "-"))
    return docs
