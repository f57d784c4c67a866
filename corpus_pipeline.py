"""A corpus pipeline of five stages over ``documents``.

Quality classifier, near-duplicates, benchmark decontamination, mixing, training order.
Each stage works on all that the one before kept; it is written and read again between.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lipika.llm import decontaminate, mixing, near_dup, quality_rules, training_order
from lipika.llm._common import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the rule ensemble, learned from ``labels``, scores below its threshold."""
    return quality_rules.good_documents(docs, quality_rules.train(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each class, by five words at 0.8."""
    return near_dup.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item, by five words at 0.8."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each source's budget of words, repeating documents where it exceeds the source."""
    return mixing.mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of token ids at their slots of the training order, written as shards."""
    return training_order.shards_written(docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("mix", mix), ("token_ids", token_ids)]

#: The classifier and the tokenizer are beyond SQL; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
