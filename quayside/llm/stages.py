"""Stages of the corpus pipeline: each takes (spark, docs, sf_dir) and works on all rows of ``docs``.

All but the last return the columns of ``docs``, whatever they are, in order. Documents are told apart by ``doc_id``; empty
tables stay empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import decontaminate, ngram_join, packing, substring_dedup, toxicity
from quayside.llm.common import table
from quayside.llm.queries import vocabulary_path
from quayside.session import prepare_session


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the threshold; the machine is fitted on the labelled ones among ``docs``."""
    prepare_session(spark)
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"), ~toxicity.held_out())
    names = {c: f"_in{i}" for i, c in enumerate(docs.columns)}
    scored = toxicity.score_toxicity(docs.withColumnsRenamed(names), model, names["text"])
    return scored.where(F.col("predicted") == 0).select(*(F.col(n).alias(c) for c, n in names.items()))


def ngram_join_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of linked ones."""
    prepare_session(spark)
    return ngram_join.keep_representatives(docs)


def substring_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document has; documents of which nothing is left go."""
    prepare_session(spark)
    return substring_dedup.remove_repeats(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without benchmark passages; documents that are mostly such passages go."""
    prepare_session(spark)
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed pieces of all texts."""
    prepare_session(spark)
    return packing.pack_texts(docs, vocabulary_path())
