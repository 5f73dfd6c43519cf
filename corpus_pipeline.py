"""The text operators in a row over ``documents``: each stage's table is stored and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quayside.llm import stages
from quayside.llm.common import table, written
from quayside.session import prepare_session

STAGES = [
    ("toxicity", stages.toxicity_stage),
    ("ngram_join", stages.ngram_join_stage),
    ("substring_dedup", stages.substring_dedup_stage),
    ("decontamination", stages.decontamination_stage),
    ("packing", stages.packing_stage),
]

# A learned score and a tokenizer cannot be expressed in SQL; tests hold the stages against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per packed piece of what the filtering stages keep of ``documents``."""
    prepare_session(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
