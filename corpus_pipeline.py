"""From raw documents to packed sequences: language, near copies, repeated passages, leaks, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripmill.llm import stages
from tripmill.llm.common import stored, table

STAGES = [
    ("language", stages.language_stage),
    ("simhash", stages.simhash_stage),
    ("substring", stages.substring_stage),
    ("decontamination", stages.decontamination_stage),
    ("packing", stages.packing_stage),
]

#: SQL has neither the learned models nor the hashes of these stages; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
