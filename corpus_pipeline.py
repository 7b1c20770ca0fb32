"""The corpus pipeline: toxic documents go, one of each group of near copies stays, documents
with benchmark items go, secrets are redacted, and what is left is packed into sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
read again as the next one's docs.  All but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pitlake.llm import decontamination, near_dedup, packing, secrets, toxicity
from pitlake.llm.common import Scratch, few, table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return few(toxicity.without_toxic(docs, table(spark, sf_dir, "labels")))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return few(near_dedup.one_of_each(docs))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return few(decontamination.without_contaminated(docs, table(spark, sf_dir, "benchmark")))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return few(secrets.redact(docs))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return few(packing.pack(docs))


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secrets_stage),
    ("packing", packing_stage),
]

#: SQL can't express the learned and tokenizing stages; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.stage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
