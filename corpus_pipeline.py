"""The corpus pipeline: toxicity, near-duplicates, secrets, mixing, packing.

Every stage works on all that its predecessor kept; its result is written as
Parquet and read again as the next stage's ``docs``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from eventide.llm import stages
from eventide.llm.common import table, write_work

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", stages.toxicity),
    ("near_dedup", stages.near_dedup),
    ("secrets", stages.secrets),
    ("mixing", stages.mixing),
    ("packing", stages.packing),
]

# A trained classifier and a tokenizer are not SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs, _ = write_work(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
