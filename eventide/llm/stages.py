"""The corpus pipeline's stages: (spark, docs, sf_dir) -> documents, the last one packed pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import icws, mixing as mix, packing as pack, secrets as scan, toxicity as tox
from .common import table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that score as toxic; the model is fitted on the documents that came in."""
    return tox.clean(docs, tox.fit(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate group, the one with the smallest doc_id."""
    return icws.deduplicated(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces found secrets in the texts; every document stays."""
    return scan.redact(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents (a Poisson draw, which can be 0) so that all sources weigh the same, shuffled."""
    names = docs.columns
    return mix.replicate(docs).select(*names)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all copies; pieces as the packing query returns them."""
    pieces = pack.pack(docs)
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
