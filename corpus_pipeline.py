"""The corpus pipeline: five stages over ``documents``, each written and read again.

Quality rules drop what they reject, near-duplicate groups keep one document,
secrets are masked in the text, sources are mixed to their targets (a document
stands as often as the mix takes it), and the last stage gives the tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import mix_sources, quality_gbt, secret_battery, simhash_tiles
from tidemark.llm.common import table, written
from tidemark.llm.queries import bpe_digests


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_gbt.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_tiles.drop_near_duplicates(docs, shingle=3, radius=2)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    masked = secret_battery.redact(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_sources.mixed(docs)


def bpe_codec(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe_digests(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("source_mix", source_mix),
    ("bpe_codec", bpe_codec),
]

# SQL can express neither the fitted trees of the first stage nor the merges of the last
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, applied to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
