"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import cut_lineage

# ASCII white space: everything else is part of a word.
SPACES = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the cluster's shared folder: computed once, and
    read again instead of recomputed when an executor is lost."""
    return cut_lineage(df, f"llm-{name}")


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in ``text``; null: 0."""
    bare = F.btrim(text, F.lit(SPACES))
    return F.coalesce(
        F.when(bare == "", 0).otherwise(F.size(F.split(bare, "[ \\t-\\r]+"))), F.lit(0)
    ).cast("long")
