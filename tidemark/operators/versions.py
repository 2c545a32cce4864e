"""Business-version fingerprints and the processed-version set.

A version is ``(opportunity_id, fingerprint)``. The processed set is history
(A->B->A stays processed), appended insert-or-ignore.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import clock_column

from tidemark.functions.ids import canonical_text
from tidemark.plans.policy import FINGERPRINT_COLUMNS

VERSION_KEYS = ["opportunity_id", "fingerprint"]


def fingerprint_expr(columns: Sequence[str] = FINGERPRINT_COLUMNS) -> Column:
    """SHA-256 hex over length-prefixed, NULL-marked fields in name order.

    Typed values hash by value (100000 and 100000.0 are the same double);
    source-only columns (``source_*``, stage, raw) are not included, so
    changing them never triggers reprocessing.
    """
    return F.sha2(canonical_text(sorted(columns)), 256)


def with_fingerprint(deals: DataFrame, columns: Sequence[str] = FINGERPRINT_COLUMNS) -> DataFrame:
    return deals.withColumn("fingerprint", fingerprint_expr(columns))


def drop_processed(versions: DataFrame, processed: DataFrame) -> DataFrame:
    """Rows whose version is not yet processed (NOT EXISTS as an anti join).

    Both sides can be large: the join is left to AQE (shuffle join, split when
    a hot key skews a partition, broadcast only from measured sizes).
    """
    return versions.join(processed.select(*VERSION_KEYS), VERSION_KEYS, "left_anti")


def flag_processed(versions: DataFrame, processed: DataFrame) -> DataFrame:
    """Adds ``already_processed`` instead of dropping (semi join + flag)."""
    seen = processed.select(*VERSION_KEYS).dropDuplicates(VERSION_KEYS).withColumn(
        "already_processed", F.lit(True))
    return versions.join(seen, VERSION_KEYS, "left").withColumn(
        "already_processed", F.coalesce(F.col("already_processed"), F.lit(False)))


def new_processed(processed: DataFrame, done: DataFrame, run_clock) -> DataFrame:
    """Rows to append so ``processed ∪ done`` holds each version once.

    Versions are de-duplicated with a partial aggregate before the shuffle;
    ``processed_at`` is the run clock (stable under recomputation).
    """
    fresh = done.select(*VERSION_KEYS).dropDuplicates(VERSION_KEYS)
    return fresh.join(processed.select(*VERSION_KEYS), VERSION_KEYS, "left_anti").withColumn(
        "processed_at", clock_column(run_clock))
