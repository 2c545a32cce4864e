"""Sinks for the pipeline's tables (A7-A10): plain Spark writes.

- events: append-only, partitioned by event date (date filters prune files);
- request changes: append-only change rows (the current state is a view);
- processed versions: insert-or-ignore (anti join against what is stored);
- marks: each commit writes a new snapshot directory; readers take the
  newest, so a reader never sees a half-written table and a path being read
  is never overwritten.

Writers for one batch target their own ``batch_id`` so a retried batch
replaces, not duplicates, its rows.
"""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.versions import VERSION_KEYS


def _batch_path(root: str, batch_id: int | None) -> str:
    return root if batch_id is None else os.path.join(root, f"batch_id={batch_id}")


def append_events(events: DataFrame, root: str, batch_id: int | None = None) -> None:
    """Append events, partitioned by ``event_date`` of ``occurred_at``."""
    out = events.withColumn("event_date", F.to_date("occurred_at"))
    mode = "append" if batch_id is None else "overwrite"
    out.write.mode(mode).partitionBy("event_date").parquet(_batch_path(root, batch_id))


def append_changes(changes: DataFrame, root: str, batch_id: int | None = None) -> None:
    """A8 storage: request change rows (``latest_requests`` reads the view)."""
    mode = "append" if batch_id is None else "overwrite"
    changes.write.mode(mode).parquet(_batch_path(root, batch_id))


def read_table(spark: SparkSession, root: str, schema=None) -> DataFrame | None:
    try:
        reader = spark.read if schema is None else spark.read.schema(schema)
        df = reader.parquet(root)
        df.schema
        return df
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def append_processed(done: DataFrame, root: str, run_clock, batch_id: int | None = None) -> DataFrame:
    """Insert-or-ignore of ``(opportunity_id, fingerprint)`` rows; returns what was added."""
    from tidemark.operators.versions import new_processed

    spark = done.sparkSession
    stored = read_table(spark, root)
    if stored is None:
        stored = spark.createDataFrame([], "opportunity_id string, fingerprint string")
    elif batch_id is not None and "batch_id" in stored.columns:
        stored = stored.where(F.col("batch_id") != batch_id)
    added = new_processed(stored.select(*VERSION_KEYS), done, run_clock)
    mode = "append" if batch_id is None else "overwrite"
    added.write.mode(mode).parquet(_batch_path(root, batch_id))
    return added


def commit_marks(new_marks: DataFrame, root: str, snapshot: int) -> str:
    """A10: write the new ``(source, watermark)`` snapshot as its own directory."""
    path = os.path.join(root, f"snapshot={snapshot:012d}")
    new_marks.write.mode("overwrite").parquet(path)
    return path


def read_marks(spark: SparkSession, root: str) -> DataFrame:
    """The newest committed snapshot (empty before the first commit)."""
    df = read_table(spark, root)
    if df is None:
        return spark.createDataFrame([], "source string, watermark timestamp")
    latest = df.agg(F.max("snapshot")).collect()[0][0]
    return df.where(F.col("snapshot") == latest).drop("snapshot")


def get_requests(latest: DataFrame, request_ids: DataFrame) -> DataFrame:
    """Current rows for a set of ids (0 or 1 row each), as a semi join."""
    return latest.join(request_ids.select("request_id").dropDuplicates(), "request_id", "left_semi")
