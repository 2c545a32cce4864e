"""The event log laid out for lookups by request.

Each batch of events is written by bucket of the request id (a folder per bucket)
and sorted by request within its files, so a lookup reads the folders of its ids
only, and in them the row groups whose least and greatest id can hold one. Rows are
dealt out by range of (bucket, request, number): a request with a third of all
events is cut over several files, and no task takes a bucket whole.

A batch has its own folder and is overwritten when it is written again. The number
of buckets is the log's: it is part of the path, so that a reader cannot mistake it.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64
LISTED_IDS = 1000  # looked up as a list in the filter; more are joined


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("request_id"), F.lit(buckets)).cast("int")


def _root(root: str, buckets: int) -> str:
    return os.path.join(root, f"buckets-{buckets}")


def append(events: DataFrame, root: str, batch_id: int, buckets: int = BUCKETS) -> None:
    """Write one batch of events (``request_id, event_seq, ...``)."""
    order = ["bucket", "request_id", "event_seq"]
    rows = events.withColumn("bucket", _bucket(buckets)).repartitionByRange(*order).sortWithinPartitions(*order)
    rows.write.mode("overwrite").partitionBy("bucket").parquet(
        os.path.join(_root(root, buckets), f"batch_id={batch_id}"), compression="zstd")  # ids are digests


def read(spark: SparkSession, root: str, buckets: int = BUCKETS) -> DataFrame:
    return spark.read.parquet(_root(root, buckets))


def history(spark: SparkSession, root: str, request_ids: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """All events of the requests named in ``request_ids``, each once.

    Up to ``LISTED_IDS`` ids become a filter on bucket and id, which Spark pushes
    into the scan: folders and row groups are pruned. More are an equi join on both,
    where Spark prunes folders at run time if the ids are small enough to be sent."""
    log = read(spark, root, buckets).drop("batch_id")
    ids = request_ids.select("request_id").where("request_id IS NOT NULL").distinct()
    listed = ids.withColumn("bucket", _bucket(buckets)).limit(LISTED_IDS + 1).collect()
    if len(listed) <= LISTED_IDS:
        found = log.where(F.col("bucket").isin(sorted({r.bucket for r in listed})) & F.col("request_id").isin([r.request_id for r in listed]))
    else:
        found = log.join(ids.withColumn("bucket", _bucket(buckets)), ["bucket", "request_id"], "left_semi")
    return found.drop("bucket")
