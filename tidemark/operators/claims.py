"""One request per opportunity, enforced as requests are written.

Each batch of requests claims its opportunities. The least ``(claimed_at,
request_id)`` ever seen holds the claim, so the holders are the same however the
requests are split into batches; a request that comes later but is earlier takes
the claim over. Whoever does not hold it is a conflict, kept whole and given out
with the holder's id.

Two sinks with a directory per batch (overwritten when a batch is replayed, and a
batch reads only those before it): ``claims`` gets the batch's least request of an
opportunity where it beats the stored one, ``conflicts`` the batch's other requests
and the holders that it displaced. A batch reads the stored claims of its own
opportunities; the least request is a partial aggregate, so an opportunity with a
third of all requests sends one row per task, and the join back to the requests is
an equi join that AQE splits where it is skewed.

Defined cases: a request without an id, a time or an opportunity cannot claim and is
a conflict with no holder; a request sent again counts once in ``conflicts``; equal
times go to the lesser id as text.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import cut_lineage
from tidemark.streaming.lifecycle_state import stored_updates

SCHEMA = "opportunity_id string, request_id string, claimed_at timestamp"
FIELDS = ("opportunity_id", "request_id", "claimed_at")


def _stored(spark: SparkSession, root: str, sink: str) -> DataFrame:
    return stored_updates(spark, os.path.join(root, sink), f"{SCHEMA}, batch_id long")


def _least(rows: DataFrame) -> DataFrame:
    """The holder of every opportunity: ``opportunity_id, holder`` (time, id)."""
    return rows.groupBy("opportunity_id").agg(F.min(F.struct("claimed_at", "request_id")).alias("holder"))


def claim(requests: DataFrame, root: str, batch_id: int) -> None:
    """Write one batch of ``opportunity_id, request_id, claimed_at``."""
    spark = requests.sparkSession
    batch = cut_lineage(requests.select(*FIELDS), "claims-batch")  # read three times, the source once
    can = F.col("opportunity_id").isNotNull() & F.col("request_id").isNotNull() & F.col("claimed_at").isNotNull()
    able = batch.where(can)
    before = _stored(spark, root, "claims").where(F.col("batch_id") < batch_id)
    before = before.join(able.select("opportunity_id").distinct(), "opportunity_id", "left_semi")
    old = _least(before).withColumnRenamed("holder", "old")
    now = cut_lineage(
        _least(able).join(old, "opportunity_id", "left").select(
            "opportunity_id", "old", F.least("holder", "old").alias("holder")), "claims-holders")
    taken = now.where(F.col("old").isNull() | (F.col("holder") < F.col("old")))
    lost = able.join(now.select("opportunity_id", "holder"), "opportunity_id").where(
        F.col("request_id") != F.col("holder.request_id")).select(*FIELDS)
    displaced = taken.where(F.col("old").isNotNull() & (F.col("old.request_id") != F.col("holder.request_id"))).select(
        "opportunity_id", F.col("old.request_id").alias("request_id"), F.col("old.claimed_at").alias("claimed_at"))
    conflicts = lost.unionByName(displaced).unionByName(batch.where(~can))
    conflicts.write.mode("overwrite").parquet(os.path.join(root, "conflicts", f"batch_id={batch_id}"))
    # claims last: they are what later batches read
    taken.select("opportunity_id", F.col("holder.request_id").alias("request_id"), F.col("holder.claimed_at").alias("claimed_at")).write.mode(
        "overwrite").parquet(os.path.join(root, "claims", f"batch_id={batch_id}"))


def holders(spark: SparkSession, root: str) -> DataFrame:
    """``opportunity_id, request_id, claimed_at`` of the request that holds each opportunity."""
    return _least(_stored(spark, root, "claims")).select(
        "opportunity_id", F.col("holder.request_id").alias("request_id"), F.col("holder.claimed_at").alias("claimed_at"))


def conflicts(spark: SparkSession, root: str) -> DataFrame:
    """Every request that does not hold its opportunity, once, with ``held_by``."""
    told = _stored(spark, root, "conflicts").select(*FIELDS).distinct()
    held = holders(spark, root).select("opportunity_id", F.col("request_id").alias("held_by"))
    return told.join(held, "opportunity_id", "left").select(
        *FIELDS, F.when(F.col("request_id").isNotNull() & F.col("claimed_at").isNotNull(), F.col("held_by")).alias("held_by")
    ).where(F.col("held_by").isNull() | (F.col("held_by") != F.col("request_id")))
