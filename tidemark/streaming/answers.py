"""D3 / Q15: the outbox joined with the gateway's answers as two streams.

A left outer stream-stream join: an answer belongs to the request it names when it
comes within ``within`` of the sending. Both sides carry a watermark, so a request's
row leaves Spark's state as soon as no answer can reach it any more; one without an
answer comes out then, once, as PENDING. An answer that comes after the bound finds
no request and settles nothing. A row whose request id is empty is a heartbeat: it
moves its side's watermark and is not given out (nor is one with a null id, but the
join filters null ids of the answers before their watermark sees them).

The state is what the bound keeps open, partitioned by request id; both sides are
shuffled on it as in a batch join. Of several answers to one request the earliest
counts (``first_answers``), as a partial aggregate over the sink.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import submission as S
from tidemark.plans import policy as P
from tidemark.streaming.incremental import run_id

OUTBOX_SCHEMA = "request_id string, sent_at timestamp"
ANSWERS_SCHEMA = "request_id string, status_code int, body string, answered_at timestamp"


def answered(outbox: DataFrame, answers: DataFrame, within: str = "7 DAYS", lateness: str = "1 DAY") -> DataFrame:
    """``request_id, sent_at`` with ``status_code, body, answered_at`` (null: none came in time)."""
    sent = outbox.select("request_id", "sent_at").withWatermark("sent_at", lateness)
    came = answers.select(
        F.col("request_id").alias("answer_to"), "status_code", "body", "answered_at"
    ).withWatermark("answered_at", lateness)
    fits = F.expr(f"request_id = answer_to AND answered_at >= sent_at AND answered_at <= sent_at + INTERVAL {within}")
    return sent.join(came, fits, "left_outer").drop("answer_to")


def first_answers(joined: DataFrame) -> DataFrame:
    """One row per request: its earliest answer, if any."""
    order = F.struct(F.col("answered_at").isNull(), "answered_at", "status_code", "body")
    rows = joined.groupBy("request_id").agg(F.min_by(F.struct("status_code", "body", "answered_at"), order).alias("a"))
    return rows.select("request_id", "a.*")


def outcomes(joined: DataFrame) -> DataFrame:
    """``request_id, outcome, registration_number, error`` of every sent request."""
    first = first_answers(joined)
    told = S.classify_answers(first.where("answered_at IS NOT NULL"))
    has_number = F.coalesce(F.col("registration_number") != "", F.lit(False))
    outcome = (F.when(~F.col("accepted"), F.lit(P.SUBMISSION_FAILED))
               .when(has_number, F.lit(P.REGISTERED)).otherwise(F.lit(P.SUBMISSION_UNKNOWN)))
    done = told.select("request_id", outcome.alias("outcome"), "registration_number",
                       F.when(~F.col("accepted"), F.col("message")).alias("error"))
    none = F.lit(None).cast("string")
    open_ = first.where("answered_at IS NULL").select(
        "request_id", F.lit(S.OUTCOME_PENDING).alias("outcome"), none.alias("registration_number"), none.alias("error"))
    return done.unionByName(open_)


def run_answers(spark: SparkSession, outbox_dir: str, answers_dir: str, root: str,
                within: str = "7 DAYS", lateness: str = "1 DAY") -> str:
    """Join what has landed on both sides since the last call with this ``root``; returns the sink.

    A batch's rows go to their own directory of the checkpoint's run, overwritten on replay."""
    checkpoint, sink = os.path.join(root, "checkpoint"), os.path.join(root, "answered")
    runs: list[str] = []

    def write(rows: DataFrame, batch_id: int) -> None:
        if not runs:
            runs.append(run_id(spark, checkpoint))
        rows.where("request_id <> ''").write.mode("overwrite").parquet(
            os.path.join(sink, f"run=r{runs[0]}", f"batch_id={batch_id}"))

    sent = spark.readStream.schema(OUTBOX_SCHEMA).parquet(outbox_dir)
    came = spark.readStream.schema(ANSWERS_SCHEMA).parquet(answers_dir)
    q = (answered(sent, came, within, lateness).writeStream.outputMode("append").foreachBatch(write)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return sink
