"""Catalogue: streaming twins of batch queries.

Each query lands a Spark-derived copy of a driver table as several files
under the shared checkpoint folder, drains it with an ``availableNow``
stream, and returns the sink read back; its oracle is the batch twin's SQL.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.plans.catalog import POLICY, register, rules_sql
from tidemark.plans.catalog_lifecycle import SQL_FOLD
from tidemark.operators import submission as S
from tidemark.plans.catalog_records import SQL_FLAT_DEALS
from tidemark.plans.catalog_submission import SQL_ATTEMPTS
from tidemark.session import scratch_path
from tidemark.sources import testdata as T
from tidemark.streaming import answers, event_order, incremental, lifecycle_state

LANDING_FILES = 4


def land(df, path: str, by, files: int = LANDING_FILES) -> str:
    """Write ``df`` as so many files, rows of one ``by`` value together."""
    df.repartition(files, by).write.mode("overwrite").parquet(path)
    return path


def landing_scale(spark) -> int:
    """How many files stand for one: every core writes and reads some, so a landing
    takes as long as its rows ask for, not as its largest file does."""
    return spark.sparkContext.defaultParallelism


@register("stream_incremental", f"""
WITH {rules_sql(SQL_FLAT_DEALS)}
SELECT opportunity_id, status, nullif(errors_text, '') AS error FROM evaluated""")
def q_stream_incremental(spark, sf_dir):
    run = uuid.uuid4().hex[:12]
    src = T.flat_source(spark, sf_dir)
    scale = landing_scale(spark)
    landing = land(src, scratch_path(spark, "landing", run, "flat"), "Opportunity_ID", LANDING_FILES * scale)
    sinks = incremental.run_incremental(
        spark, landing, scratch_path(spark, "incremental", run, "sinks"),
        scratch_path(spark, "incremental", run, "checkpoint"), POLICY,
        files_per_trigger=2 * scale, schema=src.schema)
    changes = incremental.read_sink(spark, sinks.changes)
    return changes.select("opportunity_id", "status", "error")


@register("stream_incremental_restart", f"""
WITH {rules_sql(SQL_FLAT_DEALS)}
SELECT opportunity_id, status, nullif(errors_text, '') AS error FROM evaluated""")
def q_stream_incremental_restart(spark, sf_dir):
    """Half of the source is drained, the rest lands with some records sent
    again, and a new checkpoint with another trigger size starts over on the
    same sinks: every version comes out once."""
    run = uuid.uuid4().hex[:12]
    src = T.flat_source(spark, sf_dir)
    landing, sinks_root = (scratch_path(spark, "restart", run, d) for d in ("landing", "sinks"))
    scale = landing_scale(spark)
    part = F.pmod(F.xxhash64("Opportunity_ID"), F.lit(6))
    for i, rows in enumerate((src.where(part < 3), src.where((part >= 3) | (part == 0)))):
        rows.repartition((2 + i) * scale, "Opportunity_ID").write.mode("append").parquet(landing)
        sinks = incremental.run_incremental(
            spark, landing, sinks_root, scratch_path(spark, "restart", run, f"checkpoint-{i}"), POLICY,
            files_per_trigger=(1 + i) * scale, schema=src.schema)
    return incremental.read_sink(spark, sinks.changes).select("opportunity_id", "status", "error")


@register("stream_lifecycle", f"""
WITH RECURSIVE {SQL_FOLD}
SELECT key, state AS status, moves, last_seq
FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY rn DESC) AS r FROM fold)
WHERE r = 1""")
def q_stream_lifecycle(spark, sf_dir):
    run = uuid.uuid4().hex[:12]
    cmds = T.lifecycle_commands(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    landing = land(cmds, scratch_path(spark, "landing", run, "commands"), "key")
    sink = lifecycle_state.run_lifecycle_stream(
        spark, landing, "key string, ts timestamp, seq long, target string",
        T.EVENT_TRANSITIONS, "NEW", files_per_trigger=2)
    state = lifecycle_state.current_state(spark.read.parquet(sink))
    return state.select("key", "status", "moves", "last_seq")


ARRIVALS = 4
DELAY_DAYS = 3


@register("stream_event_order", f"""
WITH RECURSIVE {SQL_FOLD},
late AS (
  SELECT concat_ws('-', CAST(user_id AS VARCHAR), strftime(ts, '%Y-%m-%d')) AS key, count(*) AS late
  FROM events WHERE event_id % 97 = 0 GROUP BY ALL
)
SELECT key, state AS status, moves, last_seq, coalesce(late, 0) AS late
FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY rn DESC) AS r FROM fold) LEFT JOIN late USING (key)
WHERE r = 1""")
def q_stream_event_order(spark, sf_dir):
    """Commands come up to three days late and out of order, so a key's commands lie
    in several landings; a heartbeat closes the log, and one in 97 comes once more."""
    root, landing = (scratch_path(spark, "event-order", uuid.uuid4().hex[:12], d) for d in ("run", "landing"))
    cmds = T.lifecycle_commands(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    seconds = F.pmod(F.xxhash64("seq"), F.lit(DELAY_DAYS * 86400))
    came = cmds.withColumn("at", F.col("ts").cast("double") + seconds)
    low, high = came.agg(F.min("at"), F.max("at")).first()
    arrival = F.least(F.floor((F.col("at") - low) * ARRIVALS / (high - low + 1)), F.lit(ARRIVALS - 1))
    slices = [came.where(arrival == i).drop("at") for i in range(ARRIVALS)]
    beat = cmds.agg(F.max("ts").alias("ts")).select(
        F.lit(None).cast("string").alias("key"), F.expr(f"ts + INTERVAL {DELAY_DAYS + 1} DAYS").alias("ts"),
        F.lit(None).cast("long").alias("seq"), F.lit(None).cast("string").alias("target"))
    for rows in (*slices, beat, cmds.where(F.col("seq") % 97 == 0)):
        rows.select("key", "ts", F.col("seq").cast("long").alias("seq"), "target").write.mode("append").parquet(landing)
        sink = event_order.run_ordered(
            spark, landing, "key string, ts timestamp, seq long, target string", T.EVENT_TRANSITIONS, "NEW", root,
            delay=f"{DELAY_DAYS} DAYS")
    state = lifecycle_state.current_state(spark.read.parquet(sink))
    late = event_order.late_commands(spark, root).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    return state.drop("late").join(late, "key", "left").select(
        "key", "status", "moves", "last_seq", F.coalesce("n", F.lit(0)).cast("long").alias("late"))


@register("stream_answers", f"""
WITH {SQL_ATTEMPTS},
sendable AS (SELECT * FROM gated WHERE status = 'APPROVED' AND NOT already),
firsts AS (SELECT opportunity_id, fingerprint, min(seq) AS s FROM sendable GROUP BY ALL),
sent AS (
  SELECT x.request_id, x.seq FROM sendable x JOIN firsts f
    ON f.opportunity_id = x.opportunity_id AND f.fingerprint = x.fingerprint AND f.s = x.seq
)
SELECT s.request_id,
       CASE WHEN c.request_id IS NULL THEN 'PENDING' WHEN NOT c.accepted THEN 'SUBMISSION_FAILED'
            WHEN coalesce(c.registration_number <> '', false) THEN 'REGISTERED' ELSE 'SUBMISSION_UNKNOWN' END AS outcome,
       c.registration_number, CASE WHEN NOT c.accepted THEN c.message END AS error
FROM sent s LEFT JOIN classified c ON c.request_id = s.request_id AND s.seq % 11 <> 0""")
def q_stream_answers(spark, sf_dir):
    """The outbox and the answers land in two parts each, many answers before the second
    part of the outbox; one answer in eleven comes after the bound. Heartbeats close both."""
    root, outbox_dir, answers_dir = (
        scratch_path(spark, "answers", uuid.uuid4().hex[:12], d) for d in ("run", "outbox", "answers"))
    key = F.col("request_id").cast("bigint")
    sent_at = F.timestamp_add("SECOND", F.pmod(key, F.lit(86400)), F.lit("2026-01-01").cast("timestamp"))
    outbox = S.build_outbox(T.attempts(spark, sf_dir), T.previous_submissions(spark, sf_dir)).select(
        "request_id", sent_at.alias("sent_at"))
    delay = F.when(key % 11 == 0, 8 * 86400).otherwise(F.pmod(F.xxhash64("request_id"), F.lit(7 * 86400)))
    came = T.raw_answers(spark, sf_dir).select(
        "request_id", "status_code", "body", F.timestamp_add("SECOND", delay, sent_at).alias("answered_at"))
    end = F.lit("2026-02-01").cast("timestamp")
    none = F.lit(None)
    beats = (spark.range(1).select(F.lit("").alias("request_id"), end.alias("sent_at")),
             spark.range(1).select(F.lit("").alias("request_id"), none.cast("int").alias("status_code"),
                                   none.cast("string").alias("body"), end.alias("answered_at")))
    # the first part stays within the lateness of the second, whatever the order of arrival
    early = F.col("answered_at") < F.lit("2026-01-02").cast("timestamp")
    parts = ((outbox.where(key % 2 == 0), came.where(early)), (outbox.where(key % 2 == 1), came.where(~early)), beats)
    for sent, told in parts:
        sent.write.mode("append").parquet(outbox_dir)
        told.write.mode("append").parquet(answers_dir)
        sink = answers.run_answers(spark, outbox_dir, answers_dir, root)
    return answers.outcomes(spark.read.parquet(sink))
