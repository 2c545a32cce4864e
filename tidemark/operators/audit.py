"""Append-only event log, request change rows and their views.

Storage model: events are append-only; request state is append-only change
rows with ``change_seq``; the current state is a view (latest row per
request). Every "latest per key" here is a ``max_by`` aggregate, which Spark
computes partially before the shuffle, so a hot request id never lands as a
whole group in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import clock_column

from tidemark.functions.ids import hash_id
from tidemark.plans import policy as P
from tidemark.operators.versions import fingerprint_expr

EVENT_COLUMNS = [
    "event_id", "request_id", "opportunity_id", "from_status", "to_status",
    "actor", "reason", "occurred_at", "event_seq",
]

REQUEST_COLUMNS = [
    "request_id", "opportunity_id", "status", "validation_errors", "approved_by", "approved_at",
    "registration_number", "submitted_at", "error", "updated_at", "change_seq", "last_event_seq",
]


def request_id_expr(opportunity_id: Column | str = "opportunity_id",
                    fingerprint: Column | str = "fingerprint") -> Column:
    """Deterministic request id: replays of one business version coincide."""
    return hash_id([opportunity_id, fingerprint])


def event_id_expr(request_id: Column | str = "request_id",
                  event_seq: Column | str = "event_seq") -> Column:
    return hash_id([request_id, event_seq])


def with_request_id(evaluated: DataFrame) -> DataFrame:
    df = evaluated if "fingerprint" in evaluated.columns else evaluated.withColumn(
        "fingerprint", fingerprint_expr())
    return df.withColumn("request_id", request_id_expr())


def evaluation_events(evaluated: DataFrame, run_clock) -> DataFrame:
    """B7/J8 events: NEW -> ELIGIBLE|NOT_ELIGIBLE, then for eligible deals
    ELIGIBLE -> VALIDATED|VALIDATION_FAILED with the joined errors as reason.

    One ``explode`` of at most two structs per deal: a narrow projection.
    """
    df = with_request_id(evaluated) if "request_id" not in evaluated.columns else evaluated
    first = F.struct(
        F.lit(1).cast("bigint").alias("event_seq"),
        F.lit(P.NEW).alias("from_status"),
        F.when(F.col("eligible"), F.lit(P.ELIGIBLE)).otherwise(F.lit(P.NOT_ELIGIBLE)).alias("to_status"),
        F.lit(None).cast("string").alias("reason"),
    )
    second = F.struct(
        F.lit(2).cast("bigint").alias("event_seq"),
        F.lit(P.ELIGIBLE).alias("from_status"),
        F.col("status").alias("to_status"),
        F.col("error").alias("reason"),
    )
    pair = F.when(F.col("eligible"), F.array(first, second)).otherwise(F.array(first))
    ev = df.select("request_id", "opportunity_id", clock_column(run_clock).alias("_at"),
                   F.explode(pair).alias("e"))
    return ev.select(
        event_id_expr("request_id", F.col("e.event_seq")).alias("event_id"),
        "request_id", "opportunity_id",
        F.col("e.from_status").alias("from_status"),
        F.col("e.to_status").alias("to_status"),
        F.lit(None).cast("string").alias("actor"),
        F.col("e.reason").alias("reason"),
        F.col("_at").alias("occurred_at"),
        F.col("e.event_seq").alias("event_seq"),
    )


def with_metadata(events: DataFrame, **fields: Column) -> DataFrame:
    """``metadata``, the JSON text of the given values of each event; values
    that are NULL are left out, and an event without any has the empty object."""
    named = [value.alias(name) for name, value in fields.items()]
    return events.withColumn("metadata", F.to_json(F.struct(*named)) if named else F.lit("{}"))


def evaluation_changes(evaluated: DataFrame, run_clock) -> DataFrame:
    """The request change row written after evaluation (change_seq 1)."""
    df = with_request_id(evaluated) if "request_id" not in evaluated.columns else evaluated
    return df.select(
        "request_id", "opportunity_id", "status", "validation_errors",
        F.lit(None).cast("string").alias("approved_by"),
        F.lit(None).cast("timestamp").alias("approved_at"),
        F.lit(None).cast("string").alias("registration_number"),
        F.lit(None).cast("timestamp").alias("submitted_at"),
        "error",
        clock_column(run_clock).alias("updated_at"),
        F.lit(1).cast("bigint").alias("change_seq"),
        F.when(F.col("eligible"), F.lit(2)).otherwise(F.lit(1)).cast("bigint").alias("last_event_seq"),
    )


def latest_requests(changes: DataFrame) -> DataFrame:
    """A8 upsert semantics as a view: the highest ``change_seq`` row per request."""
    cols = [c for c in changes.columns if c != "request_id"]
    agg = changes.groupBy("request_id").agg(
        F.max_by(F.struct(*cols), F.col("change_seq")).alias("r"))
    return agg.select("request_id", *[F.col(f"r.{c}").alias(c) for c in cols])


def request_conflicts(changes: DataFrame) -> DataFrame:
    """Q16: opportunities carrying more than one request id (UNIQUE violated).

    Two partial aggregates: distinct (opportunity, request) pairs, then a
    count per opportunity; no group is ever materialised.
    """
    pairs = changes.groupBy("opportunity_id", "request_id").agg(F.max("change_seq").alias("_c"))
    return pairs.groupBy("opportunity_id").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_requests"),
        F.min("request_id").alias("first_request_id"),
    ).where(F.col("n_requests") > 1)


def request_history(events: DataFrame, request_ids: DataFrame | None = None) -> DataFrame:
    """Events of a set of requests, ordered by time then sequence.

    The id set is applied as a semi join; the order is a global sort whose
    range partitions split even one long history across tasks.
    """
    ev = events if request_ids is None else events.join(
        request_ids.select("request_id").dropDuplicates(), "request_id", "left_semi")
    return ev.orderBy("request_id", "occurred_at", "event_seq")


def rebuild_state(events: DataFrame) -> DataFrame:
    """State reconstructed from the log: last event per request by
    ``(occurred_at, event_seq)`` (a partial ``max_by`` aggregate)."""
    order = F.struct("occurred_at", "event_seq")
    return events.groupBy("request_id").agg(
        F.max_by("opportunity_id", order).alias("opportunity_id"),
        F.max_by("to_status", order).alias("status"),
        F.max("event_seq").alias("last_event_seq"),
        F.count(F.lit(1)).cast("bigint").alias("n_events"),
    )


def state_drift(state: DataFrame, rebuilt: DataFrame) -> DataFrame:
    """Requests whose stored status differs from the status the log implies."""
    a = state.select("request_id", F.col("status").alias("stored_status"))
    b = rebuilt.select("request_id", F.col("status").alias("rebuilt_status"))
    return a.join(b, "request_id", "full_outer").where(
        ~F.col("stored_status").eqNullSafe(F.col("rebuilt_status")))


def history_gaps(events: DataFrame, start: str = P.NEW) -> DataFrame:
    """Continuity check: each event must start where the previous one ended.

    ``event_seq`` is dense per request, so "previous event" is an equi join
    on ``(request_id, event_seq - 1)``: a composite key that stays spread
    out even when one request is hot (no window over the request).
    """
    prev = events.select(
        "request_id", (F.col("event_seq") + 1).alias("event_seq"),
        F.col("to_status").alias("prev_to_status"))
    joined = events.join(prev, ["request_id", "event_seq"], "left")
    expected = F.when(F.col("event_seq") == 1, F.lit(start)).otherwise(F.col("prev_to_status"))
    return joined.where(~F.col("from_status").eqNullSafe(expected)).select(
        "request_id", "event_seq", "from_status", expected.alias("expected_from"),
        "to_status")
