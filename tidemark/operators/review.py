"""W10 decisions: move to review, approve and reject in bulk, with audit rows.

Decisions are commands applied by the set-based fold over the slice of the
request relation they can reach (depth 2), starting from each request's
current status. Illegal decisions are returned as rejects, not raised.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import lifecycle as L
from tidemark.operators.audit import event_id_expr
from tidemark.plans import policy as P

# Decision verbs and the state each one targets.
DECISION_TARGETS = {
    "REVIEW": P.READY_FOR_REVIEW,
    "APPROVE": P.APPROVED,
    "REJECT": P.REJECTED,
}


def decision_relation() -> dict[str, tuple[str, ...]]:
    targets = set(DECISION_TARGETS.values())
    rel = {s: tuple(t for t in ts if t in targets) for s, ts in P.REQUEST_TRANSITIONS.items()}
    return {s: ts for s, ts in rel.items() if ts}


def apply_decisions(requests: DataFrame, decisions: DataFrame):
    """J4/J7/J9/J10 in bulk.

    ``requests``: current state (``request_id, opportunity_id, status,
    change_seq, last_event_seq``). ``decisions``: ``request_id, decision,
    actor, reason, ts, seq``.

    Returns ``(changes, events, rejects)``: new change rows for requests that
    moved, one event per applied decision (approve carries the actor, reject
    the reason), and every decision that did not apply with its message.

    ``requests`` is a stored table, read in place for the fold, the changes and
    the events and never written again; a few decisions, or the few moves they
    made, are sent to it instead of shuffling it. Only requests in a state that
    a decision can leave go through the fold; the others are rejects.
    """
    target = F.create_map(*[x for k, v in DECISION_TARGETS.items() for x in (F.lit(k), F.lit(v))])
    cmds = decisions.select(
        F.col("request_id").alias("key"), "ts", "seq",
        F.coalesce(F.try_element_at(target, F.upper(F.col("decision"))), F.lit("UNKNOWN")).alias("target"),
        "actor", "reason",
    )
    initial = requests.select(
        F.col("request_id").alias("key"), "status",
        F.lit(None).cast(cmds.schema["ts"].dataType).alias("last_ts"),
        F.lit(None).cast(cmds.schema["seq"].dataType).alias("last_seq"))
    rel = decision_relation()
    # decisions on unknown requests have no state to move: they come back as
    # rejects (from NEW), so the fold need not add start states for them
    movable = F.col("status").isin(sorted(rel))
    _, moves = L.fold_transitions(cmds, rel, initial=initial.where(movable), add_missing_keys=False, write_initial=False)
    movers = requests.where(movable)
    req = movers.select(
        F.col("request_id").alias("key"), "opportunity_id", "change_seq", "last_event_seq")
    mv = moves.join(req, "key")
    events = mv.select(
        event_id_expr(F.col("key"), F.col("last_event_seq") + F.col("step")).alias("event_id"),
        F.col("key").alias("request_id"), "opportunity_id", "from_status", "to_status",
        F.when(F.col("to_status") == P.APPROVED, F.col("actor")).alias("actor"),
        F.when(F.col("to_status") == P.REJECTED, F.col("reason")).alias("reason"),
        F.col("ts").cast("timestamp").alias("occurred_at"),
        (F.col("last_event_seq") + F.col("step")).cast("bigint").alias("event_seq"),
    )
    # per request: the final move, and the approval move if any (bounded: <= 2 moves)
    last = moves.groupBy("key").agg(
        F.max_by(F.struct("to_status", "reason", "ts"), F.col("step")).alias("last"),
        F.max_by(F.struct("actor", "ts"), F.when(F.col("to_status") == P.APPROVED, F.col("step")))
        .alias("appr"),
        F.max("step").alias("n_moves"),
    )
    prev = movers.withColumnRenamed("request_id", "key")
    changes = prev.join(last, "key").select(
        F.col("key").alias("request_id"), "opportunity_id",
        F.col("last.to_status").alias("status"),
        "validation_errors",
        F.coalesce(F.col("appr.actor"), F.col("approved_by")).alias("approved_by"),
        F.coalesce(F.col("appr.ts").cast("timestamp"), F.col("approved_at")).alias("approved_at"),
        "registration_number", "submitted_at",
        F.when(F.col("last.to_status") == P.REJECTED, F.col("last.reason")).alias("error"),
        F.col("last.ts").cast("timestamp").alias("updated_at"),
        (F.col("change_seq") + 1).cast("bigint").alias("change_seq"),
        (F.col("last_event_seq") + F.col("n_moves")).cast("bigint").alias("last_event_seq"),
    )
    rejects = L.command_outcomes(cmds, moves, initial=initial, relation=rel).where(~F.col("applied"))
    rejects = rejects.select(F.col("key").alias("request_id"), "seq", "target", "state_before",
                             "rejection")
    return changes, events, rejects
