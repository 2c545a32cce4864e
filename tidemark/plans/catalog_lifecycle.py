"""Catalogue: lifecycle fold (W10), decisions, event log and request views."""

from __future__ import annotations

import datetime as dt
import uuid
from functools import cached_property

from pyspark.sql import functions as F

from tidemark.operators import audit, lifecycle, prefix_fold, review, rules, submission, versions
from tidemark.plans import policy as P
from tidemark.plans.catalog import POLICY, register, rules_sql
from tidemark.plans.sql_text import fingerprint_sql, hash_id_sql
from tidemark.session import cut_lineage, scratch_path
from tidemark.sources import event_log
from tidemark.sources import testdata as T
from tidemark.sources.request_table import RequestTable

# ------------------------------------------------------------- lifecycle fold

# The relations are spelled in the oracles on their own.
SQL_EDGES = """('NEW', 'signup'), ('signup', 'view'), ('signup', 'error'), ('view', 'click'), ('view', 'error'),
  ('click', 'purchase'), ('click', 'error')"""

SQL_FOLD = f"""
cmds AS (
  SELECT concat_ws('-', CAST(user_id AS VARCHAR), strftime(ts, '%Y-%m-%d')) AS key,
         ts, event_id AS seq, event_type AS target
  FROM events
),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY ts, seq) AS rn FROM cmds
),
edges(src, dst) AS (VALUES {SQL_EDGES}),
fold(key, rn, state, moves, last_seq) AS (
  SELECT DISTINCT key, CAST(0 AS BIGINT), 'NEW', CAST(0 AS BIGINT), CAST(NULL AS BIGINT) FROM cmds
  UNION ALL
  SELECT f.key, n.rn,
         CASE WHEN e.dst IS NOT NULL THEN n.target ELSE f.state END,
         f.moves + CASE WHEN e.dst IS NOT NULL THEN 1 ELSE 0 END,
         CASE WHEN e.dst IS NOT NULL THEN n.seq ELSE f.last_seq END
  FROM fold f
  JOIN numbered n ON n.key = f.key AND n.rn = f.rn + 1
  LEFT JOIN edges e ON e.src = f.state AND e.dst = n.target
),
outcomes AS (
  SELECT n.key, n.ts, n.seq, n.target, f.state AS state_before,
         EXISTS (SELECT 1 FROM edges e WHERE e.src = f.state AND e.dst = n.target) AS applied,
         f.moves AS moves_before
  FROM numbered n JOIN fold f ON f.key = n.key AND f.rn = n.rn - 1
)"""


def _fold(spark, sf_dir):
    cmds = T.lifecycle_commands(spark, sf_dir)
    state, moves = lifecycle.fold_transitions(cmds, T.EVENT_TRANSITIONS, start="NEW")
    return cmds, state, moves


@register("lifecycle_final", f"""
WITH RECURSIVE {SQL_FOLD}
SELECT key, state AS status, moves, last_seq
FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY rn DESC) AS r FROM fold)
WHERE r = 1""")
def q_lifecycle_final(spark, sf_dir):
    _, state, _ = _fold(spark, sf_dir)
    return state.select("key", "status", "moves", "last_seq")


@register("lifecycle_moves", f"""
WITH RECURSIVE {SQL_FOLD}
SELECT key, moves_before + 1 AS step, ts, seq, state_before AS from_status, target AS to_status
FROM outcomes WHERE applied""")
def q_lifecycle_moves(spark, sf_dir):
    _, _, moves = _fold(spark, sf_dir)
    return moves.select("key", "step", "ts", "seq", "from_status", "to_status")


@register("lifecycle_outcomes", f"""
WITH RECURSIVE {SQL_FOLD}
SELECT key, seq, target, state_before, applied,
       CASE WHEN NOT applied
            THEN 'Invalid registration transition: ' || state_before || ' -> ' || target END
         AS rejection
FROM outcomes""")
def q_lifecycle_outcomes(spark, sf_dir):
    cmds, _, moves = _fold(spark, sf_dir)
    out = lifecycle.command_outcomes(cmds, moves, start="NEW", relation=T.EVENT_TRANSITIONS)
    return out.select("key", "seq", "target", "state_before", "applied", "rejection")


@register("lifecycle_outcomes_reused_seq", f"""
WITH RECURSIVE {SQL_FOLD.replace("event_id AS seq", "event_id % 4 AS seq")}
SELECT key, ts, seq, target, state_before, applied FROM outcomes""")
def q_lifecycle_outcomes_reused_seq(spark, sf_dir):
    """``seq`` orders commands of one time only: it repeats at other times of a key."""
    cmds = T.lifecycle_commands(spark, sf_dir).withColumn("seq", F.col("seq") % 4)
    _, moves = lifecycle.fold_transitions(cmds, T.EVENT_TRANSITIONS, start="NEW")
    out = lifecycle.command_outcomes(cmds, moves, start="NEW", relation=T.EVENT_TRANSITIONS)
    return out.select("key", "ts", "seq", "target", "state_before", "applied")


@register("transition_check", f"""
WITH RECURSIVE {SQL_FOLD},
pairs AS (SELECT DISTINCT state_before AS from_status, target AS to_status FROM outcomes)
SELECT from_status, to_status,
       EXISTS (SELECT 1 FROM edges e WHERE e.src = from_status AND e.dst = to_status) AS legal
FROM pairs""")
def q_transition_check(spark, sf_dir):
    cmds, _, moves = _fold(spark, sf_dir)
    out = lifecycle.command_outcomes(cmds, moves, start="NEW", relation=T.EVENT_TRANSITIONS)
    pairs = out.select(F.col("state_before").alias("from_status"),
                       F.col("target").alias("to_status")).distinct()
    return lifecycle.check_transitions(pairs, relation=T.EVENT_TRANSITIONS).select(
        "from_status", "to_status", "legal")


# -------------------------------------------------- evaluation, decisions, log

SQL_REQS = rules_sql() + f""",
fp AS (SELECT e.*, {fingerprint_sql()} AS fingerprint FROM evaluated e),
reqs AS (SELECT fp.*, {hash_id_sql(['opportunity_id', 'fingerprint'])} AS request_id FROM fp),
ev_eval AS (
  SELECT request_id, opportunity_id, CAST(1 AS BIGINT) AS event_seq, 'NEW' AS from_status,
         CASE WHEN eligible THEN 'ELIGIBLE' ELSE 'NOT_ELIGIBLE' END AS to_status,
         CAST(NULL AS VARCHAR) AS actor, CAST(NULL AS VARCHAR) AS reason,
         source_updated_at AS occurred_at
  FROM reqs
  UNION ALL
  SELECT request_id, opportunity_id, 2, 'ELIGIBLE', status, NULL, nullif(errors_text, ''),
         source_updated_at
  FROM reqs WHERE eligible
),
dec AS (
  SELECT request_id, opportunity_id, status AS s0, source_updated_at AS t0,
         CASE WHEN amount > 300000 THEN 'REJECTED' ELSE 'APPROVED' END AS t2,
         CASE WHEN amount > 300000 THEN 'amount above review limit' END AS why,
         'reviewer@' || lower(country) AS who,
         CASE WHEN eligible THEN 2 ELSE 1 END AS eval_events
  FROM reqs
),
ev_dec AS (
  SELECT request_id, opportunity_id, CAST(3 AS BIGINT) AS event_seq, 'VALIDATED' AS from_status,
         'READY_FOR_REVIEW' AS to_status, CAST(NULL AS VARCHAR) AS actor,
         CAST(NULL AS VARCHAR) AS reason, t0 + INTERVAL 1 DAY AS occurred_at
  FROM dec WHERE s0 = 'VALIDATED'
  UNION ALL
  SELECT request_id, opportunity_id, 4, 'READY_FOR_REVIEW', t2,
         CASE WHEN t2 = 'APPROVED' THEN who END, CASE WHEN t2 = 'REJECTED' THEN why END,
         t0 + INTERVAL 2 DAY
  FROM dec WHERE s0 = 'VALIDATED'
),
all_events AS (SELECT * FROM ev_eval UNION ALL SELECT * FROM ev_dec),
changes AS (
  SELECT request_id, opportunity_id, status, CAST(NULL AS VARCHAR) AS approved_by,
         nullif(errors_text, '') AS error, CAST(1 AS BIGINT) AS change_seq,
         CAST(CASE WHEN eligible THEN 2 ELSE 1 END AS BIGINT) AS last_event_seq
  FROM reqs
  UNION ALL
  SELECT request_id, opportunity_id, t2, CASE WHEN t2 = 'APPROVED' THEN who END,
         CASE WHEN t2 = 'REJECTED' THEN why END, 2, 4
  FROM dec WHERE s0 = 'VALIDATED'
),
latest AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY change_seq DESC) AS r
    FROM changes) WHERE r = 1
),
rebuilt AS (
  SELECT request_id, arg_max(opportunity_id, (occurred_at, event_seq)) AS opportunity_id,
         arg_max(to_status, (occurred_at, event_seq)) AS status,
         max(event_seq) AS last_event_seq, CAST(count(*) AS BIGINT) AS n_events
  FROM all_events GROUP BY request_id
)"""


class _Flow:
    """The evaluation -> decisions flow over the deal view; parts build on first use."""

    def __init__(self, spark, sf_dir):
        ev = versions.with_fingerprint(rules.evaluate(T.deal_view(spark, sf_dir), POLICY))
        # the evaluated requests are the stored request table the later
        # steps (decisions, history) read; write them once
        self.evaluated = cut_lineage(audit.with_request_id(ev), "evaluated", "zstd")
        self.clock = F.col("source_updated_at")

    @cached_property
    def eval_events(self):
        return audit.evaluation_events(self.evaluated, self.clock)

    @cached_property
    def eval_changes(self):
        return audit.evaluation_changes(self.evaluated, self.clock)

    @cached_property
    def decided(self):
        decisions = T.review_decisions(self.evaluated)
        # right after evaluation every request has exactly one change row, so
        # the change rows are the current state (no latest-per-key needed)
        return review.apply_decisions(self.eval_changes, decisions)

    @property
    def dec_changes(self):
        return self.decided[0]

    @property
    def dec_events(self):
        return self.decided[1]

    @property
    def dec_rejects(self):
        return self.decided[2]

    @property
    def events(self):
        return self.eval_events.unionByName(self.dec_events)

    @property
    def changes(self):
        return self.eval_changes.unionByName(self.dec_changes)


EVENT_OUT = ["event_id", "request_id", "opportunity_id", "from_status", "to_status", "actor",
             "reason", "event_seq"]
SQL_EVENT_OUT = f"""{hash_id_sql(['request_id', 'event_seq'])} AS event_id, request_id,
       opportunity_id, from_status, to_status, actor, reason, event_seq"""


@register("evaluation_events", f"""
WITH {SQL_REQS}
SELECT {SQL_EVENT_OUT} FROM ev_eval""")
def q_evaluation_events(spark, sf_dir):
    return _Flow(spark, sf_dir).eval_events.select(*EVENT_OUT)


@register("decision_events", f"""
WITH {SQL_REQS}
SELECT {SQL_EVENT_OUT}, CAST(occurred_at AS TIMESTAMP) AS occurred_at FROM ev_dec""")
def q_decision_events(spark, sf_dir):
    ev = _Flow(spark, sf_dir).dec_events
    return ev.select(*EVENT_OUT, F.col("occurred_at").cast("timestamp_ntz").alias("occurred_at"))


@register("event_metadata", f"""
WITH {SQL_REQS}
SELECT request_id, event_seq,
       '{{' || concat_ws(',', CASE WHEN actor IS NOT NULL THEN '"by":' || CAST(to_json(actor) AS VARCHAR) END,
                         CASE WHEN reason IS NOT NULL THEN '"why":' || CAST(to_json(reason) AS VARCHAR) END) || '}}' AS metadata
FROM all_events""")
def q_event_metadata(spark, sf_dir):
    events = audit.with_metadata(_Flow(spark, sf_dir).events, by=F.col("actor"), why=F.col("reason"))
    return events.select("request_id", "event_seq", "metadata")


@register("rejected_histories", f"""
WITH {SQL_REQS}
SELECT {SQL_EVENT_OUT} FROM all_events
WHERE request_id IN (SELECT request_id FROM changes WHERE change_seq = 2 AND status = 'REJECTED')""")
def q_rejected_histories(spark, sf_dir):
    """The whole log is written in two batches; every rejected request's history is looked up in it."""
    flow, root = _Flow(spark, sf_dir), scratch_path(spark, "event-log", uuid.uuid4().hex[:12])
    event_log.append(flow.eval_events, root, 0)
    event_log.append(flow.dec_events, root, 1)
    return event_log.history(spark, root, flow.dec_changes.where("status = 'REJECTED'")).select(*EVENT_OUT)


@register("decision_changes", f"""
WITH {SQL_REQS}
SELECT request_id, opportunity_id, status, approved_by, error, change_seq, last_event_seq
FROM changes WHERE change_seq = 2""")
def q_decision_changes(spark, sf_dir):
    ch = _Flow(spark, sf_dir).dec_changes
    return ch.select("request_id", "opportunity_id", "status", "approved_by", "error",
                     "change_seq", "last_event_seq")


@register("decision_rejects", f"""
WITH {SQL_REQS}
SELECT request_id, CAST(1 AS BIGINT) AS seq, 'READY_FOR_REVIEW' AS target, s0 AS state_before,
       'Invalid registration transition: ' || s0 || ' -> READY_FOR_REVIEW' AS rejection
FROM dec WHERE s0 <> 'VALIDATED'
UNION ALL
SELECT request_id, 2, t2, s0, 'Invalid registration transition: ' || s0 || ' -> ' || t2
FROM dec WHERE s0 <> 'VALIDATED'""")
def q_decision_rejects(spark, sf_dir):
    return _Flow(spark, sf_dir).dec_rejects


@register("latest_requests", f"""
WITH {SQL_REQS}
SELECT request_id, opportunity_id, status, approved_by, error, change_seq, last_event_seq
FROM latest""")
def q_latest_requests(spark, sf_dir):
    lat = audit.latest_requests(_Flow(spark, sf_dir).changes)
    return lat.select("request_id", "opportunity_id", "status", "approved_by", "error",
                      "change_seq", "last_event_seq")


@register("rebuild_state", f"""
WITH {SQL_REQS}
SELECT request_id, opportunity_id, status, last_event_seq, n_events FROM rebuilt""")
def q_rebuild_state(spark, sf_dir):
    return audit.rebuild_state(_Flow(spark, sf_dir).events)


@register("state_drift", f"""
WITH {SQL_REQS},
stored AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY change_seq DESC) AS place
    FROM changes WHERE NOT (change_seq = 2 AND CAST(opportunity_id AS BIGINT) % 11 = 0)) WHERE place = 1
),
logged AS (SELECT * FROM rebuilt WHERE CAST(opportunity_id AS BIGINT) % 13 <> 0)
SELECT coalesce(l.request_id, b.request_id) AS request_id, l.status AS stored_status,
       b.status AS rebuilt_status
FROM stored l FULL OUTER JOIN logged b ON l.request_id = b.request_id
WHERE l.status IS DISTINCT FROM b.status""")
def q_state_drift(spark, sf_dir):
    """A store that lost the decisions of some requests, a log that lost others."""
    f = _Flow(spark, sf_dir)
    key = F.col("opportunity_id").cast("bigint")
    stored = f.changes.where(~((F.col("change_seq") == 2) & (key % 11 == 0)))
    logged = f.events.where(key % 13 != 0)
    return audit.state_drift(audit.latest_requests(stored), audit.rebuild_state(logged))


@register("history_gaps", f"""
WITH {SQL_REQS},
kept AS (
  SELECT * FROM all_events
  WHERE NOT (event_seq = 1 AND CAST(opportunity_id AS BIGINT) % 13 = 0)
    AND NOT (event_seq = 3 AND CAST(opportunity_id AS BIGINT) % 11 = 0)
)
SELECT e.request_id, e.event_seq, e.from_status,
       CASE WHEN e.event_seq = 1 THEN 'NEW' ELSE p.to_status END AS expected_from, e.to_status
FROM kept e
LEFT JOIN kept p ON p.request_id = e.request_id AND p.event_seq = e.event_seq - 1
WHERE e.from_status IS DISTINCT FROM CASE WHEN e.event_seq = 1 THEN 'NEW' ELSE p.to_status END""")
def q_history_gaps(spark, sf_dir):
    """A log that lost the first event of some requests and the third of others."""
    key, at = F.col("opportunity_id").cast("bigint"), F.col("event_seq")
    events = _Flow(spark, sf_dir).events
    return audit.history_gaps(events.where(~((at == 1) & (key % 13 == 0)) & ~((at == 3) & (key % 11 == 0))))


SQL_SETTLED = SQL_REQS + """,
told AS (
  SELECT *, CAST(opportunity_id AS BIGINT) AS k,
         CASE WHEN status <> 'APPROVED' OR CAST(opportunity_id AS BIGINT) % 17 = 1 THEN NULL
              WHEN CAST(opportunity_id AS BIGINT) % 7 = 0 THEN 503 WHEN CAST(opportunity_id AS BIGINT) % 5 = 0 THEN 400
              WHEN CAST(opportunity_id AS BIGINT) % 3 = 0 THEN 200 WHEN CAST(opportunity_id AS BIGINT) % 13 = 0 THEN 202
              ELSE 201 END AS code
  FROM latest
),
settled AS (
  SELECT request_id, opportunity_id, approved_by, change_seq, last_event_seq, status AS status_before, error AS error_before,
         CASE WHEN code IN (400, 503) THEN 'SUBMISSION_FAILED' WHEN code = 201 THEN 'REGISTERED'
              WHEN code IS NOT NULL THEN 'SUBMISSION_UNKNOWN' END AS outcome,
         CASE WHEN code = 503 THEN 'Downstream registration is retryable'
              WHEN code = 400 THEN 'Downstream registration rejected: HTTP 400' END AS error,
         CASE WHEN code = 201 THEN 'REG-' || CAST(k AS VARCHAR) END AS registration_number,
         CASE WHEN code IN (200, 201, 202) THEN TIMESTAMP '2026-01-01 00:00:00' END AS submitted_at
  FROM told
)"""
SETTLED_OUT = ["request_id", "opportunity_id", "status", "approved_by", "registration_number", "submitted_at", "error",
               "change_seq", "last_event_seq"]


class _Settled(_Flow):
    """The flow carried on: approved requests with their deals, outbox, answers, settlement."""

    def __init__(self, spark, sf_dir):
        super().__init__(spark, sf_dir)
        self.run_clock = dt.datetime(2026, 1, 1)
        # the stored request table that the submission run reads
        self.current = cut_lineage(audit.latest_requests(self.changes), "current", "zstd")
        requests = submission.with_deals(self.current, self.evaluated).withColumn("seq", F.col("opportunity_id").cast("bigint"))
        none_yet = self.evaluated.select("opportunity_id", "fingerprint").limit(0)
        refused = submission.contract_answers(submission.build_outbox(requests, none_yet))
        answers = submission.classify_answers(T.flow_answers(requests)).join(refused, "request_id", "left_anti")
        self.outcomes, self.sent_events, self.processed = submission.settle_submissions(
            requests, answers.unionByName(refused), none_yet, self.run_clock)

    @cached_property
    def settled_changes(self):
        return submission.settlement_changes(self.current, self.outcomes, self.run_clock)


def _settled_out(df):
    return df.withColumn("submitted_at", F.col("submitted_at").cast("timestamp_ntz")).select(*SETTLED_OUT)


@register("settlement_changes", f"""
WITH {SQL_SETTLED}
SELECT request_id, opportunity_id, outcome AS status, approved_by, registration_number, submitted_at, error,
       change_seq + 1 AS change_seq, last_event_seq + CASE WHEN outcome = 'REGISTERED' THEN 2 ELSE 1 END AS last_event_seq
FROM settled WHERE outcome IS NOT NULL""")
def q_settlement_changes(spark, sf_dir):
    return _settled_out(_Settled(spark, sf_dir).settled_changes)


@register("requests_after_settlement", f"""
WITH {SQL_SETTLED}
SELECT request_id, opportunity_id, coalesce(outcome, status_before) AS status, approved_by, registration_number,
       submitted_at, CASE WHEN outcome IS NULL THEN error_before ELSE error END AS error,
       change_seq + CASE WHEN outcome IS NULL THEN 0 ELSE 1 END AS change_seq,
       last_event_seq + CASE WHEN outcome IS NULL THEN 0 WHEN outcome = 'REGISTERED' THEN 2 ELSE 1 END AS last_event_seq
FROM settled""")
def q_requests_after_settlement(spark, sf_dir):
    """Evaluate, decide, send, settle, store: the current requests afterwards."""
    f = _Settled(spark, sf_dir)
    return _settled_out(audit.latest_requests(f.changes.unionByName(f.settled_changes)))


@register("request_history", f"""
WITH {SQL_REQS}
SELECT request_id, event_seq, from_status, to_status, actor, reason FROM all_events
WHERE request_id IN (SELECT request_id FROM reqs WHERE country = 'NATION_1')""")
def q_request_history(spark, sf_dir):
    f = _Flow(spark, sf_dir)
    ids = f.evaluated.where(F.col("country") == "NATION_1").select("request_id")
    return audit.request_history(f.events, ids).select(
        "request_id", "event_seq", "from_status", "to_status", "actor", "reason")


@register("request_conflicts", f"""
WITH {rules_sql()},
fp AS (SELECT e.*, {fingerprint_sql()} AS fingerprint FROM evaluated e),
cust AS (
  SELECT CAST(account_key AS VARCHAR) AS opportunity_id,
         {hash_id_sql(['CAST(account_key AS VARCHAR)', 'fingerprint'])} AS request_id
  FROM fp
)
SELECT opportunity_id, CAST(count(DISTINCT request_id) AS BIGINT) AS n_requests,
       min(request_id) AS first_request_id
FROM cust GROUP BY opportunity_id HAVING count(DISTINCT request_id) > 1""")
def q_request_conflicts(spark, sf_dir):
    ev = versions.with_fingerprint(rules.evaluate(T.deal_view(spark, sf_dir), POLICY))
    ev = ev.withColumn("opportunity_id", F.col("account_key").cast("string"))
    ev = ev.withColumn("request_id", audit.request_id_expr())
    changes = audit.evaluation_changes(ev, F.col("source_updated_at"))
    return audit.request_conflicts(changes)


# ------------------------------------------------- request relation (depth 6)

SQL_REQ_EDGES = """('NEW', 'ELIGIBLE'), ('NEW', 'NOT_ELIGIBLE'), ('ELIGIBLE', 'VALIDATED'),
  ('ELIGIBLE', 'VALIDATION_FAILED'), ('VALIDATED', 'READY_FOR_REVIEW'), ('VALIDATED', 'VALIDATION_FAILED'),
  ('READY_FOR_REVIEW', 'APPROVED'), ('READY_FOR_REVIEW', 'REJECTED'), ('APPROVED', 'SUBMITTED'),
  ('APPROVED', 'SUBMISSION_FAILED'), ('APPROVED', 'SUBMISSION_UNKNOWN'), ('SUBMITTED', 'REGISTERED'),
  ('SUBMITTED', 'SUBMISSION_FAILED'), ('SUBMITTED', 'SUBMISSION_UNKNOWN')"""
SQL_REQ_TARGETS = """'ELIGIBLE', 'VALIDATED', 'READY_FOR_REVIEW', 'APPROVED', 'SUBMITTED', 'REGISTERED', 'NOT_ELIGIBLE',
  'VALIDATION_FAILED', 'REJECTED', 'SUBMISSION_FAILED', 'SUBMISSION_UNKNOWN', 'ELIGIBLE'"""

SQL_REQ_FOLD = f"""
cmds AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS key, l_shipdate AS ts,
         lpad(CAST(l_linenumber AS VARCHAR), 3, '0') || '-' || lpad(CAST(l_partkey AS VARCHAR), 12, '0')
           || '-' || lpad(CAST(l_suppkey AS VARCHAR), 12, '0') AS seq,
         [{SQL_REQ_TARGETS}][((l_partkey + l_linenumber) % 12) + 1] AS target
  FROM lineitem
),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY ts, seq) AS rn FROM cmds
),
edges(src, dst) AS (VALUES {SQL_REQ_EDGES}),
fold(key, rn, state, moves, last_seq) AS (
  SELECT DISTINCT key, CAST(0 AS BIGINT), 'NEW', CAST(0 AS BIGINT), CAST(NULL AS VARCHAR) FROM cmds
  UNION ALL
  SELECT f.key, n.rn,
         CASE WHEN e.dst IS NOT NULL THEN n.target ELSE f.state END,
         f.moves + CASE WHEN e.dst IS NOT NULL THEN 1 ELSE 0 END,
         CASE WHEN e.dst IS NOT NULL THEN n.seq ELSE f.last_seq END
  FROM fold f
  JOIN numbered n ON n.key = f.key AND n.rn = f.rn + 1
  LEFT JOIN edges e ON e.src = f.state AND e.dst = n.target
),
outcomes AS (
  SELECT n.key, n.seq, n.target, f.state AS state_before,
         EXISTS (SELECT 1 FROM edges e WHERE e.src = f.state AND e.dst = n.target) AS applied
  FROM numbered n JOIN fold f ON f.key = n.key AND f.rn = n.rn - 1
)"""


def _request_fold(spark, sf_dir):
    cmds = T.request_commands(spark, sf_dir)
    state, moves = lifecycle.fold_transitions(cmds, P.REQUEST_TRANSITIONS, start=P.NEW)
    return cmds, state, moves


@register("request_lifecycle", f"""
WITH RECURSIVE {SQL_REQ_FOLD}
SELECT key, state AS status, moves, last_seq
FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY rn DESC) AS r FROM fold)
WHERE r = 1""")
def q_request_lifecycle(spark, sf_dir):
    _, state, _ = _request_fold(spark, sf_dir)
    return state.select("key", "status", "moves", "last_seq")


@register("request_rejects", f"""
WITH RECURSIVE {SQL_REQ_FOLD}
SELECT key, seq, target, state_before,
       'Invalid registration transition: ' || state_before || ' -> ' || target AS rejection
FROM outcomes WHERE NOT applied""")
def q_request_rejects(spark, sf_dir):
    cmds, _, moves = _request_fold(spark, sf_dir)
    out = lifecycle.command_outcomes(cmds, moves, start=P.NEW, relation=P.REQUEST_TRANSITIONS)
    return out.where(~F.col("applied")).select("key", "seq", "target", "state_before", "rejection")


# one recursive step per move (at most six), not per command: the hot key holds a third of lineitem
@register("skewed_request_lifecycle", f"""
WITH RECURSIVE cmds AS (
  SELECT CASE WHEN l_orderkey % 3 = 0 THEN 'HOT' ELSE CAST(l_orderkey AS VARCHAR) END AS key, l_shipdate AS ts,
         lpad(CAST(l_orderkey AS VARCHAR), 12, '0') || '-' || lpad(CAST(l_linenumber AS VARCHAR), 3, '0')
           || '-' || lpad(CAST(l_partkey AS VARCHAR), 12, '0') || '-' || lpad(CAST(l_suppkey AS VARCHAR), 12, '0') AS seq,
         [{SQL_REQ_TARGETS}][((l_partkey + l_linenumber) % 12) + 1] AS target
  FROM lineitem
),
edges(src, dst) AS (VALUES {SQL_REQ_EDGES}),
walk(key, moves, state, ts, seq) AS (
  SELECT DISTINCT key, CAST(0 AS BIGINT), 'NEW', CAST(NULL AS TIMESTAMP), CAST(NULL AS VARCHAR) FROM cmds
  UNION ALL
  SELECT key, moves, target, ts, seq FROM (
    SELECT w.key, w.moves + 1 AS moves, c.target, CAST(c.ts AS TIMESTAMP) AS ts, c.seq,
           row_number() OVER (PARTITION BY w.key ORDER BY c.ts, c.seq) AS place
    FROM walk w JOIN cmds c ON c.key = w.key
    JOIN edges e ON e.src = w.state AND e.dst = c.target
    WHERE w.ts IS NULL OR c.ts > w.ts OR (c.ts = w.ts AND c.seq > w.seq)) WHERE place = 1
)
SELECT key, state AS status, moves, seq AS last_seq
FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY moves DESC) AS r FROM walk) WHERE r = 1""")
def q_skewed_request_lifecycle(spark, sf_dir):
    cmds = T.skewed_request_commands(spark, sf_dir)
    state, _ = lifecycle.fold_transitions(cmds, P.REQUEST_TRANSITIONS, start=P.NEW)
    return state.select("key", "status", "moves", "last_seq")


# ------------------------------------------------- fold of a relation with cycles

# a third of all commands are one key's
CYCLIC_RELATION = {"NEW": ("signup", "view"), "signup": ("view", "error"), "view": ("click", "error", "view"),
                   "click": ("view", "purchase"), "purchase": ("signup",), "error": ("NEW", "signup", "view")}
SQL_CYCLIC = """
cmds AS (
  SELECT CASE WHEN user_id % 3 = 0 THEN 'HOT' ELSE CAST(user_id AS VARCHAR) END AS key, ts, event_id AS seq, event_type AS target FROM events
),
numbered AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY ts, seq) AS rn FROM cmds),
edges(src, dst) AS (VALUES ('NEW', 'signup'), ('NEW', 'view'), ('signup', 'view'), ('signup', 'error'), ('view', 'click'), ('view', 'error'),
  ('view', 'view'), ('click', 'view'), ('click', 'purchase'), ('purchase', 'signup'), ('error', 'NEW'), ('error', 'signup'), ('error', 'view')),
walk(key, rn, state, moves) AS (
  SELECT DISTINCT key, CAST(0 AS BIGINT), 'NEW', CAST(0 AS BIGINT) FROM cmds
  UNION ALL
  SELECT w.key, n.rn, coalesce(e.dst, w.state), w.moves + CASE WHEN e.dst IS NOT NULL THEN 1 ELSE 0 END
  FROM walk w JOIN numbered n ON n.key = w.key AND n.rn = w.rn + 1
  LEFT JOIN edges e ON e.src = w.state AND e.dst = n.target
)"""


def cyclic_commands(spark, sf_dir):
    ev = T.table(spark, sf_dir, "events")
    hot = F.when(F.col("user_id") % 3 == 0, F.lit("HOT")).otherwise(F.col("user_id").cast("string"))
    return ev.select(hot.alias("key"), "ts", F.col("event_id").alias("seq"), F.col("event_type").alias("target"))


@register("cyclic_outcomes", f"""
WITH RECURSIVE {SQL_CYCLIC}
SELECT n.key, n.seq, n.target, w.state AS state_before, e.dst IS NOT NULL AS applied, w.moves AS moves_before,
  CASE WHEN e.dst IS NULL THEN 'Invalid registration transition: ' || w.state || ' -> ' || n.target END AS rejection
FROM numbered n JOIN walk w ON w.key = n.key AND w.rn = n.rn - 1
LEFT JOIN edges e ON e.src = w.state AND e.dst = n.target""")
def q_cyclic_outcomes(spark, sf_dir):
    out = prefix_fold.prefix_outcomes(cyclic_commands(spark, sf_dir), CYCLIC_RELATION, "NEW")
    return out.select("key", "seq", "target", "state_before", "applied", "moves_before", "rejection")


@register("cyclic_final", f"""
WITH RECURSIVE {SQL_CYCLIC}
SELECT key, state AS status, moves FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY rn DESC) AS r FROM walk) WHERE r = 1""")
def q_cyclic_final(spark, sf_dir):
    return prefix_fold.prefix_state(prefix_fold.prefix_outcomes(cyclic_commands(spark, sf_dir), CYCLIC_RELATION, "NEW"))


# ------------------------------------------------- request table merged on read


def request_table_changes(spark, sf_dir):
    """events as change rows: a request for each user and day, ``change_seq`` = event_id."""
    ev = T.table(spark, sf_dir, "events")
    none = F.lit(None).cast("string")
    at = F.col("ts").cast("timestamp")
    errors = F.when(F.col("event_type") == "error", F.array(F.concat(F.lit('Invalid: "'), F.col("event_id").cast("string"), F.lit('"'))))
    return ev.select(
        F.concat_ws("-", F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM-dd")).alias("request_id"),
        F.concat(F.lit("O"), F.col("event_id").cast("string")).alias("opportunity_id"), F.col("event_type").alias("status"),
        errors.alias("validation_errors"), none.alias("approved_by"), F.lit(None).cast("timestamp").alias("approved_at"),
        none.alias("registration_number"), F.lit(None).cast("timestamp").alias("submitted_at"), none.alias("error"),
        at.alias("updated_at"), F.col("event_id").alias("change_seq"))


@register("request_table", """
SELECT concat_ws('-', CAST(user_id AS VARCHAR), strftime(ts, '%Y-%m-%d')) AS request_id,
  'O' || CAST(min(event_id) AS VARCHAR) AS opportunity_id, arg_max(event_type, event_id) AS status,
  arg_max(CASE WHEN event_type = 'error' THEN '["Invalid: \\"' || CAST(event_id AS VARCHAR) || '\\""]' ELSE '[]' END, event_id) AS validation_errors,
  arg_min(ts, event_id) AS created_at, arg_max(ts, event_id) AS updated_at, max(event_id) AS change_seq
FROM events GROUP BY 1""")
def q_request_table(spark, sf_dir):
    """Three batches in no order of time, buckets rewritten after the second."""
    table = RequestTable(spark, scratch_path(spark, "request-table", uuid.uuid4().hex[:12]), buckets=16)
    changes = request_table_changes(spark, sf_dir)
    for batch, part in enumerate((2, 0, 1)):
        table.apply(changes.where(F.col("change_seq") % 3 == part), batch)
        if batch == 1:
            table.compact()
    return table.read().select(
        "request_id", "opportunity_id", "status", "validation_errors",
        F.col("created_at").cast("timestamp_ntz").alias("created_at"), F.col("updated_at").cast("timestamp_ntz").alias("updated_at"), "change_seq")


@register("running_status_counts", """
WITH rows AS (
  SELECT concat_ws('-', CAST(user_id AS VARCHAR), strftime(ts, '%Y-%m-%d')) AS request_id, event_type, event_id,
    (event_id + 1) % 3 AS batch
  FROM events
),
now AS (
  SELECT b.batch, request_id, arg_max(event_type, event_id) AS status
  FROM (VALUES (0), (1), (2)) b(batch) JOIN rows r ON r.batch <= b.batch GROUP BY 1, 2
)
SELECT CAST(batch AS INTEGER) AS batch, status, count(*) AS n FROM now GROUP BY 1, 2""")
def q_running_status_counts(spark, sf_dir):
    """Counts kept by the table after each of three batches, older changes coming late."""
    table = RequestTable(spark, scratch_path(spark, "running-counts", uuid.uuid4().hex[:12]), buckets=16)
    changes, out = request_table_changes(spark, sf_dir), None
    for batch in range(3):
        table.apply(changes.where((F.col("change_seq") + 1) % 3 == batch), batch)
        kept = table.counts().select(F.lit(batch).alias("batch"), "status", "n")
        out = kept if out is None else out.unionByName(kept)
    return out
