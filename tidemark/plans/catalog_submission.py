"""Catalogue: payload and outbox (W11), answer classification and settlement."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from tidemark.operators import claims
from tidemark.operators import submission as S
from tidemark.plans.catalog import register
from tidemark.plans.catalog_records import SQL_NESTED_DEALS
from tidemark.plans.sql_text import hash_id_sql
from tidemark.session import scratch_path
from tidemark.sources import records as R
from tidemark.sources import testdata as T

RUN_CLOCK = dt.datetime(2026, 1, 1)

SQL_ATTEMPTS = """
attempts AS (
  SELECT CAST(o.o_orderkey AS VARCHAR) AS request_id,
         CAST(o.o_custkey AS VARCHAR) AS opportunity_id,
         sha256(o.o_orderpriority) AS fingerprint,
         CASE WHEN o.o_orderstatus = 'P' THEN 'READY_FOR_REVIEW' ELSE 'APPROVED' END AS status,
         o.o_orderkey AS seq,
         CASE WHEN o.o_custkey % 17 = 0 THEN '' ELSE c.c_name END AS customer_name,
         c.c_name || ' / ' || o.o_orderpriority AS deal_name,
         n.n_name AS country,
         CAST(o.o_totalprice AS DECIMAL(18,2)) AS deal_amount,
         c.c_mktsegment AS industry,
         'Preferred' AS partner_name,
         strftime(o.o_orderdate, '%Y-%m-%d') AS expected_close_date
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
),
previous AS (
  SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS opportunity_id,
         sha256(o_orderpriority) AS fingerprint
  FROM orders WHERE o_orderdate < TIMESTAMP '1995-06-01'
),
gated AS (
  SELECT a.*,
         EXISTS (SELECT 1 FROM previous p WHERE p.opportunity_id = a.opportunity_id
                 AND p.fingerprint = a.fingerprint) AS already
  FROM attempts a
),
raw AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS request_id,
         CASE WHEN o_orderkey % 7 = 0 THEN 503 WHEN o_orderkey % 5 = 0 THEN 400
              WHEN o_orderkey % 3 = 0 THEN 200 WHEN o_orderkey % 13 = 0 THEN 202
              ELSE 201 END AS status_code,
         o_orderkey
  FROM orders
  WHERE NOT (o_orderstatus = 'O' AND o_orderpriority = '3-MEDIUM')
),
answers AS (
  SELECT request_id, status_code,
         CASE WHEN status_code = 201
              THEN '{"registration_number":"REG-' || CAST(o_orderkey AS VARCHAR) || '","message":"accepted"}'
              WHEN status_code = 202 THEN '{}'
              WHEN status_code = 503 THEN 'not json'
              ELSE '' END AS body
  FROM raw
),
classified AS (
  SELECT request_id,
         status_code BETWEEN 200 AND 299 AS accepted,
         CASE WHEN status_code BETWEEN 200 AND 299 AND json_valid(body)
              THEN json_extract_string(body, '$.registration_number') END AS registration_number,
         CASE WHEN status_code BETWEEN 200 AND 299
              THEN CASE WHEN json_valid(body) THEN json_extract_string(body, '$.message') END
              WHEN status_code IN (408, 429, 500, 502, 503, 504)
              THEN 'Downstream registration is retryable'
              ELSE 'Downstream registration rejected: HTTP ' || CAST(status_code AS VARCHAR) END
           AS message,
         status_code NOT BETWEEN 200 AND 299
           AND status_code IN (408, 429, 500, 502, 503, 504) AS retryable
  FROM answers
),
joined AS (
  SELECT g.*, c.accepted, c.registration_number AS num, c.message,
         c.request_id IS NOT NULL AS answered
  FROM gated g LEFT JOIN classified c ON g.request_id = c.request_id
),
first_ok AS (
  SELECT opportunity_id, fingerprint, min(seq) AS first_ok FROM joined
  WHERE status = 'APPROVED' AND NOT already AND accepted GROUP BY ALL
),
settled AS (
  SELECT j.*,
         CASE WHEN j.status <> 'APPROVED' THEN 'SKIPPED_NOT_APPROVED'
              WHEN j.already THEN 'SKIPPED_UNCHANGED'
              WHEN f.first_ok IS NOT NULL AND j.seq > f.first_ok THEN 'SKIPPED_UNCHANGED'
              WHEN NOT j.answered THEN 'PENDING'
              WHEN NOT j.accepted THEN 'SUBMISSION_FAILED'
              WHEN coalesce(j.num <> '', false) THEN 'REGISTERED'
              ELSE 'SUBMISSION_UNKNOWN' END AS outcome
  FROM joined j LEFT JOIN first_ok f USING (opportunity_id, fingerprint)
)"""


def _classified(spark, sf_dir):
    return S.classify_answers(T.raw_answers(spark, sf_dir))


def _settled(spark, sf_dir):
    return S.settle_submissions(T.attempts(spark, sf_dir), _classified(spark, sf_dir),
                                T.previous_submissions(spark, sf_dir), RUN_CLOCK)


@register("payload", f"""
WITH {SQL_NESTED_DEALS}
SELECT opportunity_id, account_name AS customer_name, opportunity_name AS deal_name, country,
       CAST(amount AS DECIMAL(18,2)) AS deal_amount, industry, partner AS partner_name,
       close_date AS expected_close_date
FROM deals""")
def q_payload(spark, sf_dir):
    deals = R.to_deals_nested(T.nested_source(spark, sf_dir))
    p = S.to_payload(deals, keep=("opportunity_id",))
    return p.withColumn("deal_amount", F.col("deal_amount").cast("decimal(18,2)"))


@register("payload_contract", f"""
WITH {SQL_NESTED_DEALS}
SELECT opportunity_id,
       coalesce(account_name <> '', false) AND coalesce(opportunity_name <> '', false) AS contract_ok,
       CASE WHEN NOT (coalesce(account_name <> '', false) AND coalesce(opportunity_name <> '', false))
            THEN 'Draft contract requires customer_name and deal_name' END AS contract_message
FROM deals""")
def q_payload_contract(spark, sf_dir):
    deals = R.to_deals_nested(T.nested_source(spark, sf_dir))
    p = S.check_payload_contract(S.to_payload(deals, keep=("opportunity_id",)))
    return p.select("opportunity_id", "contract_ok", "contract_message")


@register("outbox", f"""
WITH {SQL_ATTEMPTS},
sendable AS (SELECT * FROM gated WHERE status = 'APPROVED' AND NOT already),
firsts AS (SELECT opportunity_id, fingerprint, min(seq) AS s FROM sendable GROUP BY ALL)
SELECT x.request_id, x.opportunity_id, x.fingerprint, x.seq, x.customer_name, x.deal_name,
       x.country, x.deal_amount, x.industry, x.partner_name, x.expected_close_date,
       x.customer_name <> '' AS contract_ok
FROM sendable x JOIN firsts f
  ON f.opportunity_id = x.opportunity_id AND f.fingerprint = x.fingerprint AND f.s = x.seq""")
def q_outbox(spark, sf_dir):
    out = S.build_outbox(T.attempts(spark, sf_dir), T.previous_submissions(spark, sf_dir))
    return out.withColumn("deal_amount", F.col("deal_amount").cast("decimal(18,2)")).drop(
        "contract_message")


@register("contract_failures", f"""
WITH {SQL_ATTEMPTS},
sendable AS (SELECT * FROM gated WHERE status = 'APPROVED' AND NOT already),
firsts AS (SELECT opportunity_id, fingerprint, min(seq) AS s FROM sendable GROUP BY ALL)
SELECT x.request_id, 'SUBMISSION_FAILED' AS outcome, 'Draft contract requires customer_name and deal_name' AS error
FROM sendable x JOIN firsts f
  ON f.opportunity_id = x.opportunity_id AND f.fingerprint = x.fingerprint AND f.s = x.seq
WHERE x.customer_name = ''""")
def q_contract_failures(spark, sf_dir):
    requests, processed = T.attempts(spark, sf_dir), T.previous_submissions(spark, sf_dir)
    refused = S.contract_answers(S.build_outbox(requests, processed))
    outcomes, _, _ = S.settle_submissions(requests, refused, processed, RUN_CLOCK)
    return outcomes.where(F.col("outcome") == "SUBMISSION_FAILED").select("request_id", "outcome", "error")


@register("classify_answers", f"""
WITH {SQL_ATTEMPTS}
SELECT request_id, accepted, registration_number, message, retryable FROM classified""")
def q_classify_answers(spark, sf_dir):
    return _classified(spark, sf_dir)


@register("settle_submissions", f"""
WITH {SQL_ATTEMPTS}
SELECT request_id, opportunity_id, seq, outcome,
       CASE WHEN outcome IN ('SUBMISSION_FAILED', 'REGISTERED', 'SUBMISSION_UNKNOWN')
            THEN outcome ELSE status END AS status,
       CASE WHEN outcome = 'SUBMISSION_FAILED' THEN message END AS error,
       CASE WHEN outcome IN ('REGISTERED', 'SUBMISSION_UNKNOWN') THEN num END
         AS registration_number,
       CASE WHEN outcome = 'SKIPPED_NOT_APPROVED' THEN 'registration_requires_approval'
            WHEN outcome = 'SKIPPED_UNCHANGED' THEN 'unchanged_source_version'
            WHEN outcome = 'SUBMISSION_FAILED' THEN message END AS reason,
       outcome IN ('REGISTERED', 'SUBMISSION_UNKNOWN') AS processed,
       outcome IN ('SKIPPED_NOT_APPROVED', 'SKIPPED_UNCHANGED') AS skipped
FROM settled""")
def q_settle_submissions(spark, sf_dir):
    outcomes, _, _ = _settled(spark, sf_dir)
    return outcomes.drop("fingerprint")


@register("settlement_events", f"""
WITH {SQL_ATTEMPTS},
ev AS (
  SELECT request_id, opportunity_id, CAST(5 AS BIGINT) AS event_seq, 'APPROVED' AS from_status,
         CASE WHEN outcome = 'REGISTERED' THEN 'SUBMITTED' ELSE outcome END AS to_status,
         CASE WHEN outcome = 'SUBMISSION_FAILED' THEN message END AS reason
  FROM settled WHERE outcome IN ('SUBMISSION_FAILED', 'REGISTERED', 'SUBMISSION_UNKNOWN')
  UNION ALL
  SELECT request_id, opportunity_id, 6, 'SUBMITTED', 'REGISTERED', NULL
  FROM settled WHERE outcome = 'REGISTERED'
)
SELECT {hash_id_sql(['request_id', 'event_seq'])} AS event_id, request_id, opportunity_id,
       from_status, to_status, reason, event_seq
FROM ev""")
def q_settlement_events(spark, sf_dir):
    _, events, _ = _settled(spark, sf_dir)
    return events.select("event_id", "request_id", "opportunity_id", "from_status", "to_status",
                         "reason", "event_seq")


@register("settlement_processed", f"""
WITH {SQL_ATTEMPTS}
SELECT DISTINCT opportunity_id, fingerprint FROM settled
WHERE outcome IN ('REGISTERED', 'SUBMISSION_UNKNOWN')""")
def q_settlement_processed(spark, sf_dir):
    _, _, processed = _settled(spark, sf_dir)
    return processed.select("opportunity_id", "fingerprint")


CLAIM_BATCHES = 3


def _claimed(spark, sf_dir):
    """Orders claim their customer, in three batches that are not in order of time;
    the second is sent again."""
    root = scratch_path(spark, "claims", uuid.uuid4().hex[:12])
    o = T.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("opportunity_id"), F.col("o_orderkey").cast("string").alias("request_id"),
        F.col("o_orderdate").cast("timestamp").alias("claimed_at"))
    part = F.pmod(F.xxhash64("request_id"), F.lit(CLAIM_BATCHES))
    for batch_id, of in enumerate([*range(CLAIM_BATCHES), 1]):
        claims.claim(o.where(part == of), root, batch_id)
    return root


SQL_CLAIMS = """
requests AS (
  SELECT CAST(o_custkey AS VARCHAR) AS opportunity_id, CAST(o_orderkey AS VARCHAR) AS request_id, o_orderdate AS claimed_at
  FROM orders
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY opportunity_id ORDER BY claimed_at, request_id) AS place,
         first_value(request_id) OVER (PARTITION BY opportunity_id ORDER BY claimed_at, request_id) AS held_by
  FROM requests
)"""


@register("request_claims", f"""
WITH {SQL_CLAIMS}
SELECT opportunity_id, request_id, strftime(claimed_at, '%Y-%m-%d') AS claimed_on FROM ranked WHERE place = 1""")
def q_request_claims(spark, sf_dir):
    held = claims.holders(spark, _claimed(spark, sf_dir))
    return held.select("opportunity_id", "request_id", F.date_format("claimed_at", "yyyy-MM-dd").alias("claimed_on"))


@register("claim_conflicts", f"""
WITH {SQL_CLAIMS}
SELECT opportunity_id, request_id, held_by FROM ranked WHERE place > 1""")
def q_claim_conflicts(spark, sf_dir):
    return claims.conflicts(spark, _claimed(spark, sf_dir)).select("opportunity_id", "request_id", "held_by")
