"""Payload, contract check, outbox and settlement of answers.

A network call per row is replaced by two jobs with a table between them:
``build_outbox`` writes what must be sent (keyed by request id, the
idempotency key); an external sender lands answers; ``settle_submissions``
applies them. Submit-once within a batch is a min aggregate per version
joined back (no window over a possibly hot version).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import clock_column

from tidemark.operators.audit import REQUEST_COLUMNS, event_id_expr
from tidemark.operators.versions import VERSION_KEYS, flag_processed
from tidemark.plans import policy as P

# Canonical field -> payload field.
PAYLOAD_FIELDS = (
    ("account_name", "customer_name"),
    ("opportunity_name", "deal_name"),
    ("country", "country"),
    ("amount", "deal_amount"),
    ("industry", "industry"),
    ("partner", "partner_name"),
    ("close_date", "expected_close_date"),
)

OUTCOME_NEEDS_APPROVAL = "SKIPPED_NOT_APPROVED"
OUTCOME_UNCHANGED = "SKIPPED_UNCHANGED"
OUTCOME_PENDING = "PENDING"


def to_payload(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """B2: rename present fields to the payload contract; absent ones are omitted."""
    cols = [F.col(src).alias(dst) for src, dst in PAYLOAD_FIELDS if src in df.columns]
    return df.select(*[F.col(k) for k in keep if k in df.columns], *cols)


def _truthy(c: Column) -> Column:
    return F.coalesce((c.cast("string") != F.lit("")), F.lit(False))


def check_payload_contract(payload: DataFrame) -> DataFrame:
    """``customer_name`` and ``deal_name`` must both be non-empty
    (text of spaces passes, as in the contract)."""
    cn = F.col("customer_name") if "customer_name" in payload.columns else F.lit(None)
    dn = F.col("deal_name") if "deal_name" in payload.columns else F.lit(None)
    ok = _truthy(cn) & _truthy(dn)
    return payload.withColumn("contract_ok", ok).withColumn(
        "contract_message", F.when(~ok, F.lit(P.MSG_CONTRACT)))


def submission_gate(requests: DataFrame, processed: DataFrame) -> DataFrame:
    """P1 then P2 (order matters, Q12): ``gate`` is NULL when the row may be sent."""
    df = flag_processed(requests, processed)
    gate = (F.when(F.col("status") != P.APPROVED, F.lit(P.REASON_NEEDS_APPROVAL))
            .when(F.col("already_processed"), F.lit(P.REASON_UNCHANGED)))
    return df.withColumn("gate", gate)


def build_outbox(requests: DataFrame, processed: DataFrame) -> DataFrame:
    """Rows to send, one per unprocessed approved version.

    ``requests`` carry ``request_id, opportunity_id, fingerprint, status, seq``
    plus canonical deal fields. When several approved requests share a
    version, only the lowest ``seq`` is sent (a min aggregate joined back);
    if it is rejected, the next one goes out in the next run.
    """
    # rows still to approve go before the joins, not after them
    approved = requests.where(F.coalesce(F.col("status") == P.APPROVED, F.lit(True)))
    gated = submission_gate(approved, processed).where(F.col("gate").isNull())
    first = gated.groupBy(*VERSION_KEYS).agg(F.min("seq").alias("_first"))
    chosen = gated.join(first, VERSION_KEYS).where(F.col("seq") == F.col("_first"))
    return check_payload_contract(
        to_payload(chosen, keep=("request_id", "opportunity_id", "fingerprint", "seq")))


def classify_answers(raw: DataFrame) -> DataFrame:
    """``(request_id, status_code, body)`` -> accepted / number / message.

    2xx accepts, reading number and message from the JSON body (an empty or
    malformed body reads as no fields); 408/429/500/502/503/504 are
    retryable failures; any other code is a rejection naming the code.
    """
    code = F.col("status_code")
    ok = (code >= 200) & (code < 300)
    retryable = code.isin(list(P.RETRYABLE_STATUS_CODES))
    number = F.get_json_object(F.col("body"), "$.registration_number")
    message = F.get_json_object(F.col("body"), "$.message")
    return raw.select(
        "request_id",
        F.coalesce(ok, F.lit(False)).alias("accepted"),
        F.when(ok, number).alias("registration_number"),
        F.when(ok, message)
        .when(retryable, F.lit(P.MSG_RETRYABLE))
        .otherwise(F.concat(F.lit(P.MSG_REJECTED_HTTP.split("{")[0]), code.cast("string")))
        .alias("message"),
        F.coalesce(~ok & retryable, F.lit(False)).alias("retryable"),
    )


def contract_answers(outbox: DataFrame) -> DataFrame:
    """Outbox rows that fail the contract are never sent; their answer is
    the contract's own refusal, shaped like ``classify_answers`` so that
    ``settle_submissions`` turns them into SUBMISSION_FAILED."""
    return outbox.where(~F.col("contract_ok")).select(
        "request_id", F.lit(False).alias("accepted"), F.lit(None).cast("string").alias("registration_number"),
        F.col("contract_message").alias("message"), F.lit(False).alias("retryable"))


def with_deals(requests: DataFrame, deals: DataFrame) -> DataFrame:
    """Current requests with the deal version each one is about.

    ``deals`` carry ``request_id`` (see ``audit.with_request_id``), their
    fingerprint and canonical fields; an equi join on the request id, so a hot
    opportunity stays spread out. Columns both sides have are the request's.
    """
    own = [c for c in deals.columns if c == "request_id" or c not in requests.columns]
    return requests.join(deals.select(*own), "request_id")


def settlement_changes(requests: DataFrame, outcomes: DataFrame, run_clock) -> DataFrame:
    """One change row per request that a settlement moved.

    ``requests``: the current request rows that were settled. A registered
    request passed through SUBMITTED, so it takes two event numbers; the
    submission time is set when the gateway accepted (with or without a
    number), and an error only when it did not. Requests that were skipped or
    still wait for an answer get no row.
    """
    accepted = F.col("_to").isin(P.REGISTERED, P.SUBMISSION_UNKNOWN)
    moved = outcomes.where(F.col("outcome").isin(P.SUBMISSION_FAILED, P.REGISTERED, P.SUBMISSION_UNKNOWN)).select(
        "request_id", F.col("outcome").alias("_to"), F.col("registration_number").alias("_number"),
        F.col("error").alias("_error"))
    steps = F.when(F.col("_to") == P.REGISTERED, 2).otherwise(1)
    return requests.select(*REQUEST_COLUMNS).join(moved, "request_id").select(
        "request_id", "opportunity_id", F.col("_to").alias("status"), "validation_errors", "approved_by", "approved_at",
        F.when(accepted, F.col("_number")).otherwise(F.col("registration_number")).alias("registration_number"),
        F.when(accepted, clock_column(run_clock)).otherwise(F.col("submitted_at")).alias("submitted_at"),
        F.col("_error").alias("error"), clock_column(run_clock).alias("updated_at"),
        (F.col("change_seq") + 1).cast("bigint").alias("change_seq"),
        (F.col("last_event_seq") + steps).cast("bigint").alias("last_event_seq"),
    )


def settle_submissions(requests: DataFrame, answers: DataFrame, processed: DataFrame,
                       run_clock) -> tuple[DataFrame, DataFrame, DataFrame]:
    """P1-P6 for a batch of requests and their (normalised) answers.

    ``requests``: ``request_id, opportunity_id, fingerprint, status, seq``
    and optionally ``last_event_seq``. ``answers``:
    ``request_id, accepted, registration_number, message`` (from
    ``classify_answers``, with ``contract_answers`` for rows never sent).
    Within a version the lowest accepted ``seq`` is the
    one submission; unaccepted rows before it fail, every row after it is
    skipped as unchanged, exactly as a sequential loop would do.

    Returns ``(outcomes, events, processed_rows)``; ``settlement_changes``
    gives the request change rows of the outcomes.
    """
    if "last_event_seq" not in requests.columns:
        requests = requests.withColumn("last_event_seq", F.lit(0).cast("bigint"))
    requests = requests.select("request_id", *VERSION_KEYS, "status", "seq", "last_event_seq")
    ans = answers.select("request_id", "accepted", "registration_number", "message",
                         F.lit(True).alias("_answered"))
    df = submission_gate(requests, processed).join(ans, "request_id", "left")
    first_ok = (df.where(F.col("gate").isNull() & F.col("accepted"))
                .groupBy(*VERSION_KEYS).agg(F.min("seq").alias("_first_ok")))
    df = df.join(first_ok, VERSION_KEYS, "left")
    has_number = F.coalesce(F.col("registration_number") != "", F.lit(False))
    outcome = (
        F.when(F.col("status") != P.APPROVED, F.lit(OUTCOME_NEEDS_APPROVAL))
        .when(F.col("already_processed"), F.lit(OUTCOME_UNCHANGED))
        .when(F.col("_first_ok").isNotNull() & (F.col("seq") > F.col("_first_ok")), F.lit(OUTCOME_UNCHANGED))
        .when(F.col("_answered").isNull(), F.lit(OUTCOME_PENDING))
        .when(~F.col("accepted"), F.lit(P.SUBMISSION_FAILED))
        .when(has_number, F.lit(P.REGISTERED))
        .otherwise(F.lit(P.SUBMISSION_UNKNOWN))
    )
    df = df.withColumn("outcome", outcome)
    moved = F.col("outcome").isin(P.SUBMISSION_FAILED, P.REGISTERED, P.SUBMISSION_UNKNOWN)
    outcomes = df.select(
        "request_id", "opportunity_id", "fingerprint", "seq", "outcome",
        F.when(moved, F.col("outcome")).otherwise(F.col("status")).alias("status"),
        F.when(F.col("outcome") == P.SUBMISSION_FAILED, F.col("message")).alias("error"),
        F.when(F.col("outcome").isin(P.REGISTERED, P.SUBMISSION_UNKNOWN),
               F.col("registration_number")).alias("registration_number"),
        F.when(F.col("outcome") == OUTCOME_NEEDS_APPROVAL, F.lit(P.REASON_NEEDS_APPROVAL))
        .when(F.col("outcome") == OUTCOME_UNCHANGED, F.lit(P.REASON_UNCHANGED))
        .when(F.col("outcome") == P.SUBMISSION_FAILED, F.col("message")).alias("reason"),
        F.col("outcome").isin(P.REGISTERED, P.SUBMISSION_UNKNOWN).alias("processed"),
        F.col("outcome").isin(OUTCOME_NEEDS_APPROVAL, OUTCOME_UNCHANGED).alias("skipped"),
        "last_event_seq",
    )
    steps = (
        F.when(F.col("outcome") == P.SUBMISSION_FAILED, F.array(
            F.struct(F.lit(1).alias("k"), F.lit(P.APPROVED).alias("f"),
                     F.lit(P.SUBMISSION_FAILED).alias("t"), F.col("error").alias("r"))))
        .when(F.col("outcome") == P.REGISTERED, F.array(
            F.struct(F.lit(1).alias("k"), F.lit(P.APPROVED).alias("f"),
                     F.lit(P.SUBMITTED).alias("t"), F.lit(None).cast("string").alias("r")),
            F.struct(F.lit(2).alias("k"), F.lit(P.SUBMITTED).alias("f"),
                     F.lit(P.REGISTERED).alias("t"), F.lit(None).cast("string").alias("r"))))
        .when(F.col("outcome") == P.SUBMISSION_UNKNOWN, F.array(
            F.struct(F.lit(1).alias("k"), F.lit(P.APPROVED).alias("f"),
                     F.lit(P.SUBMISSION_UNKNOWN).alias("t"), F.lit(None).cast("string").alias("r"))))
    )
    ev = outcomes.where(moved).select(
        "request_id", "opportunity_id", "last_event_seq", F.explode(steps).alias("e"))
    seq = (F.col("last_event_seq") + F.col("e.k")).cast("bigint")
    events = ev.select(
        event_id_expr("request_id", seq).alias("event_id"), "request_id", "opportunity_id",
        F.col("e.f").alias("from_status"), F.col("e.t").alias("to_status"),
        F.lit(None).cast("string").alias("actor"), F.col("e.r").alias("reason"),
        clock_column(run_clock).alias("occurred_at"), seq.alias("event_seq"),
    )
    processed_rows = outcomes.where(F.col("processed")).select(*VERSION_KEYS).dropDuplicates(
        VERSION_KEYS).withColumn("processed_at", clock_column(run_clock))
    return outcomes.drop("last_event_seq"), events, processed_rows
