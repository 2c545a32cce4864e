"""Eligibility, validation and evaluation of deals (row-local, no shuffle).

Each function adds columns with one projection; Catalyst fuses them with the
scan into a single whole-stage-codegen stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tidemark.functions.text import (
    as_column,
    clean_text,
    is_blank,
    is_calendar_date,
    try_double,
    ws_trim,
)
from tidemark.plans import policy as P


# separator for building the error list; never part of a message
_LIST_SEP = "\u0001"


def eligible_expr(partner: str) -> Column:
    """Trimmed partner equals the policy partner, registration required,
    and the status is not (case-insensitively) ``registered``. Never NULL."""
    return (
        (clean_text("partner") == F.lit(partner))
        & F.coalesce(F.col("registration_required"), F.lit(False))
        & (F.lower(clean_text("registration_status")) != F.lit("registered"))
    )


def eligibility_reason_expr(partner: str) -> Column:
    """Text of the first failing rule, ``''`` when eligible."""
    shown = F.coalesce(F.nullif(F.col("partner"), F.lit("")), F.lit("blank"))
    partner_msg = F.format_string(
        P.MSG_PARTNER.replace("{shown}", "%s").replace("{partner}", partner.replace("%", "%%")),
        shown,
    )
    return (
        F.when(clean_text("partner") != F.lit(partner), partner_msg)
        .when(~F.coalesce(F.col("registration_required"), F.lit(False)), F.lit(P.MSG_NOT_REQUIRED))
        .when(F.lower(clean_text("registration_status")) == F.lit("registered"),
              F.lit(P.MSG_ALREADY_REGISTERED))
        .otherwise(F.lit(""))
    )


def with_eligibility(deals: DataFrame, partner: str = "Preferred") -> DataFrame:
    """``eligible`` flag and ``eligibility_reason`` text."""
    return deals.withColumn("eligible", eligible_expr(partner)).withColumn(
        "eligibility_reason", eligibility_reason_expr(partner)
    )


def _numeric_rules(df: DataFrame, name: str) -> list[Column]:
    col = F.col(name)
    dtype = df.schema[name].dataType
    blank = is_blank(col)
    if isinstance(dtype, NumericType):
        value = col.cast("double")
        return [F.when(~blank & (value <= 0), F.lit(P.MSG_NOT_POSITIVE.format(field=name)))]
    value = try_double(col)
    return [
        F.when(~blank & value.isNotNull() & (value <= 0),
               F.lit(P.MSG_NOT_POSITIVE.format(field=name))),
        F.when(~blank & value.isNull(), F.lit(P.MSG_NOT_NUMERIC.format(field=name))),
    ]


def validation_errors_expr(df: DataFrame, policy: P.Policy) -> Column:
    """V0-V5 compiled into one ``array<string>`` expression, in rule order.

    Required checks first, then numeric, date and allowed-value checks; all
    failures are reported, none short-circuits another.
    """
    checks: list[Column] = []
    for name in policy.required_fields:
        checks.append(F.when(is_blank(name), F.lit(P.MSG_MISSING.format(field=name))))
    for name in policy.numeric_fields:
        checks.extend(_numeric_rules(df, name))
    for name in policy.date_fields:
        checks.append(
            F.when(~is_blank(name) & ~is_calendar_date(name),
                   F.lit(P.MSG_BAD_DATE.format(field=name)))
        )
    for name, allowed in policy.allowed_values.items():
        if not allowed:
            continue
        text = P.MSG_NOT_ALLOWED.format(field=name, allowed=list(allowed))
        checks.append(
            F.when(~is_blank(name) & ~ws_trim(name).isin(list(allowed)), F.lit(text))
        )
    if not checks:
        return F.array().cast("array<string>")
    # the failing checks, in order: concat_ws skips NULLs, split restores the
    # list. (array_compact would be rewritten to a higher-order filter, which
    # has no generated code and would switch the whole projection off
    # whole-stage codegen.)
    joined = F.concat_ws(_LIST_SEP, *checks)
    return F.when(joined == "", F.array().cast("array<string>")).otherwise(
        F.split(joined, _LIST_SEP))


def with_validation(df: DataFrame, policy: P.Policy | None = None) -> DataFrame:
    """``validation_errors`` (array) for every row of ``df``."""
    policy = policy or P.default_policy()
    return df.withColumn("validation_errors", validation_errors_expr(df, policy))


def evaluate(deals: DataFrame, policy: P.Policy | None = None) -> DataFrame:
    """J8 in bulk: status, validation errors and error text for every deal.

    Ineligible deals stop at NOT_ELIGIBLE with no errors (validation is not
    applied to them); eligible ones end VALIDATED or VALIDATION_FAILED.
    ``error`` holds the joined errors, NULL when there are none.
    """
    policy = policy or P.default_policy()
    errors = validation_errors_expr(deals, policy)
    eligible = eligible_expr(policy.partner)
    empty = F.array().cast("array<string>")
    out = (
        deals.withColumn("eligible", eligible)
        .withColumn("eligibility_reason", eligibility_reason_expr(policy.partner))
        .withColumn("validation_errors", F.when(F.col("eligible"), errors).otherwise(empty))
    )
    status = (
        F.when(~F.col("eligible"), F.lit(P.NOT_ELIGIBLE))
        .when(F.size("validation_errors") == 0, F.lit(P.VALIDATED))
        .otherwise(F.lit(P.VALIDATION_FAILED))
    )
    return out.withColumn("status", status).withColumn(
        "error",
        F.when(F.size("validation_errors") > 0,
               F.array_join("validation_errors", P.ERROR_SEPARATOR)),
    )


def readiness_board(evaluated: DataFrame) -> DataFrame:
    """O1: one display row per deal (reason = joined errors, blank when none)."""
    return evaluated.select(
        F.col("opportunity_id").alias("opportunity"),
        F.col("account_name").alias("account"),
        F.col("amount").cast("decimal(18,2)").alias("amount"),
        F.col("partner").alias("partner"),
        F.when(F.col("status") != P.NOT_ELIGIBLE, F.lit("Eligible"))
        .otherwise(F.lit("Not eligible")).alias("eligibility"),
        F.col("status").alias("validation"),
        F.array_join("validation_errors", P.ERROR_SEPARATOR).alias("reason"),
    )


def readiness_summary(evaluated: DataFrame) -> DataFrame:
    """O2: the three headline counts (one partial+final global aggregate)."""
    return evaluated.agg(
        F.count(F.lit(1)).cast("bigint").alias("opportunities"),
        F.count_if(F.col("status") == P.VALIDATED).cast("bigint").alias("validated"),
        F.count_if(F.col("status") == P.VALIDATION_FAILED).cast("bigint").alias("validation_failures"),
    )


def status_counts(evaluated: DataFrame) -> DataFrame:
    """Rows per status (partial aggregation before the shuffle)."""
    return evaluated.groupBy("status").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def pick(df: DataFrame, key: str, value: str) -> DataFrame:
    """The row(s) with ``key == value`` (a pushed-down filter)."""
    return df.where(as_column(key) == F.lit(value))
