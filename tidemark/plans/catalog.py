"""Named queries over the driver tables, each with an independent DuckDB oracle.

``QUERIES[name](spark, sf_dir) -> DataFrame`` runs an operator over the whole
tables; ``ORACLE_SQL[name]`` is the same result written directly in SQL
(no shared code with the Spark side). Output hygiene for value hashing: no
array/map columns, money as ``decimal(18,2)``, counts as ``bigint``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import rules
from tidemark.plans import policy as P
from tidemark.sources import testdata as T

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn

    return deco


POLICY = P.default_policy(T.TEST_PARTNER)


def _evaluated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.evaluate(T.deal_view(spark, sf_dir), POLICY)


# --------------------------------------------------------------------------
# Oracle building blocks (DuckDB SQL text)
# --------------------------------------------------------------------------

SQL_DEALS = """
deals AS (
  SELECT CAST(o.o_orderkey AS VARCHAR) AS opportunity_id,
         c.c_name AS account_name,
         c.c_name || ' / ' || o.o_orderpriority AS opportunity_name,
         n.n_name AS country,
         CASE WHEN o.o_orderkey % 11 = 0 THEN NULL
              WHEN o.o_orderkey % 13 = 0 THEN -o.o_totalprice
              ELSE o.o_totalprice END AS amount,
         c.c_mktsegment AS industry,
         CASE WHEN o.o_orderpriority = '5-LOW' THEN 'Other' ELSE 'Preferred' END AS partner,
         CASE WHEN o.o_orderkey % 17 = 0 THEN 'invalid-date'
              ELSE strftime(o.o_orderdate, '%Y-%m-%d') END AS close_date,
         o.o_orderpriority <> '4-NOT SPECIFIED' AS registration_required,
         CASE WHEN o.o_orderstatus = 'F' THEN 'Registered' ELSE 'Not Registered' END
           AS registration_status,
         o.o_orderdate AS source_updated_at,
         o.o_custkey AS account_key
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""

def rules_sql(deals_cte: str = SQL_DEALS) -> str:
    """Rules over any ``deals`` CTE: ``ruled`` and ``evaluated`` CTEs."""
    return deals_cte + """,
ruled AS (
  SELECT d.*,
    coalesce(trim(partner) = 'Preferred', false)
      AND coalesce(registration_required, false)
      AND lower(coalesce(trim(registration_status), '')) <> 'registered' AS eligible,
    CASE WHEN coalesce(trim(partner), '') <> 'Preferred'
           THEN 'Partner is ''' || coalesce(nullif(partner, ''), 'blank') || ''', not Preferred'
         WHEN NOT coalesce(registration_required, false)
           THEN 'Registration is not required for this deal'
         WHEN lower(coalesce(trim(registration_status), '')) = 'registered'
           THEN 'Deal is already registered'
         ELSE '' END AS eligibility_reason,
    concat_ws('; ',
      CASE WHEN account_name IS NULL OR trim(account_name) = '' THEN 'Missing: account_name' END,
      CASE WHEN opportunity_name IS NULL OR trim(opportunity_name) = '' THEN 'Missing: opportunity_name' END,
      CASE WHEN country IS NULL OR trim(country) = '' THEN 'Missing: country' END,
      CASE WHEN amount IS NULL THEN 'Missing: amount' END,
      CASE WHEN industry IS NULL OR trim(industry) = '' THEN 'Missing: industry' END,
      CASE WHEN partner IS NULL OR trim(partner) = '' THEN 'Missing: partner' END,
      CASE WHEN close_date IS NULL OR trim(close_date) = '' THEN 'Missing: close_date' END,
      CASE WHEN amount <= 0 THEN 'Invalid value: amount must be greater than 0' END,
      CASE WHEN NOT (close_date IS NULL OR trim(close_date) = '')
            AND (NOT regexp_matches(trim(close_date), '^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$')
                 OR TRY_CAST(trim(close_date) AS DATE) IS NULL)
           THEN 'Invalid format: close_date must be YYYY-MM-DD' END,
      CASE WHEN NOT (partner IS NULL OR trim(partner) = '') AND trim(partner) <> 'Preferred'
           THEN 'Invalid value: partner must be one of [''Preferred'']' END
    ) AS all_errors
  FROM deals d
),
evaluated AS (
  SELECT *,
    CASE WHEN NOT eligible THEN 'NOT_ELIGIBLE'
         WHEN all_errors = '' THEN 'VALIDATED'
         ELSE 'VALIDATION_FAILED' END AS status,
    CASE WHEN eligible THEN all_errors ELSE '' END AS errors_text
  FROM ruled
)"""


SQL_RULES = rules_sql()


# --------------------------------------------------------------------------
# Deals, eligibility, validation, evaluation, board
# --------------------------------------------------------------------------


@register("deal_view", f"""
WITH {SQL_DEALS}
SELECT opportunity_id, account_name, opportunity_name, country,
       CAST(amount AS DECIMAL(18,2)) AS amount, industry, partner, close_date,
       registration_required, registration_status, source_updated_at
FROM deals""")
def q_deal_view(spark, sf_dir):
    d = T.deal_view(spark, sf_dir)
    return d.select(
        "opportunity_id", "account_name", "opportunity_name", "country",
        F.col("amount").cast("decimal(18,2)").alias("amount"), "industry", "partner",
        "close_date", "registration_required", "registration_status", "source_updated_at",
    )


@register("eligibility", f"""
WITH {SQL_RULES}
SELECT opportunity_id, eligible, eligibility_reason FROM ruled""")
def q_eligibility(spark, sf_dir):
    d = rules.with_eligibility(T.deal_view(spark, sf_dir), T.TEST_PARTNER)
    return d.select("opportunity_id", "eligible", "eligibility_reason")


@register("validation_errors", f"""
WITH {SQL_RULES}
SELECT opportunity_id, all_errors AS errors,
       CAST(CASE WHEN all_errors = '' THEN 0
                 ELSE length(all_errors) - length(replace(all_errors, '; ', ';')) + 1 END
            AS BIGINT) AS n_errors
FROM ruled""")
def q_validation_errors(spark, sf_dir):
    d = rules.with_validation(T.deal_view(spark, sf_dir), POLICY)
    return d.select(
        "opportunity_id",
        F.array_join("validation_errors", P.ERROR_SEPARATOR).alias("errors"),
        F.size("validation_errors").cast("bigint").alias("n_errors"),
    )


@register("evaluate_status", f"""
WITH {SQL_RULES}
SELECT opportunity_id, status, nullif(errors_text, '') AS error FROM evaluated""")
def q_evaluate_status(spark, sf_dir):
    return _evaluated(spark, sf_dir).select("opportunity_id", "status", "error")


@register("status_counts", f"""
WITH {SQL_RULES}
SELECT status, CAST(count(*) AS BIGINT) AS n FROM evaluated GROUP BY status""")
def q_status_counts(spark, sf_dir):
    return rules.status_counts(_evaluated(spark, sf_dir))


@register("readiness_board", f"""
WITH {SQL_RULES}
SELECT opportunity_id AS opportunity, account_name AS account,
       CAST(amount AS DECIMAL(18,2)) AS amount, partner,
       CASE WHEN status <> 'NOT_ELIGIBLE' THEN 'Eligible' ELSE 'Not eligible' END AS eligibility,
       status AS validation, errors_text AS reason
FROM evaluated""")
def q_readiness_board(spark, sf_dir):
    return rules.readiness_board(_evaluated(spark, sf_dir))


@register("readiness_summary", f"""
WITH {SQL_RULES}
SELECT CAST(count(*) AS BIGINT) AS opportunities,
       CAST(count(*) FILTER (WHERE status = 'VALIDATED') AS BIGINT) AS validated,
       CAST(count(*) FILTER (WHERE status = 'VALIDATION_FAILED') AS BIGINT) AS validation_failures
FROM evaluated""")
def q_readiness_summary(spark, sf_dir):
    return rules.readiness_summary(_evaluated(spark, sf_dir))


# Themed catalogue modules register into QUERIES / ORACLE_SQL on import.
from tidemark.plans import catalog_records  # noqa: E402,F401
from tidemark.plans import catalog_lifecycle  # noqa: E402,F401
from tidemark.plans import catalog_submission  # noqa: E402,F401
from tidemark.plans import catalog_streaming  # noqa: E402,F401
