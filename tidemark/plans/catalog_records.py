"""Catalogue: sources (W1-W3), fingerprints (W8), processed sets (W9), sync."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import rules, sync, versions
from tidemark.plans.catalog import POLICY, SQL_DEALS, register, rules_sql
from tidemark.plans.sql_text import fingerprint_sql
from tidemark.sources import records as R
from tidemark.session import cut_lineage
from tidemark.sources import testdata as T

SYNC_MARK = dt.datetime(1998, 1, 1)

SQL_OC = """
oc AS (
  SELECT o.*, c.c_name, c.c_nationkey, c.c_mktsegment, n.n_name
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""

SQL_FLAT = SQL_OC + """,
flat AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS "Opportunity_ID",
         c_name AS "AccountName",
         'alt ' || c_name AS "Account_Name",
         c_name || ' / ' || o_orderpriority AS "OpportunityName",
         CASE WHEN o_orderkey % 19 = 0 THEN 'n/a'
              ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS "Amount",
         CASE WHEN o_orderkey % 7 = 0 THEN '  ' || strftime(o_orderdate, '%Y-%m-%d') || ' '
              ELSE strftime(o_orderdate, '%Y-%m-%d') END AS "CloseDate",
         CASE WHEN o_orderpriority = '5-LOW' THEN 'Other'
              WHEN o_orderkey % 5 = 0 THEN 'Preferred  ' ELSE 'Preferred' END AS "Partner",
         CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'false'
              WHEN o_orderkey % 2 = 0 THEN 'TRUE' ELSE 'true' END AS "RegistrationRequired",
         CASE WHEN o_orderstatus = 'F' THEN 'registered' ELSE 'Not Registered' END
           AS "RegistrationStatus",
         c_mktsegment AS "Industry",
         n_name AS "Country",
         o_orderdate
  FROM oc
)"""

SQL_FLAT_DEALS = SQL_FLAT + """,
deals AS (
  SELECT trim("Opportunity_ID") AS opportunity_id, trim("AccountName") AS account_name,
         trim("OpportunityName") AS opportunity_name, trim("Country") AS country,
         TRY_CAST(trim("Amount") AS DOUBLE) AS amount, trim("Industry") AS industry,
         trim("Partner") AS partner, trim("CloseDate") AS close_date,
         lower(trim("RegistrationRequired")) = 'true' AS registration_required,
         trim("RegistrationStatus") AS registration_status,
         o_orderdate AS source_updated_at
  FROM flat
)"""

SQL_NESTED_DEALS = SQL_OC + """,
deals AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS opportunity_id,
         CASE WHEN o_orderkey % 23 = 0 THEN '' ELSE c_name END AS account_name,
         c_name || ' / ' || o_orderpriority AS opportunity_name,
         n_name AS country,
         CASE WHEN o_orderkey % 11 = 0 THEN 0.0
              WHEN o_orderkey % 19 = 0 THEN NULL
              ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) END AS amount,
         c_mktsegment AS industry,
         CASE WHEN o_orderpriority = '5-LOW' THEN 'Other' ELSE 'Preferred' END AS partner,
         strftime(o_orderdate, '%Y-%-m-%-d') AS close_date,
         o_orderpriority <> '4-NOT SPECIFIED' AS registration_required,
         CASE WHEN o_orderstatus = 'F' THEN 'Registered' ELSE 'Not Registered' END
           AS registration_status,
         CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderdate END AS source_updated_at
  FROM oc
)"""

DEAL_OUT_SQL = """opportunity_id, account_name, opportunity_name, country,
       CAST(amount AS DECIMAL(18,2)) AS amount, industry, partner, close_date,
       registration_required, registration_status, source_updated_at"""


def _deal_out(df):
    return df.select(
        "opportunity_id", "account_name", "opportunity_name", "country",
        F.col("amount").cast("decimal(18,2)").alias("amount"), "industry", "partner",
        "close_date", "registration_required", "registration_status",
        F.col("source_updated_at").cast("timestamp_ntz").alias("source_updated_at"),
    )


@register("normalize_fields", f"""
WITH {SQL_FLAT}
SELECT "Opportunity_ID" AS opportunity_id, "AccountName" AS account_name,
       "OpportunityName" AS opportunity_name, "Country" AS country, "Amount" AS amount,
       "Industry" AS industry, "Partner" AS partner, "CloseDate" AS close_date,
       "RegistrationRequired" AS registration_required,
       "RegistrationStatus" AS registration_status
FROM flat""")
def q_normalize_fields(spark, sf_dir):
    return R.normalize_fields(T.flat_source(spark, sf_dir))


@register("deals_flat", f"""
WITH {SQL_FLAT_DEALS}
SELECT {DEAL_OUT_SQL} FROM deals""")
def q_deals_flat(spark, sf_dir):
    return _deal_out(R.to_deals_flat(T.flat_source(spark, sf_dir)))


@register("deals_nested", f"""
WITH {SQL_NESTED_DEALS}
SELECT {DEAL_OUT_SQL} FROM deals""")
def q_deals_nested(spark, sf_dir):
    return _deal_out(R.to_deals_nested(T.nested_source(spark, sf_dir)))


@register("flat_status_counts", f"""
WITH {rules_sql(SQL_FLAT_DEALS)}
SELECT status, CAST(count(*) AS BIGINT) AS n FROM evaluated GROUP BY status""")
def q_flat_status_counts(spark, sf_dir):
    deals = R.to_deals_flat(T.flat_source(spark, sf_dir))
    return rules.status_counts(rules.evaluate(deals, POLICY))


@register("nested_evaluate", f"""
WITH {rules_sql(SQL_NESTED_DEALS)}
SELECT opportunity_id, status, nullif(errors_text, '') AS error, eligibility_reason
FROM evaluated""")
def q_nested_evaluate(spark, sf_dir):
    deals = R.to_deals_nested(T.nested_source(spark, sf_dir))
    return rules.evaluate(deals, POLICY).select("opportunity_id", "status", "error",
                                                "eligibility_reason")


@register("fingerprint", f"""
WITH {SQL_DEALS}
SELECT opportunity_id, {fingerprint_sql()} AS fingerprint FROM deals""")
def q_fingerprint(spark, sf_dir):
    return versions.with_fingerprint(T.deal_view(spark, sf_dir)).select(
        "opportunity_id", "fingerprint")


SQL_PREVIOUS = """
previous AS (
  SELECT opportunity_id, """ + fingerprint_sql() + """ AS fingerprint
  FROM (SELECT * REPLACE ('Not Registered' AS registration_status) FROM deals
        WHERE source_updated_at < TIMESTAMP '1997-01-01')
),
current AS (
  SELECT opportunity_id, """ + fingerprint_sql() + """ AS fingerprint FROM deals
)"""


@register("drop_processed", f"""
WITH {SQL_DEALS}, {SQL_PREVIOUS}
SELECT c.opportunity_id, c.fingerprint FROM current c
WHERE NOT EXISTS (SELECT 1 FROM previous p
                  WHERE p.opportunity_id = c.opportunity_id AND p.fingerprint = c.fingerprint)""")
def q_drop_processed(spark, sf_dir):
    cur = versions.with_fingerprint(T.deal_view(spark, sf_dir)).select("opportunity_id", "fingerprint")
    return versions.drop_processed(cur, T.previous_versions(spark, sf_dir))


@register("new_processed", f"""
WITH {rules_sql(SQL_DEALS)}, {SQL_PREVIOUS},
done AS (
  SELECT DISTINCT opportunity_id, {fingerprint_sql()} AS fingerprint
  FROM evaluated WHERE status = 'VALIDATED'
)
SELECT d.opportunity_id, d.fingerprint FROM done d
WHERE NOT EXISTS (SELECT 1 FROM previous p
                  WHERE p.opportunity_id = d.opportunity_id AND p.fingerprint = d.fingerprint)""")
def q_new_processed(spark, sf_dir):
    ev = versions.with_fingerprint(rules.evaluate(T.deal_view(spark, sf_dir), POLICY))
    done = ev.where(F.col("status") == "VALIDATED")
    out = versions.new_processed(T.previous_versions(spark, sf_dir), done, dt.datetime(2026, 1, 1))
    return out.select("opportunity_id", "fingerprint")


@register("changed_since", f"""
WITH {SQL_DEALS}
SELECT opportunity_id, source_updated_at FROM deals
WHERE source_updated_at > TIMESTAMP '1998-01-01'""")
def q_changed_since(spark, sf_dir):
    return sync.changed_since(T.deal_view(spark, sf_dir), SYNC_MARK).select(
        "opportunity_id", "source_updated_at")


@register("next_watermark", f"""
WITH {SQL_DEALS}
SELECT coalesce(max(source_updated_at), TIMESTAMP '1998-01-01') AS next_watermark
FROM deals WHERE source_updated_at > TIMESTAMP '1998-01-01'""")
def q_next_watermark(spark, sf_dir):
    changed = sync.changed_since(T.deal_view(spark, sf_dir), SYNC_MARK)
    return sync.next_watermark(changed, SYNC_MARK)


SQL_MARKS = """
marks AS (
  SELECT n_name AS source,
         TIMESTAMP '1995-01-01' + to_days(CAST(n_nationkey * 90 AS INTEGER)) AS watermark
  FROM nation WHERE n_regionkey <> 0
),
changed AS (
  SELECT d.* FROM deals d LEFT JOIN marks m ON d.country = m.source
  WHERE m.watermark IS NULL OR d.source_updated_at > m.watermark
)"""


@register("changed_since_marks", f"""
WITH {SQL_DEALS}, {SQL_MARKS}
SELECT opportunity_id, country, source_updated_at FROM changed""")
def q_changed_since_marks(spark, sf_dir):
    d = T.deal_view(spark, sf_dir)
    out = sync.changed_since_marks(d, T.source_marks(spark, sf_dir), source="country")
    return out.select("opportunity_id", "country", "source_updated_at")


@register("advance_marks", f"""
WITH {SQL_DEALS}, {SQL_MARKS},
seen AS (SELECT country AS source, max(source_updated_at) AS new_mark FROM changed GROUP BY 1)
SELECT coalesce(s.source, m.source) AS source,
       CASE WHEN m.watermark IS NULL THEN s.new_mark
            WHEN s.new_mark IS NULL THEN m.watermark
            WHEN s.new_mark > m.watermark THEN s.new_mark ELSE m.watermark END AS watermark
FROM seen s FULL OUTER JOIN marks m ON s.source = m.source""")
def q_advance_marks(spark, sf_dir):
    d = T.deal_view(spark, sf_dir)
    marks = T.source_marks(spark, sf_dir)
    changed = sync.changed_since_marks(d, marks, source="country")
    return sync.advance_marks(changed, marks, source="country")


@register("keyset_syncs", """
WITH landed AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority AS source, date_trunc('year', o_orderdate)::TIMESTAMP AS changed_at,
    CASE WHEN year(o_orderdate) < 1995 OR (year(o_orderdate) = 1995 AND o_orderkey % 2 = 0) THEN 1
         WHEN year(o_orderdate) <= 1996 OR (year(o_orderdate) = 1997 AND o_orderkey % 3 = 0) THEN 2 ELSE 3 END AS sync
  FROM orders
),
sync1 AS (SELECT id, source, changed_at FROM landed WHERE sync = 1),
mark1 AS (SELECT source, max(changed_at) AS mark FROM sync1 GROUP BY 1),
sync2 AS (
  SELECT id, l.source, changed_at FROM landed l LEFT JOIN mark1 m ON l.source = m.source
  WHERE sync <= 2 AND (mark IS NULL OR changed_at > mark OR (changed_at = mark AND id NOT IN (SELECT id FROM sync1)))
),
mark2 AS (SELECT source, max(changed_at) AS mark FROM (FROM sync1 UNION ALL FROM sync2) GROUP BY 1),
sync3 AS (
  SELECT id, l.source, changed_at FROM landed l LEFT JOIN mark2 m ON l.source = m.source
  WHERE mark IS NULL OR changed_at > mark OR (changed_at = mark AND id NOT IN (SELECT id FROM sync1 UNION ALL SELECT id FROM sync2))
)
SELECT 1 AS sync, id, source, changed_at FROM sync1 UNION ALL SELECT 2, id, source, changed_at FROM sync2 UNION ALL SELECT 3, id, source, changed_at FROM sync3""")
def q_keyset_syncs(spark, sf_dir):
    """Three syncs over orders landing bit by bit, with many records at every mark."""
    o, year, key = T.table(spark, sf_dir, "orders"), F.year("o_orderdate"), F.col("o_orderkey")
    first = (year < 1995) | ((year == 1995) & (key % 2 == 0))
    second = (year <= 1996) | ((year == 1997) & (key % 3 == 0))
    rows = o.select(key.cast("string").alias("id"), F.col("o_orderpriority").alias("source"),
                    F.date_trunc("year", "o_orderdate").cast("timestamp_ntz").alias("changed_at"), F.when(first, 1).when(second, 2).otherwise(3).alias("landed"))
    marks = spark.createDataFrame([], "source string, watermark timestamp_ntz")
    seen, out = spark.createDataFrame([], "source string, watermark timestamp_ntz, id string"), None
    for n in (1, 2, 3):
        new = sync.changed_since_keyset(rows.where(F.col("landed") <= n), marks, seen, "source", "changed_at", "id")
        new = cut_lineage(new.select(F.lit(n).alias("sync"), "id", "source", "changed_at"), "keyset-read")
        marks, seen = (cut_lineage(t, "keyset-state") for t in sync.advance_keyset(new, marks, seen, "source", "changed_at", "id"))
        out = new if out is None else out.unionByName(new)
    return out
