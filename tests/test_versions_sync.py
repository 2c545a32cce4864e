"""Fingerprints, processed sets (W8-W9) and high-water marks."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import sync, versions

DEAL = dict(opportunity_id="k-88", account_name="Harbour Freight Lab", opportunity_name="Crane telemetry",
            country="Chile", amount=4820.75, industry="Shipping", partner="Preferred",
            close_date="2031-07-04", registration_required=False,
            registration_status="Registered")
SCHEMA = ("opportunity_id string, account_name string, opportunity_name string, country string, "
          "amount double, industry string, partner string, close_date string, "
          "registration_required boolean, registration_status string")


def fp(spark, **changes):
    row = dict(DEAL, **changes)
    df = spark.createDataFrame([tuple(row.values())], SCHEMA)
    return versions.with_fingerprint(df).collect()[0]["fingerprint"]


def test_business_change_changes_fingerprint(spark):
    base = fp(spark)
    assert len(base) == 64
    for field, value in (("amount", 4820.76), ("industry", "shipping"), ("registration_required", True),
                         ("registration_status", None)):
        assert fp(spark, **{field: value}) != base, field
    # typed: text 310 and 310.0 canonicalise to the same double
    from tidemark.sources import records as R

    recs = [dict(OpportunityId="X", Amount="310"), dict(OpportunityId="X", Amount="310.0 ")]
    fps = versions.with_fingerprint(R.to_deals_flat(R.from_rows(spark, recs))).collect()
    assert fps[0].fingerprint == fps[1].fingerprint


def test_null_and_blank_differ_and_fields_do_not_run_together(spark):
    assert fp(spark, country=None) != fp(spark, country="")
    assert fp(spark, account_name="a|b", opportunity_name="c") != fp(
        spark, account_name="a", opportunity_name="b|c")


def test_source_columns_do_not_matter(spark):
    row = dict(DEAL)
    df = spark.createDataFrame([tuple(row.values())], SCHEMA).withColumn("stage", F.lit("x"))
    assert versions.with_fingerprint(df).collect()[0]["fingerprint"] == fp(spark)


def test_processed_is_history_a_b_a(spark):
    processed = spark.createDataFrame([("O", "A"), ("O", "B")], "opportunity_id string, fingerprint string")
    now = spark.createDataFrame([("O", "A"), ("O", "C")], "opportunity_id string, fingerprint string")
    left = versions.drop_processed(now, processed).collect()
    assert [(r.opportunity_id, r.fingerprint) for r in left] == [("O", "C")]
    new = versions.new_processed(processed, now.union(now), dt.datetime(2026, 1, 1))
    assert [(r.opportunity_id, r.fingerprint) for r in new.collect()] == [("O", "C")]


def _times(spark):
    rows = [("A", dt.datetime(2031, 2, 28, 23, 45)), ("B", dt.datetime(2031, 3, 1, 0, 30)),
            ("C", None), ("D", dt.datetime(2031, 2, 27, 6))]
    return spark.createDataFrame(rows, "opportunity_id string, source_updated_at timestamp")


def test_changed_since_strict_and_nulls(spark):
    df = _times(spark)
    assert df.transform(lambda d: sync.changed_since(d, None)).count() == 4
    mark = dt.datetime(2031, 2, 27, 6)
    got = sorted(r.opportunity_id for r in sync.changed_since(df, mark).collect())
    assert got == ["A", "B"]  # equal-to-mark and NULL times are not returned
    got = sorted(r.opportunity_id for r in sync.changed_since(df, mark, inclusive=True).collect())
    assert got == ["A", "B", "D"]
    tz_mark = dt.datetime(2031, 3, 1, 2, 30, tzinfo=dt.timezone(dt.timedelta(hours=3)))  # 23:30 UTC
    assert [r.opportunity_id for r in sync.changed_since(df, tz_mark).collect()] == ["A", "B"]


def test_next_watermark(spark):
    df = _times(spark)
    mark = dt.datetime(2031, 2, 27, 6)
    nxt = sync.next_watermark(sync.changed_since(df, mark), mark).collect()[0][0]
    assert nxt == dt.datetime(2031, 3, 1, 0, 30)
    empty = df.limit(0)
    assert sync.next_watermark(empty, mark).collect()[0][0] == mark


def test_marks_per_source_never_move_back(spark):
    deals = spark.createDataFrame(
        [("s1", dt.datetime(2026, 1, 5)), ("s1", dt.datetime(2026, 1, 7)),
         ("s2", dt.datetime(2025, 1, 1)), ("s3", dt.datetime(2026, 3, 1)), ("s1", None)],
        "source_system string, source_updated_at timestamp")
    marks = spark.createDataFrame([("s1", dt.datetime(2026, 1, 6)), ("s2", dt.datetime(2026, 1, 1)),
                                   ("s4", dt.datetime(2026, 2, 1))], "source string, watermark timestamp")
    changed = sync.changed_since_marks(deals, marks)
    assert sorted((r.source_system, r.source_updated_at) for r in changed.collect()) == [
        ("s1", dt.datetime(2026, 1, 7)), ("s3", dt.datetime(2026, 3, 1))]
    new = {r.source: r.watermark for r in sync.advance_marks(deals, marks).collect()}
    assert new == {"s1": dt.datetime(2026, 1, 7), "s2": dt.datetime(2026, 1, 1),
                   "s3": dt.datetime(2026, 3, 1), "s4": dt.datetime(2026, 2, 1)}


def test_changed_since_filter_reaches_scan(spark):
    from tests.conftest import SF_SMALL
    from tidemark.sources import testdata as T

    d = T.table(spark, SF_SMALL, "orders").withColumnRenamed("o_orderdate", "source_updated_at")
    plan = sync.changed_since(d, dt.datetime(1998, 1, 1))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(source_updated_at), GreaterThan(source_updated_at" in plan or \
        "GreaterThan(o_orderdate" in plan


def test_records_at_the_mark_come_once_over_three_syncs(spark):
    at = lambda day: dt.datetime(2026, 3, day)
    marks = spark.createDataFrame([], "source string, watermark timestamp")
    seen = spark.createDataFrame([], sync.SEEN_SCHEMA)
    landed = [
        [("a", "1", at(1)), ("a", "2", at(2)), ("b", "1", at(5)), ("c", "9", None)],
        [("a", "3", at(2)), ("a", "4", at(1)), ("b", "2", at(4)), ("b", "3", at(5)), ("b", "3", at(5))],  # ties, late ones, a repeated row
        [("a", "2", at(3)), ("a", "5", at(2)), ("b", "4", at(5)), (None, "n", at(1)), ("c", "8", at(1))],  # an updated record
    ]
    rows, got = [], []
    for part in landed:
        rows += part
        df = spark.createDataFrame(rows, "source_system string, source_id string, source_updated_at timestamp")
        new = sync.changed_since_keyset(df, marks, seen)
        got.append(sorted((r.source_system or "", r.source_id) for r in new.collect()))
        marks, seen = sync.advance_keyset(new, marks, seen)
        marks, seen = (spark.createDataFrame(t.collect(), t.schema) for t in (marks, seen))
    assert got == [
        [("a", "1"), ("a", "2"), ("b", "1"), ("c", "9")],
        [("a", "3"), ("b", "3"), ("b", "3"), ("c", "9")],
        [("", "n"), ("a", "2"), ("a", "5"), ("b", "4"), ("c", "8"), ("c", "9")],
    ]
    assert {(r.source, r.watermark, r.id) for r in seen.collect()} == {
        ("a", at(3), "2"), ("b", at(5), "1"), ("b", at(5), "3"), ("b", at(5), "4"), ("c", at(1), "8")}
    assert sync.changed_since_keyset(df, marks, seen).select("source_id").collect() == [("n",)]
