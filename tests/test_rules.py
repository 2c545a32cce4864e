"""Eligibility, validation and evaluation (W6, W7, W16) on hand-made rows."""

import math

from pyspark.sql import functions as F

from tidemark.operators import rules
from tidemark.plans import policy as P
from tidemark.sources import records as R

PARTNER = "Preferred"
POLICY = P.default_policy(PARTNER)


def fixture_rows():
    """25 flat records shaped like the reference's sample: 4 ineligible,
    3 failing validation, 18 valid. Names are invented."""
    base = dict(AccountName="Acct", OpportunityName="Deal", Amount="100000", Stage="Proposal",
                CloseDate="2026-10-01", Partner=PARTNER, RegistrationRequired="true",
                RegistrationStatus="Not Registered", Industry="Retail", Country="India")
    out = []
    for i in range(1, 26):
        r = dict(base, OpportunityId=f"OPP-{1000 + i}", AccountName=f"Acct {i}",
                 OpportunityName=f"Deal {i}")
        out.append(r)
    out[2]["Partner"] = "Other"              # OPP-1003
    out[16]["Partner"] = "Other"             # OPP-1017
    out[3]["RegistrationRequired"] = "false"  # OPP-1004
    out[4]["RegistrationStatus"] = "Registered"  # OPP-1005
    out[6]["Amount"] = ""                    # OPP-1007
    out[7]["Amount"] = "-5000"               # OPP-1008
    out[8]["CloseDate"] = "invalid-date"     # OPP-1009
    return out


def test_fixture_statuses(spark):
    deals = R.to_deals_flat(R.from_rows(spark, fixture_rows()))
    ev = rules.evaluate(deals, POLICY)
    got = {r["opportunity_id"]: (r["status"], r["error"]) for r in ev.collect()}
    assert len(got) == 25
    assert {k for k, v in got.items() if v[0] == P.NOT_ELIGIBLE} == {
        "OPP-1003", "OPP-1004", "OPP-1005", "OPP-1017"}
    assert got["OPP-1007"] == (P.VALIDATION_FAILED, "Missing: amount")
    assert got["OPP-1008"] == (P.VALIDATION_FAILED, "Invalid value: amount must be greater than 0")
    assert got["OPP-1009"] == (P.VALIDATION_FAILED, "Invalid format: close_date must be YYYY-MM-DD")
    assert sum(1 for v in got.values() if v[0] == P.VALIDATED) == 18
    assert got["OPP-1001"] == (P.VALIDATED, None)
    summary = rules.readiness_summary(ev).collect()[0]
    assert (summary.opportunities, summary.validated, summary.validation_failures) == (25, 18, 3)


def test_board_reason_blank_for_not_eligible(spark):
    deals = R.to_deals_flat(R.from_rows(spark, fixture_rows()))
    board = {r["opportunity"]: r for r in rules.readiness_board(rules.evaluate(deals, POLICY)).collect()}
    assert board["OPP-1003"]["eligibility"] == "Not eligible"
    assert board["OPP-1003"]["reason"] == ""
    assert board["OPP-1007"]["reason"] == "Missing: amount"


def test_eligibility_reasons(spark):
    data = [("Other", True, "Not Registered"), ("", True, "x"), (PARTNER, False, "x"),
            (PARTNER, True, " REGISTERED "), (PARTNER, True, "Not Registered"),
            (PARTNER + "\t", True, "Not Registered"), (None, None, None)]
    df = spark.createDataFrame(data, "partner string, registration_required boolean, "
                                     "registration_status string")
    out = [(r.eligible, r.eligibility_reason) for r in rules.with_eligibility(df, PARTNER).collect()]
    assert out == [
        (False, "Partner is 'Other', not Preferred"),
        (False, "Partner is 'blank', not Preferred"),
        (False, "Registration is not required for this deal"),
        (False, "Deal is already registered"),
        (True, ""),
        (True, ""),  # trailing tab is trimmed
        (False, "Partner is 'blank', not Preferred"),  # NULL reads as blank
    ]


def _errors(spark, record):
    cols = list(P.VALIDATION_COLUMNS)
    df = spark.createDataFrame([tuple(record.get(c) for c in cols)],
                               ", ".join(f"{c} string" for c in cols))
    return rules.with_validation(df, POLICY).collect()[0]["validation_errors"]


VALID = dict(account_name="Harbour Freight Lab", opportunity_name="Crane telemetry", country="Chile",
             amount="4820.75", industry="Shipping", partner=PARTNER,
             close_date="2031-07-04")


def test_valid_and_invalid_record(spark):
    assert _errors(spark, VALID) == []
    errs = _errors(spark, dict(VALID, amount="4,820", close_date="July 2031"))
    assert errs == ["Invalid format: amount must be numeric",
                    "Invalid format: close_date must be YYYY-MM-DD"]


def test_all_errors_reported_in_rule_order(spark):
    errs = _errors(spark, dict(VALID, account_name="  ", amount="-1", partner="Other",
                               close_date="2031-02-30"))
    assert errs == [
        "Missing: account_name",
        "Invalid value: amount must be greater than 0",
        "Invalid format: close_date must be YYYY-MM-DD",
        "Invalid value: partner must be one of ['Preferred']",
    ]


def test_null_cell_is_missing(spark):
    assert _errors(spark, dict(VALID, country=None)) == ["Missing: country"]


# numeric text -> accepted?
NUMERIC_CASES = {
    "1e5": True, " 12 ": True, "\t7\n": True, "nan": True, "inf": True, "+5": True,
    ".5": True, "5.": True, "1d": False, "1.5f": False, "1,000": False, "0x10": False,
    "1_000": False, "abc": False,
}
DATE_CASES = {
    "2026-09-30": True, "2026-9-5": True, " 2026-09-30 ": True, "2026": False,
    "2026-09": False, "2026-09-15T00:00": False, "+2026-01-01": False, "12026-01-01": False,
    "0000-01-01": False, "2026-009-15": False, "2026-02-30": False, "30-09-2026": False,
    "26-09-15": False, "2024-02-29": True,
}


def test_numeric_parsing_parity(spark):
    for text, ok in NUMERIC_CASES.items():
        errs = _errors(spark, dict(VALID, amount=text))
        assert ("Invalid format: amount must be numeric" not in errs) == ok, text


def test_date_parsing_parity(spark):
    for text, ok in DATE_CASES.items():
        errs = _errors(spark, dict(VALID, close_date=text))
        assert ("Invalid format: close_date must be YYYY-MM-DD" not in errs) == ok, text


def test_nan_and_infinity_amounts(spark):
    df = spark.createDataFrame([(v,) for v in (math.nan, math.inf, -math.inf, 0.0)], "amount double")
    pol = P.Policy(partner=PARTNER, required_fields=("amount",), date_fields=())
    out = [r.validation_errors for r in rules.with_validation(df, pol).collect()]
    assert out[0] == [] and out[1] == []
    assert out[2] == ["Invalid value: amount must be greater than 0"]
    assert out[3] == ["Invalid value: amount must be greater than 0"]


def test_batch_plan_has_no_python_and_one_stage(spark):
    deals = R.to_deals_flat(R.from_rows(spark, fixture_rows()))
    plan = rules.evaluate(deals, POLICY)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_pick(spark):
    deals = R.to_deals_flat(R.from_rows(spark, fixture_rows()))
    assert rules.pick(deals, "opportunity_id", "OPP-1002").count() == 1
    assert deals.where(F.col("opportunity_id") == "nope").count() == 0


def test_evaluate_pipeline_is_whole_stage_codegen(spark):
    """No expression in evaluate / fingerprint / ids falls back to
    interpreted evaluation (a higher-order function would switch the
    projection off whole-stage codegen)."""
    from tests.conftest import SF_SMALL
    from tidemark.operators import audit, versions
    from tidemark.sources import testdata as T

    ev = audit.with_request_id(versions.with_fingerprint(
        rules.evaluate(T.deal_view(spark, SF_SMALL), POLICY)))
    ev.collect()
    final = ev._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    projects = [line for line in final.splitlines() if "Project [" in line]
    assert projects and all("*(" in line for line in projects)
