"""Sources and canonicalisation (W1-W3, W11 payload)."""

import datetime as dt
import json
import os

from tidemark.operators import submission as S
from tidemark.sources import records as R

from .test_rules import fixture_rows


def test_csv_scan_blank_is_null_and_rules_hold(spark, tmp_dir):
    path = os.path.join(tmp_dir, "opps.csv")
    cols = list(R.FLAT_COLUMNS)
    with open(path, "w", encoding="utf-8") as f:
        f.write(",".join(cols) + "\n")
        for r in fixture_rows():
            f.write(",".join(r[c] for c in cols) + "\n")
    raw = R.read_flat(spark, path)
    assert raw.count() == 25
    assert raw.where("OpportunityId = 'OPP-1007'").collect()[0]["Amount"] is None
    deals = R.to_deals_flat(raw)
    first = deals.where("opportunity_id = 'OPP-1001'").collect()[0]
    assert first.source_system == "flat-file" and first.source_record_id == "OPP-1001"
    assert first.amount == 100000.0 and first.registration_required is True
    assert first.source_updated_at is None  # no change-time column in the file


def test_alias_normalisation(spark):
    df = spark.createDataFrame([("lost", "Quarry pumps", "7.5e3", "k-88", "Peru")],
                               "Stage string, Opportunity_Name string, Amount string, "
                               "OpportunityId string, Country string")
    out = R.normalize_fields(df)
    assert set(out.columns) == {"opportunity_id", "opportunity_name", "country", "amount"}
    row = out.collect()[0]
    assert (row.opportunity_id, row.opportunity_name, row.country, row.amount) == (
        "k-88", "Quarry pumps", "Peru", "7.5e3")


def test_first_spelling_wins(spark):
    df = spark.createDataFrame([("a", "b")], "Account_Name string, AccountName string")
    assert R.normalize_fields(df).collect()[0]["account_name"] == "b"


def test_flat_timestamps_and_trim(spark):
    recs = [dict(OpportunityId=" OPP-1 ", LastModifiedDate="2031-02-28T23:45:10Z",
                 Partner="Preferred ", RegistrationRequired=" TRUE"),
            dict(OpportunityId="OPP-2", LastModifiedDate="2031-03-01T05:15:10+05:30"),
            dict(OpportunityId="OPP-3", LastModifiedDate="10:00:00"),
            dict(OpportunityId="OPP-4", LastModifiedDate="garbage")]
    deals = R.to_deals_flat(R.from_rows(spark, recs))
    got = {r.opportunity_id: r for r in deals.collect()}
    assert got["OPP-1"].partner == "Preferred" and got["OPP-1"].registration_required
    t = spark.sql("select timestamp'2031-02-28 23:45:10' as t").collect()[0].t
    assert got["OPP-1"].source_updated_at == t
    assert got["OPP-2"].source_updated_at == t
    assert got["OPP-3"].source_updated_at is None
    assert got["OPP-4"].source_updated_at is None


def test_nested_records(spark, tmp_dir):
    path = os.path.join(tmp_dir, "api.json")
    recs = [
        {"Id": "n-1", "Account": {"Name": " Harbour Freight Lab "}, "Name": "Crane telemetry",
         "Country__c": "Chile", "Amount": "4820.75", "Industry": "Shipping",
         "Partner__c": "Preferred", "CloseDate": "2031-07-04", "Registration_Required__c": "TRUE",
         "Registration_Status__c": "Registered", "LastModifiedDate": "2031-02-28T23:45:10Z"},
        {"Id": "n-2", "Account": None, "Amount": None, "Registration_Required__c": "false"},
        {"Id": "n-3", "Amount": "abc"},
    ]
    with open(path, "w") as f:
        for r in recs:
            f.write(json.dumps(r) + "\n")
    deals = {r.opportunity_id: r for r in R.to_deals_nested(R.read_nested(spark, path)).collect()}
    a = deals["n-1"]
    assert (a.account_name, a.amount, a.registration_status) == ("Harbour Freight Lab", 4820.75, "Registered")
    assert (a.country, a.close_date, a.registration_required, a.source_system) == (
        "Chile", "2031-07-04", True, "api")
    b = deals["n-2"]
    assert (b.account_name, b.amount, b.registration_required, b.registration_status) == (
        "", 0.0, False, "Not Registered")
    assert deals["n-3"].amount is None


def test_envelope_unwrap(spark, tmp_dir):
    path = os.path.join(tmp_dir, "pages.json")
    with open(path, "w") as f:
        f.write(json.dumps({"records": [{"Id": "A"}, {"Id": "B"}]}) + "\n")
        f.write(json.dumps({"totalSize": 0}) + "\n")
    assert sorted(r.Id for r in R.read_envelopes(spark, path).collect()) == ["A", "B"]


def test_payload_mapping(spark):
    df = spark.createDataFrame([("r-5", "2031-07-04", "Shipping", "Preferred", "x")],
                               "request_id string, close_date string, industry string, partner string, stage string")
    p = S.to_payload(df, keep=("request_id",))
    assert p.columns == ["request_id", "industry", "partner_name", "expected_close_date"]
    assert tuple(p.collect()[0]) == ("r-5", "Shipping", "Preferred", "2031-07-04")


def test_payload_contract(spark):
    df = spark.createDataFrame([("Tannery 9", "Belts"), ("Tannery 9", None), ("  ", "Belts"), ("", "Belts")],
                               "customer_name string, deal_name string")
    out = [(r.contract_ok, r.contract_message) for r in S.check_payload_contract(df).collect()]
    msg = "Draft contract requires customer_name and deal_name"
    assert out == [(True, None), (False, msg), (True, None), (False, msg)]


def test_ordering_helpers(spark):
    df = spark.createDataFrame([("a", dt.datetime(2026, 1, 2)), ("b", dt.datetime(2026, 1, 1)),
                                ("c", None)], "id string, source_updated_at timestamp")
    assert [r.id for r in R.newest_first(df).collect()] == ["a", "b", "c"]
    assert [r.id for r in R.oldest_first(df).collect()] == ["c", "b", "a"]


def test_timestamp_text_is_matched_whole(spark):
    from tidemark.functions.text import try_timestamp

    texts = ["2031-02-03T04:05:06 Europe/Paris", "2031-02-03T04:05:06UTC", "2031-02-03T04:05:06 PST", "2031-02-03T4:5:6", "04:05:06"]
    good = ["2031-02-03", "2031-02-03T04:05:06Z", "2031-02-03 04:05", "2031-02-03T04:05:06.25+01:00"]
    df = spark.createDataFrame([(t,) for t in texts + good], "t string").select(try_timestamp("t").alias("v"))
    assert [r.v is not None for r in df.collect()] == [False] * len(texts) + [True] * len(good)


def test_chosen_fields_are_read_and_the_rest_is_blank(spark, tmp_dir):
    path = f"{tmp_dir}/chosen"
    line = '{"Id": "1", "Account": {"Name": "Acme", "Id": "x"}, "Name": "Deal", "Amount": 5, "Extra__c": "more"}'
    spark.createDataFrame([(line,)], "value string").write.text(path)
    got = R.read_nested(spark, path, ["Id", "Account.Name", "Extra__c"])
    assert got.collect()[0].asDict(True) == {"Id": "1", "Account": {"Name": "Acme"}, "Extra__c": "more"}
    whole = R.with_all_fields(got)
    assert whole.columns == R.NESTED_SCHEMA.fieldNames()
    assert whole.select("Id", "Account.Name", "Amount").collect()[0] == ("1", "Acme", None)
    assert R.to_deals_nested(whole).collect()[0].account_name == "Acme"
    # records of another shape in a field of the list are not taken for it
    assert R.with_all_fields(R.read_nested(spark, path, ["Id", "Account"])).collect()[0].Account is None
