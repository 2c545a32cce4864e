"""The request table merged on read."""

import datetime as dt
import json
import random

from tidemark.sources.request_table import RequestTable

T0 = dt.datetime(2026, 1, 1)
SCHEMA = ("request_id string, opportunity_id string, status string, validation_errors array<string>, approved_by string, approved_at timestamp, "
          "registration_number string, submitted_at timestamp, error string, updated_at timestamp, change_seq long")


def change(request, seq, opportunity="o", errors=None):
    return (request, opportunity, f"S{seq}", errors, None, None, None, None, None, T0 + dt.timedelta(minutes=seq), seq)


def current(rows):
    out = {}
    for request in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == request), key=lambda r: r[-1])
        out[request] = (own[0][1], own[-1][2], json.dumps(own[-1][3] or [], separators=(",", ":"), ensure_ascii=False), own[0][9], own[-1][9])
    return out


def found(df):
    return {r.request_id: (r.opportunity_id, r.status, r.validation_errors, r.created_at, r.updated_at) for r in df.collect()}


def test_batches_in_any_order_keep_the_first_row_and_the_last_state(spark, tmp_dir):
    rng = random.Random(4)
    rows = [change(f"r{rng.randint(0, 30)}", seq, f"o{seq}", rng.choice([None, [], ['Missing: "x"', "é"]])) for seq in range(200)]
    rng.shuffle(rows)
    table = RequestTable(spark, f"{tmp_dir}/t", buckets=8)
    assert table.read().collect() == []
    for batch in range(3):
        part = spark.createDataFrame(rows[batch::3], SCHEMA)
        table.apply(part, batch)
        table.apply(part, batch)  # a retry changes nothing
        if batch == 1:
            table.compact()
    assert found(table.read()) == current(rows)
    table.compact()
    assert found(table.read()) == current(rows)
    assert found(table.read(["r3", "nobody"])) == {"r3": current(rows)["r3"]}


def test_a_bucket_that_a_batch_does_not_touch_is_not_read_or_written(spark, tmp_dir):
    table = RequestTable(spark, f"{tmp_dir}/t", buckets=8)
    table.apply(spark.createDataFrame([change(f"r{i}", 1) for i in range(60)], SCHEMA), 0)
    before = table.manifest()["live"]
    assert len(before) == 8
    table.apply(spark.createDataFrame([change("r7", 2)], SCHEMA), 1)
    after = table.compact()["live"]
    changed = {b for b in before if before[b] != after[b]}
    assert len(changed) == 1
    files = [f for f in table.read(["r7"]).inputFiles()]
    assert files and all("/base/" in f for f in files)  # the one bucket that was rewritten
    assert found(table.read(["r7"]))["r7"][1] == "S2" and table.read().count() == 60


def test_a_manifest_that_was_not_finished_is_not_seen(spark, tmp_dir):
    import os

    table = RequestTable(spark, f"{tmp_dir}/t", buckets=2)
    table.apply(spark.createDataFrame([change("a", 1)], SCHEMA), 0)
    os.makedirs(f"{tmp_dir}/t/manifest/version=2")
    assert table.manifest()["version"] == 1 and table.read().count() == 1
    table.apply(spark.createDataFrame([change("a", 2)], SCHEMA), 1)
    assert found(table.read())["a"][1] == "S2"


def test_counts_equal_a_recount_after_every_batch(spark, tmp_dir):
    rng = random.Random(9)
    states = ["VALIDATED", "VALIDATION_FAILED", "APPROVED", None]
    rows = [change(f"r{rng.randint(0, 25)}", seq)[:2] + (rng.choice(states),) + change("r", seq)[3:] for seq in range(150)]
    rng.shuffle(rows)  # older changes come late
    table = RequestTable(spark, f"{tmp_dir}/t", buckets=8)
    assert table.counts().collect() == [] and tuple(table.summary().first()) == (0, 0, 0)
    for batch in range(5):
        part = rows[batch * 30:(batch + 1) * 30]
        table.apply(spark.createDataFrame(part, SCHEMA), batch)
        table.apply(spark.createDataFrame(part, SCHEMA), batch)  # a retry counts nothing twice
        if batch == 2:
            table.compact()
        last = {}
        for r in sorted(rows[:(batch + 1) * 30], key=lambda r: r[-1]):
            last[r[0]] = r[2]
        want = {s: list(last.values()).count(s) for s in set(last.values())}
        assert {r.status: r.n for r in table.counts().collect()} == want
        assert tuple(table.summary().first()) == (len(last), want.get("VALIDATED", 0), want.get("VALIDATION_FAILED", 0))


def test_counts_read_only_the_buckets_that_a_batch_touches(spark, tmp_dir):
    table = RequestTable(spark, f"{tmp_dir}/t", buckets=8)
    before = table.apply(spark.createDataFrame([change(f"r{i}", 1) for i in range(60)], SCHEMA), 0)
    after = table.apply(spark.createDataFrame([change("r7", 2)], SCHEMA), 1)
    touched = [b for b in after["live"] if after["live"][b] != before["live"][b]]
    assert len(touched) == 1
    files = table._counted(before, after["live"], "changes/version=2").inputFiles()
    data = {f.split("/bucket=")[1].split("/")[0] for f in files if "/bucket=" in f}
    assert data == set(touched)
    assert {r.status: r.n for r in table.counts().collect()} == {"S1": 59, "S2": 1}
