"""The event log by request: lookups against plain Python, and what they read."""

import os

import pytest

from tidemark.sources import event_log

SCHEMA = "request_id string, event_seq long, to_status string"


@pytest.mark.parametrize("most", [1000, 3])
def test_lookups_read_their_buckets_only(spark, tmp_dir, monkeypatch, most):
    monkeypatch.setattr(event_log, "LISTED_IDS", most)
    hot = [("hot", i, "s") for i in range(400)]
    rows = [(f"r{i % 200}", i // 200, f"s{i % 7}") for i in range(800)]
    for batch_id, part in ((0, rows[:400] + hot[:100]), (1, rows[400:] + hot[100:]), (1, rows[400:] + hot[100:])):
        event_log.append(spark.createDataFrame(part, SCHEMA), tmp_dir, batch_id, buckets=16)  # batch 1 is written again
    assert event_log.read(spark, tmp_dir, 16).count() == 1200
    ids = spark.createDataFrame([("r3",), ("r77",), ("hot",), ("r3",), (None,), ("nobody",)], "request_id string")
    got = event_log.history(spark, tmp_dir, ids, 16)
    assert sorted(tuple(r) for r in got.select("request_id", "event_seq", "to_status").collect()) == sorted(
        r for r in rows + hot if r[0] in {"r3", "r77", "hot"})
    if most > 3:
        plan = got._jdf.queryExecution().executedPlan().toString()
        scan = [x for x in plan.splitlines() if "PartitionFilters" in x][0]
        assert "bucket" in scan.split("PartitionFilters")[1].split("]")[0] and "In(request_id" in scan
        files = {os.path.basename(os.path.dirname(r.f)) for r in got.selectExpr("input_file_name() AS f").distinct().collect()}
        assert 1 <= len(files) <= 3
    assert event_log.history(spark, tmp_dir, ids.limit(0), 16).count() == 0
