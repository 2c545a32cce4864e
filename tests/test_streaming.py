"""Structured Streaming: incremental driver (W17) and lifecycle state."""

import datetime as dt
import os

import pytest

from pyspark.sql import functions as F

from tidemark.operators import lifecycle as L
from tidemark.sources import records as R
from tidemark.streaming import incremental, lifecycle_state

from .test_lifecycle import brute_fold, random_commands
from .test_rules import POLICY, fixture_rows


def land_fixture(spark, path, n_files=3):
    rows = fixture_rows()
    for i, r in enumerate(rows):
        r["LastModifiedDate"] = f"2026-08-19T{10 + i % 10:02d}:00:00Z"
    df = R.from_rows(spark, rows)
    df.repartition(n_files, "OpportunityId").write.mode("overwrite").parquet(path)
    return df


def test_incremental_stream_and_replay_safety(spark, tmp_dir):
    src = os.path.join(tmp_dir, "landing")
    df = land_fixture(spark, src)
    sinks = incremental.run_incremental(spark, src, sinks_root=os.path.join(tmp_dir, "sinks"),
                                        checkpoint=os.path.join(tmp_dir, "ck1"), policy=POLICY,
                                        schema=df.schema)
    changes = spark.read.parquet(sinks.changes)
    assert changes.count() == 25
    assert changes.select("batch_id").distinct().count() >= 2  # several micro-batches
    assert changes.where("status = 'VALIDATED'").count() == 18
    n_events = spark.read.parquet(sinks.events).count()
    assert n_events == 25 + 21  # one event each, a second for the 21 eligible
    # a second run over the same files (fresh checkpoint, same sinks): every
    # version is already processed, nothing is emitted twice
    incremental.run_incremental(spark, src, sinks_root=sinks.root,
                                checkpoint=os.path.join(tmp_dir, "ck2"), policy=POLICY,
                                schema=df.schema)
    assert spark.read.parquet(sinks.changes).count() == 25
    assert spark.read.parquet(sinks.events).count() == n_events
    marks = spark.read.parquet(sinks.marks).agg(F.max("watermark")).collect()[0][0]
    assert marks == dt.datetime(2026, 8, 19, 19)


def test_replayed_batch_replaces_its_output(spark, tmp_dir):
    df = R.from_rows(spark, fixture_rows())
    sinks = incremental.IncrementalSinks(os.path.join(tmp_dir, "s"))
    incremental.process_batch(df, 0, sinks, POLICY)
    incremental.process_batch(df, 0, sinks, POLICY)  # same batch id again (a retry)
    assert spark.read.parquet(sinks.changes).count() == 25
    assert spark.read.parquet(sinks.processed).count() == 25


@pytest.mark.parametrize("engine", ["fold", "state-store"])
def test_lifecycle_stream_matches_batch_fold(spark, tmp_dir, engine):
    relation = {"NEW": ("a",), "a": ("b", "x"), "b": ("c", "x")}
    cmds = random_commands(300, 25, ["a", "b", "c", "x"], seed=2)
    df = spark.createDataFrame(cmds, "key string, ts timestamp, seq long, target string")
    src = os.path.join(tmp_dir, "cmds")
    df.repartition(4, "key").write.mode("overwrite").parquet(src)
    sink = lifecycle_state.run_lifecycle_stream(
        spark, src, "key string, ts timestamp, seq long, target string", relation, "NEW",
        files_per_trigger=1, root=os.path.join(tmp_dir, "lc"), engine=engine)
    state = lifecycle_state.current_state(spark.read.parquet(sink))
    got = {r.key: (r.status, r.late) for r in state.collect()}
    exp, _ = brute_fold(cmds, relation, "NEW")
    assert {k: v[0] for k, v in got.items()} == exp
    assert all(v[1] == 0 for v in got.values())
    batch_state, _ = L.fold_transitions(df, relation, start="NEW")
    assert {r.key: r.status for r in batch_state.collect()} == exp


@pytest.mark.parametrize("engine", ["fold", "state-store"])
def test_late_commands_are_counted_not_applied(spark, tmp_dir, engine):
    relation = {"NEW": ("a",), "a": ("b",)}
    t = dt.datetime(2026, 1, 1)
    schema = "key string, ts timestamp, seq long, target string"
    src = os.path.join(tmp_dir, "cmds")
    root = os.path.join(tmp_dir, "lc")
    first = [("k", t + dt.timedelta(minutes=5), 2, "a")]
    spark.createDataFrame(first, schema).coalesce(1).write.mode("append").parquet(src)
    lifecycle_state.run_lifecycle_stream(spark, src, schema, relation, "NEW", root=root,
                                         engine=engine)
    # a later file carries one command older than what was already applied
    late = [("k", t, 1, "a"), ("k", t + dt.timedelta(minutes=9), 3, "b")]
    spark.createDataFrame(late, schema).coalesce(1).write.mode("append").parquet(src)
    sink = lifecycle_state.run_lifecycle_stream(spark, src, schema, relation, "NEW", root=root,
                                                engine=engine)
    state = lifecycle_state.current_state(spark.read.parquet(sink)).collect()[0]
    assert (state.status, state.moves, state.late, state.last_seq) == ("b", 2, 1, 3)


def test_failed_batch_is_replayed_exactly_once(spark, tmp_dir, monkeypatch):
    """A micro-batch that fails after writing some sinks is replayed from the
    checkpoint on restart; every sink ends with each version exactly once."""
    src = os.path.join(tmp_dir, "landing")
    df = land_fixture(spark, src)
    root, ck = os.path.join(tmp_dir, "sinks"), os.path.join(tmp_dir, "ck")
    real_write = incremental._write_batch

    def failing_write(frame, path, run, batch_id):
        real_write(frame, path, run, batch_id)
        if batch_id == 1 and path.endswith("request_changes"):
            raise RuntimeError("executor lost while writing batch 1")

    monkeypatch.setattr(incremental, "_write_batch", failing_write)
    with pytest.raises(Exception, match="executor lost while writing batch 1"):
        incremental.run_incremental(spark, src, sinks_root=root, checkpoint=ck, policy=POLICY,
                                    schema=df.schema)
    monkeypatch.setattr(incremental, "_write_batch", real_write)
    half = spark.read.parquet(os.path.join(root, "request_changes")).where("batch_id = 1")
    assert not half.isEmpty()  # written, but its processed versions were not
    assert spark.read.parquet(os.path.join(root, "processed")).where("batch_id = 1").isEmpty()
    sinks = incremental.run_incremental(spark, src, sinks_root=root, checkpoint=ck, policy=POLICY,
                                        schema=df.schema)
    changes = spark.read.parquet(sinks.changes)
    assert changes.count() == 25
    assert changes.select("opportunity_id").distinct().count() == 25
    assert spark.read.parquet(sinks.processed).count() == 25
    assert spark.read.parquet(sinks.events).count() == 25 + 21


def one_file(spark, path, rows):
    R.from_rows(spark, rows).coalesce(1).write.mode("append").parquet(path)


def test_checkpoint_lost_and_made_again_at_the_same_path_loses_nothing(spark, tmp_dir):
    """Two files drained one by one; a third lands, the checkpoint is lost and
    made again with a larger trigger: its batches never replace the first run's."""
    src, root, ck = (os.path.join(tmp_dir, d) for d in ("landing", "sinks", "ck"))
    rows = fixture_rows()
    schema = R.from_rows(spark, rows).schema
    one_file(spark, src, rows[:8])
    one_file(spark, src, rows[8:16])
    incremental.run_incremental(spark, src, sinks_root=root, checkpoint=ck, policy=POLICY, schema=schema)
    first = incremental.run_id(spark, ck)
    one_file(spark, src, rows[16:])
    os.rename(ck, os.path.join(tmp_dir, "lost"))
    sinks = incremental.run_incremental(spark, src, sinks_root=root, checkpoint=ck, policy=POLICY,
                                        files_per_trigger=2, schema=schema)
    assert incremental.run_id(spark, ck) != first
    changes = spark.read.parquet(sinks.changes)
    assert changes.count() == changes.select("opportunity_id").distinct().count() == 25
    assert spark.read.parquet(sinks.processed).count() == 25


def test_marks_are_read_before_and_committed_after_each_batch(spark, tmp_dir):
    """A later batch with older records only keeps the source's mark."""
    src, root, ck = (os.path.join(tmp_dir, d) for d in ("landing", "sinks", "ck"))
    rows = fixture_rows()[:4]
    for r, hour in zip(rows, (12, 15, 9, 10)):
        r["LastModifiedDate"] = f"2026-08-19T{hour:02d}:00:00Z"
    schema = R.from_rows(spark, rows).schema
    for part in (rows[:2], rows[2:]):
        one_file(spark, src, part)
        sinks = incremental.run_incremental(spark, src, sinks_root=root, checkpoint=ck, policy=POLICY, schema=schema)
    stored = spark.read.parquet(sinks.marks)
    assert [r.watermark.hour for r in stored.orderBy("batch_id").collect()] == [15, 15]
    assert [tuple(r) for r in incremental.latest_marks(stored).collect()] == [("flat-file", dt.datetime(2026, 8, 19, 15))]


def test_state_of_another_checkpoint_is_refused(spark, tmp_dir):
    schema = "key string, ts timestamp, seq long, target string"
    src, root = os.path.join(tmp_dir, "cmds"), os.path.join(tmp_dir, "lc")
    spark.createDataFrame([("k", dt.datetime(2026, 1, 1), 1, "a")], schema).coalesce(1).write.parquet(src)
    sink = lifecycle_state.run_lifecycle_stream(spark, src, schema, {"NEW": ("a",)}, "NEW", root=root)
    os.rename(os.path.join(root, "checkpoint"), os.path.join(tmp_dir, "lost"))
    with pytest.raises(Exception, match="state of another checkpoint"):
        lifecycle_state.run_lifecycle_stream(spark, src, schema, {"NEW": ("a",)}, "NEW", root=root)
    assert lifecycle_state.current_state(spark.read.parquet(sink)).count() == 1


def test_csv_files_with_columns_in_another_order_stop_the_stream(spark, tmp_dir):
    src = os.path.join(tmp_dir, "landing")
    df = R.from_rows(spark, fixture_rows())
    df.coalesce(1).write.option("header", True).csv(src)
    df.select(*reversed(df.columns)).coalesce(1).write.mode("append").option("header", True).csv(src)
    with pytest.raises(Exception, match="header"):
        incremental.run_incremental(spark, src, os.path.join(tmp_dir, "s"), os.path.join(tmp_dir, "ck"), POLICY,
                                    source_format="csv", schema=df.schema)


def test_a_batch_keeps_only_what_its_sinks_hold(spark, tmp_dir, monkeypatch):
    """Versions are dealt out without the deal's other fields, and a landing has files for every core."""
    from tidemark.plans import catalog_streaming as C

    kept, real = [], incremental.first_per_version
    monkeypatch.setattr(incremental, "first_per_version", lambda df: kept.append(df.columns) or real(df))
    incremental.process_batch(R.from_rows(spark, fixture_rows()), 0, incremental.IncrementalSinks(os.path.join(tmp_dir, "s")), POLICY)
    assert kept == [incremental.SINK_FIELDS]
    assert C.landing_scale(spark) >= spark.sparkContext.defaultParallelism
