"""State relation, ordered fold and decisions (W10), checked against a plain
sequential replay on small fixtures."""

import datetime as dt
import random

import pytest

from tidemark.operators import lifecycle as L
from tidemark.operators import review
from tidemark.plans import policy as P

T0 = dt.datetime(2026, 1, 1)


def brute_fold(cmds, relation, start):
    """Reference semantics: apply in (ts, seq) order; illegal leaves state unchanged."""
    legal = {(s, t) for s, ts in relation.items() for t in ts}
    state, out = {}, {}
    for key, ts, seq, target in sorted(cmds, key=lambda c: (c[0], c[1], c[2])):
        cur = state.get(key, start)
        ok = (cur, target) in legal
        out[(key, seq)] = (cur, ok)
        if ok:
            state[key] = target
    keys = {c[0] for c in cmds}
    return {k: state.get(k, start) for k in keys}, out


def random_commands(n, keys, targets, hot_share=0.0, seed=7):
    rnd = random.Random(seed)
    cmds = []
    for i in range(n):
        key = "HOT" if rnd.random() < hot_share else f"k{rnd.randrange(keys)}"
        ts = T0 + dt.timedelta(minutes=rnd.randrange(50))  # many ties on ts
        cmds.append((key, ts, i, rnd.choice(targets)))
    return cmds


def run_fold(spark, cmds, relation, start):
    df = spark.createDataFrame(cmds, "key string, ts timestamp, seq long, target string")
    state, moves = L.fold_transitions(df, relation, start=start)
    outcomes = L.command_outcomes(df, moves, start=start, relation=relation)
    return ({r.key: r.status for r in state.collect()},
            {(r.key, r.seq): (r.state_before, r.applied) for r in outcomes.collect()},
            moves)


def test_request_relation_fold_matches_sequential_replay(spark):
    targets = list(P.STATES[1:])
    cmds = random_commands(600, 40, targets)
    final, outcomes, moves = run_fold(spark, cmds, P.REQUEST_TRANSITIONS, P.NEW)
    exp_final, exp_out = brute_fold(cmds, P.REQUEST_TRANSITIONS, P.NEW)
    assert final == exp_final
    assert outcomes == exp_out
    # every move is a legal edge and steps are dense per key
    for r in moves.collect():
        assert r.to_status in P.REQUEST_TRANSITIONS[r.from_status]


def test_hot_key_with_a_third_of_rows(spark):
    relation = {"NEW": ("a",), "a": ("b", "x"), "b": ("c", "x"), "c": ("d", "x")}
    cmds = random_commands(900, 30, ["a", "b", "c", "d", "x"], hot_share=0.34, seed=11)
    assert sum(1 for c in cmds if c[0] == "HOT") > 250
    final, outcomes, _ = run_fold(spark, cmds, relation, "NEW")
    exp_final, exp_out = brute_fold(cmds, relation, "NEW")
    assert final == exp_final and outcomes == exp_out


def test_cyclic_relation_is_refused(spark):
    relation = {"NEW": ("on",), "on": ("off",), "off": ("on",)}
    cmds = random_commands(10, 2, ["on", "off"], seed=3)
    with pytest.raises(ValueError, match="cycle"):
        run_fold(spark, cmds, relation, "NEW")


def test_decisions_touch_decided_requests_only(spark):
    """Of many requests the fold writes and joins those with a decision."""
    cols = ("request_id string, opportunity_id string, status string, validation_errors array<string>, "
            "approved_by string, approved_at timestamp, registration_number string, submitted_at timestamp, "
            "error string, updated_at timestamp, change_seq long, last_event_seq long")
    requests = spark.createDataFrame([(f"r{i}", f"o{i}", "VALIDATED", [], None, None, None, None, None, T0, 1, 2)
                                      for i in range(50)], cols)
    decisions = spark.createDataFrame(
        [("r7", "REVIEW", "a", None, T0, 1), ("r7", "APPROVE", "a", None, T0, 2), ("r9", "APPROVE", "a", None, T0, 1),
         ("r9", "APPROVE", "a", None, T0, 1), ("absent", "REVIEW", "a", None, T0, 1)],
        "request_id string, decision string, actor string, reason string, ts timestamp, seq long")
    changes, events, rejects = review.apply_decisions(requests, decisions)
    assert [(r.request_id, r.status, r.approved_by, r.change_seq, r.last_event_seq) for r in changes.collect()] == [
        ("r7", "APPROVED", "a", 2, 4)]
    assert sorted((e.request_id, e.event_seq, e.to_status) for e in events.collect()) == [
        ("r7", 3, "READY_FOR_REVIEW"), ("r7", 4, "APPROVED")]
    assert sorted((r.request_id, r.state_before) for r in rejects.collect()) == [
        ("absent", "NEW"), ("r9", "VALIDATED"), ("r9", "VALIDATED")]
    for df in (changes, events, rejects):
        assert "FullOuter" not in df._jdf.queryExecution().executedPlan().toString()


def test_transition_check(spark):
    df = spark.createDataFrame([("READY_FOR_REVIEW", "APPROVED"), ("NEW", "APPROVED"),
                                ("REGISTERED", "SUBMITTED")], "from_status string, to_status string")
    out = [(r.legal, r.transition_error) for r in L.check_transitions(df).collect()]
    assert out == [(True, None), (False, "Invalid registration transition: NEW -> APPROVED"),
                   (False, "Invalid registration transition: REGISTERED -> SUBMITTED")]
    assert P.relation_depth(P.REQUEST_TRANSITIONS, P.NEW) == 6


def test_decisions(spark):
    reqs = spark.createDataFrame(
        [("r1", "o1", "VALIDATED", 1, 2), ("r2", "o2", "VALIDATED", 1, 2),
         ("r3", "o3", "NEW", 1, 0), ("r4", "o4", "READY_FOR_REVIEW", 2, 3)],
        "request_id string, opportunity_id string, status string, change_seq long, last_event_seq long"
    ).selectExpr("*", "cast(null as array<string>) as validation_errors",
                 "cast(null as string) as approved_by", "cast(null as timestamp) as approved_at",
                 "cast(null as string) as registration_number", "cast(null as timestamp) as submitted_at")
    d = [("r1", "REVIEW", None, None, T0, 1), ("r1", "APPROVE", "mgr@x", None, T0 + dt.timedelta(1), 2),
         ("r2", "APPROVE", "mgr@x", None, T0, 1), ("r2", "REVIEW", None, None, T0 + dt.timedelta(1), 2),
         ("r2", "REJECT", None, "too big", T0 + dt.timedelta(2), 3),
         ("r3", "APPROVE", "mgr@x", None, T0, 1), ("r4", "approve", "boss", None, T0, 1),
         ("r1", "ESCALATE", "x", None, T0 + dt.timedelta(3), 3),
         ("r9", "REVIEW", None, None, T0, 1)]
    decisions = spark.createDataFrame(d, "request_id string, decision string, actor string, "
                                         "reason string, ts timestamp, seq long")
    changes, events, rejects = review.apply_decisions(reqs, decisions)
    ch = {r.request_id: r for r in changes.collect()}
    assert ch["r1"].status == "APPROVED" and ch["r1"].approved_by == "mgr@x"
    assert ch["r1"].change_seq == 2 and ch["r1"].last_event_seq == 4
    assert ch["r2"].status == "REJECTED" and ch["r2"].error == "too big"
    assert ch["r4"].status == "APPROVED" and ch["r4"].approved_by == "boss"
    assert "r3" not in ch
    ev = sorted((r.request_id, r.event_seq, r.from_status, r.to_status, r.actor) for r in events.collect())
    assert ev[:2] == [("r1", 3, "VALIDATED", "READY_FOR_REVIEW", None),
                      ("r1", 4, "READY_FOR_REVIEW", "APPROVED", "mgr@x")]
    rj = sorted((r.request_id, r.seq, r.rejection) for r in rejects.collect())
    assert rj == [("r1", 3, "Invalid registration transition: APPROVED -> UNKNOWN"),
                  ("r2", 1, "Invalid registration transition: VALIDATED -> APPROVED"),
                  ("r3", 1, "Invalid registration transition: NEW -> APPROVED"),
                  ("r9", 1, "Invalid registration transition: NEW -> READY_FOR_REVIEW")]


def test_skewed_request_lifecycle_matches_replay_on_small_tables(spark):
    """The registered hot-key query (no SQL oracle) against a sequential
    replay of the same commands at sf0.001."""
    import __spark_entry__ as E
    from tests.conftest import SF_SMALL
    from tidemark.sources import testdata as T

    cmds = [(r.key, r.ts, r.seq, r.target)
            for r in T.skewed_request_commands(spark, SF_SMALL).collect()]
    hot = sum(1 for c in cmds if c[0] == "HOT")
    assert hot * 4 > len(cmds)  # the hot key holds about a third
    exp, _ = brute_fold(cmds, P.REQUEST_TRANSITIONS, P.NEW)
    got = {r.key: r.status for r in E.queries()["skewed_request_lifecycle"](spark, SF_SMALL).collect()}
    assert got == exp


def test_fold_property_against_replay(spark):
    """Generated command logs (ties, repeats, illegal targets) through the
    Spark fold equal the sequential replay, for the full request relation."""
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    command = st.tuples(
        st.sampled_from(["a", "b", "c"]),
        st.integers(min_value=0, max_value=4),
        st.sampled_from(list(P.STATES[1:])),
    )

    @settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(command, min_size=1, max_size=40))
    def check(spec):
        cmds = [(k, T0 + dt.timedelta(minutes=m), i, t) for i, (k, m, t) in enumerate(spec)]
        final, outcomes, _ = run_fold(spark, cmds, P.REQUEST_TRANSITIONS, P.NEW)
        exp_final, exp_out = brute_fold(cmds, P.REQUEST_TRANSITIONS, P.NEW)
        assert final == exp_final and outcomes == exp_out

    check()


def test_outcomes_with_a_repeated_seq(spark):
    """``seq`` may repeat at another time: one row per command, applied or not on its own."""
    day = [dt.datetime(2030, 5, d) for d in (1, 2, 3)]
    cmds = spark.createDataFrame(
        [("k", day[0], 1, "ELIGIBLE"), ("k", day[1], 1, "VALIDATED"), ("k", day[2], 1, "REGISTERED")],
        "key string, ts timestamp, seq long, target string")
    _, moves = L.fold_transitions(cmds)
    got = L.command_outcomes(cmds, moves).orderBy("ts").collect()
    assert [(r.target, r.applied) for r in got] == [("ELIGIBLE", True), ("VALIDATED", True), ("REGISTERED", False)]


def test_outcomes_and_decisions_shuffle_commands_once(spark):
    """The outcomes need one join with the moves, and decisions write no request table again."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cmds = random_commands(200, 20, list(P.STATES[1:]), seed=5) + [("k0", None, 900, "ELIGIBLE"), ("k1", T0, 901, None)]
        df = spark.createDataFrame(cmds, "key string, ts timestamp, seq long, target string")
        _, moves = L.fold_transitions(df)
        plan = L.command_outcomes(df, moves)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Join ") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_decisions_write_only_moves(spark, monkeypatch):
    cuts, real = [], L.cut_lineage
    monkeypatch.setattr(L, "cut_lineage", lambda df, name, *a: cuts.append(name) or real(df, name, *a))
    reqs = spark.createDataFrame(
        [("r1", "o1", "VALIDATED", 1, 2), ("r2", "o2", "NOT_ELIGIBLE", 1, 1)],
        "request_id string, opportunity_id string, status string, change_seq long, last_event_seq long").selectExpr(
        "*", "array('e') AS validation_errors", "cast(null AS string) AS approved_by", "cast(null AS timestamp) AS approved_at",
        "cast(null AS string) AS registration_number", "cast(null AS timestamp) AS submitted_at")
    decisions = spark.createDataFrame(
        [(r, d, "a", "why", T0 + dt.timedelta(days=i), i) for r in ("r1", "r2", "r9") for i, d in enumerate(("REVIEW", "APPROVE"), 1)],
        "request_id string, decision string, actor string, reason string, ts timestamp, seq long")
    changes, events, rejects = review.apply_decisions(reqs, decisions)
    assert [(r.request_id, r.status, r.last_event_seq) for r in changes.collect()] == [("r1", "APPROVED", 4)]
    assert sorted((r.event_seq, r.to_status) for r in events.collect()) == [(3, "READY_FOR_REVIEW"), (4, "APPROVED")]
    assert sorted((r.request_id, r.seq, r.state_before) for r in rejects.collect()) == [
        ("r2", 1, "NOT_ELIGIBLE"), ("r2", 2, "NOT_ELIGIBLE"), ("r9", 1, "NEW"), ("r9", 2, "NEW")]
    assert cuts and all(c.startswith("moves-") for c in cuts)
