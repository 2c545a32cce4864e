"""Event-time ordered commands and the stream-stream join of answers, against plain Python."""

import datetime as dt
import os
import random

from pyspark.sql import functions as F

from tidemark.streaming import answers, event_order
from tidemark.streaming import lifecycle_state as L

RELATION = {"NEW": ("a",), "a": ("b", "x"), "b": ("c", "x")}
SCHEMA = "key string, ts timestamp, seq long, target string"
T0 = dt.datetime(2026, 1, 1)
HOUR = dt.timedelta(hours=1)


def plain_order(batches, delay):
    """(state per key, late rows): rows wait for the mark, then move in order."""
    mark, waiting, late, state = None, [], [], {}
    for batch in batches:
        old = mark
        for r in batch:
            if r[0] is None:
                continue
            (late if r[1] is None or (old is not None and r[1] <= old) else waiting).append(r)
        times = [r[1] - delay for r in batch if r[1] is not None]
        mark = max([*times, *([old] if old else [])], default=None)
        ready = sorted((r for r in waiting if mark is not None and r[1] <= mark), key=lambda r: (r[1], r[2]))
        waiting = [r for r in waiting if not (mark is not None and r[1] <= mark)]
        for key, _, seq, target in ready:
            status, moves = state.get(key, ("NEW", 0))
            state[key] = (target, moves + 1) if target in RELATION.get(status, ()) else (status, moves)
    return state, late, waiting


def test_commands_wait_for_their_turn(spark, tmp_dir):
    rng = random.Random(5)
    rows = [(rng.choice(["hot", "hot", "k1", "k2", "k3"]), T0 + HOUR * rng.randint(0, 60), i, rng.choice("aabbccx")) for i in range(160)]
    arrival = sorted(rows, key=lambda r: r[1] + HOUR * rng.uniform(0, 9))  # some beyond the delay of six hours
    batches = [arrival[i : i + 55] for i in range(0, 160, 55)]
    batches[1].append(("k1", None, 999, "a"))
    batches += [[(None, T0 + HOUR * 200, None, None)], [("k2", T0 + HOUR * 3, 1000, "a")]]
    frames = [spark.createDataFrame(b, SCHEMA).repartition(2) for b in batches]
    for n, frame in enumerate(frames):
        event_order.ordered_batch(frame, n, tmp_dir, RELATION, "NEW", "6 HOURS")
        if n == 1:  # a replayed batch replaces its own rows
            event_order.ordered_batch(frame, n, tmp_dir, RELATION, "NEW", "6 HOURS")
    state, late, waiting = plain_order(batches, HOUR * 6)
    got = L.current_state(spark.read.parquet(os.path.join(tmp_dir, "updates"))).collect()
    assert {r.key: (r.status, r.moves) for r in got} == state
    assert sum(r.late for r in got) == 0 and not waiting
    assert sorted(r.seq for r in event_order.late_commands(spark, tmp_dir).collect()) == sorted(r[2] for r in late)
    assert len(late) > 2 and {999, 1000} <= {r[2] for r in late}


def test_answers_settle_within_the_bound_and_pending_comes_once(spark, tmp_dir):
    day = dt.timedelta(days=1)
    sent = [(f"r{i}", T0 + HOUR * i) for i in range(12)] + [(None, T0)]
    told = [("r0", 201, '{"registration_number":"A"}', T0 + day), ("r0", 400, "", T0 + day * 2),  # the earliest counts
            ("r1", 503, "", T0 + HOUR + day * 7),  # at the bound
            ("r2", 201, "{}", T0 + HOUR * 2 + day * 7 + dt.timedelta(seconds=1)),  # after it
            ("r3", 201, "{}", T0 + HOUR * 2),  # before it was sent
            ("r4", 202, "{}", T0 + HOUR * 4), ("r5", 418, None, T0 + HOUR * 6), ("nobody", 201, "{}", T0), (None, 201, "{}", T0)]
    end = T0 + day * 30
    out, ans, root = (os.path.join(tmp_dir, d) for d in ("outbox", "answers", "run"))
    counts = []
    # answers come before their request in the first part; the beats close both sides
    for s, a in ((sent[6:], told), (sent[:6], told[:0]), ([("", end)], [("", None, None, end)])):
        spark.createDataFrame(s, answers.OUTBOX_SCHEMA).write.mode("append").parquet(out)
        spark.createDataFrame(a, answers.ANSWERS_SCHEMA).write.mode("append").parquet(ans)
        # both parts lie within one watermark: a lateness of ten days keeps the first part's answers open
        sink = answers.run_answers(spark, out, ans, root, lateness="10 DAYS")
        counts.append(spark.read.parquet(sink).where("answered_at IS NULL").count())
    assert counts == [0, 0, 8]
    joined = spark.read.parquet(sink)
    assert joined.where(F.col("answered_at").isNull()).groupBy("request_id").count().where("count > 1").isEmpty()
    got = {r.request_id: (r.outcome, r.registration_number, r.error) for r in answers.outcomes(joined).collect()}
    want = {f"r{i}": ("PENDING", None, None) for i in range(12)}
    want["r0"] = ("REGISTERED", "A", None)
    want["r1"] = ("SUBMISSION_FAILED", None, "Downstream registration is retryable")
    want["r4"] = ("SUBMISSION_UNKNOWN", None, None)
    want["r5"] = ("SUBMISSION_FAILED", None, "Downstream registration rejected: HTTP 418")
    assert got == want
